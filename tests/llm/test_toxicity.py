import random

import numpy as np
from pyspark.sql import functions as F

from lexispan.llm.toxicity import fit, maximal_segments, score

WORDS = [f"{a}{b}" for a in "ba ce di fo gu ma ne ri so tu".split() for b in "lan mek tor vip".split()]
BAD = ["vile", "rotten", "filth"]


def corpus(seed, n=400):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [rnd.choice(WORDS) for _ in range(rnd.randrange(40, 120))]
        toxic = i % 5 == 0
        if toxic:
            at = rnd.randrange(len(words))
            words[at:at] = [rnd.choice(BAD + WORDS[:4]) if j % 2 else rnd.choice(BAD) for j in range(8)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def segments_by_definition(scores):
    """Recursive definition: the best segment, then the same left and right of it."""
    def of(a, b):
        best = max(((sum(scores[i:j]), -i, i - j, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
        if best[0] <= 0:
            return []
        i, j = best[3], best[4]
        return of(a, i) + [(i, j, best[0])] + of(j, b)

    return of(0, len(scores))


def test_segments_are_maximal():
    rnd = random.Random(2)
    for _ in range(80):
        scores = [rnd.choice([-3, -2, -1, 1, 2, 4]) + rnd.random() * 0.01 for _ in range(rnd.randrange(0, 14))]
        expected = segments_by_definition(scores)
        found = maximal_segments(np.array(scores))
        assert [x[:2] for x in found] == [x[:2] for x in expected]
        assert np.allclose([x[2] for x in found], [x[2] for x in expected])


def test_held_out_texts(spark):
    rows, labels = corpus(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    asked, truth = corpus(7)
    found = {r.doc_id: r for r in score(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()}
    right = sum((found[i].toxic_score >= 0.5) == bool(t) for i, t in truth)
    assert right >= 0.97 * len(truth)
    texts = dict(asked)
    for i, t in truth:
        for p in found[i].toxic_passages if t else []:
            passage = texts[i][p.start : p.stop]
            assert any(b in passage for b in BAD) and p.expected < 0.05


def test_odd_rows(spark):
    rows, labels = corpus(1)
    rows += [(None, "vile rotten filth"), (5, "vile"), (5, "vile")]
    labels += [(5, None), (None, 1), (5, 1), (5, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    odd = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "vile " * 50_000, "c")], "doc_id long, text string, toxic_score string")
    found = {r.doc_id: r for r in score(odd, model).collect()}
    assert all(0 <= r.toxic_score <= 1 for r in found.values())
    assert found[1].toxic_score == found[2].toxic_score < 0.5 < found[None].toxic_score
    assert score(odd.limit(0), model).collect() == []
    nothing = fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert score(odd, nothing).where(F.col("toxic_score") >= 0.5).count() == 0
