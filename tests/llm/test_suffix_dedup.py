import hashlib
import random

import pytest

from lexispan.llm.suffix_dedup import kept_text, removal_digest, without_repeats

LENGTH = 100


def brute(rows):
    """doc rows -> {doc_id: digest}; every window against all earlier ones."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - LENGTH + 1):
            window = data[i : i + LENGTH]
            if window in seen:
                gone[i : i + LENGTH] = b"\1" * LENGTH
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc_id] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    rnd = random.Random(seed)
    words = ["the", "of", "straße", "año", "élève", "x", "lorem", "ipsum", "wörter", "日本"]
    make = lambda n: " ".join(rnd.choice(words) + str(rnd.randrange(60)) for _ in range(n))
    passages = [make(40) for _ in range(4)]
    rows, made = [], []
    for doc_id in range(60):
        kind = rnd.randrange(8)
        if kind == 0 and made:
            text = rnd.choice(made)
        elif kind == 1 and made:
            base = rnd.choice(made)
            cut = rnd.randrange(len(base) + 1)
            text = base[:cut] + rnd.choice(["", "Z", "été "]) + base[cut + 1 :]
        elif kind == 2:
            text = make(rnd.randrange(30)) + " " + rnd.choice(passages) + " " + make(rnd.randrange(30))
        elif kind == 3:
            text = rnd.choice("ab") * rnd.randrange(90, 400)
        elif kind == 4:
            text = rnd.choice(passages)[: rnd.randrange(95, 200)]
        else:
            text = make(rnd.randrange(60))
        made.append(text)
        rows.append((doc_id * 3 + 1, text))
    rows += [(1000, None), (1001, ""), (1002, "x" * 99), (1003, "x" * 100), (1004, "ab" * 300)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,largest", [(1, 1 << 17), (2, 1 << 17), (3, 2)])
def test_against_all_windows(spark, seed, largest):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r[0]: tuple(r[1:]) for r in removal_digest(docs, largest_group=largest).collect()}
    assert found == brute(rows)


def test_one_passage_over_many_partitions(spark):
    rows = [(i, "q" * (i % 7) + "common passage " * 12 + str(i)) for i in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
        found = {r[0]: tuple(r[1:]) for r in removal_digest(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == brute(rows)


def test_odd_rows(spark):
    text = "one passage that is repeated " * 5
    rows = [(1, text, "a", 0), (1, text, "b", 0), (1, text + "more", "c", 0), (None, text, "d", 0), (None, None, "e", 0), (2, text, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _n int")
    out = without_repeats(docs).collect()
    assert len(out) == 6 and out[0].asDict().keys() == {"doc_id", "text", "source", "_n"}
    by = {(r.doc_id, r.source): r.text for r in out}
    assert by[1, "a"] == by[1, "b"]
    assert by[None, "e"] is None
    assert len(by[2, None]) < 100
    empty = without_repeats(docs.limit(0))
    assert empty.collect() == [] and empty.columns == docs.columns


def test_characters_stay_whole():
    text = "é" * 10
    spans = [{"start": 3, "stop": 9}]
    assert kept_text(text, spans) == "é" * 8
    assert kept_text(None, spans) is None
