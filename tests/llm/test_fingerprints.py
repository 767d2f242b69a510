import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lexispan.llm import fingerprints as P


def shingles(text, width=5):
    words = text.lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def corpus(seed, n=120):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        text = " ".join(rnd.choice(["the", "Straße", "日本", "x"]) + str(rnd.randrange(50)) for _ in range(rnd.randrange(0, 200)))
        rows.append((i * 5 - 40, text))
    return rows + [(10_000, None), (10_001, ""), (10_002, "one"), (10_003, "One"), (-99, "a b c d e f g")]


@pytest.mark.parametrize("bucket_rows", [1500, 10])
def test_against_whole_sets(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(P, "BUCKET_ROWS", bucket_rows)
    rows = corpus(3)
    found = {r.doc_id: r for r in P.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    texts = sorted((i, t or "") for i, t in rows)
    assert len(found) == len(rows)
    for at, (i, text) in enumerate(texts):
        following = texts[(at + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = found[i]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = shingles(text), shingles(edited), shingles(following)
        alike = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert abs(row.near_edited - alike(a, b)) < (1e-9 if len(a | b) <= P.K else 0.25)
        assert abs(row.near_next - alike(a, c)) < (1e-9 if len(a | c) <= P.K else 0.25)
        assert row.n_shingles == len(a) if len(a) < P.K else abs(row.n_shingles / len(a) - 1) < 0.4
    assert found[10_002].fingerprint == found[10_003].fingerprint != ""


def test_sketches_merge(spark):
    rnd = random.Random(5)
    rows = [(i % 3, " ".join(str(rnd.randrange(1000)) for _ in range(100))) for i in range(30)] + [(7, None), (None, "a b")]
    docs = spark.createDataFrame(rows, "g long, text string")
    whole = docs.select("g", F.explode_outer(P.shingle_hashes(F.col("text"))).alias("h")).groupBy("g").agg(F.sort_array(F.collect_set("h")).alias("h"))
    expected = {r.g: r.h[: P.K] for r in whole.collect()}
    parts = docs.select("g", P.sketch(F.col("text")).alias("sketch"))
    assert {r.g: r.sketch for r in P.merged_sketches(parts, ["g"]).collect()} == expected


def test_estimates(spark):
    a, b = range(0, 3000), range(1000, 3000)
    df = spark.createDataFrame([(" ".join(map(str, a)), " ".join(map(str, b)))], "a string, b string")
    x, y = P.sketch(F.col("a"), 1), P.sketch(F.col("b"), 1)
    row = df.select(P.resemblance(x, y).alias("r"), P.containment(y, x).alias("c"), P.distinct_shingles(x).alias("n")).first()
    assert abs(row.r - 2 / 3) < 0.15 and row.c > 0.8 and abs(row.n / 3000 - 1) < 0.3


def test_odd_rows(spark):
    rows = [(None, "a b c d", 1), (None, "e f g h", 2), (3, "i j", 3), (3, "i j", 4), (3, "k l", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sketch int")
    found = P.fingerprints(docs).collect()
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert sorted(r.edited_sha256 for r in found) == sorted(map(digest, ["a b e f", "e f i j", "i i", "i k", "k a"]))
    assert P.fingerprints(docs.limit(0)).collect() == []


@pytest.mark.parametrize("ids", ["outlying", "clustered", "null"])
def test_ids_that_lie_unevenly(spark, monkeypatch, ids):
    monkeypatch.setattr(P, "BUCKET_ROWS", 20)
    monkeypatch.setattr(P, "CELLS", 64)
    numbers = {
        "outlying": [*range(400), 10**9, 10**15, -(2**62)],
        "clustered": [base + i for base in (0, 10**6, 10**6 + 500, 2**60) for i in range(100)],
        "null": [None] * 30 + [5] * 30 + list(range(100, 300)),
    }[ids]
    rows = [(n, f"text {i}") for i, n in enumerate(numbers)]
    found = P.with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", "text")
    order = [t for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))]
    assert {r.text: r.next_text for r in found.collect()} == dict(zip(order, order[1:] + order[:1]))
    plain = spark.createDataFrame(rows, "id long, text string").withColumn("cell", F.array(F.lit(0)))
    sizes = [r["count"] for r in P._cut_again(plain, 40).groupBy("cell").count().collect()]
    assert max(sizes) <= (60 if ids == "null" else 40) and sum(sizes) == len(rows)
