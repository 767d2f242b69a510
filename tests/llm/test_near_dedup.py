import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexispan.llm import near_dedup
from lexispan.llm.components import components
from lexispan.llm.near_dedup import near_duplicates, one_of_each

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, width):
    """{doc_id: (n_shingles, component_id, kept)} by comparing all pairs."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets}


def corpus(seed, n=150):
    rnd = random.Random(seed)
    make = lambda k: [f"w{rnd.randrange(400)}" for _ in range(k)]
    made, rows = [], []
    passage = make(30)
    for i in range(n):
        kind = rnd.randrange(6)
        if kind < 3 and made:
            words = list(rnd.choice(made))
            for _ in range(rnd.randrange(0, 4)):
                if words:
                    words[rnd.randrange(len(words))] = rnd.choice(["NEW", "x", "Été"])
        elif kind == 3:
            words = make(rnd.randrange(0, 8))
        elif kind == 4:
            words = passage + make(rnd.randrange(5, 40))
        else:
            words = make(rnd.randrange(20, 120))
        made.append(words)
        rows.append((i * 7 + 3, rnd.choice([" ", "\t", " \n"]).join(w.upper() if rnd.random() < 0.1 else w for w in words)))
    rows += [(5000, None), (5001, ""), (5002, " \n "), (5003, "one"), (5004, "ONE"), (5005, "Straße É"), (5006, "straße É")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,width", [(1, 4), (2, 5)])
def test_against_all_pairs(spark, seed, width):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r[0]: tuple(r[1:]) for r in near_duplicates(docs, width).collect()}
    assert found == brute(rows, width)


@pytest.mark.parametrize("held,streamed,chunk", [(2048, 8192, 1 << 24), (2, 3, 2500)])
def test_links_that_no_centre_shows(spark, monkeypatch, held, streamed, chunk):
    """A chain of edits whose ends are unlike: only its steps are links."""
    monkeypatch.setattr(near_dedup, "HELD", held)
    monkeypatch.setattr(near_dedup, "STREAMED", streamed)
    monkeypatch.setattr(near_dedup, "CHUNK_BYTES", chunk)
    base = [f"c{i}" for i in range(100)]
    chain = []
    for i in range(8):
        chain.append(list(base))
        base[i * 10 + 5] = f"z{i}"
    rows = [(i, "same few words here " + " ".join(c)) for i, c in enumerate(chain)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r[0]: tuple(r[1:]) for r in near_duplicates(docs, 4).collect()}
    assert found == brute(rows, 4)


def test_pairs_of_four_and_five_shingles(spark):
    """The last numbers make shingles whose extra one differs in its low bits from all others."""
    unlike = [2159, 6663, 9121, 9303, 9545, 10607, 12724, 13310, 15159, 15856, 17672, 18056, 20729, 20791, 23358, 24696, 26245, 29650]
    rows = []
    for i in [*range(2000), *unlike]:
        words = [f"{c}{i}" for c in "abcdefgh"]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:-1]))]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    assert len(found) == len(rows)
    assert [r.doc_id for r in found if r.component_id != r.doc_id // 2 * 2] == []


def test_bits_of_sketches_are_counted_as_unsigned():
    """Blocks compare all bits of a sketch, the sign bit of a word included."""
    words = [[f"{i}x{k}" for k in range(27)] for i in range(200)]
    sides = []
    for cut in (0, 2):
        texts = [" ".join(w[cut:]) for w in words]
        sketched = pa.Table.from_batches(near_dedup._sketcher(1)([pa.RecordBatch.from_pydict({"_id": list(range(200)), "_text": texts})]))
        planes = sketched["planes"].to_pylist()
        roots = [cut * 1000 + i for i in range(200)]
        sides.append((planes, pa.RecordBatch.from_pydict({"root": roots, "number": roots, "planes": planes})))
    (a, own), (b, other) = sides
    most, size = near_dedup.most_different(80), near_dedup.WORDS

    def differing(x, y):
        odd = [u ^ v for u, v in zip(x, y)]
        return sum(((odd[w] | odd[w + size]) % 2**64).bit_count() for w in range(size))

    expected = {(i, j) for i in range(200) for j in range(200) if differing(a[i], b[j]) <= most}
    assert {(i, i) for i in range(200)} <= expected
    x, y = near_dedup._alike(near_dedup._sketch_rows(own), near_dedup._sketch_rows(other), most)
    assert set(zip(x.tolist(), y.tolist())) == expected


def test_a_large_group_of_copies(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[:100] + [f"n{i}"] + words[100:])) for i in range(400)] + [(1000 + i, " ".join(words)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = near_duplicates(docs).collect()
    assert len(found) == 700 and {r.component_id for r in found} == {0} and sum(r.kept for r in found) == 1


def test_odd_rows(spark):
    text, other = "a b c d e f g h i j", "k l m n o p q r s t"
    rows = [(1, text, "x"), (1, other, "y"), (1, text, "x"), (2, other, "z"), (None, text, "u"), (None, None, "v"), (3, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    found = sorted(map(str, ((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).collect())))
    assert found == sorted(map(str, [(1, 1, True)] * 3 + [(2, 1, False), (None, None, True), (None, None, True), (3, 3, True)]))
    left = one_of_each(docs)
    assert left.columns == docs.columns and left.count() == 6
    assert near_duplicates(docs.limit(0)).collect() == []


def test_estimate_is_close(spark):
    rnd = np.random.default_rng(5)
    rows = []
    for share in (0.2, 0.5, 0.8, 0.95):
        both = [f"w{i}" for i in range(int(2000 * share / (1 + share)) * 1)]
        rest = (2000 - 2 * len(both)) // 2 if share < 1 else 0
        a = both + [f"a{i}" for i in range(max(rest, 0))]
        b = both + [f"b{i}" for i in range(max(rest, 0))]
        true = len(set(a) & set(b)) / len(set(a) | set(b))
        rows.append((" ".join(a), " ".join(b), true))
    sketch = near_dedup._sketcher(1)
    planes = []
    for column in (0, 1):
        batch = pa.RecordBatch.from_pydict({"_id": list(range(len(rows))), "_text": [r[column] for r in rows]})
        planes.append([p for out in sketch([batch]) for p in out["planes"].to_pylist()])
    df = spark.createDataFrame([(*p, r[2]) for *p, r in zip(*planes, rows)], "a array<long>, b array<long>, true double")
    for r in df.select(near_dedup.similarity_estimate(near_dedup.differing_minima(F.col("a"), F.col("b"))).alias("e"), "true").collect():
        assert abs(r.e - r.true) < 0.12


@pytest.mark.parametrize("few,hubs", [(500_000, 100_000), (0, 20)])
def test_components(spark, monkeypatch, few, hubs):
    monkeypatch.setattr("lexispan.llm.components.FEW_EDGES", few)
    monkeypatch.setattr("lexispan.llm.components.MOST_HUBS", hubs)
    rnd = random.Random(4)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(500, 500 + i) for i in range(50)] + [(600 + i, 601 + i) for i in range(40)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    expected = {x: find(x) for x in root if find(x) != x}
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert {n: r for n, r in found.items() if n != r} == expected


def test_rows_made_of_a_group_of_unlike_members(spark):
    """Members of one bucket that no link joins: each pair is looked at, but few become rows."""
    rnd = random.Random(11)
    base = [f"b{i}" for i in range(60)]
    texts = []
    for i in range(500):
        words = list(base)
        for k in rnd.sample(range(60), 5):
            words[k] = f"n{i}.{k}"
        texts.append(" ".join(words))
    texts += [t + " and some more" for t in texts[:50]]
    nodes = spark.createDataFrame(list(enumerate(texts)), "_id long, _text string").repartition(3)
    sketches = nodes.mapInArrow(near_dedup._sketcher(1), "_id long, n_shingles long, s1 long, s2 long, keys array<long>, planes array<long>")
    node = F.struct(F.col("_id").alias("rep"), F.lit(0).cast("long").alias("var"))
    sketched = sketches.select(node.alias("node"), "s1", "s2", "n_shingles", "keys", "planes").cache()
    tied = near_dedup._tied(sketched.select("node", "keys"))
    roots = spark.createDataFrame([], "node struct<rep:long,var:long>, root struct<rep:long,var:long>")
    made = near_dedup._candidates(tied, roots, sketched, 80).count()
    assert made <= 64 * len(texts)
    found = {r.doc_id: r.component_id for r in near_duplicates(nodes.withColumnsRenamed({"_id": "doc_id", "_text": "text"}), 1).collect()}
    assert all(found[500 + i] == found[i] for i in range(50))


def thue_morse(bits: int) -> tuple[str, str]:
    """Two words of 2 ** ``bits`` letters whose rolling hashes by powers are equal modulo 2 ** 64."""
    word = "".join("ab"[i.bit_count() % 2] for i in range(1 << bits))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("bits", [10, 12])
def test_words_that_rolling_hashes_confuse(spark, bits):
    rows = list(enumerate([w for w in thue_morse(bits)] + [f"x {w} y z" for w in thue_morse(bits)]))
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1).collect()
    assert [(r.doc_id, r.component_id) for r in found if r.doc_id != r.component_id] == []
