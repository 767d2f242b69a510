import itertools
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from lexispan.llm import sentencepiece_codec as S

PATH = str(public_tokenizers.path("piece_bpe_32k.model"))
ODD = [
    "", " ", "   ", "a", " a", "a ", "Hello  world", "x\ty\nz", "日本語 テキスト", "zażółć gęślą jaźń", "x́ É ﬁ", "a▁b", "😀😀 ok", "=" * 70 + "word",
    "aaaa" * 40, "supercalifragilisticexpialidocious" * 3, "def f(x):\n    return x+1  # done", "It's 3.14, isn't it?", "\x00\x7f", "ÀÈÌ" * 30, "  indented\n\n\n    more",
]


@pytest.fixture(scope="module")
def model():
    return S.load_pieces(PATH)


def test_ids_are_those_of_the_library(spark, model):
    rnd = random.Random(3)
    letters = "etaoinshrdlu     éßñ.,'-\n"
    texts = ODD + ["".join(rnd.choice(letters) for _ in range(rnd.randrange(200))) for _ in range(150)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for head in (S.HEAD, 50, 0):
        found = {r.doc_id: r.token_ids for r in S.encode(docs, model, head=head).collect()}
        assert [found[i] for i in range(len(texts))] == [library.encode(t) for t in texts]


def test_what_tasks_hold_is_bounded_by_ids_too(spark, model, monkeypatch):
    """Few but long units: the rarer ones take the join, with the same ids."""
    monkeypatch.setattr(S, "HEAD_IDS", 50, raising=False)
    joined = []
    monkeypatch.setattr(S, "_with_rare_units", lambda *args, join=S._with_rare_units: joined.append(args[1].count()) or join(*args))
    texts = ["the the the cat", "日本語テキスト" * 8, "x" * 55 + " the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    found = {r.doc_id: r.token_ids for r in S.encode(docs, model).collect()}
    assert [found[i] for i in range(len(texts))] == [library.encode(t) for t in texts]
    assert len(joined) == 1 and joined[0] >= 2
    units = spark.createDataFrame([(1, 9, [1] * 5), (2, 7, [1] * 45), (3, 7, [1]), (4, 2, [1])], "h long, n long, ids array<int>")
    assert S._least_count(units, 10) == 9


def test_decoding_gives_the_texts_again(spark, model):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, decoded string")
    encoded = S.encode(docs, model, "decoded").withColumnRenamed("decoded", "given")
    for r in S.decode(encoded, model).collect():
        assert r.decoded == r.given.replace("▁", " ")


def test_digests_and_odd_rows(spark, model):
    rows = [(1, None, "a"), (2, "", "b"), (2, "same text", "c"), (2, "same text", "d"), (None, "same text", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    ids = sentencepiece.SentencePieceProcessor(model_file=PATH).encode("same text")
    own = (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), True)
    found = sorted(map(str, (tuple(r) for r in S.codec_digest(docs, model).collect())))
    assert found == sorted(map(str, [(1, 0, 0, True), (2, 0, 0, True), (2, *own), (2, *own), (None, *own)]))
    assert S.encode(docs, model).columns == ["doc_id", "text", "token_ids"]
    assert S.codec_digest(docs.limit(0), model).collect() == []


def best_paths(text, pieces):
    """Least cost over every segmentation, by brute force."""
    best = None
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        edges = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(text)]
        parts = [text[a:b] for a, b in zip(edges, edges[1:])]
        if all(p in pieces or len(p) == 1 for p in parts):
            cost = sum(-pieces[p] if p in pieces else 1e6 for p in parts)
            best = cost if best is None else min(best, cost)
    return best


def test_viterbi_for_unigram_models(spark):
    rnd = random.Random(8)
    names = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 4))) for _ in range(25)} - {"c"})
    table = tuple((p, i + 1, -rnd.random() * 9 - 0.5) for i, p in enumerate(names))
    model = S.PieceTable(table, None, 0, merges=False, prefix=False)
    texts = ["".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 10))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scores = {p: s for p, _, s in table}
    for r in S.encode(docs, model).collect():
        cost = sum(1e6 if i == 0 else -table[i - 1][2] for i in r.token_ids)
        assert cost == pytest.approx(best_paths(r.text, scores))


def test_pieces_across_units_are_refused():
    with pytest.raises(ValueError, match="across"):
        S.PieceTable((("a.", 1, -1.0),), None, 0, merges=True)


def test_units_too_long_for_a_lattice(spark, model):
    rnd = random.Random(12)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    direct = S.UnitEncoder(model)
    word = "".join(rnd.choice("etaoinshrdlu") for _ in range(100_000))
    start = time.process_time()
    ids = direct.ids("▁" + word)
    assert time.process_time() - start < 10
    assert ids == library.encode(word)
    texts = [word, "a " + word[:61] + " b", word[:60], "語" * 3000, "=" * 2000 + " " * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in S.encode(docs, model, verify=True).collect():
        assert r.token_ids == library.encode(texts[r.doc_id]) and r.round_trip


def test_single_units_as_lattices_have_them(model):
    rnd = random.Random(13)
    names = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 4))) for _ in range(25)} - {"c"})
    table = tuple((p, i + 1, -rnd.random() * 9 - 0.5) for i, p in enumerate(names))
    unigram = S.PieceTable(table, None, 0, merges=False, prefix=False)
    scores = {p: s for p, _, s in table}
    for _ in range(60):
        text = "".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 10)))
        cost = sum(1e6 if i < 0 else -table[i - 1][2] for i in S.UnitEncoder(unigram).ids(text))
        assert cost == pytest.approx(best_paths(text, scores))


@pytest.mark.parametrize("bits", [10, 12])
def test_words_that_rolling_hashes_confuse(spark, model, bits):
    word = "".join("ab"[i.bit_count() % 2] for i in range(1 << bits))
    texts = [word, word.translate(str.maketrans("ab", "ba"))]
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    found = S.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)
    assert {r.doc_id: r.token_ids for r in found.collect()} == {i: library.encode(t) for i, t in enumerate(texts)}


def test_units_that_share_a_hash(spark, model, monkeypatch):
    """As if another unit had the hash of a known one: both are encoded where they stand."""
    known = S.distinct_units
    twin = lambda *args: (lambda d: d.unionByName(d.where("unit = '▁cat'").selectExpr("'▁dog' AS unit", "h", "n")))(known(*args))
    monkeypatch.setattr(S, "distinct_units", twin)
    texts = ["the cat sat", "a cat", "no such word"]
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    found = S.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)
    assert {r.doc_id: r.token_ids for r in found.collect()} == {i: library.encode(t) for i, t in enumerate(texts)}
