"""Encoding by shared chunks against the library on whole texts."""

from __future__ import annotations

import hashlib
import json
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexispan.llm import chunked_bpe
from lexispan.llm.workers import known_to_workers

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
LIBRARY = Tokenizer.from_file(PATH)
DESCRIBED = chunked_bpe.described(PATH)
BPE = chunked_bpe.byte_bpe(DESCRIBED)

ODD = "ab'sdtlvre 09.,(\n\t\r\x0b\x1c\x85\xa0é中、。한ぁ🙂́٣Ⅷß’`_- 　ǅʰ"
TEXTS = st.text(st.sampled_from(ODD) | st.characters(exclude_categories=["Cs"]), max_size=80)


def ids_of(text: str) -> list[int]:
    return LIBRARY.encode(text, add_special_tokens=False).ids


def test_ranks_may_stand_for_merges():
    assert DESCRIBED[1]
    # A token of another split: its parts are not what its bytes are joined to.
    toy = {"model": {"vocab": dict(zip("abc", range(3))) | {"bc": 3, "ab": 4, "abc": 5}, "merges": ["b c", "a b", "ab c"]}}
    assert not chunked_bpe.merges_by_rank(json.dumps(toy))


@pytest.mark.parametrize("by_rank", [True, False])
def test_texts_of_documents(by_rank):
    texts = duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet' WHERE text IS NOT NULL").fetchall()
    bpe = chunked_bpe.ByteBpe(DESCRIBED[0], by_rank)
    assert [i.tolist() for i in bpe.whole([t for (t,) in texts])] == [ids_of(t) for (t,) in texts]


@settings(max_examples=500, deadline=None)
@given(TEXTS)
def test_whole_texts(text):
    assert BPE.whole([text])[0].tolist() == ids_of(text)
    assert BPE.decoded(BPE.whole([text])[0]) == LIBRARY.decode(ids_of(text), skip_special_tokens=False)


@settings(max_examples=800, deadline=None)
@given(st.lists(st.text(st.sampled_from(ODD), min_size=1, max_size=12), max_size=10))
def test_joins_of_any_pieces(pieces):
    encoded = [(np.array(ids_of(p)), False) for p in pieces]
    assert BPE.repaired(encoded).tolist() == ids_of("".join(pieces))


def test_every_pair_of_neighbours_breaks_as_stated():
    for a in ODD:
        for b in ODD:
            if chunked_bpe.FIRST_BREAK.match(a + b, 1):
                for before in ("", "x", "'"):
                    for after in ("", "s", " "):
                        text = before + a + b + after
                        words = [w for w, _ in LIBRARY.pre_tokenizer.pre_tokenize_str(text)]
                        sizes = np.cumsum([len(bytes(chunked_bpe._byte_of_character()[c] for c in w)) for w in words])
                        assert len((before + a).encode()) in sizes, text


def test_long_text_without_breaks():
    random.seed(3)
    text = "".join(random.choice("abcdefg") for _ in range(30_000))
    pieces = [text[i : i + 97] for i in range(0, len(text), 97)]
    assert BPE.repaired([(np.array(ids_of(p)), False) for p in pieces]).tolist() == ids_of(text)


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def expected(doc_id, text: str | None) -> tuple:
    ids = ids_of(text or "")
    return (doc_id, len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False)))


def corpus() -> list[tuple]:
    random.seed(4)
    word = lambda: random.choice(["the", "don't", "12", "été", "中文字", "...", "🙂", "  ", "\n\n", "x" * random.randrange(1, 9)])
    passages = ["".join(word() + random.choice([" ", "", "\n"]) for _ in range(120)) for _ in range(6)]
    texts = []
    for _ in range(60):
        own = " ".join(word() for _ in range(random.randrange(60)))
        texts.append(own[: len(own) // 2] + "".join(random.sample(passages, random.randrange(3))) + own[len(own) // 2 :])
    texts += [texts[0]] * 20 + [None, "", " ", "<|endoftext|>", passages[0] + "<|endoftext|>" + passages[1] + "<|endoftext", "a <|endoftext|><|endoftext|> b"]
    return [(i, t) for i, t in enumerate(texts)] + [(None, texts[1]), (None, None), (3, texts[3]), (3, texts[3])]


@pytest.mark.parametrize("sizes", [(3, 4, 40), (6, 16, 512), (chunked_bpe.CUT_BITS, chunked_bpe.LEAST, chunked_bpe.MOST)])
def test_digests_of_documents(spark, sizes):
    known_to_workers(spark)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = chunked_bpe.codec_digest(docs, PATH, chunk_sizes=sizes)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(str(expected(*r)) for r in rows)


def test_ids_decoding_and_clashing_names(spark):
    known_to_workers(spark)
    rows = [(i, t, i, "x") for i, t in corpus()]
    docs = spark.createDataFrame(rows, "doc_id long, body string, token_ids long, t1 string")
    found = chunked_bpe.decode(chunked_bpe.encode(docs, PATH, "body", (4, 8, 64)), PATH)
    assert found.columns == ["doc_id", "body", "t1", "token_ids", "decoded"]
    for row in found.collect():
        assert row.token_ids == ids_of(row.body or "") and row.decoded == (row.body or "") and row.t1 == "x"
    assert found.count() == len(rows)


def test_empty_table(spark):
    known_to_workers(spark)
    assert chunked_bpe.codec_digest(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_equal_passages_are_cut_alike():
    random.seed(8)
    passage = bytes(random.randrange(97, 123) for _ in range(4000))
    chunks = []
    for before, after in ((b"", b"tail"), (b"some head ", b""), (b"y" * 500, b"z" * 700)):
        text = before + passage + after
        cuts = chunked_bpe.chunk_bounds(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
        assert cuts[0] == 0 and cuts[-1] == len(text) and max(np.diff(cuts)) <= chunked_bpe.MOST
        chunks.append({text[a:b] for a, b in zip(cuts[:-1], cuts[1:])})
    assert chunks[0] & chunks[1] & chunks[2]
