import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexispan.llm import token_files
from lexispan.llm.idcoder import LARGEST_ID, CorruptBlock, decode_block, encode_block
from lexispan.llm.token_files import id_digests, read_ids, word_tokenizer, write_ids

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
ODD = ["", " ", "it's a dog's 3rd", "a  b", "café É", " ́x", "ΣΑΣ σας", "<|endoftext|> x<|startoftext|>", "漢字 文1", "a\n\tb\r\n", "x" * 300, "İstanbul ß"]


@pytest.mark.parametrize("n", [0, 1, 2, 127, 128, 129, 1000, 20_000])
@pytest.mark.parametrize("kind", ["few", "spread", "one", "large"])
def test_blocks_round_trip(n, kind):
    rnd = np.random.default_rng(n)
    ids = {
        "few": rnd.integers(0, 5, n), "spread": rnd.integers(0, 49_000, n), "one": np.full(n, 7),
        "large": rnd.integers(LARGEST_ID - 50, LARGEST_ID + 1, n),
    }[kind]
    assert (decode_block(encode_block(ids)) == ids).all()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 9), st.integers(0, 60_000)), max_size=700))
def test_any_ids_round_trip(ids):
    assert decode_block(encode_block(np.array(ids, np.int64))).tolist() == ids


def test_repetition_is_learned_and_damage_is_noticed():
    ids = np.tile(np.random.default_rng(1).integers(0, 40_000, 500), 100)
    data = encode_block(ids)
    assert len(data) < 0.25 * 2 * len(ids)
    for at in (0, 5, 30, len(data) - 1):
        with pytest.raises(CorruptBlock):
            decode_block(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])
    with pytest.raises(ValueError):
        encode_block(np.array([LARGEST_ID + 1]))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_words_are_tokenised_as_in_their_texts(texts):
    own = word_tokenizer(open(PATH, encoding="utf-8").read())
    texts = texts + ODD
    plain = Tokenizer.from_file(PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


MIXED = st.text(
    st.one_of(
        st.sampled_from("a Z é É ß ÿ × ÷ Þ 0 9 . , - | _ < > ' s ¿ » ª µ ² \u00a0 \u0085 \u00ad \u0301 İ Σ — 漢 \t \n \x0b \x1c \x7f".split(" ") + [" "]),
        st.characters(max_codepoint=0x17F, codec="utf-8"),
    ),
    max_size=60,
)


@settings(max_examples=200, deadline=None)
@given(st.lists(MIXED, min_size=1, max_size=8))
def test_pieces_are_cut_as_the_rules_cut_them(texts):
    own = word_tokenizer(open(PATH, encoding="utf-8").read())
    plain = Tokenizer.from_file(PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("at_once", [1, 50, 1 << 22])
def test_every_character_below_1000_among_others(monkeypatch, at_once):
    monkeypatch.setattr(token_files, "BYTES_TOGETHER", at_once)
    texts = [t for c in map(chr, range(1000)) for t in (c, f"Ab{c}Cd {c}1{c} é{c}E. {c}{c}")]
    own = token_files.WordTokenizer(open(PATH, encoding="utf-8").read())
    plain = Tokenizer.from_file(PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_that_differ_in_case_and_marks_are_tokenised_once():
    own = token_files.WordTokenizer(open(PATH, encoding="utf-8").read())
    marks = ["", ".", ",", "!", "?", ";", ":", ")", "...", "!!"]
    own.encode([f"{a}{word}{b}" for word in ("unionlang", "Unionlang", "UNIONLANG") for a in marks for b in marks])
    assert len(own.known) == len(marks)


def test_forgotten_and_long_pieces(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 20)
    own = token_files.WordTokenizer(open(PATH, encoding="utf-8").read())
    plain = Tokenizer.from_file(PATH)
    for i in range(6):
        texts = [f"word{'abcdef'[i]}{chr(97 + j)} {'y' * 70} {i * j}" for j in range(15)]
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert "y" * 70 not in own.known and len(own.known) <= 20 + 15 + 10


def test_rules_that_are_not_known_go_through_the_library():
    description = json.loads(open(PATH, encoding="utf-8").read())
    description["normalizer"]["normalizers"].pop()
    own = token_files.WordTokenizer(json.dumps(description))
    plain = Tokenizer.from_str(json.dumps(description))
    texts = [*ODD, "It's NOT lower-cased, Ünder 12 rules."]
    assert own.letters is None
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("block_ids", [1 << 20, 50])
def test_files_against_direct_encoding(spark, tmp_path, monkeypatch, block_ids):
    monkeypatch.setattr(token_files, "BLOCK_IDS", block_ids)
    rows = [(i * 3 - 50, f"{t} document {i} " * (i % 9)) for i, t in enumerate(ODD * 8)] + [(9999, None), (None, "null id"), (5000, "twice"), (5000, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS part").repartition(5)
    write_ids(docs, str(tmp_path / "ids"), PATH, 2)
    found = id_digests(spark, str(tmp_path / "ids")).collect()
    plain = Tokenizer.from_file(PATH)
    expected = {}
    for name, text in rows:
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        expected.setdefault(name, []).append((len(ids), zlib.crc32(ids.tobytes())))
    got = {}
    for r in found:
        got.setdefault(r.id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}
    start = 0
    for r in sorted(found, key=lambda r: (r.id is not None, r.id or 0, r.start)):
        assert r.start == start
        start += r.n_tokens
    assert read_ids(spark, str(tmp_path / "ids")).where("size(token_ids) = 0").count() == 0


def test_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    write_ids(docs, str(tmp_path / "ids"), PATH, 2)
    assert id_digests(spark, str(tmp_path / "ids")).collect() == []
