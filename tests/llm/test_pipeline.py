import random
import sys
from collections import Counter
from pathlib import Path

import pytest
import public_tokenizers
import sentencepiece

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from tests.llm.test_near_dedup import brute as near_groups  # noqa: E402
from tests.llm.test_suffix_dedup import LENGTH  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed=2):
    rnd = random.Random(seed)
    vocabulary = {"en": [f"the{c}ing{d}" for c in "abcdefghij" for d in "klmnop"], "de": [f"ung{c}schö{d}" for c in "abcdefghij" for d in "klmnop"]}
    passage = " ".join(rnd.choice(vocabulary["en"]) for _ in range(30))
    rows = []
    for i in range(160):
        lang = "en" if i % 3 else "de"
        words = [rnd.choice(vocabulary[lang]) for _ in range(rnd.randrange(20, 90))]
        text = " ".join(words)
        if i % 10 == 4:
            text = rows[-3][1]
        elif i % 10 == 7:
            text = rows[-2][1] + " more"
        elif i % 10 == 9:
            text = text + " " + passage + " " + " ".join(words[:2])
        rows.append((i, text, lang if i % 4 else None, ["a", "b", None][i % 3], len(text)))
    return rows + [(1000, "12 34 -- !!", "en", "a", 11), (1001, None, "en", "a", 0), (1002, "", None, "b", 0)]


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first stage and after each."""
    docs = spark.createDataFrame(corpus(), SCHEMA).repartition(4)
    found = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialized(stage(spark, docs, ""))
        found.append(docs.collect())
    return found


def test_stage_order_and_columns(spark, stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "minhash_near_dedup", "suffix_array_dedup", "mixing_sources", "sentencepiece"]
    for rows in stages[:-1]:
        assert rows and list(rows[0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_rejects_only_what_has_no_language(stages):
    assert {r.doc_id for r in stages[0]} - {r.doc_id for r in stages[1]} == {1000, 1001, 1002}


def test_keeps_one_of_each_group(stages):
    groups = near_groups([(r.doc_id, r.text) for r in stages[1]], 5)
    assert {r.doc_id for r in stages[2]} == {i for i, (_, _, kept) in groups.items() if kept}
    assert len(stages[2]) < len(stages[1])


def test_cuts_what_was_there_before(stages):
    seen, expected = set(), {}
    for r in sorted(stages[2], key=lambda r: r.doc_id):
        data = r.text.encode()
        gone = bytearray(len(data))
        for i in range(len(data) - LENGTH + 1):
            if data[i : i + LENGTH] in seen:
                gone[i : i + LENGTH] = b"\1" * LENGTH
            seen.add(data[i : i + LENGTH])
        # A character of which any byte stays is whole.
        text, at = "", 0
        for char in r.text:
            size = len(char.encode())
            text += "" if all(gone[at : at + size]) else char
            at += size
        expected[r.doc_id] = text
    assert {r.doc_id: r.text for r in stages[3]} == expected
    assert any(r.text != expected[r.doc_id] for r in stages[2])


def test_mixes_to_the_targets(stages):
    before = {r.doc_id: r for r in stages[3]}
    times = Counter(r.doc_id for r in stages[4])
    assert max(times.values()) <= 2 and all(before[r.doc_id].text == r.text for r in stages[4])
    words = Counter()
    for r in stages[3]:
        words[r.source] += len(r.text.split())
    mixed = Counter()
    for r in stages[4]:
        mixed[r.source] += len(r.text.split())
    weights = {"a": 5, "b": 2, None: 1}
    targets, open_, left = {}, dict(weights), 1.5 * sum(words.values())
    while open_:
        level = left / sum(open_.values())
        full = [s for s in open_ if 2 * words[s] <= level * open_[s]]
        if not full:
            targets |= {s: level * w for s, w in open_.items()}
            break
        for s in full:
            targets[s] = 2 * words[s]
            left -= targets[s]
            del open_[s]
    for source, target in targets.items():
        assert abs(mixed[source] - target) <= 0.25 * target


def test_ids_are_those_of_the_library(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    texts = {r.doc_id: r.text for r in stages[4]}
    assert Counter(r.doc_id for r in stages[4]) == Counter(r.doc_id for r in stages[5])
    for r in stages[5]:
        assert r.token_ids == library.encode(texts[r.doc_id]) and r.n_tokens == len(r.token_ids) and r.round_trip


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialized(stage(spark, docs, ""))
    assert docs.collect() == []


def test_labels_that_are_missing_or_odd(spark):
    """Without labels all texts with letters stay; a label that says "und" is one like any other."""
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    rows = [(i, text, None, "a", 0) for i, text in enumerate(["some words", "日本語", "12 34", None, "", "x"])]
    assert {r.doc_id for r in stage(spark, spark.createDataFrame(rows, SCHEMA), "").collect()} == {0, 1, 5}
    rows = [(i, text, "und", "a", 0) for i, (_, text, *_) in enumerate(rows)]
    assert {r.doc_id for r in stage(spark, spark.createDataFrame(rows, SCHEMA), "").collect()} == {0, 1, 5}
    # The only label is on a row that op5 would hold out.
    rows = [(2, "das ist gut", "de", "a", 0), (3, "und das", None, "a", 0)]
    assert {r.doc_id for r in stage(spark, spark.createDataFrame(rows, SCHEMA), "").collect()} == {2, 3}


def test_odd_ids_and_clashing_names(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(None, text, "en", "a", 1, "t", 5, "g"), (7, text, "en", "a", 1, "u", 6, "h"), (7, text, "en", "a", 1, "u", 6, "h"), (8, text + " x", None, None, 1, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA + ", token_ids string, copies int, _gone string")
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialized(stage(spark, docs, ""))
        sizes.append(docs.count())
        if name != "sentencepiece":
            assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    # A null id is nobody's copy; rows of one id are one document; the rest are its copies.
    assert sizes[:3] == [4, 3, 3] and docs.columns == ["doc_id", "lang", "source", "token_ids", "n_tokens", "round_trip"]
