import random
import unicodedata

import pytest
from pyspark.sql import functions as F

import brute
from lexispan.functions import display, text
from lexispan.functions.stopwords import BROWSER_STOPWORDS, CORE_STOPWORDS
from lexispan.operators.lines import document_lines, line_universe
from lexispan.operators.postings import (
    document_index, drop_stopwords, line_postings, line_tokens, master_index, term_frequencies, term_totals,
)


def column(spark, values, expr):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").select("i", expr(F.col("v")).alias("r"))
    return [r.r for r in sorted(df.collect(), key=lambda r: r.i)]


def docs(spark, mapping):
    return spark.createDataFrame(list(mapping.items()), "doc_id string, text string")


def test_stopword_lists():
    assert len(set(CORE_STOPWORDS)) == 178 and len(set(BROWSER_STOPWORDS)) == 56
    assert set(BROWSER_STOPWORDS) < set(CORE_STOPWORDS)


def test_tokens_fold_completely(spark):
    values = ["Straße ﬁne ſo \u212A", "café", "Abe, Lincoln", "Abe-Lincoln", "foo_bar", "대한민국 헌법", "ᄒ가x", "İstanbul ŉa", ""]
    assert column(spark, values, text.tokens) == [brute.words_of(v) for v in values]
    assert column(spark, values, text.tokens)[0] == ["strasse", "fine", "so", "k"]
    assert column(spark, ["Straße CAFÉ"], lambda c: text.tokens(c, "lower")) == [["stra", "e", "caf"]]


def test_tokens_of_every_character(spark):
    values = [f"x{chr(c)}y" for c in range(1, 0x3000) if chr(c) not in "\r\n"] + [f"x{chr(c)}y" for c in range(0xA640, 0xD7FF, 7)]
    values += [f"x{chr(c)}y" for c in range(0xF900, 0xFFFE)]
    assert column(spark, values, text.tokens) == [brute.words_of(v) for v in values]


def test_normalize(spark):
    values = ["A--b\tÇ c", "x\u00a0Y\u3000é\x1f!"]
    assert column(spark, values, text.normalize) == ["a b\t  c", "x\u00a0y\u3000 \x1f "]


def test_fold_name_is_a_complete_casefold(spark):
    values = ["ΣΊΣΥΦΟΣ", "ς", "Maße", "ᾳ", "ﬀ", "ꭰ", "B.txt", "a.txt"]
    codes = (*range(1, 0x2FFF), *range(0xA640, 0xAC00), *range(0xF900, 0xFFFE), *range(0x10400, 0x1E944))
    # Spark's Unicode tables may be newer than Python's.
    values += [f"x{chr(c)}y" for c in codes if unicodedata.category(chr(c)) != "Cn"]
    assert column(spark, values, text.fold_name) == [v.casefold() for v in values]


@pytest.mark.parametrize("value", ["", "\n", "a\n\n", "a\r\nb\rc", "a\u2028b", "a\x1cb\x1d\x1ec\x85\x0bd\x0c", "\r\n\r\n", "a\n\r", "x"])
def test_line_split(spark, value):
    expected = value.replace("\r\n", "\n").replace("\r", "\n").splitlines()
    assert column(spark, [value], text.split_lines) == [expected]
    assert brute.lines_of(value) == expected


def test_browser_line_split(spark):
    got = column(spark, ["\uFEFFa\r\nb\n", "a\rb", ""], lambda c: text.split_lines(c, "browser"))
    assert got == [["a", "b", ""], ["a\rb"], [""]]


def test_unknown_modes_are_refused():
    with pytest.raises(ValueError):
        text.split_lines(F.lit(""), "other")
    with pytest.raises(ValueError):
        text.folded(F.lit(""), "other")


def test_document_key(spark):
    import hashlib

    assert column(spark, ["a/b.txt"], text.document_key) == [hashlib.sha256(b"a/b.txt").hexdigest()[:16]]


START = "*** START of the PROJECT GUTENBERG EBOOK X ***"
END = "*** END OF THE PROJECT GUTENBERG EBOOK X ***"


def test_body_range(spark):
    corpus = {
        "body": f"h\n{START}\nb1\n\nb2\n{END}\nf",
        "adjacent": f"h\n{START}\n{END}\nf",
        "reversed": f"h\n{END}\nb\n{START}\nf",
        "open": f"h\n{START}\nb",
        "again": f"{START}\nb\n{START}\nc\n{END}\nd\n{END}",
        "kelvin": f"{START.replace('K', chr(0x212A))}\nb\n{END}",
    }
    lines = document_lines(docs(spark, corpus))
    got = {}
    for r in line_universe(lines).collect():
        got.setdefault(r.doc_id, []).append(r.line_no)
    assert {k: sorted(v) for k, v in got.items()} == {
        "body": [3, 4, 5], "reversed": [1, 2, 3, 4, 5], "open": [1, 2, 3], "again": [2, 3, 4], "kelvin": [2],
    }
    assert lines.count() == sum(len(brute.lines_of(t)) for t in corpus.values())


def test_positions_count_stopwords(spark):
    lines = document_lines(docs(spark, {"d": "Abe was Lincoln"}))
    assert {(r.term, r.pos) for r in line_tokens(lines).collect()} == {("abe", 0), ("was", 1), ("lincoln", 2)}
    kept = {("abe", 0), ("lincoln", 2)}
    assert {(r.term, r.pos) for r in line_postings(lines).collect()} == kept
    listed = spark.createDataFrame([("was",)], "term string")
    assert {(r.term, r.pos) for r in drop_stopwords(line_tokens(lines), listed).collect()} == kept


def test_index_shapes(spark):
    postings = line_postings(document_lines(docs(spark, {"a": "red blue red\nred", "b": "blue"})))
    assert {tuple(r) for r in term_frequencies(postings).collect()} == {("a", "red", 3), ("a", "blue", 1), ("b", "blue", 1)}
    nested = document_index(postings)
    entries = {(r.doc_id, r.term): [tuple(e) for e in r.entries] for r in nested.collect()}
    assert entries["a", "red"] == [(1, 0), (1, 2), (2, 0)]
    assert sorted(master_index(nested).collect()) == sorted(postings.collect())
    assert {tuple(r) for r in term_totals(postings).collect()} == {("red", 3, 1), ("blue", 2, 2)}


def test_random_lines_match_plain_python(spark):
    rng = random.Random(7)
    alphabet = ["a", "B", "ß", "ﬁ", "é", "가", "9", " ", "-", "\n", "\r", "\r\n", "\u2028", "\x85", "was", "Lincoln "]
    corpus = {f"d{i}": "".join(rng.choices(alphabet, k=rng.randrange(30))) for i in range(200)}
    lines = document_lines(docs(spark, corpus))
    got = {(r.doc_id, r.line_no): r.line for r in lines.collect()}
    assert got == {(d, i): line for d, t in corpus.items() for i, line in enumerate(brute.lines_of(t), 1)}
    expected = {s[:3] + (w,) for w, spans in brute.Corpus(corpus).spans.items() for s in spans}
    assert {(r.doc_id, r.line_no, r.pos, r.term) for r in line_postings(lines).collect()} == expected


def test_documents_to_postings_without_shuffle(spark):
    lines = document_lines(docs(spark, {"a": "x"}))
    plan = line_postings(lines)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_display(spark):
    marks = lambda words: lambda c: display.highlight(c, words)
    assert column(spark, ["Abe's abel ABE-x abe"], marks(["abe"])) == [
        "<mark>Abe</mark>'s abel <mark>ABE</mark>-x <mark>abe</mark>"
    ]
    assert column(spark, ["red red blue"], marks(["red", "blue"])) == [
        "<mark>red</mark> <mark>red</mark> <mark>blue</mark>"
    ]
    assert column(spark, ["café ſ s"], marks(["café", "s"])) == ["café ſ <mark>s</mark>"]
    assert column(spark, ["a b"], marks([])) == ["a b"]
    dollars = lambda c: display.highlight(c, ["a"], "$1", "\\")
    assert column(spark, ["a b"], dollars) == ["$1a\\ b"]
    labels = lambda n: lambda c: display.count_label(c, F.lit(n))
    assert column(spark, ["w"], labels(1)) == ["w: 1 occurrence"]
    assert column(spark, ["w"], labels(0)) == ["w: 0 occurrences"]
