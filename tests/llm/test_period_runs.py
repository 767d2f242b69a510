"""Runs of repeated words against a search of every period."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from lexispan.llm import period_runs
from lexispan.llm.workers import known_to_workers


def brute_runs(words: list) -> list[tuple[int, int, int]]:
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            stop = i
            while stop + q < n and words[stop] == words[stop + q]:
                stop += 1
            found.append((i, stop + q - i, q))
            i = stop + 1
    smallest = {}
    for s, length, q in sorted(found, key=lambda r: r[2]):
        if length >= 2 * q and any(s >= a and s + length <= a + b and q % p == 0 for a, b, p in smallest):
            continue
        smallest[s, length, q] = None
    return sorted(r for r in smallest if r[1] >= max(6, 4 * r[2]))


def brute_collapsed(words: list, runs: list) -> list:
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60))
def test_runs_of_random_words(letters):
    words = [w.encode() for w in letters]
    assert period_runs.runs_of_words(words) == brute_runs(words)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abcde"), min_size=1, max_size=6), st.integers(1, 9)), max_size=8))
def test_runs_of_repeated_phrases(phrases):
    words = [w.encode() for phrase, n in phrases for w in phrase * n]
    assert period_runs.runs_of_words(words) == brute_runs(words)


def test_trees_without_choice_of_stretches():
    random.seed(5)
    for size in (1, 2, 7, 40, 120):
        letters = [random.randrange(1, 4) for _ in range(size)]
        assert sorted(period_runs.long_runs(letters)) == brute_runs(letters)


def test_agreement_equals_comparing():
    random.seed(6)
    s = [random.randrange(1, 3) for _ in range(80)] + [0]
    agreement = period_runs.Agreement(s)
    for _ in range(300):
        a, b = random.sample(range(len(s)), 2)
        n = 0
        while max(a, b) + n < len(s) and s[a + n] == s[b + n]:
            n += 1
        assert agreement.common([a], [b])[0] == n
    suffixes = sorted(range(len(s)), key=lambda i: s[i:])
    assert [int(agreement.rank[i]) for i in suffixes] == list(range(len(s)))
    backwards = sorted(range(len(s)), key=lambda i: [-x if x else -9 for x in s[i:]])
    assert [int(agreement.reverse_rank()[i]) for i in backwards] == list(range(len(s)))


def expected(doc_id, text: str | None) -> tuple:
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    h, n = (zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    shown = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *shown, sha("".join(f"{s},{m},{q}\n" for s, m, q in sorted(runs, key=lambda r: (r[0], r[2])))), sha(" ".join(brute_collapsed(words, runs))))


def test_digests_of_documents(spark):
    known_to_workers(spark)
    random.seed(7)
    tenth = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    texts = [" ".join(random.choice("uvwxyz") for _ in range(random.randrange(90))) for _ in tenth]
    rows = list(zip(tenth, texts))
    odd = ["", None, " \t\n ", "ha " * 50, "\x0bx y\x0cx y\rx y x y x y z", "é è " * 9, "a b c d e f g", "no no no no no no no"]
    rows += [(1000 + i, t) for i, t in enumerate(odd)] + [(None, "la la la la la la"), (None, None), (2, "x " * 7), (2, "x " * 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = period_runs.run_digests(period_runs.with_planted_period(docs))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(str(expected(*r)) for r in rows)


def test_empty_table_and_clashing_names(spark):
    known_to_workers(spark)
    assert period_runs.run_digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(1, "a a a a a a b", "old", 3)], "doc_id long, runs string, collapsed string, `_n` int")
    row = period_runs.word_runs(period_runs.with_planted_period(docs, text_column="runs"), "runs").first()
    assert (row.doc_id, row.n_words, row.collapsed, row._n) == (1, 7, "a b", 3) and [tuple(r) for r in row.runs] == [(0, 6, 1)]


@pytest.mark.parametrize("period", [1, 7, 900])
def test_very_long_text(period):
    words = [b"%d" % (i % period) for i in range(60_000)] + [b"end"]
    assert period_runs.runs_of_words(words) == [(0, 60_000, period)]
