"""Runs of repeated words in texts, by suffix trees and Lyndon roots.

A run is a stretch of words with smallest period q (words q apart are equal)
that no neighbouring word extends. Every run that is at least twice as long as
its period is an extension of a longest Lyndon word, under the order of words or
under its reverse, from some place on. So each text gets

1. Ukkonen's suffix tree of its words, and one of their reversal; a tour of each
   tree, with the depths of the nodes it turns at, answers by range minima how
   far two places agree to the right, or to the left, in constant time;
2. the longest Lyndon word from each place on, under both orders: it ends at the
   next smaller suffix, by the places of suffixes in the tours;
3. both extensions of all these roots at once.

Words that no long run can hold do not enter the trees: with a length of at
least four periods and six words, each three words in a row of a run occur in it
three times. Stretches of words without that are exact to leave out, since a run
lies within one stretch, and so does any word that would extend it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.llm.workers import lean

# What a run needs at least; the choice of stretches relies on these.
LEAST_WORDS, LEAST_PERIODS = 6, 4

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def word_runs(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed``.

    Words are runs of characters other than space, tab and line breaks. ``runs``
    has every run of at least six words and four periods as (number of its first
    word, words, period), by start and period. ``collapsed`` has the words, joined
    by one space, that no run holds after its first period. A null or empty text,
    or one of white space, has no words, no runs and an empty ``collapsed``. Rows
    are treated one by one, so repeated rows stay. Columns of these names are
    replaced. A text is one row and must fit a task: some 200 bytes per word that
    lies in a stretch of words repeating three times.
    """
    added = ["n_words", "runs", "collapsed"]
    kept = docs.drop(*[c for c in added if c != text_column])
    packed = kept.select(F.struct("*").alias("_row"), F.col(text_column).alias("_text"))
    row_type = packed.schema["_row"].dataType.simpleString()

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                counts, runs, collapsed = [], [], []
                for text in part["_text"].cast(pa.binary()).to_pylist():
                    words = text.split() if text else []
                    found = runs_of_words(words)
                    counts.append(len(words))
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                    collapsed.append(b" ".join(without_repeats(words, found)))
                texts = pa.array(collapsed, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([part["_row"], pa.array(counts, pa.int64()), pa.array(runs, run_type), texts], names=["_row", *added])

    found = packed.mapInArrow(lean(find), f"_row {row_type}, n_words bigint, runs {RUNS}, collapsed string")
    names = [c for c in kept.columns if c not in added]
    return found.select(*[F.col(f"_row.`{c}`").alias(c) for c in names], *added)


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def runs_of_words(words: list[bytes]) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs that are long enough, by start and period."""
    if len(words) < LEAST_WORDS:
        return []
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    stretches = repeating_stretches(ids, len(numbers))
    if not stretches:
        return []
    # Stretches in one string, each closed by a symbol of its own; symbols are numbered from 1.
    parts, origins, closing = [], [], len(numbers) + 1
    for begin, stop in stretches:
        parts += [ids[begin:stop] + 1, [closing]]
        origins += [np.arange(begin, stop), [-1]]
        closing += 1
    _, symbols = np.unique(np.concatenate(parts), return_inverse=True)
    origin = np.concatenate(origins)
    runs = long_runs((symbols + 1).tolist())
    return sorted((int(origin[s]), n, q) for s, n, q in runs)


def repeating_stretches(ids: np.ndarray, n_words: int) -> list[tuple[int, int]]:
    """``(begin, stop)`` of the longest stretches whose triples of words all occur three times or more."""
    pairs = ids[:-1] * n_words + ids[1:]
    _, pairs = np.unique(pairs, return_inverse=True)
    triples = pairs[:-1] * n_words + ids[2:]
    _, at, n = np.unique(triples, return_inverse=True, return_counts=True)
    often = np.concatenate([[False], n[at] >= 3, [False]])
    edges = np.flatnonzero(often[1:] != often[:-1])
    begins, stops = edges[::2], edges[1::2]
    long = stops - begins >= LEAST_WORDS - 2
    return [(int(a), int(b) + 2) for a, b in zip(begins[long], stops[long])]


def long_runs(symbols: list[int]) -> set[tuple[int, int, int]]:
    """Runs of a string of numbers from 1 on that are long enough."""
    n = len(symbols)
    right = Agreement([*symbols, 0])
    left = Agreement([*symbols[::-1], 0])
    places = np.arange(n)
    runs: set[tuple[int, int, int]] = set()
    for order in (right.rank, right.reverse_rank()):
        ends = next_smaller(order[:n].tolist())
        period = ends - places
        to_right = right.common(places, ends)
        # What stands before both places, read backwards: place p - 1 is n - p in the reversal.
        to_left = left.common(n - places, n - ends)
        length = to_left + period + to_right
        good = (length >= LEAST_PERIODS * period) & (length >= LEAST_WORDS)
        runs.update(zip((places - to_left)[good].tolist(), length[good].tolist(), period[good].tolist()))
    return runs


def next_smaller(values: list[int]) -> np.ndarray:
    """For each place the next one with a smaller value, or the end."""
    out = [len(values)] * len(values)
    waiting: list[int] = []
    for i, value in enumerate(values):
        while waiting and values[waiting[-1]] > value:
            out[waiting.pop()] = i
        waiting.append(i)
    return np.array(out, np.int64)


def suffix_tree(s: list[int]) -> tuple[list[int], list[int], dict[int, int], int]:
    """Ukkonen's tree of ``s``, whose last symbol is its only 0.

    ``(start, stop)`` of the edge into each node (node 0 is the root), and the
    child of a node by ``node * base + first symbol``, with that base.
    """
    n, base = len(s), max(s) + 1
    start, stop, link = [0], [0], [0]
    child_of: dict[int, int] = {}
    node = edge = depth = waiting = 0
    for i, c in enumerate(s):
        waiting += 1
        fresh = 0
        while waiting:
            if not depth:
                edge = i
            key = node * base + s[edge]
            child = child_of.get(key)
            if child is None:
                child_of[key] = len(start)
                start.append(i)
                stop.append(n)
                link.append(0)
                if fresh:
                    link[fresh] = node
                    fresh = 0
            else:
                begin = start[child]
                size = min(stop[child], i + 1) - begin
                if depth >= size:
                    node, edge, depth = child, edge + size, depth - size
                    continue
                if s[begin + depth] == c:
                    depth += 1
                    if fresh:
                        link[fresh] = node
                    break
                inner = len(start)
                start += [begin, i]
                stop += [begin + depth, n]
                link += [0, 0]
                start[child] = begin + depth
                child_of[key] = inner
                child_of[inner * base + c] = inner + 1
                child_of[inner * base + s[begin + depth]] = child
                if fresh:
                    link[fresh] = inner
                fresh = inner
            waiting -= 1
            if node:
                node = link[node]
            elif depth:
                depth -= 1
                edge = i - waiting + 1
    return start, stop, child_of, base


class Agreement:
    """How far two suffixes of a string agree, from a tour of its suffix tree.

    Between two leaves the tour turns at their lowest common ancestor. Of each
    turn only the depth of its highest node is kept, and least depths over
    ranges of turns whose sizes are powers of two.
    """

    def __init__(self, s: list[int]) -> None:
        self.start, self.stop, child_of, self.base = suffix_tree(s)
        keys = np.fromiter(child_of.keys(), np.int64, len(child_of))
        children = np.fromiter(child_of.values(), np.int64, len(child_of))
        by_key = np.argsort(keys)
        self.children = children[by_key].tolist()
        self.symbols = (keys[by_key] % self.base).tolist()
        self.first = np.searchsorted(keys[by_key] // self.base, np.arange(len(self.start) + 1)).tolist()
        self.n = len(s)
        leaves, turns = self._tour()
        self.rank = np.empty(self.n, np.int64)
        self.rank[leaves] = np.arange(self.n)
        self.least = [np.array(turns, np.int32)]
        while 2 << (len(self.least) - 1) <= self.n:
            last, step = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(last[:-step], last[step:]))

    def _tour(self) -> tuple[list[int], list[int]]:
        """Suffixes in order of their leaves, and before each the depth of the turn."""
        start, stop, first, children = self.start, self.stop, self.first, self.children
        leaves, turns = [], []
        waiting, above, turned = [0], [0], 0
        after_leaf = True
        while waiting:
            node, upper = waiting.pop(), above.pop()
            if after_leaf:
                turned, after_leaf = upper, False
            depth = upper + stop[node] - start[node]
            a, b = first[node], first[node + 1]
            if a == b:
                leaves.append(self.n - depth)
                turns.append(turned)
                after_leaf = True
            else:
                waiting += children[a:b][::-1]
                above += [depth] * (b - a)
        return leaves, turns

    def reverse_rank(self) -> np.ndarray:
        """Places of the suffixes if symbols are ordered the other way round; a suffix still follows its own beginnings."""
        start, stop, first, children, symbols = self.start, self.stop, self.first, self.children, self.symbols
        rank = np.empty(self.n, np.int64)
        waiting, above, seen = [0], [0], 0
        while waiting:
            node, upper = waiting.pop(), above.pop()
            depth = upper + stop[node] - start[node]
            a, b = first[node], first[node + 1]
            if a == b:
                rank[self.n - depth] = seen
                seen += 1
            else:
                ends = symbols[a] == 0
                waiting += children[a + ends : b]
                waiting += children[a : a + ends]
                above += [depth] * (b - a)
        return rank

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Symbols that the suffixes from the different places ``a`` and ``b`` on have in common."""
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for i in range(len(self.least)):
            here = np.flatnonzero(level == i)
            if len(here):
                least = self.least[i]
                out[here] = np.minimum(least[low[here]], least[high[here] - (1 << i)])
        return out


# -- texts with a planted period ----------------------------------------------


def with_planted_period(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with a repeating end in every tenth text, by the checksum of its id; other rows stay as they are.

    With h = crc32 of the id in decimal, g = h / 10 and n words, a text with
    h % 10 = 0 gets from word a = g % n on the word a + (i - a) % p for word i,
    where p = 1 + (n - a) / (3 + g % 8), all in whole numbers; its words are then
    joined by spaces. A null id, null text or text without words is not changed.
    """
    rest = [c for c in docs.columns if c != text_column]
    others = F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row")
    packed = docs.select(others, F.col(text_column).alias("_text"), F.crc32(F.col(id_column).cast("string")).alias("_h"))
    g = F.floor(F.col("_h") / 10)
    words = F.filter(F.split("_text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    chosen = packed.withColumn("_words", F.when(F.col("_h") % 10 == 0, words)).withColumn("_n", F.size("_words").cast("long"))
    chosen = chosen.withColumn("_a", F.when(F.col("_n") > 0, g % F.col("_n")))
    chosen = chosen.withColumn("_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + g % 8)))
    places = F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)
    edited = F.transform(places, lambda i: F.element_at("_words", _place(i).cast("int") + 1))
    replaced = F.when(F.col("_n") > 0, F.array_join(edited, " ")).otherwise(F.col("_text"))
    return chosen.select(*[(replaced if c == text_column else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def _place(i: Column) -> Column:
    a, p = F.col("_a"), F.col("_p")
    return F.when(i < a, i).otherwise(a + (i - a) % p)


def run_digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: its id, how many runs, the longest run (of equal ones the first, then of least period), and digests.

    ``runs_sha256`` is of a line "start,length,period" per run, ``collapsed_sha256`` of the words that are kept.
    """
    found = word_runs(docs.select(id_column, F.col(text_column).alias("_text_")), "_text_")
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("minus"), r["start"].alias("start"), r["period"].alias("period"))))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    length = -F.col("_longest.minus")
    return found.withColumn("_longest", longest).select(
        id_column, F.size("runs").cast("long").alias("n_runs"), F.col("_longest.start").alias("start"), length.alias("length"),
        F.col("_longest.period").alias("period"), F.floor(length * 1000 / F.col("_longest.period")).alias("exponent_milli"),
        F.sha2(F.encode(lines, "utf-8"), 256).alias("runs_sha256"), F.sha2(F.encode("collapsed", "utf-8"), 256).alias("collapsed_sha256"),
    )
