"""Boolean and phrase search over the line and posting tables.

A :class:`Searcher` hands out :class:`Hits`: matching lines plus the spans
(first and last word position) of every occurrence. Hits are composed with
``adjacent``, ``any_of``, ``none_of`` and ``both_lines``; nothing runs until a
DataFrame of the final result is used.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce
from itertools import product
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.operators.keys import fits, is_small, measures
from lexispan.sources.workspace import materialized

LINE_KEY = ["doc_id", "line_no"]
SPAN = ["doc_id", "line_no", "start_pos", "end_pos"]

# Where a stored index keeps a document's lines: columns of its postings, folders of its lines.
PLACE = ["run", "part"]

# Per slot of a phrase the words that may fill it.
Pattern = tuple[tuple[str, ...], ...]

# So many times more postings than those of its rarest word must a phrase have to look them up first.
WORTH = 4

# So many rows a task groups, where their number is known: with keys some hundred MB.
GROUPED_ROWS = 1_000_000

# Longest phrase matched by one grouping: slots are bits of a BIGINT.
MAX_SLOTS = 62


def line_key(df: DataFrame) -> list[str]:
    """What tells lines apart, and in a stored index also where they are."""
    return [*(c for c in PLACE if c in df.columns), *LINE_KEY]


def distinct_lines(df: DataFrame) -> DataFrame:
    return df.select(*line_key(df)).distinct()


def apart(rows: DataFrame, key: list[str], n: int) -> DataFrame:
    """``n`` rows to be grouped by ``key``, over as many tasks as that takes.

    Most groups are single rows, so grouping them before they are moved would
    save little and hold all rows of a task, which are many for a common word.
    """
    return rows.repartition(1 + n // GROUPED_ROWS, *key) if n > GROUPED_ROWS else rows


class LineSet:
    """Line keys, held as ``keys`` or as everything in the corpus but ``keys``.

    Excluding is kept symbolic, so ``a and not b`` subtracts b's lines from a's
    and only a search whose answer really is "all lines but ..." reads them all.
    """

    def __init__(self, keys: DataFrame, excluded: bool = False) -> None:
        self.keys = keys
        self.excluded = excluded

    def complement(self) -> LineSet:
        return LineSet(self.keys, not self.excluded)

    def intersect(self, other: LineSet) -> LineSet:
        if self.excluded and other.excluded:
            return LineSet(_union(self.keys, other.keys), excluded=True)
        if self.excluded:
            return other.intersect(self)
        how = "left_anti" if other.excluded else "left_semi"
        return LineSet(self.keys.join(other.keys, line_key(self.keys), how))

    def union(self, other: LineSet) -> LineSet:
        if not self.excluded and not other.excluded:
            return LineSet(_union(self.keys, other.keys))
        return self.complement().intersect(other.complement()).complement()

    def restrict(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` that lie on lines of this set."""
        return df.join(self.keys, line_key(self.keys), "left_anti" if self.excluded else "left_semi")

    def restrict_table(self, lines: DataFrame) -> DataFrame:
        """Like ``restrict``, for the (large) line table.

        Measuring the keys first keeps a selective search from shuffling the
        text of the whole corpus, and from opening parts of a stored index that
        have no line of it. A broad one joins by a shuffle, if possible of the
        documents with a hit only.
        """
        placed = line_key(self.keys) != LINE_KEY and not self.excluded
        # One place per part of the index at most.
        places = [F.collect_set(F.struct(*PLACE)).alias("places")] if placed else []
        found = self.keys.agg(*measures(self.keys), *places).first()
        if fits(found):
            if placed:
                lines = lines.where(_at(found["places"]))
            return LineSet(F.broadcast(self.keys), self.excluded).restrict(lines)
        if not self.excluded:
            documents = self.keys.select("doc_id").distinct()
            if is_small(documents):
                lines = lines.join(F.broadcast(documents), "doc_id", "left_semi")
        return self.restrict(lines)


def _union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def _at(places) -> Column:
    """Rows of these parts; a condition on folders alone."""
    parts: dict[int, list[int]] = {}
    for run, part in places:
        parts.setdefault(run, []).append(part)
    return reduce(or_, [(F.col("run") == r) & F.col("part").isin(sorted(p)) for r, p in sorted(parts.items())], F.lit(False))


class Hits:
    """One search result. ``lines`` and ``spans`` are DataFrames, built on first use."""

    def __init__(
        self,
        searcher: Searcher,
        spans: Callable[[], DataFrame],
        line_set: Callable[[], LineSet],
        *,
        words: tuple[str, ...],
        lengths: frozenset[int],
        alternatives: Callable[[], tuple[tuple[str, ...], ...]],
        phrases: Callable[[], tuple[tuple[str, ...], ...]],
        patterns: tuple[Pattern, ...],
        phrase_patterns: tuple[Pattern, ...],
        again: Callable[[Searcher], Hits],
        has_not: bool = False,
        slots: tuple[frozenset[str], ...] | None = None,
    ) -> None:
        self.searcher = searcher
        #: the same search by another searcher
        self.on = again
        self._spans = spans
        self._line_set = line_set
        self._alternatives = alternatives
        self._phrases = phrases
        #: the same as ``alternatives`` and ``phrases``, but words that may stand for each other are not multiplied out
        self.patterns = tuple(dict.fromkeys(patterns))
        self.phrase_patterns = tuple(dict.fromkeys(phrase_patterns))
        #: query words in order of first mention
        self.words = tuple(dict.fromkeys(words))
        #: how many words a span can have
        self.lengths = lengths
        #: is anything excluded, anywhere inside?
        self.has_not = has_not
        #: for "one of these words, then one of those ...": the word sets in order
        self.slots = slots

    @cached_property
    def alternatives(self) -> tuple[tuple[str, ...], ...]:
        """The exact phrases this search could stand for; excluded parts have none."""
        return self._alternatives()

    @cached_property
    def phrases(self) -> tuple[tuple[str, ...], ...]:
        """Alternatives of every adjacency inside, inner ones first."""
        return tuple(dict.fromkeys(self._phrases()))

    def may_share_spans(self, other: Hits) -> bool:
        """Could a span be found by both? A place holds one word, so not by searches without a common word."""
        return bool(self.lengths & other.lengths and set(self.words) & set(other.words))

    @cached_property
    def spans(self) -> DataFrame:
        """``(doc_id, line_no, start_pos, end_pos)``, each occurrence once."""
        return self.placed_spans.select(*SPAN)

    @cached_property
    def placed_spans(self) -> DataFrame:
        """Spans, in a stored index with the place of their lines."""
        return self._spans()

    @cached_property
    def line_set(self) -> LineSet:
        return self._line_set()

    def settled(self) -> Hits:
        """The same search with all it needs written once: its words' postings, its spans and its line keys.

        For several looks at one result: none of them reads the index again, but for the text of lines.
        """
        searcher = self.searcher
        postings = materialized(with_terms(searcher.table, self.words).drop("buckets", "bucket"))
        hits = self.on(Searcher(searcher.line_table, postings, searcher.fold_mode, searcher.stored))
        hits.placed_spans = materialized(hits.placed_spans)
        hits.line_set = LineSet(materialized(hits.line_set.keys), hits.line_set.excluded)
        return hits

    @cached_property
    def lines(self) -> DataFrame:
        """``(doc_id, line_no)``, each matching line once."""
        if not self.line_set.excluded:
            return self.line_set.keys.select(*LINE_KEY)
        searchable = self.searcher.line_table.where("searchable")
        return self.line_set.restrict_table(searchable.select(*line_key(searchable))).select(*LINE_KEY)

    @cached_property
    def lines_with_text(self) -> DataFrame:
        """``(doc_id, line_no, line)`` of each matching line."""
        searchable = self.searcher.line_table.where("searchable")
        return self.line_set.restrict_table(searchable.select(*line_key(searchable), "line")).select(*LINE_KEY, "line")


class Searcher:
    """Search surface over ``lines(doc_id, line_no, line, searchable)`` and
    ``postings(term, doc_id, line_no, pos)``.

    Words are folded like the index and then looked up exactly; stopwords are
    not in the index and so match nothing.
    """

    def __init__(self, lines: DataFrame, postings: DataFrame, fold_mode: str = "full", stored: bool = False) -> None:
        self.lines = lines.select(*LINE_KEY, "line", "searchable")
        self.postings = postings.select("term", *LINE_KEY, "pos")
        #: the same, in a stored index with places and buckets; there, counting a word's postings is cheap
        self.line_table = lines if stored else self.lines
        self.table = postings if stored else self.postings
        self.stored = stored
        self.fold_mode = fold_mode

    def word(self, word: str) -> Hits:
        term = word.casefold() if self.fold_mode == "full" else word.lower()
        return self._slot_hits(
            (frozenset([term]),),
            words=(term,),
            lengths=frozenset([1]),
            alternatives=lambda: ((term,),),
            phrases=tuple,
            patterns=(((term,),),),
            phrase_patterns=(),
            again=lambda searcher: searcher.word(word),
        )

    def adjacent(self, *parts: Hits | str) -> Hits:
        """Each part directly after the one before, on one line.

        An excluding part has no position; with one on either side this is
        :meth:`both_lines`.
        """
        return reduce(self._adjacent, self._operands(parts))

    def any_of(self, *parts: Hits | str) -> Hits:
        return reduce(self._either, self._operands(parts))

    def none_of(self, part: Hits | str) -> Hits:
        """All searchable lines without a match of ``part``; there are no spans."""
        (inner,) = self._operands([part])
        return Hits(
            self,
            spans=self._no_spans,
            line_set=lambda: inner.line_set.complement(),
            words=inner.words,
            lengths=frozenset(),
            alternatives=tuple,
            phrases=lambda: inner.phrases,
            patterns=(),
            phrase_patterns=inner.phrase_patterns,
            again=lambda searcher: searcher.none_of(inner.on(searcher)),
            has_not=True,
        )

    def both_lines(self, left: Hits | str, right: Hits | str) -> Hits:
        """Lines matched by both sides, with the spans both sides have there."""
        left, right = self._operands([left, right])
        return Hits(
            self,
            spans=lambda: self._shared_spans(left, right),
            line_set=lambda: left.line_set.intersect(right.line_set),
            has_not=left.has_not or right.has_not,
            lengths=left.lengths | right.lengths,
            again=lambda searcher: searcher.both_lines(left.on(searcher), right.on(searcher)),
            **self._paired(left, right),
        )

    # -- composition ------------------------------------------------------

    def _operands(self, parts) -> list[Hits]:
        if not parts:
            raise ValueError("a search needs at least one part")
        return [self.word(part) if isinstance(part, str) else part for part in parts]

    @staticmethod
    def _paired(left: Hits, right: Hits) -> dict:
        """What two sides of an adjacency contribute to the statistics."""

        def alternatives() -> tuple[tuple[str, ...], ...]:
            return tuple(a + b for a, b in product(left.alternatives, right.alternatives))

        patterns = tuple(a + b for a, b in product(left.patterns, right.patterns))
        return {
            "words": left.words + right.words,
            "alternatives": alternatives,
            "phrases": lambda: left.phrases + right.phrases + alternatives(),
            "patterns": patterns,
            "phrase_patterns": left.phrase_patterns + right.phrase_patterns + patterns,
        }

    def _adjacent(self, left: Hits, right: Hits) -> Hits:
        if left.has_not or right.has_not:
            return self.both_lines(left, right)
        described = self._paired(left, right) | {"again": lambda searcher: searcher.adjacent(left.on(searcher), right.on(searcher))}
        described["lengths"] = frozenset(a + b for a, b in product(left.lengths, right.lengths))
        if left.slots and right.slots and len(left.slots) + len(right.slots) <= MAX_SLOTS:
            return self._slot_hits(left.slots + right.slots, **described)
        hits = Hits(
            self,
            spans=lambda: _join_adjacent(left, right),
            line_set=lambda: LineSet(distinct_lines(hits.placed_spans)),
            **described,
        )
        return hits

    def _either(self, left: Hits, right: Hits) -> Hits:
        described = {
            "words": left.words + right.words,
            "lengths": left.lengths | right.lengths,
            "alternatives": lambda: left.alternatives + right.alternatives,
            "phrases": lambda: left.phrases + right.phrases,
            "patterns": _either_pattern(left.patterns, right.patterns),
            "phrase_patterns": left.phrase_patterns + right.phrase_patterns,
            "again": lambda searcher: searcher.any_of(left.on(searcher), right.on(searcher)),
        }
        if left.slots and right.slots and len(left.slots) == len(right.slots) == 1:
            return self._slot_hits((left.slots[0] | right.slots[0],), **described)
        return Hits(
            self,
            spans=lambda: _union_spans(left, right, left.placed_spans, right.placed_spans),
            line_set=lambda: left.line_set.union(right.line_set),
            has_not=left.has_not or right.has_not,
            **described,
        )

    def _slot_hits(self, slots: tuple[frozenset[str], ...], **described) -> Hits:
        hits = Hits(
            self,
            spans=lambda: slot_spans(self.table, slots, self.stored),
            line_set=lambda: LineSet(distinct_lines(self._countable(hits.placed_spans, slots))),
            slots=slots,
            **described,
        )
        return hits

    def _countable(self, spans: DataFrame, slots: tuple[frozenset[str], ...]) -> DataFrame:
        """The spans of one slot, which are its postings, so that they can be grouped by line."""
        if not self.stored or len(slots) > 1:
            return spans
        return apart(spans, line_key(spans), with_terms(self.table, slots[0]).count())

    def _no_spans(self) -> DataFrame:
        return slot_spans(self.table, (frozenset(),)).where(F.lit(False))

    @staticmethod
    def _shared_spans(left: Hits, right: Hits) -> DataFrame:
        """Each side's spans lie on its own lines, so only the other side filters them."""
        return _union_spans(left, right, right.line_set.restrict(left.placed_spans), left.line_set.restrict(right.placed_spans))


def _either_pattern(left: tuple[Pattern, ...], right: tuple[Pattern, ...]) -> tuple[Pattern, ...]:
    """Both; single words together are one slot."""
    both = left + right
    if all(len(pattern) == 1 for pattern in both):
        words = tuple(dict.fromkeys(word for pattern in both for word in pattern[0]))
        return ((words,),) if words else ()
    return both


def with_terms(postings: DataFrame, terms) -> DataFrame:
    """Postings of the given words; the filter reaches the Parquet scan, and that of a stored index opens their buckets only."""
    found = postings.where(F.col("term").isin(sorted(terms)))
    if "bucket" in postings.columns and terms:
        buckets = [F.col("bucket") == F.pmod(F.xxhash64(F.lit(term)), F.col("buckets")) for term in sorted(terms)]
        found = found.where(reduce(or_, buckets))
    return found


def slot_anchors(postings: DataFrame, slots) -> DataFrame:
    """Each posting once per slot its word may fill: ``(doc_id, line_no, anchor, slot, term)``.

    ``anchor`` is where a phrase would start that has the word in this slot.
    """
    fills = [F.when(F.col("term").isin(sorted(words)), F.lit(i)) for i, words in enumerate(slots)]
    wanted = frozenset().union(*slots)
    if sum(map(len, slots)) == len(wanted):
        slot = F.coalesce(*fills)
    else:  # some word fills several slots
        slot = F.explode(F.array_compact(F.array(*fills)))
    key = line_key(postings)
    rows = with_terms(postings, wanted).select(*key, "pos", "term", slot.alias("slot"))
    return rows.select(*key, (F.col("pos") - F.col("slot")).alias("anchor"), "slot", "term")


def slot_spans(postings: DataFrame, slots, measured: bool = False) -> DataFrame:
    """Spans of "a word of slot 0, then a word of slot 1, ...".

    A single slot is a filter; any longer phrase takes one grouping, whatever
    its length. Groups hold at most one row per slot, so no word is too common.
    If the postings are cheap to count, they are ``measured``, and only those at
    the places of the rarest slot are grouped.
    """
    key = line_key(postings)
    if len(slots) == 1:
        pos = F.col("pos")
        return with_terms(postings, slots[0]).select(*key, pos.alias("start_pos"), pos.alias("end_pos"))
    bit = F.expr("shiftleft(1L, slot)")
    anchors = slot_anchors(postings, slots)
    if measured:
        anchors = around_rarest(anchors, len(slots))
    complete = anchors.groupBy(*key, "anchor").agg(F.bit_or(bit).alias("seen"))
    return complete.where(F.col("seen") == (1 << len(slots)) - 1).select(
        *key, F.col("anchor").alias("start_pos"), (F.col("anchor") + (len(slots) - 1)).alias("end_pos")
    )


def around_rarest(anchors: DataFrame, n_slots: int) -> DataFrame:
    """Only the anchors that the rarest slot has too, if those are few enough to be broadcast and much fewer than all; else all, ready to be grouped."""
    # One row per slot.
    found = anchors.groupBy("slot").agg(*measures(anchors)).collect()
    if len(found) < n_slots:
        return anchors.where(F.lit(False))
    rarest = min(found, key=lambda row: (row["n"], row["slot"]))
    total = sum(row["n"] for row in found)
    place = [*line_key(anchors), "anchor"]
    if not fits(rarest) or total < WORTH * rarest["n"]:
        return apart(anchors, place, total)
    places = anchors.where(F.col("slot") == rarest["slot"]).select(*place)
    return anchors.join(F.broadcast(places), place, "left_semi")


def _union_spans(left: Hits, right: Hits, left_spans: DataFrame, right_spans: DataFrame) -> DataFrame:
    """Spans of either side; deduplicated only if the sides can find the same span."""
    both = left_spans.unionByName(right_spans)
    return both.distinct() if left.may_share_spans(right) else both


def _join_adjacent(left: Hits, right: Hits) -> DataFrame:
    """Left spans directly followed by right spans; an equi-join on the next position.

    Where right spans share a start, every end counts. A joined span can occur
    twice only if it can be split at two places.
    """
    key = line_key(left.placed_spans)
    lhs = left.placed_spans.select(*key, "start_pos", (F.col("end_pos") + 1).alias("next_pos"))
    rhs = right.placed_spans.select(*key, F.col("start_pos").alias("next_pos"), "end_pos")
    joined = lhs.join(rhs, [*key, "next_pos"]).select(*key, "start_pos", "end_pos")
    totals = [a + b for a, b in product(left.lengths, right.lengths)]
    return joined.distinct() if len(totals) != len(set(totals)) else joined
