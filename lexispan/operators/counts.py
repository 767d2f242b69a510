"""Statistics of a search: occurrences, lines, words, and phrase alternatives."""

from __future__ import annotations

from math import prod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispan.operators.ranking import with_rank
from lexispan.operators.search import Hits, apart, line_key, with_terms

# A search lists so many exact phrases whether they occur or not.
LISTED = 10_000


def occurrence_count(hits: Hits) -> DataFrame:
    """One row: ``occurrences``, the number of distinct spans."""
    return hits.spans.agg(F.count("*").alias("occurrences"))


def line_count(hits: Hits) -> DataFrame:
    """One row: ``matching_lines``."""
    return hits.lines.agg(F.count("*").alias("matching_lines"))


def document_count(documents: DataFrame) -> DataFrame:
    """One row: ``documents``, from any table with one ``doc_id`` per document.

    Pass the corpus or the manifest, not postings: blank documents have none.
    """
    return documents.select("doc_id").distinct().agg(F.count("*").alias("documents"))


def _labelled(hits: Hits, phrases: list[tuple[str, ...]], keys: list[str]) -> DataFrame:
    """The query's own labels as a table; its size is the query's, not the data's."""
    rows = [(i, " && ".join(words), key) for i, (words, key) in enumerate(zip(phrases, keys), start=1)]
    return hits.searcher.postings.sparkSession.createDataFrame(rows, "ordinal int, label string, key string")


def _with_zeros(labels: DataFrame, counted: DataFrame) -> DataFrame:
    return labels.join(counted, "key", "left").select("ordinal", "label", F.coalesce("n", F.lit(0)).alias("n"))


def word_counts(hits: Hits) -> DataFrame:
    """``(ordinal, label, n)`` per distinct query word in order of first mention.

    Counts cover the whole index, excluded words are included, and words that
    are not indexed count 0.
    """
    found = with_terms(hits.searcher.table, hits.words).groupBy(F.col("term").alias("key")).agg(F.count("*").alias("n"))
    return _with_zeros(_labelled(hits, [(w,) for w in hits.words], list(hits.words)), found)


def phrase_counts(hits: Hits) -> DataFrame:
    """``(ordinal, label, n)`` per exact phrase that any adjacency inside stands for.

    Alternatives multiply: up to ``LISTED`` phrases are all listed, in order, with
    0 for those that do not occur. Of more, those that occur are listed, by label.
    """
    found = found_phrases(hits)
    if sum(prod(map(len, pattern)) for pattern in hits.phrase_patterns) > LISTED:
        return with_rank(found, [F.col("label")], "ordinal").select(F.col("ordinal").cast("int").alias("ordinal"), "label", "n")
    phrases = list(hits.phrases)
    keys = [" && ".join(words) for words in phrases]
    return _with_zeros(_labelled(hits, phrases, keys), found.withColumnRenamed("label", "key"))


def found_phrases(hits: Hits) -> DataFrame:
    """``(label, n)`` of the exact phrases that occur, of those any adjacency inside stands for.

    One pass over the postings of all words, for phrases of every length: a
    posting goes to each slot that its word may fill, and as a position holds one
    word, the words found at an anchor name the phrase they form. Alternatives are
    never multiplied out.
    """
    patterns = hits.phrase_patterns
    table = hits.searcher.table
    slots = [(p, i, len(pattern), word, n) for p, pattern in enumerate(patterns) for i, words in enumerate(pattern) for n, word in enumerate(words, 1)]
    # As many rows as the search has words.
    known = F.broadcast(table.sparkSession.createDataFrame(slots, "pattern int, slot int, size int, term string, choice int"))
    rows = with_terms(table, {word for *_, word, _ in slots}).join(known, "term")
    key = [*line_key(table), "anchor", "pattern", "size"]
    longest = max(map(len, patterns), default=0)
    columns = [f"w{i}" for i in range(longest)]
    # Words as their numbers in the slot: fixed-width values keep the grouping a hash aggregate.
    at_slot = [F.max(F.when(F.col("slot") == i, F.col("choice"))).alias(c) for i, c in enumerate(columns)]
    anchors = rows.withColumn("anchor", F.col("pos") - F.col("slot"))
    if hits.searcher.stored:
        anchors = apart(anchors, key, rows.count())
    formed = anchors.groupBy(*key).agg(F.count("*").alias("filled"), *at_slot)
    counted = formed.where("filled = size").groupBy("pattern", *columns).agg(F.count("*").alias("n"))
    spelled = F.array(*[F.array(*[F.array(*map(F.lit, words)) for words in pattern]) for pattern in patterns]) if patterns else F.array()
    own = F.element_at(spelled, F.col("pattern") + 1)
    words = [F.when(F.col(c).isNotNull(), F.element_at(F.element_at(own, i + 1), F.col(c))) for i, c in enumerate(columns)]
    label = F.concat_ws(" && ", *words) if words else F.lit("")
    # Two patterns may stand for one phrase.
    return counted.select(label.alias("label"), "n").groupBy("label").agg(F.max("n").alias("n"))

