"""Everything a search session shows for one query."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispan.functions import display
from lexispan.operators import counts, results
from lexispan.operators.search import Hits


@dataclass(frozen=True)
class SearchReport:
    #: ``(section, ordinal, label, n, text)``: word counts, then phrase counts
    statistics: DataFrame
    #: one row ``(occurrences, matching_lines, message)``
    summary: DataFrame
    #: ``(doc_id, line_no, line, result)`` in display order
    lines: DataFrame
    #: the search itself, read from what was written for the report
    hits: Hits


def statistics(hits: Hits) -> DataFrame:
    words = counts.word_counts(hits).withColumn("section", F.lit("word"))
    phrases = counts.phrase_counts(hits).withColumn("section", F.lit("phrase"))
    return words.unionByName(phrases).select(
        "section", "ordinal", "label", "n", display.count_label(F.col("label"), F.col("n")).alias("text")
    )


def summary(hits: Hits, query: str | None = None) -> DataFrame:
    """One row; a search without a match is named by ``query``, if that is given."""
    spans = hits.spans.select(F.lit(1).alias("span"), F.lit(0).alias("line"))
    lines = hits.lines.select(F.lit(0).alias("span"), F.lit(1).alias("line"))
    totals = spans.unionByName(lines).agg(
        F.coalesce(F.sum("span"), F.lit(0)).alias("occurrences"),
        F.coalesce(F.sum("line"), F.lit(0)).alias("matching_lines"),
    )
    found = F.format_string("Found %d matching line(s).", "matching_lines")
    nothing = "No results found." if query is None else f"No results found for: {query}"
    message = F.when(F.col("matching_lines") > 0, found).otherwise(nothing)
    return totals.withColumn("message", message)


def search_report(hits: Hits, query: str | None = None) -> SearchReport:
    """Every section of one search, from one scan of the index."""
    hits = hits.settled()
    return SearchReport(statistics(hits), summary(hits, query), results.ordered_results(hits), hits)
