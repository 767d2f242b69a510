"""Lines to word positions, and the inverted index over them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.functions import text as T
from lexispan.functions.stopwords import CORE_STOPWORDS
from lexispan.operators.keys import broadcast_if_small


# Bytes of postings, as Spark estimates them, that a task groups by document and word if their shuffle is to be sized:
# about 1.5 million of them. So many times as much is left to a task before it is, and there are this many tasks at most.
TOTALS_BYTES = 6 << 20
TOTALS_FACTOR = 4
MOST_TASKS = 8192


def line_tokens(lines: DataFrame, fold_mode: str = "full") -> DataFrame:
    """Every word of every searchable line with its 0-based position.

    Columns other than ``line`` and ``searchable`` are carried along.
    """
    rest = [c for c in lines.columns if c not in ("line", "searchable")]
    return lines.where("searchable").select(
        *rest, F.posexplode(T.tokens(F.col("line"), fold_mode)).alias("pos", "term")
    )


def drop_stopwords(tokens: DataFrame, stopwords: Iterable[str] | DataFrame = CORE_STOPWORDS) -> DataFrame:
    """Remove stopwords; the positions of the remaining words do not move.

    ``stopwords`` is a word list, or a table with a ``term`` column.
    """
    if isinstance(stopwords, DataFrame):
        listed = stopwords.select("term").distinct()
        return tokens.join(broadcast_if_small(listed), "term", "left_anti")
    words = list(stopwords)
    return tokens.where(~F.col("term").isin(words)) if words else tokens


def line_postings(
    lines: DataFrame, fold_mode: str = "full", stopwords: Iterable[str] | DataFrame = CORE_STOPWORDS
) -> DataFrame:
    """``lines`` to ``postings(term, doc_id, line_no, pos)``.

    A position of a line holds one word, so the rows are a set without any
    ``distinct``; the whole path from documents to postings has no shuffle.
    """
    kept = drop_stopwords(line_tokens(lines, fold_mode), stopwords)
    rest = [c for c in kept.columns if c not in ("term", "doc_id", "line_no", "pos")]
    return kept.select("term", "doc_id", "line_no", "pos", *rest)


def packed_place() -> Column:
    """``line_no`` and ``pos`` as one number of the same order: half of what they take apart when moved."""
    return F.shiftleft(F.col("line_no").cast("long"), 32).bitwiseOR(F.col("pos").cast("long"))


def unpacked_place(place: Column) -> dict[str, Column]:
    return {"line_no": F.shiftright(place, 32).cast("int"), "pos": place.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")}


def term_frequencies(postings: DataFrame) -> DataFrame:
    """``(doc_id, term, tf)``"""
    return postings.groupBy("doc_id", "term").agg(F.count("*").alias("tf"))


def document_index(postings: DataFrame) -> DataFrame:
    """Per document and word, the ordered ``(line_no, pos)`` entries.

    A group never exceeds one document, whose text is already a single row.
    Words occur about once per document, so collecting before the shuffle saves
    nothing: rows are moved as they are, and only a partition of them is sorted.
    """
    rows = postings.select("doc_id", "term", packed_place().alias("place")).repartition("doc_id")
    grouped = rows.groupBy("doc_id", "term").agg(F.sort_array(F.collect_list("place")).alias("places"))
    types = postings.schema
    entry = lambda p: F.struct(*[part.cast(types[c].dataType).alias(c) for c, part in unpacked_place(p).items()])
    return grouped.select("doc_id", "term", F.transform("places", entry).alias("entries"))


def master_index(document_indexes: DataFrame) -> DataFrame:
    """Merge per-document indexes into one flat ``(term, doc_id, line_no, pos)`` table.

    Flat rows instead of one array per word: a common word would otherwise be a
    single row holding a large part of the corpus.
    """
    entries = document_indexes.select("term", "doc_id", F.explode("entries").alias("e"))
    return entries.select("term", "doc_id", F.col("e.line_no").alias("line_no"), F.col("e.pos").alias("pos"))


def term_totals(postings: DataFrame) -> DataFrame:
    """Index-wide occurrences and documents per word: ``(term, n, n_docs)``.

    Counting per document first spreads a frequent word over many tasks. Words
    occur about once per document, so those counts are nearly as many as the
    postings; if the session has too few partitions to hold them in memory, the
    postings are dealt out to more.
    """
    rows = postings.select("doc_id", "term")
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    tasks = min(MOST_TASKS, size // TOTALS_BYTES)
    if tasks > TOTALS_FACTOR * int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        rows = rows.repartition(tasks, "doc_id", "term")
    return (
        term_frequencies(rows)
        .groupBy("term")
        .agg(F.sum("tf").alias("n"), F.count("*").alias("n_docs"))
    )
