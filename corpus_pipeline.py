"""Documents to training data, in stages; each stage's rows are written and read again by the next.

Languages that cannot be told are rejected, one document of each group of near
duplicates stays, repeated passages are cut out, sources are mixed to their
target weights, and what remains becomes token ids. Every stage runs over all
rows of the stage before; its models and counts come from these rows alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan.llm import language_id, mixing, near_dedup, sentencepiece_codec, suffix_dedup
from lexispan.llm.queries import tokenizer_file
from lexispan.llm.workers import known_to_workers
from lexispan.sources.workspace import materialized

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found, by all rows with a label; a null text or one without letters is rejected.

    Without any label there is no language to find: then texts with letters stay.
    """
    known_to_workers(spark)
    model = language_id.fit(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language_id.identify(docs.select(F.struct("*").alias("_document"), F.col("text").alias("_text")), model, "_text")
    return found.where(F.size("lang_spans") > 0).select("_document.*")


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 80% of the runs of five words, the document of smallest id."""
    known_to_workers(spark)
    return near_dedup.one_of_each(docs, width=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that occurred before are cut out; every row stays."""
    known_to_workers(spark)
    return suffix_dedup.without_repeats(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once or twice."""
    return mixing.mixture(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with its ids, their number, and whether decoding them gives its text again."""
    known_to_workers(spark)
    model = sentencepiece_codec.load_pieces(tokenizer_file("piece_bpe_32k.model"))
    encoded = sentencepiece_codec.encode(docs, model, verify=True)
    return encoded.select("doc_id", "lang", "source", "token_ids", F.size("token_ids").alias("n_tokens"), "round_trip")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("minhash_near_dedup", one_of_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("mixing_sources", mixed_sources),
    ("sentencepiece", token_ids),
]

# Most stages are models and approximate searches that SQL cannot express; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialized(stage(spark, docs, sf_dir))
    return docs
