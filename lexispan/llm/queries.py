"""One query per operation over the given tables, and SQL with the same result where there is any."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan.llm import (
    chunked_bpe, fingerprints, language_id, mixing, near_dedup, period_runs, prefix_trie, sentencepiece_codec, suffix_dedup,
    token_files, topk_search, toxicity, warc,
)
from lexispan.llm.workers import known_to_workers
from lexispan.sources.workspace import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    known_to_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster names for shared files."""
    return f"{shared_folder(spark)}/lexispan/{spark.sparkContext.applicationId}/{name}/{uuid.uuid4().hex}"


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = language_id.is_held_out("doc_id", 5, 0)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"), F.size("toxic_passages").alias("n_passages"),
    )


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for the whole text of every document whose id is divisible by 100."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    queries = docs.where(F.col("doc_id") % 100 == 0).withColumnRenamed("doc_id", "query_id")
    return topk_search.top_k(docs, queries, 10)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = language_id.is_held_out("doc_id", 4, 2)
    model = language_id.fit(docs.where(~held_out))
    labelled = language_id.identify(docs.select("doc_id", "text"), model)
    return labelled.select(
        "doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.size("lang_spans").alias("n_spans")
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digest(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), folder)
    found = warc.record_summary(warc.read_archive(spark, folder))
    return found.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


# The end-of-document id of the token files.
END_ID = 2


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "ids")
    token_files.write_ids(table(spark, sf_dir, "documents"), folder, tokenizer_file("word_bpe_49k.json"), END_ID)
    return token_files.id_digests(spark, folder).withColumnRenamed("id", "doc_id")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = sentencepiece_codec.load_pieces(tokenizer_file("piece_bpe_32k.model"))
    return sentencepiece_codec.codec_digest(table(spark, sf_dir, "documents"), model)


def op11_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return chunked_bpe.codec_digest(docs, tokenizer_file("byte_bpe_50k.json"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turn_lists(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.sharing_first_turns(turns))


def op13_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return period_runs.run_digests(period_runs.with_planted_period(docs))


LLM_QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_toxicity": op2_toxicity,
    "op3_topk_search": op3_topk_search,
    "op4_near_dedup": op4_near_dedup,
    "op5_language_id": op5_language_id,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_warc": op7_warc,
    "op8_fingerprints": op8_fingerprints,
    "op9_token_files": op9_token_files,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_chunked_bpe": op11_chunked_bpe,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_period_runs": op13_period_runs,
}

LLM_ORACLES: dict[str, str] = {
    "op1_mixing": mixing.oracle(),
    "op4_near_dedup": near_dedup.oracle(),
    "op6_suffix_dedup": suffix_dedup.oracle(),
    "op7_warc": warc.oracle(),
    "op12_prefix_trie": prefix_trie.oracle(),
}
