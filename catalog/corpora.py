"""The given tables as corpora, and a stored index over them per session."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan import Searcher, TextIndex, document_lines, line_postings, table_corpus
from lexispan.sources.corpus import spread
from lexispan.sources.workspace import shared_folder

APPENDIX = "\nappendix lincoln"
BODY_START = "*** START OF THE PROJECT GUTENBERG EBOOK X ***"
BODY_END = "*** END OF THE PROJECT GUTENBERG EBOOK X ***"

_WRITTEN: set[str] = set()
_SEARCHERS: dict[tuple[str, str], Searcher] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per turn, named ``c<conversation>:<turn>``."""
    turns = spread(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "text"))
    return turns.select(F.format_string("c%d:%d", "conv_id", "turn").alias("doc_id"), "text")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw HTML as plain text, named ``p<page>``."""
    raw = spread(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html"))
    return raw.select(F.format_string("p%d", "page_id").alias("doc_id"), F.col("html").alias("text"))


def named_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang")


def earlier_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first state of a corpus: all documents and all conversation turns."""
    return named_documents(spark, sf_dir).select("doc_id", "text").unionByName(conversations(spark, sf_dir))


def later_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second state: German documents edited, turns gone, pages added."""
    docs = named_documents(spark, sf_dir)
    text = F.when(F.col("lang") == "de", F.concat("text", F.lit(APPENDIX))).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text")).unionByName(pages(spark, sf_dir))


def ordered_changes(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three waves of ``(doc_id, text, deleted, version)``: every document, then later and late ones, then late ones of deleted documents.

    In the end Spanish documents are edited, French ones deleted, and all others as they were.
    """
    docs = named_documents(spark, sf_dir)
    edited = F.concat("text", F.lit(APPENDIX)).alias("text")

    def rows(lang: str | None, text, version: int, deleted: bool = False) -> DataFrame:
        some = docs if lang is None else docs.where(F.col("lang") == lang)
        return some.select("doc_id", text, F.lit(deleted).alias("deleted"), F.lit(version).alias("version"))

    text, nothing = F.col("text"), F.lit(None).cast("string").alias("text")
    second = rows("de", edited, 1).unionByName(rows("fr", nothing, 3, True)).unionByName(rows("es", edited, 3))
    return [rows(None, text, 2), second, rows("fr", edited, 2)]


def damaged_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second state in which German documents are edited and French ones are not valid UTF-8."""
    docs = named_documents(spark, sf_dir)
    raw = F.encode("text", "utf-8")
    edited = F.encode(F.concat("text", F.lit(APPENDIX)), "utf-8")
    broken = F.concat(raw, F.lit(b"\xff"))
    content = F.when(F.col("lang") == "de", edited).when(F.col("lang") == "fr", broken).otherwise(raw)
    return docs.select("doc_id", content.alias("content"))


def framed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with body markers: in order, reversed, opening only, or none, by language."""
    docs = documents(spark, sf_dir)
    head, start, end, tail = (F.lit(f"{part}\n") for part in ("h", BODY_START, BODY_END, "f"))
    whole = F.concat("text", F.lit("\n"))
    framed = (
        F.when(F.col("lang") == "de", F.concat(head, start, whole, end, tail))
        .when(F.col("lang") == "fr", F.concat(head, end, whole, start, tail))
        .when(F.col("lang") == "es", F.concat(head, start, whole))
        .otherwise(F.col("text"))
    )
    return docs.select("doc_id", framed.alias("text"))


def scratch(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A folder of this session, below the folder the cluster names for shared files."""
    key = hashlib.sha256(sf_dir.encode()).hexdigest()[:12]
    return f"{shared_folder(spark)}/lexispan/{spark.sparkContext.applicationId}/{key}/{name}"


def text_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder with each document as a ``.txt`` file, written once per session."""
    root = scratch(spark, sf_dir, "tree")
    if root not in _WRITTEN:
        write_text_files(documents(spark, sf_dir).select("lang", F.col("doc_id").alias("doc"), "text"), root)
        _WRITTEN.add(root)
    return root


def write_text_files(docs: DataFrame, root: str) -> None:
    """``docs(lang, doc, text)`` as ``.txt`` files below ``root``, by language, each text followed by a newline.

    Hadoop's local file system, without its native library, starts a process
    for the permissions of every file and folder it makes. So tasks write local
    files themselves, and only other file systems get them from Spark's writer.
    """
    spark = docs.sparkSession
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = top.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if files.getUri().getScheme() != "file":
        docs.write.mode("overwrite").partitionBy("lang", "doc").text(root)
        return
    files.delete(top, True)
    keys = [F.col(c).cast("string").alias(c) for c in ("lang", "doc")]
    rows = docs.sortWithinPartitions("lang", "doc").select(*keys, F.col("text").cast("binary").alias("text"))
    rows.mapInArrow(_local_writer(top.toUri().getPath()), "n long").agg(F.sum("n")).collect()


def _local_writer(root: str) -> Callable[[Iterator], Iterator]:
    """A function for ``mapInArrow`` that writes rows sorted by name, and counts the files.

    Names are those of Spark's partition folders, and a file has the number of
    its task, so a task that runs again writes the same files. Workers need not
    be able to import this module.
    """
    default = "__HIVE_DEFAULT_PARTITION__"
    escapes = {c: f"%{c:02X}" for c in (*range(1, 32), 127, *map(ord, "\"#%'*/:=?\\{[]^"))}

    def write(batches):
        import os
        from itertools import groupby

        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get()
        folders, n = set(), 0
        rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns), strict=True))
        for names, texts in groupby(rows, key=lambda row: row[:2]):
            lang, doc = ((name or default).translate(escapes) for name in names)
            folder = f"{root}/lang={lang}"
            if folder not in folders:
                os.makedirs(folder, exist_ok=True)
                folders.add(folder)
            unfinished = f"{folder}/.{task.taskAttemptId()}"
            with open(unfinished, "wb") as file:
                file.writelines((text or b"") + b"\n" for *_, text in texts)
            os.replace(unfinished, f"{folder}/doc={doc}.part-{task.partitionId():05d}.txt")
            n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    return write


def stored_index(spark: SparkSession, sf_dir: str, name: str) -> TextIndex:
    return TextIndex(spark, scratch(spark, sf_dir, name))


def searcher(spark: SparkSession, sf_dir: str) -> Searcher:
    """Search over the stored index of ``documents``, built once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SEARCHERS:
        index = stored_index(spark, sf_dir, "documents")
        index.sync(table_corpus(documents(spark, sf_dir).select("doc_id", "text")))
        _SEARCHERS[key] = index.searcher()
    return _SEARCHERS[key]


def direct_searcher(docs: DataFrame) -> Searcher:
    """Search without a stored index: lines and postings are part of the query."""
    lines = document_lines(docs)
    return Searcher(lines, line_postings(lines))
