"""Corpora: what an index can be kept in step with.

A corpus is a cheap *listing* (names and fingerprints) plus the *documents*
themselves, both DataFrames, so an incremental run can compare first and read
only what changed.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan.sources.workspace import settings, shared_folder

FINGERPRINT = ["mtime", "size", "content_hash"]

# Spark's limit for a file read as one value.
MAX_FILE_BYTES = 2**31 - 1

# Folders are listed by so many tasks per core; Spark's own number, 10,000, is a task for every few folders.
LISTING_TASKS = 4

# Small files that a task reads, and partitions of Spark's plan it takes for them at most: by itself Spark plans a task per 32.
FILES_PER_TASK = 1000
MERGED_PARTITIONS = 32


@dataclass(frozen=True)
class Corpus:
    #: ``(doc_id, mtime, size, content_hash)``
    listing: DataFrame
    #: ``(doc_id, text, mtime, size, content_hash)``; ``text`` is NULL if unreadable
    documents: DataFrame
    #: can the documents be found by ``mtime`` without reading all of them?
    pruned_by_mtime: bool = False


def valid_text(raw: Column, is_binary: bool) -> Column:
    """Strict UTF-8: NULL where the bytes are not valid."""
    return F.try_validate_utf8(raw.cast("string") if is_binary else raw)


def table_corpus(docs: DataFrame, verify_content: bool = True) -> Corpus:
    """A table with ``doc_id`` and either ``text`` (string) or ``content`` (bytes).

    The fingerprint is the size and a hash of the content, plus ``mtime`` if the
    table has one; with ``verify_content=False`` it is ``mtime`` alone, so that a
    comparison reads no text. Rows of a change table may be flagged ``deleted``
    and have a ``sequence``, their place in the order of changes.
    Rows without ``doc_id`` are listed, and so count as failed, but not read.
    """
    if not verify_content and "mtime" not in docs.columns:
        raise ValueError("without content to compare, the table needs an mtime column")
    is_binary = "content" in docs.columns
    raw = F.col("content" if is_binary else "text")
    mtime = F.col("mtime") if "mtime" in docs.columns else F.lit(None)
    deleted = F.coalesce("deleted", F.lit(False)) if "deleted" in docs.columns else F.lit(False)
    sequence = ["sequence"] if "sequence" in docs.columns else []
    documents = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        valid_text(raw, is_binary).alias("text"),
        mtime.cast("timestamp").alias("mtime"),
        F.octet_length(raw).cast("long").alias("size"),
        F.xxhash64(raw).alias("content_hash"),
        deleted.alias("deleted"),
        *sequence,
    )
    unread = [F.lit(None).cast("long").alias(c) for c in ("size", "content_hash")]
    compared = FINGERPRINT if verify_content else ["mtime", *unread]
    present = documents.where(~F.col("deleted") & F.col("doc_id").isNotNull()).drop("deleted")
    return Corpus(documents.select("doc_id", *compared, "deleted", *sequence), present)


def text_tree(spark: SparkSession, root: str, verify_content: bool = False) -> Corpus:
    """All ``.txt`` files (any case) below ``root``, named by their relative path.

    The listing reads no content unless ``verify_content`` asks for hashes;
    modification times have the file system's precision as Spark reports it
    (milliseconds). A file too large for one value is listed but not read, and
    so counts as failed.

    Names that begin with ``_`` or ``.``, which Spark's listing leaves out, are
    found by walking a local tree, else through the Hadoop file system: such
    folders are given to the reader one by one, such files are copied to the
    shared folder and read from there.
    """
    hidden = _hidden(spark, root)
    folders = [_literal(path) for path, status in hidden if status.isDirectory()]
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    tasks = min(int(spark.conf.get(name)), LISTING_TASKS * spark.sparkContext.defaultParallelism)
    with settings(spark, {name: str(tasks)}):
        files = _in_few_tasks(_text_files(spark.read).load([root, *folders]))
    refused = [(p, s) for p, s in hidden if s.isFile() and p.lower().endswith(".txt")]
    if refused:
        files = files.unionByName(_copied(spark, refused))
    # Pushed into the scan, which otherwise fails at the first file beyond the limit.
    fits = F.col("length") <= int(spark.conf.get("spark.sql.sources.binaryFile.maxLength", str(MAX_FILE_BYTES)))
    stat = [
        relative_name(F.col("path"), root).alias("doc_id"),
        F.col("modificationTime").alias("mtime"),
        F.col("length").alias("size"),
    ]
    content_hash = F.xxhash64("content").alias("content_hash")
    documents = files.where(fits).select(*stat, valid_text(F.col("content"), True).alias("text"), content_hash)
    unread = F.lit(None).cast("long").alias("content_hash")
    if verify_content:
        listing = files.where(fits).select(*stat, content_hash).unionByName(files.where(~fits).select(*stat, unread))
    else:
        listing = files.select(*stat, unread)
    return Corpus(listing, documents.select("doc_id", "text", *FINGERPRINT), pruned_by_mtime=True)


def one_row_per_name(rows: DataFrame) -> DataFrame:
    """Per ``doc_id`` the row of largest fingerprint, and ``copies``, the rows there were.

    A row that is ``deleted`` gives way to one that is not. Rows without
    ``doc_id`` are one group, of which only the count is of use.
    """
    rest = [c for c in rows.columns if c != "doc_id"]
    present = [~F.col("deleted")] if "deleted" in rest else []
    latest = F.max_by(F.struct(*rest), F.struct(*present, *FINGERPRINT)).alias("_row")
    grouped = rows.groupBy("doc_id").agg(latest, F.count("*").alias("copies"))
    return grouped.select("doc_id", *[F.col(f"_row.{c}").alias(c) for c in rest], "copies")


def text_tree_stream(spark: SparkSession, root: str) -> DataFrame:
    """Files as they appear below ``root``: change rows ``(doc_id, content, mtime)`` for an index stream.

    A file that is rewritten or deleted is not reported again; that takes a sync with ``text_tree``.
    """
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = _text_files(spark.readStream.schema(schema)).load(root)
    name = relative_name(F.col("path"), root).alias("doc_id")
    return files.select(name, "content", F.col("modificationTime").alias("mtime"))


def _text_files(reader):
    """A batch or stream reader of ``.txt`` files in any depth."""
    options = {"recursiveFileLookup": "true", "pathGlobFilter": "*.[tT][xX][tT]", "ignoreMissingFiles": "true"}
    return reader.format("binaryFile").options(**options)


def _in_few_tasks(files: DataFrame) -> DataFrame:
    """The same scan with more files to a task if most of what Spark counts is the cost of opening them."""
    spark = files.sparkSession
    size_of = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    opening, most = (size_of(spark.conf.get(f"spark.sql.files.{name}")) for name in ("openCostInBytes", "maxPartitionBytes"))
    # Both are known from the listing; the names stay in the JVM.
    n = len(files._jdf.inputFiles())
    size = int(files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if n * opening <= size:
        return files
    planned = (size + n * opening) // most
    return files.coalesce(max(spark.sparkContext.defaultParallelism, n // FILES_PER_TASK, size // most, planned // MERGED_PARTITIONS))


def _hidden(spark: SparkSession, root: str) -> list[tuple[str, object]]:
    """``(path, status)`` of what Spark's listing leaves out below ``root`` because of its own name, in any depth."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(root)
    fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    left_out = jvm.org.apache.spark.util.HadoopFSUtils.shouldFilterOutPathName
    if fs.getUri().getScheme() == "file":
        paths = _local_names(fs.makeQualified(at).toUri().getPath(), left_out)
        found = [s for p in paths for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(_literal(p))) or []]
        return [(status.getPath().toString(), status) for status in found]
    level, found = _literal(root.rstrip("/")), []
    # Level by level, so that only what may be hidden passes from the JVM.
    while len(fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{level}/*")) or []):
        for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{level}/{{[._]*,*._COPYING_}}")) or []:
            if left_out(status.getPath().getName()):
                found.append((status.getPath().toString(), status))
        level += "/*"
    return list(dict(found).items())


def _local_names(root: str, left_out: Callable[[str], bool]) -> list[str]:
    """Paths with a name that is left out, by one walk; the Hadoop file system takes a status of every file, several times."""
    found = []
    for folder, *names in os.walk(root, followlinks=True):
        for name in (x for kind in names for x in kind):
            # Hadoop hides its own checksums, and Java cannot open what is not UTF-8.
            odd = name[0] in "._" or name.endswith("._COPYING_")
            if odd and not (name[0] == "." and name.endswith(".crc")) and _is_utf8(f"{folder}/{name}") and left_out(name):
                found.append(f"{folder}/{name}")
    return found


def _is_utf8(name: str) -> bool:
    return not re.search("[\ud800-\udfff]", name)


def _literal(path: str) -> str:
    """A pattern for this path alone."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _copied(spark: SparkSession, refused: list[tuple[str, object]]) -> DataFrame:
    """The files with their own path and time, read from copies under names that Spark takes."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    folder = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/lexispan/{spark.sparkContext.applicationId}/copies/{uuid.uuid4().hex}")
    target = folder.getFileSystem(conf)
    target.mkdirs(folder)
    limit = int(spark.conf.get("spark.sql.sources.binaryFile.maxLength", str(MAX_FILE_BYTES)))
    rows = []
    for n, (path, status) in enumerate(refused):
        rows.append((f"{n}.txt", path, status.getModificationTime(), status.getLen()))
        if 0 < status.getLen() <= limit:
            copy = jvm.org.apache.hadoop.fs.Path(folder, f"{n}.txt")
            jvm.org.apache.hadoop.fs.FileUtil.copy(status.getPath().getFileSystem(conf), status.getPath(), target, copy, False, conf)
    names = spark.createDataFrame(rows, "copy string, path string, millis long, length long")
    copies = _text_files(spark.read).load(folder.toString()).select(F.substring_index("path", "/", -1).alias("copy"), "content")
    content = F.coalesce("content", F.when(F.col("length") == 0, F.lit(b""))).alias("content")
    return names.join(copies, "copy", "left").select("path", F.timestamp_millis("millis").alias("modificationTime"), "length", content)


def relative_name(path: Column, root: str) -> Column:
    """Path below ``root`` with forward slashes; scheme and authority are ignored."""
    uri_prefix = r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?"
    base = re.sub(uri_prefix, "", root)
    if base == root:
        base = os.path.abspath(root)
    base = base.rstrip("/")
    return F.substr(F.regexp_replace(path, uri_prefix, ""), F.lit(len(base) + 2))


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for a source that arrives in fewer partitions than that.

    A large source already has many partitions and is left alone, so its text
    is never shuffled. Only for plain scans: it plans ``df`` to count them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
