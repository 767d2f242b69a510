"""A text index kept as Parquet tables, brought up to date by runs.

Layout below the index folder::

    store/run=K/kind=document/part=P      the manifest: one row per document
    store/run=K/kind=line/part=P          its lines
    postings/batch=K/buckets=N/bucket=B   its words, by a hash of the word, sorted by word in every file
    removed/run=K                         documents of which earlier runs no longer hold
    commits/run=K                         which of these make up the index

A run writes what is new and names the documents whose earlier rows are void; it
rewrites nothing. Readers leave void rows out by an anti join with those names.
When several runs of one size have gathered they are merged into one, so there
are few of them however many there were, and a row is rewritten only as often as
its run grows by a factor. A run becomes visible with its commit, written last;
one that died before that is overwritten by the next, and no folder that a
commit names is ever written again.

The text of a document is written by the task that read it, into that task's
part. Only postings are shuffled, once: all rows of a word lie in one bucket, so
looking a word up opens the files of one bucket per run. A bucket too large for a
task becomes several files. Postings carry the run and part of their lines, so
fetching lines opens the parts that have some.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from datetime import timedelta

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan.functions.stopwords import CORE_STOPWORDS
from lexispan.operators.keys import broadcast_if_small, is_small
from lexispan.operators.lines import is_searchable, with_line_arrays
from lexispan.operators.postings import line_postings, packed_place, unpacked_place
from lexispan.operators.search import Searcher
from lexispan.plans.classify import INDEX_VERSION, build_summary, classify, names_only, settle_failures, surplus_rows
from lexispan.sources.corpus import FINGERPRINT, Corpus, one_row_per_name, table_corpus
from lexispan.sources.workspace import settings

# Parts per run; bounds what a commit lists and what the driver ever collects.
MAX_PARTS = 16384

# Text per part and per bucket that writing aims at, and the most buckets of a run.
PART_BYTES = 256 << 20
BUCKET_BYTES = 4 << 20
MAX_BUCKETS = 32768

# Stored bytes that a task sorts postings of, and shuffled bytes of them that a task writes: both some hundred MB as rows.
# A file is read in parts only between its row groups, so those of the store are as small, counted before compression.
SORTED_BYTES = 12 << 20
SHUFFLED_BYTES = 24 << 20
ROW_GROUP_BYTES = 16 << 20

# Removed documents that are broadcast to leave out their rows, at most: about 400 MB in memory. Beyond that all rows move.
REMOVED_ROWS = 4_000_000
REMOVED_BYTES = 128 << 20

# A row group holds words of so many documents at most if a dictionary of their names is to fit.
NAMED_DOCUMENTS = 1 << 16

# So many runs of one tier are merged; tiers go by postings, in steps of the same factor.
FANOUT = 4
TIER_ROWS = 100_000

STORE = (
    "doc_id string, line_no int, line string, searchable boolean, mtime timestamp, size bigint, "
    "content_hash bigint, sequence bigint, index_version int, run bigint, kind string, part int"
)
POSTINGS = (
    "term string, doc_id string, line_no int, pos int, index_version int, run bigint, part int, "
    "batch bigint, buckets int, bucket int"
)
REMOVED = "doc_id string, sequence bigint, removed_run bigint, run bigint"
COMMITS = "item string, data_run bigint, data_part int, folder bigint, n bigint, bytes bigint, run bigint"
PLAN = "doc_id string, action string, known boolean, mtime timestamp, n bigint, usable boolean, old_run bigint, old_part int"

# What Spark and Parquet say of files that are missing or corrupt, and of those that may not be read.
DAMAGE = (
    "PATH_NOT_FOUND",
    "FILE_NOT_EXIST",
    "FileNotFoundException",
    "CANNOT_READ_FILE_FOOTER",
    "is not a Parquet file",
    "ParquetDecodingException",
)
DENIED = ("AccessControlException", "AccessDeniedException", "Permission denied")

Part = tuple[int, int]  # run, part


@dataclass(frozen=True)
class Batch:
    """Postings of a run: their folder, in how many buckets, and how many they are."""

    folder: int
    buckets: int
    n: int

    @property
    def path(self) -> str:
        return f"batch={self.folder}/buckets={self.buckets}"


@dataclass(frozen=True)
class State:
    """What a commit says. Its size goes with the number of live runs, not of documents."""

    run: int = 0
    #: per live run its postings
    batches: dict[int, Batch] = field(default_factory=dict)
    #: folders of removed documents, with rows and bytes
    removed: dict[int, tuple[int, int]] = field(default_factory=dict)
    #: parts of live runs that were damaged and do not count
    dropped: frozenset[Part] = frozenset()


class TextIndex:
    """The index in folder ``root``; one writer at a time, any number of readers."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        split_mode: str = "core",
        fold_mode: str = "full",
        stopwords: Iterable[str] = CORE_STOPWORDS,
        version: int | None = None,
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.split_mode = split_mode
        self.fold_mode = fold_mode
        self.stopwords = list(stopwords)
        self._version = version

    @property
    def version(self) -> int:
        """The version of the text rules. Rows of other versions stay side by side, are not read, and count as changed."""
        return INDEX_VERSION if self._version is None else self._version

    # -- reading ----------------------------------------------------------

    @property
    def lines(self) -> DataFrame:
        """``(doc_id, line_no, line, searchable)``"""
        return self.searcher().lines

    @property
    def postings(self) -> DataFrame:
        """``(term, doc_id, line_no, pos)``: the merged index of all documents."""
        return self.searcher().postings

    @property
    def manifest(self) -> DataFrame:
        """``(doc_id, mtime, size, content_hash, index_version)``; empty before the first build."""
        return self._live("document", self._state()).select("doc_id", *FINGERPRINT, "index_version")

    def searcher(self) -> Searcher:
        """Search over the index as of the last commit; lines and postings are of the same."""
        state = self._state()
        served = (F.col("index_version") == self.version) & F.col("doc_id").isNotNull()
        lines = self._live("line", state).where(served).select("run", "part", "doc_id", "line_no", "line", "searchable")
        postings = self._live("postings", state).where(served)
        columns = ["term", "doc_id", "line_no", "pos", "run", "part", "buckets", "bucket"]
        return Searcher(lines, postings.select(*columns), self.fold_mode, stored=True)

    def actions(self, run: int | None = None) -> DataFrame:
        """The action log ``(doc_id, action, ...)`` of a run of ``sync``, by default the last."""
        if run is None:
            last = self._state().run
            run = max(r for r in _runs_of(self.spark.read.schema(PLAN).parquet(f"{self.root}/actions")) if r <= last)
        return self.spark.read.schema(PLAN).parquet(f"{self.root}/actions/run={run}")

    def _state(self) -> State:
        """The last commit, or an empty one."""
        try:
            commits = self.spark.read.schema(COMMITS).parquet(f"{self.root}/commits")
        except PySparkException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return State()
        runs = _runs_of(commits)
        if not runs:
            return State()
        rows = commits.where((F.col("run") == max(runs)) & F.col("item").isin("run", "removed", "dropped")).collect()
        return State(
            max(runs),
            {r.data_run: Batch(r.folder, r.data_part, r.n) for r in rows if r.item == "run"},
            {r.data_run: (r.n, r.bytes) for r in rows if r.item == "removed"},
            frozenset((r.data_run, r.data_part) for r in rows if r.item == "dropped"),
        )

    def _committed(self) -> tuple[int, dict[str, list[Part]]]:
        """The last run, and the live parts of documents and of lines: each run's commit names those it wrote."""
        state = self._state()
        parts: dict[str, list[Part]] = {"document": [], "line": []}
        if state.batches:
            commits = self.spark.read.schema(COMMITS).parquet(f"{self.root}/commits")
            named = commits.where(F.col("run").isin(list(state.batches)) & F.col("item").isin(list(parts)))
            # At most MAX_PARTS per table and live run.
            for item, run, part in named.select("item", "data_run", "data_part").collect():
                if (run, part) not in state.dropped:
                    parts[item].append((run, part))
        return state.run, parts

    def _live(self, table: str, state: State, runs: Iterable[int] | None = None, without: Iterable[Part] = ()) -> DataFrame:
        """Rows of ``runs`` (by default of all live ones) that hold."""
        runs = sorted(state.batches if runs is None else runs)
        if table == "postings":
            folder, schema, paths = "postings", POSTINGS, sorted(state.batches[r].path for r in runs)
        else:
            folder, schema, paths = "store", STORE, [f"run={r}" for r in runs]
        if not paths:
            # Known to be empty when planning already.
            return self.spark.createDataFrame([], schema).where(F.lit(False))
        paths = [f"{self.root}/{folder}/{p}" for p in paths]
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/{folder}").parquet(*paths)
        if folder == "store":
            rows = rows.where(F.col("kind") == table)
        for run, part in sorted(state.dropped.union(without)):
            rows = rows.where((F.col("run") != run) | (F.col("part") != part))
        return self._without_removed(rows, state)

    def _without_removed(self, rows: DataFrame, state: State) -> DataFrame:
        """Leave out rows of documents that a later run removed or replaced; how many those are is known."""
        if not state.removed:
            return rows
        removed = self._removed(state).select(F.col("doc_id").alias("_gone"), "removed_run")
        # Else hashed, so that the rows are moved but not sorted.
        removed = F.broadcast(removed) if _few_removed(state) else removed.hint("shuffle_hash")
        return rows.join(removed, (rows["doc_id"] == removed["_gone"]) & (rows["run"] < removed["removed_run"]), "left_anti")

    def _removed(self, state: State) -> DataFrame:
        """``(doc_id, removed_run, sequence)``: the last removal of each document."""
        if not state.removed:
            return self.spark.createDataFrame([], REMOVED).where(F.lit(False)).select("doc_id", "removed_run", "sequence")
        paths = [f"{self.root}/removed/run={run}" for run in sorted(state.removed)]
        rows = self.spark.read.schema(REMOVED).option("basePath", f"{self.root}/removed").parquet(*paths)
        return rows.groupBy("doc_id").agg(F.max("removed_run").alias("removed_run"), F.max("sequence").alias("sequence"))

    def _read_parts(self, table: str, parts: Iterable[Part]) -> DataFrame:
        paths = [f"{self.root}/store/run={run}/kind={table}/part={part}" for run, part in parts]
        return self.spark.read.schema(STORE).option("basePath", f"{self.root}/store").parquet(*paths)

    def _damaged(self, table: str, parts: Iterable[Part]) -> set[Part]:
        """Parts with missing or corrupt files: none by one job, else by halving where it fails."""
        parts = sorted(parts)
        if not parts or _is_readable(lambda: self._read_parts(table, parts)):
            return set()
        if len(parts) == 1:
            return set(parts)
        half = len(parts) // 2
        return self._damaged(table, parts[:half]) | self._damaged(table, parts[half:])

    def _read_run(self, table: str, run: int) -> DataFrame:
        """What run ``run`` has written so far, committed or not."""
        base = f"{self.root}/store"
        return self.spark.read.schema(STORE).option("basePath", base).parquet(f"{base}/run={run}").where(F.col("kind") == table)

    # -- writing ----------------------------------------------------------

    def sync(self, corpus: Corpus, partial: bool = False) -> DataFrame:
        """Make the index match ``corpus``; returns the one-row build summary.

        With ``partial`` the listing only names changes: documents it does not
        mention stay, and those flagged ``deleted`` go.
        """
        if not partial:
            self._repair_postings()
        state = self._state()
        run = state.run + 1
        listing = corpus.listing if state.batches else names_only(corpus.listing)
        # Grouping by name leaves the rows where the comparison with the manifest needs them.
        names = self._materialize(one_row_per_name(listing), f"names/run={run}")
        named = names.where(F.col("doc_id").isNotNull()).drop("copies")
        unusable: set[Part] = set()
        if partial:
            # A few changes need no shuffle of the whole manifest.
            manifest = self._live("document", state).join(broadcast_if_small(named.select("doc_id")), "doc_id", "left_semi")
        else:
            parts = self._committed()[1]
            unknown = self._damaged("document", parts["document"])
            unusable = unknown | self._damaged("line", set(parts["line"]) - unknown)
            intact = {r for r, _ in set(parts["document"]) - unknown}
            # Nothing of a damaged part stays: its documents are read again, or have failed.
            at = F.concat_ws(":", "run", "part")
            usable = ~at.isin([f"{r}:{p}" for r, p in unusable]) if unusable else F.lit(True)
            manifest = self._live("document", state, intact, unknown).withColumn("usable", usable)
        plan = self._materialize(classify(named, manifest, partial, self.version), f"plan/run={run}")
        attempted = F.col("action").isin("new", "updated")
        todo = plan.agg(
            F.count_if(attempted).alias("attempted"),
            F.count_if(F.col("action") == "skipped").alias("skipped"),
            F.unix_micros(F.min(F.when(attempted, F.col("mtime")))).alias("oldest"),
            F.unix_micros(F.max(F.when(attempted, F.col("mtime")))).alias("newest"),
        ).first()

        indexed = self.spark.createDataFrame([], "doc_id string")
        wrote: tuple[Batch, list[tuple[str, int]]] | None = None
        if todo.attempted:
            documents = corpus.documents
            if corpus.pruned_by_mtime:
                limits = [F.timestamp_micros(F.lit(t)) for t in (todo.oldest, todo.newest)]
                documents = documents.where(F.col("mtime").between(*limits))
            if todo.skipped:
                documents = _without_skipped(documents, plan, attempted)
            repeated = names.where((F.col("copies") > 1) & F.col("doc_id").isNotNull()).select("doc_id")
            if not repeated.isEmpty():
                documents = _without_repeats(documents, repeated)
            wrote = self._index_documents(documents, run)
            if wrote is not None:
                indexed = self._read_run("document", run).select("doc_id")
        settled = settle_failures(plan, indexed).unionByName(surplus_rows(names), allowMissingColumns=True)
        actions = self._materialize(settled, f"actions/run={run}")

        replaced = actions.where(F.col("action").isin("updated", "deleted") & F.col("usable")).select("doc_id")
        void = replaced.withColumn("sequence", F.lit(None).cast("long"))
        if "sequence" in named.columns:
            # A deletion is kept with its place in the order of changes, also if there was nothing to delete.
            deleted = named.where("deleted").select("doc_id", "sequence")
            void = replaced.join(deleted, "doc_id", "full_outer")
        removed = {} if void.isEmpty() else self._write_removed(void, run)
        dropped = state.dropped | unusable
        batches = dict(state.batches)
        if unusable:
            left = {r for r, _ in set(parts["document"]) - unusable}
            batches = {r: b for r, b in batches.items() if r in left}
        if wrote is not None:
            batches[run] = wrote[0]
        dropped = frozenset((r, p) for r, p in dropped if r in batches)
        after = State(run, batches, state.removed | removed, dropped)
        self._commit(after, wrote[1] if wrote else [])
        self._merge_tiers(after)
        return build_summary(actions)

    def apply_changes(self, changes: DataFrame, order: Column | None = None) -> DataFrame:
        """Upsert and delete by change rows ``(doc_id, text [, deleted])``.

        With ``order``, a whole number or a time, the last row of each document
        counts, and only if the index knows none of later order; deletions are
        remembered for that. Without, there is one row per document.
        """
        if order is None:
            return self.sync(table_corpus(changes), partial=True)
        latest = latest_rows(changes.withColumn("sequence", _as_long(changes, order)), F.col("sequence"))
        state = self._state()
        stored = self._live("document", state).select("doc_id", "sequence")
        known = stored.unionByName(self._removed(state).select("doc_id", "sequence")).where("sequence IS NOT NULL")
        named = latest.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("sequence").alias("_sequence"))
        known = known.join(broadcast_if_small(named), "doc_id").where("sequence > _sequence").select("doc_id")
        late = self._materialize(known.distinct(), f"late/run={state.run + 1}")
        current = latest.withColumn("doc_id", F.col("doc_id").cast("string"))
        return self.sync(table_corpus(current.join(broadcast_if_small(late), "doc_id", "left_anti")), partial=True)

    def rebuild_postings(self, runs: Iterable[int] | None = None) -> None:
        """Write the postings of ``runs`` again, by default of all, from the stored lines.

        They go to new folders; readers of the last commit see no change.
        """
        state = self._state()
        batches, last = dict(state.batches), state.run
        for run in sorted(batches if runs is None else set(runs).intersection(batches)):
            last += 1
            lines = self._live("line", state, [run]).where((F.col("index_version") == self.version) & F.col("doc_id").isNotNull())
            fixed = {"run": run, "index_version": self.version}
            batches[run] = self._write_postings(self._postings_of(lines), last, _extent(self._live("document", state, [run])), fixed)
        if last > state.run:
            self._commit(State(last, batches, state.removed, state.dropped), [])

    def _repair_postings(self) -> None:
        """Rebuild postings that are missing, corrupt or fewer than were written."""
        state = self._state()
        if not state.batches:
            return
        expected = sum(batch.n for batch in state.batches.values())
        rows = lambda runs: lambda: self._read_batches(state, runs)
        if _is_readable(rows(state.batches), expected):
            return
        damaged = [r for r, batch in state.batches.items() if not _is_readable(rows([r]), batch.n)]
        self.rebuild_postings(damaged)

    def _read_batches(self, state: State, runs: Iterable[int]) -> DataFrame:
        paths = [f"{self.root}/postings/{state.batches[r].path}" for r in runs]
        return self.spark.read.schema(POSTINGS).option("basePath", f"{self.root}/postings").parquet(*paths)

    def compact(self) -> None:
        """Gather the parts of all runs into one run, without any row that no longer holds."""
        state = self._state()
        if state.batches:
            self._merge(state, list(state.batches))

    def purge(self, unused_for: timedelta = timedelta(days=7)) -> None:
        """Remove the rows of deleted and replaced documents from the disk.

        Runs with such rows are written again without them. Folders that the last
        commit does not name are removed once they have been unused for the given
        time; readers of older commits have so long to finish. Work tables and
        folders that an unfinished run may still write are kept as long.
        """
        state = self._state()
        affected = self._void_runs(state)
        if affected:
            state = self._merge(state, affected)
        named = {
            "store": {f"run={r}" for r in state.batches},
            "postings": {f"batch={batch.folder}" for batch in state.batches.values()},
            "removed": {f"run={r}" for r in state.removed},
            "commits": {f"run={r}" for r in (*state.batches, state.run)},
            "names": set(), "plan": set(), "late": set(),
        }
        jvm = self.spark._jvm
        top = jvm.org.apache.hadoop.fs.Path(self.root)
        files = top.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        before = jvm.java.lang.System.currentTimeMillis() - int(unused_for.total_seconds() * 1000)
        for table, used in named.items():
            # One status per run.
            for status in files.globStatus(jvm.org.apache.hadoop.fs.Path(top, f"{table}/*")) or []:
                name = status.getPath().getName()
                if name not in used and status.getModificationTime() <= before and int(name.split("=")[1]) <= state.run:
                    files.delete(status.getPath(), True)

    def _void_runs(self, state: State) -> list[int]:
        """Runs with rows that no longer hold, or with dropped parts."""
        whole = self._live("document", State(state.run, state.batches, {}, state.dropped))
        removed = self._removed(state).select("doc_id", "removed_run")
        void = whole.join(broadcast_if_small(removed), "doc_id").where("run < removed_run") if state.removed else None
        # At most one row per live run.
        found = {r.run for r in void.select("run").distinct().collect()} if void is not None else set()
        return sorted(found | {r for r, _ in state.dropped})

    def _merge_tiers(self, state: State) -> None:
        """Merge runs of one tier when there are ``FANOUT`` of them."""
        while True:
            tiers: dict[int, list[int]] = {}
            for run, batch in state.batches.items():
                tier = 0
                while batch.n >= TIER_ROWS * FANOUT**tier:
                    tier += 1
                tiers.setdefault(tier, []).append(run)
            full = [runs for runs in tiers.values() if len(runs) >= FANOUT]
            if not full:
                return
            state = self._merge(state, full[0])

    def _merge(self, state: State, runs: list[int]) -> State:
        """Write what holds of ``runs`` as one new run."""
        run = state.run + 1
        extent = _extent(self._live("document", state, runs))
        parts = min(MAX_PARTS, 1 + extent[0] // PART_BYTES)
        place = F.pmod(F.xxhash64("run", "part"), F.lit(parts)).cast("int")
        tables = [self._live(t, state, runs).withColumn("part", place).drop("run") for t in ("document", "line")]
        self._overwrite(tables[0].unionByName(tables[1]).hint("rebalance", "kind", "part"), f"{self.root}/store/run={run}", "kind", "part")
        postings = self._live("postings", state, runs).where(F.col("run").isin(runs)).withColumn("part", place)
        batches = {r: b for r, b in state.batches.items() if r not in runs} | {run: self._write_postings(postings, run, extent, {"run": run}, by_word=_few_removed(state))}
        # A removal matters while an earlier run is left, or for the order of changes to come.
        earliest = min(batches)
        left = self._removed(state).where((F.col("removed_run") > earliest) | F.col("sequence").isNotNull()) if state.removed else None
        removed = self._write_removed(left, run) if left is not None else {}
        after = State(run, batches, removed, frozenset(p for p in state.dropped if p[0] in batches))
        self._commit(after, self._written_parts(run))
        return after

    def _materialize(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table of the run and read it back: later steps see one fixed state."""
        self._overwrite(df, f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def _overwrite(self, df: DataFrame, path: str, *partitions: str, at_once: int = 8, **options: str) -> None:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("parquet.block.size", ROW_GROUP_BYTES).options(**options)
        if partitions:
            writer = writer.partitionBy(*partitions)
        with _files_at_once(df.sparkSession, at_once):
            writer.parquet(path)

    def _index_documents(self, documents: DataFrame, run: int) -> tuple[Batch, list[tuple[str, int]]] | None:
        """Lines and postings of the readable documents, each text read once; the postings' place, and the parts. None if there are no such documents."""
        readable = documents.where(F.col("text").isNotNull())
        if "sequence" not in readable.columns:
            readable = readable.withColumn("sequence", F.lit(None).cast("long"))
        about = [*FINGERPRINT, "sequence"]
        arrays = with_line_arrays(readable, self.split_mode, self.fold_mode)
        # Element 0 stands for the document itself, which so exists even without lines.
        elements = F.concat(F.array(F.lit(None).cast("string")), "_lines")
        rows = arrays.select(
            "doc_id",
            *about,
            (F.spark_partition_id() % MAX_PARTS).alias("part"),
            "_start",
            "_end",
            F.posexplode(elements).alias("line_no", "line"),
        )
        is_document = F.col("line_no") == 0
        stored = rows.select(
            "doc_id",
            "line_no",
            "line",
            (~is_document & is_searchable(F.col("line_no"))).alias("searchable"),
            *[F.when(is_document, F.col(c)).alias(c) for c in about],
            F.lit(self.version).alias("index_version"),
            F.when(is_document, "document").otherwise("line").alias("kind"),
            "part",
        )
        self._overwrite(stored, f"{self.root}/store/run={run}", "kind", "part")
        parts = self._written_parts(run)
        if not parts:
            return None
        extent = _extent(self._read_run("document", run))
        fixed = {"run": run, "index_version": self.version}
        return self._write_postings(self._postings_of(self._read_run("line", run)), run, extent, fixed), parts

    def _written_parts(self, run: int) -> list[tuple[str, int]]:
        """``(table, part)`` of what a run has written, by the names of its folders."""
        base = f"{self.root}/store/run={run}"
        files = self.spark.read.schema(STORE).option("basePath", f"{self.root}/store").parquet(base).inputFiles()
        return sorted({(t, int(n)) for f in files for t, n in re.findall(r"/kind=(\w+)/part=(\d+)/", f)})

    def _postings_of(self, lines: DataFrame) -> DataFrame:
        lines = lines.select("doc_id", "line_no", "line", "searchable", "index_version", "run", "part")
        return line_postings(lines, self.fold_mode, self.stopwords)

    def _write_postings(self, postings: DataFrame, folder: int, extent: tuple[int, int], fixed: dict[str, int], by_word: bool = False) -> Batch:
        """Write postings by bucket; the one shuffle of a build. ``fixed`` are columns of one value, which are not moved.

        Rows are packed and words brought together before the shuffle too: then
        neighbours differ little and compress to about half. That goes by a hash,
        as numbers are sorted much faster, and is left out if rows are read from
        files sorted ``by_word``. ``extent`` has the bytes of text and the documents.
        """
        text_size, documents = extent
        buckets = 1
        while buckets * BUCKET_BYTES < text_size and buckets < MAX_BUCKETS:
            buckets *= 2
        columns = ["term", "doc_id", "line_no", "pos", "index_version", "run", "part"]
        bucket = F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")
        moved = [c for c in ("index_version", "run") if c not in fixed]
        rows = postings.select("part", *moved, "doc_id", "term", bucket.alias("bucket"), packed_place().alias("place"))
        if not by_word:
            rows = rows.sortWithinPartitions(F.shiftleft(F.col("bucket").cast("long"), 48).bitwiseOR(F.shiftrightunsigned(F.xxhash64("term"), 16)))
            # Not to be known before it runs, or else the optimizer takes the sort out.
            rows = rows.withColumn("part", F.col("part") + F.spark_partition_id() * 0)
        # Small buckets share a task and a bucket with a common word is split over several, both at run time.
        rows = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term")
        unpacked = {
            **unpacked_place(F.col("place")),
            **{c: F.lit(n).cast({"run": "long", "index_version": "int"}[c]) for c, n in fixed.items()},
        }
        rows = rows.select(*[unpacked.get(c, F.col(c)).alias(c) for c in columns], "bucket")
        batch = Batch(folder, buckets, 0)
        path = f"{self.root}/postings/{batch.path}"
        bounds = {"spark.sql.files.maxPartitionBytes": SORTED_BYTES, "spark.sql.adaptive.advisoryPartitionSizeInBytes": SHUFFLED_BYTES}
        with _at_most(self.spark, bounds):
            # Rows come sorted by bucket, so one file is open at a time.
            dictionary = {"parquet.enable.dictionary#doc_id": str(documents <= NAMED_DOCUMENTS).lower()}
            self._overwrite(rows, path, "bucket", at_once=0, **dictionary)
        written = self.spark.read.schema(POSTINGS).option("basePath", f"{self.root}/postings").parquet(path)
        return replace(batch, n=written.count())

    def _write_removed(self, void: DataFrame, run: int) -> dict[int, tuple[int, int]]:
        """Keep ``(doc_id, sequence)`` as removed by ``run``, unless the rows say by which; how many and how long they are."""
        by = F.col("removed_run") if "removed_run" in void.columns else F.lit(run).cast("long")
        rows = self._materialize(void.select("doc_id", "sequence", by.alias("removed_run")), f"removed/run={run}")
        found = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("doc_id")).alias("bytes")).first()
        return {run: (found.n, found.bytes or 0)} if found.n else {}

    def _commit(self, state: State, parts: list[tuple[str, int]]) -> None:
        """Publish ``state`` and the parts that its run wrote."""
        rows: list[tuple] = [(None,) * 6]  # so that an empty index has a commit as well
        rows += [("run", r, b.buckets, b.folder, b.n, None) for r, b in state.batches.items()]
        rows += [("removed", r, None, None, n, size) for r, (n, size) in state.removed.items()]
        rows += [("dropped", r, p, None, None, None) for r, p in state.dropped]
        rows += [(table, state.run, p, None, None, None) for table, p in parts]
        schema = COMMITS.removesuffix(", run bigint")
        self._overwrite(self.spark.createDataFrame(rows, schema).coalesce(1), f"{self.root}/commits/run={state.run}")


def _runs_of(table: DataFrame) -> list[int]:
    """Runs with a folder, by the names of their files; reads none."""
    return sorted({int(n) for f in table.inputFiles() for n in re.findall(r"/run=(\d+)/[^/]*$", f)})


def _few_removed(state: State) -> bool:
    n, size = (sum(x[i] for x in state.removed.values()) for i in (0, 1))
    return n <= REMOVED_ROWS and size + 16 * n <= REMOVED_BYTES


def _extent(documents: DataFrame) -> tuple[int, int]:
    """Bytes of the texts, and how many they are."""
    size, n = documents.agg(F.sum("size"), F.count("*")).first()
    return size or 0, n


def latest_rows(changes: DataFrame, order: Column) -> DataFrame:
    """The last row of each document; a plain aggregate, so map-side combined."""
    rest = [c for c in changes.columns if c != "doc_id"]
    latest = changes.groupBy("doc_id").agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return latest.select("doc_id", *[F.col(f"_row.{c}").alias(c) for c in rest])


def _as_long(changes: DataFrame, order: Column) -> Column:
    kind = changes.select(order.alias("_order")).schema["_order"].dataType.simpleString()
    if kind == "date":
        order, kind = order.cast("timestamp"), "timestamp"
    return F.unix_micros(order.cast("timestamp")) if kind.startswith("timestamp") else order.cast("long")


def _without_skipped(documents: DataFrame, plan: DataFrame, attempted: Column) -> DataFrame:
    """The documents to read, moving no text if few changed or all but few did."""
    changed = plan.where(attempted).select("doc_id")
    skipped = plan.where(F.col("action") == "skipped").select("doc_id")
    if not is_small(changed) and is_small(skipped):
        return documents.join(F.broadcast(skipped), "doc_id", "left_anti")
    return documents.join(broadcast_if_small(changed), "doc_id", "left_semi")


@contextmanager
def _files_at_once(spark: SparkSession, n: int) -> Iterator[None]:
    """Let a task write its few parts side by side, instead of sorting all its rows by part first.

    Beyond this number of parts Spark itself goes back to sorting.
    """
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(n)}):
        yield


@contextmanager
def _at_most(spark: SparkSession, sizes: dict[str, int]) -> Iterator[None]:
    """Bound settings of bytes; those that are smaller already stay."""
    size_of = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    with settings(spark, {k: str(n) for k, n in sizes.items() if size_of(spark.conf.get(k)) > n}):
        yield


def _without_repeats(documents: DataFrame, repeated: DataFrame) -> DataFrame:
    """One row per name; only the text of repeated names is moved, if they are few."""
    names = broadcast_if_small(repeated)
    once = documents.join(names, "doc_id", "left_anti")
    chosen = one_row_per_name(documents.join(names, "doc_id", "left_semi")).drop("copies")
    return once.unionByName(chosen)


def _is_readable(open_table: Callable[[], DataFrame], expected: int | None = None) -> bool:
    """Are all files there and intact, with as many rows as expected? Counting rows reads file footers only.

    Any error but that of missing or corrupt files is raised: a lost executor
    or a denied read is no damage.
    """
    try:
        found = open_table().agg(F.count(F.lit(1))).first()[0]
    except (PySparkException, Py4JJavaError) as error:
        message = str(error)
        if any(sign in message for sign in DENIED) or not any(sign in message for sign in DAMAGE):
            raise
        return False
    return expected is None or found == expected
