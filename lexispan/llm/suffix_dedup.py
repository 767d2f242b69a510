"""Removing passages that occurred before: every byte of a repeated ``length``-byte string.

A byte goes if a ``length``-byte string over it also starts earlier: in a
document of smaller id, or further ahead in the same one. Matches never cross
documents and are judged on the input, so overlapping copies count.

1. *Anchors.* Of the ``gram``-byte strings in each ``length``-byte window the
   one of least hash is an anchor, so equal windows hold equal anchors at the
   same place. A global sort by (anchor, context, document, place) brings equal
   ones together; it splits common anchors over as many tasks as they need.
2. *Whole contexts.* An anchor whose entire context (all windows around it)
   occurred earlier is settled by that sort: all its windows are repeated.
3. *Column-wise suffix sorting.* What remains are the first occurrences of each
   context of anchors with several contexts. Their strings are sorted together
   by suffixes, one symbol of every string per round, from the right: the order
   after a round, the symbols in that order (the strings' Burrows-Wheeler
   column) and the lengths of common prefixes give those of the next round.
   Suffixes with a common prefix of a whole window are equal windows; all but
   the earliest are repeated. A task holds one bounded chunk at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexispan.llm.textbytes import SMALL_SLICE_BYTES, gram_hashes, mixed, utf8_slices
from lexispan.llm.workers import lean
from lexispan.operators.keys import broadcast_if_small
from lexispan.sources.workspace import materialized

LENGTH = 100
GRAM = 32

# Contexts sorted at a time, and from which number on one anchor's contexts are
# compared by a distributed aggregation instead.
CHUNK = 1 << 15
LARGEST_GROUP = 1 << 17

KEY = ["_id", "_sub"]
PLACE = [*KEY, "pos"]
REPEATED, SEVERAL, EDGE = 0, 1, 2


def repeated_spans(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    length: int = LENGTH, gram: int = GRAM, largest_group: int = LARGEST_GROUP,
) -> DataFrame:
    """Every row of ``docs`` as ``_row``, its ``_text``, and ``_spans``: repeated byte ranges ``(start, stop)``, which may overlap.

    A null text is empty. A null id counts as the smallest. Documents that
    share an id are told apart by their texts; rows equal in both are one
    document and get the same spans. Null ``_spans`` means none.
    """
    side = length - gram
    keyed = _keyed(docs, id_column, text_column)
    id_type = keyed.schema["_id"].dataType.simpleString()
    once = keyed.where("_sub = 0").select(*KEY, "_text").unionByName(
        keyed.where("_sub <> 0").select(*KEY, "_text").dropDuplicates(KEY)
    ) if _has_repeated_ids(keyed) else keyed.select(*KEY, "_text")
    order = ["h", "ctx", *PLACE]
    anchors = once.mapInArrow(lean(_anchor_finder(length, gram)), f"h long, ctx long, _id {id_type}, _sub long, pos long")
    ordered = anchors.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = materialized(ordered.mapInArrow(lean(_mark_runs), f"_id {id_type}, _sub long, pos long, h long, mark int, ctx long, last_ctx long, part int, last boolean"))
    marks = marked.where(F.col("mark") != EDGE).select(*PLACE, "h", "mark").unionByName(_edges_settled(marked))

    several = marks.where(F.col("mark") == SEVERAL)
    wanted = several.groupBy(*KEY).agg(F.collect_list(F.struct("pos", "h")).alias("_wanted"))
    contexts = _join(once, wanted).mapInArrow(
        lean(_context_cutter(length, gram)), f"h long, _id {id_type}, _sub long, pos long, at int, context binary"
    )
    large = several.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > largest_group).select("h")
    large = materialized(large)
    columns = f"_id {id_type}, _sub long, start long, stop long"
    if large.limit(1).count():
        common = _common_windows(contexts.join(broadcast_if_small(large), "h", "left_semi"), length, gram)
        contexts = contexts.join(broadcast_if_small(large), "h", "left_anti")
    else:
        common = None
    grouped = contexts.repartition("h").sortWithinPartitions("h", *PLACE)
    spans = grouped.mapInArrow(lean(_column_sorter(length, gram)), columns)
    whole = marks.where(F.col("mark") == REPEATED).select(
        *KEY, F.greatest(F.col("pos") - side, F.lit(0)).alias("start"), (F.col("pos") + length).alias("stop")
    )
    every = spans.unionByName(whole)
    if common is not None:
        every = every.unionByName(common)
    lists = every.groupBy(*KEY).agg(F.collect_list(F.struct("start", "stop")).alias("_spans"))
    return _join(keyed, lists, "left").select("_row", "_text", "_spans")


def kept_bytes(text: str | None, spans: list | None) -> tuple[bytes, int, int, int]:
    """``(bytes that stay, bytes before, bytes removed, maximal removed runs)``."""
    data = (text or "").encode()
    gone = merged_spans(spans, len(data))
    pieces, at = [], 0
    for start, stop in gone:
        pieces.append(data[at:start])
        at = stop
    pieces.append(data[at:])
    return b"".join(pieces), len(data), sum(b - a for a, b in gone), len(gone)


def kept_text(text: str | None, spans: list | None) -> str | None:
    """The text without its removed characters; one of which any byte stays is kept whole."""
    if text is None or spans is None:
        return text
    data = text.encode()
    pieces, at = [], 0
    for start, stop in merged_spans(spans, len(data)):
        # Continuation bytes at either end belong to a character that stays.
        while start < stop and data[start] & 0xC0 == 0x80:
            start += 1
        if stop < len(data):
            while stop > start and data[stop] & 0xC0 == 0x80:
                stop -= 1
        pieces.append(data[at:start])
        at = stop
    pieces.append(data[at:])
    return b"".join(pieces).decode()


def merged_spans(spans: list | None, n: int) -> list[tuple[int, int]]:
    """Overlapping and adjacent ``(start, stop)`` as maximal runs within ``n`` bytes."""
    if spans is None or not len(spans):
        return []
    both = np.array([(s["start"], s["stop"]) for s in spans], np.int64)
    both[:, 1] = np.minimum(both[:, 1], n)
    both = both[np.argsort(both[:, 0], kind="stable")]
    reach = np.maximum.accumulate(both[:, 1])
    first = np.flatnonzero(np.concatenate([[True], both[1:, 0] > reach[:-1]]))
    last = np.concatenate([first[1:], [len(both)]]) - 1
    return list(zip(both[first, 0].tolist(), reach[last].tolist()))


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` with the repeated passages cut out of the text column; other columns and all rows stay."""
    schema = docs.schema

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = dict(zip(schema.names, batch["_row"].flatten()))
            texts = [kept_text(t, s) for t, s in zip(own[text_column].to_pylist(), batch["_spans"].to_pylist())]
            own[text_column] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(list(own.values()), names=schema.names)

    return repeated_spans(docs, id_column, text_column, **options).select("_row", "_spans").mapInArrow(lean(cut), schema)


def removal_digest(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256)`` of every row."""
    id_field = T.StructField(id_column, docs.schema[id_column].dataType)
    schema = T.StructType([id_field]).add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [kept_bytes(t, s) for t, s in zip(batch["_text"].to_pylist(), batch["_spans"].to_pylist())]
            counts = [pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2, 3)]
            digests = pa.array([hashlib.sha256(r[0]).hexdigest() for r in rows], pa.string())
            yield pa.RecordBatch.from_arrays([batch["_id"], *counts, digests], names=schema.names)

    spans = repeated_spans(docs.select(id_column, text_column), id_column, text_column, **options)
    return spans.select(F.col("_row").getField(id_column).alias("_id"), "_text", "_spans").mapInArrow(lean(digest), schema)


# -- documents and their keys ------------------------------------------------


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Adds ``_id``, ``_text`` and ``_sub``, a hash of the text where an id is shared (0 elsewhere)."""
    plain = docs.select(F.struct("*").alias("_row"), F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    shared = materialized(
        docs.groupBy(F.col(id_column).alias("_id")).agg(F.count("*").alias("n")).where("n > 1").select("_id")
    )
    if not shared.limit(1).count():
        return plain.withColumn("_sub", F.lit(0).cast("long"))
    marked = plain.alias("d").join(
        broadcast_if_small(shared.withColumn("_shared", F.lit(True))).alias("s"), F.col("d._id").eqNullSafe(F.col("s._id")), "left"
    ).select("d.*", "_shared")
    sub = F.when(F.col("_shared"), F.xxhash64("_text").bitwiseOR(F.lit(1))).otherwise(F.lit(0))
    return marked.withColumn("_sub", sub).drop("_shared")


def _has_repeated_ids(keyed: DataFrame) -> bool:
    """Does ``_sub`` depend on the row at all?"""
    return bool(keyed.where("_sub <> 0").limit(1).count())


def _join(docs: DataFrame, lists: DataFrame, how: str = "inner") -> DataFrame:
    on = F.col("d._id").eqNullSafe(F.col("l._id")) & (F.col("d._sub") == F.col("l._sub"))
    added = [F.col(f"l.{c}") for c in lists.columns if c not in KEY]
    return docs.alias("d").join(lists.alias("l"), on, how).select("d.*", *added)


# -- anchors -----------------------------------------------------------------


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` neighbours."""
    out, done = values, 1
    while done * 2 <= width:
        out = pick(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return pick(out[:-rest], out[rest:]) if rest else out


def find_anchors(h: np.ndarray, n: int, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(places, hashes, hashes of the whole context)`` of one document's anchors; ``h`` hashes its grams."""
    side = length - gram
    least = _sliding(h, side + 1, np.minimum)
    edge = np.zeros(side, np.uint64)
    chosen = np.flatnonzero(h == _sliding(np.concatenate([edge, least, edge]), side + 1, np.maximum))
    low, high = np.maximum(chosen - side, 0), np.minimum(chosen + length, n)
    context = (chosen - low).astype(np.uint64) * np.uint64(2 * length + 1) + (high - chosen).astype(np.uint64)
    for step in range(0, side + length, gram):
        context = mixed(context) + h[np.minimum(low + step, high - gram)]
    return chosen, h[chosen], mixed(context)


def _anchor_finder(length: int, gram: int):
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in utf8_slices(batch["_text"], SMALL_SLICE_BYTES):
                if len(data) < length:
                    continue
                grams = gram_hashes(data, gram)
                rows, parts = [], []
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                    if b - a >= length:
                        found = find_anchors(grams[a : b - gram + 1], b - a, length, gram)
                        rows.append(np.full(len(found[0]), first + i))
                        parts.append(found)
                if not rows:
                    continue
                rows = pa.array(np.concatenate(rows))
                pos, h, ctx = (np.concatenate([p[i] for p in parts]) for i in range(3))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(ctx.view(np.int64)), batch["_id"].take(rows), batch["_sub"].take(rows), pa.array(pos)],
                    names=["h", "ctx", "_id", "_sub", "pos"],
                )

    return find


def _mark_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks of one sorted partition; memory holds a batch and one pending row.

    ``REPEATED``: the same anchor in the same context came before.
    ``SEVERAL``: the first of a context, of an anchor with several. The first
    rows of the first and the last anchor are ``EDGE`` rows instead, as their
    anchors may go on in neighbouring partitions.
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    names = ["_id", "_sub", "pos", "h", "mark", "ctx", "last_ctx", "part", "last"]
    pending = None  # first row of the current anchor: [one-row batch, has several contexts, is the partition's first]
    last_h = last_ctx = None

    def edge(state, last_ctx: int, last: bool) -> pa.RecordBatch:
        # Contexts are sorted, so a second one shows as a last context that differs from the first.
        row = state[0]
        told = [pa.array([EDGE], pa.int32()), row["ctx"], pa.array([last_ctx], pa.int64()), pa.array([part], pa.int32()), pa.array([last])]
        return pa.RecordBatch.from_arrays([row["_id"], row["_sub"], row["pos"], row["h"], *told], names=names)

    def marks(batch: pa.RecordBatch, rows: np.ndarray, mark: np.ndarray) -> pa.RecordBatch:
        taken = batch.take(pa.array(rows))
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [taken["_id"], taken["_sub"], taken["pos"], pa.array(np.where(mark == SEVERAL, taken["h"].to_numpy(), 0)), pa.array(mark.astype(np.int32)),
             pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.bool_())],
            names=names,
        )

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        h, ctx = batch["h"].to_numpy(), batch["ctx"].to_numpy()
        new_h, new_ctx = np.ones(n, bool), np.ones(n, bool)
        new_h[1:] = h[1:] != h[:-1]
        new_ctx[1:] = new_h[1:] | (ctx[1:] != ctx[:-1])
        if pending is not None:
            new_h[0] = h[0] != last_h
            new_ctx[0] = new_h[0] or ctx[0] != last_ctx
        mark = np.where(new_ctx, SEVERAL, REPEATED)
        starts = np.flatnonzero(new_h)
        keep = ~new_h  # the first rows of anchors are decided when their anchor ends
        until = starts[0] if len(starts) else n
        if pending is not None and new_ctx[:until].any():
            pending[1] = True
        if len(starts):
            if pending is not None:
                end_ctx = int(ctx[until - 1]) if until else last_ctx
                if pending[2]:
                    yield edge(pending, end_ctx, False)
                elif pending[1]:
                    yield marks(pending[0], np.array([0]), np.array([SEVERAL]))
            counts = np.add.reduceat(new_ctx, starts, dtype=np.int64)
            several = counts > 1
            is_first = pending is None
            keep[starts[:-1]] = several[:-1]
            if is_first and len(starts) > 1:
                keep[0] = False
                yield edge([batch.slice(0, 1), bool(several[0]), True], int(ctx[starts[1] - 1]), False)
            final = int(starts[-1])
            pending = [batch.slice(final, 1), bool(several[-1]), is_first and len(starts) == 1]
        rows = np.flatnonzero(keep)
        if len(rows):
            yield marks(batch, rows, mark[rows])
        last_h, last_ctx = h[-1], int(ctx[-1])
    if pending is not None:
        yield edge(pending, last_ctx, True)


def _edges_settled(marked: DataFrame) -> DataFrame:
    """Marks of the edge rows: at most two of each partition, so few enough for the driver."""
    rows = marked.where(F.col("mark") == EDGE).collect()
    rows.sort(key=lambda r: (r["part"], r["last"]))
    settled, at = [], 0
    while at < len(rows):
        end = at + 1
        while end < len(rows) and rows[end]["h"] == rows[at]["h"]:
            end += 1
        chain = rows[at:end]
        several = len({c for r in chain for c in (r["ctx"], r["last_ctx"])}) > 1
        for i, r in enumerate(chain):
            if i and chain[i - 1]["last_ctx"] == r["ctx"]:
                settled.append((*(r[c] for c in PLACE), r["h"], REPEATED))
            elif several:
                settled.append((*(r[c] for c in PLACE), r["h"], SEVERAL))
        at = end
    columns = marked.select(*PLACE, "h", "mark")
    return columns.sparkSession.createDataFrame(settled, columns.schema)


# -- contexts and their suffixes ---------------------------------------------


def _context_cutter(length: int, gram: int):
    side = length - gram

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch["_wanted"].to_pylist()
            for i, text in enumerate(batch["_text"].to_pylist()):
                data = text.encode()
                places = [w["pos"] for w in wanted[i]]
                n = len(places)
                rows = pa.array([i] * n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([w["h"] for w in wanted[i]], pa.int64()), batch["_id"].take(rows), batch["_sub"].take(rows), pa.array(places, pa.int64()),
                        pa.array([min(p, side) for p in places], pa.int32()), pa.array([data[max(0, p - side) : p + length] for p in places], pa.binary()),
                    ],
                    names=["h", "_id", "_sub", "pos", "at", "context"],
                )

    def gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Few large batches instead of one per document."""
        held, n = [], 0
        for batch in cut(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= 8192:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return gathered


def repeated_windows(symbols: np.ndarray, side: int) -> np.ndarray:
    """Which windows of which strings occur in an earlier string.

    ``symbols`` has a row per string, in order of first occurrence: ``side``
    symbols to the left, one for the shared gram, ``side`` to the right; a
    negative symbol lies outside the text and equals nothing. Returned are a
    row per string and a column per start, 0 to ``side`` symbols left of the gram.

    Each round prepends one symbol to the suffix of every string: a stable sort
    by that symbol of the order so far is the new order. Neighbours with the
    same symbol have one more symbol in common than the least common prefix
    between their places in the order before.
    """
    n, width = symbols.shape
    order = np.arange(n)
    common = np.zeros(n, np.int32)  # with the string before, in the current order
    window = side + 1
    repeated = np.zeros((n, side + 1), bool)
    for column in range(width - 1, -1, -1):
        front = symbols[order, column]
        moved = np.argsort(front, kind="stable")
        front = front[moved]
        same = np.zeros(n, bool)
        same[1:] = (front[1:] == front[:-1]) & (front[1:] >= 0)
        lowest = np.zeros(n, np.int32)
        if same.any():
            lowest[same] = _range_minima(common, moved[:-1][same[1:]] + 1, moved[1:][same[1:]] + 1)
        common = np.where(same, np.minimum(lowest + 1, window), 0).astype(np.int32)
        order = order[moved]
        start = side - column
        if start >= 0:
            heads = np.flatnonzero(common < window)
            earliest = np.minimum.reduceat(order, heads)
            repeated[order, start] = order > np.repeat(earliest, np.diff(np.append(heads, n)))
    return repeated


def _range_minima(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Minimum of ``values[start:stop]`` for every pair, from minima over powers of two."""
    levels = np.frexp((stop - start).astype(np.float64))[1] - 1
    out = np.empty(len(start), values.dtype)
    table = values
    for level in range(int(levels.max()) + 1):
        if level:
            half = 1 << (level - 1)
            table = np.minimum(table[:-half], table[half:])
        here = levels == level
        if here.any():
            out[here] = np.minimum(table[start[here]], table[stop[here] - (1 << level)])
    return out


def _column_sorter(length: int, gram: int):
    side = length - gram

    def solve(table: pa.Table) -> pa.RecordBatch | None:
        n = table.num_rows
        at = table["at"].to_numpy()
        offsets = np.frombuffer(table["context"].combine_chunks().buffers()[1], np.int32)[: n + 1].astype(np.int64)
        data = np.frombuffer(table["context"].combine_chunks().buffers()[2], np.uint8)
        begin, size = offsets[:-1], np.diff(offsets)
        symbols = np.full((n, 2 * side + 1), -1, np.int16)
        for k in range(side):
            left, right = at - 1 - k, at + gram + k
            has = left >= 0
            symbols[has, side - 1 - k] = data[begin[has] + left[has]]
            has = right < size
            symbols[has, side + 1 + k] = data[begin[has] + right[has]]
        grams = data[(begin + at)[:, None] + np.arange(gram)]
        named = np.concatenate([table["h"].to_numpy()[:, None].view(np.uint8).reshape(n, 8), grams], axis=1)
        group = np.unique(np.ascontiguousarray(named).view(f"V{named.shape[1]}").ravel(), return_inverse=True)[1]
        symbols = symbols.astype(np.int32)
        symbols[:, side] = group
        # Rows arrive by anchor; what counts is the order of places, within each anchor.
        repeated = repeated_windows(symbols, side)
        padded = np.zeros((n, side + 3), np.int8)
        padded[:, 1:-1] = repeated
        step = np.diff(padded, axis=1)
        row, low = np.nonzero(step == 1)
        _, high = np.nonzero(step == -1)
        if not len(row):
            return None
        pos = table["pos"].to_numpy()[row]
        taken = table.select(KEY).take(pa.array(row)).combine_chunks()
        ids = [taken[c].chunk(0) for c in KEY]
        return pa.RecordBatch.from_arrays([*ids, pa.array(pos - (high - 1)), pa.array(pos - low + length)], names=[*KEY, "start", "stop"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            h = batch["h"].to_numpy()
            if n >= CHUNK:
                # Cut where one anchor ends and the next begins.
                last = held[-1]["h"][-1].as_py()
                change = int(np.argmax(h != last)) if (h != last).any() else batch.num_rows
                held.append(batch.slice(0, change))
                n += change
                batch = batch.slice(change)
                if batch.num_rows:
                    if (out := solve(pa.Table.from_batches(held).combine_chunks())) is not None:
                        yield out
                    held, n = [], 0
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
        if held and (out := solve(pa.Table.from_batches(held).combine_chunks())) is not None:
            yield out

    return run


def _common_windows(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """The same for anchors with very many contexts: the earliest place per window by aggregation."""
    side = length - gram
    starts = F.sequence(F.lit(0), F.lit(side))
    windows = contexts.select("h", *PLACE, "at", "context", F.explode(starts).alias("back")).where("back <= at")
    piece = F.substring(F.col("context"), F.col("at") - F.col("back") + 1, F.lit(length))
    windows = windows.withColumn("piece", piece).where(F.octet_length("piece") == length)
    windows = windows.select("h", "back", F.sha2("piece", 256).alias("digest"), F.struct(*PLACE).alias("place"))
    same = ["h", "back", "digest"]
    earliest = windows.groupBy(*same).agg(F.min("place").alias("earliest"))
    later = windows.join(earliest, same).where("place <> earliest")
    start = F.col("place.pos") - F.col("back")
    return later.select(*[F.col(f"place.{c}").alias(c) for c in KEY], start.alias("start"), (start + length).alias("stop"))


# -- the same in SQL -----------------------------------------------------------


def oracle() -> str:
    """Every window of 100 bytes, two hexadecimal digits a byte; all but the first of equal ones cover what goes."""
    return """
WITH hexed AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
starts AS (SELECT doc_id, h, unnest(range(n - 99)) AS i FROM hexed WHERE n >= 100),
windows AS (SELECT doc_id, i, sha256(substr(h, 2 * i + 1, 200)) AS w FROM starts),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1),
islands AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS island FROM (
    SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM again)),
spans AS (SELECT doc_id, island, min(i) AS a, max(i) + 100 AS b FROM islands GROUP BY doc_id, island),
gaps AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
    UNION ALL SELECT doc_id, max(b), NULL FROM spans GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, n) - a)), '' ORDER BY a) AS k FROM gaps JOIN hexed USING (doc_id) GROUP BY doc_id),
counted AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM hexed LEFT JOIN counted USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
