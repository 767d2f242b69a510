"""SentencePiece encoding as a relational lattice, and decoding.

1. Texts become *units*: a run of space marks with the letters, or the other
   characters, after it. No piece reaches across a unit (checked when the model
   is loaded), so only distinct units are encoded.
2. Every substring of a unit up to the longest piece is a row; an equi-join to
   the piece table leaves the edges of the unit's lattice.
3. A unit's edges are gathered and folded by ``aggregate``. For a unigram model
   that is Viterbi: the path of highest total score. For a BPE model scores are
   merge ranks, and the best path by their sum is not what the model means; the
   fold then goes through the edges by rank and joins the two symbols that an
   edge spans, if it spans just two: the model's merges in their order.
4. Texts look their units up. Units up to ``HEAD`` and ``HEAD_IDS``, by frequency,
   are held by every task as sorted hashes and ids; texts with rarer ones get
   theirs by a join.

A lattice of a unit has its length times the longest piece as edges, so units of
more than ``LONGEST_UNIT`` characters (runs of letters without a space) do not
become lattices: the task that meets one applies the merges with a heap, in
memory of the unit's size. So it does with units whose hash another unit shares.
"""

from __future__ import annotations

import heapq
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexispan.llm.textbytes import _letters, code_run_hashes, utf8_slices
from lexispan.llm.workers import lean
from lexispan.sources.workspace import materialized, shared_folder

# Units that every task holds, some 20 bytes each without their ids, and the ids of all of them, four bytes each.
HEAD = 4_000_000
HEAD_IDS = 16_000_000

UNITS_PER_TASK = 20_000

# Fixed value: how a model writes a space.
MARK = "▁"

# The dictionary reaches the driver in so many pieces, one after another.
SLICES = 8

# Up to this many characters a unit is a lattice; boundaries between symbols are bits of a BIGINT.
LONGEST_UNIT = 60


@dataclass(frozen=True)
class PieceTable:
    """Pieces with ids and scores; ``byte_ids`` for characters without a piece, else ``unknown``."""

    pieces: tuple[tuple[str, int, float], ...]
    byte_ids: tuple[int, ...] | None
    unknown: int
    merges: bool  # BPE, else unigram
    prefix: bool = True  # a space is put before every text

    def __post_init__(self) -> None:
        for piece, _, _ in self.pieces:
            if len(unit_bounds(np.array([ord(c) for c in piece], np.uint32), np.array([0, len(piece)]))[0]) != 1:
                raise ValueError(f"piece {piece!r} reaches across units")

    @cached_property
    def longest(self) -> int:
        return max((len(p) for p, _, _ in self.pieces), default=1)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.pieces), "piece string, id int, score double")

    def texts(self) -> list[bytes]:
        """The bytes that each id stands for."""
        size = max([i for _, i, _ in self.pieces] + list(self.byte_ids or ()) + [self.unknown]) + 1
        out = [b""] * size
        out[self.unknown] = " ⁇ ".encode()
        for byte, i in enumerate(self.byte_ids or ()):
            out[i] = bytes([byte])
        for piece, i, _ in self.pieces:
            out[i] = piece.replace(MARK, " ").encode()
        return out


def load_pieces(path: str) -> PieceTable:
    """The table of a SentencePiece model file without normalisation rules of its own."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(model.get_piece_size())
    byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in every if model.is_byte(i)}
    pieces = tuple((model.id_to_piece(i), i, model.get_score(i)) for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)))
    # Merge ranks are whole numbers, log-probabilities are not.
    merges = all(float(score).is_integer() for _, _, score in pieces)
    return PieceTable(pieces, tuple(byte_ids[b] for b in range(256)) if len(byte_ids) == 256 else None, model.unk_id(), merges)


# -- units -------------------------------------------------------------------


def unit_bounds(codes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(begin, stop)`` of every unit of texts whose code points begin at ``places``."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mark = codes == ord(MARK)
    letter = _letters()[0][codes]
    first = np.zeros(n + 1, bool)
    first[places] = True
    begins = first[:-1].copy()
    begins[1:] |= ~mark[:-1] & (mark[1:] | (letter[1:] != letter[:-1]))
    begin = np.flatnonzero(begins)
    return begin, np.append(begin[1:], n)


def _unit_batches(column: pa.Array, prefix: bool) -> Iterator[tuple]:
    """``(first row, code points, begin, stop, hash, text bounds in units)`` of slices of texts."""
    for first, data, offsets in utf8_slices(column):
        codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        places = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        codes = np.where(codes == 0x20, np.uint32(ord(MARK)), codes)
        if prefix:
            some = np.flatnonzero(np.diff(places))
            codes = np.insert(codes, places[:-1][some], np.uint32(ord(MARK)))
            places = places + np.concatenate([[0], np.cumsum(np.diff(places) > 0)])
        begin, stop = unit_bounds(codes, places)
        yield first, codes, begin, stop, code_run_hashes(codes, begin, stop), np.searchsorted(begin, places)


def distinct_units(texts: DataFrame, prefix: bool) -> DataFrame:
    """``(unit, h, n)``: every distinct unit of ``texts._text``, but for long ones, with its hash and number of occurrences."""

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, codes, begin, stop, hashes, _ in _unit_batches(batch["_text"], prefix):
                short = np.flatnonzero(stop - begin <= LONGEST_UNIT)
                once, at, n = np.unique(hashes[short], return_index=True, return_counts=True)
                at = short[at]
                text = codes.tobytes().decode("utf-32-le")
                units = [text[a:b] for a, b in zip(begin[at].tolist(), stop[at].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(units, pa.string()), pa.array(once.view(np.int64)), pa.array(n.astype(np.int64))], names=["unit", "h", "n"])

    found = texts.select("_text").mapInArrow(lean(collect), "unit string, h long, n long")
    return found.groupBy("unit", "h").agg(F.sum("n").alias("n"))


# -- the lattice -------------------------------------------------------------


def encoded_units(units: DataFrame, model: PieceTable) -> DataFrame:
    """``units`` with ``ids``; an id below 0 stands for a character without a piece: -1 less its code point.

    The edges of a unit stay in the partition of its unit, so gathering them is no shuffle.
    """
    # Every unit has some thirty edges: few units per task keep their gathering in memory.
    n_tasks = max(1, -(-units.count() // UNITS_PER_TASK))
    units = units.repartition(n_tasks, "h")
    size = F.char_length("unit")
    starts = units.withColumn("size", size).withColumn("start", F.explode(F.sequence(F.lit(0), F.col("size") - 1)))
    lengths = F.sequence(F.lit(1), F.least(F.lit(model.longest), F.col("size") - F.col("start")))
    substrings = starts.withColumn("length", F.explode(lengths))
    substrings = substrings.withColumn("piece", F.substring(F.col("unit"), F.col("start") + 1, F.col("length")))
    # As many rows as the model has pieces.
    pieces = F.broadcast(model.table(units.sparkSession))
    edges = substrings.join(pieces, "piece", "left").where(F.col("id").isNotNull() | (F.col("length") == 1))
    unknown = -1 - F.ascii("piece")
    # The boundaries an edge covers, and those at its ends, as bits.
    one = F.lit(1).cast("long")
    covers = _shift("shiftleft", _shift("shiftleft", one, F.col("length") + 1) - 1, F.col("start"))
    ends = _shift("shiftleft", _shift("shiftleft", one, F.col("length")) + 1, F.col("start"))
    edge = F.struct(
        (-F.coalesce("score", F.lit(0.0))).alias("cost"), "start", "length", F.coalesce("id", unknown).cast("int").alias("id"),
        covers.alias("covers"), ends.alias("ends"),
    )
    kept = [F.first(c).alias(c) for c in units.columns if c != "h"]
    lattices = edges.groupBy("h").agg(*kept, F.sort_array(F.collect_list(edge)).alias("edges")).withColumn("size", size)
    if not model.merges:
        return lattices.select(*units.columns, viterbi_ids(F.col("edges"), F.col("size")).alias("ids"))
    return lattices.select(*units.columns, merged_ids(F.col("edges"), F.col("size")).alias("ids"))


def _shift(way: str, value: Column, by: Column) -> Column:
    return F.call_function(way, value, by)


def _ids_by_start(edges: Column, final) -> Column:
    chosen = F.transform(F.filter(edges, final), lambda e: F.struct(e["start"].alias("start"), e["id"].alias("id")))
    return F.transform(F.array_sort(chosen), lambda e: e["id"])


def merged_ids(edges: Column, size: Column) -> Column:
    """Merges in order of rank, leftmost first; a bit per boundary between symbols, in one BIGINT."""
    def joins(mask: Column, e: Column) -> Column:
        seen = mask.bitwiseAND(e["covers"])
        two = (F.bit_count(seen) == 3) & (seen.bitwiseAND(e["ends"]) == e["ends"])
        return F.when(two, mask.bitwiseAND(F.bitwise_not(e["covers"].bitwiseXOR(e["ends"])))).otherwise(mask)

    every = _shift("shiftleft", F.lit(1).cast("long"), size + 1) - 1
    longer = F.filter(edges, lambda e: e["length"] > 1)
    mask = F.aggregate(longer, every, joins)
    final = lambda mask: _ids_by_start(edges, lambda e: mask.bitwiseAND(e["covers"]) == e["ends"])
    return F.element_at(F.transform(F.array(mask), final), 1)


def viterbi_ids(edges: Column, size: Column) -> Column:
    """The path of least cost; of equal ones, the one whose last pieces are shorter.

    The state holds, per position reached so far, the least cost and the ids of
    a path to it. Edges come by their end, so a position is final once a later one is.
    A character without a piece costs more than any piece.
    """
    none = F.lit(1e300)
    kind = "array<struct<cost:double,ids:array<int>>>"
    by_end = F.array_sort(F.transform(edges, lambda e: F.struct(
        (e["start"] + e["length"]).alias("stop"), e["length"].alias("length"), e["start"].alias("start"),
        F.when(e["id"] < 0, 1e6).otherwise(e["cost"]).alias("cost"), e["id"].alias("id"),
    )))
    begin = F.array(F.struct(F.lit(0.0).alias("cost"), F.array().cast("array<int>").alias("ids"))).cast(kind)

    def extend(best: Column, e: Column) -> Column:
        before = F.element_at(best, e["start"] + 1)
        cost = before["cost"] + e["cost"]
        path = F.struct(cost.alias("cost"), F.concat(before["ids"], F.array(e["id"])).alias("ids"))
        known = F.size(best) > e["stop"]
        current = F.when(known, F.element_at(best, F.least(e["stop"] + 1, F.size(best)))["cost"]).otherwise(none)
        return F.when(cost < current, F.concat(F.slice(best, F.lit(1), e["stop"]), F.array(path)).cast(kind)).otherwise(best)

    return F.element_at(F.aggregate(by_end, begin, extend), size + 1)["ids"]


# -- units that are no lattices -----------------------------------------------


class UnitEncoder:
    """Ids of single units, in memory of the unit's size; those of the lattice's fold."""

    def __init__(self, model: PieceTable) -> None:
        self.model = model
        self.known = {piece: (score, i) for piece, i, score in model.pieces}

    def ids(self, unit: str) -> list[int]:
        """An id below 0 stands for a character without a piece: -1 less its code point."""
        return self._merged(unit) if self.model.merges else self._best_path(unit)

    def _merged(self, unit: str) -> list[int]:
        """Join neighbours in order of rank, leftmost first, in a linked list of symbols."""
        n = len(unit)
        stop = list(range(1, n + 1))  # where the symbol that begins here ends; 0 once it is part of another
        before = list(range(-1, n - 1))
        waiting: list[tuple[float, int, int]] = []

        def propose(a: int) -> None:
            b = stop[a]
            if b < n and (found := self.known.get(unit[a : stop[b]])):
                heapq.heappush(waiting, (-found[0], a, stop[b]))

        for a in range(n - 1):
            propose(a)
        while waiting:
            _, a, end = heapq.heappop(waiting)
            b = stop[a]
            if not b or b >= n or stop[b] != end:
                continue
            stop[a], stop[b] = end, 0
            if end < n:
                before[end] = a
            propose(a)
            if before[a] >= 0:
                propose(before[a])
        return [self.known[unit[a : stop[a]]][1] if unit[a : stop[a]] in self.known else -1 - ord(unit[a]) for a in range(n) if stop[a]]

    def _best_path(self, unit: str) -> list[int]:
        """The path of least cost, as :func:`viterbi_ids` finds it."""
        best: list[tuple[float, int, int]] = [(0.0, 0, 0)]
        for stop in range(1, len(unit) + 1):
            found: tuple[float, int, int] | None = None
            for length in range(1, min(self.model.longest, stop) + 1):
                piece = unit[stop - length : stop]
                score, i = self.known.get(piece, (None, -1 - ord(piece[0])))
                if score is None and length > 1:
                    continue
                cost = best[stop - length][0] + (1e6 if score is None else -score)
                if found is None or cost < found[0]:
                    found = (cost, length, i)
            best.append(found)
        ids, at = [], len(unit)
        while at:
            ids.append(best[at][2])
            at -= best[at][1]
        return ids[::-1]


# -- texts -------------------------------------------------------------------


class _Dictionary:
    """Sorted hashes of units and, flat, the ids of each, from tables ``(h, ids)`` that come one after another."""

    def __init__(self, tables: Iterable[tuple[np.ndarray, pa.Array]], model: PieceTable) -> None:
        # As narrow as the numbers allow: every task holds these arrays.
        narrow = lambda a: a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))
        parts = []
        for hashes, lists in tables:
            offsets = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values.to_numpy()[offsets[0] : offsets[-1]] if len(lists) else np.zeros(0, np.int32)
            offsets = offsets - (offsets[0] if len(offsets) else 0)
            if (flat < 0).any():
                flat, offsets = _with_bytes(flat, offsets, model)
            parts.append((hashes, narrow(np.diff(offsets)), narrow(flat)))
        hashes, sizes, flat = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.uint64) for i in range(3))
        del parts
        starts = np.cumsum(sizes, dtype=np.int64) - sizes
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.starts, self.sizes, self.flat = hashes[order], narrow(starts[order]), narrow(sizes[order]), narrow(flat)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each hash, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def ids(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids of all rows, where each row's begin)``."""
        return ragged(self.flat, self.starts[rows], self.sizes[rows])


def ragged(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of ``flat`` one after another, and their bounds in the result."""
    bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    return flat[np.arange(bounds[-1]) + np.repeat(starts.astype(np.int64) - bounds[:-1], sizes)], bounds


def _with_bytes(flat: np.ndarray, offsets: np.ndarray, model: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """Replace characters without a piece by their bytes, or by the unknown id."""
    sizes = np.ones(len(flat), np.int64)
    out: list[list[int]] = []
    odd = np.flatnonzero(flat < 0)
    for i in odd:
        data = chr(-1 - int(flat[i])).encode()
        out.append([model.byte_ids[b] for b in data] if model.byte_ids else [model.unknown])
        sizes[i] = len(out[-1])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    new = np.repeat(flat, sizes)
    for i, ids in zip(odd, out):
        new[bounds[i] : bounds[i + 1]] = ids
    return new, bounds[offsets]


def encode(docs: DataFrame, model: PieceTable, text_column: str = "text", head: int = HEAD, verify: bool = False) -> DataFrame:
    """``docs`` with ``token_ids``, the ids of each text; null and empty texts have none.

    With ``verify`` the ids are decoded as well, in the same pass, and
    ``round_trip`` says whether that gives the text again (with spaces for space
    marks). Columns of these names are replaced.
    """
    added = ["token_ids", *(["round_trip"] if verify else [])]
    packed, look_up = _lookup(docs.drop(*[c for c in added if c != text_column]), model, text_column, head)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(shared.value) if verify else None
        for rows, lists in look_up(batches):
            checks = [pa.array(round_trips(speller, rows.field(text_column), lists))] if verify else []
            yield pa.RecordBatch.from_arrays([rows, lists, *checks], names=["_row", *added])

    row_type = packed.schema["_row"].dataType.simpleString()
    schema = f"_row {row_type}, token_ids array<int>" + (", round_trip boolean" if verify else "")
    return packed.mapInArrow(lean(encoded), schema).select("_row.*", *added)


def round_trips(speller: Speller, texts: pa.Array, lists: pa.Array) -> list[bool]:
    return [a == (b or "").replace(MARK, " ") for a, b in zip(speller.texts(lists), texts.to_pylist())]


def _lookup(docs: DataFrame, model: PieceTable, text_column: str, head: int):
    """Rows of ``docs`` as ``_row``, with ids of their rare units, and a function from their batches to ``(rows, ids)``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("_row").getField(text_column), F.lit("")).alias("_text")
    packed = docs.select(F.struct("*").alias("_row"))
    distinct = materialized(distinct_units(packed.select(text), model.prefix))
    several = distinct.groupBy("h").agg(F.count("*").alias("units")).where("units > 1").select("h")
    # Of n different units, some n * n / 2 ** 65 share their hash with another.
    shared_hashes = np.array([r.h for r in several.collect()], np.int64).view(np.uint64)
    if len(shared_hashes):
        distinct = distinct.join(F.broadcast(several), "h", "left_anti")
    folder = f"{shared_folder(spark)}/lexispan/{spark.sparkContext.applicationId}/tables/{uuid.uuid4().hex}"
    sliced = encoded_units(distinct, model).withColumn("slice", F.pmod("h", F.lit(SLICES)).cast("int"))
    sliced.select("h", "n", "ids", "slice").write.partitionBy("slice").parquet(folder)
    units = spark.read.schema("h long, n long, ids array<int>, slice int").parquet(folder)
    total, ids = units.agg(F.count("*"), F.sum(F.size("ids"))).first()
    least = _least_count(units, head) if total > head or total and ids > HEAD_IDS else 1
    dictionary = _Dictionary(_tables(units.where(F.col("n") >= least)), model)
    shared = spark.sparkContext.broadcast((dictionary, model, shared_hashes))
    if least > 1:
        packed = _with_rare_units(packed.select("_row", text), units.where(F.col("n") < least).select("h", "ids"), model.prefix).select("_row", "_rare")

    def look_up(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
        known, table, shared_by_units = shared.value
        direct = UnitEncoder(table)
        for batch in batches:
            rows = batch["_row"]
            for first, codes, begin, stop, hashes, bounds in _unit_batches(rows.field(text_column), table.prefix):
                n = len(bounds) - 1
                once, at, back = np.unique(hashes, return_index=True, return_inverse=True)
                found = known.find(once)
                alone = stop - begin > LONGEST_UNIT
                if len(shared_by_units):
                    alone |= np.isin(hashes, shared_by_units)
                missing = (found < 0) & ~alone[at]
                extra = [known]
                if missing.any():
                    extra.append(_rare(once[missing], batch["_rare"].slice(first, n).flatten(), table))
                    found[missing] = len(known.hashes) + extra[-1].find(once[missing])
                rows_of_units = found[back]
                if alone.any():
                    places = np.flatnonzero(alone)
                    texts = [codes[a:b].tobytes().decode("utf-32-le") for a, b in zip(begin[places].tolist(), stop[places].tolist())]
                    own = _Dictionary([(np.arange(len(texts), dtype=np.uint64), pa.array([direct.ids(t) for t in texts], pa.list_(pa.int32())))], table)
                    rows_of_units[places] = sum(len(d.hashes) for d in extra) + np.arange(len(texts))
                    extra.append(own)
                tokens, edges = _ids_of(extra, rows_of_units)
                yield rows.slice(first, n), pa.ListArray.from_arrays(pa.array(edges[bounds].astype(np.int32)), pa.array(tokens.astype(np.int32)))

    return packed, look_up


def _tables(units: DataFrame) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """``(hashes, ids)`` of the slices, one collected after another."""
    for i in range(SLICES):
        table = units.where(F.col("slice") == i).select("h", "ids").toArrow().combine_chunks()
        if len(table):
            lists = table["ids"].combine_chunks()
            yield table["h"].to_numpy().view(np.uint64), lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists


def _ids_of(dictionaries: list[_Dictionary], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of rows of these dictionaries, numbered through."""
    if len(dictionaries) == 1:
        return dictionaries[0].ids(rows)
    starts, sizes = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    flats, base, length = [], 0, 0
    for d in dictionaries:
        here = np.flatnonzero((rows >= base) & (rows < base + len(d.hashes)))
        sizes[here] = d.sizes[rows[here] - base]
        once, back = np.unique(rows[here], return_inverse=True)
        # Only what the rows need, not the whole dictionary.
        flat, bounds = d.ids(once - base)
        starts[here] = length + bounds[:-1][back]
        flats.append(flat)
        length += len(flat)
        base += len(d.hashes)
    return ragged(np.concatenate(flats), starts, sizes)


def _rare(wanted: np.ndarray, listed: pa.Array, table: PieceTable) -> _Dictionary:
    """The units that are in the texts' own lists, all ``wanted`` ones among them."""
    h, at = np.unique(listed.field("h").to_numpy().view(np.uint64), return_index=True)
    rare = _Dictionary([(h, listed.field("ids").take(pa.array(at)))], table)
    if (rare.find(wanted) < 0).any():
        raise ValueError("a unit was not encoded")
    return rare


def _least_count(units: DataFrame, head: int) -> int:
    """Units that occur at least so often are at most ``head``, with at most ``HEAD_IDS`` ids."""
    by_count = units.groupBy("n").agg(F.count("*").alias("units"), F.sum(F.size("ids")).alias("ids"))
    # One row per number of occurrences.
    down = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = by_count.select("n", F.sum("units").over(down).alias("units"), F.sum("ids").over(down).alias("ids"))
    fits = upto.where((F.col("units") <= head) & (F.col("ids") <= HEAD_IDS))
    return fits.agg(F.min("n")).first()[0] or by_count.agg(F.max("n")).first()[0] + 1


def _with_rare_units(plain: DataFrame, rare: DataFrame, prefix: bool) -> DataFrame:
    """Each text with the ids of the rare units it has; texts are told apart by a digest, equal ones share it."""
    keyed = plain.withColumn("_key", F.sha2(F.col("_text").cast("binary"), 256))

    def occurrences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, _, _, hashes, bounds in _unit_batches(batch["_text"], prefix):
                text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                once = np.unique(np.stack([text.astype(np.uint64), hashes], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays(
                    [batch["_key"].take(pa.array(first + once[:, 0].astype(np.int64))), pa.array(once[:, 1].view(np.int64))], names=["_key", "h"]
                )

    found = keyed.select("_key", "_text").mapInArrow(lean(occurrences), "_key string, h long").join(rare, "h").distinct()
    lists = found.groupBy("_key").agg(F.collect_list(F.struct("h", "ids")).alias("_rare"))
    return keyed.join(lists, "_key", "left").drop("_key")


def decode(docs: DataFrame, model: PieceTable, ids_column: str = "token_ids") -> DataFrame:
    """``docs`` with ``decoded``, the text of its ids; null ids give an empty text. A column of that name is replaced."""
    packed = docs.drop(*[c for c in ("decoded",) if c != ids_column]).select(F.struct("*").alias("_row"), F.col(ids_column).alias("_ids"))
    row_type = packed.schema["_row"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def spell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part["_row"], pa.array(speller.texts(part["_ids"]), pa.string())], names=["_row", "decoded"])

    return packed.mapInArrow(lean(spell), f"_row {row_type}, decoded string").select("_row.*", "decoded")


class Speller:
    def __init__(self, model: PieceTable) -> None:
        pieces = model.texts()
        self.prefix = model.prefix
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def texts(self, lists: pa.Array) -> list[str]:
        lists = lists.fill_null([]) if lists.null_count else lists
        offsets = lists.offsets.to_numpy()
        ids = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
        data, bounds = ragged(self.flat, self.starts[ids], self.sizes[ids])
        data = data.tobytes()
        edges = bounds[offsets - offsets[0]].tolist()
        texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(edges[:-1], edges[1:])]
        return [t[1:] if self.prefix and t.startswith(" ") else t for t in texts]


def codec_digest(docs: DataFrame, model: PieceTable, id_column: str = "doc_id", text_column: str = "text", head: int = HEAD) -> DataFrame:
    """``(id, n_tokens, ids_crc32, round_trip)``; ``round_trip``: decoding gives the text again (with spaces for space marks)."""
    packed, look_up = _lookup(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")), model, "text", head)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_column].dataType.simpleString()

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(shared.value)
        for rows, lists in look_up(batches):
            offsets = lists.offsets.to_numpy()
            data = lists.values.to_numpy().astype("<u4")
            crcs = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            same = round_trips(speller, rows.field("text"), lists)
            yield pa.RecordBatch.from_arrays(
                [rows.field("id"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crcs, pa.int64()), pa.array(same)],
                names=["id", "n_tokens", "ids_crc32", "round_trip"],
            )

    found = packed.mapInArrow(lean(digest), f"id {kind}, n_tokens long, ids_crc32 long, round_trip boolean")
    return found.withColumnRenamed("id", id_column)
