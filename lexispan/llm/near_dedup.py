"""Near duplicates by b-bit MinHash: banded minima propose, packed low bits sift, full sets confirm.

* A document's set are its distinct shingles of ``width`` words; documents with
  equal sets form a *class* (a node), so exact copies cost one row each.
* Every class has ``BANDS * ROWS`` minima. A band's minima together are a
  bucket key; a pair at similarity 0.8 misses all buckets with probability
  (1 - 0.8**6)**64 < 4e-9.
* Of every minimum, mixed once more, two low bits are kept, packed into two bit
  planes. Two sets agree in a kept pair with probability J + (1 - J) / 4, so the
  number of equal pairs estimates J; an estimate more than six standard
  deviations under the threshold ends a candidate pair.
* What is left is confirmed on the full sets of both texts, as sorted hashes.

No bucket is expanded into its pairs, and no step makes more rows than it has
members. First each member is compared with its bucket's centre, the one with
most company over all bands, and the nearest centre over all bands is confirmed:
that ties groups of copies together, at one pair per member. Then sketches are
compared within buckets that still hold several components, in blocks of bounded
size; of the components that alike sketches could join, a block reports a tree.
Components so connected are a *cluster*: its members meet, with their sets, in
blocks of bounded bytes, where every pair of sketches of different components is
looked at, the sets decide, and again only a tree of links is reported. So every
pair that could join two components is looked at, once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexispan.llm.bitmaps import bit_map, may_hold
from lexispan.llm.components import components
from lexispan.llm.textbytes import SMALL_SLICE_BYTES, mixed, seeded, shingle_hashes, utf8_slices, word_hashes
from lexispan.llm.workers import lean
from lexispan.operators.keys import broadcast_if_small
from lexispan.sources.workspace import materialized

BANDS, ROWS = 64, 6
MINIMA = BANDS * ROWS
PLANES = 2
WORDS = MINIMA // 64  # of 64 bits, per plane

# Members of one bucket compared at a time, and bytes of the sets of one side of a cluster's block.
HELD, STREAMED = 2048, 8192
CHUNK_BYTES = 16 << 20

# Members of a centre that are confirmed in one task, on average.
CONFIRMED = 4096

NODE = ["rep", "var"]


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` per row of ``docs``.

    Two documents are linked if 100 * shared shingles >= ``percent`` * all
    shingles of both. ``component_id`` is the smallest id reachable over links,
    the own included; ``kept`` marks the document with that id. An empty or
    null text has no shingles and no links. Rows that share an id are one
    document with several texts: their links add up, and ``kept`` falls on all
    of them. A null id has no component and is kept. Equal rows get equal results.
    """
    plain = docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    id_type = docs.schema[id_column].dataType.simpleString()
    sketches = materialized(plain.mapInArrow(
        lean(_sketcher(width)), f"_id {id_type}, n_shingles long, s1 long, s2 long, keys array<long>, planes array<long>"
    ))
    has_node = F.col("_id").isNotNull() & (F.col("n_shingles") > 0)
    # The smallest id of a class names it; ``var`` tells classes apart that the same id names.
    classes = sketches.where(has_node).groupBy("s1", "s2", "n_shingles").agg(F.min("_id").alias("rep"))
    shared = classes.groupBy("rep").agg(F.min(F.struct("s1", "s2")).alias("first"))
    var = F.when(F.struct("s1", "s2") == F.col("first"), 0).otherwise(F.xxhash64("s1", "s2").bitwiseOR(F.lit(1)))
    classes = materialized(classes.join(shared, "rep").select("s1", "s2", "n_shingles", "rep", var.alias("var")))

    node = F.when(has_node & F.col("rep").isNotNull(), F.struct(*NODE)).alias("node")
    members = sketches.select("_id", "n_shingles", "s1", "s2").join(classes, ["s1", "s2", "n_shingles"], "left")
    members = materialized(members.select("_id", "n_shingles", node))
    ids = members.where("node IS NOT NULL").groupBy("_id").agg(F.count("*").alias("n"), F.min("node").alias("a"), F.max("node").alias("z"))
    repeated = materialized(ids.where("n > 1").select("_id", "a", "z"))
    ids_repeat = bool(repeated.limit(1).count())

    same_id = members.join(repeated.where("a <> z"), "_id").select("a", F.col("node").alias("b")) if ids_repeat else None
    roots, tops = _roots(plain, sketches, classes, same_id, width, percent)
    smallest = F.coalesce(F.col("top.rep"), F.col("root.rep"), F.col("_id"))
    rows = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = rows.join(tops, "root", "left").withColumn("component_id", smallest)
    kept = F.coalesce(F.col("_id") == F.col("component_id"), F.lit(True))
    return rows.select(F.col("_id").alias(id_column), "n_shingles", "component_id", kept.alias("kept"))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the rows whose id is not the smallest of its component; columns and other rows stay."""
    found = near_duplicates(docs, width, percent, id_column, text_column)
    name = "_gone"
    while name in docs.columns:
        name += "_"
    gone = found.where(~F.col("kept")).select(F.col(id_column).alias(name)).distinct()
    return docs.join(gone, F.col(id_column) == F.col(name), "left_anti")


# -- sketches ----------------------------------------------------------------


def text_sets(column, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """``(first row, sorted distinct shingle hashes of each text)`` of consecutive rows."""
    for first, data, offsets in utf8_slices(column, SMALL_SLICE_BYTES):
        shingles, bounds = shingle_hashes(*word_hashes(data, offsets), width)
        yield first, [np.unique(shingles[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def minima(shingles: np.ndarray, flips: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Least value of every hash function over the shingles, a bounded block at a time."""
    least = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    base = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(base), 256):
        np.minimum(least, ((base[at : at + 256, None] ^ flips) * factors).min(axis=0), out=least)
    return least


def bit_planes(least: np.ndarray) -> np.ndarray:
    """The low bits of all minima of each row, ``PLANES`` times ``WORDS`` numbers.

    A minimum's own lowest bit is that of its shingle, but for a constant: two
    shingles would agree in it under all hash functions or under none. Mixed,
    different minima agree by chance, in each function anew.
    """
    planes = np.empty((len(least), PLANES, MINIMA // 8), np.uint8)
    for at in range(0, len(least), 256):
        bits = mixed(least[at : at + 256].astype(np.uint64))
        for p in range(PLANES):
            planes[at : at + 256, p] = np.packbits((bits >> np.uint64(p)) & np.uint64(1) == 1, axis=1)
    return planes.reshape(len(least), PLANES * MINIMA // 8).view(np.int64)


def _sketcher(width: int):
    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = (seeded(MINIMA, 3) >> np.uint64(32)).astype(np.uint32)
        factors = (seeded(MINIMA, 5) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        band_seeds = seeded(BANDS, 7)
        for batch in batches:
            for first, sets in text_sets(batch["_text"], width):
                n = len(sets)
                least = np.zeros((n, MINIMA), np.uint32)
                sums = np.zeros((2, n), np.uint64)
                sizes = np.array([len(s) for s in sets], np.int64)
                for i, s in enumerate(sets):
                    if len(s):
                        least[i] = minima(s, flips, factors)
                        sums[0, i] = mixed(s).sum(dtype=np.uint64)
                        sums[1, i] = mixed(s ^ band_seeds[0]).sum(dtype=np.uint64)
                keys = np.broadcast_to(band_seeds, (n, BANDS)).copy()
                for row in range(ROWS):
                    keys = mixed(keys ^ least[:, row::ROWS].astype(np.uint64)) + band_seeds
                planes = bit_planes(least)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["_id"].slice(first, n), pa.array(sizes), *(pa.array(mixed(s).view(np.int64)) for s in sums),
                        _lists(keys.view(np.int64)), _lists(planes),
                    ],
                    names=["_id", "n_shingles", "s1", "s2", "keys", "planes"],
                )

    return sketch


def _lists(rows: np.ndarray) -> pa.ListArray:
    at = pa.array(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32))
    return pa.ListArray.from_arrays(at, pa.array(rows.ravel()))


def differing_minima(a: Column, b: Column) -> Column:
    """How many minima have different low bits, by bit counts over two ``planes`` arrays."""
    total = F.lit(0)
    for i in range(1, WORDS + 1):
        odd = F.lit(0).cast("long")
        for p in range(PLANES):
            odd = odd.bitwiseOR(F.element_at(a, i + p * WORDS).bitwiseXOR(F.element_at(b, i + p * WORDS)))
        total = total + F.bit_count(odd)
    return total


def similarity_estimate(differ):
    """Similarity from the number of differing minima, corrected for low bits that agree by chance."""
    by_chance = 0.5**PLANES
    return (1 - differ / MINIMA - by_chance) / (1 - by_chance)


def most_different(percent: int) -> int:
    """Pairs with more differing minima are below the threshold: six standard deviations are allowed for."""
    equal = percent / 100 * (1 - 0.5**PLANES) + 0.5**PLANES
    return int(MINIMA * (1 - equal) + 6 * (MINIMA * equal * (1 - equal)) ** 0.5)


# -- links -------------------------------------------------------------------


def _roots(
    plain: DataFrame, sketches: DataFrame, classes: DataFrame, same_id: DataFrame | None, width: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """``(node, root)`` of components by links to centres and ``same_id``, and ``(root, top)`` of those that further links join."""
    ids_repeat = same_id is not None
    # One sketch per class: of the row with the id that names it.
    nodes = sketches.join(classes.withColumnRenamed("rep", "_id"), ["s1", "s2", "n_shingles", "_id"])
    nodes = nodes.select(F.struct(F.col("_id").alias("rep"), "var").alias("node"), "s1", "s2", "n_shingles", "keys", "planes")
    nodes = materialized(nodes.dropDuplicates(["node"]) if ids_repeat else nodes)
    tied = _tied(nodes.select("node", "keys"))
    sets = _Sets(plain, nodes.select("node", "s1", "s2"), ids_repeat, width)

    to_centres = tied.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    links = materialized(_confirmed(materialized(_nearest(to_centres, nodes, percent)), sets, percent))
    roots = components(links if same_id is None else links.unionByName(same_id), "a", "b")
    candidates = materialized(_candidates(tied, roots, nodes, percent))
    clusters = components(candidates, "a", "b")
    tops = components(_across(clusters, roots, nodes, sets, percent), "a", "b")
    return roots, tops.select(F.col("node").alias("root"), F.col("root").alias("top"))


def _tied(nodes: DataFrame) -> DataFrame:
    """``(key, node, centre)`` of every bucket with several nodes.

    Most buckets have one node; a bit map of the others keeps them from being shuffled with their node.
    """
    shared = nodes.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialized(shared)
    found = bit_map(shared, "key")
    kind = nodes.schema["node"].dataType

    def bands(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                keys = part["keys"].flatten().to_numpy()
                some = np.flatnonzero(may_hold(found.value, keys))
                yield pa.RecordBatch.from_arrays([pa.array(keys[some]), part["node"].take(pa.array(some // BANDS))], names=["key", "node"])

    banded = nodes.mapInArrow(lean(bands), T.StructType().add("key", "long").add("node", kind))
    sized = materialized(banded.join(shared.hint("merge"), "key"))
    # An original shares more of its buckets with its copies than they do with each other: a good centre.
    degrees = sized.groupBy("node").agg(F.sum("n").alias("degree"))
    ranked = sized.join(degrees.hint("merge"), "node").select("key", "node", F.struct("degree", "node").alias("rank"))
    centres = ranked.groupBy("key").agg(F.max("rank").alias("rank")).select("key", F.col("rank.node").alias("centre"))
    return materialized(sized.select("key", "node").join(centres.hint("merge"), "key"))


def _nearest(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Of the pairs ``(a, b)`` with alike sketches the best of each ``b``."""
    for side in ("a", "b"):
        planes = nodes.select(F.col("node").alias(side), F.col("planes").alias(f"p{side}"))
        pairs = pairs.join(planes.hint("merge"), side)
    differ = differing_minima(F.col("pa"), F.col("pb"))
    alike = pairs.where(differ <= most_different(percent)).select("a", "b", similarity_estimate(differ).alias("estimate"))
    return alike.groupBy("b").agg(F.max(F.struct("estimate", "a")).alias("best")).select("best.a", "b")


def _confirmed(pairs: DataFrame, sets: _Sets, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that are links; each ``b`` is in one pair. The sets of all ``b`` of an ``a`` stream past its own."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    found = sets.of(wanted)
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / CONFIRMED).cast("int").alias("salts"))
    salt = F.pmod(F.xxhash64("b"), F.col("salts")).cast("int")
    members = pairs.join(sizes, "a").select("a", salt.alias("salt"), "b")
    centres = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("a").alias("node"), F.lit(False).alias("member"))
    rows = centres.unionByName(members.select("a", "salt", F.col("b").alias("node"), F.lit(True).alias("member")))
    rows = rows.join(found.hint("merge"), "node").repartition("a", "salt").sortWithinPartitions("a", "salt", "member")
    return rows.mapInArrow(lean(_star_confirmer(percent)), pairs.select("a", "b").schema)


def _star_confirmer(percent: int):
    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = None
        for batch in batches:
            members = batch["member"].to_pylist()
            sets = _set_rows(batch["set"])
            linked = []
            for i, is_member in enumerate(members):
                if not is_member:
                    centre = sets[i]
                elif _linked(centre, sets[i], percent):
                    linked.append(i)
            some = batch.take(pa.array(linked, pa.int64()))
            yield pa.RecordBatch.from_arrays([some["a"], some["node"]], names=["a", "b"])

    return confirm


def _set_rows(column: pa.Array) -> list[np.ndarray]:
    offsets = column.offsets.to_numpy()
    flat = column.flatten().to_numpy().view(np.uint64)
    return [flat[a:b] for a, b in zip((offsets[:-1] - offsets[0]).tolist(), (offsets[1:] - offsets[0]).tolist())]


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    least, most = sorted((len(x), len(y)))
    if 100 * least < percent * most:
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= percent * (len(x) + len(y) - shared)


# -- across components -------------------------------------------------------


def _candidates(tied: DataFrame, roots: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of components with alike sketches in one bucket, enough to connect all such.

    Of each bucket the members outside its largest component are compared with
    all its members, ``HELD`` by ``STREAMED`` at a time; a block reports fewer
    pairs than it has components.
    """
    rooted = tied.select("key", "node").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    rooted = materialized(rooted)
    parts = rooted.groupBy("key", "root").agg(F.count("*").alias("n"))
    buckets = parts.groupBy("key").agg(
        F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("n"), F.count("*").alias("roots")
    ).where("roots > 1")
    blocks = F.ceil((F.col("n") - F.col("most.n")) / HELD).cast("int").alias("held_blocks")
    salts = F.ceil(F.col("n") / STREAMED).cast("int").alias("streamed_blocks")
    buckets = materialized(buckets.select("key", F.col("most.root").alias("most"), blocks, salts))
    members = rooted.join(buckets, "key").join(nodes.select("node", "planes"), "node")
    own = lambda n: F.array(F.pmod(F.xxhash64("node"), F.col(n)).cast("int"))
    all_of = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    held = members.where("root <> most").withColumns({"i": own("held_blocks"), "j": all_of("streamed_blocks"), "streamed": F.lit(False)})
    streamed = members.withColumns({"i": all_of("held_blocks"), "j": own("streamed_blocks"), "streamed": F.lit(True)})
    rows = held.unionByName(streamed).withColumn("i", F.explode("i")).withColumn("j", F.explode("j"))
    rows = rows.select("key", "i", "j", "streamed", "root", F.xxhash64("root").alias("number"), "planes")
    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "streamed")
    kind = tied.schema["node"].dataType
    pairs = rows.mapInArrow(lean(_bucket_comparer(percent)), T.StructType().add("a", kind).add("b", kind))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _groups(batches: Iterable[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of rows with equal ``columns``, with these values; a group may come in several stretches."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = np.stack([batch[c].to_numpy().astype(np.int64) for c in columns])
        edges = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            yield tuple(at[:, a].tolist()), batch.slice(a, b - a)


class _Union:
    """Which numbers have been joined so far."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def find(self, x: int) -> int:
        top = x
        while (up := self.above.get(top, top)) != top:
            top = up
        while x != top:
            self.above[x], x = top, self.above.get(x, x)
        return top

    def join(self, x: int, y: int) -> bool:
        """Whether they were apart."""
        x, y = self.find(x), self.find(y)
        if x != y:
            self.above[y] = x
        return x != y

    def tops(self, numbers: np.ndarray) -> np.ndarray:
        once, back = np.unique(numbers, return_inverse=True)
        return np.array([self.find(x) for x in once.tolist()], np.int64)[back]


def _bucket_comparer(percent: int):
    most = most_different(percent)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, union = None, [], _Union()
        for at, part in _groups(batches, ("key", "i", "j")):
            if block != at:
                block, held, union = at, [], _Union()
            streamed = part["streamed"].to_numpy(zero_copy_only=False)
            split = int(np.searchsorted(streamed, True))
            if split:
                held.append(_sketch_rows(part.slice(0, split)))
            if split < part.num_rows and held:
                other = _sketch_rows(part.slice(split))
                for own in held:
                    x, y = _tree(own, other, most, union)
                    if len(x):
                        yield pa.RecordBatch.from_arrays([own["root"].take(pa.array(x)), other["root"].take(pa.array(y))], names=["a", "b"])

    return compare


def _tree(own: dict, other: dict, most: int, union: _Union) -> tuple[list[int], list[int]]:
    """Of the pairs with alike sketches, those that join what is still apart."""
    found: tuple[list[int], list[int]] = ([], [])
    for at in range(0, len(other["number"]), 256):
        tops = union.tops(own["number"]), union.tops(other["number"][at : at + 256])
        x, y = _alike({**own, "number": tops[0]}, {"number": tops[1], "planes": other["planes"][at : at + 256]}, most)
        if not len(x):
            continue
        _, first = np.unique(np.stack([tops[0][x], tops[1][y]]), axis=1, return_index=True)
        for i in first.tolist():
            if union.join(int(tops[0][x[i]]), int(tops[1][y[i]])):
                found[0].append(int(x[i]))
                found[1].append(int(y[i]) + at)
    return found


def _sketch_rows(part: pa.RecordBatch) -> dict:
    # Unsigned: of a negative number numpy counts the bits of its absolute value.
    planes = part["planes"].flatten().to_numpy().view(np.uint64).reshape(part.num_rows, PLANES * WORDS)
    return {"root": part["root"], "number": part["number"].to_numpy(), "planes": planes}


def _alike(own: dict, other: dict, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of both sides with different numbers and at most ``most`` differing minima."""
    found = []
    for at in range(0, len(other["number"]), 256):
        planes, numbers = other["planes"][at : at + 256], other["number"][at : at + 256]
        differ = np.zeros((len(own["number"]), len(planes)), np.uint16)
        for w in range(WORDS):
            odd = own["planes"][:, w, None] ^ planes[:, w]
            for p in range(1, PLANES):
                odd |= own["planes"][:, w + p * WORDS, None] ^ planes[:, w + p * WORDS]
            differ += np.bitwise_count(odd)
        x, y = np.nonzero((differ <= most) & (own["number"][:, None] != numbers))
        found.append((x, y + at))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(side) for side in zip(*found))


def _across(clusters: DataFrame, roots: DataFrame, nodes: DataFrame, sets: _Sets, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of components of one cluster with a link between them, enough to join all that are linked.

    Members of a cluster are dealt into chunks of bounded bytes; each pair of
    chunks is a block, which reports fewer links than it has members.
    """
    kind = nodes.schema["node"].dataType
    schema = T.StructType().add("a", kind).add("b", kind)
    if clusters.isEmpty():
        return nodes.sparkSession.createDataFrame([], schema)
    tops = clusters.select(F.col("node").alias("root"), F.col("root").alias("cluster"))
    tops = tops.unionByName(tops.select(F.col("cluster").alias("root"), "cluster").distinct())
    rooted = nodes.select("node", "n_shingles", "planes").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    members = materialized(rooted.join(broadcast_if_small(tops), "root"))
    chunks = members.groupBy("cluster").agg(F.ceil(F.sum(8 * F.col("n_shingles") + 200) / CHUNK_BYTES).cast("int").alias("chunks"))
    # The largest component of a cluster is linked already; its members need not be compared with each other.
    largest = members.groupBy("cluster", "root").agg(F.count("*").alias("n")).groupBy("cluster").agg(F.max(F.struct("n", "root")).alias("most"))
    members = members.join(chunks.join(largest, "cluster"), "cluster").withColumn("outside", F.col("root") != F.col("most.root"))
    members = members.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    # A chunk meets itself and every other one: blocks (i, j) with i <= j.
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    members = members.withColumn("_other", F.explode(every))
    rows = members.select(
        F.xxhash64("cluster").alias("key"), F.xxhash64(F.lit(1), "cluster").alias("key2"), F.least("chunk", "_other").alias("i"), F.greatest("chunk", "_other").alias("j"),
        (F.col("chunk") > F.col("_other")).alias("second"), "outside", "node", "root", F.xxhash64("root").alias("number"), "planes",
    )
    rows = rows.join(sets.of(members.select("node").distinct()).hint("merge"), "node")
    rows = rows.repartition("key", "key2", "i", "j").sortWithinPartitions("key", "key2", "i", "j")
    return materialized(rows.mapInArrow(lean(_cluster_comparer(percent)), schema))


def _cluster_comparer(percent: int):
    most = most_different(percent)

    def links(block: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(block).combine_chunks().to_batches()[0]
        sets, numbers = _set_rows(rows["set"]), rows["number"].to_numpy()
        planes = rows["planes"].flatten().to_numpy().view(np.uint64).reshape(rows.num_rows, PLANES * WORDS)
        second, outside = (rows[c].to_numpy(zero_copy_only=False) for c in ("second", "outside"))
        # Within a chunk, or between two chunks, each pair of which one is outside the largest component.
        sides = [(np.flatnonzero(outside & ~second), np.arange(len(sets)))]
        if second.any():
            sides = [(np.flatnonzero(outside & ~second), np.flatnonzero(second)), (np.flatnonzero(outside & second), np.flatnonzero(~second & ~outside))]
        union, found = _Union(), ([], [])
        for own, other in sides:
            for at in range(0, len(other), 256):
                y_rows = other[at : at + 256]
                for begin in range(0, len(own), 4096):
                    x_rows = own[begin : begin + 4096]
                    tops = union.tops(numbers[x_rows]), union.tops(numbers[y_rows])
                    x, y = _alike({"number": tops[0], "planes": planes[x_rows]}, {"number": tops[1], "planes": planes[y_rows]}, most)
                    x, y = x_rows[x], y_rows[y]
                    once = (x < y) | ~outside[y] | (second[x] != second[y])
                    for u, v in zip(x[once].tolist(), y[once].tolist()):
                        a, b = int(numbers[u]), int(numbers[v])
                        if union.find(a) != union.find(b) and _linked(sets[u], sets[v], percent):
                            union.join(a, b)
                            found[0].append(u)
                            found[1].append(v)
        return pa.RecordBatch.from_arrays([rows["root"].take(pa.array(f, pa.int64())) for f in found], names=["a", "b"])

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, block = None, []
        for at, part in _groups(batches, ("key", "key2", "i", "j")):
            if at != current and block:
                yield links(block)
                block = []
            current = at
            block.append(part)
        if block:
            yield links(block)

    return compare


# -- full sets ---------------------------------------------------------------


class _Sets:
    """The full sets of nodes, from the texts."""

    def __init__(self, plain: DataFrame, nodes: DataFrame, ids_repeat: bool, width: int) -> None:
        self.plain = plain
        self.nodes = nodes
        self.ids_repeat = ids_repeat
        self.width = width

    def of(self, wanted: DataFrame) -> DataFrame:
        """``(node, set)`` of the nodes ``wanted``, the hashes of a set in order.

        A bit map of their ids tells which texts are needed, and only their sets are shuffled.
        """
        ids = wanted.select(F.col("node.rep").alias("_id"), "node")
        found = bit_map(ids.select(F.xxhash64("_id").alias("h")), "h")
        kind = self.plain.schema["_id"].dataType
        schema = T.StructType().add("_id", kind).add("s1", "long").add("s2", "long").add("set", T.ArrayType(T.LongType()))
        hashed = self.plain.where(F.col("_id").isNotNull()).withColumn("h", F.xxhash64("_id"))
        sets = hashed.mapInArrow(lean(_set_maker(self.width, found, self.ids_repeat)), schema)
        if not self.ids_repeat:
            return sets.drop("s1", "s2").join(ids.hint("merge"), "_id").drop("_id")
        # An id may have several texts: take the one the node stands for.
        known = ids.join(self.nodes, "node")
        return sets.join(known.hint("merge"), ["_id", "s1", "s2"]).select("node", "set").dropDuplicates(["node"])


def _set_maker(width: int, found, with_sums: bool):
    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.take(pa.array(np.flatnonzero(may_hold(found.value, batch["h"].to_numpy()))))
            for first, sets in text_sets(some["_text"], width):
                n = len(sets)
                sums = [_set_sums(s) if with_sums else (0, 0) for s in sets]
                bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64) if bounds[-1] else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [some["_id"].slice(first, n), *(pa.array([s[i] for s in sums], pa.int64()) for i in (0, 1)), pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))],
                    names=["_id", "s1", "s2", "set"],
                )

    return make


def _set_sums(s: np.ndarray) -> tuple[int, int]:
    other = seeded(BANDS, 7)[0]
    sums = np.array([mixed(s).sum(dtype=np.uint64), mixed(s ^ other).sum(dtype=np.uint64)], np.uint64)
    return tuple(mixed(sums).view(np.int64).tolist())


# -- the same in SQL -----------------------------------------------------------


def oracle() -> str:
    """Whole sets of four-word shingles, joined on every shingle they share; links closed step by step."""
    return r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingled AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s
    FROM worded
), sets AS (
    SELECT dense_rank() OVER (ORDER BY list_sort(s)) AS class, doc_id, len(s) AS n FROM shingled WHERE len(s) > 0
), classes AS (
    SELECT class, min(doc_id) AS doc_id, any_value(n) AS n FROM sets GROUP BY class
), elements AS (
    SELECT class, n, unnest(s) AS shingle FROM classes JOIN shingled USING (doc_id)
), shared AS (
    SELECT a.class AS a, b.class AS b, any_value(a.n + b.n) AS total, count(*) AS n FROM elements a JOIN elements b ON a.shingle = b.shingle AND a.class < b.class
    WHERE 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n) GROUP BY a.class, b.class
), links AS (
    SELECT a, b FROM shared WHERE 100 * n >= 80 * (total - n) UNION ALL SELECT b, a FROM shared WHERE 100 * n >= 80 * (total - n)
), reached AS (
    SELECT class AS a, class AS b FROM classes UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
), components AS (
    SELECT a AS class, min(c.doc_id) AS component_id FROM reached JOIN classes c ON c.class = b GROUP BY a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM shingled LEFT JOIN sets USING (doc_id) LEFT JOIN components USING (class)
"""
