"""The trie of conversations that begin alike, built in shards of balanced parentheses.

1. A conversation is the sequence of digests of its turns (role and text). Equal
   sequences are one *path*, with its number of conversations and the smallest id.
2. Paths are sorted and cut into shards of contiguous ranges, so a subtree is a
   range of paths and lies in one shard or in consecutive ones.
3. A shard encodes the trie of its paths as parentheses. The closing one of a
   node delimits its subtree: leaf pairs up to there are its leaves, and running
   sums over nodes in order give conversations and savings of any subtree.
4. Only the nodes on a shard's first and last path can reach into another shard.
   A shard knows the last path before it and the first one after, and so counts
   a node, a child or a leaf only where it first occurs; what the shards say of
   such a shared spine is added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexispan.llm.parentheses import Parentheses
from lexispan.llm.textbytes import mixed, seeded
from lexispan.llm.workers import lean
from lexispan.operators.keys import broadcast_if_small
from lexispan.sources.workspace import materialized

# Turns of different paths per shard, and ids per piece of a list of ends.
SHARD_TURNS, PIECE_IDS = 200_000, 20_000

NODE_KEY = ["depth", "k1", "k2"]
COUNTS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]


def turn_lists(conversations: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """``(conv_id, turns)``: each conversation's turns as (turn, x1, x2, size), in order.

    Turns go by ``turn``, null first; of equal ones, by the digest of role and
    text. A null role or text is empty. ``x1`` and ``x2`` are 120 bits of that
    digest, ``size`` the code points of the text. Rows with a null id belong to
    no conversation. A conversation is one row, some 40 bytes per turn.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.encode(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), "utf-8"), 256)
    part = lambda at: F.conv(F.substring("_digest", at, 15), 16, 10).cast("long")
    turns = conversations.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("_digest"),
        F.char_length(text).cast("long").alias("size"),
    )
    turn = F.struct("turn", part(1).alias("x1"), part(16).alias("x2"), "size")
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def sharing_first_turns(turns: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """``turns`` with the first ones of each conversation c replaced by those of conversation c - c % ``every``.

    With h = crc32 of c in decimal % ``most``: the first h turns of that
    conversation (all if it has fewer, none if there is no such), then the own
    turns after the first h. ``%`` keeps the sign of c.
    """
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    bases = turns.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most - 1).alias("_head"))
    joined = turns.withColumn("_base", F.col("conv_id") - F.col("conv_id") % every).join(bases, "_base", "left")
    head = F.coalesce(F.slice("_head", F.lit(1), h), F.slice("turns", 1, 0))
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


def prefix_trie(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of ``turns(conv_id, turns)``, as :func:`turn_lists` makes it; ids are distinct.

    A node is a sequence of first turns that some conversation has; the root, of
    no turns, is there if there is any conversation, and a conversation without
    turns ends in it. ``conv_id`` is the smallest conversation of a node,
    ``parent_conv_id`` that of its parent, ``n_convs`` how many begin with it,
    ``n_children`` and ``n_leaves`` count nodes below it (a leaf is its own leaf),
    ``saved_tokens`` is what storing each node once saves, summed over the
    subtree: (conversations - 1) * code points of the last turn's text.
    ``ends_sha256`` is of the ids of conversations that end in the node, ascending
    and joined by commas. No conversations: no rows.
    """
    path = F.transform("turns", lambda t: F.struct(t["x1"].alias("x1"), t["x2"].alias("x2"), t["size"].alias("size")))
    keyed = turns.select("conv_id", path.alias("path"))
    keys = [F.xxhash64(F.lit(seed), "path").alias(name) for seed, name in ((1, "p1"), (2, "p2"))]
    keyed = materialized(keyed.select("conv_id", "path", *keys))
    ends = keyed.groupBy("p1", "p2").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    ends = ends.join(_end_digests(keyed.select("p1", "p2", "conv_id")), ["p1", "p2"])
    total = keyed.join(ends.select("conv_id"), "conv_id").agg(F.sum(F.size("path") + 1)).first()[0] or 0
    n_shards = max(1, -(-total // shard_turns))
    paths = keyed.select("conv_id", "path").join(ends.select("conv_id", "n", "ends"), "conv_id")
    shards = materialized(paths.repartitionByRange(n_shards, "path").withColumn("shard", F.spark_partition_id()))
    nodes = materialized(_shard_nodes(shards))
    return _merged(nodes)


def _end_digests(members: DataFrame) -> DataFrame:
    """``(p1, p2, ends)``: the SHA-256 of the ids of each path, ascending, joined by commas.

    Ids are sorted by ranges, however many share a path, and joined to pieces;
    only the pieces of a path meet, and are hashed one after another.
    """
    ordered = members.repartitionByRange("p1", "p2", "conv_id").sortWithinPartitions("p1", "p2", "conv_id")

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            p1, p2, ids = (batch[c].to_numpy() for c in ("p1", "p2", "conv_id"))
            edges = np.flatnonzero((p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])) + 1
            begins = np.union1d(np.concatenate([[0], edges]), np.arange(0, len(ids), PIECE_IDS))
            stops = np.append(begins[1:], len(ids))
            listed = ids.astype(str).tolist()
            pieces = [",".join(listed[a:b]) for a, b in zip(begins.tolist(), stops.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(p1[begins]), pa.array(p2[begins]), pa.array(ids[begins]), pa.array(pieces, pa.string())], names=["p1", "p2", "first", "piece"])

    pieces = ordered.mapInArrow(lean(join), "p1 bigint, p2 bigint, first bigint, piece string")
    pieces = pieces.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "first")

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for p1, p2, piece in zip(*(batch[c].to_pylist() for c in ("p1", "p2", "piece"))):
                if (p1, p2) == key:
                    state.update(b"," + piece.encode())
                    continue
                if key:
                    done.append((*key, state.hexdigest()))
                key, state = (p1, p2), hashlib.sha256(piece.encode())
            yield _rows(done)
        if key:
            yield _rows([(*key, state.hexdigest())])

    return pieces.mapInArrow(lean(digest), "p1 bigint, p2 bigint, ends string")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=["p1", "p2", "ends"])


# -- shards ------------------------------------------------------------------

NODES = (
    "depth bigint, k1 bigint, k2 bigint, u1 bigint, u2 bigint, conv_id bigint, parent_conv_id bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string, is_open boolean, parent_open boolean"
)


def _shard_nodes(shards: DataFrame) -> DataFrame:
    """Nodes of each shard; ``is_open`` marks those that another shard may have as well."""
    bounds = shards.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    # One row per shard.
    order = Window.orderBy("shard")
    around = bounds.select("shard", F.lag("high").over(order).alias("before"), F.lead("low").over(order).alias("after"))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("conv_id", "long"), ("n", "long"), ("ends", "string"))]
    before = around.where("before IS NOT NULL").select("shard", F.lit(0).alias("kind"), F.col("before").alias("path"), *nothing)
    own = shards.select("shard", F.lit(1).alias("kind"), "path", "conv_id", "n", "ends")
    after = around.where("after IS NOT NULL").select("shard", F.lit(2).alias("kind"), F.col("after").alias("path"), *nothing)
    rows = before.unionByName(own).unionByName(after).repartition("shard").sortWithinPartitions("shard", "kind", "path")

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = batch["shard"].to_numpy()
            edges = (np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist()
            for a, b in zip([0, *edges], [*edges, len(numbers)]):
                if numbers[a] != current and parts:
                    yield from shard_trie(pa.Table.from_batches(parts))
                    parts = []
                current = numbers[a]
                parts.append(batch.slice(a, b - a))
        if parts:
            yield from shard_trie(pa.Table.from_batches(parts))

    return rows.mapInArrow(lean(build), NODES)


class _Path:
    def __init__(self, x1: np.ndarray, x2: np.ndarray) -> None:
        self.x1, self.x2 = x1, x2

    def shared_with(self, other: _Path) -> int:
        n = min(len(self.x1), len(other.x1))
        differ = (self.x1[:n] != other.x1[:n]) | (self.x2[:n] != other.x2[:n])
        return int(differ.argmax()) if differ.any() else n


def shard_trie(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Nodes of the paths of one shard, which come in order, after the path before them and before the one after."""
    rows = rows.combine_chunks()
    kinds = rows["kind"].to_numpy()
    lists = rows["path"].chunk(0)
    offsets = lists.offsets.to_numpy()
    base = offsets[0]
    x1, x2, size = (lists.flatten().field(c).to_numpy() for c in ("x1", "x2", "size"))
    paths = [_Path(x1[a:b], x2[a:b]) for a, b in zip((offsets[:-1] - base).tolist(), (offsets[1:] - base).tolist())]
    own = np.flatnonzero(kinds == 1)
    if not len(own):
        return
    # How many turns each path has in common with the one before it; -1: not even the root.
    common = np.array([-1] + [paths[i].shared_with(paths[i - 1]) for i in range(1, len(paths))], np.int64)
    depths = np.array([len(p.x1) for p in paths], np.int64)
    first, last = int(own[0]), int(own[-1])
    before = int(common[first])
    after = int(common[last + 1]) if last + 1 < len(paths) else -1
    common[first] = -1
    shared, depth = common[own], depths[own]
    fresh = depth - shared  # nodes that each path adds

    # Nodes in order: each path adds those of depths shared + 1 to its own.
    path_of = np.repeat(np.arange(len(own)), fresh)
    n = len(path_of)
    begin = np.cumsum(fresh) - fresh
    node_depth = shared[path_of] + 1 + np.arange(n) - begin[path_of]
    parent = np.arange(n) - 1
    on_path = np.zeros(int(depth.max()) + 2, np.int64)  # the node of each depth of the path at hand
    end_node = np.empty(len(own), np.int64)
    for i, (a, s, d) in enumerate(zip(begin.tolist(), shared.tolist(), depth.tolist())):
        if d > s:
            parent[a] = on_path[s] if s >= 0 else -1
            on_path[s + 1 : d + 1] = np.arange(a, a + d - s)
        end_node[i] = on_path[d]
    last_spine = on_path[: depth[-1] + 1].copy()

    opens = np.repeat(np.tile([False, True], len(own)), np.stack([np.append(0, depth[:-1] - shared[1:]), fresh], axis=1).ravel())
    tree = Parentheses(np.concatenate([opens, np.zeros(depth[-1] + 1, bool)]))
    closes = tree.close(tree.places)
    stop = np.arange(n) + (closes - tree.places + 1) // 2  # the node after each subtree

    # A node, or a leaf, counts in the shard where it first occurs.
    new = np.ones(n, bool)
    new[: before + 1] = False
    leaf = np.zeros(len(tree.opens) + 1, np.int64)
    leaf[tree.leaf_pairs()] = 1
    if after == depth[-1]:
        leaf[tree.places[end_node[-1]]] = 0
    ranks = np.concatenate([[0], np.cumsum(leaf)])
    n_leaves = ranks[closes] - ranks[tree.places]

    ending = np.zeros(n, np.int64)
    ending[end_node] = rows["n"].to_numpy()[own].astype(np.int64)
    running = lambda values: np.concatenate([[0], np.cumsum(values)])
    below = lambda values: (lambda sums: sums[stop] - sums[:n])(running(values))
    n_convs = below(ending)
    at_turn = (offsets[:-1] - base)[own][path_of] + np.maximum(node_depth - 1, 0)
    last_size = np.zeros(n, np.int64)
    last_size[node_depth > 0] = size[at_turn[node_depth > 0]]
    saved = below((n_convs - new) * last_size)
    n_children = np.bincount(parent[new & (parent >= 0)], minlength=n)

    smallest = np.full(n, np.iinfo(np.int64).max)
    smallest[end_node] = rows["conv_id"].to_numpy()[own].astype(np.int64)
    by_depth = np.argsort(-node_depth, kind="stable")
    for level in np.split(by_depth, np.flatnonzero(np.diff(node_depth[by_depth])) + 1):
        if node_depth[level[0]] > 0:
            np.minimum.at(smallest, parent[level], smallest[level])

    k1, k2 = (_node_keys(x1, x2, offsets[:-1] - base, offsets[1:] - base, seed)[at_turn] for seed in (1, 2))
    k1[node_depth == 0] = k2[node_depth == 0] = 0
    is_open = np.zeros(n, bool)
    is_open[: before + 1] = True
    is_open[last_spine[: after + 1]] = True
    parent_open = np.append(is_open, False)[parent]
    ends = np.full(n, None, object)
    ends[end_node] = np.array(rows["ends"].to_pylist(), object)[own]
    missing = parent < 0
    up = lambda values: pa.array(values[parent], mask=missing)
    columns = [
        pa.array(node_depth), pa.array(k1), pa.array(k2), up(k1), up(k2), pa.array(smallest), up(smallest),
        pa.array(n_convs), pa.array(n_children), pa.array(n_leaves), pa.array(saved), pa.array(ends, pa.string()),
        pa.array(is_open), pa.array(parent_open),
    ]
    names = [c.split()[0] for c in NODES.split(", ")]
    table = pa.RecordBatch.from_arrays([c.cast(pa.int64()) if pa.types.is_integer(c.type) else c for c in columns], names=names)
    for at in range(0, n, 50_000):
        yield table.slice(at, 50_000)


def _node_keys(x1: np.ndarray, x2: np.ndarray, begins: np.ndarray, stops: np.ndarray, seed: int) -> np.ndarray:
    """A number per turn for its path up to there: that of the path before it, mixed with the turn's place and digest."""
    if not len(x1):
        return np.zeros(1, np.int64)
    place = np.arange(len(x1)) - np.repeat(begins, stops - begins)
    salt = seeded(2, seed)
    turn = mixed(mixed(x1.astype(np.uint64) ^ salt[0]) + mixed(x2.astype(np.uint64) + salt[1] * (place.astype(np.uint64) + np.uint64(1))))
    # Places are part of the numbers, so sums stand for sequences.
    sums = np.concatenate([[np.uint64(0)], np.cumsum(turn, dtype=np.uint64)])
    return mixed(sums[1:] - np.repeat(sums[begins], stops - begins)).view(np.int64)


def _merged(nodes: DataFrame) -> DataFrame:
    """Add up what shards say of shared nodes, and give nodes below them their parent's smallest conversation."""
    shared = nodes.where("is_open").groupBy(*NODE_KEY).agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in COUNTS], F.max("ends").alias("ends"), F.max("u1").alias("u1"), F.max("u2").alias("u2"),
    )
    shared = materialized(shared)
    known = nodes.where("NOT is_open AND NOT parent_open")
    below = nodes.where("NOT is_open AND parent_open").drop("parent_conv_id")
    below = below.select(*shared.columns).unionByName(shared)
    parents = shared.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("conv_id").alias("parent_conv_id"))
    below = below.join(broadcast_if_small(parents), ["depth", "u1", "u2"], "left")
    columns = ["conv_id", "depth", "parent_conv_id", *COUNTS, "ends"]
    rows = known.select(*columns).unionByName(below.select(*columns))
    nobody = hashlib.sha256(b"").hexdigest()
    return rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(nobody)).alias("ends_sha256")
    )


# -- the same in SQL -----------------------------------------------------------


def oracle() -> str:
    """Every prefix of every rebuilt conversation, grouped; subtrees by joining nodes to the nodes above them."""
    steps = "[CASE WHEN i % 9 = 0 THEN ascii(substr(s, CAST(i // 9 + 1 AS INT), 1)) ELSE -1 END FOR i IN range(9 * length(s))]"
    step = "CASE WHEN y >= 0 THEN xor(x, y) WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda x, y: {step}), 4294967295)"
    return f"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
            substr(sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, 30)) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, {crc} % 6 AS h FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM turns)
), rebuilt AS (
    SELECT c.conv_id, 0 AS own, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.pos < c.h
    UNION ALL
    SELECT c.conv_id, 1 AS own, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h
), prefixes AS (
    SELECT conv_id, row_number() OVER w AS depth, length(text) AS size,
        sha256(string_agg(sha256(length(role)::VARCHAR || ':' || role || text), '') OVER w) AS key
    FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos ROWS UNBOUNDED PRECEDING)
    UNION ALL
    SELECT conv_id, 0, 0, '' FROM convs
), placed AS (
    SELECT p.*, up.key AS parent, max(p.depth) OVER (PARTITION BY p.conv_id) = p.depth AS is_end
    FROM prefixes p LEFT JOIN prefixes up ON up.conv_id = p.conv_id AND up.depth = p.depth - 1
), nodes AS (
    SELECT depth, key, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
    FROM placed GROUP BY depth, key
), with_children AS (
    SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.parent = n.key) AS n_children FROM nodes n
), subtrees AS (
    SELECT above.depth, above.key, count(*) FILTER (below.n_children = 0) AS n_leaves, sum((below.n_convs - 1) * below.size) AS saved_tokens
    FROM with_children below JOIN prefixes above ON above.conv_id = below.conv_id AND above.depth <= below.depth GROUP BY above.depth, above.key
)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM with_children n JOIN subtrees s USING (depth, key) LEFT JOIN nodes up ON up.depth = n.depth - 1 AND up.key = n.parent
"""
