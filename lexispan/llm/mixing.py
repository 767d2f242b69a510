"""Mixing sources to target weights, in equal blocks of words.

Blocks are given to sources by highest quotients (Sainte-Lague), and those of a
source to its groups of shards and then its shards in the same way, so every
shard has an integer quota. A shard's documents stand in seeded order; its words
are cut into blocks, and the quota takes whole passes over the shard plus the
blocks of least seeded hash. A source of small target has smaller blocks, down
to one word, so that the words taken come near any target.

Everything is DataFrame code. Shards hold about ``SHARD_WORDS`` words and groups
about ``SHARDS_PER_GROUP`` shards, however large a source is, and every seeded
choice is a hash, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispan.sources.workspace import materialized

WORD = r"[^\x20\x09-\x0D]+"

# Weights of the sources in order of their names, repeating.
WEIGHTS = [5, 2, 1]

# Words per block at most; sources of small targets have smaller blocks, so that each still has many.
BLOCK_WORDS = 64
BLOCKS_PER_TARGET = 256

SHARD_WORDS = 1_000_000
SHARDS_PER_GROUP = 10_000

SEED = "mix"


def mixed_documents(
    docs: DataFrame, share: float = 1.5, most: int = 2, weights: list[int] | None = None, seed: str = SEED,
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
) -> DataFrame:
    """``(id, source, size, source_size, target, taken)`` for every row of ``docs``.

    The sources share ``share`` times all words by their weights; none gets more
    than ``most`` times its own, and what is left over goes to the others by
    weight. ``taken`` counts the words the mix takes of the document, repeats
    included: at most ``most`` times its size, 0 for a null or blank text. A
    null source is a source of its own, after all others. Rows with a null or
    repeated id are documents like any other.
    """
    words = F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select(F.col(id_column).alias("id"), F.col(source_column).alias("source"), words.alias("size"))
    taken = _mixed(materialized(sized), share, most, weights or WEIGHTS, seed)
    return taken.select(
        F.col("id").alias(id_column), F.col("source").alias(source_column), "size", "source_size", "target", "taken"
    )


def mixture(
    docs: DataFrame, share: float = 1.5, most: int = 2, weights: list[int] | None = None, seed: str = SEED,
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the words taken of it, over its size.

    A fraction is rounded up or down by a seeded hash in its proportion, so the
    words of a source stay near its target. Texts without words are not in the mix.
    """
    text = F.xxhash64(F.coalesce(F.col(text_column), F.lit("")))
    words = F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select(F.col(id_column).alias("id"), F.col(source_column).alias("source"), words.alias("size"), text.alias("digest"))
    taken = _mixed(materialized(sized.where("size > 0")), share, most, weights or WEIGHTS, seed)
    # Rows alike in id, source and text are interchangeable: they share what was taken of them.
    keys = ["id", "source", "digest"]
    shares = taken.groupBy(*keys).agg((F.sum("taken") / F.sum("size")).alias("share"))
    chance = _hash(F.lit(f"{seed}:copies"), "id", "digest") / 2.0**32
    copies = (F.floor("share") + (chance < F.col("share") - F.floor("share")).cast("int")).cast("int")
    shares = materialized(shares.withColumn("copies", copies).where("copies > 0").drop("share"))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_column).alias("id"), F.col(source_column).alias("source"), text.alias("digest"))
    on = F.col("r.digest") == F.col("s.digest")
    for c in ("id", "source"):
        on = on & F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}"))
    joined = rows.alias("r").join(shares.alias("s"), on).select("r.row", "s.copies")
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def _mixed(sized: DataFrame, share: float, most: int, weights: list[int], seed: str) -> DataFrame:
    targets = source_targets(sized, share, most, weights)
    quotas = materialized(shard_quotas(sized, targets, seed))
    return _taken(sized, targets, quotas, most, seed)


def source_targets(sized: DataFrame, share: float, most: int, weights: list[int]) -> DataFrame:
    """``(source, source_size, target, block, n_shards, blocks)``: one row per source.

    Sources reach their limit in order of limit per weight; the level at which
    the first of them stays below it is everyone's share per weight.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source: these windows have no other rows to order.
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % len(weights) + 1).cast("int"))
    sizes = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * most)
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.asc_nulls_last("source"))
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    words = F.sum("source_size").over(every) * share
    level = (words - F.coalesce(F.sum("limit").over(before), F.lit(0))) / F.sum("weight").over(onward)
    levels = sizes.withColumns({"level": level, "words": words})
    open_ = F.col("limit") / F.col("weight") > F.col("level")
    final = F.first(F.when(open_, F.col("level")), ignorenulls=True).over(every)
    target = F.coalesce(F.least(F.col("limit").cast("double"), final * F.col("weight")), F.col("limit").cast("double"))
    targets = levels.withColumn("target", target)
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).over(every)
    sized_for = lambda words: F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(words / BLOCKS_PER_TARGET))).cast("long")
    # Sources compete for blocks of one size, the smallest's; within a source they are put together to its own.
    units = {"unit": F.coalesce(sized_for(least), F.lit(BLOCK_WORDS)), "block": sized_for(F.col("target"))}
    n_shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD_WORDS))
    targets = targets.withColumns(units | {"n_shards": n_shards.cast("long")})
    seats = F.floor(F.sum("target").over(every) / F.col("unit") + 0.5).cast("long")
    allocated = sainte_lague(targets.withColumn("seats", seats), [], ["source"], "target", "seats", "won")
    blocks = F.floor(F.col("won") * F.col("unit") / F.col("block") + 0.5).cast("long").alias("blocks")
    return allocated.select("source", "source_size", "target", "block", "n_shards", blocks)


def shard_quotas(sized: DataFrame, targets: DataFrame, seed: str) -> DataFrame:
    """``(source, shard, shard_size, quota)``: the source's blocks shared out by size, to groups of shards, then within them."""
    shards = _sharded(sized, targets, seed).groupBy("source", "shard", "blocks").agg(F.sum("size").alias("shard_size"))
    shards = shards.withColumn("part", F.floor(F.col("shard") / SHARDS_PER_GROUP))
    parts = shards.groupBy("source", "part", "blocks").agg(F.sum("shard_size").alias("part_size"))
    parts = sainte_lague(parts, ["source"], ["part"], "part_size", "blocks", "part_blocks").drop("blocks", "part_size")
    shards = _with_source(shards.drop("blocks"), parts, "part")
    quotas = sainte_lague(shards, ["source", "part"], ["shard"], "shard_size", "part_blocks", "quota")
    return quotas.select("source", "shard", "shard_size", "quota")


def sainte_lague(parties: DataFrame, within: list[str], party: list[str], votes: str, seats: str, name: str) -> DataFrame:
    """Adds ``name``: the seats of each party, of ``seats`` given in its group, by highest quotients votes / (2 k - 1).

    Rounding a party's proportional share up or down is off by at most its part
    of half a seat per party, so seats below that range are certain, and only
    the quotients within it are compared: about three per party, however many
    seats there are. Equal quotients go by party. No votes, no seats.
    """
    group = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    total = F.sum(F.col(votes)).over(group).cast("double")
    n = F.count(F.lit(1)).over(group)
    share = F.when(total > 0, F.col(votes) / total * F.col(seats)).otherwise(0.0)
    slack = F.when(F.col(seats) > 0, n / (F.col(seats) * 2.0)).otherwise(0.0)
    ranged = parties.withColumns({"_share": share, "_slack": slack})
    certain = F.greatest(F.lit(0), F.floor(F.col("_share") * (1 - F.col("_slack")) - 0.5)).cast("long")
    possible = F.ceil(F.col("_share") * (1 + F.col("_slack")) + 0.5).cast("long")
    ranged = ranged.withColumns({"_certain": certain, "_possible": possible})
    ranged = ranged.withColumn("_open", F.col(seats) - F.sum("_certain").over(group))
    seat = F.explode_outer(F.when((F.col(votes) > 0) & (F.col("_possible") > F.col("_certain")), F.sequence(F.col("_certain") + 1, F.col("_possible"))))
    quotients = ranged.withColumn("_seat", seat).withColumn("_quotient", F.col(votes) / (2 * F.col("_seat") - 1))
    order = Window.partitionBy(*(within or [F.lit(0)])).orderBy(F.desc_nulls_last("_quotient"), *[F.asc_nulls_last(c) for c in party], "_seat")
    won = (F.col("_seat").isNotNull() & (F.row_number().over(order) <= F.col("_open"))).cast("long")
    counted = quotients.withColumn("_won", won).groupBy(*parties.columns, "_certain").agg(F.sum("_won").alias("_won"))
    return counted.withColumn(name, F.col("_certain") + F.col("_won")).select(*parties.columns, name)


def _hash(*parts: str | Column) -> Column:
    """32 bits of a digest of the parts, as a number."""
    text = F.concat_ws(":", *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def _sharded(sized: DataFrame, targets: DataFrame, seed: str) -> DataFrame:
    """Each document with its source's row and its shard; there are few sources, but their number is checked by size."""
    rows = _with_source(sized, targets)
    return rows.withColumn("shard", _hash(F.lit(seed), "id", "size") % F.col("n_shards"))


def _with_source(rows: DataFrame, other: DataFrame, *more: str) -> DataFrame:
    """Join on source, null included, and further columns."""
    on = F.col("r.source").eqNullSafe(F.col("o.source"))
    for c in more:
        on = on & (F.col(f"r.{c}") == F.col(f"o.{c}"))
    added = [F.col(f"o.{c}") for c in other.columns if c not in ("source", *more)]
    return rows.alias("r").join(other.alias("o"), on).select("r.*", *added)


def _taken(sized: DataFrame, targets: DataFrame, quotas: DataFrame, most: int, seed: str) -> DataFrame:
    rows = _with_source(_sharded(sized, targets, seed), quotas, "shard")
    shard = Window.partitionBy("source", "shard")
    seeded = shard.orderBy("seeded", F.asc_nulls_first("id"), "size")
    rows = rows.withColumn("seeded", _hash(F.lit(f"{seed}:order"), "id", "size"))
    rows = rows.withColumns({"row": F.row_number().over(seeded), "stop": F.sum("size").over(seeded.rowsBetween(Window.unboundedPreceding, 0))})
    n_blocks = F.greatest(F.lit(1), F.ceil(F.col("shard_size") / F.col("block"))).cast("long")
    passes = F.least(F.lit(most), F.floor(F.col("quota") / n_blocks)).cast("long")
    rows = rows.withColumns({"start": F.col("stop") - F.col("size"), "passes": passes, "rest": F.when(passes < most, F.col("quota") % n_blocks).otherwise(0)})
    first, last = F.floor(F.col("start") / F.col("block")), F.floor((F.col("stop") - 1) / F.col("block"))
    blocks = F.when((F.col("size") > 0) & (F.col("rest") > 0), F.sequence(first, last))
    pieces = rows.withColumn("piece", F.explode_outer(blocks))
    overlap = F.least(F.col("stop"), (F.col("piece") + 1) * F.col("block")) - F.greatest(F.col("start"), F.col("piece") * F.col("block"))
    pieces = pieces.withColumn("luck", F.when(F.col("piece").isNotNull(), _hash(F.lit(f"{seed}:block"), "source", "shard", "piece")))
    luck = F.dense_rank().over(shard.orderBy(F.asc_nulls_last("luck"), "piece"))
    chosen = F.when(F.col("piece").isNotNull() & (luck <= F.col("rest")), overlap).otherwise(0)
    pieces = pieces.withColumn("chosen", chosen)
    # By place in the shard, which no two rows share, whatever their ids.
    own = pieces.groupBy("source", "shard", "row").agg(
        *[F.first(c).alias(c) for c in ("id", *sized.columns[2:], "source_size", "target", "passes")], F.sum("chosen").alias("chosen")
    )
    return own.withColumn("taken", (F.col("passes") * F.col("size") + F.col("chosen")).cast("long"))


def oracle() -> str:
    """DuckDB SQL with the rows of :func:`mixed_documents` over ``documents``, at its defaults."""
    weights = "[" + ", ".join(map(str, WEIGHTS)) + "]"
    digest = lambda *parts: "('0x' || substr(md5(" + " || ':' || ".join(parts) + "), 1, 8))::BIGINT"
    text = lambda c: f"coalesce({c}::VARCHAR, '')"

    def seats(table: str, within: str, party: str, votes: str, n: str, name: str) -> str:
        by = f"PARTITION BY {within}" if within else ""
        return f"""
    {name}_ranged AS (
      SELECT *, CASE WHEN v > 0 THEN {votes} / v * {n} ELSE 0.0 END AS portion,
        CASE WHEN {n} > 0 THEN m / ({n} * 2.0::DOUBLE) ELSE 0.0 END AS slack
      FROM (SELECT *, sum({votes}) OVER ({by})::DOUBLE AS v, count(*) OVER ({by}) AS m FROM {table})),
    {name}_bounds AS (
      SELECT *, greatest(0, floor(portion * (1 - slack) - 0.5))::BIGINT AS certain, ceil(portion * (1 + slack) + 0.5)::BIGINT AS possible
      FROM {name}_ranged),
    {name}_open AS (SELECT *, {n} - sum(certain) OVER ({by}) AS vacant FROM {name}_bounds),
    {name}_quotients AS (
      SELECT *, {votes}::DOUBLE / (2 * seat - 1) AS quotient
      FROM (SELECT *, unnest(CASE WHEN {votes} > 0 AND possible > certain THEN range(certain + 1, possible + 1) ELSE [NULL] END) AS seat FROM {name}_open)),
    {name}_won AS (
      SELECT *, (seat IS NOT NULL AND row_number() OVER ({by} ORDER BY quotient DESC NULLS LAST, {party} NULLS LAST, seat) <= vacant)::BIGINT AS won
      FROM {name}_quotients)"""

    return f"""
    WITH sized AS (
      SELECT doc_id AS id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
    sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    weighted AS (
      SELECT *, {weights}[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::INT] AS weight, source_size * 2 AS most FROM sizes),
    levels AS (
      SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5 - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
        / (sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
      FROM weighted),
    aimed AS (
      SELECT *, coalesce(least(most::DOUBLE, first_value(CASE WHEN most / weight > level THEN level END IGNORE NULLS) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) * weight), most::DOUBLE) AS target FROM levels),
    blocked AS (
      SELECT *, CASE WHEN max(target) OVER () > 0 THEN greatest(1, least({BLOCK_WORDS}, floor(min(CASE WHEN target > 0 THEN target END) OVER () / {BLOCKS_PER_TARGET})))
          ELSE {BLOCK_WORDS} END::BIGINT AS unit,
        greatest(1, least({BLOCK_WORDS}, floor(target / {BLOCKS_PER_TARGET})))::BIGINT AS block,
        greatest(1, ceil(source_size / {SHARD_WORDS}))::BIGINT AS n_shards
      FROM aimed),
    seated AS (SELECT *, floor(sum(target) OVER () / unit + 0.5)::BIGINT AS seats FROM blocked),
    {seats("seated", "", "source", "target", "seats", "s")},
    targets AS (
      SELECT source, any_value(source_size) AS source_size, any_value(target) AS target, any_value(block) AS block,
        any_value(n_shards) AS n_shards, floor((any_value(certain) + sum(won)::BIGINT) * any_value(unit) / any_value(block) + 0.5)::BIGINT AS blocks
      FROM s_won GROUP BY source),
    sharded AS (
      SELECT z.*, source_size, target, block, n_shards, blocks, {digest(f"'{SEED}'", text("id"), text("size"))} % n_shards AS shard
      FROM sized z JOIN targets t ON z.source IS NOT DISTINCT FROM t.source),
    divided AS (SELECT source, shard, blocks, shard // {SHARDS_PER_GROUP} AS part, sum(size)::BIGINT AS shard_size FROM sharded GROUP BY ALL),
    parts AS (SELECT source, part, blocks, sum(shard_size)::BIGINT AS part_size FROM divided GROUP BY ALL),
    {seats("parts", "source", "part", "part_size", "blocks", "p")},
    parted AS (SELECT source, part, any_value(certain) + sum(won)::BIGINT AS part_blocks FROM p_won GROUP BY source, part),
    shards AS (
      SELECT d.source, d.part, shard, shard_size, part_blocks
      FROM divided d JOIN parted p ON d.source IS NOT DISTINCT FROM p.source AND d.part = p.part),
    {seats("shards", "source, part", "shard", "shard_size", "part_blocks", "q")},
    quotas AS (SELECT source, shard, shard_size, any_value(certain) + sum(won)::BIGINT AS quota FROM q_won GROUP BY source, shard, shard_size),
    placed AS (
      SELECT *, row_number() OVER w AS place, sum(size) OVER (w ROWS UNBOUNDED PRECEDING) AS stop
      FROM (SELECT h.*, shard_size, quota, {digest(f"'{SEED}:order'", text("id"), text("size"))} AS seeded
            FROM sharded h JOIN quotas q ON h.source IS NOT DISTINCT FROM q.source AND h.shard = q.shard)
      WINDOW w AS (PARTITION BY source, shard ORDER BY seeded, id NULLS FIRST, size)),
    passed AS (
      SELECT *, stop - size AS start, least(2, quota // greatest(1, ceil(shard_size / block)::BIGINT)) AS passes,
        CASE WHEN least(2, quota // greatest(1, ceil(shard_size / block)::BIGINT)) < 2 THEN quota % greatest(1, ceil(shard_size / block)::BIGINT) ELSE 0 END AS rest
      FROM placed),
    pieces AS (
      SELECT *, unnest(CASE WHEN size > 0 AND rest > 0 THEN range((start // block)::BIGINT, ((stop - 1) // block)::BIGINT + 1) ELSE [NULL] END) AS piece FROM passed),
    lucky AS (
      SELECT *, CASE WHEN piece IS NOT NULL THEN {digest(f"'{SEED}:block'", text("source"), text("shard"), text("piece"))} END AS luck FROM pieces),
    chosen AS (
      SELECT *, CASE WHEN piece IS NOT NULL AND dense_rank() OVER (PARTITION BY source, shard ORDER BY luck NULLS LAST, piece) <= rest
        THEN least(stop, (piece + 1) * block) - greatest(start, piece * block) ELSE 0 END AS words
      FROM lucky)
    SELECT any_value(id) AS doc_id, source, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
      (any_value(passes) * any_value(size) + sum(words))::BIGINT AS taken
    FROM chosen GROUP BY source, shard, place
    """
