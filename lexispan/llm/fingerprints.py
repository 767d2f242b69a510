"""Document fingerprints: bottom-k sketches of word shingles.

A sketch is the sorted array of the ``K`` least hashes of a text's distinct
shingles. The least ``K`` of two sketches' union are the sketch of both texts
together, so sketches of parts merge, and the share of them that both sketches
hold estimates resemblance. Everything is built-in functions on arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 128
SHINGLE = 5

# Hashes are spread evenly over this many values.
HASHES = 2.0**64

# Rows of neighbouring documents handled together, and cells their ids are counted in.
BUCKET_ROWS = 1500
CELLS = 1 << 14


def shingle_hashes(text: Column, width: int = SHINGLE) -> Column:
    """Hashes of all runs of ``width`` words, in lower case; of the whole sequence if it is shorter; none without words."""
    breaks = "\t\n\x0b\x0c\r"
    words = F.array_remove(F.split(F.translate(F.lower(F.coalesce(text, F.lit(""))), breaks, " " * len(breaks)), " "), "")

    def runs(words: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.size(words) - (width - 1), F.lit(1)))
        return F.when(F.size(words) > 0, F.transform(places, lambda i: F.xxhash64(F.slice(words, i, width)))).otherwise(F.array().cast("array<bigint>"))

    # Bound once, so the words are split once per text.
    return F.element_at(F.transform(F.array(words), runs), 1)


def sketch(text: Column, width: int = SHINGLE, k: int = K) -> Column:
    """The ``k`` least distinct shingle hashes, ascending; a null text is empty."""
    return least(F.array_distinct(shingle_hashes(text, width)), k)


def least(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(hashes), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two texts' shingles together."""
    return least(F.array_union(a, b), k)


def merged_sketches(sketches: DataFrame, by: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group. Salted part sketches come first, so no group is gathered whole."""
    def reduced(rows: DataFrame, keys: list[str]) -> DataFrame:
        each = rows.select(*keys, F.explode(column).alias("_h")).distinct()
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_h"))
        few = each.withColumn("_rank", rank).where(F.col("_rank") <= k)
        return few.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(column))

    empty = sketches.groupBy(*by).agg(F.lit(0).alias("_none")).drop("_none")
    parts = reduced(sketches.withColumn("_salt", F.pmod(F.xxhash64(column), F.lit(64))), [*by, "_salt"])
    found = reduced(parts, by)
    same = [F.col(f"e.{c}").eqNullSafe(F.col(f"f.{c}")) for c in by]
    on = same[0]
    for condition in same[1:]:
        on = on & condition
    return empty.alias("e").join(found.alias("f"), on, "left").select(
        *[F.col(f"e.{c}") for c in by], F.coalesce(F.col(f"f.{column}"), F.array().cast("array<bigint>")).alias(column)
    )


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of shingles in both texts of those in either: exact for small sets, 1 for two empty ones."""
    def of(both: Column) -> Column:
        shared = F.size(F.array_intersect(both, F.array_intersect(a, b)))
        return F.when(F.size(both) == 0, 1.0).otherwise(shared / F.size(both))

    return F.element_at(F.transform(F.array(merged(a, b, k)), of), 1)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below ``k``."""
    reach = (F.element_at(a, F.size(a)).cast("double") + HASHES / 2) / HASHES
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / reach)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    shared = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits per hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def with_next(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``(id, text, sketch, next_text, next_sketch)``: each document with the next one by id, the last with the first.

    Ids are whole numbers. Null ids come first; equal ids go by their texts, and
    rows equal in both are interchangeable. Ids are cut into ranges of some
    ``BUCKET_ROWS`` documents, so each text is shuffled once; the first document
    of a range is also put behind the range before. Ranges come from cells of equal
    width, and a cell with too many documents is cut again between its own least
    and greatest id, so ids may lie as unevenly as they like. Rows that share one
    id, or have none, are not cut.
    """
    plain = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    ends = plain.agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n")).first()
    low, high = ends["low"] or 0, ends["high"] or 0
    cell = F.coalesce(F.floor((F.col("id").cast("decimal(20,0)") - F.lit(low)) * CELLS / (high - low + 1)), F.lit(0)).cast("int")
    limit = max(BUCKET_ROWS, ends["n"] // CELLS)
    plain = _cut_again(plain.withColumn("cell", F.array(cell)), 2 * limit)
    # At most CELLS rows per level, so one task orders them and every task may hold them.
    counted = plain.groupBy("cell").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    ranges = counted.select("cell", F.floor(before / limit).alias("bucket"))
    plain = plain.join(F.broadcast(ranges), "cell").drop("cell")
    narrow = plain.groupBy("bucket").agg(F.min(F.struct(F.col("id").isNotNull().alias("known"), "id")).alias("first"))
    by_bucket = Window.orderBy("bucket")
    last = F.max("bucket").over(by_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = narrow.select("bucket", F.col("first.id").alias("head"), F.coalesce(F.lag("bucket").over(by_bucket), last).alias("behind"))
    is_head = (F.col("p.bucket") == F.col("h.bucket")) & F.col("p.id").eqNullSafe(F.col("h.head"))
    copies = plain.alias("p").join(F.broadcast(heads).alias("h"), is_head).select("p.id", "p.text", F.col("h.behind").alias("bucket"), F.lit(1).alias("behind"))
    rows = plain.select("id", "text", "bucket", F.lit(0).alias("behind")).unionByName(copies).withColumn("sketch", sketch(F.col("text")))
    order = Window.partitionBy("bucket").orderBy("behind", F.asc_nulls_first("id"), "text")
    both = rows.withColumns({"next_text": F.lead("text").over(order), "next_sketch": F.lead("sketch").over(order)})
    return both.where("behind = 0").drop("behind", "bucket")


def _cut_again(plain: DataFrame, limit: int) -> DataFrame:
    """Cells of more than ``limit`` documents cut by their own ids, until none is left or its ids are all equal."""
    # Each level cuts the width of a cell to half at least; few are ever needed.
    while True:
        sizes = plain.groupBy("cell").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
        large = sizes.where((F.col("n") > limit) & (F.col("low") < F.col("high"))).select("cell", "low", "high")
        n_large = large.count()
        if not n_large:
            return plain
        offset = F.col("id").cast("decimal(20,0)") - F.col("low").cast("decimal(20,0)")
        width = F.col("high").cast("decimal(20,0)") - F.col("low").cast("decimal(20,0)") + 1
        inner = F.coalesce(F.floor(offset * max(2, CELLS // n_large) / width), F.lit(0)).cast("int")
        cut = F.when(F.col("low").isNotNull(), F.concat("cell", F.array(inner))).otherwise(F.col("cell"))
        plain = plain.join(F.broadcast(large), "cell", "left").withColumn("cell", cut).drop("low", "high")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_shingles, in_edited)``.

    The edited text has the last half of its code points (rounded down)
    replaced by as many from the start of the next document, or all of it.
    """
    rows = with_next(docs, id_column, text_column).withColumn("n", F.char_length("text"))
    half = F.floor(F.col("n") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", edited).withColumn("edited_sketch", sketch(F.col("edited")))
    own, other = F.col("sketch"), F.col("edited_sketch")
    return rows.select(
        F.col("id").alias(id_column), F.col("n").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(own).alias("fingerprint"), as_text(other).alias("edited_fingerprint"), resemblance(own, other).alias("near_edited"),
        resemblance(own, F.col("next_sketch")).alias("near_next"), distinct_shingles(own).alias("n_shingles"), containment(own, other).alias("in_edited"),
    )
