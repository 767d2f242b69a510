"""Compare a corpus listing with the manifest of an index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.functions.text import fold_name
from lexispan.sources.corpus import FINGERPRINT

# Version of the text rules; rows of another version are not used.
INDEX_VERSION = 2

ACTIONS = ["new", "updated", "skipped", "deleted", "failed"]


def classify(listing: DataFrame, manifest: DataFrame, partial: bool = False, version: int | None = None) -> DataFrame:
    """``(doc_id, action, known, mtime, n, usable, ...)`` with the old location; ``n`` is 1.

    A document is skipped only if its fingerprint is unchanged *and* its stored
    index is of the given version (by default the current one) and usable
    (``manifest.usable``, true if there is no such column).
    A ``partial`` listing says nothing about documents it does not mention; it
    may have a ``deleted`` flag per row. With a ``sequence`` on both sides, a later
    one counts as updated whatever it says, so that the manifest learns of it.
    """
    ordered = "sequence" in listing.columns and "sequence" in manifest.columns
    if "deleted" not in listing.columns:
        listing = listing.withColumn("deleted", F.lit(False))
    if "usable" not in manifest.columns:
        manifest = manifest.withColumn("usable", F.lit(True))
    location = [c for c in ("run", "part") if c in manifest.columns]
    sequence = ["sequence"] if ordered else []
    now = listing.select(
        "doc_id", F.lit(True).alias("listed"), "deleted", *[F.col(c).alias(f"now_{c}") for c in (*FINGERPRINT, *sequence)]
    )
    old = manifest.select(
        "doc_id",
        F.lit(True).alias("stored"),
        "usable",
        *[F.col(c).alias(f"old_{c}") for c in (*FINGERPRINT, "index_version", *location, *sequence)],
    )
    pairs = now.join(old, "doc_id", "left" if partial else "full_outer")
    gone = F.col("listed").isNull() | F.col("deleted")
    known = F.col("stored").isNotNull()
    later = F.coalesce(F.col("now_sequence") > F.col("old_sequence"), F.lit(False)) if ordered else F.lit(False)
    same = _unchanged(INDEX_VERSION if version is None else version) & F.col("usable") & ~later
    action = F.when(gone, "deleted").when(~known, "new").when(same, "skipped").otherwise("updated")
    return pairs.where(~gone | known).select(
        "doc_id",
        action.alias("action"),
        known.alias("known"),
        F.col("now_mtime").alias("mtime"),
        F.lit(1).cast("long").alias("n"),
        F.coalesce("usable", F.lit(True)).alias("usable"),
        *[f"old_{c}" for c in location],
    )


def _unchanged(version: int) -> Column:
    """Equal fingerprints, as far as the listing knows them without reading content."""
    same = F.col("now_mtime").eqNullSafe(F.col("old_mtime")) & (F.col("old_index_version") == version)
    for name in ("size", "content_hash"):
        same = same & (F.col(f"now_{name}").isNull() | F.col(f"now_{name}").eqNullSafe(F.col(f"old_{name}")))
    return same


def names_only(listing: DataFrame) -> DataFrame:
    """A listing without what it takes reading content to know, for when there is nothing to compare."""
    return listing.withColumns({c: F.lit(None).cast("long") for c in ("size", "content_hash")})


def settle_failures(plan: DataFrame, indexed: DataFrame) -> DataFrame:
    """The plan after reading: new or updated documents not in ``indexed`` have failed."""
    read = indexed.select("doc_id", F.lit(True).alias("_read"))
    attempted = F.col("action").isin("new", "updated")
    outcome = F.when(attempted & F.col("_read").isNull(), "failed").otherwise(F.col("action"))
    return plan.join(read, "doc_id", "left").withColumn("action", outcome).drop("_read")


def surplus_rows(names: DataFrame) -> DataFrame:
    """Rows of a listing that cannot be indexed, as failed: ``n`` repeats of a name, or ``n`` rows without one."""
    unnamed = F.col("doc_id").isNull()
    return names.where(unnamed | (F.col("copies") > 1)).select(
        "doc_id",
        F.lit("failed").alias("action"),
        F.lit(False).alias("known"),
        F.lit(None).cast("timestamp").alias("mtime"),
        F.when(unnamed, F.col("copies")).otherwise(F.col("copies") - 1).alias("n"),
    )


def build_summary(actions: DataFrame) -> DataFrame:
    """One row of counts: new, updated, skipped, deleted, failed."""
    n = F.coalesce("n", F.lit(1))
    return actions.agg(*[F.coalesce(F.sum(F.when(F.col("action") == a, n)), F.lit(0)).alias(a) for a in ACTIONS])


def log_order() -> list[Column]:
    """Order of the action log: by folded name, deletions after everything else."""
    return [F.col("action") == "deleted", fold_name(F.col("doc_id")), F.col("doc_id")]
