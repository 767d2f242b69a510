"""A bit map of hashes, small enough for every task whatever the number of hashes."""

from __future__ import annotations

import numpy as np
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The map has up to this many bits (16 MB).
MOST_BITS = 27


def bit_map(hashes: DataFrame, column: str) -> Broadcast:
    """A broadcast map in which the bit of every hash of ``column`` (a BIGINT, evenly spread) is set.

    It has some eight bits per hash, up to ``2 ** MOST_BITS``. A hash whose bit is
    not set is not in the column; one whose bit is set may be.
    """
    spark = hashes.sparkSession
    bits = min(MOST_BITS, max(16, (8 * hashes.count()).bit_length()))
    place = F.shiftrightunsigned(column, 64 - bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    words = hashes.select(F.shiftright(place, 6).alias("word"), bit.alias("bit"))
    # At most 2 ** (bits - 6) rows.
    table = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast((bits, out))


def may_hold(shared: tuple[int, np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes have their bit set."""
    bits, words = shared
    place = hashes.view(np.uint64) >> np.uint64(64 - bits)
    return (words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
