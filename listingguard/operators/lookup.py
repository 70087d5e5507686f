"""Left joins against fitted tables: broadcast only when the size is checked, skew-safe beyond that."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
HOT_KEYS = 1_000
SCATTER = 4_096
#: Bits per key of ``may_hold``, and bits in all (16 MB).
FILTER_BITS = 16
MOST_FILTER_BITS = 2**27


def fits_broadcast(table: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a stage table has at most ``limit`` rows (answered from the file footers and a limit)."""
    return table.limit(limit + 1).count() <= limit


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """``df`` with the columns of a one-row result, read through a scalar subquery instead of a join."""
    row = one_row.select(F.struct("*")).scalar()
    return df.withColumn("_one", row).select(*df.columns, *[F.col("_one")[c].alias(c) for c in one_row.columns])


def left_lookup(
    big: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    row_id: str = "listing_id",
    freq: str | None = None,
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """``big`` left-joined with a one-row-per-key stage ``table``.

    Small table: broadcast. Large table: the ``HOT_KEYS`` most frequent keys are broadcast (a fixed bound), and
    rows with a hot or missing key get a scattered, never-matching salt in the shuffled join, so no
    partition holds more than its share; rows without the column ``row_id`` are scattered by their place. ``freq`` names the key frequency in ``table``; it is counted from
    ``big`` when absent.
    """
    keys = list(keys)
    values = [c for c in table.columns if c not in keys and c != freq]
    if fits_broadcast(table, limit):
        return big.join(F.broadcast(table.select(*keys, *values)), keys, "left")
    if freq is None:
        present = F.lit(True)
        for k in keys:
            present = present & F.col(k).isNotNull()
        top = big.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("_freq"))
        top = top.orderBy(F.desc("_freq"), *keys).limit(HOT_KEYS)
        hot = table.join(F.broadcast(top), keys).select(*keys, *values)
    else:
        hot = table.orderBy(F.desc(freq), *keys).limit(HOT_KEYS).select(*keys, *values)
    hot = hot.select(*keys, F.struct(*values).alias("_hot"))
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    spread = F.xxhash64(row_id) if row_id in big.columns else F.monotonically_increasing_id()
    scattered = big.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(F.col("_hot").isNotNull() | missing, -1 - F.pmod(spread, F.lit(SCATTER))).otherwise(0)
    )
    cold = table.select(*keys, F.lit(0).cast("long").alias("_salt"), F.struct(*values).alias("_cold"))
    picked = F.coalesce(F.col("_hot"), F.col("_cold"))
    return (
        scattered.join(cold, [*keys, "_salt"], "left")
        .withColumn("_hit", picked)
        .select(*big.columns, *[F.col("_hit")[v].alias(v) for v in values])
    )


def may_hold(table: DataFrame, keys: Sequence[str]) -> Column:
    """A condition on rows with columns ``keys``: it holds for all that are in the stage ``table`` and for few others.

    Each key of the table sets one bit; the bits reach the rows as one scalar of a fixed size at most.
    """
    bits = min(MOST_FILTER_BITS, 64 << (table.count() * FILTER_BITS // 64).bit_length())
    at = F.pmod(F.xxhash64(*keys), F.lit(bits).cast("bigint"))
    word, bit = F.shiftright(at, 6).cast("int"), F.pmod(at, F.lit(64)).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    held = table.groupBy(word.alias("word")).agg(F.bit_or(mask).alias("bits")).toArrow()
    words = np.zeros(bits // 64, "int64")
    words[held["word"].to_numpy()] = held["bits"].to_numpy()
    whole = table.sparkSession.createDataFrame(pa.table({"words": pa.array([words], pa.list_(pa.int64()))})).scalar()
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return present & (F.get(whole, word).bitwiseAND(mask) != 0)
