"""Dense row numbers without a global sort in one task, and equal ranges over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinestar.session import ensure_checkpoint_dir

_ROW_BITS = 33  # monotonically_increasing_id() = partition << 33 | row in partition


def dense_key(frame: DataFrame, *order: str, key: str = "id") -> DataFrame:
    """Add a key 0..n-1 that follows the given order, which must identify a row.

    Range partitions are sorted on their own; a partition's first key is the
    number of rows before it. The sorted rows are checkpointed first: counting
    and numbering are two jobs and must see the same partitions. Those offsets
    are one row per partition, hence the broadcast and the unpartitioned window.
    """
    ensure_checkpoint_dir(frame.sparkSession)
    rows = frame.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    place = F.monotonically_increasing_id()
    rows = rows.withColumn("_part", F.shiftright(place, _ROW_BITS)).withColumn(
        "_row", place.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_first"))
    )
    return (
        rows.join(F.broadcast(offsets), "_part")
        .withColumn(key, F.col("_first") + F.col("_row"))
        .drop("_part", "_row", "_first")
    )


def range_slice(key: str, i: int, slices: int, rows: int) -> Column:
    """Condition for the i-th of `slices` equal half-open ranges over keys 0..rows-1.

    Integer bounds: every key falls into exactly one range, also where the
    number of rows is not a multiple of the number of slices.
    """
    return (F.col(key) >= i * rows // slices) & (F.col(key) < (i + 1) * rows // slices)


def range_slices(frame: DataFrame, slices: int, *order: str) -> DataFrame:
    """Number the rows densely and add the `slice` (0..slices-1) of each row's range."""
    numbered = dense_key(frame, *order)
    rows = numbered.count()
    return numbered.withColumn("slice", F.expr(f"((id + 1) * {slices} - 1) div {max(rows, 1)}"))
