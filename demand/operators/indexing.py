"""Dense, ordered row numbers without a single-partition window.

``row_number() OVER (ORDER BY ...)`` with no PARTITION BY moves every row
into one task. Instead: range-partition and sort by the order keys, take
``monotonically_increasing_id`` (partition id in the upper 31 bits, position
inside the partition in the lower 33), count rows per partition, and add the
running count of earlier partitions. The per-partition count table has one
row per partition, so broadcasting it is bounded by the partition count, not
by the data. The input is checkpointed first, so the upstream plan runs
once (not once for the range sampling and again for the rows); the sorted
rows with their ids are checkpointed too, so the per-partition counts and
the rows come from the same materialised partitions, also when a lost
executor's tasks are re-run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_LOW_BITS = (1 << 33) - 1


def dense_row_index(df: DataFrame, order_cols: list, name: str = "row_idx", start: int = 0,
                    num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = start + 0-based position of the row in ``order_cols`` order.

    ``order_cols`` must define a total order (ties get an arbitrary but
    stable order after the checkpoint).
    """
    df = cut_lineage(df)
    ranged = (df.repartitionByRange(num_partitions, *order_cols) if num_partitions
              else df.repartitionByRange(*order_cols))
    ordered = ranged.sortWithinPartitions(*order_cols).withColumn("_mid", F.monotonically_increasing_id())
    # the ids are materialised once: the count branch and the row branch must
    # see the same partitions (adaptive execution may coalesce two separate
    # evaluations of the range shuffle differently)
    ordered = cut_lineage(ordered)
    pos = ordered.select(
        "*",
        F.shiftright(F.col("_mid"), 33).alias("_pid"),
        F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)).alias("_pos"),
    )
    counts = pos.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    ).na.fill(0, ["_off"])
    out = pos.join(F.broadcast(offsets), "_pid")
    out = out.withColumn(name, (F.col("_off") + F.col("_pos") + F.lit(start)).cast("long"))
    return out.drop("_mid", "_pid", "_pos", "_off")
