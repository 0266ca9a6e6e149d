"""Supervised features from series: lags, leads, walk-forward origins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lag_features(split: DataFrame, n_in: int = 6, n_out: int = 1, dropnan: bool = True,
                 value: str = "y") -> DataFrame:
    """lag_1..lag_n_in and (n_out > 1) lead_1..lead_{n_out-1} per item.

    One window per item ordered by month; rows lacking any lag or lead are
    dropped when ``dropnan``. Series are dense after gap filling, so a lag
    of k rows is a lag of k months.
    """
    w = Window.partitionBy("item_id").orderBy("t")
    cols = [F.lag(value, i).over(w).alias(f"lag_{i}") for i in range(1, n_in + 1)]
    cols += [F.lead(value, i).over(w).alias(f"lead_{i}") for i in range(1, n_out)]
    out = split.select("*", *cols)
    if dropnan:
        names = [f"lag_{i}" for i in range(1, n_in + 1)] + [f"lead_{i}" for i in range(1, n_out)]
        out = out.dropna(subset=names)
    return out


def walk_forward_origins(split: DataFrame) -> DataFrame:
    """Every hold-out month as a forecast origin with its history size.

    The history of origin o is every month of the item before o (earlier
    hold-out actuals included, as a walk-forward appends them). For a dense
    series that is the row position, and the last history value is the
    previous row: one window, no self join.
    """
    w = Window.partitionBy("item_id").orderBy("t")
    out = split.select("item_id", "t", "is_test", "pos", F.lag("y", 1).over(w).alias("last_y"))
    return out.filter("is_test").select("item_id", F.col("t").alias("origin_t"),
                                        F.col("pos").alias("n_history"), "last_y")
