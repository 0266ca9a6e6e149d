"""Naive, persistence, seasonal-naive and drift predictors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ...functions.constants import BASELINE, HORIZON, N_TEST


def baseline_naive(split: DataFrame, future: DataFrame | None = None) -> DataFrame:
    """Last training value repeated over the hold-out, last value over the future.

    ``split`` is the output of ``series.tail_split``; ``future`` of
    ``series.future_months``. Returns long predictions
    (item_id, model, phase, t, ds, yhat) before clipping.
    """
    last_train = (split.filter(~F.col("is_test")).groupBy("item_id")
                  .agg(F.max_by("y", "t").alias("yhat")))
    test = split.filter("is_test").select("item_id", "t", "ds").join(last_train, "item_id")
    out = test.select("item_id", F.lit(BASELINE).alias("model"), F.lit("test").alias("phase"), "t", "ds", "yhat")
    if future is not None:
        last_all = split.groupBy("item_id").agg(F.max_by("y", "t").alias("yhat"))
        fut = future.select("item_id", "t", "ds").join(last_all, "item_id")
        out = out.unionByName(
            fut.select("item_id", F.lit(BASELINE).alias("model"), F.lit("future").alias("phase"), "t", "ds", "yhat"))
    return out


def baseline_persistence(split: DataFrame) -> DataFrame:
    """Lag-1 prediction over the hold-out (previous actual)."""
    w = Window.partitionBy("item_id").orderBy("t")
    lagged = split.select("item_id", "t", "ds", "is_test", F.lag("y", 1).over(w).alias("yhat"))
    return lagged.filter("is_test").select("item_id", F.lit("Persistence").alias("model"),
                                           F.lit("test").alias("phase"), "t", "ds", "yhat")


def seasonal_naive(split: DataFrame, n_test: int = N_TEST, horizon: int = HORIZON, period: int = 12) -> DataFrame:
    """The value one period earlier, over the hold-out and the future (periods longer than both)."""
    from ..series import month_start_of_index
    back = split.select("item_id", (F.col("t") + F.lit(period)).alias("t"), F.col("y").alias("yhat"))
    last = split.groupBy("item_id").agg(F.max("t").alias("last"))
    known = back.join(last, "item_id").filter((F.col("t") > F.col("last") - F.lit(n_test)) & (F.col("t") <= F.col("last") + F.lit(horizon)))
    phase = F.when(F.col("t") <= F.col("last"), F.lit("test")).otherwise(F.lit("future"))
    return known.select("item_id", F.lit("SeasonalNaive").alias("model"), phase.alias("phase"), "t",
                        month_start_of_index(F.col("t")).alias("ds"), "yhat")


def drift(split: DataFrame, n_test: int = N_TEST, horizon: int = HORIZON) -> DataFrame:
    """The line through the first and last value of the fitted months, carried on."""
    from ..series import month_start_of_index
    fits = (split.filter(~F.col("is_test")).select("item_id", "t", "y", F.lit("test").alias("phase"), F.lit(n_test).alias("steps"))
            .unionByName(split.select("item_id", "t", "y", F.lit("future").alias("phase"), F.lit(horizon).alias("steps"))))
    line = (fits.groupBy("item_id", "phase", "steps")
            .agg(F.min_by("y", "t").alias("y0"), F.max_by("y", "t").alias("y1"), F.min("t").alias("t0"), F.max("t").alias("t1"))
            .filter("t1 > t0"))
    out = line.select("*", F.explode(F.sequence(F.lit(1), F.col("steps"))).alias("h"))
    t = F.col("t1") + F.col("h")
    slope = (F.col("y1") - F.col("y0")) / (F.col("t1") - F.col("t0")).cast("double")
    return out.select("item_id", F.lit("Drift").alias("model"), "phase", t.alias("t"), month_start_of_index(t).alias("ds"),
                      (F.col("y1") + F.col("h") * slope).alias("yhat"))
