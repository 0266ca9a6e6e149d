"""Error terms, clipping and labels as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import EPSILON, TREND_BAND


def clip_sanitize(yhat: Column, cap: Column) -> Column:
    """Clip a prediction into [0, cap]; NaN/null become EPSILON.

    NaN and null are tested before clipping: ``least(NaN, cap)`` would give
    ``cap`` in Spark, while the reproduced rule keeps NaN through the clip and
    replaces it afterwards. +inf clips to ``cap``, -inf to 0.
    """
    clipped = F.greatest(F.lit(0.0), F.least(yhat, cap))
    return F.when(yhat.isNull() | F.isnan(yhat), F.lit(EPSILON)).otherwise(clipped)


def ape(y: Column, yhat: Column) -> Column:
    """Absolute percentage error term |(y - yhat + eps) / (y + eps)|."""
    return F.abs((y - yhat + F.lit(EPSILON)) / (y + F.lit(EPSILON)))


def mean_in_order(value: Column, order: Column) -> Column:
    """Mean of the non-null values of a group, added up in the order of ``order``.

    ``avg`` adds in whatever order rows and partial sums arrive, so equal groups may differ in the last digit and ties
    between them fall either way; this sum is the same for any partitioning. Groups are as long as the hold-out."""
    rows = F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v"))))
    values = F.transform(F.array_sort(rows), lambda r: r["v"])
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values))


def rescale_accuracy(mape: Column) -> Column:
    """max(0, 100 - mape); null without an error."""
    return F.when(mape.isNotNull(), F.greatest(F.lit(0.0), F.lit(100.0) - mape))


def trend_label(last_actual: Column, forecast: Column) -> Column:
    """UP / DW / NC against a +/-10 % band; UP is tested first; null if either is missing."""
    up = last_actual + last_actual * F.lit(TREND_BAND)
    down = last_actual - last_actual * F.lit(TREND_BAND)
    return (F.when(forecast >= up, F.lit("UP"))
            .when(forecast <= down, F.lit("DW"))
            .when(forecast.isNotNull() & last_actual.isNotNull(), F.lit("NC")))


def trend_pct(last_actual: Column, forecast: Column) -> Column:
    """|(forecast - last + eps) / (last + eps)| * 100."""
    return F.abs((forecast - last_actual + F.lit(EPSILON)) / (last_actual + F.lit(EPSILON)) * F.lit(100.0))


def vs_baseline_label(rmodel: Column, rbase: Column) -> Column:
    """BETTER / WORST / EQUAL of the rescaled model vs baseline accuracy; null if either is missing."""
    return (F.when(rmodel > rbase, F.lit("BETTER"))
            .when(rmodel < rbase, F.lit("WORST"))
            .when(rmodel == rbase, F.lit("EQUAL")))


def vs_baseline_gap(rmodel: Column, rbase: Column) -> Column:
    """Absolute gap between the two accuracies, 0.0 when equal; null if either is missing."""
    return F.abs(rmodel - rbase)
