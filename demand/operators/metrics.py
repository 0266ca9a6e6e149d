"""Scoring: clipping, error metrics, best model, comparison labels.

Predictions are long: (item_id, model, phase, t, ds, yhat) with phase
'test' (hold-out) or 'future'. All aggregates group by (item_id, model)
on frames already partitioned by item_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import errors
from ..functions.constants import BASELINE, MODEL_OPTIONS, MODEL_ORDER, N_TEST

#: Errors of two models that agree in so many decimal places are equal.
TIE_DIGITS = 9


def model_subset(models: str | list[str]) -> list[str]:
    """Model labels selected by an option string 'sarimax,prophet,...'."""
    names = models.split(",") if isinstance(models, str) else list(models)
    return [MODEL_OPTIONS[n.strip()] for n in names if n.strip() in MODEL_OPTIONS]


def model_rank():
    """Tie-break rank of a model label (SARIMAX first)."""
    return F.coalesce(F.array_position(F.array(*[F.lit(m) for m in MODEL_ORDER]), F.col("model")),
                      F.lit(len(MODEL_ORDER) + 1))


def clip_predictions(preds: DataFrame, caps: DataFrame) -> DataFrame:
    """clip to [0, cap]; models also replace NaN by epsilon.

    The baseline is only clipped (no NaN replacement), as in the reproduced
    rules; ``caps`` holds (item_id, cap).
    """
    j = preds.join(caps.select("item_id", "cap"), "item_id")
    clipped = F.when(F.col("model") == BASELINE, F.greatest(F.lit(0.0), F.least(F.col("yhat"), F.col("cap")))) \
               .otherwise(errors.clip_sanitize(F.col("yhat"), F.col("cap")))
    return j.withColumn("yhat", clipped).drop("cap")


def error_metrics(actuals: DataFrame, preds: DataFrame) -> DataFrame:
    """MAE, MAPE, MAAPE per (item_id, model) over the hold-out, added up by month.

    ``actuals`` (item_id, t, y) of hold-out months; ``preds`` test-phase rows.
    """
    j = preds.filter(F.col("phase") == "test").join(actuals.select("item_id", "t", "y"), ["item_id", "t"])
    a = errors.ape(F.col("y"), F.col("yhat"))
    return (j.groupBy("item_id", "model")
            .agg(errors.mean_in_order(F.abs(F.col("y") - F.col("yhat")), F.col("t")).alias("mae"),
                 (errors.mean_in_order(a, F.col("t")) * F.lit(100.0)).alias("mape"),
                 errors.mean_in_order(F.atan(a), F.col("t")).alias("maape")))


def best_model(metrics: DataFrame) -> DataFrame:
    """MAPE-best and MAAPE-best model per item; errors equal to TIE_DIGITS places tie, by model order.

    Baseline rows and null errors are ignored. Output: item_id, mape_model,
    mape_min, mae_v (MAE of the MAPE-best model), maape_model, maape_min.
    """
    m = metrics.filter((F.col("model") != BASELINE)).withColumn("_rank", model_rank())
    by_mape = (m.filter(F.col("mape").isNotNull() & ~F.isnan("mape")).groupBy("item_id")
               .agg(F.min_by(F.struct("model", "mape", "mae"), F.struct(F.round("mape", TIE_DIGITS), "_rank")).alias("b")))
    by_maape = (m.filter(F.col("maape").isNotNull() & ~F.isnan("maape")).groupBy("item_id")
                .agg(F.min_by(F.struct("model", "maape"), F.struct(F.round("maape", TIE_DIGITS), "_rank")).alias("c")))
    return by_mape.join(by_maape, "item_id", "full").select(
        "item_id",
        F.col("b.model").alias("mape_model"), F.col("b.mape").alias("mape_min"), F.col("b.mae").alias("mae_v"),
        F.col("c.model").alias("maape_model"), F.col("c.maape").alias("maape_min"))


def rescale_accuracy(df: DataFrame, col: str, out: str) -> DataFrame:
    """F13 as a DataFrame step."""
    return df.withColumn(out, errors.rescale_accuracy(F.col(col)))


def first_forecast_of(preds: DataFrame, best: DataFrame) -> DataFrame:
    """The first future value of each item's MAPE-best model."""
    fut = preds.filter(F.col("phase") == "future")
    j = fut.join(best.select("item_id", F.col("mape_model").alias("model")), ["item_id", "model"])
    return j.groupBy("item_id").agg(F.min_by("yhat", "t").alias("forecast_amt"))


def last_actual(split: DataFrame) -> DataFrame:
    """The last hold-out actual of each item."""
    return split.groupBy("item_id").agg(F.max_by("y", "t").alias("tmonth_amt"))


def model_ok(metrics: DataFrame, preds: DataFrame, horizon: int, n_test: int = N_TEST) -> DataFrame:
    """M6: a model counts when it predicts every hold-out month and has a full future."""
    def rows_of(phase: str):
        return F.count(F.when((F.col("phase") == phase) & F.col("yhat").isNotNull(), 1))
    have = preds.groupBy("item_id", "model").agg(rows_of("test").alias("_nt"), rows_of("future").alias("_nf"))
    j = metrics.join(have, ["item_id", "model"], "left")
    ok = F.col("mape").isNotNull() & (F.col("_nt") >= F.lit(n_test)) & (F.col("_nf") >= F.lit(horizon))
    return j.select("item_id", "model", F.when(ok, F.lit(1)).otherwise(F.lit(0)).alias("model_ok"))


def labels(df: DataFrame) -> DataFrame:
    """Rescaled accuracies, baseline comparison and trend labels.

    Needs mape_min, baseline_mape, tmonth_amt, forecast_amt.
    """
    rm = errors.rescale_accuracy(F.col("mape_min"))
    rb = errors.rescale_accuracy(F.col("baseline_mape"))
    return (df.withColumn("rmape", rm).withColumn("rbaseline", rb)
            .withColumn("pred_bt_base", errors.vs_baseline_label(F.col("rmape"), F.col("rbaseline")))
            .withColumn("pred_bt_base_p", errors.vs_baseline_gap(F.col("rmape"), F.col("rbaseline")))
            .withColumn("pred_trend", errors.trend_label(F.col("tmonth_amt"), F.col("forecast_amt")))
            .withColumn("pred_trend_p", errors.trend_pct(F.col("tmonth_amt"), F.col("forecast_amt"))))
