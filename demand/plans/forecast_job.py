"""The forecast job over the whole work list in one plan.

work list -(anti join stored keys)-> items -(hierarchy expand)-> monthly sums
-> gap fill -> hold-out split  [checkpointed: every model reads it]
-> baseline + selected models -> clip -> metrics -> best model -> labels
-> JSON documents -> one record per item.

Shuffles: the per-level monthly sums (map-side combined), the item join,
one shuffle by item_id for the series windows; model folds, metrics and
packing group by item_id on small per-item data, the record in one pass. The monthly sums, the
split series and the predictions are checkpointed: each is read by several
later steps and none of them is recomputed from the facts.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import BASELINE, DEFAULT_MODELS, HORIZON, MODEL_ORDER, N_TEST
from ..operators import metrics as M
from ..operators import record as R
from ..operators import series as S
from ..operators.models import naive
from ..session import cut_lineage


def _model_registry():
    from ..operators.models import boosted, holt_winters, pooled, seasonal_ar, trend_holiday

    def boost(split, n_test, horizon, boosting="series", boost_rounds=None, **kw):
        if boosting == "pooled":
            return pooled.pooled_lags(split, n_test, horizon, rounds=boost_rounds or pooled.ROUNDS)
        return boosted.boosted_lags(split, n_test, horizon, max_iter=boost_rounds or boosted.MAX_ITER)

    return {
        "SARIMAX": lambda split, n_test, horizon, **kw: seasonal_ar.seasonal_ar(split, n_test, horizon),
        "Prophet": lambda split, n_test, horizon, **kw: trend_holiday.trend_holiday(
            split, n_test, horizon, holidays=kw.get("holidays")),
        "XGBoost": boost,
        "HWExSmooth": lambda split, n_test, horizon, **kw: holt_winters.holt_winters_grid(split, n_test, horizon),
    }


def items_from_worklist(worklist: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """J4 + P15: blank cells read as '', stored keys skipped, item_id assigned."""
    wl = worklist.na.fill("", ["debtorcode", "category", "projno", "month_year"])
    if done is not None:
        wl = S.skip_done(wl, done)
    if "item_id" not in wl.columns:
        wl = wl.withColumn("item_id", F.col("row_idx").cast("long"))
    return wl


def build_series(cells: DataFrame, items: DataFrame, n_test: int = N_TEST, channel_scoped: bool = False,
                 checkpoint: bool = True):
    """Raw monthly sums and the gap-filled, split series of every item."""
    raw = S.hierarchy_expand(cells, items, channel_scoped)
    if checkpoint:
        # a checkpoint does not keep hash partitioning, so no repartition before it:
        # the gap-fill window shuffles by item_id once either way
        raw = cut_lineage(raw)
    split = S.tail_split(S.gap_fill(raw), n_test)
    if checkpoint:
        split = cut_lineage(split)
    return raw, split


def score(split: DataFrame, models: str | list[str] = DEFAULT_MODELS, n_test: int = N_TEST,
          horizon: int = HORIZON, checkpoint: bool = True, registry: dict | None = None,
          **model_kw) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Baseline + models -> (clipped preds, model metrics, baseline metrics, caps).

    ``registry`` (label -> function of split, n_test, horizon) replaces the models behind the labels;
    ``boosting="pooled"`` takes one booster per origin over all series instead of one per series and origin.
    A series on which a model raised has a row of phase ``failed`` with the error in ``preds``."""
    labels = M.model_subset(models)
    registry = registry or _model_registry()
    usable = split.filter(F.col("n") > F.lit(n_test))  # too short: no training month
    fut = S.future_months(usable, horizon)
    base = naive.baseline_naive(usable, fut)
    chosen = [m for m in MODEL_ORDER if m in labels]
    if checkpoint and chosen:
        # the models are independent jobs: run them concurrently, each one
        # materialised once; metrics, selection and packing reuse the result
        def run_model(m):
            return cut_lineage(registry[m](usable, n_test, horizon, **model_kw))
        with ThreadPoolExecutor(max_workers=len(chosen)) as pool:
            model_preds = list(pool.map(run_model, chosen))
    else:
        model_preds = [registry[m](usable, n_test, horizon, **model_kw) for m in chosen]
    # the union stays lazy: models are materialised, the baseline is a cheap
    # aggregate over the checkpointed split
    raw_preds = base
    for p in model_preds:
        raw_preds = raw_preds.unionByName(p, allowMissingColumns=True)  # kernels tell which series raised
    caps = S.holdout_cap(usable)
    actuals = usable.filter("is_test").select("item_id", "t", "y")
    baseline_metrics = M.error_metrics(actuals, base)          # before clipping (quirk Q5)
    preds = M.clip_predictions(raw_preds, caps)
    if checkpoint:
        # read by metrics, model_ok, selection, the first forecast and the JSON documents
        preds = cut_lineage(preds)
    model_metrics = M.error_metrics(actuals, preds.filter(F.col("model") != BASELINE))
    ok = M.model_ok(model_metrics, preds, horizon, n_test)
    model_metrics = model_metrics.join(ok, ["item_id", "model"]).withColumn(
        "mape", F.when(F.col("model_ok") == 1, F.col("mape"))).withColumn(
        "mae", F.when(F.col("model_ok") == 1, F.col("mae"))).withColumn(
        "maape", F.when(F.col("model_ok") == 1, F.col("maape"))).drop("model_ok")
    if checkpoint:
        model_metrics, baseline_metrics = cut_lineage(model_metrics), cut_lineage(baseline_metrics)
    return preds, model_metrics, baseline_metrics, caps


def forecast_record(cells: DataFrame, worklist: DataFrame, done: DataFrame | None = None,
                    models: str | list[str] = DEFAULT_MODELS, n_test: int = N_TEST, horizon: int = HORIZON,
                    channel_scoped: bool = False, checkpoint: bool = True, with_json: bool = True,
                    **model_kw) -> DataFrame:
    """One summary record per work-list item (schema FORECAST_RECORD).

    Items with the same level key and cutoff (one customer in two channels, unless ``channel_scoped``) have the
    same series: it is built and fitted once, under the smallest item_id, and joined back to all of them."""
    items = items_from_worklist(worklist, done)
    same = Window.partitionBy("lvl", "kd", "kc", "kp", "month_year")
    keyed = S.item_keys(items, channel_scoped).withColumnRenamed("item_id", "own_id")
    keyed = keyed.withColumn("item_id", F.when(F.col("lvl").isNotNull(), F.min("own_id").over(same)).otherwise(F.col("own_id")))
    if checkpoint:
        keyed = cut_lineage(keyed)
    once = keyed.filter(F.col("own_id") == F.col("item_id")).select("item_id", "debtorcode", "category", "projno", "month_year")
    raw, split = build_series(cells, once, n_test, channel_scoped, checkpoint)
    preds, mm, bm, caps = score(split, models, n_test, horizon, checkpoint, **model_kw)
    per_item = R.item_summary(split, preds, mm, bm)
    rec = keyed.select("own_id", "item_id", "debtorcode", "category", "projno", "lvl").join(per_item, "item_id", "left")
    rec = M.labels(rec)
    status = (F.when(F.col("lvl").isNull(), F.lit("bad_item"))
              .when(F.col("n").isNull(), F.lit("no_data"))
              .when(F.col("n") <= F.lit(n_test), F.lit("too_short"))
              .when(F.col("mape_model").isNull() & (F.size("errors") > 0), F.lit("model_error"))
              .when(F.col("mape_model").isNull(), F.lit("no_model"))
              .otherwise(F.lit("ok")))
    rec = rec.withColumn("status", status)
    if with_json:
        docs = R.json_pack(raw, split, preds, mm, bm, M.model_subset(models))
        rec = rec.join(docs, "item_id", "left")
    else:
        for c in ("metrics_df", "train_df", "validation_df", "forecast_df", "baseline_df"):
            rec = rec.withColumn(c, F.lit(None).cast("string"))
    from ..schemas import FORECAST_RECORD
    rec = rec.withColumn("last_update", F.current_timestamp())
    return rec.select(F.col("own_id").alias("item_id"), *[F.col(f.name).cast(f.dataType).alias(f.name) for f in FORECAST_RECORD.fields])


def run(cells: DataFrame, worklist: DataFrame, store_path: str, models: str | list[str] = DEFAULT_MODELS,
        n_test: int = N_TEST, horizon: int = HORIZON, channel_scoped: bool = False, **model_kw) -> int:
    """Forecast every work-list item not yet stored, upsert the records.

    Items whose (customer, category, month, channel) is already in the store
    are skipped (J4), so a re-run after a failure only does the remainder;
    the upsert commits the next store version. Items stored without a forecast
    (too short, no model) are tried again. Returns that version (the
    current one when every item is already stored).
    """
    from ..sources import forecast_store
    spark = cells.sparkSession
    done = forecast_store.stored_keys(spark, store_path)
    if items_from_worklist(worklist, done).isEmpty():  # everything is stored already
        return forecast_store.latest_version(spark, store_path)
    rec = forecast_record(cells, worklist, done, models, n_test, horizon, channel_scoped, **model_kw)
    return forecast_store.upsert_forecast(spark, rec.drop("item_id"), store_path)
