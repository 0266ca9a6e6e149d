"""S9 + C4: JSON packing and the keyed summary record of each item.

JSON documents are column-oriented, ``{column: {epoch_ms: value}}`` for the
time-indexed frames and ``{column: {row: value}}`` for the metric frames.
Each document is built from one item's rows (a group bounded by the
series' months and the model count), never from the whole data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import BASELINE, MODEL_ORDER
from ..functions.errors import mean_in_order
from .metrics import TIE_DIGITS, model_rank
from .models.isolate import FAILED
from .series import month_start_of_index


def epoch_ms_key(ds: Column) -> Column:
    """Month-start date -> epoch milliseconds as a string key."""
    return (F.unix_date(ds).cast("long") * F.lit(86400000)).cast("string")


def json_metrics(metrics: DataFrame, key_col: str, models: list[str]) -> DataFrame:
    """Metric frame as JSON: {"Models": {i: name}, "MAPE_Errors": {i: v}, ...}.

    Every model of ``models`` gets a row (null errors when it did not run).
    """
    idx = {m: i for i, m in enumerate(models)}
    pos = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model")) - 1
    rows = metrics.filter(F.col("model").isin(models)).select(
        "item_id", pos.cast("string").alias("i"), "model", "mape", "mae", "maape")
    per = rows.groupBy("item_id").agg(F.collect_list(F.struct("i", "model", "mape", "mae", "maape")).alias("r"))

    def is_model(name: str):
        return lambda x: x["model"] == F.lit(name)

    def col_map(field: str) -> Column:
        # one entry per listed model, in order, null when missing
        entries = [F.struct(F.lit(str(i)).alias("k"),
                            F.try_element_at(F.filter(F.col("r"), is_model(m)), F.lit(1))[field].alias("v"))
                   for m, i in idx.items()]
        return F.map_from_entries(F.array(*entries))

    names = F.map_from_entries(F.array(*[F.struct(F.lit(str(i)).alias("k"), F.lit(m).alias("v"))
                                         for m, i in idx.items()]))
    doc = F.struct(names.alias("Models"), col_map("mape").alias("MAPE_Errors"),
                   col_map("mae").alias("MAE_Errors"), col_map("maape").alias("MAAPE_Errors"))
    return per.select("item_id", F.to_json(doc).alias(key_col))


def json_docs_by_time(long: DataFrame, col_order: list[str]) -> DataFrame:
    """(item_id, doc, name, ds, value) -> item_id + one JSON column per doc.

    All time-indexed documents go through one chain of aggregates:
    per (item, doc, name) the time map, per (item, doc) the column map,
    per item one map of documents, unpacked into columns.
    """
    rank = F.coalesce(F.array_position(F.array(*[F.lit(c) for c in col_order]), F.col("name")), F.lit(99))
    inner = (long.groupBy("item_id", "doc", "name")
             .agg(F.map_from_entries(F.transform(
                 F.array_sort(F.collect_list(F.struct(F.col("ds"), epoch_ms_key(F.col("ds")).alias("k"),
                                                      F.col("value")))),
                 lambda s: F.struct(s["k"], s["value"]))).alias("m"))
             .withColumn("_r", rank))
    per_doc = (inner.groupBy("item_id", "doc")
               .agg(F.to_json(F.map_from_entries(F.transform(
                   F.array_sort(F.collect_list(F.struct("_r", "name", "m")),
                                lambda a, b: F.signum(a["_r"] - b["_r"]).cast("int")),
                   lambda s: F.struct(s["name"], s["m"])))).alias("json")))
    docs = per_doc.groupBy("item_id").agg(F.map_from_entries(F.collect_list(F.struct("doc", "json"))).alias("d"))
    return docs.select("item_id", *[F.col("d")[name].alias(name) for name in ("train_df", "validation_df", "forecast_df")])


def item_summary(split: DataFrame, preds: DataFrame, model_metrics: DataFrame, baseline_metrics: DataFrame) -> DataFrame:
    """Everything the record says of an item, in one grouped pass over the union of its months, errors and forecasts.

    One row per item_id: n, last_trainmy, test_mean, tmonth_amt (A5, A7, W7), the best models as in
    :func:`..metrics.best_model`, baseline_mape, forecast_amt (first future value of the MAPE-best model) and
    errors (models that failed, sorted)."""
    kind = lambda df, name: df.withColumn("kind", F.lit(name))
    rows = kind(split.select("item_id", "t", "y", "n", "filled", "is_test"), "month")
    for name, part in (("model", model_metrics.select("item_id", "model", "mape", "mae", "maape")),
                       ("baseline", baseline_metrics.select("item_id", "mape")),
                       ("forecast", preds.filter(F.col("phase") == "future").select("item_id", "model", "t", "yhat")),
                       (FAILED, preds.filter(F.col("phase") == FAILED).select(
                           "item_id", F.concat_ws(": ", "model", *(["error"] if "error" in preds.columns else [])).alias("error")))):
        rows = rows.unionByName(kind(part, name), allowMissingColumns=True)
    month, forecast = F.col("kind") == "month", F.col("kind") == "forecast"

    def best(measure: str, *more: str) -> Column:
        runs = (F.col("kind") == "model") & F.col("model").isin(MODEL_ORDER) & F.col(measure).isNotNull() & ~F.isnan(measure)
        return F.min_by(F.struct("model", measure, *more), F.when(runs, F.struct(F.round(measure, TIE_DIGITS), model_rank())))

    out = rows.groupBy("item_id").agg(
        F.max("n").alias("n"), F.max(F.when(month & ~F.col("filled"), F.col("t"))).alias("last_t"),
        mean_in_order(F.when(month & F.col("is_test"), F.col("y")), F.col("t")).alias("test_mean"),
        F.max_by("y", F.when(month, F.col("t"))).alias("tmonth_amt"),
        best("mape", "mae").alias("b"), best("maape").alias("c"),
        F.max(F.when(F.col("kind") == "baseline", F.col("mape"))).alias("baseline_mape"),
        *[F.min_by("yhat", F.when(forecast & (F.col("model") == m), F.col("t"))).alias(f"first_{m}") for m in MODEL_ORDER],
        F.array_sort(F.collect_set("error")).alias("errors"))
    first = F.coalesce(*[F.when(F.col("b.model") == m, F.col(f"first_{m}")) for m in MODEL_ORDER])
    return out.select(
        "item_id", "n", F.date_format(month_start_of_index(F.col("last_t")), "yyyy-MM").alias("last_trainmy"), "test_mean", "tmonth_amt",
        F.col("b.model").alias("mape_model"), F.col("b.mape").alias("mape_min"), F.col("b.mae").alias("mae_v"),
        F.col("c.model").alias("maape_model"), F.col("c.maape").alias("maape_min"), "baseline_mape", first.alias("forecast_amt"), "errors")


def json_pack(raw_series: DataFrame, split: DataFrame, preds: DataFrame, metrics: DataFrame,
              baseline_metrics: DataFrame, models: list[str]) -> DataFrame:
    """The five JSON documents of the record, one row per item."""
    from ..functions.dates import month_to_date
    cols = ["y", BASELINE] + [m for m in MODEL_ORDER if m in models]
    long = (raw_series.select("item_id", F.lit("train_df").alias("doc"), F.lit("y").alias("name"),
                              month_to_date(F.col("month_year")).alias("ds"), F.col("y").alias("value"))
            .unionByName(split.filter("is_test").select("item_id", F.lit("validation_df").alias("doc"),
                                                        F.lit("y").alias("name"), "ds", F.col("y").alias("value")))
            .unionByName(preds.filter(F.col("phase") != FAILED).select("item_id",
                                      F.when(F.col("phase") == "test", F.lit("validation_df"))
                                      .otherwise(F.lit("forecast_df")).alias("doc"),
                                      F.col("model").alias("name"), "ds", F.col("yhat").alias("value"))))
    by_time = json_docs_by_time(long, cols)
    metrics_doc = json_metrics(metrics, "metrics_df", MODEL_ORDER)
    baseline_doc = json_metrics(baseline_metrics, "baseline_df", [BASELINE])
    return by_time.join(metrics_doc, "item_id", "full").join(baseline_doc, "item_id", "full")
