"""One bad series fails alone; a hot customer does not land in one task; scan ranges; the record's grouped pass."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from demand.operators import facts, record, series as S
from demand.operators.models import boosted, holt_winters, isolate, pooled
from demand.plans import forecast_job
from demand.sources import warehouse
from demand.sources.warehouse import Warehouse


def _cells(spark, n=48):
    rng = np.random.default_rng(3)
    rows = [(f"D{d}", "C", "AC", float(v), f"{2000 + i // 12}-{i % 12 + 1:02d}") for d in range(4)
            for i, v in enumerate(100 * (1 + d) * (1 + 0.3 * np.sin(np.arange(n) / 12 * 2 * np.pi)) * rng.uniform(0.9, 1.1, n))]
    return spark.createDataFrame(rows, "debtorcode string, category string, projno string, y double, month_year string")


def _items(spark):
    return spark.createDataFrame([(i, f"D{i}", "All", "AC", "2003-12") for i in range(4)],
                                 "row_idx long, debtorcode string, category string, projno string, month_year string")


def test_a_poisoned_series_gets_a_status_and_the_others_are_stored(spark, monkeypatch, tmp_path):
    """The kernel raises on one series of the batch (a stand-in for a solver that does)."""
    items, cells = _items(spark), _cells(spark)
    split = forecast_job.build_series(cells, forecast_job.items_from_worklist(items))[1]
    poisoned = float(split.filter("item_id = 2").orderBy("t").first()["y"])

    def poison(fn):
        def run(Y, *more):
            if (Y[:, 0] == poisoned).any():
                raise ZeroDivisionError("poisoned")
            return fn(Y, *more)
        return run

    whole = {(r.item_id, r.phase, r.t): r.yhat for r in holt_winters.holt_winters_grid(split).collect()}
    plain = holt_winters._kernel(6, 3)
    rows = holt_winters.series_arrays(split).withColumn("ok_train", F.lit(True)).withColumn("ok_all", F.lit(True)).toPandas()
    monkeypatch.setattr(holt_winters, "_forecast_batch", poison(holt_winters._forecast_batch))
    import pandas as pd
    got = pd.concat(plain([rows]))
    bad = got[got.phase == isolate.FAILED]
    assert bad.item_id.tolist() == [2] and bad.error.tolist() == ["ZeroDivisionError: poisoned"]
    kept = {(r.item_id, r.phase, r.t): r.yhat for r in got[got.phase != isolate.FAILED].itertuples()}
    assert kept == {k: v for k, v in whole.items() if k[0] != 2}

    def failing(split, n_test, horizon, **_):
        p = holt_winters.holt_winters_grid(split, n_test, horizon)
        broken = split.filter("item_id = 2").select("item_id").distinct().select(
            "item_id", F.lit("HWExSmooth").alias("model"), F.lit(isolate.FAILED).alias("phase"), F.lit(None).cast("long").alias("t"),
            F.lit(None).cast("date").alias("ds"), F.lit(None).cast("double").alias("yhat"), F.lit("ZeroDivisionError: poisoned").alias("error"))
        return p.filter("item_id <> 2").unionByName(broken)
    monkeypatch.undo()
    rec = forecast_job.forecast_record(cells, items, models="hwexsmooth", registry={"HWExSmooth": failing}).collect()
    assert {r.debtorcode: r.status for r in rec} == {"D0": "ok", "D1": "ok", "D2": "model_error", "D3": "ok"}
    assert all("failed" not in (r.forecast_df or "") for r in rec)
    from demand.sources import forecast_store
    store = str(tmp_path / "store")
    forecast_job.run(cells, items, store, models="hwexsmooth", registry={"HWExSmooth": failing})
    assert forecast_store.stored_keys(spark, store).count() == 3  # the failed one is tried again


def test_boosted_kernel_isolates(spark):
    import pandas as pd
    good = {"n": 20, "n_train": 14, "t_last": 100, "y_all": np.arange(1.0, 21.0)}
    rows = pd.DataFrame([{"item_id": 1, **good}, {"item_id": 2, **good, "y_all": np.array(["x"] * 20, object)}, {"item_id": 3, **good}])
    got = pd.concat(boosted._kernel(6, 3, 5, 2, 6)([rows]))
    assert got[got.phase == isolate.FAILED].item_id.tolist() == [2] and got[got.phase == "future"].item_id.tolist() == [1] * 3 + [3] * 3


def test_the_record_takes_one_grouped_pass(spark):
    split = forecast_job.build_series(_cells(spark), forecast_job.items_from_worklist(_items(spark)))[1]
    preds, mm, bm, _ = forecast_job.score(split, "hwexsmooth")
    plan = record.item_summary(split, preds, mm, bm)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_hot_customer_is_dealt_to_many_tasks(spark):
    n = 6000
    who = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("C"), F.pmod(F.xxhash64("id"), F.lit(900)).cast("string")))
    day = F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 360).cast("int"))
    headers = spark.range(n).select(F.col("id").alias("dockey"), day.alias("docdate"), who.alias("debtorcode"))
    lines = spark.range(n).select(F.col("id").alias("dockey"), F.lit(1).cast("long").alias("itemcode"), (F.col("id") + 1.0).alias("amount"),
                                  F.lit(None).cast("string").alias("projno"))
    wh = Warehouse(headers, lines, spark.createDataFrame([(1, "SOAP")], "itemcode long, itemtype string"),
                   spark.createDataFrame([], "debtorcode string, docdate date, amount double, category string, invtype string"))
    assert facts.hot_customers(wh) == ["HOT"]
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        f = facts.sales_fact(wh, "2021-01-15")
        per_task = f.groupBy(F.spark_partition_id().alias("p")).count().collect()
        got = f.groupBy("debtorcode").count().collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    plain = facts.union_channels(wh).join(facts.active_customers(wh, "2021-01-15"), "debtorcode", "left_semi").groupBy("debtorcode").count().collect()
    assert sorted(got) == sorted(plain) and {r["debtorcode"]: r["count"] for r in got}["HOT"] == n // 3
    assert max(r["count"] for r in per_task) < sum(r["count"] for r in per_task) * 0.3  # eight tasks; unsalted, one has over a third


def test_scan_ranges_are_disjoint_complete_and_even(spark):
    rows = [(i, dt.date(2020, 1, 1) + dt.timedelta(days=i * i % 700)) for i in range(1000)] + [(5000 + i, None) for i in range(3)]
    df = spark.createDataFrame(rows, "k long, d date")
    for column in ("d", "k"):
        cuts = warehouse.quantile_cuts(df, column, 8)
        preds = warehouse.range_predicates(column, cuts)
        met = df.select("k", sum(F.expr(p).cast("int") if "NULL" in p else F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in preds).alias("n"))
        assert met.filter("n <> 1").count() == 0 and len(preds) == 8
        sizes = [df.filter(p).count() for p in preds]
        assert sum(sizes) == len(rows) and max(sizes) < 2 * len(rows) / 8
    assert warehouse.range_predicates("d", []) == ["1 = 1"]
    assert warehouse.quantile_cuts(df.limit(0), "d", 4) == [] and warehouse.quantile_cuts(df, "k", 1) == []
    hot = spark.createDataFrame([(7,)] * 50 + [(9,)], "k long")  # one value: fewer ranges, still every row once
    preds = warehouse.range_predicates("k", warehouse.quantile_cuts(hot, "k", 4))
    assert sum(hot.filter(p).count() for p in preds) == 51


def test_pooled_boosting_beats_the_naive_error_in_any_partitioning(spark):
    split = S.tail_split(forecast_job.build_series(_cells(spark, 60).withColumn("month_year", F.col("month_year")), forecast_job.items_from_worklist(
        _items(spark).withColumn("month_year", F.lit("2004-12"))))[1].select("item_id", "t", "ds", "y", "filled"))
    got = [{(r.item_id, r.phase, r.t): r.yhat for r in pooled.pooled_lags(split.repartition(k), rounds=9, depth=3).collect()} for k in (1, 13)]
    assert got[0] == got[1] and len(got[0]) == 4 * 9
    actual = {(r.item_id, r.t): (r.y, r.is_test) for r in split.collect()}
    held = [(i, t) for (i, t), (_, test) in actual.items() if test]
    ours = sum(abs(got[0][i, "test", t] - actual[i, t][0]) / actual[i, t][0] for i, t in held)
    last = {i: max(t for (j, t), (_, test) in actual.items() if j == i and not test) for i in range(4)}
    naive = sum(abs(actual[i, last[i]][0] - actual[i, t][0]) / actual[i, t][0] for i, t in held)
    assert ours < naive
    none = split.withColumn("y", F.lit(0.0))
    assert pooled.pooled_lags(none, rounds=1, depth=1).count() == 0 and pooled.pooled_lags(split.limit(0), rounds=1, depth=1).count() == 0
