"""Record assembly, JSON documents, store append/upsert, plan shapes."""

import json

import numpy as np
from pyspark.sql import functions as F

from conftest import cells_df, months
from demand.plans import forecast_job
from demand.session import scratch_path
from demand.sources import forecast_store, worklist_io


def _cells(spark):
    ms = months(2015, 1, 40)
    rng = np.random.default_rng(0)
    rows = []
    for i, m in enumerate(ms):
        rows.append(("D1", "C1", "AC", float(100 + 10 * np.sin(i / 2) + rng.random()), m))
        rows.append(("D2", "C1", "UL", float(50 + 5 * np.cos(i / 3) + rng.random()), m))
    rows += [("D3", "C2", "AC", 5.0, m) for m in ms[-4:]]  # too short
    return cells_df(spark, rows), ms[-1]


def _worklist(spark, cutoff):
    rows = [(0, "All", "All", "All", cutoff), (1, "D1", "All", "AC", cutoff), (2, "D3", "All", "AC", cutoff),
            (3, "", "C9", "AC", cutoff), (4, "D9", "All", "AC", cutoff)]
    return spark.createDataFrame(rows, "row_idx long, debtorcode string, category string, projno string, month_year string")


def test_record_statuses_and_json(spark):
    cells, cutoff = _cells(spark)
    rec = forecast_job.forecast_record(cells, _worklist(spark, cutoff), models="hwexsmooth").collect()
    st = {r.item_id: r for r in rec}
    assert st[0].status == "ok" and st[1].status == "ok"
    assert st[2].status == "too_short" and st[3].status == "bad_item" and st[4].status == "no_data"
    r = st[0]
    assert r.mape_model == "HWExSmooth" and r.last_trainmy == cutoff
    m = json.loads(r.metrics_df)
    assert m["Models"] == {"0": "SARIMAX", "1": "Prophet", "2": "XGBoost", "3": "HWExSmooth"}
    assert m["MAPE_Errors"]["3"] == r.mape_min and m["MAPE_Errors"]["0"] is None
    v = json.loads(r.validation_df)
    assert list(v) == ["y", "Baseline", "HWExSmooth"] and len(v["y"]) == 6
    f = json.loads(r.forecast_df)
    assert list(f) == ["Baseline", "HWExSmooth"] and len(f["HWExSmooth"]) == 3
    assert list(f["HWExSmooth"].values())[0] == r.forecast_amt
    t = json.loads(r.train_df)
    assert len(t["y"]) == 40 and sorted(t["y"]) == list(t["y"])
    b = json.loads(r.baseline_df)
    assert b["Models"] == {"0": "Baseline"}


def test_no_model_when_all_fail(spark):
    # a series with a zero value: Holt-Winters (multiplicative) cannot run
    ms = months(2015, 1, 30)
    cells = cells_df(spark, [("D1", "C1", "AC", 0.0 if i == 3 else 10.0 + i, m) for i, m in enumerate(ms)])
    wl = spark.createDataFrame([(0, "D1", "All", "AC", ms[-1])],
                               "row_idx long, debtorcode string, category string, projno string, month_year string")
    r = forecast_job.forecast_record(cells, wl, models="hwexsmooth").first()
    assert r.status == "no_model" and r.mape_model is None and r.rbaseline is not None
    # nothing is invented for a model that does not exist
    assert (r.rmape, r.pred_bt_base, r.pred_bt_base_p, r.pred_trend, r.pred_trend_p, r.forecast_amt) == (None,) * 6


def test_labels_are_null_without_a_forecast(spark):
    cells, cutoff = _cells(spark)
    rec = forecast_job.forecast_record(cells, _worklist(spark, cutoff), models="hwexsmooth", with_json=False).collect()
    for r in rec:
        made = (r.rmape, r.rbaseline, r.pred_bt_base, r.pred_trend)
        assert all(x is not None for x in made) if r.status == "ok" else all(x is None for x in made), r


def test_items_without_a_model_are_tried_again(spark):
    ms = months(2015, 1, 30)
    cells = cells_df(spark, [("D1", "C1", "AC", 0.0 if i == 3 else 10.0 + i, m) for i, m in enumerate(ms)])
    wl = spark.createDataFrame([(0, "D1", "All", "AC", ms[-1])],
                               "row_idx long, debtorcode string, category string, projno string, month_year string")
    path = scratch_path(spark, "store-retry")
    assert forecast_job.run(cells, wl, path, models="hwexsmooth") == 0
    assert [r.status for r in forecast_store.read_forecasts(spark, path).collect()] == ["no_model"]
    assert forecast_job.run(cells, wl, path, models="xgboost", boost_rounds=5) == 1
    assert [r.status for r in forecast_store.read_forecasts(spark, path).collect()] == ["ok"]
    assert forecast_job.run(cells, wl, path, models="hwexsmooth") == 1  # has a forecast now


def test_same_series_is_fitted_once(spark):
    """A customer's items in two channels share the series, and each gets its record."""
    cells, cutoff = _cells(spark)
    wl = spark.createDataFrame([(5, "D1", "All", "AC", cutoff), (6, "D1", "All", "UL", cutoff), (7, "D2", "All", "UL", cutoff)],
                               "row_idx long, debtorcode string, category string, projno string, month_year string")
    got = {r.item_id: r for r in forecast_job.forecast_record(cells, wl, models="hwexsmooth").collect()}
    assert got[5].projno == "AC" and got[6].projno == "UL"
    assert got[5].forecast_amt == got[6].forecast_amt != got[7].forecast_amt
    assert got[5].forecast_df == got[6].forecast_df is not None


def _records(spark, cutoff, cells, code, value):
    rec = forecast_job.forecast_record(cells, _worklist(spark, cutoff).filter("row_idx = 1"), models="hwexsmooth", with_json=False)
    return rec.drop("item_id").withColumn("debtorcode", F.lit(code)).withColumn("mape_min", F.lit(value)).cache()


def test_two_writers_keep_all_keys(spark):
    from concurrent.futures import ThreadPoolExecutor
    cells, cutoff = _cells(spark)
    path = scratch_path(spark, "store-writers")
    forecast_store.upsert_forecast(spark, _records(spark, cutoff, cells, "A", 1.0), path)
    new = [_records(spark, cutoff, cells, c, 2.0) for c in "BCDE"]
    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(lambda r: forecast_store.upsert_forecast(spark, r, path), new))
    assert sorted(versions) == [1, 2, 3, 4]
    assert sorted(r.debtorcode for r in forecast_store.read_forecasts(spark, path).collect()) == list("ABCDE")


def test_a_write_without_commit_is_not_read(spark):
    cells, cutoff = _cells(spark)
    path = scratch_path(spark, "store-partial")
    rec = _records(spark, cutoff, cells, "A", 1.0)
    forecast_store.upsert_forecast(spark, rec, path)
    rec.withColumn("mape_min", F.lit(9.0)).write.partitionBy("last_trainmy").parquet(f"{path}/data/run=died")
    fs, path_of = forecast_store._fs(spark, path)
    fs.create(path_of(f"{path}/log/v1/entry.json"), False).close()  # a commit that never became whole
    assert [r.mape_min for r in forecast_store.read_forecasts(spark, path).collect()] == [1.0]
    forecast_store.upsert_forecast(spark, rec.withColumn("mape_min", F.lit(3.0)), path)
    assert [r.mape_min for r in forecast_store.read_forecasts(spark, path).collect()] == [3.0]


def test_upsert_idempotent_and_run_skips_done(spark):
    cells, cutoff = _cells(spark)
    wl = _worklist(spark, cutoff)
    path = scratch_path(spark, "store-test")
    v0 = forecast_job.run(cells, wl, path, models="hwexsmooth")
    first = forecast_store.read_forecasts(spark, path)
    n0 = first.count()
    assert v0 == 0 and n0 == 5
    # second run: every key is stored, nothing new is forecast
    v1 = forecast_job.run(cells, wl, path, models="hwexsmooth")
    again = forecast_store.read_forecasts(spark, path)
    # items without a series store a null month, so the skip rule (stored month
    # = item month, quirk Q12) never matches them: they are redone, not duplicated
    assert v1 == 1 and again.count() == n0
    # with only forecastable items stored, a re-run writes nothing at all
    ok_items = wl.filter("row_idx < 2")
    path2 = scratch_path(spark, "store-test-ok")
    assert forecast_job.run(cells, ok_items, path2, models="hwexsmooth") == 0
    assert forecast_job.run(cells, ok_items, path2, models="hwexsmooth") == 0
    # upsert of the same records with a newer timestamp keeps one row per key
    newer = first.withColumn("last_update", F.col("last_update") + F.expr("INTERVAL 1 MINUTE")).withColumn(
        "mape_min", F.lit(1.0))
    forecast_store.upsert_forecast(spark, newer, path)
    latest = forecast_store.read_forecasts(spark, path)
    assert latest.count() == n0
    assert {r.mape_min for r in latest.collect()} == {1.0}


def test_worklist_csv_roundtrip(spark):
    wl = spark.createDataFrame([(0, "All", "All", "All", "2020-12", 1), (1, "A", None, "AC", "2020-12", 2)],
                               "row_idx long, debtorcode string, category string, projno string, month_year string, part int")
    path = scratch_path(spark, "csv-test")
    worklist_io.write_worklist_csv(wl, path)
    back = {r.row_idx: r for r in worklist_io.read_worklist_csv(spark, path).collect()}
    assert back[1].category == "" and back[1].part == 2 and back[0].debtorcode == "All"
    half = worklist_io.read_worklist_csv(spark, path + "/part=1").collect()
    assert [r.row_idx for r in half] == [0]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_shapes(spark):
    from demand.operators import facts, series as S
    from demand.sources.testdata import TESTDATA_AS_OF, warehouse_from_testdata
    wh = warehouse_from_testdata(spark, "/root/testdata/sf0.001")
    plan = _plan(facts.sales_fact(wh, TESTDATA_AS_OF))
    assert "LeftSemi" in plan and "CartesianProduct" not in plan
    cells, cutoff = _cells(spark)
    wl = _worklist(spark, cutoff).withColumn("item_id", F.col("row_idx"))
    done = spark.createDataFrame([("D1", "All", "AC", cutoff)],
                                 "debtorcode string, category string, projno string, last_trainmy string")
    plan = _plan(S.hierarchy_expand(cells, S.skip_done(wl, done)))
    assert "LeftAnti" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_worklist_stream_forecasts_each_file(spark):
    from demand.streaming.worklist_stream import start_forecast_stream
    cells, cutoff = _cells(spark)
    wl = _worklist(spark, cutoff).withColumn("part", F.when(F.col("row_idx") < 2, 1).otherwise(2))
    wl_dir = scratch_path(spark, "stream-wl-test")
    worklist_io.write_worklist_csv(wl, wl_dir)
    store = scratch_path(spark, "stream-store-test")
    ckpt = scratch_path(spark, "stream-ckpt-test")
    q = start_forecast_stream(spark, wl_dir, lambda: cells, store, checkpoint_location=ckpt, models="hwexsmooth")
    q.awaitTermination()
    got = forecast_store.read_forecasts(spark, store)
    assert got.count() == 5
    assert {r.status for r in got.collect()} == {"ok", "too_short", "bad_item", "no_data"}
    versions = forecast_store.latest_version(spark, store)
    assert versions == 0  # both files were pending: one micro-batch, one commit
    # restart on the same checkpoint: the files are known, no batch runs
    q2 = start_forecast_stream(spark, wl_dir, lambda: cells, store, checkpoint_location=ckpt, models="hwexsmooth")
    q2.awaitTermination()
    assert forecast_store.latest_version(spark, store) == versions
    # a fresh checkpoint replays the files: stored keys are skipped, content unchanged
    q3 = start_forecast_stream(spark, wl_dir, lambda: cells, store, models="hwexsmooth")
    q3.awaitTermination()
    again = forecast_store.read_forecasts(spark, store)
    assert again.count() == 5
    assert sorted(r.mape_min or -1 for r in again.collect()) == sorted(r.mape_min or -1 for r in got.collect())


def test_upsert_rewrites_only_touched_months(spark):
    import glob
    cells, cutoff = _cells(spark)
    rec = forecast_job.forecast_record(cells, _worklist(spark, cutoff), models="hwexsmooth").drop("item_id").cache()
    path = scratch_path(spark, "store-months")
    jan = rec.withColumn("last_trainmy", F.lit("2021-01"))
    feb = rec.withColumn("last_trainmy", F.lit("2021-02"))
    forecast_store.upsert_forecast(spark, jan, path)
    forecast_store.upsert_forecast(spark, feb, path)
    forecast_store.upsert_forecast(spark, feb.withColumn("mape_min", F.lit(2.0))
                                   .withColumn("last_update", F.col("last_update") + F.expr("INTERVAL 1 MINUTE")), path)
    local = path.replace("file:", "")
    months = sorted(p.split("last_trainmy=")[1].split("/")[0] for p in glob.glob(local + "/data/run=*/last_trainmy=*"))
    assert months == ["2021-01", "2021-02", "2021-02"]  # January written once
    got = forecast_store.read_forecasts(spark, path)
    assert got.count() == 10
    assert {r.mape_min for r in got.filter("last_trainmy = '2021-02'").collect()} == {2.0}
    assert 2.0 not in {r.mape_min for r in got.filter("last_trainmy = '2021-01'").collect()}


def test_hot_keys_are_combined_map_side(spark):
    """Cells and per-level sums aggregate partially before any shuffle."""
    from demand.operators import facts, series as S
    from demand.sources.testdata import TESTDATA_AS_OF, warehouse_from_testdata
    wh = warehouse_from_testdata(spark, "/root/testdata/sf0.001")
    plan = _plan(facts.sum_by_cell(facts.sales_fact(wh, TESTDATA_AS_OF)))
    assert "partial_sum" in plan
    cells, cutoff = _cells(spark)
    wl = _worklist(spark, cutoff).withColumn("item_id", F.col("row_idx"))
    plan = _plan(S.level_month_sums(cells))
    assert "partial_sum" in plan and "Generate" in plan
    plan = _plan(S.hierarchy_expand(cells, wl))
    # the per-level sums are aggregated before they meet the work list
    assert plan.index("partial_sum") > plan.index("Join")


def test_prepare_then_forecast_end_to_end(spark):
    """Warehouse -> work-list CSV halves -> read back -> forecast -> store (sf0.001)."""
    from demand.operators import facts
    from demand.plans import prepare_job
    from demand.sources.testdata import TESTDATA_AS_OF, warehouse_from_testdata
    wh = warehouse_from_testdata(spark, "/root/testdata/sf0.001")
    out = scratch_path(spark, "prepare-e2e")
    wl = prepare_job.run(wh, out, as_of=TESTDATA_AS_OF)
    assert wl.count() == 35 and {r.part for r in wl.collect()} == {1, 2}
    back = worklist_io.read_worklist_csv(spark, out)
    assert back.count() == 35 and back.filter("part = 1").count() == 17
    store = scratch_path(spark, "prepare-e2e-store")
    cells = facts.cells(wh, TESTDATA_AS_OF)
    forecast_job.run(cells, back.filter("part = 1").drop("part"), store, models="hwexsmooth")
    forecast_job.run(cells, back.drop("part"), store, models="hwexsmooth")  # second half only is new
    got = forecast_store.read_forecasts(spark, store)
    assert got.count() == 35
    assert got.filter("status = 'ok'").count() == 35
    # a forced month later than the last closed month is refused
    import pytest
    with pytest.raises(ValueError):
        prepare_job.build_worklist(wh, TESTDATA_AS_OF, month="2001-08")
