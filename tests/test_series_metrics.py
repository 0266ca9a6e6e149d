"""Series layer, scoring and labels on small literal frames."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import cells_df, months
from demand.functions import errors as E
from demand.operators import metrics as M, series as S


def _items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, debtorcode string, category string, projno string, month_year string")


def test_gap_fill_linear(spark):
    raw = spark.createDataFrame([(1, "2020-01", 1.0), (1, "2020-04", 4.0), (1, "2020-05", 5.0)],
                                "item_id long, month_year string, y double")
    out = S.gap_fill(raw).orderBy("t").collect()
    assert [r.y for r in out] == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert [r.filled for r in out] == [False, True, True, False, False]
    assert [str(r.ds) for r in out] == ["2020-01-01", "2020-02-01", "2020-03-01", "2020-04-01", "2020-05-01"]


def test_hierarchy_levels_and_channel_quirk(spark):
    cells = cells_df(spark, [("D", "C", "AC", 1.0, "2020-01"), ("D", "C", "UL", 2.0, "2020-01"),
                             ("E", "C", "UL", 4.0, "2020-01"), ("D", None, "AC", 8.0, "2020-02")])
    items = _items(spark, [(0, "All", "All", "All", "2020-12"), (1, "All", "All", "UL", "2020-12"),
                           (2, "D", "All", "AC", "2020-12"), (3, "D", "All", "UL", "2020-12"),
                           (4, "All", "C", "AC", "2020-12"), (5, "D", "C", "UL", "2020-12"),
                           (6, "", "C", "AC", "2020-12"), (7, "D", "All", "AC", "2020-01")])
    got = {}
    for r in S.hierarchy_expand(cells, items).collect():
        got.setdefault(r.item_id, {})[r.month_year] = r.y
    assert got[0] == {"2020-01": 7.0, "2020-02": 8.0}          # total = grand total
    assert got[1] == {"2020-01": 6.0}
    assert got[2] == got[3] == {"2020-01": 3.0, "2020-02": 8.0}  # channel ignored below the channel level
    assert got[4] == {"2020-01": 7.0}                           # null category not in category series
    assert got[5] == {"2020-01": 3.0}
    assert 6 not in got                                         # blank customer: bad item
    assert got[7] == {"2020-01": 3.0}                           # as-of cutoff
    scoped = {r.item_id: r.y for r in S.hierarchy_expand(cells, items, channel_scoped=True)
              .filter("month_year = '2020-01'").collect()}
    assert scoped[2] == 1.0 and scoped[3] == 2.0


def test_tail_split_and_cap(spark):
    raw = spark.createDataFrame([(1, m, float(i + 1)) for i, m in enumerate(months(2020, 1, 10))],
                                "item_id long, month_year string, y double")
    split = S.tail_split(S.gap_fill(raw), 6)
    rows = split.orderBy("t").collect()
    assert [r.is_test for r in rows] == [False] * 4 + [True] * 6
    cap = S.holdout_cap(split).first()
    assert cap.test_mean == pytest.approx(7.5) and cap.cap == pytest.approx(37.5)


def test_clip_sanitize_edges(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (4.0,)], "y double")
    out = [r.v for r in df.select(E.clip_sanitize(F.col("y"), F.lit(10.0)).alias("v")).collect()]
    assert out == [1e-10, 10.0, 0.0, 1e-10, 4.0]


def test_zero_actual_errors(spark):
    actuals = spark.createDataFrame([(1, 1, 0.0)], "item_id long, t long, y double")
    preds = spark.createDataFrame([(1, "HWExSmooth", "test", 1, 5.0)], "item_id long, model string, phase string, t long, yhat double")
    m = M.error_metrics(actuals, preds).first()
    assert math.isfinite(m.mape) and m.mape > 1e10
    assert m.maape == pytest.approx(math.pi / 2, abs=1e-9)
    assert m.mae == 5.0


def test_best_model_tie_and_nulls(spark):
    mm = spark.createDataFrame(
        [(1, "Prophet", 1.0, 5.0, 0.2), (1, "SARIMAX", 2.0, 5.0, 0.3), (1, "HWExSmooth", None, None, None),
         (2, "HWExSmooth", 3.0, 7.0, 0.1), (2, "XGBoost", 3.0, 7.0, 0.1)],
        "item_id long, model string, mae double, mape double, maape double")
    b = {r.item_id: r for r in M.best_model(mm).collect()}
    assert b[1].mape_model == "SARIMAX" and b[1].mae_v == 2.0 and b[1].maape_model == "Prophet"
    assert b[2].mape_model == "XGBoost"


@pytest.mark.parametrize("last,fc,label", [(100.0, 110.0, "UP"), (100.0, 90.0, "DW"), (100.0, 100.0, "NC"),
                                           (0.0, 0.0, "UP")])
def test_trend_label_borders(spark, last, fc, label):
    df = spark.createDataFrame([(last, fc)], "a double, b double")
    assert df.select(E.trend_label(F.col("a"), F.col("b"))).first()[0] == label


def test_labels_equal_and_rescale(spark):
    df = spark.createDataFrame([(150.0, 150.0, 100.0, 100.0), (10.0, 20.0, 1.0, 2.0)],
                               "mape_min double, baseline_mape double, tmonth_amt double, forecast_amt double")
    rows = M.labels(df).collect()
    assert rows[0].rmape == 0.0 and rows[0].pred_bt_base == "EQUAL" and rows[0].pred_bt_base_p == 0.0
    assert rows[1].pred_bt_base == "BETTER" and rows[1].pred_bt_base_p == pytest.approx(10.0)


def test_skip_done(spark):
    items = _items(spark, [(0, "A", "All", "AC", "2020-12"), (1, "B", "All", "AC", "2020-12")])
    done = spark.createDataFrame([("A", "All", "AC", "2020-12")], "debtorcode string, category string, projno string, last_trainmy string")
    assert [r.item_id for r in S.skip_done(items, done).collect()] == [1]


def test_scores_and_choice_do_not_depend_on_partitions(spark):
    """Errors, best models and ties are the same bits for any number of partitions, with adaptive execution or without."""
    import random

    from demand.operators import metrics as M
    rng = random.Random(3)
    actual = [(i, t, rng.choice([0.1, 0.3, 1e6, 7.7]) * rng.random()) for i in range(40) for t in range(6)]
    made = [(i, m, "test", t, None, rng.choice([1.1, 1e-9, 3e5]) * rng.random()) for i in range(40) for m in ("SARIMAX", "Prophet") for t in range(6)]
    made += [(i, "XGBoost", p, t, d, y) for i, m, p, t, d, y in made if m == "SARIMAX"]  # ties with the first label
    seen = set()
    saved = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        for n, parts in enumerate([1, 7, 200] * 3 + [3]):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.enabled", str(n % 2 == 0).lower())
            rng.shuffle(made)
            a = spark.createDataFrame(actual, "item_id long, t int, y double").repartition(parts)
            p = spark.createDataFrame(made, "item_id long, model string, phase string, t int, ds date, yhat double").repartition(min(parts, 40))
            m = M.error_metrics(a, p)
            best = M.best_model(m)
            seen.add(tuple(sorted(map(repr, m.collect() + best.collect()))))
            assert all(r.mape_model != "XGBoost" and r.maape_model != "XGBoost" for r in best.collect())
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert len(seen) == 1


def test_mean_in_order_skips_nulls(spark):
    from demand.functions.errors import mean_in_order
    rows = [(1, 2, 3.0), (1, 1, None), (1, 3, 5.0), (2, 1, None)]
    df = spark.createDataFrame(rows, "k int, t int, y double")
    got = {r.k: r.m for r in df.groupBy("k").agg(mean_in_order(F.col("y"), F.col("t")).alias("m")).collect()}
    assert got == {1: 4.0, 2: None}
