"""Facts and work-list operators on hand-made edge rows (FIXTURES.md section 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import cells_df, months
from demand.operators import facts, worklist as W
from demand.sources.warehouse import Warehouse


def _wh(spark, headers, lines, items, ch2):
    return Warehouse(
        headers=spark.createDataFrame(headers, "dockey long, docdate date, debtorcode string"),
        lines=spark.createDataFrame(lines, "dockey long, itemcode long, amount double, projno string"),
        items=spark.createDataFrame(items, "itemcode long, itemtype string"),
        channel2=spark.createDataFrame(ch2, "debtorcode string, docdate date, amount double, category string, invtype string"),
    )


def test_facts_filters_and_activity(spark):
    d = dt.date
    headers = [(1, d(2020, 1, 10), "A"), (2, d(2020, 12, 5), "B"), (3, d(2021, 1, 3), "C"), (4, d(2020, 2, 1), "C")]
    lines = [(1, 10, 5.0, None), (1, 11, -1.0, None), (1, None, 3.0, None), (1, 10, 2.0, "P1"),
             (2, 10, 7.0, None), (3, 10, 1.0, None), (4, 10, 4.0, None)]
    items = [(10, "SOAP"), (11, "SKIN")]
    ch2 = [("A", d(2020, 11, 2), 9.0, "X", "Normal"), ("A", d(2020, 3, 1), 1.5, "X", "Return"),
           ("D", d(2020, 5, 1), 2.0, "X", "Normal")]
    wh = _wh(spark, headers, lines, items, ch2)
    f = facts.sales_fact(wh, "2021-01-15").collect()
    got = sorted((r.debtorcode, r.y, r.projno, r.month_year) for r in f)
    # A: AC line kept (old AC rows kept because of UL activity in 2020-11);
    # B active in AC; C active only through the open month, its Jan row excluded
    # but the old Feb row kept; D inactive; negative, null-item and project lines dropped
    assert got == [("A", 5.0, "AC", "2020-01"), ("A", 9.0, "UL", "2020-11"), ("B", 7.0, "AC", "2020-12"),
                   ("C", 4.0, "AC", "2020-02")]
    c = facts.cells(wh, "2021-01-15").collect()
    assert sorted((r.debtorcode, r.y, r.month_year) for r in c) == sorted((g[0], g[1], g[3]) for g in got)


def test_grain_profile_null_category(spark):
    rows = [("D1", None, "AC", 1.0, "2020-01"), ("D1", "C1", "AC", 2.0, "2020-02")]
    prof = W.grain_profile(cells_df(spark, rows)).collect()
    by = {(r.grain, r.debtorcode, r.category, r.projno): r.n_cells for r in prof}
    assert by[(W.GRAIN_CUSTOMER, "D1", None, "AC")] == 2
    assert by[(W.GRAIN_CATEGORY, None, "C1", "AC")] == 1
    assert by[(W.GRAIN_CUSTOMER_CATEGORY, "D1", "C1", "AC")] == 1
    assert len(by) == 3


def _series_rows(name, ms, cat="C1", proj="AC"):
    return [(name, cat, proj, 1.0, m) for m in ms]


def test_qualify_density_span_and_staleness(spark):
    all_m = months(2018, 1, 40)
    cutoff = all_m[-1]
    span25 = all_m[-26:]                       # span 25 (exclusive difference)
    dense20 = [span25[0]] + span25[-19:]       # 20 cells over span 25: 20 >= 25*0.8
    sparse = [span25[0]] + span25[-18:]        # 19 cells: dropped
    span20 = all_m[-21:]                       # 21 consecutive months: span 20, kept
    span19 = all_m[-20:]                       # span 19, dropped
    stale = all_m[:30]                         # ends before the cutoff
    rows = (_series_rows("DENSE", dense20) + _series_rows("SPARSE", sparse) + _series_rows("S20", span20)
            + _series_rows("S19", span19) + _series_rows("STALE", stale))
    q = W.qualify_series(W.grain_profile(cells_df(spark, rows)), cutoff)
    kept = {r.debtorcode for r in q.filter(F.col("grain") == W.GRAIN_CUSTOMER).collect()}
    assert kept == {"DENSE", "S20"}


def test_worklist_order_and_sections(spark):
    ms = months(2018, 1, 30)
    rows = (_series_rows("B", ms) + _series_rows("A", ms, "C2", "UL") + _series_rows("A", ms, "C1", "AC"))
    wl = W.worklist(cells_df(spark, rows), ms[-1]).orderBy("row_idx").collect()
    keys = [(r.row_idx, r.debtorcode, r.category, r.projno) for r in wl]
    assert keys[:3] == [(0, "All", "All", "All"), (1, "All", "All", "UL"), (2, "All", "All", "AC")]
    assert [k[1:] for k in keys[3:]] == [
        ("A", "All", "AC"), ("A", "All", "UL"), ("B", "All", "AC"),          # customer section
        ("All", "C1", "AC"), ("All", "C2", "UL"),                           # category section
        ("A", "C1", "AC"), ("A", "C2", "UL"), ("B", "C1", "AC")]            # customer x category
    assert [k[0] for k in keys] == list(range(len(keys)))


def test_split_sequential_odd_and_random(spark):
    wl = spark.createDataFrame([(i, f"D{i}", "All", "AC", "2020-12") for i in range(5)],
                               "row_idx long, debtorcode string, category string, projno string, month_year string")
    parts = {r.row_idx: r.part for r in W.split_sequential(wl).collect()}
    assert [parts[i] for i in range(5)] == [1, 1, 2, 2, 2]
    r1 = W.split_random(wl, seed=3).collect()
    r2 = W.split_random(wl, seed=3).collect()
    assert sorted((r.row_idx, r.part) for r in r1) == sorted((r.row_idx, r.part) for r in r2)
    assert sum(r.part == 1 for r in r1) == 2 and len(r1) == 5


def test_split_random_property(spark):
    n = 101
    wl = spark.createDataFrame([(i, f"D{i}", "All", "AC", "2020-12") for i in range(n)],
                               "row_idx long, debtorcode string, category string, projno string, month_year string")
    out = W.split_random(wl, seed=11).collect()
    ids = sorted(r.row_idx for r in out)
    assert ids == list(range(n))  # complete and disjoint
    assert sum(r.part == 1 for r in out) == n // 2


def test_validate_cutoff():
    assert W.validate_cutoff(None, "2021-06") == "2021-06"
    assert W.validate_cutoff("2021-01", "2021-06") == "2021-01"
    with pytest.raises(ValueError):
        W.validate_cutoff("2021-07", "2021-06")


def test_dense_row_index_matches_sort(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k"))
    from demand.operators.indexing import dense_row_index
    out = dense_row_index(df, ["k"], num_partitions=7).collect()
    assert sorted((r.row_idx, r.k) for r in out) == [(i, i) for i in range(1000)]


def test_worklist_numbering_is_dense_on_real_tables(spark):
    """Regression: counts and rows of the numbering must see the same partitions."""
    from demand.sources.testdata import TESTDATA_AS_OF, TESTDATA_CUTOFF, warehouse_from_testdata
    cells = facts.cells(warehouse_from_testdata(spark, "/root/testdata/sf0.01"), TESTDATA_AS_OF)
    for _ in range(2):
        ids = sorted(r.row_idx for r in W.worklist(cells, TESTDATA_CUTOFF).collect())
        assert ids == list(range(206))


def test_small_amounts_are_summed_before_they_are_cast(spark):
    from demand.operators import series as S
    rows = [("D1", "2020-01-05", 0.004, "C1", "AC")] * 1000
    facts_df = spark.createDataFrame([(d, a, c, p, "2020-01") for d, _, a, c, p in rows],
                                     "debtorcode string, y double, category string, projno string, month_year string")
    assert facts.sum_by_cell(facts_df).first().y == 4.0
    # a decimal column keeps its own scale
    fine = facts_df.withColumn("y", F.lit("0.00000004").cast("decimal(18,8)"))
    assert abs(facts.sum_by_cell(fine).first().y - 0.00004) < 1e-15
    cells = spark.createDataFrame([("D1", "C1", "AC", 0.0049, "2020-01")],
                                  "debtorcode string, category string, projno string, y double, month_year string")
    assert {float(r.y_dec) for r in S.level_month_sums(cells).collect()} == {0.0049}


def test_amounts_keep_a_decimal_type(spark):
    from demand.sources.warehouse import canonical
    src = spark.createDataFrame([(1, "0.0049")], "k int, a string").withColumn("a", F.col("a").cast("decimal(18,4)"))
    assert dict(canonical(src, {"k": "dockey", "a": "amount"}).dtypes)["amount"] == "decimal(18,4)"


def test_partial_holdout_is_no_model(spark):
    from demand.operators import metrics as M
    preds = spark.createDataFrame([(1, "XGBoost", "test", t, 1.0) for t in range(4)] + [(1, "XGBoost", "future", t, 1.0) for t in range(6, 9)]
                                  + [(2, "XGBoost", "test", t, 1.0) for t in range(6)] + [(2, "XGBoost", "future", t, 1.0) for t in range(6, 9)],
                                  "item_id long, model string, phase string, t long, yhat double")
    metrics = spark.createDataFrame([(1, "XGBoost", 1.0), (2, "XGBoost", 1.0)], "item_id long, model string, mape double")
    assert {r.item_id: r.model_ok for r in M.model_ok(metrics, preds, 3).collect()} == {1: 0, 2: 1}
