"""Registered queries over the driver's test tables, with DuckDB twins.

Every query reads the given tables (through the warehouse adapter) and
returns a DataFrame whose column names match its SQL twin. Conventions that
make both engines produce identical values:

* amounts are summed as DECIMAL, then cast to DOUBLE (exact, order-free);
* derived doubles (interpolations, metrics, forecasts) are rounded to 4
  places on both sides;
* integer outputs are BIGINT on both sides.

The run date is fixed to the test data's ``as_of``.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..functions import errors as E
from ..operators import facts, metrics as M, series as S, worklist as W
from ..operators.models import naive
from ..sources.testdata import ORACLE_ADAPTER_SQL, TESTDATA_AS_OF, TESTDATA_CUTOFF, warehouse_from_testdata

AS_OF = TESTDATA_AS_OF
CUTOFF = TESTDATA_CUTOFF
EARLY_CUTOFF = "2000-12"   # a forced, earlier work-list month
CLOSED_START = "2001-08-01"
RECENT_START = "2001-05-01"
R = 4  # rounding of derived doubles
FORCED_MONTHS = [None, "", EARLY_CUTOFF, CUTOFF, "2001-09"]
POOLED_ROUNDS, POOLED_DEPTH = 2, 2
FINE_AMOUNT = "CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)) / 10"


def _r(c):
    return F.round(c, R)


def _r_off(c):
    """Means and lines of short decimals can end in a 5 that two engines leave on either side: move off it."""
    return F.round(c + F.lit(1e-6), R)


# ---------------------------------------------------------------------------
# Spark side

def _wh(spark, sf):
    return warehouse_from_testdata(spark, sf)


def _cells(spark, sf):
    return facts.cells(_wh(spark, sf), AS_OF)


def _worklist(spark, sf, cutoff=CUTOFF, cells=None):
    return W.worklist(cells if cells is not None else _cells(spark, sf), cutoff)


def _items(spark, sf, cutoff=CUTOFF, cells=None):
    wl = _worklist(spark, sf, cutoff, cells)
    return wl.withColumn("item_id", F.col("row_idx"))


def _raw(spark, sf, cutoff=CUTOFF):
    cells = _cells(spark, sf)  # one fact pass feeds both the work list and the series
    return S.hierarchy_expand(cells, _items(spark, sf, cutoff, cells))


def _split(spark, sf):
    return S.tail_split(S.gap_fill(_raw(spark, sf)))


def q_scan_sales_lines(spark, sf):
    return _wh(spark, sf).lines


def q_filter_valid_lines(spark, sf):
    return facts.filter_valid_lines(_wh(spark, sf).lines).select("dockey", "itemcode", "amount")


def q_filter_normal_invoices(spark, sf):
    return facts.filter_normal_invoices(_wh(spark, sf).channel2).select("debtorcode", "docdate", "amount", "category")


def q_closed_month_filter(spark, sf):
    return _wh(spark, sf).headers.filter(F.col("docdate") < facts.closed_month_start(AS_OF))


def q_join_lines_headers_items(spark, sf):
    return facts.join_lines_headers_items(_wh(spark, sf))


def q_month_key(spark, sf):
    h = _wh(spark, sf).headers
    return h.select("dockey", dates.month_key(F.col("docdate")).alias("month_year"))


def q_channel_constant(spark, sf):
    u = facts.union_channels(_wh(spark, sf))
    return u.groupBy("projno").agg(F.count(F.lit(1)).alias("n_rows"))


def q_month_diff(spark, sf):
    c = _cells(spark, sf)
    g = c.groupBy("debtorcode", "projno").agg(F.min("month_year").alias("month_year_min"),
                                              F.max("month_year").alias("month_year_max"))
    return g.withColumn("monthcount",
                        dates.month_diff(F.col("month_year_max"), F.col("month_year_min")).cast("long"))


def q_month_last_day(spark, sf):
    c = _cells(spark, sf).select("month_year").distinct()
    return c.select("month_year", dates.month_last_day(F.col("month_year")).alias("last_day"))


def q_last_closed_month(spark, sf):
    f = facts.sales_fact(_wh(spark, sf), AS_OF)
    g = f.groupBy("debtorcode").agg(F.max("month_year").alias("last_month"))
    lc = dates.last_closed_month(AS_OF)
    return g.select("debtorcode", "last_month", lc.alias("last_closed"),
                    dates.month_diff(lc, F.col("last_month")).cast("long").alias("months_behind"))


def q_union_channels(spark, sf):
    return facts.union_channels(_wh(spark, sf))


def _customer_wh(spark, sf):
    """The warehouse with customers instead of nations as debtors: many of them are not active."""
    return warehouse_from_testdata(spark, sf, debtor="o_custkey")


def q_active_customers(spark, sf):
    return facts.active_customers(_customer_wh(spark, sf), AS_OF)


def q_semi_join_active(spark, sf):
    wh = _customer_wh(spark, sf)
    return facts.union_channels(wh).join(facts.active_customers(wh, AS_OF), "debtorcode", "left_semi")


def q_sales_fact(spark, sf):
    return facts.sales_fact(_wh(spark, sf), AS_OF)


def q_sum_by_cell(spark, sf):
    return _cells(spark, sf)


def q_cell_sums_fine(spark, sf):
    """Cells of amounts with more than two decimals: summed first, cast last."""
    return facts.cells(warehouse_from_testdata(spark, sf, amount=FINE_AMOUNT), AS_OF)


def q_cutoff_filter(spark, sf):
    return facts.cutoff_filter(_cells(spark, sf), EARLY_CUTOFF)


def q_grain_profile_grouping_sets(spark, sf):
    p = W.grain_profile(_cells(spark, sf).filter(F.col("month_year") <= F.lit(CUTOFF)))
    return p.withColumn("grain", F.col("grain").cast("long"))


def q_qualify_series(spark, sf):
    p = W.grain_profile(_cells(spark, sf).filter(F.col("month_year") <= F.lit(CUTOFF)))
    return W.qualify_series(p, CUTOFF).withColumn("grain", F.col("grain").cast("long"))


def q_default_items(spark, sf):
    """The three roll-up items with the months of data each one covers."""
    items = W.default_items(spark, CUTOFF).withColumn("item_id", F.col("_ord").cast("long"))
    raw = S.hierarchy_expand(_cells(spark, sf), items)
    n = raw.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_months"))
    return items.join(n, "item_id", "left").select("debtorcode", "category", "projno", "month_year",
                                                   F.coalesce("n_months", F.lit(0)).cast("long").alias("n_months"))


def q_worklist(spark, sf):
    return _worklist(spark, sf)


def q_worklist_row_index(spark, sf):
    return _worklist(spark, sf, EARLY_CUTOFF)


def q_split_sequential(spark, sf):
    return W.split_sequential(_worklist(spark, sf)).withColumn("part", F.col("part").cast("long"))


def q_split_random(spark, sf):
    """Sizes of the random halves, what both hold, what neither holds, and whether the order was kept."""
    wl = _worklist(spark, sf)
    parts = W.split_random(wl, seed=7)
    both = wl.select("row_idx").join(parts.groupBy("row_idx").agg(F.collect_set("part").alias("p"), F.count("*").alias("n")), "row_idx", "left")
    return both.agg(F.count("*").alias("n_rows"), F.count(F.when(F.array_contains("p", 1), 1)).alias("n_first"),
                    F.count(F.when(F.array_contains("p", 2), 1)).alias("n_second"),
                    F.count(F.when(F.col("n") > 1, 1)).alias("n_in_both"), F.count(F.when(F.col("n").isNull(), 1)).alias("n_missing"),
                    (F.count(F.when(F.array_contains("p", 1) & (F.col("row_idx") >= F.floor(F.lit(wl.count()) / 2)), 1)) == 0)
                    .alias("is_sequential"))


def q_worklist_csv_roundtrip(spark, sf):
    from ..session import scratch_path
    from ..sources import worklist_io
    path = scratch_path(spark, "worklist-csv")
    worklist_io.write_worklist_csv(W.split_sequential(_worklist(spark, sf)), path)
    return worklist_io.read_worklist_csv(spark, path)


def q_skip_done_anti(spark, sf):
    """Items of the first half count as stored; the second half remains."""
    wl = W.split_sequential(_worklist(spark, sf))
    done = wl.filter("part = 1").select("debtorcode", "category", "projno", F.col("month_year").alias("last_trainmy"))
    return S.skip_done(wl.drop("part"), done)


def q_asof_cutoff_join(spark, sf):
    return _raw(spark, sf, EARLY_CUTOFF)


def q_hierarchy_expand(spark, sf):
    return _raw(spark, sf)


def q_series_month_sum(spark, sf):
    r = _raw(spark, sf)
    return r.select("item_id", dates.month_to_date(F.col("month_year")).alias("ds"), "y")


def q_last_train_month(spark, sf):
    return S.last_train_month(_raw(spark, sf))


def q_month_spine(spark, sf):
    return S.gap_fill(_raw(spark, sf)).select("item_id", F.col("t").cast("long").alias("t"), "ds")


def q_gap_profile(spark, sf):
    g = S.gap_profile(_raw(spark, sf))
    return g.select("item_id", "first_month", "last_month", *[F.col(c).cast("long").alias(c)
                                                            for c in ("n_known", "n_months", "n_missing")])


def q_linear_interpolate(spark, sf):
    g = S.gap_fill(_raw(spark, sf))
    return g.select("item_id", F.col("t").cast("long").alias("t"), "ds", _r(F.col("y")).alias("y"), "filled")


def q_tail_split(spark, sf):
    s = _split(spark, sf)
    return s.select("item_id", F.col("t").cast("long").alias("t"), _r(F.col("y")).alias("y"),
                    F.col("n").cast("long").alias("n"), F.col("pos").cast("long").alias("pos"), "is_test")


def q_holdout_cap(spark, sf):
    c = S.holdout_cap(_split(spark, sf))
    return c.select("item_id", _r(F.col("test_mean")).alias("test_mean"), _r(F.col("cap")).alias("cap"))


def q_lag_features(spark, sf):
    from ..operators import features
    lf = features.lag_features(_split(spark, sf), 6)
    return lf.select("item_id", F.col("t").cast("long").alias("t"), _r(F.col("y")).alias("y"),
                     *[_r(F.col(f"lag_{i}")).alias(f"lag_{i}") for i in range(1, 7)])


def q_walk_forward_origins(spark, sf):
    from ..operators import features
    w = features.walk_forward_origins(_split(spark, sf))
    return w.select("item_id", F.col("origin_t").cast("long").alias("origin_t"),
                    F.col("n_history").cast("long").alias("n_history"), _r(F.col("last_y")).alias("last_y"))


def q_future_months(spark, sf):
    f = S.future_months(_split(spark, sf))
    return f.select("item_id", F.col("step").cast("long").alias("step"), F.col("t").cast("long").alias("t"), "ds")


def _baseline(spark, sf):
    s = _split(spark, sf)
    return s, naive.baseline_naive(s, S.future_months(s))


def q_baseline_naive(spark, sf):
    _, b = _baseline(spark, sf)
    return b.select("item_id", "phase", F.col("t").cast("long").alias("t"), "ds", _r(F.col("yhat")).alias("yhat"))


def q_baseline_persistence(spark, sf):
    b = naive.baseline_persistence(_split(spark, sf))
    return b.select("item_id", F.col("t").cast("long").alias("t"), _r(F.col("yhat")).alias("yhat"))


def q_clip_sanitize(spark, sf):
    s, b = _baseline(spark, sf)
    caps = S.holdout_cap(s)
    j = b.join(caps, "item_id")
    return j.select("item_id", "phase", F.col("t").cast("long").alias("t"),
                    _r(E.clip_sanitize(F.col("yhat") * F.lit(1.5), F.col("cap"))).alias("yhat"))


def _baseline_metrics(spark, sf):
    s, b = _baseline(spark, sf)
    return M.error_metrics(s.filter("is_test"), b)


def q_error_metrics(spark, sf):
    m = _baseline_metrics(spark, sf)
    return m.select("item_id", "model", _r_off(F.col("mae")).alias("mae"), _r(F.col("mape")).alias("mape"),
                    _r(F.col("maape")).alias("maape"))


def q_rescale_accuracy(spark, sf):
    m = _baseline_metrics(spark, sf)
    return m.select("item_id", _r(E.rescale_accuracy(F.col("mape"))).alias("rbaseline"))


def q_vs_baseline_label(spark, sf):
    s = _split(spark, sf)
    pers = M.error_metrics(s.filter("is_test"), naive.baseline_persistence(s))
    base = _baseline_metrics(spark, sf)
    j = (pers.select("item_id", E.rescale_accuracy(F.col("mape")).alias("rmape"))
         .join(base.select("item_id", E.rescale_accuracy(F.col("mape")).alias("rbaseline")), "item_id"))
    return j.select("item_id", E.vs_baseline_label(F.col("rmape"), F.col("rbaseline")).alias("pred_bt_base"),
                    _r(E.vs_baseline_gap(F.col("rmape"), F.col("rbaseline"))).alias("pred_bt_base_p"))


def q_trend_label(spark, sf):
    """The first Holt-Winters forecast against the last actual."""
    from ..operators.models import holt_winters
    s = _split(spark, sf)
    b = holt_winters.holt_winters_grid(s)
    last = M.last_actual(s.filter("is_test"))
    first = b.filter("phase = 'future'").groupBy("item_id").agg(F.min_by("yhat", "t").alias("fc"))
    j = last.join(first, "item_id")
    return j.select("item_id", E.trend_label(F.col("tmonth_amt"), F.col("fc")).alias("pred_trend"),
                    _r(E.trend_pct(F.col("tmonth_amt"), F.col("fc"))).alias("pred_trend_p"))


QUERIES = {
    "scan_sales_lines": q_scan_sales_lines,
    "filter_valid_lines": q_filter_valid_lines,
    "filter_normal_invoices": q_filter_normal_invoices,
    "closed_month_filter": q_closed_month_filter,
    "join_lines_headers_items": q_join_lines_headers_items,
    "month_key": q_month_key,
    "channel_constant": q_channel_constant,
    "month_diff": q_month_diff,
    "month_last_day": q_month_last_day,
    "last_closed_month": q_last_closed_month,
    "union_channels": q_union_channels,
    "active_customers": q_active_customers,
    "semi_join_active": q_semi_join_active,
    "sales_fact": q_sales_fact,
    "sum_by_cell": q_sum_by_cell,
    "cell_sums_fine": q_cell_sums_fine,
    "cutoff_filter": q_cutoff_filter,
    "grain_profile_grouping_sets": q_grain_profile_grouping_sets,
    "qualify_series": q_qualify_series,
    "default_items": q_default_items,
    "worklist": q_worklist,
    "worklist_row_index": q_worklist_row_index,
    "split_sequential": q_split_sequential,
    "split_random": q_split_random,
    "worklist_csv_roundtrip": q_worklist_csv_roundtrip,
    "skip_done_anti": q_skip_done_anti,
    "asof_cutoff_join": q_asof_cutoff_join,
    "hierarchy_expand": q_hierarchy_expand,
    "series_month_sum": q_series_month_sum,
    "last_train_month": q_last_train_month,
    "month_spine": q_month_spine,
    "gap_profile": q_gap_profile,
    "linear_interpolate": q_linear_interpolate,
    "tail_split": q_tail_split,
    "holdout_cap": q_holdout_cap,
    "lag_features": q_lag_features,
    "walk_forward_origins": q_walk_forward_origins,
    "future_months": q_future_months,
    "baseline_naive": q_baseline_naive,
    "baseline_persistence": q_baseline_persistence,
    "clip_sanitize": q_clip_sanitize,
    "error_metrics": q_error_metrics,
    "rescale_accuracy": q_rescale_accuracy,
    "vs_baseline_label": q_vs_baseline_label,
    "trend_label": q_trend_label,
}


# ---------------------------------------------------------------------------
# DuckDB side

BASE_CTE = "WITH " + ORACLE_ADAPTER_SQL.strip() + f""",
valid AS (
  SELECT l.dockey, l.itemcode, l.amount FROM ivdtl l
  WHERE l.itemcode IS NOT NULL AND l.amount > 0 AND l.projno IS NULL),
jli AS (
  SELECT v.dockey, v.itemcode, h.debtorcode, h.docdate, v.amount, i.itemtype AS category
  FROM valid v JOIN iv h ON v.dockey = h.dockey JOIN item i ON i.itemcode = v.itemcode),
chan AS (
  SELECT debtorcode, docdate, amount, category, 'AC' AS projno FROM jli
  UNION ALL
  SELECT debtorcode, docdate, amount, category, 'UL' AS projno FROM ch2 WHERE invtype = 'Normal'),
active AS (SELECT debtorcode FROM chan WHERE docdate >= DATE '{RECENT_START}' GROUP BY debtorcode),
fact AS (
  SELECT debtorcode, docdate, CAST(amount AS DOUBLE) AS y, category, projno, strftime(docdate, '%Y-%m') AS month_year
  FROM chan WHERE docdate < DATE '{CLOSED_START}' AND debtorcode IN (SELECT debtorcode FROM active)),
cells AS (
  SELECT debtorcode, category, projno, CAST(SUM(CAST(y AS DECIMAL(28,6))) AS DOUBLE) AS y, month_year
  FROM fact GROUP BY month_year, debtorcode, category, projno)"""


CUSTOMER_CTE = BASE_CTE.replace("n.n_name AS debtorcode", "CAST(o.o_custkey AS VARCHAR) AS debtorcode")


def _profile_cte(cutoff: str) -> str:
    return f""",
prof AS (
  SELECT debtorcode, category, projno, COUNT(y) AS n_cells, MIN(month_year) AS month_year_min,
         MAX(month_year) AS month_year_max, CAST(GROUPING(debtorcode, category, projno) AS BIGINT) AS grain
  FROM (SELECT * FROM cells WHERE month_year <= '{cutoff}')
  GROUP BY GROUPING SETS ((debtorcode, projno), (category, projno), (debtorcode, category, projno))),
prof_k AS (
  SELECT * FROM prof WHERE (grain = 2 AND debtorcode IS NOT NULL AND projno IS NOT NULL)
     OR (grain = 4 AND category IS NOT NULL AND projno IS NOT NULL)
     OR (grain = 0 AND debtorcode IS NOT NULL AND category IS NOT NULL AND projno IS NOT NULL)),
qual AS (
  SELECT CASE WHEN grain = 4 THEN 'All' ELSE debtorcode END AS debtorcode,
         CASE WHEN grain = 2 THEN 'All' ELSE category END AS category,
         projno, month_year_max AS month_year, grain
  FROM (SELECT *, (CAST(substr(month_year_max, 1, 4) AS INTEGER) * 12 + CAST(substr(month_year_max, 6, 2) AS INTEGER))
                 - (CAST(substr(month_year_min, 1, 4) AS INTEGER) * 12 + CAST(substr(month_year_min, 6, 2) AS INTEGER))
                 AS monthcount FROM prof_k WHERE month_year_max = '{cutoff}')
  WHERE CAST(n_cells AS DOUBLE) >= CAST(monthcount AS DOUBLE) * 0.8 AND monthcount >= 20),
wl_rows AS (
  SELECT 'All' AS debtorcode, 'All' AS category, 'All' AS projno, '{cutoff}' AS month_year, 0 AS section, 0 AS ord
  UNION ALL SELECT 'All', 'All', 'UL', '{cutoff}', 0, 1
  UNION ALL SELECT 'All', 'All', 'AC', '{cutoff}', 0, 2
  UNION ALL SELECT debtorcode, category, projno, month_year,
                   CASE grain WHEN 2 THEN 1 WHEN 4 THEN 2 ELSE 3 END, 0 FROM qual),
wl AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY section, ord, debtorcode, category, projno) - 1 AS BIGINT) AS row_idx,
         debtorcode, category, projno, month_year FROM wl_rows)"""


SERIES_CTE = """,
items AS (
  SELECT row_idx AS item_id, month_year AS cutoff,
         CASE WHEN debtorcode = 'All' AND category = 'All' AND projno = 'All' THEN 0
              WHEN debtorcode = 'All' AND category = 'All' AND projno <> '' THEN 1
              WHEN debtorcode <> '' AND category = 'All' THEN 2
              WHEN debtorcode = 'All' AND category <> '' THEN 3
              WHEN debtorcode <> '' AND category <> '' THEN 4 END AS lvl,
         debtorcode AS d, category AS c, projno AS p
  FROM wl),
items_k AS (
  SELECT item_id, cutoff, lvl,
         CASE WHEN lvl IN (2, 4) THEN d ELSE '' END AS kd,
         CASE WHEN lvl IN (3, 4) THEN c ELSE '' END AS kc,
         CASE WHEN lvl = 1 THEN p ELSE '' END AS kp
  FROM items WHERE lvl IS NOT NULL),
cell_k AS (
  SELECT 0 AS lvl, '' AS kd, '' AS kc, '' AS kp, month_year, y FROM cells
  UNION ALL SELECT 1, '', '', projno, month_year, y FROM cells WHERE projno IS NOT NULL
  UNION ALL SELECT 2, debtorcode, '', '', month_year, y FROM cells WHERE debtorcode IS NOT NULL
  UNION ALL SELECT 3, '', category, '', month_year, y FROM cells WHERE category IS NOT NULL
  UNION ALL SELECT 4, debtorcode, category, '', month_year, y FROM cells
            WHERE debtorcode IS NOT NULL AND category IS NOT NULL),
lvl_sum AS (
  SELECT lvl, kd, kc, kp, month_year, SUM(CAST(y AS DECIMAL(28,6))) AS y_dec
  FROM cell_k GROUP BY lvl, kd, kc, kp, month_year),
raw AS (
  SELECT i.item_id, s.month_year, CAST(s.y_dec AS DOUBLE) AS y
  FROM lvl_sum s JOIN items_k i ON s.lvl = i.lvl AND s.kd = i.kd AND s.kc = i.kc AND s.kp = i.kp
  WHERE s.month_year <= i.cutoff),
base AS (
  SELECT item_id, CAST(substr(month_year, 1, 4) AS BIGINT) * 12 + CAST(substr(month_year, 6, 2) AS BIGINT) AS t0,
         y AS y0 FROM raw),
nxt AS (
  SELECT *, LEAD(t0) OVER (PARTITION BY item_id ORDER BY t0) AS t1,
            LEAD(y0) OVER (PARTITION BY item_id ORDER BY t0) AS y1 FROM base),
filled AS (
  SELECT item_id, t0 + k AS t,
         make_date(CAST(floor((t0 + k - 1) / 12) AS BIGINT),
                   CAST(t0 + k - floor((t0 + k - 1) / 12) * 12 AS BIGINT), 1) AS ds,
         CASE WHEN k = 0 THEN y0 ELSE ((y1 - y0) / CAST(t1 - t0 AS DOUBLE)) * k + y0 END AS y,
         k > 0 AS filled
  FROM (SELECT *, UNNEST(range(0, COALESCE(t1 - t0, 1))) AS k FROM nxt)),
split AS (
  SELECT item_id, t, ds, y, filled,
         MAX(t) OVER (PARTITION BY item_id) - MIN(t) OVER (PARTITION BY item_id) + 1 AS n,
         t - MIN(t) OVER (PARTITION BY item_id) AS pos,
         t > MAX(t) OVER (PARTITION BY item_id) - 6 AS is_test
  FROM filled),
caps AS (SELECT item_id, AVG(y ORDER BY t) AS test_mean, AVG(y ORDER BY t) * 5.0 AS cap FROM split WHERE is_test GROUP BY item_id),
fut AS (
  SELECT item_id, step, t_last + step AS t,
         make_date(CAST(floor((t_last + step - 1) / 12) AS BIGINT),
                   CAST(t_last + step - floor((t_last + step - 1) / 12) * 12 AS BIGINT), 1) AS ds
  FROM (SELECT item_id, MAX(t) AS t_last FROM split GROUP BY item_id), range(1, 4) r(step)),
base_pred AS (
  SELECT s.item_id, 'Baseline' AS model, 'test' AS phase, s.t, s.ds, lt.yhat
  FROM split s JOIN (SELECT item_id, arg_max(y, t) AS yhat FROM split WHERE NOT is_test GROUP BY item_id) lt
    ON s.item_id = lt.item_id WHERE s.is_test
  UNION ALL
  SELECT f.item_id, 'Baseline', 'future', f.t, f.ds, la.yhat
  FROM fut f JOIN (SELECT item_id, arg_max(y, t) AS yhat FROM split GROUP BY item_id) la ON f.item_id = la.item_id),
pers_pred AS (
  SELECT item_id, t, yhat FROM (
    SELECT item_id, t, is_test, LAG(y, 1) OVER (PARTITION BY item_id ORDER BY t) AS yhat FROM split) WHERE is_test),
base_metrics AS (
  SELECT b.item_id, b.model, AVG(abs(s.y - b.yhat) ORDER BY s.t) AS mae,
         AVG(abs((s.y - b.yhat + 1e-10) / (s.y + 1e-10)) ORDER BY s.t) * 100.0 AS mape,
         AVG(atan(abs((s.y - b.yhat + 1e-10) / (s.y + 1e-10))) ORDER BY s.t) AS maape
  FROM base_pred b JOIN split s ON b.item_id = s.item_id AND b.t = s.t
  WHERE b.phase = 'test' GROUP BY b.item_id, b.model),
pers_metrics AS (
  SELECT b.item_id, AVG(abs((s.y - b.yhat + 1e-10) / (s.y + 1e-10)) ORDER BY s.t) * 100.0 AS mape
  FROM pers_pred b JOIN split s ON b.item_id = s.item_id AND b.t = s.t GROUP BY b.item_id)"""


def _series(cutoff: str = CUTOFF) -> str:
    return BASE_CTE + _profile_cte(cutoff) + SERIES_CTE


WL = BASE_CTE + _profile_cte(CUTOFF)
SER = _series(CUTOFF)

ORACLES = {
    "scan_sales_lines": BASE_CTE + " SELECT dockey, itemcode, amount, projno FROM ivdtl",
    "filter_valid_lines": BASE_CTE + " SELECT dockey, itemcode, amount FROM valid",
    "filter_normal_invoices": BASE_CTE + " SELECT debtorcode, docdate, amount, category FROM ch2 WHERE invtype = 'Normal'",
    "closed_month_filter": BASE_CTE + f" SELECT dockey, docdate, debtorcode FROM iv WHERE docdate < DATE '{CLOSED_START}'",
    "join_lines_headers_items": BASE_CTE + " SELECT * FROM jli",
    "month_key": BASE_CTE + " SELECT dockey, strftime(docdate, '%Y-%m') AS month_year FROM iv",
    "channel_constant": BASE_CTE + " SELECT projno, COUNT(*) AS n_rows FROM chan GROUP BY projno",
    "month_diff": BASE_CTE + """ SELECT debtorcode, projno, month_year_min, month_year_max,
        CAST((CAST(substr(month_year_max,1,4) AS INTEGER)*12 + CAST(substr(month_year_max,6,2) AS INTEGER))
           - (CAST(substr(month_year_min,1,4) AS INTEGER)*12 + CAST(substr(month_year_min,6,2) AS INTEGER)) AS BIGINT)
          AS monthcount
        FROM (SELECT debtorcode, projno, MIN(month_year) AS month_year_min, MAX(month_year) AS month_year_max
              FROM cells GROUP BY debtorcode, projno)""",
    "month_last_day": BASE_CTE + """ SELECT month_year, last_day(CAST(month_year || '-01' AS DATE)) AS last_day
        FROM (SELECT DISTINCT month_year FROM cells)""",
    "last_closed_month": BASE_CTE + """ SELECT debtorcode, last_month, '2001-07' AS last_closed,
        CAST((2001*12 + 7) - (CAST(substr(last_month,1,4) AS INTEGER)*12 + CAST(substr(last_month,6,2) AS INTEGER))
             AS BIGINT) AS months_behind
        FROM (SELECT debtorcode, MAX(month_year) AS last_month FROM fact GROUP BY debtorcode)""",
    "union_channels": BASE_CTE + " SELECT * FROM chan",
    "active_customers": CUSTOMER_CTE + " SELECT debtorcode FROM active",
    "semi_join_active": CUSTOMER_CTE + " SELECT * FROM chan WHERE debtorcode IN (SELECT debtorcode FROM active)",
    "sales_fact": BASE_CTE + " SELECT * FROM fact",
    "sum_by_cell": BASE_CTE + " SELECT * FROM cells",
    "cell_sums_fine": BASE_CTE.replace("CAST(l_extendedprice AS DOUBLE) AS amount", f"CAST({FINE_AMOUNT} AS DOUBLE) AS amount")
        + " SELECT * FROM cells",
    "cutoff_filter": BASE_CTE + f" SELECT * FROM cells WHERE month_year <= '{EARLY_CUTOFF}'",
    "grain_profile_grouping_sets": WL + " SELECT * FROM prof_k",
    "qualify_series": WL + " SELECT * FROM qual",
    "default_items": SER.replace("FROM wl),", "FROM (SELECT * FROM wl WHERE row_idx < 3)),", 1)
        + """ SELECT w.debtorcode, w.category, w.projno, w.month_year, CAST(COALESCE(n.n_months, 0) AS BIGINT) AS n_months
        FROM (SELECT * FROM wl WHERE row_idx < 3) w LEFT JOIN (SELECT item_id, COUNT(*) AS n_months FROM raw GROUP BY item_id) n
        ON w.row_idx = n.item_id""",
    "worklist": WL + " SELECT * FROM wl",
    "worklist_row_index": BASE_CTE + _profile_cte(EARLY_CUTOFF) + " SELECT * FROM wl",
    "split_random": WL + """ SELECT COUNT(*) AS n_rows, CAST(floor(COUNT(*) * 0.5) AS BIGINT) AS n_first,
        CAST(COUNT(*) - floor(COUNT(*) * 0.5) AS BIGINT) AS n_second, CAST(0 AS BIGINT) AS n_in_both,
        CAST(0 AS BIGINT) AS n_missing, FALSE AS is_sequential FROM wl""",
    "split_sequential": WL + """ SELECT *, CAST(CASE WHEN row_idx < floor((SELECT COUNT(*) FROM wl) * 0.5) THEN 1 ELSE 2 END
        AS BIGINT) AS part FROM wl""",
    "worklist_csv_roundtrip": WL + """ SELECT *, CAST(CASE WHEN row_idx < floor((SELECT COUNT(*) FROM wl) * 0.5) THEN 1 ELSE 2 END
        AS BIGINT) AS part FROM wl""",
    "skip_done_anti": WL + " SELECT * FROM wl WHERE row_idx >= floor((SELECT COUNT(*) FROM wl) * 0.5)",
    "asof_cutoff_join": _series(EARLY_CUTOFF) + " SELECT item_id, month_year, y FROM raw",
    "hierarchy_expand": SER + " SELECT item_id, month_year, y FROM raw",
    "series_month_sum": SER + " SELECT item_id, CAST(month_year || '-01' AS DATE) AS ds, y FROM raw",
    "last_train_month": SER + " SELECT item_id, MAX(month_year) AS last_trainmy FROM raw GROUP BY item_id",
    "month_spine": SER + " SELECT item_id, t, ds FROM filled",
    "gap_profile": SER + """ SELECT item_id, MIN(month_year) AS first_month, MAX(month_year) AS last_month,
        CAST(COUNT(*) AS BIGINT) AS n_known,
        CAST(MAX(CAST(substr(month_year,1,4) AS INTEGER)*12 + CAST(substr(month_year,6,2) AS INTEGER))
           - MIN(CAST(substr(month_year,1,4) AS INTEGER)*12 + CAST(substr(month_year,6,2) AS INTEGER)) + 1 AS BIGINT) AS n_months,
        CAST(MAX(CAST(substr(month_year,1,4) AS INTEGER)*12 + CAST(substr(month_year,6,2) AS INTEGER))
           - MIN(CAST(substr(month_year,1,4) AS INTEGER)*12 + CAST(substr(month_year,6,2) AS INTEGER)) + 1 - COUNT(*) AS BIGINT)
           AS n_missing
        FROM raw GROUP BY item_id""",
    "linear_interpolate": SER + " SELECT item_id, t, ds, round(y, 4) AS y, filled FROM filled",
    "tail_split": SER + " SELECT item_id, t, round(y, 4) AS y, n, pos, is_test FROM split",
    "holdout_cap": SER + " SELECT item_id, round(test_mean, 4) AS test_mean, round(cap, 4) AS cap FROM caps",
    "lag_features": SER + """ SELECT * FROM (
        SELECT item_id, t, round(y, 4) AS y,
          round(LAG(y, 1) OVER w, 4) AS lag_1, round(LAG(y, 2) OVER w, 4) AS lag_2, round(LAG(y, 3) OVER w, 4) AS lag_3,
          round(LAG(y, 4) OVER w, 4) AS lag_4, round(LAG(y, 5) OVER w, 4) AS lag_5, round(LAG(y, 6) OVER w, 4) AS lag_6
        FROM split WINDOW w AS (PARTITION BY item_id ORDER BY t)) WHERE lag_6 IS NOT NULL""",
    "walk_forward_origins": SER + """ SELECT o.item_id, o.t AS origin_t, CAST(COUNT(*) AS BIGINT) AS n_history,
        round(arg_max(h.y, h.t), 4) AS last_y
        FROM split o JOIN split h ON o.item_id = h.item_id AND h.t < o.t
        WHERE o.is_test GROUP BY o.item_id, o.t""",
    "future_months": SER + " SELECT item_id, step, t, ds FROM fut",
    "baseline_naive": SER + " SELECT item_id, phase, t, ds, round(yhat, 4) AS yhat FROM base_pred",
    "baseline_persistence": SER + " SELECT item_id, t, round(yhat, 4) AS yhat FROM pers_pred",
    "clip_sanitize": SER + """ SELECT b.item_id, b.phase, b.t,
        round(CASE WHEN b.yhat * 1.5 IS NULL OR isnan(b.yhat * 1.5) THEN 1e-10
                   ELSE greatest(0.0, least(b.yhat * 1.5, c.cap)) END, 4) AS yhat
        FROM base_pred b JOIN caps c ON b.item_id = c.item_id""",
    "error_metrics": SER + """ SELECT item_id, model, round(mae + 1e-6, 4) AS mae, round(mape, 4) AS mape,
        round(maape, 4) AS maape FROM base_metrics""",
    "rescale_accuracy": SER + " SELECT item_id, round(greatest(0.0, 100.0 - mape), 4) AS rbaseline FROM base_metrics",
    "vs_baseline_label": SER + """ SELECT item_id,
        CASE WHEN rmape > rbaseline THEN 'BETTER' WHEN rmape < rbaseline THEN 'WORST' ELSE 'EQUAL' END AS pred_bt_base,
        round(CASE WHEN rmape > rbaseline THEN rmape - rbaseline WHEN rmape < rbaseline THEN rbaseline - rmape ELSE 0.0 END, 4)
          AS pred_bt_base_p
        FROM (SELECT p.item_id, greatest(0.0, 100.0 - p.mape) AS rmape, greatest(0.0, 100.0 - b.mape) AS rbaseline
              FROM pers_metrics p JOIN base_metrics b ON p.item_id = b.item_id)""",
    "trend_label": """ SELECT item_id,
        CASE WHEN fc >= last + last * 0.1 THEN 'UP' WHEN fc <= last - last * 0.1 THEN 'DW' ELSE 'NC' END AS pred_trend,
        round(abs((fc - last + 1e-10) / (last + 1e-10) * 100.0), 4) AS pred_trend_p
        FROM (SELECT l.item_id, l.last, f.fc FROM
                (SELECT item_id, arg_max(y, t) AS last FROM split WHERE is_test GROUP BY item_id) l
                JOIN (SELECT item_id, arg_min(yhat, t) AS fc FROM hw_pred WHERE phase = 'future' GROUP BY item_id) f
                ON l.item_id = f.item_id)""",
}


@lru_cache(maxsize=1)
def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)


# ---------------------------------------------------------------------------
# Model scoring, selection and the record (Holt-Winters has a SQL twin:
# the same recurrence as a recursive CTE).

def _dbl_values(name, vals):
    return "(VALUES " + ", ".join(f"(CAST({v!r} AS DOUBLE))" for v in vals) + f") {name}({name})"


def _hw_sql() -> str:
    from ..operators.models import holt_winters as hw
    l0 = "(" * 6 + "0.0" + "".join(f" + zs[{i}])" for i in range(1, 7)) + " / 6.0"
    l1 = "(" * 6 + "0.0" + "".join(f" + zs[{i}])" for i in range(7, 13)) + " / 6.0"
    s0 = "[" + ", ".join(f"zs[{i}] / l0" for i in range(1, 7)) + "]"
    f = "(l + phi * b)"
    z, y = "zs[i + 1]", "ys[i + 1]"
    nl = f"(alpha * {z} / s[1] + (1.0 - alpha) * {f})"

    def back(x, lam="lam"):
        return f"(CASE WHEN {lam} = 1 THEN {x} ELSE pow(greatest({x}, 0.0), 1.0 / {lam}) END)"
    point = "alpha, beta, gamma, phi, lam"

    def search(rec, points):
        """Recurrence of every series at every point of ``points`` (item_id, phase, point)."""
        return f"""{rec} AS (
  SELECT item_id, phase, ys, zs, len_fit, t_end, steps, {point}, 6 AS i,
         l0 AS l, (l1 - l0) / 6.0 AS b, {s0} AS s, CAST(0.0 AS DOUBLE) AS sse
  FROM (SELECT *, {l0} AS l0, {l1} AS l1 FROM (
          SELECT f.*, {point}, [CASE WHEN lam = 1 THEN v ELSE pow(v, lam) END for v in ys] AS zs
          FROM hw_fit f JOIN {points} g ON f.item_id = g.item_id AND f.phase = g.phase))
  UNION ALL
  SELECT item_id, phase, ys, zs, len_fit, t_end, steps, {point}, i + 1,
         {nl},
         beta * ({nl} - l) + (1.0 - beta) * phi * b,
         list_concat(s[2:6], [gamma * {z} / {f} + (1.0 - gamma) * s[1]]),
         sse + ({y} - {back(f + " * s[1]")}) * ({y} - {back(f + " * s[1]")})
  FROM {rec} WHERE i < len_fit)"""

    def winner(name, rec):
        return f"""{name} AS (
  SELECT item_id, phase,
         arg_min(struct_pack(alpha := alpha, beta := beta, gamma := gamma, phi := phi, lam := lam),
                 struct_pack(e := CASE WHEN isnan(sse) THEN 'inf'::DOUBLE ELSE sse END, k := -lam)) AS g0
  FROM {rec} WHERE i = len_fit GROUP BY item_id, phase)"""

    def clip(p, k):
        return (f"least(CAST({hw.REFINE_HIGH[k]!r} AS DOUBLE), "
                f"greatest(CAST({hw.REFINE_LOW[k]!r} AS DOUBLE), g0.{p} + d_{p}))")
    clip_a, clip_b, clip_g, clip_p = (clip(p, k) for k, p in enumerate(hw.PARAMS))
    offs = ", ".join(_dbl_values(f"d_{p}", [-st, 0.0, st]) for p, st in zip(hw.PARAMS, hw.REFINE_STEPS))
    return f""",
hw_in AS (
  SELECT item_id, list(y ORDER BY t) AS ys, COUNT(*) AS n, SUM(CASE WHEN is_test THEN 0 ELSE 1 END) AS n_train,
         MAX(t) AS t_last, MIN(CASE WHEN NOT is_test THEN y END) AS min_train, MIN(y) AS min_all
  FROM split GROUP BY item_id),
hw_fit AS (
  SELECT item_id, 'test' AS phase, ys, n_train AS len_fit, t_last - 6 AS t_end, 6 AS steps FROM hw_in
  WHERE n_train >= 12 AND min_train > 0
  UNION ALL
  SELECT item_id, 'future', ys, n, t_last, 3 FROM hw_in WHERE n >= 12 AND min_all > 0),
hw_grid AS (
  SELECT item_id, phase, alpha, beta, gamma, phi, CAST(1 AS DOUBLE) AS lam
  FROM hw_fit, {_dbl_values('alpha', hw.ALPHAS)}, {_dbl_values('beta', hw.BETAS)},
       {_dbl_values('gamma', hw.GAMMAS)}, {_dbl_values('phi', hw.PHIS)}),
{search("hw_rec", "hw_grid")},
{winner("hw_best1", "hw_rec")},
hw_grid1 AS (
  SELECT item_id, phase, g0.alpha AS alpha, g0.beta AS beta, g0.gamma AS gamma, g0.phi AS phi, lam
  FROM hw_best1, {_dbl_values('lam', hw.LAMBDAS)}),
{search("hw_rec1", "hw_grid1")},
{winner("hw_best2", "hw_rec1")},
hw_grid2 AS (
  SELECT item_id, phase,
         {clip_a} AS alpha, {clip_b} AS beta, {clip_g} AS gamma, {clip_p} AS phi, g0.lam AS lam
  FROM hw_best2, {offs}),
{search("hw_rec2", "hw_grid2")},
hw_best AS (
  SELECT item_id, phase, t_end, steps,
         arg_min(struct_pack(l := l, b := b, s := s, phi := phi, lam := lam), CASE WHEN isnan(sse) THEN 'inf'::DOUBLE ELSE sse END) AS st
  FROM hw_rec2 WHERE i = len_fit GROUP BY item_id, phase, t_end, steps),
hw_pred AS (
  SELECT item_id, 'HWExSmooth' AS model, phase, t_end + h AS t,
         make_date(CAST(floor((t_end + h - 1) / 12) AS BIGINT), CAST(t_end + h - floor((t_end + h - 1) / 12) * 12 AS BIGINT), 1) AS ds,
         {back("((st.l + (st.phi * (1.0 - pow(st.phi, h)) / (1.0 - st.phi)) * st.b) * st.s[((h - 1) % 6) + 1])", "st.lam")} AS yhat
  FROM (SELECT *, UNNEST(range(1, steps + 1)) AS h FROM hw_best)),
all_pred AS (SELECT item_id, model, phase, t, ds, yhat FROM base_pred UNION ALL SELECT * FROM hw_pred),
clipped AS (
  SELECT p.item_id, p.model, p.phase, p.t, p.ds,
         CASE WHEN p.model = 'Baseline' THEN greatest(0.0, least(p.yhat, c.cap))
              WHEN p.yhat IS NULL OR isnan(p.yhat) THEN 1e-10
              ELSE greatest(0.0, least(p.yhat, c.cap)) END AS yhat
  FROM all_pred p JOIN caps c ON p.item_id = c.item_id),
mm_raw AS (
  SELECT p.item_id, p.model, AVG(abs(s.y - p.yhat) ORDER BY s.t) AS mae,
         AVG(abs((s.y - p.yhat + 1e-10) / (s.y + 1e-10)) ORDER BY s.t) * 100.0 AS mape,
         AVG(atan(abs((s.y - p.yhat + 1e-10) / (s.y + 1e-10))) ORDER BY s.t) AS maape
  FROM clipped p JOIN split s ON p.item_id = s.item_id AND p.t = s.t
  WHERE p.phase = 'test' AND p.model <> 'Baseline' GROUP BY p.item_id, p.model),
fut_n AS (
  SELECT item_id, model, COUNT(*) FILTER (WHERE phase = 'future') AS nf, COUNT(*) FILTER (WHERE phase = 'test') AS nt
  FROM clipped WHERE yhat IS NOT NULL GROUP BY item_id, model),
mok AS (
  SELECT m.item_id, m.model,
         CAST(CASE WHEN m.mape IS NOT NULL AND COALESCE(f.nf, 0) >= 3 AND COALESCE(f.nt, 0) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS model_ok
  FROM mm_raw m LEFT JOIN fut_n f ON m.item_id = f.item_id AND m.model = f.model),
mm AS (
  SELECT m.item_id, m.model, CASE WHEN k.model_ok = 1 THEN m.mae END AS mae,
         CASE WHEN k.model_ok = 1 THEN m.mape END AS mape, CASE WHEN k.model_ok = 1 THEN m.maape END AS maape
  FROM mm_raw m JOIN mok k ON m.item_id = k.item_id AND m.model = k.model),
ranked AS (
  SELECT *, CASE model WHEN 'SARIMAX' THEN 1 WHEN 'Prophet' THEN 2 WHEN 'XGBoost' THEN 3 WHEN 'HWExSmooth' THEN 4 ELSE 5 END AS rk
  FROM mm),
best_mape AS (
  SELECT item_id, arg_min(struct_pack(model := model, mape := mape, mae := mae), struct_pack(a := round(mape, 9), b := rk)) AS bm
  FROM ranked WHERE mape IS NOT NULL AND NOT isnan(mape) GROUP BY item_id),
best_maape AS (
  SELECT item_id, arg_min(struct_pack(model := model, maape := maape), struct_pack(a := round(maape, 9), b := rk)) AS bq
  FROM ranked WHERE maape IS NOT NULL AND NOT isnan(maape) GROUP BY item_id),
best AS (
  SELECT COALESCE(a.item_id, q.item_id) AS item_id, a.bm.model AS mape_model, a.bm.mape AS mape_min, a.bm.mae AS mae_v,
         q.bq.model AS maape_model, q.bq.maape AS maape_min
  FROM best_mape a FULL JOIN best_maape q ON a.item_id = q.item_id),
rec AS (
  SELECT w.debtorcode, w.category, w.projno, lt.last_trainmy, b.mape_model, b.mape_min, b.mae_v, b.maape_model, b.maape_min,
         c.test_mean, bl.mape AS baseline_mape, la.tmonth_amt, fc.forecast_amt, sz.n, lv.lvl
  FROM wl w
  LEFT JOIN items lv ON w.row_idx = lv.item_id
  LEFT JOIN (SELECT item_id, MAX(month_year) AS last_trainmy FROM raw GROUP BY item_id) lt ON w.row_idx = lt.item_id
  LEFT JOIN (SELECT item_id, MAX(n) AS n FROM split GROUP BY item_id) sz ON w.row_idx = sz.item_id
  LEFT JOIN best b ON w.row_idx = b.item_id
  LEFT JOIN caps c ON w.row_idx = c.item_id
  LEFT JOIN base_metrics bl ON w.row_idx = bl.item_id
  LEFT JOIN (SELECT item_id, arg_max(y, t) AS tmonth_amt FROM split WHERE is_test GROUP BY item_id) la ON w.row_idx = la.item_id
  LEFT JOIN (SELECT c.item_id, arg_min(c.yhat, c.t) AS forecast_amt FROM clipped c JOIN best b2
               ON c.item_id = b2.item_id AND c.model = b2.mape_model WHERE c.phase = 'future' GROUP BY c.item_id) fc
    ON w.row_idx = fc.item_id),
rec2 AS (
  SELECT *, CASE WHEN mape_min IS NOT NULL THEN greatest(0.0, 100.0 - mape_min) END AS rmape,
         CASE WHEN baseline_mape IS NOT NULL THEN greatest(0.0, 100.0 - baseline_mape) END AS rbaseline FROM rec),
record AS (
  SELECT debtorcode, category, projno, last_trainmy, mape_model, round(mape_min, 4) AS mape_min, round(rmape, 4) AS rmape,
         round(rbaseline, 4) AS rbaseline, maape_model, round(maape_min, 4) AS maape_min, round(test_mean, 4) AS test_mean,
         CASE WHEN rmape > rbaseline THEN 'BETTER' WHEN rmape < rbaseline THEN 'WORST' WHEN rmape = rbaseline THEN 'EQUAL' END
           AS pred_bt_base,
         round(abs(rmape - rbaseline), 4) AS pred_bt_base_p,
         CASE WHEN forecast_amt >= tmonth_amt + tmonth_amt * 0.1 THEN 'UP'
              WHEN forecast_amt <= tmonth_amt - tmonth_amt * 0.1 THEN 'DW'
              WHEN forecast_amt IS NOT NULL AND tmonth_amt IS NOT NULL THEN 'NC' END AS pred_trend,
         round(mae_v + 1e-6, 4) AS mae_v,
         round(abs((forecast_amt - tmonth_amt + 1e-10) / (tmonth_amt + 1e-10) * 100.0), 4) AS pred_trend_p,
         round(tmonth_amt, 4) AS tmonth_amt, round(forecast_amt + 1e-6, 4) AS forecast_amt,
         CASE WHEN lvl IS NULL THEN 'bad_item' WHEN n IS NULL THEN 'no_data' WHEN n <= 6 THEN 'too_short' WHEN mape_model IS NULL THEN 'no_model' ELSE 'ok' END
           AS status
  FROM rec2)"""


HW = SER.replace("WITH ", "WITH RECURSIVE ", 1) + _hw_sql()
ORACLES["trend_label"] = HW + ORACLES["trend_label"]
# Predictors that SQL can say, under the labels of the models: scoring, selection and the record are checked on
# candidates that compete (several winners) and tie (two labels with the same numbers).
COMPETING = HW.replace("all_pred AS (", """comp_pred AS (
  SELECT p.item_id, 'SARIMAX' AS model, CASE WHEN p.t + 12 <= l.t_last THEN 'test' ELSE 'future' END AS phase, p.t + 12 AS t,
         make_date(CAST(floor((p.t + 11) / 12) AS BIGINT), CAST(p.t + 12 - floor((p.t + 11) / 12) * 12 AS BIGINT), 1) AS ds, p.y AS yhat
  FROM split p JOIN (SELECT item_id, MAX(t) AS t_last FROM split GROUP BY item_id) l ON p.item_id = l.item_id
  WHERE p.t + 12 > l.t_last - 6 AND p.t + 12 <= l.t_last + 3),
drift_fit AS (
  SELECT item_id, 'test' AS phase, 6 AS steps, arg_min(y, t) AS y0, arg_max(y, t) AS y1, MIN(t) AS t0, MAX(t) AS t1
  FROM split WHERE NOT is_test GROUP BY item_id
  UNION ALL
  SELECT item_id, 'future', 3, arg_min(y, t), arg_max(y, t), MIN(t), MAX(t) FROM split GROUP BY item_id),
drift_pred AS (
  SELECT item_id, 'Prophet' AS model, phase, t1 + h AS t,
         make_date(CAST(floor((t1 + h - 1) / 12) AS BIGINT), CAST(t1 + h - floor((t1 + h - 1) / 12) * 12 AS BIGINT), 1) AS ds,
         y1 + h * ((y1 - y0) / CAST(t1 - t0 AS DOUBLE)) AS yhat
  FROM (SELECT *, UNNEST(range(1, steps + 1)) AS h FROM drift_fit WHERE t1 > t0)),
all_pred AS (
  SELECT * FROM comp_pred UNION ALL SELECT item_id, 'XGBoost', phase, t, ds, yhat FROM comp_pred
  UNION ALL SELECT * FROM drift_pred UNION ALL """, 1)
# Work-list rows that end in every status: no level, no data, five months, ten months (Holt-Winters needs twelve).
ODD_ITEMS = [(900001, "", "C9", "AC", CUTOFF), (900002, "NOBODY", "All", "AC", CUTOFF), (900003, "All", "All", "All", "1995-05"),
             (900004, "All", "All", "All", "1995-10")]
STATUSES = HW.replace("- 1 AS BIGINT) AS row_idx,\n         debtorcode, category, projno, month_year FROM wl_rows)",
                      "- 1 AS BIGINT) AS row_idx,\n         debtorcode, category, projno, month_year FROM wl_rows\n  UNION ALL VALUES "
                      + ", ".join(f"(CAST({i} AS BIGINT), '{d}', '{c}', '{p}', '{m}')" for i, d, c, p, m in ODD_ITEMS) + ")", 1)


def _competing() -> dict:
    """Predictors with SQL twins under the four labels; the third repeats the first, for ties."""
    from ..operators.models import holt_winters

    def labelled(fn, label):
        return lambda split, n_test, horizon, **_: fn(split, n_test, horizon).withColumn("model", F.lit(label))

    return {"SARIMAX": labelled(naive.seasonal_naive, "SARIMAX"), "Prophet": labelled(naive.drift, "Prophet"),
            "XGBoost": labelled(naive.seasonal_naive, "XGBoost"), "HWExSmooth": labelled(holt_winters.holt_winters_grid, "HWExSmooth")}


def _scored(spark, sf):
    from . import forecast_job
    split = _split(spark, sf)
    preds, mm, bm, caps = forecast_job.score(split, registry=_competing())
    return split, preds, mm, bm, caps


RECORD_COLUMNS = ["debtorcode", "category", "projno", "last_trainmy", "mape_model", "mape_min", "rmape", "rbaseline",
                  "maape_model", "maape_min", "test_mean", "pred_bt_base", "pred_bt_base_p", "pred_trend", "mae_v",
                  "pred_trend_p", "tmonth_amt", "forecast_amt", "status"]
ROUNDED = {"mape_min", "rmape", "rbaseline", "maape_min", "test_mean", "pred_bt_base_p", "mae_v", "pred_trend_p",
           "tmonth_amt", "forecast_amt"}


def _record_view(rec):
    return rec.select(*[_r_off(F.col(c)).alias(c) if c in ("mae_v", "forecast_amt") else _r(F.col(c)).alias(c) if c in ROUNDED else F.col(c)
                        for c in RECORD_COLUMNS])


def _record(spark, sf, with_json=False, registry="competing"):
    """All four labels: by the competing predictors, or (registry=None) by the models themselves."""
    from . import forecast_job
    cells = _cells(spark, sf)
    return forecast_job.forecast_record(cells, _worklist(spark, sf, cells=cells), with_json=with_json,
                                        registry=_competing() if registry else None)


def q_holt_winters_grid(spark, sf):
    from ..operators.models import holt_winters
    p = holt_winters.holt_winters_grid(_split(spark, sf))
    return p.select("item_id", "model", "phase", F.col("t").cast("long").alias("t"), "ds", _r(F.col("yhat")).alias("yhat"))


def q_model_subset(spark, sf):
    _, preds, _, _, _ = _scored(spark, sf)
    return preds.select("item_id", "model", "phase", F.col("t").cast("long").alias("t"), _r_off(F.col("yhat")).alias("yhat"))


def q_model_ok(spark, sf):
    split, preds, _, _, _ = _scored(spark, sf)
    raw = M.error_metrics(split.filter("is_test").select("item_id", "t", "y"), preds.filter("model <> 'Baseline'"))
    ok = M.model_ok(raw, preds, 3)
    return ok.select("item_id", "model", F.col("model_ok").cast("long").alias("model_ok"))


def q_model_scores_long(spark, sf):
    _, _, mm, bm, _ = _scored(spark, sf)
    return mm.unionByName(bm).select("item_id", "model", _r_off(F.col("mae")).alias("mae"), _r(F.col("mape")).alias("mape"),
                                     _r(F.col("maape")).alias("maape"))


def q_best_model(spark, sf):
    _, _, mm, _, _ = _scored(spark, sf)
    b = M.best_model(mm)
    return b.select("item_id", "mape_model", _r(F.col("mape_min")).alias("mape_min"), _r_off(F.col("mae_v")).alias("mae_v"),
                    "maape_model", _r(F.col("maape_min")).alias("maape_min"))


def q_future_forecasts(spark, sf):
    _, preds, _, _, _ = _scored(spark, sf)
    f = preds.filter("phase = 'future'")
    return f.select("item_id", "model", F.col("t").cast("long").alias("t"), "ds", _r_off(F.col("yhat")).alias("yhat"))


def q_forecast_record(spark, sf):
    return _record_view(_record(spark, sf))


def q_json_pack(spark, sf):
    """The five JSON documents of every record, parsed back into (document, column, key, value) rows."""
    docs = ("metrics_df", "train_df", "validation_df", "forecast_df", "baseline_df")
    rec = _record(spark, sf, with_json=True)
    parsed = F.array(*[F.struct(F.lit(d).alias("doc"), F.from_json(d, "map<string,map<string,string>>").alias("m")) for d in docs])
    rows = (rec.select("item_id", F.inline(parsed)).select("item_id", "doc", F.explode("m").alias("col", "values"))
            .select("item_id", "doc", "col", F.explode("values").alias("key", "v")))
    named = F.col("col") == "Models"
    return rows.select("item_id", "doc", "col", "key", F.when(named, F.col("v")).alias("label"),
                       F.when(~named, _r_off(F.col("v").cast("double"))).alias("value"))


def q_append_results(spark, sf):
    from ..session import scratch_path
    from ..sources import forecast_store
    rec = _record(spark, sf).cache()
    path = scratch_path(spark, "append")
    forecast_store.append_results(rec, path)
    forecast_store.append_results(rec, path)
    return _record_view(spark.read.parquet(path))


def q_upsert_forecast(spark, sf):
    from ..session import scratch_path
    from ..sources import forecast_store
    rec = _record(spark, sf).cache()
    path = scratch_path(spark, "upsert")
    forecast_store.upsert_forecast(spark, rec, path)
    forecast_store.upsert_forecast(spark, rec.withColumn("last_update", F.col("last_update") + F.expr("INTERVAL 1 SECOND")),
                                   path)
    return _record_view(forecast_store.read_forecasts(spark, path))


def _model_preds(fn):
    def q(spark, sf):
        p = fn(_split(spark, sf).filter(F.col("n") > F.lit(6)))
        return p.select("item_id", "model", "phase", F.col("t").cast("long").alias("t"), "ds", "yhat")
    return q


def _relative_preds(spark, sf, fn):
    """Predictions relative to the largest value of their series: regressions are compared to five digits."""
    split = _split(spark, sf)
    p = fn(split.filter(F.col("n") > F.lit(6)))
    top = split.groupBy("item_id").agg(F.max(F.abs("y")).alias("top"))
    return p.join(top, "item_id").select("item_id", "model", "phase", F.col("t").cast("long").alias("t"), "ds",
                                         F.round(F.col("yhat") / F.col("top"), 5).alias("yhat"))


def q_seasonal_ar(spark, sf):
    from ..operators.models import seasonal_ar
    return _relative_preds(spark, sf, seasonal_ar.seasonal_ar)


def q_trend_holiday(spark, sf):
    from ..operators.models import trend_holiday
    return _relative_preds(spark, sf, trend_holiday.trend_holiday)


def q_boosted_lags(spark, sf):
    from ..operators.models import boosted
    return _model_preds(boosted.boosted_lags)(spark, sf)


def q_cutoff_guard(spark, sf):
    """The month each forced month is replaced by, refused months, and the cells up to it."""
    cells = _cells(spark, sf)
    last = cells.agg(F.max("month_year")).first()[0]
    used = []
    for forced in FORCED_MONTHS:
        try:
            used.append((forced, W.validate_cutoff(forced, last), False))
        except ValueError:
            used.append((forced, None, True))
    asked = spark.createDataFrame(used, "forced string, used string, refused boolean")
    upto = [facts.cutoff_filter(cells, u).agg(F.count("*").alias("n_cells"), F.sum(F.col("y").cast("decimal(28,6)")).cast("double").alias("y"))
            .select(F.lit(f).alias("forced"), "n_cells", "y") for f, u, bad in used if not bad]
    found = upto[0]
    for part in upto[1:]:
        found = found.unionByName(part)
    return asked.join(found, asked.forced.eqNullSafe(found.forced), "left").select(asked.forced, "used", "refused", "n_cells", "y")


def q_record_three_models(spark, sf):
    """C5 with the models themselves: seasonal AR, trend and Holt-Winters compete for every item's record."""
    from . import forecast_job
    cells = _cells(spark, sf)
    rec = forecast_job.forecast_record(cells, _worklist(spark, sf, cells=cells), models="sarimax,prophet,hwexsmooth", with_json=False)
    return rec.select("debtorcode", "category", "projno", "last_trainmy", "mape_model", F.round("mape_min", 2).alias("mape_min"), "maape_model",
                      F.round("maape_min", 4).alias("maape_min"), F.round("rbaseline", 2).alias("rbaseline"), "pred_bt_base", "pred_trend",
                      F.round(F.col("mae_v") / F.col("test_mean"), 4).alias("mae_share"),
                      F.round(F.col("forecast_amt") / F.col("test_mean"), 4).alias("forecast_share"), "status")


def q_boosted_pooled(spark, sf):
    """The pooled booster at the size of its SQL twin: two rounds of depth-2 trees."""
    from ..operators.models import pooled
    return _relative_preds(spark, sf, lambda split: pooled.pooled_lags(split, rounds=POOLED_ROUNDS, depth=POOLED_DEPTH))


def q_forecast_all_models(spark, sf):
    """C5 flagship: every model, JSON documents included (rows-only check)."""
    return _record(spark, sf, with_json=True, registry=None).drop("last_update")


def q_record_statuses(spark, sf):
    """Records of a work list with items that have no level, no data, too few months, or no model; nulls stay null."""
    from . import forecast_job
    cells = _cells(spark, sf)
    odd = spark.createDataFrame(ODD_ITEMS, "row_idx long, debtorcode string, category string, projno string, month_year string")
    wl = _worklist(spark, sf, cells=cells).unionByName(odd)
    return _record_view(forecast_job.forecast_record(cells, wl, models="hwexsmooth", with_json=False))


def q_scan_warehouse(spark, sf):
    """The warehouse scan itself on parquet: per-table columns and options, decimals kept; rows and sums per table."""
    from ..sources.warehouse import scan_warehouse
    d = sf.rstrip("/")
    wh = scan_warehouse(spark, f"{d}/orders.parquet", f"{d}/lineitem.parquet", f"{d}/part.parquet", f"{d}/orders.parquet", fmt="parquet",
                        table_options={"lines": {"mergeSchema": "false"}},
                        columns={"headers": {"o_orderkey": "dockey", "o_orderdate": "docdate", "o_custkey": "debtorcode"},
                                 "lines": {"l_orderkey": "dockey", "l_partkey": "itemcode", "l_extendedprice": "amount", "l_returnflag": "projno"},
                                 "items": {"p_partkey": "itemcode", "p_type": "itemtype"},
                                 "channel2": {"o_custkey": "debtorcode", "o_orderdate": "docdate", "o_totalprice": "amount",
                                              "o_orderpriority": "category", "o_orderstatus": "invtype"}})
    lines = wh.lines.join(wh.headers, "dockey").join(wh.items, "itemcode")
    return (lines.groupBy("itemtype", F.date_format("docdate", "yyyy-MM").alias("month_year"))
            .agg(F.count("*").alias("n_lines"), facts.exact_sum(lines, "amount").cast("double").alias("y"))
            .unionByName(wh.channel2.groupBy(F.col("category").alias("itemtype"), F.date_format("docdate", "yyyy-MM").alias("month_year"))
                         .agg(F.count("*").alias("n_lines"), facts.exact_sum(wh.channel2, "amount").cast("double").alias("y"))))


QUERIES.update({
    "record_statuses": q_record_statuses,
    "scan_warehouse": q_scan_warehouse,
    "holt_winters_grid": q_holt_winters_grid,
    "model_subset": q_model_subset,
    "model_ok": q_model_ok,
    "model_scores_long": q_model_scores_long,
    "best_model": q_best_model,
    "future_forecasts": q_future_forecasts,
    "forecast_record": q_forecast_record,
    "json_pack": q_json_pack,
    "append_results": q_append_results,
    "upsert_forecast": q_upsert_forecast,
    "seasonal_ar": q_seasonal_ar,
    "trend_holiday": q_trend_holiday,
    "boosted_lags": q_boosted_lags,
    "boosted_pooled": q_boosted_pooled,
    "cutoff_guard": q_cutoff_guard,
    "record_three_models": q_record_three_models,
    "forecast_all_models": q_forecast_all_models,
})

ORACLES.update({
    "holt_winters_grid": HW + " SELECT item_id, model, phase, t, ds, round(yhat, 4) AS yhat FROM hw_pred",
    "model_subset": COMPETING + " SELECT item_id, model, phase, t, round(yhat + 1e-6, 4) AS yhat FROM clipped",
    "model_ok": COMPETING + " SELECT item_id, model, model_ok FROM mok",
    "model_scores_long": COMPETING + """ SELECT item_id, model, round(mae + 1e-6, 4) AS mae, round(mape, 4) AS mape, round(maape, 4) AS maape
        FROM mm UNION ALL SELECT item_id, model, round(mae + 1e-6, 4), round(mape, 4), round(maape, 4) FROM base_metrics""",
    "best_model": COMPETING + """ SELECT item_id, mape_model, round(mape_min, 4) AS mape_min, round(mae_v + 1e-6, 4) AS mae_v, maape_model,
        round(maape_min, 4) AS maape_min FROM best""",
    "future_forecasts": COMPETING + " SELECT item_id, model, t, ds, round(yhat + 1e-6, 4) AS yhat FROM clipped WHERE phase = 'future'",
    "forecast_record": COMPETING + " SELECT * FROM record",
    "append_results": COMPETING + " SELECT * FROM record UNION ALL SELECT * FROM record",
    "upsert_forecast": COMPETING + " SELECT * FROM record",
    "record_statuses": STATUSES + " SELECT * FROM record",
    "scan_warehouse": """ SELECT p_type AS itemtype, strftime(CAST(o_orderdate AS DATE), '%Y-%m') AS month_year, COUNT(*) AS n_lines,
        CAST(SUM(CAST(l_extendedprice AS DECIMAL(28,6))) AS DOUBLE) AS y
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
        UNION ALL
        SELECT o_orderpriority, strftime(CAST(o_orderdate AS DATE), '%Y-%m'), COUNT(*), CAST(SUM(CAST(o_totalprice AS DECIMAL(28,6))) AS DOUBLE)
        FROM orders GROUP BY 1, 2""",
    "json_pack": COMPETING + """,
names(i, model) AS (VALUES ('0', 'SARIMAX'), ('1', 'Prophet'), ('2', 'XGBoost'), ('3', 'HWExSmooth')),
scored AS (
  SELECT i.item_id, 'metrics_df' AS doc, n.i AS key, n.model, m.mape, m.mae, m.maape
  FROM (SELECT DISTINCT item_id FROM mm) i CROSS JOIN names n LEFT JOIN mm m ON m.item_id = i.item_id AND m.model = n.model
  UNION ALL SELECT item_id, 'baseline_df', '0', 'Baseline', mape, mae, maape FROM base_metrics),
timed AS (
  SELECT item_id, 'train_df' AS doc, 'y' AS col, CAST(month_year || '-01' AS DATE) AS ds, y AS v FROM raw
  UNION ALL SELECT item_id, 'validation_df', 'y', ds, y FROM split WHERE is_test
  UNION ALL SELECT item_id, CASE WHEN phase = 'test' THEN 'validation_df' ELSE 'forecast_df' END, model, ds, yhat FROM clipped)
SELECT item_id, doc, 'Models' AS col, key, model AS label, CAST(NULL AS DOUBLE) AS value FROM scored
UNION ALL SELECT item_id, doc, 'MAPE_Errors', key, NULL, round(mape + 1e-6, 4) FROM scored
UNION ALL SELECT item_id, doc, 'MAE_Errors', key, NULL, round(mae + 1e-6, 4) FROM scored
UNION ALL SELECT item_id, doc, 'MAAPE_Errors', key, NULL, round(maape + 1e-6, 4) FROM scored
UNION ALL SELECT item_id, doc, col, CAST(date_diff('day', DATE '1970-01-01', ds) * 86400000 AS VARCHAR), NULL, round(v + 1e-6, 4) FROM timed""",
})


def q_worklist_stream_forecast(spark, sf):
    """Both work-list halves as stream files -> forecast per micro-batch -> store."""
    from ..session import scratch_path
    from ..sources import forecast_store, worklist_io
    from ..streaming.worklist_stream import start_forecast_stream
    cells = _cells(spark, sf)
    wl_dir = scratch_path(spark, "stream-worklist")
    worklist_io.write_worklist_csv(W.split_sequential(_worklist(spark, sf, cells=cells)), wl_dir)
    store = scratch_path(spark, "stream-store")
    q = start_forecast_stream(spark, wl_dir, lambda: cells, store, registry=_competing())
    q.awaitTermination()
    return _record_view(forecast_store.read_forecasts(spark, store))


QUERIES["worklist_stream_forecast"] = q_worklist_stream_forecast
ORACLES["worklist_stream_forecast"] = COMPETING + " SELECT * FROM record"


def q_seasonal_ar_lag1(spark, sf):
    from ..operators.models import seasonal_ar
    r = seasonal_ar.lag_regression(_split(spark, sf))
    return r.select("item_id", F.round("intercept", 4).alias("intercept"), F.round("slope", 6).alias("slope"), "n_obs")


def q_trend_line(spark, sf):
    from ..operators.models import trend_holiday
    r = trend_holiday.trend_line(_split(spark, sf))
    return r.select("item_id", F.round("intercept", 6).alias("intercept"), F.round("slope", 6).alias("slope"), "n_obs")


QUERIES["seasonal_ar_lag1"] = q_seasonal_ar_lag1
QUERIES["trend_line"] = q_trend_line
ORACLES["seasonal_ar_lag1"] = SER + """ SELECT item_id, round(regr_intercept(y, x), 4) AS intercept,
    round(regr_slope(y, x), 6) AS slope, CAST(COUNT(*) AS BIGINT) AS n_obs
    FROM (SELECT item_id, y, LAG(y, 1) OVER w AS x, LAG(y, 12) OVER w AS x12
          FROM split WINDOW w AS (PARTITION BY item_id ORDER BY t))
    WHERE x IS NOT NULL AND x12 IS NOT NULL GROUP BY item_id HAVING COUNT(*) > 2"""
ORACLES["trend_line"] = SER + """ SELECT item_id, round(regr_intercept(ys, tau), 6) AS intercept,
    round(regr_slope(ys, tau), 6) AS slope, CAST(COUNT(*) AS BIGINT) AS n_obs
    FROM (SELECT item_id, y / MAX(abs(y)) OVER (PARTITION BY item_id) AS ys,
                 (t - MIN(t) OVER (PARTITION BY item_id))
                   / CAST(MAX(t) OVER (PARTITION BY item_id) - MIN(t) OVER (PARTITION BY item_id) AS DOUBLE) AS tau
          FROM split)
    GROUP BY item_id"""


# ---------------------------------------------------------------------------
# Regression models in SQL: Gram sums, Gaussian elimination written out per step, recursive forecasts.

def _eliminate(name: str, source: str, keys: str, k: int) -> str:
    """CTEs that solve the k x k system a0_0..a{k-1}_{k-1}, b0..b{k-1} of each row of ``source``: x0..x{k-1} in ``name``."""
    out, prev = [], source
    for p in range(k - 1):
        rest = ", ".join([f"a{i}_{j} - a{i}_{p} / a{p}_{p} * a{p}_{j} AS a{i}_{j}" for i in range(p + 1, k) for j in range(p + 1, k)]
                         + [f"b{i} - a{i}_{p} / a{p}_{p} * b{p} AS b{i}" for i in range(p + 1, k)])
        keep = ", ".join([f"a{i}_{j}" for i in range(p + 1) for j in range(i, k)] + [f"b{i}" for i in range(p + 1)])
        out.append(f"{name}_{p} AS (SELECT {keys}, {keep}, {rest} FROM {prev})")
        prev = f"{name}_{p}"
    for i in range(k - 1, -1, -1):
        known = "".join(f" - a{i}_{j} * x{j}" for j in range(i + 1, k))
        out.append(f"{name}_x{i} AS (SELECT *, (b{i}{known}) / a{i}_{i} AS x{i} FROM {prev})")
        prev = f"{name}_x{i}"
    return ",\n".join(out) + f",\n{name} AS (SELECT * FROM {prev})"


def _trend_sql() -> str:
    from ..operators.models import trend_holiday as m
    f = ["1.0", "tau", *[f"greatest(0.0, tau - {c!r})" for c in m.CHANGEPOINTS]]
    k = len(f)
    ridge = [0.0, 0.0] + [1.0 / m.CHANGEPOINT_PRIOR_SCALE ** 2] * len(m.CHANGEPOINTS)
    grams = ", ".join([f"SUM(({f[i]}) * ({f[j]})){f' + {ridge[i]!r}' if i == j and ridge[i] else ''} AS a{i}_{j}" for i in range(k) for j in range(k)]
                      + [f"SUM(({f[i]}) * ys) AS b{i}" for i in range(k)])
    trend = " + ".join(f"x{i} * ({f[i]})" for i in range(k))
    days = " OR ".join(f"(month(ds) = {mo} AND {d} = 1)" for mo, d, _ in m.MONTH_START_HOLIDAYS)
    event = f"CASE WHEN {days} THEN month(ds) END"
    return f""",
th_rows AS (
  SELECT item_id, phase, t, y, MIN(t) OVER w AS t0, MAX(t) OVER w AS t1, MAX(abs(y)) OVER w AS scale, COUNT(*) OVER w AS n_fit
  FROM (SELECT item_id, 'test' AS phase, t, y FROM split WHERE NOT is_test AND n > 6
        UNION ALL SELECT item_id, 'future', t, y FROM split WHERE n > 6)
  WINDOW w AS (PARTITION BY item_id, phase)),
th AS (
  SELECT item_id, phase, t, t0, t1, scale, (t - t0) / CAST(t1 - t0 AS DOUBLE) AS tau, y / scale AS ys FROM th_rows WHERE n_fit >= 8 AND scale > 0),
th_gram AS (SELECT item_id, phase, {grams} FROM th GROUP BY item_id, phase),
{_eliminate("th_sol", "th_gram", "item_id, phase", k)},
th_fit AS (
  SELECT h.item_id, h.phase, ys, {trend} AS fit, make_date(CAST(floor((t - 1) / 12) AS BIGINT), CAST(t - floor((t - 1) / 12) * 12 AS BIGINT), 1) AS ds
  FROM th h JOIN th_sol s ON h.item_id = s.item_id AND h.phase = s.phase),
th_hol AS (
  SELECT item_id, phase, {event} AS event, SUM((ys - fit) * fit) / (SUM(fit * fit) + {1.0 / m.HOLIDAYS_PRIOR_SCALE ** 2!r}) AS effect
  FROM th_fit WHERE {event} IS NOT NULL GROUP BY item_id, phase, event),
th_meta AS (SELECT DISTINCT item_id, phase, t0, t1, scale FROM th),
th_tgt AS (
  SELECT *, (t - t0) / CAST(t1 - t0 AS DOUBLE) AS tau,
         make_date(CAST(floor((t - 1) / 12) AS BIGINT), CAST(t - floor((t - 1) / 12) * 12 AS BIGINT), 1) AS ds
  FROM (SELECT *, t1 + UNNEST(range(1, CASE WHEN phase = 'test' THEN 7 ELSE 4 END)) AS t FROM th_meta)),
th_pred AS (
  SELECT g.item_id, 'Prophet' AS model, g.phase, g.t, g.ds, g.scale * ({trend}) * (1.0 + coalesce(h.effect, 0.0)) AS yhat
  FROM th_tgt g JOIN th_sol s ON g.item_id = s.item_id AND g.phase = s.phase
  LEFT JOIN th_hol h ON h.item_id = g.item_id AND h.phase = g.phase AND h.event = {event.replace('ds', 'g.ds')})"""


def _relative_sql(preds: str) -> str:
    return f""" SELECT p.item_id, p.model, p.phase, p.t, p.ds, round(p.yhat / m.top, 5) AS yhat
        FROM {preds} p JOIN (SELECT item_id, MAX(abs(y)) AS top FROM split GROUP BY item_id) m ON p.item_id = m.item_id"""


ORACLES["trend_holiday"] = SER + _trend_sql() + _relative_sql("th_pred")


def _seasonal_sql() -> str:
    from ..operators.models import seasonal_ar as m
    z = {(0, 0): "y", (1, 0): "y - y1", (0, 1): "y - y12", (1, 1): "y - y1 - y12 + y13"}
    variances = ", ".join(f"coalesce(var_samp({e}) OVER v, 'inf'::DOUBLE) AS v{i}" for i, e in enumerate(z.values()))
    # the first of the smallest variances, in the order of z
    chosen = "CASE " + " ".join(f"WHEN {' AND '.join(f'v{i} <= v{j}' for j in range(4) if j != i)} THEN {i}" for i in range(4)) + " END"
    znow = "CASE o " + " ".join(f"WHEN {i} THEN {e}" for i, e in enumerate(z.values())) + " END"
    # the long autoregression of the month before (units scaled away), its residual e1 row by row, then the Gram sums with it
    g_long = ["1.0", "z2", "z3", "z4", "z13"]
    n_long = len(g_long)
    long_sums = ", ".join([f"SUM({g_long[i]} * {g_long[j]}) AS g{i}_{j}" for i in range(n_long) for j in range(i, n_long)]
                          + [f"SUM({g_long[i]} * z1) AS h{i}" for i in range(n_long)])
    long_in = ", ".join([f"g{min(i, j)}_{max(i, j)} / sqrt(g{i}_{i} * g{j}_{j}) AS a{i}_{j}" for i in range(n_long) for j in range(n_long)]
                        + [f"h{i} / sqrt(g{i}_{i}) AS b{i}" for i in range(n_long)])
    long_beta = ", ".join(f"s.x{i} / sqrt(g.g{i}_{i}) AS l{i}" for i in range(n_long))
    some = " AND ".join(f"g{i}_{i} > 0" for i in range(n_long))
    f = ["1.0", "z1", "z2", "z12", "e1"]
    grams = ", ".join([f"SUM({f[i]} * {f[j]}) AS g{i}_{j}" for i in range(5) for j in range(i, 5)] + [f"SUM({f[i]} * z) AS h{i}" for i in range(5)])
    sets, union = [], []
    for c, cols in enumerate(m.CANDIDATES):
        k = len(cols)
        g = lambda i, j: f"g{min(i, j)}_{max(i, j)}"
        scaled = ", ".join([f"{g(cols[i], cols[j])} / sqrt({g(cols[i], cols[i])} * {g(cols[j], cols[j])}) AS a{i}_{j}" for i in range(k) for j in range(k)]
                           + [f"h{cols[i]} / sqrt({g(cols[i], cols[i])}) AS b{i}" for i in range(k)])
        sets.append(f"sa_in{c} AS (SELECT item_id, phase, {scaled} FROM sa_gram WHERE n_obs > {k}{f' AND g4_4 > {m.LEAST_RESIDUAL!r} * g1_1' if 4 in cols else ''})")
        sets.append(_eliminate(f"sa_sol{c}", f"sa_in{c}", "item_id, phase", k))
        beta = [f"s.x{cols.index(i)} / sqrt({g(i, i)})" if i in cols else "0.0" for i in range(5)]
        sets.append(f"sa_b{c} AS (SELECT r.*, {', '.join(f'{b} AS w{i}' for i, b in enumerate(beta))} FROM sa_gram r "
                    f"JOIN sa_sol{c} s ON r.item_id = s.item_id AND r.phase = s.phase)")
        quad = " + ".join(f"w{i} * w{j} * {g(i, j)}" for i in cols for j in cols)
        rss = f"greatest(yy - 2 * ({' + '.join(f'w{i} * h{i}' for i in cols)}) + ({quad}), 1e-300)"
        union.append(f"SELECT item_id, phase, {c} AS c, n_obs * ln({rss} / n_obs) + {2 * k} AS aic, w0, w1, w2, w3, w4 FROM sa_b{c}")
    at = lambda j: f"coalesce(hist[len(hist) - {j - 1}], 0.0)"
    back = lambda j: f"({at(j)} - d1 * {at(j + 1)} - d12 * {at(j + 12)} + d1 * d12 * {at(j + 13)})"
    last = f"({back(1)} - (l0 + l1 * {back(2)} + l2 * {back(3)} + l3 * {back(4)} + l4 * {back(13)}))"
    ahead = (f"CASE WHEN h = 0 AND w4 <> 0 THEN w4 * {last} ELSE 0.0 END + w0 + w1 * {back(1)} + w2 * {back(2)} + w3 * {back(12)} + d1 * {at(1)} + d12 * {at(12)} - d1 * d12 * {at(13)}")
    return f""",
sa_rows AS (
  SELECT item_id, 'test' AS phase, t, y FROM split WHERE NOT is_test AND n > 6 UNION ALL SELECT item_id, 'future', t, y FROM split WHERE n > 6),
sa_lag AS (
  SELECT *, LAG(y, 1) OVER w AS y1, LAG(y, 12) OVER w AS y12, LAG(y, 13) OVER w AS y13 FROM sa_rows WINDOW w AS (PARTITION BY item_id, phase ORDER BY t)),
sa_var AS (SELECT *, {variances} FROM sa_lag WINDOW v AS (PARTITION BY item_id, phase)),
sa_z AS (SELECT item_id, phase, t, y, o, {znow} AS z FROM (SELECT *, {chosen} AS o FROM sa_var)),
sa_zl AS (
  SELECT *, LAG(z, 1) OVER w AS z1, LAG(z, 2) OVER w AS z2, LAG(z, 12) OVER w AS z12,
         LAG(z, 3) OVER w AS z3, LAG(z, 4) OVER w AS z4, LAG(z, 13) OVER w AS z13 FROM sa_z WINDOW w AS (PARTITION BY item_id, phase ORDER BY t)),
sa_meta AS (
  SELECT item_id, phase, MAX(o) AS o, MAX(t) AS t_last, COUNT(*) AS n_fit, list(y ORDER BY t) AS ys FROM sa_zl GROUP BY item_id, phase
  HAVING COUNT(*) >= {m.MIN_TRAIN}),
sa_common AS (
  SELECT * FROM sa_zl WHERE z IS NOT NULL AND z1 IS NOT NULL AND z2 IS NOT NULL AND z12 IS NOT NULL AND z3 IS NOT NULL AND z4 IS NOT NULL
  AND z13 IS NOT NULL),
sa_lgram AS (SELECT item_id, phase, COUNT(*) AS n_obs, {long_sums} FROM sa_common GROUP BY item_id, phase),
sa_lin AS (SELECT item_id, phase, {long_in} FROM sa_lgram WHERE n_obs >= {m.MIN_LONG} AND {some}),
{_eliminate("sa_lsol", "sa_lin", "item_id, phase", n_long)},
sa_long AS (
  SELECT * FROM (SELECT g.item_id, g.phase, {long_beta} FROM sa_lgram g JOIN sa_lsol s ON g.item_id = s.item_id AND g.phase = s.phase)
  WHERE isfinite(l0 + l1 + l2 + l3 + l4)),
sa_e AS (
  SELECT c.*, coalesce(c.z1 - (l0 + l1 * c.z2 + l2 * c.z3 + l3 * c.z4 + l4 * c.z13), 0.0) AS e1
  FROM sa_common c LEFT JOIN sa_long l ON c.item_id = l.item_id AND c.phase = l.phase),
sa_gram AS (SELECT item_id, phase, COUNT(*) AS n_obs, SUM(z * z) AS yy, {grams} FROM sa_e GROUP BY item_id, phase),
{", ".join(sets)},
sa_best AS (
  SELECT item_id, phase, arg_min(struct_pack(w0 := w0, w1 := w1, w2 := w2, w3 := w3, w4 := w4), struct_pack(a := aic, b := c)) AS w
  FROM ({" UNION ALL ".join(union)}) WHERE NOT isnan(aic) GROUP BY item_id, phase),
sa_rec AS (
  SELECT b.item_id, b.phase, e.t_last, 0 AS h, e.ys[-{m.HISTORY}:] AS hist, b.w.w0 AS w0, b.w.w1 AS w1, b.w.w2 AS w2, b.w.w3 AS w3,
         b.w.w4 AS w4, coalesce(l.l0, 0.0) AS l0, coalesce(l.l1, 0.0) AS l1, coalesce(l.l2, 0.0) AS l2, coalesce(l.l3, 0.0) AS l3, coalesce(l.l4, 0.0) AS l4,
         CAST(CASE WHEN e.o IN (1, 3) THEN 1 ELSE 0 END AS DOUBLE) AS d1, CAST(CASE WHEN e.o IN (2, 3) THEN 1 ELSE 0 END AS DOUBLE) AS d12
  FROM sa_best b JOIN sa_meta e ON b.item_id = e.item_id AND b.phase = e.phase
  LEFT JOIN sa_long l ON l.item_id = b.item_id AND l.phase = b.phase
  UNION ALL
  SELECT item_id, phase, t_last, h + 1, list_append(hist, {ahead}), w0, w1, w2, w3, w4, l0, l1, l2, l3, l4, d1, d12 FROM sa_rec
  WHERE h < CASE WHEN phase = 'test' THEN 6 ELSE 3 END),
sa_pred AS (
  SELECT item_id, 'SARIMAX' AS model, phase, t_last + h AS t,
         make_date(CAST(floor((t_last + h - 1) / 12) AS BIGINT), CAST(t_last + h - floor((t_last + h - 1) / 12) * 12 AS BIGINT), 1) AS ds,
         hist[len(hist)] AS yhat
  FROM sa_rec WHERE h > 0)"""


ORACLES["seasonal_ar"] = SER.replace("WITH ", "WITH RECURSIVE ", 1) + _seasonal_sql() + _relative_sql("sa_pred")


def _pooled_sql(rounds: int, depth: int) -> str:
    """The pooled booster: exact residual sums per (origin, node, lag, bin), cuts by gain, leaves by shrunken means."""
    from ..operators.models import pooled as m
    bin_of = f"least({m.CELLS - 1}, greatest(0, {{v}} // {m.CELL}))"
    out = [f"""pb_v AS MATERIALIZED (
  SELECT s.item_id, s.t, s.pos, s.is_test, m.scale, CAST(floor(s.y / m.scale * {m.UNIT}.0 + 0.5) AS BIGINT) AS v
  FROM split s JOIN (SELECT item_id, AVG(y ORDER BY t) AS scale FROM split WHERE NOT is_test GROUP BY item_id) m ON s.item_id = m.item_id
  WHERE s.n > 6 AND m.scale > 0),
pb_count AS (SELECT {bin_of.format(v="v")} AS cell, COUNT(*) AS c FROM pb_v WHERE NOT is_test GROUP BY 1),
pb_bin AS MATERIALIZED (
  SELECT r.cell, CAST(least({m.BINS - 1}, (SUM(coalesce(c, 0)) OVER (ORDER BY r.cell) - coalesce(c, 0)) * {m.BINS}
                                       // (SELECT SUM(c) FROM pb_count)) AS BIGINT) AS bin
  FROM range(0, {m.CELLS}) r(cell) LEFT JOIN pb_count k ON k.cell = r.cell),
pb_x AS MATERIALIZED (
  SELECT item_id, t, v, is_test, scale, bs FROM (
    SELECT v.*, [{", ".join(f"LAG(bin, {k}) OVER w" for k in range(1, 7))}] AS bs
    FROM pb_v v JOIN pb_bin b ON b.cell = {bin_of.format(v="v.v")} WINDOW w AS (PARTITION BY item_id ORDER BY t)) WHERE pos >= 6),
pb_base AS MATERIALIZED (
  SELECT o, CAST(floor(SUM(v) / COUNT(*) + 0.5) AS BIGINT) AS f
  FROM (SELECT DISTINCT t AS o FROM pb_x WHERE is_test UNION ALL SELECT {m.FUTURE}) JOIN pb_x ON t < o GROUP BY o),
pb_s0 AS MATERIALIZED (SELECT x.*, o, f FROM pb_x x, pb_base)"""]
    for r in range(rounds):
        rows = f"(SELECT *, 0 AS node FROM pb_s{r})"
        for k in range(depth):
            name = f"pb_{r}_{k}"
            out.append(f"""{name}c AS (
  SELECT *, SUM(g) OVER w AS gl, SUM(n) OVER w AS nl, SUM(g) OVER a AS gt, SUM(n) OVER a AS nt
  FROM (SELECT o, node, lag, bin, SUM(v - f) AS g, COUNT(*) AS n
        FROM (SELECT o, node, v, f, UNNEST(range(1, 7)) AS lag, UNNEST(bs) AS bin FROM {rows} WHERE t < o) GROUP BY o, node, lag, bin)
  WINDOW w AS (PARTITION BY o, node, lag ORDER BY bin), a AS (PARTITION BY o, node, lag)),
{name}b AS MATERIALIZED (
  SELECT o, node, arg_min(struct_pack(lag := lag, bin := bin), struct_pack(a := -gain, l := lag, b := bin)) AS cut
  FROM (SELECT *, CAST(gl AS DOUBLE) * CAST(gl AS DOUBLE) / (nl + {m.LAMBDA}) + CAST(gt - gl AS DOUBLE) * CAST(gt - gl AS DOUBLE) / (nt - nl + {m.LAMBDA}) AS gain,
               CAST(gt AS DOUBLE) * CAST(gt AS DOUBLE) / (nt + {m.LAMBDA}) AS whole FROM {name}c)
  WHERE nl < nt AND gain > whole GROUP BY o, node),
{name}n AS MATERIALIZED (
  SELECT n.* REPLACE (2 * n.node + CASE WHEN n.bs[b.cut.lag] > b.cut.bin THEN 1 ELSE 0 END AS node)
  FROM {rows} n LEFT JOIN {name}b b ON n.o = b.o AND n.node = b.node)""")
            rows = f"{name}n"
        out.append(f"""pb_{r}v AS MATERIALIZED (
  SELECT o, node, CAST(floor({m.RATE} * CAST(SUM(v - f) AS DOUBLE) / (COUNT(*) + {m.LAMBDA}) + 0.5) AS BIGINT) AS add FROM {rows} WHERE t < o GROUP BY o, node),
pb_s{r + 1} AS MATERIALIZED (
  SELECT n.* EXCLUDE (node) REPLACE (n.f + coalesce(l.add, 0) AS f) FROM {rows} n LEFT JOIN pb_{r}v l ON n.o = l.o AND n.node = l.node)""")
    last = ", ".join(f"arg_max(bin, t, 6)[{k}]" for k in range(1, 7))
    out.append(f"""pb_a0 AS (
  SELECT item_id, MAX(t) AS t, scale, 0 AS v, [{last}] AS bs
  FROM pb_v v JOIN pb_bin b ON b.cell = {bin_of.format(v="v.v")} GROUP BY item_id, scale)""")
    for h in range(3):
        rows = f"(SELECT a.item_id, a.t, a.scale, a.bs, p.f FROM pb_a{h} a, pb_base p WHERE p.o = {m.FUTURE})"
        for r in range(rounds):
            node = f"(SELECT *, 0 AS node FROM {rows})"
            for k in range(depth):
                node = (f"(SELECT n.* REPLACE (2 * n.node + CASE WHEN n.bs[b.cut.lag] > b.cut.bin THEN 1 ELSE 0 END AS node) FROM {node} n "
                        f"LEFT JOIN (SELECT * FROM pb_{r}_{k}b WHERE o = {m.FUTURE}) b ON n.node = b.node)")
            rows = (f"(SELECT n.* EXCLUDE (node) REPLACE (n.f + coalesce(l.add, 0) AS f) FROM {node} n "
                    f"LEFT JOIN (SELECT * FROM pb_{r}v WHERE o = {m.FUTURE}) l ON n.node = l.node)")
        out.append(f"""pb_a{h + 1} AS MATERIALIZED (
  SELECT item_id, t + 1 AS t, scale, f AS v, list_prepend(bin, bs[1:5]) AS bs FROM {rows} x JOIN pb_bin b ON b.cell = {bin_of.format(v="x.f")})""")
    out.append(f"""pb_pred AS (
  SELECT item_id, 'XGBoost' AS model, phase, t, make_date(CAST(floor((t - 1) / 12) AS BIGINT), CAST(t - floor((t - 1) / 12) * 12 AS BIGINT), 1) AS ds, yhat
  FROM (SELECT item_id, 'test' AS phase, t, f / {m.UNIT}.0 * scale AS yhat FROM pb_s{rounds} WHERE is_test AND t = o
        UNION ALL {" UNION ALL ".join(f"SELECT item_id, 'future', t, v / {m.UNIT}.0 * scale FROM pb_a{h}" for h in (1, 2, 3))}))""")
    return ",\n" + ",\n".join(out)


ORACLES["boosted_pooled"] = SER + _pooled_sql(POOLED_ROUNDS, POOLED_DEPTH) + _relative_sql("pb_pred")
ORACLES["cutoff_guard"] = BASE_CTE + """, last AS (SELECT MAX(month_year) AS m FROM cells),
forced(forced) AS (VALUES """ + ", ".join("(CAST(NULL AS VARCHAR))" if f is None else f"('{f}')" for f in FORCED_MONTHS) + """),
guarded AS (SELECT forced, CASE WHEN coalesce(forced, '') = '' THEN m WHEN forced <= m THEN forced END AS used FROM forced, last)
SELECT g.forced, g.used, g.used IS NULL AS refused, CASE WHEN g.used IS NOT NULL THEN COUNT(c.month_year) END AS n_cells,
       CAST(SUM(CAST(c.y AS DECIMAL(28,6))) AS DOUBLE) AS y
FROM guarded g LEFT JOIN cells c ON c.month_year <= g.used GROUP BY g.forced, g.used"""
THREE_MODELS = HW.replace("all_pred AS (", (_trend_sql() + _seasonal_sql()).lstrip(",\n") + """,
all_pred AS (SELECT * FROM sa_pred UNION ALL SELECT * FROM th_pred UNION ALL """, 1)
ORACLES["record_three_models"] = THREE_MODELS + """ SELECT debtorcode, category, projno, last_trainmy, mape_model, round(mape_min, 2) AS mape_min,
       maape_model, round(maape_min, 4) AS maape_min, round(rbaseline, 2) AS rbaseline,
       CASE WHEN rmape > rbaseline THEN 'BETTER' WHEN rmape < rbaseline THEN 'WORST' WHEN rmape = rbaseline THEN 'EQUAL' END AS pred_bt_base,
       CASE WHEN forecast_amt >= tmonth_amt + tmonth_amt * 0.1 THEN 'UP' WHEN forecast_amt <= tmonth_amt - tmonth_amt * 0.1 THEN 'DW'
            WHEN forecast_amt IS NOT NULL AND tmonth_amt IS NOT NULL THEN 'NC' END AS pred_trend,
       round(mae_v / test_mean, 4) AS mae_share, round(forecast_amt / test_mean, 4) AS forecast_share,
       CASE WHEN lvl IS NULL THEN 'bad_item' WHEN n IS NULL THEN 'no_data' WHEN n <= 6 THEN 'too_short' WHEN mape_model IS NULL THEN 'no_model' ELSE 'ok' END
         AS status FROM rec2"""
