"""Fixed schemas of the canonical tables and outputs (names, never positions)."""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical warehouse tables (lower-case names; the scan layer renames).
HEADERS = T.StructType([
    T.StructField("dockey", T.LongType()),
    T.StructField("docdate", T.DateType()),
    T.StructField("debtorcode", T.StringType()),
])
LINES = T.StructType([
    T.StructField("dockey", T.LongType()),
    T.StructField("itemcode", T.LongType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("projno", T.StringType()),
])
ITEMS = T.StructType([
    T.StructField("itemcode", T.LongType()),
    T.StructField("itemtype", T.StringType()),
])
CHANNEL2 = T.StructType([
    T.StructField("debtorcode", T.StringType()),
    T.StructField("docdate", T.DateType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("category", T.StringType()),
    T.StructField("invtype", T.StringType()),
])

# Sales fact, line level.
SALES_FACT = T.StructType([
    T.StructField("debtorcode", T.StringType()),
    T.StructField("docdate", T.DateType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("category", T.StringType()),
    T.StructField("projno", T.StringType()),
    T.StructField("month_year", T.StringType()),
])

# Cell: one row per customer x category x channel x month.
CELL = T.StructType([
    T.StructField("debtorcode", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("projno", T.StringType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("month_year", T.StringType()),
])

# Work list (row_idx is the unnamed index column of the CSV files).
WORKLIST = T.StructType([
    T.StructField("row_idx", T.LongType()),
    T.StructField("debtorcode", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("projno", T.StringType()),
    T.StructField("month_year", T.StringType()),
])

# Keyed summary record of one forecast run (key: first four columns).
FORECAST_KEY = ["debtorcode", "category", "projno", "last_trainmy"]
FORECAST_RECORD = T.StructType([
    T.StructField("debtorcode", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("projno", T.StringType()),
    T.StructField("last_trainmy", T.StringType()),
    T.StructField("mape_model", T.StringType()),
    T.StructField("mape_min", T.DoubleType()),
    T.StructField("rmape", T.DoubleType()),
    T.StructField("rbaseline", T.DoubleType()),
    T.StructField("maape_model", T.StringType()),
    T.StructField("maape_min", T.DoubleType()),
    T.StructField("test_mean", T.DoubleType()),
    T.StructField("metrics_df", T.StringType()),
    T.StructField("train_df", T.StringType()),
    T.StructField("validation_df", T.StringType()),
    T.StructField("forecast_df", T.StringType()),
    T.StructField("baseline_df", T.StringType()),
    T.StructField("pred_bt_base", T.StringType()),
    T.StructField("pred_bt_base_p", T.DoubleType()),
    T.StructField("pred_trend", T.StringType()),
    T.StructField("mae_v", T.DoubleType()),
    T.StructField("pred_trend_p", T.DoubleType()),
    T.StructField("tmonth_amt", T.DoubleType()),
    T.StructField("forecast_amt", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("last_update", T.TimestampType()),
])
