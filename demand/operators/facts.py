"""Sales facts: two channels joined, unioned, limited to active customers.

Plan shape (what Catalyst makes of it):

* joined channel = lines JOIN headers ON dockey JOIN items ON itemcode,
  with ``itemcode IS NOT NULL``, ``amount > 0`` and ``projno IS NULL``
  pushed into the line scan, and the date predicate pushed into the header
  scan. Join strategy is left to the planner: sort-merge for the fact-size
  line/header join, broadcast for the item master only when its measured
  size is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks the
  real size at runtime).
* second channel = denormalised invoices with ``invtype = 'Normal'``.
* activity = customers with a valid line in the recent window (no upper
  bound), used as a LEFT SEMI join: activity in either channel keeps the
  customer in both. ``sales_fact`` (line level) computes it from the two
  branches over the window only (the date predicate prunes row groups); lines
  of customers with a large share of all invoices meet it under salted keys.
* cells = GROUP BY month, customer, category, channel with partial
  (map-side) aggregation, so a hot customer or category never reaches one
  reducer as raw lines. Sums run in DECIMAL so they are exact and
  independent of partitioning: amounts keep the source's own decimal type (or, from
  floating-point sources, ``AMOUNT_SCALE`` digits) until they are summed, and the sum is
  cast to DOUBLE last. ``cells``
  joins the lines once: all months are summed, checkpointed, and both the
  activity set and the closed months are read from the (much smaller) cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.constants import (ACTIVE_LOOKBACK_MONTHS, AMOUNT_SCALE, CHANNEL_DENORM, CHANNEL_JOINED,
                                   NORMAL_INVOICE)
from ..sources.warehouse import Warehouse

#: A customer with more than this part of all invoices is hot: its lines are salted in the line-level semi-join.
HOT_PARTS = 200


def filter_valid_lines(lines: DataFrame) -> DataFrame:
    """Item present, positive amount, no project code."""
    return lines.filter(F.col("itemcode").isNotNull() & (F.col("amount") > 0) & F.col("projno").isNull())


def filter_normal_invoices(channel2: DataFrame) -> DataFrame:
    """P5: keep normal invoices of the denormalised channel."""
    return channel2.filter(F.col("invtype") == F.lit(NORMAL_INVOICE))


def closed_month_start(as_of) -> Column:
    """First day of the run month: everything before it is closed."""
    return dates.month_start(dates.as_date(as_of))


def recent_window_start(as_of, lookback: int = ACTIVE_LOOKBACK_MONTHS) -> Column:
    """Month start ``lookback`` months before the run date (F4); no upper bound."""
    return dates.months_back(dates.as_date(as_of), lookback)


def join_lines_headers_items(wh: Warehouse, date_pred: Column | None = None) -> DataFrame:
    """J1, J2 over valid lines; ``date_pred`` is applied to the header date."""
    lines = filter_valid_lines(wh.lines).select("dockey", "itemcode", "amount")
    headers = wh.headers if date_pred is None else wh.headers.filter(date_pred)
    return (lines.join(headers, "dockey")
            .join(wh.items, "itemcode")
            .select("dockey", "itemcode", "debtorcode", "docdate", "amount", F.col("itemtype").alias("category")))


def joined_channel(wh: Warehouse, date_pred: Column | None = None) -> DataFrame:
    """First channel in fact layout (F5: the channel is a constant)."""
    j = join_lines_headers_items(wh, date_pred)
    return j.select("debtorcode", "docdate", "amount", "category", F.lit(CHANNEL_JOINED).alias("projno"))


def denorm_channel(wh: Warehouse, date_pred: Column | None = None) -> DataFrame:
    """Second channel in fact layout (no amount filter on this branch)."""
    c = filter_normal_invoices(wh.channel2)
    if date_pred is not None:
        c = c.filter(date_pred)
    return c.select("debtorcode", "docdate", "amount", "category", F.lit(CHANNEL_DENORM).alias("projno"))


def union_channels(wh: Warehouse, date_pred: Column | None = None) -> DataFrame:
    """UNION ALL of both channels (by name)."""
    return joined_channel(wh, date_pred).unionByName(denorm_channel(wh, date_pred))


def active_customers(wh: Warehouse, as_of=None, lookback: int = ACTIVE_LOOKBACK_MONTHS) -> DataFrame:
    """Distinct customers with a valid line in the recent window."""
    start = recent_window_start(as_of, lookback)
    pred = F.col("docdate") >= start
    recent = (join_lines_headers_items(wh, pred).select("debtorcode")
              .unionByName(filter_normal_invoices(wh.channel2).filter(pred).select("debtorcode")))
    return recent.distinct()


def hot_customers(wh: Warehouse) -> list[str]:
    """Customers with over 1/``HOT_PARTS`` of all invoices: at most ``HOT_PARTS`` of them, whatever the data.

    Counted on the invoice headers of both channels (map-side combined), not on the lines."""
    invoices = wh.headers.select("debtorcode").unionByName(filter_normal_invoices(wh.channel2).select("debtorcode"))
    total = invoices.count()
    counts = invoices.groupBy("debtorcode").count().filter(F.col("debtorcode").isNotNull() & (F.col("count") * HOT_PARTS > total))
    return sorted(r["debtorcode"] for r in counts.collect())


def keep_active(lines: DataFrame, active: DataFrame, hot: list[str], salts: int = 32) -> DataFrame:
    """J3 at line level: LEFT SEMI on the customer, with the lines of ``hot`` customers dealt to ``salts`` keys.

    ``active`` grows by at most ``salts`` rows per hot customer; every other customer keeps one key."""
    if not hot:
        return lines.join(active, "debtorcode", "left_semi")
    is_hot = F.col("debtorcode").isin(hot)
    salted = lines.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64("docdate", "amount", "category", "projno"), F.lit(salts)))
                              .otherwise(F.lit(0)).cast("int"))
    keys = active.select("debtorcode", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))).alias("_salt"))
    return salted.join(keys, ["debtorcode", "_salt"], "left_semi").drop("_salt")


def sales_fact(wh: Warehouse, as_of=None, lookback: int = ACTIVE_LOOKBACK_MONTHS) -> DataFrame:
    """Line-level fact of closed months for active customers."""
    closed = F.col("docdate") < closed_month_start(as_of)
    facts = union_channels(wh, closed)
    active = active_customers(wh, as_of, lookback)
    facts = keep_active(facts, active, hot_customers(wh))
    return facts.select(
        "debtorcode", "docdate", F.col("amount").cast("double").alias("y"), "category", "projno",
        dates.month_key(F.col("docdate")).alias("month_year"))


def exact_sum(df: DataFrame, amount: str, amount_scale: int = AMOUNT_SCALE) -> Column:
    """Sum first, cast last: in the column's own decimal type, else in ``amount_scale`` digits."""
    from pyspark.sql.types import DecimalType
    c = F.col(amount)
    if not isinstance(df.schema[amount].dataType, DecimalType):
        c = c.cast(f"decimal(28,{amount_scale})")
    return F.sum(c)


def sum_by_cell(facts: DataFrame, amount_scale: int = AMOUNT_SCALE) -> DataFrame:
    """A1/S3: one row per (customer, category, channel, month); exact decimal sum."""
    return (facts.groupBy("month_year", "debtorcode", "category", "projno")
            .agg(exact_sum(facts, "y", amount_scale).cast("double").alias("y"))
            .select("debtorcode", "category", "projno", "y", "month_year"))


def cutoff_filter(df: DataFrame, cutoff: str) -> DataFrame:
    """Months up to and including the cutoff ('YYYY-MM', string order)."""
    return df.filter(F.col("month_year") <= F.lit(cutoff))


def all_month_cells(wh: Warehouse, amount_scale: int = AMOUNT_SCALE) -> DataFrame:
    """Both channels summed to cells for every month (one pass over the lines)."""
    lines = union_channels(wh).select("debtorcode", "category", "projno", "amount",
                                      dates.month_key(F.col("docdate")).alias("month_year"))
    return (lines.groupBy("month_year", "debtorcode", "category", "projno")
            .agg(exact_sum(lines, "amount", amount_scale).cast("double").alias("y")))


def cells(wh: Warehouse, as_of=None, amount_scale: int = AMOUNT_SCALE, lookback: int = ACTIVE_LOOKBACK_MONTHS,
          checkpoint: bool = True) -> DataFrame:
    """Facts summed to cells: the same result as ``sum_by_cell(sales_fact(...))``.

    The line-level join runs once: every month (the open one included) is
    summed to cells, the result is checkpointed, and both the activity test
    and the closed-month cells are read from it. Activity "any valid line
    on or after the window start" equals "any cell of a month on or after
    the window's month", since the window starts on a month start; cells
    are grouped by customer, so the semi join on customer is unchanged.
    """
    every = all_month_cells(wh, amount_scale)
    if checkpoint:
        from ..session import cut_lineage
        every = cut_lineage(every)
    closed_key = dates.month_key(closed_month_start(as_of))
    recent_key = dates.month_key(recent_window_start(as_of, lookback))
    active = every.filter(F.col("month_year") >= recent_key).select("debtorcode").distinct()
    closed = every.filter(F.col("month_year") < closed_key)
    return (closed.join(active, "debtorcode", "left_semi")
            .select("debtorcode", "category", "projno", "y", "month_year"))
