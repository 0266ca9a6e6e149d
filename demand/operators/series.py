"""Series layer: work-list items -> gap-filled monthly series, all items at once.

Hierarchy expansion (H1): every cell emits the level keys it belongs to
(total, channel, customer, category, customer x category), the exploded rows
are summed per (level key, month) with partial aggregation -- the total
level holds every cell, and map-side combine reduces it to one row per map
task and month before the shuffle -- and the small per-level monthly sums are
then equi-joined to the work list, with the item's own cutoff as a residual
predicate (J5, never a range or cross join).

Gap filling (J6 + W5) needs no month spine join: a ``lead`` over each item's
months gives the next known month, and the months in between are emitted by
``explode(sequence(...))`` with linearly interpolated values. Each window is
one item's months, a group bounded by the calendar span of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.constants import ALL, AMOUNT_SCALE, CAP_MULTIPLE, HORIZON, N_TEST
from ..functions.errors import mean_in_order

LEVEL_TOTAL, LEVEL_CHANNEL, LEVEL_CUSTOMER, LEVEL_CATEGORY, LEVEL_CUSTOMER_CATEGORY = 0, 1, 2, 3, 4


def item_level(d: Column, c: Column, p: Column) -> Column:
    """Level of a work-list item; null = no level matches (bad item)."""
    return (F.when((d == ALL) & (c == ALL) & (p == ALL), F.lit(LEVEL_TOTAL))
            .when((d == ALL) & (c == ALL) & (p != ""), F.lit(LEVEL_CHANNEL))
            .when((d != "") & (c == ALL), F.lit(LEVEL_CUSTOMER))
            .when((d == ALL) & (c != ""), F.lit(LEVEL_CATEGORY))
            .when((d != "") & (c != ""), F.lit(LEVEL_CUSTOMER_CATEGORY)))


def item_keys(items: DataFrame, channel_scoped: bool = False) -> DataFrame:
    """Work-list rows with their level key (lvl, kd, kc, kp).

    Blank cells are read as '' (P15). ``channel_scoped=False`` reproduces
    series that ignore the channel below the channel level (quirk Q1).
    """
    d, c, p = (F.coalesce(F.col(x), F.lit("")) for x in ("debtorcode", "category", "projno"))
    lvl = item_level(d, c, p)
    kp_scoped = p if channel_scoped else F.lit("")
    return items.select(
        "*",
        lvl.alias("lvl"),
        F.when(lvl.isin(LEVEL_CUSTOMER, LEVEL_CUSTOMER_CATEGORY), d).otherwise(F.lit("")).alias("kd"),
        F.when(lvl.isin(LEVEL_CATEGORY, LEVEL_CUSTOMER_CATEGORY), c).otherwise(F.lit("")).alias("kc"),
        F.when(lvl == LEVEL_CHANNEL, p).when(lvl >= LEVEL_CUSTOMER, kp_scoped).otherwise(F.lit("")).alias("kp"),
    )


def cell_keys(cells: DataFrame, channel_scoped: bool = False) -> DataFrame:
    """H1: every cell explodes into the level keys it contributes to."""
    d, c, p = F.col("debtorcode"), F.col("category"), F.col("projno")
    kp = p if channel_scoped else F.lit("")
    e = F.lit("")

    def key(lvl, kd, kc, kpp):
        return F.struct(F.lit(lvl).alias("lvl"), kd.alias("kd"), kc.alias("kc"), kpp.alias("kp"))

    keys = F.array(key(LEVEL_TOTAL, e, e, e), key(LEVEL_CHANNEL, e, e, p), key(LEVEL_CUSTOMER, d, e, kp),
                   key(LEVEL_CATEGORY, e, c, kp), key(LEVEL_CUSTOMER_CATEGORY, d, c, kp))
    exploded = cells.select(F.explode(keys).alias("k"), "month_year", "y").select("k.*", "month_year", "y")
    # a null key part (null customer, category or channel) matches no item
    return exploded.filter(F.col("kd").isNotNull() & F.col("kc").isNotNull() & F.col("kp").isNotNull())


def level_month_sums(cells: DataFrame, channel_scoped: bool = False, amount_scale: int = AMOUNT_SCALE) -> DataFrame:
    """Monthly sums per level key (exact decimal sums, map-side combined)."""
    return (cell_keys(cells, channel_scoped)
            .groupBy("lvl", "kd", "kc", "kp", "month_year")
            .agg(F.sum(F.col("y").cast(f"decimal(28,{amount_scale})")).alias("y_dec")))


def hierarchy_expand(cells: DataFrame, items: DataFrame, channel_scoped: bool = False,
                     amount_scale: int = AMOUNT_SCALE) -> DataFrame:
    """P17 + J5 + A4: (item_id, month_year, y) for every work-list item.

    ``items`` needs item_id, debtorcode, category, projno, month_year (the
    item's cutoff). Only months up to the item's cutoff are kept.
    """
    keyed = item_keys(items, channel_scoped).filter(F.col("lvl").isNotNull()).select(
        "item_id", "lvl", "kd", "kc", "kp", F.col("month_year").alias("cutoff"))
    sums = level_month_sums(cells, channel_scoped, amount_scale)
    joined = sums.join(keyed, ["lvl", "kd", "kc", "kp"]).filter(F.col("month_year") <= F.col("cutoff"))
    return joined.select("item_id", "month_year", F.col("y_dec").cast("double").alias("y"))


def last_train_month(series: DataFrame) -> DataFrame:
    """A5: the last month with data of each item."""
    return series.groupBy("item_id").agg(F.max("month_year").alias("last_trainmy"))


def gap_profile(series: DataFrame) -> DataFrame:
    """A6 + A12: span bounds, months with data and missing months per item."""
    t = dates.month_index(F.col("month_year"))
    return (series.groupBy("item_id")
            .agg(F.min("month_year").alias("first_month"), F.max("month_year").alias("last_month"),
                 F.count(F.lit(1)).alias("n_known"), (F.max(t) - F.min(t) + 1).alias("n_months"))
            .withColumn("n_missing", F.col("n_months") - F.col("n_known")))


def gap_fill(series: DataFrame) -> DataFrame:
    """J6 + W5 + F7: dense monthly series with linear interpolation of gaps.

    Output: item_id, t (absolute month number), ds (month start), y,
    filled (true for interpolated months).
    """
    base = series.select("item_id", dates.month_index(F.col("month_year")).alias("t0"), F.col("y").alias("y0"))
    w = Window.partitionBy("item_id").orderBy("t0")
    nxt = base.select("*", F.lead("t0").over(w).alias("t1"), F.lead("y0").over(w).alias("y1"))
    gap = F.coalesce(F.col("t1") - F.col("t0"), F.lit(1))
    steps = nxt.select("item_id", "t0", "y0", "t1", "y1", gap.alias("gap"),
                       F.explode(F.sequence(F.lit(0), gap - 1)).alias("k"))
    slope = (F.col("y1") - F.col("y0")) / (F.col("t1") - F.col("t0")).cast("double")
    y = F.when(F.col("k") == 0, F.col("y0")).otherwise(slope * F.col("k") + F.col("y0"))
    t = F.col("t0") + F.col("k")
    return steps.select(
        "item_id",
        t.alias("t"),
        month_start_of_index(t).alias("ds"),
        y.alias("y"),
        (F.col("k") > 0).alias("filled"),
    )


def month_start_of_index(t: Column) -> Column:
    """Absolute month number -> month-start date."""
    year = F.floor((t - 1) / 12).cast("int")
    month = (t - year * 12).cast("int")
    return F.make_date(year, month, F.lit(1))


def tail_split(filled: DataFrame, n_test: int = N_TEST) -> DataFrame:
    """The last ``n_test`` months of each item are the hold-out.

    Adds n (months in the series), pos (0-based position), is_test.
    Series are dense after gap filling, so positions follow from t.
    """
    w = Window.partitionBy("item_id")
    out = filled.select("*", F.min("t").over(w).alias("_tmin"), F.max("t").over(w).alias("_tmax"))
    n = F.col("_tmax") - F.col("_tmin") + 1
    return out.select(
        *[c for c in filled.columns],
        n.alias("n"),
        (F.col("t") - F.col("_tmin")).alias("pos"),
        (F.col("t") > F.col("_tmax") - F.lit(n_test)).alias("is_test"),
    )


def holdout_cap(split: DataFrame, multiple: float = CAP_MULTIPLE) -> DataFrame:
    """Hold-out mean per item and the clip cap (mean * 5)."""
    return (split.filter("is_test").groupBy("item_id")
            .agg(mean_in_order(F.col("y"), F.col("t")).alias("test_mean"))
            .withColumn("cap", F.col("test_mean") * F.lit(float(multiple))))


def spread(rows: DataFrame, per_task: int) -> DataFrame:
    """Series dealt to tasks by count: AQE merges partitions by bytes, and series are small but slow to fit."""
    n = rows.count()
    return rows.repartition(max(1, min(-(-n // per_task), 20_000)), "item_id") if n else rows


def future_months(split: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """the ``horizon`` months after each item's last month."""
    last = split.groupBy("item_id").agg(F.max("t").alias("t_last"))
    fut = last.select("item_id", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"), "t_last")
    t = F.col("t_last") + F.col("step")
    return fut.select("item_id", "step", t.alias("t"), month_start_of_index(t).alias("ds"))


def skip_done(items: DataFrame, done: DataFrame) -> DataFrame:
    """Drop items whose (customer, category, month, channel) is stored.

    ``done`` carries the stored key with ``last_trainmy``; compared with the
    item's month (quirk Q12: a stale item is never skipped).
    """
    stored = done.select("debtorcode", "category", F.col("last_trainmy").alias("month_year"), "projno").distinct()
    return items.join(stored, ["debtorcode", "category", "month_year", "projno"], "left_anti")
