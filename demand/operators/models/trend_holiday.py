"""M3: piecewise-linear trend with multiplicative holiday effects (labelled Prophet).

Per series and phase ('test' fits the training months, 'future' all months):

* y is scaled by its maximum absolute value on the fit months; time is
  tau = (t - t_first) / (t_last - t_first) on the fit months (so the
  hold-out and the future extrapolate past 1);
* trend features 1, tau and hinges max(0, tau - c) at changepoints
  c = 0.2, 0.4, 0.6 (inside the first 80 % of the history); ridge penalty
  1/30^2 on the hinge coefficients (the changepoint prior scale);
* holiday effects are multiplicative: y = trend * (1 + beta_h) on months
  whose first day is holiday h. With one event per month start the
  indicators are disjoint, so given the trend each beta_h has the closed
  ridge form sum(r*T) / (sum(T^2) + 1/20^2) over that event's months
  (r = scaled y - T): a grouped aggregate, no second solve.

The holiday calendar is an input table (date, name); by default it covers the
years of the series and their horizon. It is left to the planner to broadcast. Only dates on a month start can touch
monthly data; several holidays on one date form one event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ...functions.constants import HORIZON, N_TEST
from .linalg import gram_aggs, gram_struct, solve_candidates
from .seasonal_ar import fit_rows

MODEL = "Prophet"

# --- fixed values -----------------------------------------------------------
CHANGEPOINTS = [0.2, 0.4, 0.6]
CHANGEPOINT_PRIOR_SCALE = 30.0
HOLIDAYS_PRIOR_SCALE = 20.0
# Fixed-date national holidays that fall on a month start (month, day, name).
MONTH_START_HOLIDAYS = [(1, 1, "New Year's Day"), (5, 1, "Labour Day")]
# --- end of fixed values ----------------------------------------------------


def default_holidays(split: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """The fixed-date holidays above for the years of the series and their horizon (a rule, not a list)."""
    span = split.agg(F.min("t").alias("a"), (F.max("t") + F.lit(horizon)).alias("b")).filter("a is not null")
    years = span.select(F.explode(F.expr("sequence(int((a - 1) div 12), int((b - 1) div 12))")).alias("year"))
    hol = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(n).alias("name"))
                              for m, d, n in MONTH_START_HOLIDAYS])).alias("h")
    return years.select("year", hol).select(F.make_date("year", F.col("h.m"), F.col("h.d")).alias("date"),
                                            F.col("h.name").alias("name"))


def month_start_events(holidays: DataFrame) -> DataFrame:
    """(ds, event): holidays on month starts, names of one date merged."""
    ms = holidays.filter(F.dayofmonth("date") == 1)
    return (ms.groupBy(F.col("date").alias("ds"))
            .agg(F.array_join(F.array_sort(F.collect_set("name")), " + ").alias("event")))


def _features(tau):
    return [F.lit(1.0), tau] + [F.greatest(F.lit(0.0), tau - F.lit(c)) for c in CHANGEPOINTS]


def trend_holiday(split: DataFrame, n_test: int = N_TEST, horizon: int = HORIZON,
                  holidays: DataFrame | None = None, min_fit: int = 8) -> DataFrame:
    """Long predictions (item_id, model, phase, t, ds, yhat)."""
    from ..series import month_start_of_index
    events = month_start_events(holidays if holidays is not None else default_holidays(split, horizon))
    rows = fit_rows(split)
    wa = Window.partitionBy("item_id", "phase")
    rows = rows.select("*", F.min("t").over(wa).alias("t0"), F.max("t").over(wa).alias("t1"),
                       F.max(F.abs("y")).over(wa).alias("scale"), F.count(F.lit(1)).over(wa).alias("n_fit"))
    rows = rows.filter((F.col("n_fit") >= F.lit(min_fit)) & (F.col("scale") > 0))
    tau = (F.col("t") - F.col("t0")) / (F.col("t1") - F.col("t0")).cast("double")
    ys = F.col("y") / F.col("scale")
    rows = rows.select("item_id", "phase", "t", "t0", "t1", "scale", tau.alias("tau"), ys.alias("ys"))
    k = 2 + len(CHANGEPOINTS)
    feats = _features(F.col("tau"))
    agg = rows.groupBy("item_id", "phase").agg(*gram_aggs(feats, F.col("ys")))
    ridge = [0.0, 0.0] + [1.0 / CHANGEPOINT_PRIOR_SCALE ** 2] * len(CHANGEPOINTS)
    sol = solve_candidates(agg.select("item_id", "phase", gram_struct(k).alias("g")), ["item_id", "phase"], k,
                           [list(range(k))], ridge)
    coef = sol.select("item_id", "phase", "beta")

    def trend_of(tau_col):
        return sum(F.element_at(F.col("beta"), i + 1) * f for i, f in enumerate(_features(tau_col)))

    # holiday effects from the residuals of the fit months
    fitted = rows.join(coef, ["item_id", "phase"]).withColumn("trend_fit", trend_of(F.col("tau")))
    fitted = fitted.withColumn("ds", month_start_of_index(F.col("t")))
    hol = (fitted.join(events, "ds")
           .groupBy("item_id", "phase", "event")
           .agg((F.sum((F.col("ys") - F.col("trend_fit")) * F.col("trend_fit"))
                 / (F.sum(F.col("trend_fit") * F.col("trend_fit")) + F.lit(1.0 / HOLIDAYS_PRIOR_SCALE ** 2)))
                .alias("beta_h")))
    # targets: the hold-out months (test fit) and the future months (full fit)
    meta = rows.groupBy("item_id", "phase").agg(F.first("t0").alias("t0"), F.first("t1").alias("t1"),
                                                F.first("scale").alias("scale"))
    steps = F.when(F.col("phase") == "test", F.lit(n_test)).otherwise(F.lit(horizon))
    tgt = meta.select("*", F.explode(F.sequence(F.lit(1), steps)).alias("h"))
    tgt = tgt.withColumn("t", F.col("t1") + F.col("h")).withColumn("ds", month_start_of_index(F.col("t")))
    tgt = tgt.join(coef, ["item_id", "phase"]).join(events, "ds", "left")
    tgt = tgt.join(hol, ["item_id", "phase", "event"], "left")
    tau_t = (F.col("t") - F.col("t0")) / (F.col("t1") - F.col("t0")).cast("double")
    yhat = F.col("scale") * trend_of(tau_t) * (F.lit(1.0) + F.coalesce(F.col("beta_h"), F.lit(0.0)))
    return tgt.select("item_id", F.lit(MODEL).alias("model"), "phase", "t", "ds", yhat.alias("yhat"))


def trend_line(split: DataFrame) -> DataFrame:
    """One-regressor case of M3 on each whole series: scaled y = a + b * tau.

    Same scaling (max |y|), time axis (tau in [0, 1]) and Gram-sum + solve
    path as the model; output item_id, intercept, slope, n_obs.
    """
    wa = Window.partitionBy("item_id")
    r = split.select("item_id", "t", "y", F.min("t").over(wa).alias("t0"), F.max("t").over(wa).alias("t1"),
                     F.max(F.abs("y")).over(wa).alias("scale"))
    r = r.filter((F.col("t1") > F.col("t0")) & (F.col("scale") > 0))
    tau = (F.col("t") - F.col("t0")) / (F.col("t1") - F.col("t0")).cast("double")
    agg = r.groupBy("item_id").agg(*gram_aggs([F.lit(1.0), tau], F.col("y") / F.col("scale")))
    sol = solve_candidates(agg.select("item_id", gram_struct(2).alias("g")), ["item_id"], 2, [[0, 1]])
    return sol.select("item_id", F.element_at("beta", 1).alias("intercept"), F.element_at("beta", 2).alias("slope"),
                      "n_obs")
