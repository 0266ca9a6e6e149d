"""M2: seasonal ARMA fitted by batch least squares (labelled SARIMAX).

Per series and phase ('test' fits the training months, 'future' the whole
series):

1. differencing (d, D) in {0,1}^2 with period 12: the pair whose differenced
   series has the smallest sample variance (ties: fewer differences);
2. residuals in two steps (Hannan-Rissanen): a long autoregression of z on its
   lags 1, 2, 3 and 12 leaves residuals e, which stand for the unseen shocks;
3. candidates p in {0,1,2}, P in {0,1}, q in {0,1}: z_t ~ 1 + z_{t-1..t-p}
   (+ z_{t-12}) (+ e_{t-1}); all candidates use the rows where every lag
   exists (common sample), the long autoregression the same rows one month back;
4. least squares from Gram sums (G1), best candidate by AIC;
5. recursive forecast on the differenced scale, undone in the same fold; the
   last residual counts in the first step, later shocks are expected to be 0.

e_{t-1} is a sum of lags of z with coefficients of the series, so its Gram sums
follow from those of the lags: both steps read the rows once, with one
``groupBy``. A series with fewer than ``MIN_LONG`` common rows, a singular long
autoregression or hardly any residual takes no candidate with q = 1.

Everything up to the Gram sums is window functions over one
``partitionBy(item_id, phase)``; the forecast is an ``aggregate`` fold over
``sequence(1, h)`` carrying the tail of the series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ...functions.constants import HORIZON, N_TEST
from .linalg import gram_aggs, gram_struct, solve_candidates, solve_scaled

MODEL = "SARIMAX"
PERIOD = 12
MIN_TRAIN = 30
HISTORY = 2 * PERIOD + 2
# Gram columns: intercept and these lags of z
LAGS = [1, 2, PERIOD, 3, 4, PERIOD + 1]
# the long autoregression of the month before: z lag 1 on the intercept and lags 2, 3, 4, 13
LONG_TARGET, LONG = 1, [0, 2, 4, 5, 6]
MIN_LONG = 2 * len(LONG)
LEAST_RESIDUAL = 1e-8  # of the squares of lag 1
# feature order: intercept, lag 1, lag 2, lag 12, residual of the month before; candidates in tie order
CANDIDATES = [[0], [0, 1], [0, 3], [0, 4], [0, 1, 2], [0, 1, 3], [0, 1, 4], [0, 3, 4],
              [0, 1, 2, 3], [0, 1, 2, 4], [0, 1, 3, 4], [0, 1, 2, 3, 4]]


def fit_rows(split: DataFrame) -> DataFrame:
    """Rows of both fits: 'test' = training months, 'future' = all months."""
    ph = F.explode(F.when(F.col("is_test"), F.array(F.lit("future")))
                   .otherwise(F.array(F.lit("test"), F.lit("future")))).alias("phase")
    return split.select("item_id", "t", "y", ph)


def differencing_choice(rows: DataFrame) -> DataFrame:
    """Add d, D (chosen per item and phase) and the differenced value z."""
    w = Window.partitionBy("item_id", "phase").orderBy("t")
    wa = Window.partitionBy("item_id", "phase")
    y = F.col("y")
    y1, y12, y13 = F.lag(y, 1).over(w), F.lag(y, PERIOD).over(w), F.lag(y, PERIOD + 1).over(w)
    r = rows.select("*", y1.alias("y1"), y12.alias("y12"), y13.alias("y13"))
    z = {(0, 0): F.col("y"), (1, 0): F.col("y") - F.col("y1"), (0, 1): F.col("y") - F.col("y12"),
         (1, 1): F.col("y") - F.col("y1") - F.col("y12") + F.col("y13")}
    big = F.lit(float("inf"))
    opts = [F.struct(F.coalesce(F.var_samp(e).over(wa), big).alias("v"), F.lit(i).alias("o"),
                     F.lit(d).alias("d1"), F.lit(dd).alias("d12"))
            for i, ((d, dd), e) in enumerate(z.items())]
    r = r.select("*", F.array_min(F.array(*opts)).alias("ch"))
    zc = (F.when((F.col("ch.d1") == 0) & (F.col("ch.d12") == 0), z[(0, 0)])
          .when((F.col("ch.d1") == 1) & (F.col("ch.d12") == 0), z[(1, 0)])
          .when((F.col("ch.d1") == 0) & (F.col("ch.d12") == 1), z[(0, 1)])
          .otherwise(z[(1, 1)]))
    return r.select("item_id", "phase", "t", "y", F.col("ch.d1").alias("d1"), F.col("ch.d12").alias("d12"),
                    zc.alias("z"))


def residual_feature(xtx, n):
    """Per series the 5 features in terms of the 7 Gram columns; the last is the long autoregression's residual, or 0."""
    import numpy as np

    m, k = len(xtx), 1 + len(LAGS)
    made = np.zeros((m, k, 5))
    made[:, range(4), range(4)] = 1.0
    beta, ok = solve_scaled(xtx[:, LONG][:, :, LONG], xtx[:, LONG, LONG_TARGET], n >= MIN_LONG)
    rest = np.zeros((m, k))
    rest[:, LONG_TARGET] = 1.0
    rest[:, LONG] = -beta
    square = np.einsum("mi,mij,mj->m", rest, xtx, rest)
    with np.errstate(invalid="ignore"):
        ok &= square > LEAST_RESIDUAL * xtx[:, LONG_TARGET, LONG_TARGET]
    made[ok, :, 4] = rest[ok]
    return made


def seasonal_ar_fit(split: DataFrame, min_train: int = MIN_TRAIN) -> DataFrame:
    """Coefficients per (item_id, phase): d1, d12, beta[5], raw[7] (first step, per Gram column), t_last, hist."""
    r = differencing_choice(fit_rows(split))
    w = Window.partitionBy("item_id", "phase").orderBy("t")
    z = F.col("z")
    r = r.select("*", *[F.lag(z, j).over(w).alias(f"z{j}") for j in LAGS])
    common = z.isNotNull()
    for j in LAGS:
        common &= F.col(f"z{j}").isNotNull()
    feats = [F.lit(1.0), *[F.col(f"z{j}") for j in LAGS]]
    agg = (r.groupBy("item_id", "phase")
           .agg(*gram_aggs(feats, z, common),
                F.first("d1").alias("d1"), F.first("d12").alias("d12"), F.max("t").alias("t_last"),
                F.count(F.lit(1)).alias("n_fit"),
                F.transform(F.slice(F.array_sort(F.collect_list(F.struct("t", "y"))), -HISTORY, HISTORY),
                            lambda s: s["y"]).alias("hist")))
    agg = agg.filter(F.col("n_fit") >= F.lit(min_train))
    gram = agg.select("item_id", "phase", gram_struct(len(feats)).alias("g"))
    sol = solve_candidates(gram, ["item_id", "phase"], len(feats), CANDIDATES, derive=residual_feature)
    return sol.join(agg.select("item_id", "phase", "d1", "d12", "t_last", "hist"), ["item_id", "phase"])


def _forecast(hist, beta, raw, d, dd, steps: int):
    """Recursive forecast: append ``steps`` values to the history array."""
    def at(arr, j):
        return F.coalesce(F.try_element_at(arr, F.lit(-j)), F.lit(0.0))

    def zback(arr, j):
        return (at(arr, j) - d * at(arr, j + 1) - dd * at(arr, j + PERIOD)
                + d * dd * at(arr, j + PERIOD + 1))

    def weighted(arr, weights, lags):
        out = F.element_at(weights, 1)
        for i, j in enumerate(lags):
            out = out + F.element_at(weights, i + 2) * zback(arr, j)
        return out

    def step(acc, h):
        znext = F.when(h == 1, weighted(acc, raw, LAGS)).otherwise(weighted(acc, beta, LAGS[:3]))
        ynext = znext + d * at(acc, 1) + dd * at(acc, PERIOD) - d * dd * at(acc, PERIOD + 1)
        return F.concat(acc, F.array(ynext))

    full = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), hist, step)
    return F.slice(full, -steps, steps)


def seasonal_ar(split: DataFrame, n_test: int = N_TEST, horizon: int = HORIZON,
                min_train: int = MIN_TRAIN) -> DataFrame:
    """Long predictions (item_id, model, phase, t, ds, yhat)."""
    from ..series import month_start_of_index
    fit = seasonal_ar_fit(split, min_train)
    d, dd = F.col("d1").cast("double"), F.col("d12").cast("double")
    test = fit.filter(F.col("phase") == "test").select(
        "item_id", "phase", "t_last", F.posexplode(_forecast(F.col("hist"), F.col("beta"), F.col("raw"), d, dd, n_test)))
    fut = fit.filter(F.col("phase") == "future").select(
        "item_id", "phase", "t_last", F.posexplode(_forecast(F.col("hist"), F.col("beta"), F.col("raw"), d, dd, horizon)))
    out = test.unionByName(fut)
    t = F.col("t_last") + F.col("pos") + 1
    return out.select("item_id", F.lit(MODEL).alias("model"), "phase", t.alias("t"),
                      month_start_of_index(t).alias("ds"), F.col("col").alias("yhat"))


def lag_regression(split: DataFrame, lag: int = 1) -> DataFrame:
    """One-regressor case of M2 on each whole series: y_t = c + phi * y_{t-lag}.

    Uses the model's common sample (rows where lag 12 exists) and the same
    Gram-sum + batched-solve path; output item_id, intercept, slope, n_obs.
    """
    w = Window.partitionBy("item_id").orderBy("t")
    r = split.select("item_id", "y", F.lag("y", lag).over(w).alias("x"), F.lag("y", PERIOD).over(w).alias("x12"))
    common = F.col("x").isNotNull() & F.col("x12").isNotNull()
    agg = r.groupBy("item_id").agg(*gram_aggs([F.lit(1.0), F.col("x")], F.col("y"), common))
    sol = solve_candidates(agg.select("item_id", gram_struct(2).alias("g")), ["item_id"], 2, [[0, 1]])
    return sol.select("item_id", F.element_at("beta", 1).alias("intercept"), F.element_at("beta", 2).alias("slope"),
                      "n_obs")
