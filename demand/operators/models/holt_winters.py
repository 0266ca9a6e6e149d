"""M1: grid Holt-Winters (additive damped trend, multiplicative season of 6).

Every series becomes one row with its values as an array (bounded by the
series' month span); the fixed parameter grid is a literal array exploded
per row, so no join and no shuffle happens until ``min_by`` picks the best
grid point per item (on a frame already partitioned by item_id).

Equations (m = 6, phi = damping):
  f   = l + phi*b                      one-step level+trend
  yhat= f * s[t-m]
  l'  = alpha*y/s[t-m] + (1-alpha)*f
  b'  = beta*(l'-l) + (1-beta)*phi*b
  s'  = gamma*y/f + (1-gamma)*s[t-m]
  forecast(h) = (l + (phi+...+phi^h)*b) * s[(h-1) mod m]
Start: l = mean of the first 6 values, b = (mean of values 7..12 - l)/6,
s_i = y_i / l for the first 6 values.
Box-Cox: the recurrence runs on y**lam (a Box-Cox transform up to shift and scale; unlike its
usual form it keeps small values positive, as the multiplicative season needs), forecasts are
transformed back (below 0: 0) and the errors are taken on the original scale.
The fit minimises the one-step SSE over a coarse grid at lam = 1, then over the lambdas at the
coarse winner, then over a finer grid around it at the chosen lambda.
The hold-out forecast uses the best fit on the training months, the future
forecast the best fit on the whole series. A series needs 12 positive values.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.constants import HORIZON, N_TEST
from .isolate import KERNEL_SCHEMA, isolated

SEASON = 6
MODEL = "HWExSmooth"

# --- fixed values: coarse search grid --------------------------------------
ALPHAS = [0.1, 0.3, 0.5, 0.7, 0.9]
BETAS = [0.01, 0.1, 0.3]
GAMMAS = [0.05, 0.2, 0.5]
PHIS = [0.8, 0.9, 0.98]
# Second, finer search: every parameter of the coarse winner -step, 0, +step
# (3^4 = 81 points), clipped to its bounds. Order: alpha, beta, gamma, phi.
REFINE_STEPS = [0.1, 0.05, 0.1, 0.04]
REFINE_LOW = [0.02, 0.005, 0.01, 0.7]
REFINE_HIGH = [0.98, 0.95, 0.95, 0.995]
# Box-Cox lambdas, 1 first: it leaves the series as it is and wins ties.
LAMBDAS = [1.0, 0.75, 0.5, 0.25]
# --- end of fixed values ----------------------------------------------------
PARAMS = ["alpha", "beta", "gamma", "phi"]


def param_grid(alphas=ALPHAS, betas=BETAS, gammas=GAMMAS, phis=PHIS) -> Column:
    """The grid as a literal array of structs (size fixed by the parameters), at lambda 1."""
    pts = [F.struct(F.lit(float(a)).alias("alpha"), F.lit(float(b)).alias("beta"),
                    F.lit(float(g)).alias("gamma"), F.lit(float(p)).alias("phi"), F.lit(1.0).alias("lam"))
           for a, b, g, p in itertools.product(alphas, betas, gammas, phis)]
    return F.array(*pts)


def _init_state(y: Column) -> Column:
    l0 = (sum(F.element_at(y, i) for i in range(1, 7))) / F.lit(6.0)
    l1 = (sum(F.element_at(y, i) for i in range(7, 13))) / F.lit(6.0)
    fields = [l0.alias("l"), ((l1 - l0) / F.lit(6.0)).alias("b")]
    fields += [(F.element_at(y, i + 1) / l0).alias(f"s{i}") for i in range(SEASON)]
    fields.append(F.lit(0.0).alias("sse"))
    return F.struct(*fields)


def _step(g: Column):
    a, bt, gm, ph = g["alpha"], g["beta"], g["gamma"], g["phi"]

    def merge(st: Column, pair: Column) -> Column:
        y, actual = pair["z"], pair["y"]
        f = st["l"] + ph * st["b"]
        yhat = _back(f * st["s0"], g["lam"])
        lev = a * y / st["s0"] + (F.lit(1.0) - a) * f
        trend = bt * (lev - st["l"]) + (F.lit(1.0) - bt) * ph * st["b"]
        snew = gm * y / f + (F.lit(1.0) - gm) * st["s0"]
        fields = [lev.alias("l"), trend.alias("b")]
        fields += [st[f"s{i + 1}"].alias(f"s{i}") for i in range(SEASON - 1)]
        fields += [snew.alias(f"s{SEASON - 1}"), (st["sse"] + (actual - yhat) * (actual - yhat)).alias("sse")]
        return F.struct(*fields)

    return merge


def _forth(y: Column, lam: Column) -> Column:
    return F.when(lam == 1.0, y).otherwise(F.pow(y, lam))


def _back(z: Column, lam: Column) -> Column:
    return F.when(lam == 1.0, z).otherwise(F.pow(F.greatest(z, F.lit(0.0)), F.lit(1.0) / lam))


def fit(y: Column, g: Column) -> Column:
    """Fold the recurrence over ``y`` (array<double>) for grid point ``g``."""
    pairs = F.transform(y, lambda v: F.struct(_forth(v, g["lam"]).alias("z"), v.alias("y")))
    rest = F.slice(pairs, SEASON + 1, F.greatest(F.size(y) - SEASON, F.lit(1)))
    return F.aggregate(rest, _init_state(F.transform(y, lambda v: _forth(v, g["lam"]))), _step(g))


def forecast(state: Column, g: Column, h: Column) -> Column:
    """h-step forecast from a fitted state."""
    ph = g["phi"]
    damp = ph * (F.lit(1.0) - F.pow(ph, h)) / (F.lit(1.0) - ph)
    season = F.element_at(F.array(*[state[f"s{i}"] for i in range(SEASON)]), ((h - 1) % SEASON) + 1)
    return _back((state["l"] + damp * state["b"]) * season, g["lam"])


SERIES_PER_TASK = 256


def series_arrays(split: DataFrame) -> DataFrame:
    """One row per item: ordered values, train length, first test / future month."""
    return (split.groupBy("item_id")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("t", "y"))), lambda s: s["y"]).alias("y_all"),
                 F.count(F.lit(1)).alias("n"),
                 F.sum(F.when(F.col("is_test"), 0).otherwise(1)).alias("n_train"),
                 F.max("t").alias("t_last"),
                 F.min(F.when(~F.col("is_test"), F.col("y"))).alias("min_train"),
                 F.min("y").alias("min_all")))


def holt_winters_grid(split: DataFrame, n_test: int = N_TEST, horizon: int = HORIZON,
                      grid: Column | None = None, engine: str = "arrow") -> DataFrame:
    """Hold-out and future predictions of the best grid point per item.

    ``engine="arrow"`` runs the recurrence as a numpy kernel in
    ``mapInPandas`` over Arrow batches of series (vectorised over series
    and grid points); ``engine="sql"`` runs it as an ``aggregate`` fold,
    which is fully declarative but interpreted per step (about 50x slower).
    Both give the same numbers. Returns long predictions
    (item_id, model, phase, t, ds, yhat).
    """
    if engine == "arrow":
        return _holt_winters_arrow(split, n_test, horizon)
    from ..series import month_start_of_index
    best = _search_sql(_fit_inputs(split, n_test, horizon), grid)
    out = best.select("item_id", "phase", "t_end", "b", F.explode(F.sequence(F.lit(1), F.col("steps"))).alias("h"))
    out = out.select("item_id", "phase", (F.col("t_end") + F.col("h")).alias("t"),
                     forecast(F.col("b.st"), F.col("b.g"), F.col("h")).alias("yhat"))
    return out.select("item_id", F.lit(MODEL).alias("model"), "phase", "t",
                      month_start_of_index(F.col("t")).alias("ds"), "yhat")


def _fit_inputs(split: DataFrame, n_test: int, horizon: int) -> DataFrame:
    """One row per (item, phase): the values to fit, last fitted month, steps."""
    arr = series_arrays(split)
    test = arr.filter((F.col("n_train") >= 2 * SEASON) & (F.col("min_train") > 0)).select(
        "item_id", F.lit("test").alias("phase"), F.slice("y_all", 1, F.col("n_train")).alias("y"),
        (F.col("t_last") - F.lit(n_test)).alias("t_end"), F.lit(n_test).alias("steps"))
    fut = arr.filter((F.col("n") >= 2 * SEASON) & (F.col("min_all") > 0)).select(
        "item_id", F.lit("future").alias("phase"), F.col("y_all").alias("y"), F.col("t_last").alias("t_end"),
        F.lit(horizon).alias("steps"))
    return test.unionByName(fut)


def refine_grid(g: Column) -> Column:
    """The 81 refinement points around grid point ``g`` (array of structs)."""
    offs = [F.struct(*[F.lit(float(o) * st).alias(p) for o, st, p in zip(combo, REFINE_STEPS, PARAMS)])
            for combo in itertools.product([-1, 0, 1], repeat=4)]

    def point(o):
        return F.struct(*[F.least(F.lit(hi), F.greatest(F.lit(lo), g[p] + o[p])).alias(p)
                          for p, lo, hi in zip(PARAMS, REFINE_LOW, REFINE_HIGH)], g["lam"].alias("lam"))
    return F.transform(F.array(*offs), point)


def lambda_grid(g: Column) -> Column:
    """Grid point ``g`` at every lambda."""
    return F.array(*[F.struct(*[g[p].alias(p) for p in PARAMS], F.lit(lam).alias("lam")) for lam in LAMBDAS])


def _best_of(rows: DataFrame, grid: Column) -> DataFrame:
    pts = rows.select("item_id", "phase", "y", F.explode(grid).alias("g"))
    fits = pts.select("item_id", "phase", "g", fit(F.col("y"), F.col("g")).alias("st"))
    return fits.groupBy("item_id", "phase").agg(F.min_by(F.struct("g", "st"), F.col("st.sse")).alias("b"))


def _search_sql(rows: DataFrame, grid: Column | None = None) -> DataFrame:
    """Coarse grid, lambdas, then the refinement grid around each winner (SQL fold)."""
    fine = _best_of(rows, grid if grid is not None else param_grid())
    for around in (lambda_grid, refine_grid):
        again = rows.join(fine.select("item_id", "phase", F.col("b.g").alias("g0")), ["item_id", "phase"])
        fine = _best_of(again.withColumn("g2", around(F.col("g0"))), F.col("g2"))
    return rows.select("item_id", "phase", "t_end", "steps").join(fine, ["item_id", "phase"])


# ---------------------------------------------------------------------------
# Arrow engine: the same recurrence vectorised with numpy inside tasks.

def grid_points():
    return [(*map(float, p), 1.0) for p in itertools.product(ALPHAS, BETAS, GAMMAS, PHIS)]


def _power(x, e):
    """x**e, a value's result the same in any batch: where one exponent serves a whole row, numpy takes 0.5 and 2 another way."""
    import numpy as np
    return np.power(*map(np.ascontiguousarray, np.broadcast_arrays(x, e)))


def _back_batch(z, lam):
    import numpy as np
    if (lam == 1.0).all():
        return z
    return np.where(lam == 1.0, z, _power(np.maximum(z, 0.0), 1.0 / lam))


def _fit_batch(Y, L, grid):
    """Fit every grid point on every row of Y (rows padded, lengths L).

    ``grid`` is (G, 5) for a shared grid or (rows, G, 5) for one per row; lambda is the last.
    Returns level, trend, seasonal ring (6 arrays) and SSE, each (rows, G).
    """
    import numpy as np
    rows = Y.shape[0]
    if grid.ndim == 2:  # one grid for every row
        grid = np.broadcast_to(grid, (rows,) + grid.shape)
    A, B, G, P, lam = (grid[:, :, k] for k in range(5))
    width = grid.shape[1]
    plain = (lam == 1.0).all()
    if (lam == lam[:, :1]).all():  # one lambda per row: one transform of its values
        lam = lam[:, :1]

    def forth(y):  # (rows, n) -> (rows, lambdas, n)
        power = lam[:, :, None]
        return y[:, None, :] if plain else np.where(power == 1.0, y[:, None, :], _power(y[:, None, :], power))
    with np.errstate(all="ignore"):
        Z = forth(Y)
        l0, l1 = Z[:, :, :SEASON].mean(axis=2), Z[:, :, SEASON:2 * SEASON].mean(axis=2)
        lev = np.array(np.broadcast_to(l0, (rows, width)))
        tr = np.array(np.broadcast_to((l1 - l0) / 6.0, (rows, width)))
        ring = [np.array(np.broadcast_to(Z[:, :, j] / l0, (rows, width))) for j in range(SEASON)]
        sse = np.zeros((rows, width))
        for i in range(SEASON, int(L.max())):
            act = (i < L)[:, None]
            z, actual = Z[:, :, i], Y[:, i][:, None]
            s0 = ring[i % SEASON]
            f = lev + P * tr
            yhat = _back_batch(f * s0, lam)
            nl = A * z / s0 + (1.0 - A) * f
            nt = B * (nl - lev) + (1.0 - B) * P * tr
            ns = G * z / f + (1.0 - G) * s0
            sse = np.where(act, sse + (actual - yhat) * (actual - yhat), sse)
            lev = np.where(act, nl, lev)
            tr = np.where(act, nt, tr)
            ring[i % SEASON] = np.where(act, ns, s0)
    return lev, tr, ring, sse


def _best_batch(Y, L, grid):
    """Best grid point per row: its parameters and fitted state."""
    import numpy as np
    lev, tr, ring, sse = _fit_batch(Y, L, grid)
    best = np.argmin(np.where(np.isnan(sse), np.inf, sse), axis=1)
    r = np.arange(Y.shape[0])
    params = grid[best] if grid.ndim == 2 else grid[r, best]
    return params, lev[r, best], tr[r, best], [ring[j][r, best] for j in range(SEASON)]


def _refine_batch(params):
    """(rows, 5) winners -> (rows, 81, 5) refinement grids, clipped, at their lambda."""
    import numpy as np
    offs = np.array(list(itertools.product([-1, 0, 1], repeat=4)), dtype=float) * np.array(REFINE_STEPS)
    points = np.clip(params[:, None, :4] + offs[None, :, :], np.array(REFINE_LOW), np.array(REFINE_HIGH))
    return np.concatenate([points, np.broadcast_to(params[:, None, 4:], (*points.shape[:2], 1))], axis=2)


def _lambda_batch(params):
    """(rows, 5) winners -> (rows, lambdas, 5)."""
    import numpy as np
    out = np.repeat(params[:, None, :], len(LAMBDAS), axis=1)
    out[:, :, 4] = LAMBDAS
    return out


def _forecast_batch(Y, L, grid, steps):
    """Coarse search, lambdas, refinement around the winner, ``steps``-ahead forecasts."""
    import numpy as np
    params, _, _, _ = _best_batch(Y, L, grid)
    params, _, _, _ = _best_batch(Y, L, _lambda_batch(params))
    params, lev, tr, ring = _best_batch(Y, L, _refine_batch(params))
    phi = params[:, 3]
    out = np.empty((Y.shape[0], steps))
    with np.errstate(all="ignore"):
        for h in range(1, steps + 1):
            damp = phi * (1.0 - phi ** h) / (1.0 - phi)
            slot = (L + h - 1) % SEASON
            season = np.choose(slot, ring)
            out[:, h - 1] = _back_batch((lev + damp * tr) * season, params[:, 4])
    return out


def _kernel(n_test: int, horizon: int, chunk: int = 256):
    import numpy as np
    import pandas as pd
    grid = np.array(grid_points())

    def fitted(part):
        ys = [np.asarray(v, dtype=float) for v in part["y_all"]]
        width = max(len(v) for v in ys)
        Y = np.full((len(ys), width), np.nan)
        for k, v in enumerate(ys):
            Y[k, :len(v)] = v
        n = part["n"].to_numpy()
        n_train = part["n_train"].to_numpy()
        t_last = part["t_last"].to_numpy()
        frames = []
        for ok_col, L, steps, phase, t0 in (("ok_train", n_train, n_test, "test", t_last - n_test),
                                            ("ok_all", n, horizon, "future", t_last)):
            ok = part[ok_col].to_numpy().astype(bool)
            if not ok.any():
                continue
            fc = _forecast_batch(Y[ok], L[ok], grid, steps)
            hs = np.arange(1, steps + 1)
            frames.append(pd.DataFrame({
                "item_id": np.repeat(part["item_id"].to_numpy()[ok], steps),
                "phase": phase,
                "t": (np.repeat(t0[ok], steps) + np.tile(hs, ok.sum())).astype("int64"),
                "yhat": fc.reshape(-1)}))
        if frames:
            yield pd.concat(frames, ignore_index=True)

    def run(batches):
        for pdf in batches:
            for lo in range(0, len(pdf), chunk):
                yield from isolated(fitted, pdf.iloc[lo:lo + chunk])
    return run


def _holt_winters_arrow(split: DataFrame, n_test: int, horizon: int) -> DataFrame:
    from ..series import month_start_of_index, spread
    arr = series_arrays(split)
    ok_train = (F.col("n_train") >= 2 * SEASON) & (F.col("min_train") > 0)
    ok_all = (F.col("n") >= 2 * SEASON) & (F.col("min_all") > 0)
    rows = arr.filter(ok_train | ok_all).select(
        "item_id", "n", "n_train", "t_last", ok_train.alias("ok_train"), ok_all.alias("ok_all"), "y_all")
    out = spread(rows, SERIES_PER_TASK).mapInPandas(_kernel(n_test, horizon), KERNEL_SCHEMA)
    return out.select("item_id", F.lit(MODEL).alias("model"), "phase", "t",
                      month_start_of_index(F.col("t")).alias("ds"), "yhat", "error")
