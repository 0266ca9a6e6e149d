"""M4: gradient-boosted trees on lag features, one booster per series (labelled XGBoost).

Every series has its own fits, as in a walk-forward run: for each hold-out month one
booster on the lag rows before it, predicting that month from its actual lags; and one on
all rows, rolled forward ``horizon`` steps on its own predictions. ``max_iter`` rounds of
depth-``max_depth`` trees (squared error, second-order gains with ridge ``LAMBDA``, shrinkage
``RATE``) are grown for all fits of a chunk of series at once: the sorted order of each lag is
found once per fit, and a level of the tree is one cumulative sum per node over those orders.

Spark spreads the series over tasks (``item_id`` decides, so the tasks do not depend on how
few bytes the series have); the kernel sees one row per series, bounded by its months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.constants import HORIZON, N_LAGS, N_TEST
from .holt_winters import series_arrays
from .isolate import KERNEL_SCHEMA, isolated

MODEL = "XGBoost"
# --- fixed values -----------------------------------------------------------
MAX_ITER = 1000
RATE = 0.3
LAMBDA = 1.0
DONE = 1e-6
# --- end of fixed values ----------------------------------------------------
MAX_DEPTH = 3
SERIES_PER_TASK = 16


def _grow(g, x, order, sorted_x, distinct, live, depth):
    """One tree per fit on residuals g: (feature, threshold) per inner node, value per leaf, leaf per row."""
    import numpy as np
    fits, rows, lags = x.shape
    leaf = np.zeros((fits, rows), np.int64)
    nodes = 2 ** depth - 1
    feature, cut = np.zeros((fits, nodes), np.int64), np.full((fits, nodes), np.inf)
    fit = np.arange(fits)
    node = 0
    for level in range(depth):
        for k in range(2 ** level):
            here = live & (leaf == k)
            gs = np.where(here, g, 0.0).ravel()[order].cumsum(axis=1)
            ns = here.ravel()[order].cumsum(axis=1, dtype=np.float64)
            gl, nl = gs[:, :-1], ns[:, :-1]
            gr, nr = gs[:, -1:, :] - gl, ns[:, -1:, :] - nl
            gain = gl * gl / (nl + LAMBDA) + gr * gr / (nr + LAMBDA)
            gain[~distinct | (nl == 0) | (nr == 0)] = -1.0
            gain = gain.reshape(fits, -1)
            best = gain.argmax(axis=1)
            at, f = best // lags, best % lags
            whole = gs[:, -1, 0] ** 2 / (ns[:, -1, 0] + LAMBDA)
            split = gain[fit, best] > whole + 1e-15
            feature[:, node] = f
            cut[:, node] = np.where(split, (sorted_x[fit, at, f] + sorted_x[fit, at + 1, f]) / 2, np.inf)
            node += 1
        which = 2 ** level - 1 + leaf
        chosen = np.take_along_axis(feature, which, axis=1)
        value = x.ravel()[(fit[:, None] * rows + np.arange(rows)) * lags + chosen]
        leaf = 2 * leaf + (value > np.take_along_axis(cut, which, axis=1))
    leaves = 2 ** depth
    slot = (fit[:, None] * leaves + leaf)[live]
    total = np.bincount(slot, weights=g[live], minlength=fits * leaves)
    count = np.bincount(slot, minlength=fits * leaves)
    return feature, cut, (RATE * total / (count + LAMBDA)).reshape(fits, leaves), leaf


def _leaf_of(x, feature, cut, depth):
    """Leaf of one point per fit."""
    import numpy as np
    fit, node, leaf = np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for level in range(depth):
        node = 2 ** level - 1 + leaf
        leaf = 2 * leaf + (x[fit, feature[fit, node]] > cut[fit, node])
    return leaf


def boost(x, y, live, point, rolled, horizon, max_iter=MAX_ITER, depth=MAX_DEPTH):
    """Predictions (fits x horizon) at ``point``; only fits with ``rolled`` go past the first step.

    x (fits, rows, lags), y and live (fits, rows): rows a fit may learn from; lag 1 is the first column.
    A fit whose residuals are all below ``DONE`` of its series' level takes no further rounds.
    """
    import numpy as np
    fits, rows, lags = x.shape
    order = np.argsort(np.where(live[:, :, None], x, np.inf), axis=1, kind="stable")
    sorted_x = np.take_along_axis(x, order, axis=1)
    distinct = sorted_x[:, 1:] != sorted_x[:, :-1]
    base = (y * live).sum(axis=1) / np.maximum(live.sum(axis=1), 1)
    out = np.full((fits, horizon), np.nan)
    trees, who, part = [], np.arange(fits), None
    fitted = np.repeat(base[:, None], rows, axis=1)
    for n in range(max_iter):
        g = np.where(live[who], y[who] - fitted, 0.0)
        if n % 20 == 0:  # the fits that still learn
            open_ = np.abs(g).max(axis=1, initial=0.0) > DONE
            who, fitted, g = who[open_], fitted[open_], g[open_]
            if not len(who):
                break
            flat = order[who] + (np.arange(len(who)) * rows)[:, None, None]
            part = (np.ascontiguousarray(x[who]), flat, sorted_x[who], distinct[who], live[who])
        feature, cut, value, leaf = _grow(g, *part, depth)
        fitted = fitted + np.take_along_axis(value, leaf, axis=1)
        trees.append((who, feature, cut, value))
    now = point.astype(float)
    for step in range(horizon):
        pred = base.copy()
        for w, feature, cut, value in trees:
            pred[w] += value[np.arange(len(w)), _leaf_of(now[w], feature, cut, depth)]
        out[:, step] = np.where(rolled | (step == 0), pred, np.nan)
        now = np.concatenate([pred[:, None], now[:, :-1]], axis=1)
    return out


def _kernel(n_test: int, horizon: int, max_iter: int, max_depth: int, n_lags: int, chunk: int = 16):
    import numpy as np
    import pandas as pd

    def fits_of(values, n_train):
        """(lag rows, targets, learning flags, point, is future) of the fits of one scaled series."""
        n = len(values)
        rows = np.arange(n_lags, n)
        lags = np.stack([values[rows - i] for i in range(1, n_lags + 1)], axis=1)
        for t in range(max(n_train, n_lags + 1), n):  # a hold-out month with at least one row before it
            yield lags, values[rows], rows < t, lags[t - n_lags], t
        yield lags, values[rows], rows < n, values[-1:-n_lags - 1:-1], None

    def fitted(part):
        jobs = []
        for r in part.itertuples():
            v = np.asarray(r.y_all, dtype=float)
            scale = v[:r.n_train].mean() if r.n_train else 0.0
            if len(v) > n_lags and scale != 0 and np.isfinite(scale):
                jobs += [(r, scale, *f) for f in fits_of(v / scale, r.n_train)]
        if not jobs:
            return
        width = max(len(j[3]) for j in jobs)
        x = np.zeros((len(jobs), width, n_lags))
        y, live = np.zeros((len(jobs), width)), np.zeros((len(jobs), width), bool)
        for k, (_, _, lags, target, flag, _, _) in enumerate(jobs):
            x[k, :len(target)], y[k, :len(target)], live[k, :len(target)] = lags, target, flag
        rolled = np.array([j[6] is None for j in jobs])
        got = boost(x, y, live, np.array([j[5] for j in jobs]), rolled, horizon, max_iter, max_depth)
        out = []
        for (r, scale, _, _, _, _, t), p in zip(jobs, got):
            first = r.t_last - r.n + 1
            if t is not None:
                out.append((r.item_id, "test", first + t, p[0] * scale))
            else:
                out += [(r.item_id, "future", r.t_last + 1 + h, p[h] * scale) for h in range(horizon)]
        yield pd.DataFrame(out, columns=["item_id", "phase", "t", "yhat"])

    def run(batches):
        for pdf in batches:
            for lo in range(0, len(pdf), chunk):
                yield from isolated(fitted, pdf.iloc[lo:lo + chunk])
    return run


def boosted_lags(split: DataFrame, n_test: int = N_TEST, horizon: int = HORIZON, max_iter: int = MAX_ITER,
                 max_depth: int = MAX_DEPTH, n_lags: int = N_LAGS) -> DataFrame:
    """Long predictions (item_id, model, phase, t, ds, yhat)."""
    from ..series import month_start_of_index, spread
    rows = series_arrays(split).select("item_id", "n", "n_train", "t_last", "y_all")
    out = spread(rows, SERIES_PER_TASK).mapInPandas(_kernel(n_test, horizon, max_iter, max_depth, n_lags),
                                                    KERNEL_SCHEMA)
    return out.select("item_id", F.lit(MODEL).alias("model"), "phase", "t",
                      month_start_of_index(F.col("t")).alias("ds"), "yhat", "error")
