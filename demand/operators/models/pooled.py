"""M4, pooled: one booster per forecast origin over the lag rows of all series (labelled XGBoost).

Series are scaled by their training mean and held as whole numbers (millionths of it), lags as one of ``bins``
quantile bins, so every sum is exact and independent of partitioning. Origins are the hold-out months (rows before
the origin are learned from, the origin's row is predicted from its actual lags) and the future (all rows; its
forecasts are rolled forward on their own predictions).

A level of a tree is one Spark job for all origins: each task adds the residuals of its rows up per (origin, node, lag,
bin), Spark sums those, and the best cuts are read from at most origins x nodes x lags x bins numbers. Trees go to
the tasks in the closure; the running predictions are checkpointed every ``TREES_PER_CUT`` trees. Nothing that grows
with the number of series leaves the tasks; origins are at most the months of the data.

Defined results: series without a positive finite training mean or with at most ``n_lags`` months take no part; an
origin without earlier rows gives no forecast; ties go to the smaller lag, then the smaller bin.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.constants import HORIZON, N_LAGS, N_TEST
from ...session import cut_lineage
from .boosted import LAMBDA, MODEL, RATE
from .holt_winters import series_arrays

ROUNDS = 40
DEPTH = 4
BINS = 32
UNIT = 1_000_000     # whole numbers per training mean
CELL = UNIT // 64    # width of the cells that bin edges are read from
CELLS = 4096
FUTURE = 1 << 30     # origin after every month
TREES_PER_CUT = 8
SERIES_PER_TASK = 2048
SERIES_PER_CHUNK = 512


@dataclass
class Tree:
    """One tree per origin: lag (0-based) and last bin that goes left per inner node, value per leaf."""
    lag: np.ndarray
    cut: np.ndarray
    value: np.ndarray | None = None

    def node(self, binned: np.ndarray, levels: int) -> np.ndarray:
        """(rows, origins): number of each row's node after ``levels`` levels, from (rows, lags) bins."""
        origins = np.arange(len(self.lag))
        node = np.zeros((len(binned), len(origins)), np.int64)
        for level in range(levels):
            at = 2 ** level - 1 + node
            seen = np.take_along_axis(binned, self.lag[origins, at], axis=1)
            node = 2 * node + (seen > self.cut[origins, at])
        return node

    def predicted(self, binned: np.ndarray, levels: int) -> np.ndarray:
        return self.value[np.arange(len(self.lag)), self.node(binned, levels)]


def scaled_series(split: DataFrame, n_lags: int = N_LAGS) -> DataFrame:
    """(item_id, t_last, n_train, scale, vals): one row per usable series, values in millionths of the training mean."""
    train = F.slice("y_all", 1, F.col("n_train"))
    rows = (series_arrays(split).filter((F.col("n") > n_lags) & (F.col("n_train") > 0))
            .withColumn("scale", F.aggregate(train, F.lit(0.0), lambda a, x: a + x) / F.col("n_train")))
    usable = (F.col("scale") > 0) & (F.col("scale") < float("inf")) & F.forall(
        "y_all", lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")))
    return rows.filter(usable).select(
        "item_id", F.col("t_last").cast("long").alias("t_last"), F.col("n_train").cast("long").alias("n_train"), "scale",
        F.transform("y_all", lambda y: F.floor(y / F.col("scale") * F.lit(float(UNIT)) + 0.5).cast("long")).alias("vals"))


def _cell(v):
    return F.least(F.lit(CELLS - 1), F.greatest(F.lit(0), F.floor(v / F.lit(CELL)))).cast("int")


def bin_of_cell(rows: DataFrame, bins: int) -> np.ndarray:
    """Bin of each cell by the share of training values in smaller cells (one aggregate of at most CELLS rows)."""
    train = rows.select(F.explode(F.slice("vals", 1, F.col("n_train").cast("int"))).alias("v"))
    count = np.zeros(CELLS, np.int64)
    for r in train.groupBy(_cell(F.col("v")).alias("cell")).count().collect():
        count[r["cell"]] = r["count"]
    return np.minimum(bins - 1, (count.cumsum() - count) * bins // max(1, count.sum()))


def origins_of(rows: DataFrame, n_lags: int) -> tuple[np.ndarray, np.ndarray]:
    """(origin months, mean of the targets before each), ascending; read from one row per month of the data."""
    n = F.size("vals")
    months = (rows.select("n_train", (F.col("t_last") - n + 1).alias("t0"), F.posexplode("vals").alias("pos", "v"))
              .filter(F.col("pos") >= n_lags)
              .groupBy((F.col("t0") + F.col("pos")).alias("t"))
              .agg(F.sum("v").alias("v"), F.count("*").alias("n"), F.max(F.col("pos") >= F.col("n_train")).alias("held")).collect())
    origins, base = [], []
    for o in sorted(r["t"] for r in months if r["held"]) + [FUTURE]:
        before = [r for r in months if r["t"] < o]
        if before:
            origins.append(o)
            base.append(int(np.floor(sum(r["v"] for r in before) / sum(r["n"] for r in before) + 0.5)))
    return np.array(origins, np.int64), np.array(base, np.int64)


def _list(column):
    """(values, offsets) of a list array."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    off = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]], off - off[0]


def _chunks(batches, bin_of: np.ndarray, n_lags: int):
    """Per chunk of series: (batch, series of each lag row, its month, its value, its bins, values, offsets)."""
    for batch in batches:
        for lo in range(0, batch.num_rows, SERIES_PER_CHUNK):
            part = batch.slice(lo, SERIES_PER_CHUNK)
            vals, off = _list(part.column("vals"))
            size = np.diff(off)
            series = np.repeat(np.arange(len(size)), size - n_lags)
            pos = np.concatenate([np.arange(n_lags, s) for s in size.tolist()])
            at = off[series] + pos
            cells = bin_of[np.clip(vals // CELL, 0, CELLS - 1)]
            binned = np.stack([cells[at - k] for k in range(1, n_lags + 1)], axis=1)
            month = part.column("t_last").to_numpy()[series] - size[series] + 1 + pos
            yield part, series, month, vals[at], binned, vals, off


def _sums(bin_of, origins, trees, partial, level, bins, depth, n_lags):
    """Task: residual sums and row counts of its rows per (origin, node, lag, bin) slot."""

    def run(batches):
        slots = len(origins) * 2 ** level * n_lags * bins
        g_sum, n_sum = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
        for part, _, month, value, binned, _, _ in _chunks(batches, bin_of, n_lags):
            f = _list(part.column("f"))[0].reshape(-1, len(origins))
            for tree in trees:
                f = f + tree.predicted(binned, depth)
            node = partial.node(binned, level)
            row, k = np.nonzero(month[:, None] < origins[None, :])
            residual = (value[row] - f[row, k]).astype(np.float64)
            first = (k * 2 ** level + node[row, k]) * n_lags
            for lag in range(n_lags):
                slot = (first + lag) * bins + binned[row, lag]
                g_sum += np.bincount(slot, weights=residual, minlength=slots).astype(np.int64)
                n_sum += np.bincount(slot, minlength=slots)
        some = np.flatnonzero(n_sum)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(g_sum[some]), pa.array(n_sum[some])], names=["slot", "g", "n"])

    return run


def best_cuts(g: np.ndarray, n: np.ndarray):
    """Best (lag, bin) per (origin, node) from sums (origins, nodes, lags, bins), and the sums on both sides of it."""
    left_g, left_n = g.cumsum(axis=3), n.cumsum(axis=3)
    all_g, all_n = left_g[:, :, :1, -1:], left_n[:, :, :1, -1:]
    right_g, right_n = all_g - left_g, all_n - left_n
    gain = left_g.astype(float) ** 2 / (left_n + LAMBDA) + right_g.astype(float) ** 2 / (right_n + LAMBDA)
    gain[(left_n == 0) | (right_n == 0)] = -1.0
    origins, nodes, _, bins = g.shape
    flat = gain.reshape(origins, nodes, -1)
    best = flat.argmax(axis=2)
    pick = lambda x: np.take_along_axis(x.reshape(origins, nodes, -1), best[:, :, None], axis=2)[:, :, 0]
    whole = all_g[:, :, 0, 0].astype(float) ** 2 / (all_n[:, :, 0, 0] + LAMBDA)
    split = pick(gain) > whole
    sides = [(np.where(split, pick(a), b[:, :, 0, 0]), np.where(split, pick(c), d[:, :, 0, 0])) for a, b, c, d in
             ((left_g, all_g, left_n, all_n), (right_g, 0 * all_g, right_n, 0 * all_n))]
    return np.where(split, best // bins, 0), np.where(split, best % bins, bins), sides


def _leaf(g, n):
    return np.floor(RATE * g.astype(float) / (n + LAMBDA) + 0.5).astype(np.int64)


def _grow(state: DataFrame, sums_of, origins: int, depth: int, bins: int, n_lags: int) -> Tree:
    tree = Tree(np.zeros((origins, 2 ** depth - 1), np.int64), np.full((origins, 2 ** depth - 1), bins, np.int64))
    for level in range(depth):
        got = (state.select("t_last", "vals", "f").mapInArrow(sums_of(tree, level), "slot long, g long, n long")
               .groupBy("slot").agg(F.sum("g").alias("g"), F.sum("n").alias("n")).toPandas())
        shape = (origins, 2 ** level, n_lags, bins)
        g, n = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        g.ravel()[got["slot"].to_numpy()], n.ravel()[got["slot"].to_numpy()] = got["g"].to_numpy(), got["n"].to_numpy()
        here = slice(2 ** level - 1, 2 ** (level + 1) - 1)
        tree.lag[:, here], tree.cut[:, here], sides = best_cuts(g, n)
        if level == depth - 1:
            tree.value = np.stack([_leaf(*side) for side in sides], axis=2).reshape(origins, -1)
    return tree


def _advance(bin_of, trees, origins, depth, n_lags):
    """Task: running predictions after ``trees``."""

    def run(batches):
        for part, series, _, _, binned, _, off in _chunks(batches, bin_of, n_lags):
            f = _list(part.column("f"))[0].reshape(-1, len(origins))
            for tree in trees:
                f = f + tree.predicted(binned, depth)
            ends = np.concatenate([[0], np.cumsum(np.diff(off) - n_lags)]) * len(origins)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(f.ravel()))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ("item_id", "t_last", "n_train", "scale", "vals")], lists],
                                             names=["item_id", "t_last", "n_train", "scale", "vals", "f"])

    return run


def _forecasts(bin_of, origins, base, trees, horizon, depth, n_lags):
    """Task: hold-out forecasts from the running predictions, future ones rolled forward tree by tree."""
    ahead = len(origins) - 1  # the future is the last origin

    def run(batches):
        for part, series, month, _, _, vals, off in _chunks(batches, bin_of, n_lags):
            ids, scale, t_last = (part.column(c).to_numpy() for c in ("item_id", "scale", "t_last"))
            f = _list(part.column("f"))[0].reshape(-1, len(origins))
            held = month > (t_last - np.diff(off) + part.column("n_train").to_numpy())[series]
            k = np.minimum(np.searchsorted(origins, month), ahead)
            row = np.flatnonzero(held & (origins[k] == month))
            out = [(ids[series[row]], np.full(len(row), "test"), month[row], f[row, k[row]] / UNIT * scale[series[row]])]
            now = np.stack([vals[off[1:] - 1 - j] for j in range(n_lags)], axis=1)
            for step in range(1, horizon + 1):
                binned = bin_of[np.clip(now // CELL, 0, CELLS - 1)]
                got = np.full(len(now), base[ahead], np.int64)
                for tree in trees:
                    got = got + tree.value[ahead, tree.node(binned, depth)[:, ahead]]
                out.append((ids, np.full(len(ids), "future"), t_last + step, got / UNIT * scale))
                now = np.concatenate([got[:, None], now[:, :-1]], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                             names=["item_id", "phase", "t", "yhat"])

    return run


def pooled_lags(split: DataFrame, n_test: int = N_TEST, horizon: int = HORIZON, rounds: int = ROUNDS, depth: int = DEPTH,
                bins: int = BINS, n_lags: int = N_LAGS) -> DataFrame:
    """Long predictions (item_id, model, phase, t, ds, yhat); ``n_test`` is the split's own."""
    from ..series import month_start_of_index, spread
    rows = cut_lineage(spread(scaled_series(split, n_lags), SERIES_PER_TASK))
    bin_of = bin_of_cell(rows, bins)
    origins, base = origins_of(rows, n_lags)
    found = split.sparkSession.createDataFrame([], "item_id long, phase string, t long, yhat double")
    if len(origins):
        start = F.flatten(F.array_repeat(F.array(*[F.lit(int(b)).cast("long") for b in base]), F.size("vals") - n_lags))
        state = rows.withColumn("f", start)
        schema, trees, done = state.schema, [], 0
        for _ in range(rounds):
            pending = trees[done:]
            trees.append(_grow(state, lambda tree, level: _sums(bin_of, origins, pending, tree, level, bins, depth, n_lags),  # noqa: B023
                               len(origins), depth, bins, n_lags))
            if len(trees) - done >= TREES_PER_CUT or len(trees) == rounds:
                state = cut_lineage(state.mapInArrow(_advance(bin_of, trees[done:], origins, depth, n_lags), schema))
                done = len(trees)
        found = state.mapInArrow(_forecasts(bin_of, origins, base, trees, horizon, depth, n_lags), found.schema)
    return found.select("item_id", F.lit(MODEL).alias("model"), "phase", "t", month_start_of_index(F.col("t")).alias("ds"), "yhat")
