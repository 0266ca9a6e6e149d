"""G1: Gram sums in Spark, batched small least-squares solves in Arrow batches.

A regression per series is reduced by Spark to its sufficient statistics
(X'X, X'y, y'y, n) with one ``groupBy`` -- a sum per pair of features,
combined map-side -- so each series costs one small row whatever its
length. The k x k systems (k <= 10) of a whole Arrow batch are then solved
together with stacked ``numpy.linalg.solve``; candidates (feature subsets)
are scored by AIC on the common sample and the best one kept.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gram_aggs(features: list[Column], target: Column, where: Column | None = None) -> list[Column]:
    """Aggregate expressions for X'X (upper triangle), X'y, y'y and n."""
    k = len(features)

    def s(expr):
        return F.sum(F.when(where, expr) if where is not None else expr)

    aggs = [s(features[i] * features[j]).alias(f"xx_{i}_{j}") for i, j in itertools.combinations_with_replacement(range(k), 2)]
    aggs += [s(features[i] * target).alias(f"xy_{i}") for i in range(k)]
    aggs += [s(target * target).alias("yy"),
             F.sum(F.when(where, F.lit(1)).otherwise(F.lit(0)) if where is not None else F.lit(1)).alias("n_obs")]
    return aggs


def gram_struct(k: int) -> Column:
    """Pack the Gram columns into arrays: xtx (k*k row-major), xty (k)."""
    xtx = []
    for i in range(k):
        for j in range(k):
            a, b = min(i, j), max(i, j)
            xtx.append(F.col(f"xx_{a}_{b}").cast("double"))
    return F.struct(F.array(*xtx).alias("xtx"), F.array(*[F.col(f"xy_{i}").cast("double") for i in range(k)]).alias("xty"),
                    F.col("yy").cast("double").alias("yy"), F.col("n_obs").cast("long").alias("n_obs"))


def solve_scaled(a, b, ok):
    """Solutions of the stacked systems a x = b for which ``ok`` holds, and which of them were well enough conditioned."""
    import numpy as np

    # Jacobi scaling (unit diagonal): the condition test and the solve
    # then do not depend on the units of the regressors
    diag = np.einsum("ijj->ij", a)
    ok = ok & np.isfinite(a).all(axis=(1, 2)) & np.isfinite(b).all(axis=1) & (diag > 0).all(axis=1)
    x = np.zeros(b.shape)
    with np.errstate(all="ignore"):
        d = 1.0 / np.sqrt(np.where(diag > 0, diag, 1.0))
        a_s = a * d[:, :, None] * d[:, None, :]
        cond = np.full(len(a), np.inf)
        if ok.any():
            cond[ok] = np.linalg.cond(a_s[ok])
    ok = ok & (cond < 1e10)
    if ok.any():
        x[ok] = np.linalg.solve(a_s[ok], (b * d)[ok][..., None])[..., 0] * d[ok]
    return x, ok


def solve_candidates(gram: DataFrame, keys: list[str], k: int, candidates: list[list[int]],
                     ridge: list[float] | None = None, derive=None) -> DataFrame:
    """Best candidate per row by AIC = n*ln(RSS/n) + 2*|candidate|.

    ``gram`` has the key columns and a ``g`` struct from :func:`gram_struct`.
    ``candidates`` are feature subsets ordered by preference on ties (fewer
    terms first). ``ridge`` adds a diagonal penalty (per feature). ``derive(xtx, n)``
    may return a (rows, k, features) array whose columns say how each feature
    of the candidates is made of the k Gram columns; without it they are the
    same. Output: keys, cand (index), beta array<double> (per feature, zeros
    outside the subset), raw array<double> (the same per Gram column), rss,
    n_obs. Rows with no solvable candidate, or whose solver raises, are dropped.
    """
    import numpy as np
    import pandas as pd

    features = k if derive is None else 1 + max(max(c) for c in candidates)
    pen = np.zeros(features) if ridge is None else np.asarray(ridge, dtype=float)
    cands = [np.asarray(c, dtype=int) for c in candidates]

    def solved(pdf):
        if pdf.empty:
            return
        try:
            yield from solved_together(pdf)
        except np.linalg.LinAlgError:  # one system of the batch: the others are solved alone, this one gets no row
            if len(pdf) > 1:
                for k in range(len(pdf)):
                    yield from solved(pdf.iloc[k:k + 1])

    def run(batches):
        for pdf in batches:
            yield from solved(pdf)

    def solved_together(pdf):
        m = len(pdf)
        xtx = np.stack([np.asarray(v, dtype=float) for v in pdf["xtx"]]).reshape(m, k, k)
        xty = np.stack([np.asarray(v, dtype=float) for v in pdf["xty"]])
        yy = pdf["yy"].to_numpy(dtype=float)
        n = pdf["n_obs"].to_numpy(dtype=float)
        made = np.broadcast_to(np.eye(k), (m, k, k)) if derive is None else derive(xtx, n)
        if derive is not None:
            xtx, xty = np.einsum("mia,mij,mjb->mab", made, xtx, made), np.einsum("mia,mi->ma", made, xty)
        best_aic = np.full(m, np.inf)
        best_c = np.full(m, -1)
        best_beta = np.zeros((m, features))
        best_rss = np.full(m, np.nan)
        for ci, idx in enumerate(cands):
            a = xtx[:, idx[:, None], idx[None, :]] + np.diag(pen[idx])[None, :, :]
            b = xty[:, idx]
            beta, ok = solve_scaled(a, b, n > len(idx))
            if not ok.any():
                continue
            rss = yy - 2 * np.einsum("ij,ij->i", beta, b) + np.einsum("ij,ijk,ik->i", beta, xtx[:, idx[:, None], idx[None, :]], beta)
            rss = np.maximum(rss, 1e-300)
            with np.errstate(all="ignore"):
                aic = n * np.log(rss / n) + 2 * len(idx)
            better = ok & (aic < best_aic)
            best_aic = np.where(better, aic, best_aic)
            best_c = np.where(better, ci, best_c)
            best_rss = np.where(better, rss, best_rss)
            full = np.zeros((m, features))
            full[:, idx] = beta
            best_beta = np.where(better[:, None], full, best_beta)
        keep = best_c >= 0
        if keep.any():
            out = pdf.loc[keep, keys].reset_index(drop=True)
            out["cand"] = best_c[keep].astype("int64")
            out["beta"] = list(best_beta[keep])
            out["raw"] = list(np.einsum("mka,ma->mk", made, best_beta)[keep])
            out["rss"] = best_rss[keep]
            out["n_obs"] = n[keep].astype("int64")
            yield out

    flat = gram.select(*keys, "g.xtx", "g.xty", "g.yy", "g.n_obs")
    key_types = ", ".join(f"{c} {flat.schema[c].dataType.simpleString()}" for c in keys)
    schema = f"{key_types}, cand long, beta array<double>, raw array<double>, rss double, n_obs long"
    return flat.mapInPandas(run, schema)
