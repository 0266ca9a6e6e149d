"""Approximate nearest neighbours: a forest of random-projection trees with one shared priority queue.

*Fit*: each tree splits a bounded sample (``sample_rows`` rows, the smallest hashes of vec_id) at the median of
the widest of ``directions`` random projections, down to ``leaves`` equal
leaves, as many at any size, so what a query's leaves return grows with the queries only. *Index*: every row is routed through every tree; rows of one (tree, leaf) and task are packed in one
blob. *Search*: a query walks all trees with one heap ordered by the summed squared margins of the splits it
left on the far side, and takes leaves until they hold ``inspect_share`` of all rows (rows met in two trees count
twice). *Rerank*: leaf blocks and their queries meet by (tree, leaf); matrix products rule out the rows that are
too far, exact double-precision distances are computed of the others and only the ``k`` best of each query and block go on to a final ranking.

Scale: the forest and the leaf counts are bounded by ``sample_rows`` and ``trees``. Leaves with many rows (copies)
are dealt to salts of ``block_rows`` rows and their queries repeated, queries of one leaf to blocks of
``query_block``. ``inspect_share`` is a share, so recall does not fall as the table grows; data with
near-uniform directions (neighbours hardly nearer than strangers) need a large one.

Defined results: vectors that are null, empty, of another length than most of the sample, zero, or with null or
non-finite components take no part; null ids neither; an id that occurs on several rows counts once, with its
nearest vector; distances beyond the largest double take no part. Other columns are not read. Ties go to the smaller id. With at most 4k ids all leaves of one tree are searched, so fewer than k
other ids are all found.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from demand.llm.common import hashed_sample, mix, span_index, written

CELLS = 1 << 22  # distances held at once
INDEX = "tree int, leaf int, n long, part long, ids binary, vectors binary"
PROBES = "tree int, leaf int, salt int, block int, query_id long, vector binary"
FOUND = "query_id long, vec_id long, score double"


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) with finite, non-zero vectors in double precision."""
    v = F.col("vector")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
            .where(F.col("vec_id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)))


def _grow(sample: np.ndarray, leaf: int, directions: int, rng) -> dict:
    """One tree as arrays; children < 0 are leaves (-1 - leaf number)."""
    normals, cuts, left, right = [], [], [], []
    leaves = 0
    todo = [(np.arange(len(sample)), -1, 0)]
    root = -1
    while todo:
        rows, parent, side = todo.pop()
        node = None
        if len(rows) > leaf:
            trial = rng.normal(size=(directions, sample.shape[1]))
            trial /= np.linalg.norm(trial, axis=1)[:, None]
            shadow = sample[rows] @ trial.T
            best = int(shadow.var(axis=0).argmax())
            cut = float(np.median(shadow[:, best]))
            below = shadow[:, best] <= cut
            if below.any() and not below.all():
                node = len(normals)
                normals.append(trial[best])
                cuts.append(cut)
                left.append(0)
                right.append(0)
                todo += [(rows[below], node, 0), (rows[~below], node, 1)]
        if node is None:
            leaves += 1
            node = -leaves
        if parent < 0:
            root = node
        else:
            (right if side else left)[parent] = node
    d = sample.shape[1]
    return {"normals": np.array(normals).reshape(-1, d), "cuts": np.array(cuts), "left": np.array(left, int),
            "right": np.array(right, int), "root": root, "leaves": leaves}


def fit_forest(vectors: DataFrame, trees: int = 8, leaves: int = 64, sample_rows: int = 32768,
               directions: int = 16, seed: int = 7) -> tuple[list[dict], int, int]:
    """(trees, dimension, number of usable rows); fitted on at most ``sample_rows`` rows."""
    total = vectors.count()
    sample = hashed_sample(vectors, sample_rows, "vec_id").select("vector").toPandas()["vector"]
    if not len(sample):
        return [], 0, 0
    dim = int(pd.Series([len(v) for v in sample]).mode()[0])
    data = np.array([v for v in sample if len(v) == dim], dtype=np.float64)
    leaf = max(4, -(-len(data) // leaves))
    rng = np.random.default_rng(seed)
    return [_grow(data, leaf, directions, rng) for _ in range(trees)], dim, total


def _route(tree: dict, data: np.ndarray) -> np.ndarray:
    node = np.full(len(data), tree["root"])
    while (inner := np.flatnonzero(node >= 0)).size:
        at = node[inner]
        below = np.einsum("ij,ij->i", data[inner], tree["normals"][at]) <= tree["cuts"][at]
        node[inner] = np.where(below, tree["left"][at], tree["right"][at])
    return -1 - node


def _matrix(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def index_rows(vectors: DataFrame, forest: list[dict], dim: int, kind: str = "<f8") -> DataFrame:
    """Every row of ``vectors`` in its leaf of every tree, packed per task and leaf as numbers of ``kind``."""

    def run(batches):
        for batch in batches:
            ids, data = batch.column("vec_id").to_numpy(), _matrix(batch.column("vector"), dim)
            if not len(ids):
                continue
            out = []
            for t, tree in enumerate(forest):
                leaf = _route(tree, data)
                order = np.argsort(leaf, kind="stable")
                cut = np.flatnonzero(np.diff(leaf[order])) + 1
                for rows in np.split(order, cut):
                    out.append((t, int(leaf[rows[0]]), len(rows), int(ids[rows[0]]), ids[rows].astype("<i8").tobytes(),
                                data[rows].astype(kind).tobytes()))
            yield pa.RecordBatch.from_pydict(dict(zip(["tree", "leaf", "n", "part", "ids", "vectors"], zip(*out), strict=True)),
                                             schema=pa.schema([("tree", pa.int32()), ("leaf", pa.int32()), ("n", pa.int64()),
                                                               ("part", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary())]))

    return vectors.where(F.size("vector") == dim).mapInArrow(run, INDEX)


def query_blocks(ids: np.ndarray, blocks: int) -> np.ndarray:
    """Block of each query by a hash of its id: ids with a common factor spread as well."""
    return (mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(blocks)).astype(np.int64)


def probe_leaves(queries: DataFrame, forest: list[dict], dim: int, counts: list[np.ndarray], budget: float,
                 block_rows: int, blocks: int) -> DataFrame:
    """The leaves that each query inspects, by one heap over all trees; a row per leaf and salt of the leaf."""
    salts = [np.maximum(1, -(-c // block_rows)) for c in counts]

    def run(batches):
        for batch in batches:
            ids, data = batch.column("vec_id").to_numpy(), _matrix(batch.column("vector"), dim)
            block_of = query_blocks(ids, blocks)
            margins = [tree["normals"] @ data.T - tree["cuts"][:, None] for tree in forest]
            out = []
            for q, (qid, vector) in enumerate(zip(ids.tolist(), data, strict=True)):
                heap = [(0.0, t, tree["root"]) for t, tree in enumerate(forest)]
                seen, raw, block = 0, vector.astype("<f8").tobytes(), int(block_of[q])
                while heap and seen < budget:
                    far, t, node = heapq.heappop(heap)
                    tree = forest[t]
                    while node >= 0:
                        m = margins[t][node, q]
                        near, other = (tree["left"][node], tree["right"][node]) if m <= 0 else (tree["right"][node], tree["left"][node])
                        heapq.heappush(heap, (far + m * m, t, int(other)))
                        node = near
                    leaf = -1 - int(node)
                    seen += counts[t][leaf]
                    out += [(t, leaf, s, block, qid, raw) for s in range(int(salts[t][leaf]))]
            if out:
                yield pa.RecordBatch.from_pydict(
                    dict(zip(["tree", "leaf", "salt", "block", "query_id", "vector"], zip(*out), strict=True)),
                    schema=pa.schema([("tree", pa.int32()), ("leaf", pa.int32()), ("salt", pa.int32()), ("block", pa.int32()),
                                      ("query_id", pa.int64()), ("vector", pa.binary())]))

    return queries.where(F.size("vector") == dim).mapInArrow(run, PROBES)


def nearest_in(ids: np.ndarray, data: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> pd.DataFrame:
    """The k nearest ids of one block to each query, exactly, each by its nearest row; a query's own id is left out.

    Matrix products find the rows that can be among them, with room for their rounding; distances of those are taken
    from the differences."""
    names, number = np.unique(ids, return_inverse=True)
    many = len(names) < len(ids)
    if many:
        order = np.argsort(number, kind="stable")
        data, number = data[order], number[order]
        ids = names
        head = np.flatnonzero(np.diff(number, prepend=-1))
        size = np.diff(head, append=len(number))
    else:
        head = size = None
    at = np.minimum(np.searchsorted(names, query_ids), len(names) - 1)
    own = np.flatnonzero(names[at] == query_ids)
    place = np.full(len(query_ids), -1)
    place[own] = at[own] if many else np.argsort(number)[at[own]]
    with np.errstate(over="ignore", invalid="ignore"):
        square, asked = np.einsum("ij,ij->i", data, data), np.einsum("ij,ij->i", queries, queries)
        slack = 128 * (data.shape[1] + 4) * np.finfo(np.float64).eps * (square.max() + asked) + np.finfo(np.float64).tiny
    out = []
    step = max(1, CELLS // len(data))
    for first in range(0, len(queries), step):
        some = slice(first, first + step)
        with np.errstate(over="ignore", invalid="ignore"):
            near = square + asked[some, None] - 2 * (queries[some] @ data.T)
        near[~np.isfinite(near)] = -np.inf
        if many:
            near = np.minimum.reduceat(near, head, axis=1)
        mine = np.flatnonzero(place[some] >= 0)
        near[mine, place[some][mine]] = np.inf
        last = np.partition(near, k - 1, axis=1)[:, k - 1] if near.shape[1] > k else np.full(len(near), np.inf)
        room = slack[some]  # without bound if squares are too large to tell: all rows are looked at
        most = np.where(np.isfinite(room), last, np.inf) + room
        for i, row in enumerate(near):
            few = np.flatnonzero((row <= most[i]) & (row < np.inf))
            rows = span_index(head[few], size[few]) if many else few
            with np.errstate(over="ignore"):
                score = np.sqrt(((data[rows] - queries[first + i]) ** 2).sum(axis=1))
            if many and len(few):
                score = np.minimum.reduceat(score, np.cumsum(size[few]) - size[few])
            real = np.isfinite(score)
            few, score = few[real], score[real]
            best = np.lexsort((ids[few], score))[:k]
            out.append((np.full(len(best), query_ids[first + i]), ids[few[best]], score[best]))
    return pd.DataFrame(dict(zip(["query_id", "vec_id", "score"], map(np.concatenate, zip(*out, strict=True)), strict=True)))


def search(df: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, trees: int = 8,
           leaves: int = 64, sample_rows: int = 32768, inspect_share: float = 1.0, block_rows: int = 8192,
           query_block: int = 16384) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found rows of each row for which ``is_query(id column)`` holds."""
    vectors = usable(df, id_col, vector_col)
    forest, dim, total = fit_forest(vectors, trees, leaves, sample_rows)
    found = df.sparkSession.createDataFrame([], FOUND)
    if forest:
        budget = max(inspect_share * total, 4 * k)
        if vectors.where(F.size("vector") == dim).select("vec_id").distinct().limit(4 * k + 1).count() <= 4 * k:
            forest, budget = forest[:1], float("inf")  # few ids: all rows
        kind = "<f4" if isinstance(df.schema[vector_col].dataType.elementType, FloatType) else "<f8"  # as given: nothing is lost
        index = written(index_rows(vectors, forest, dim, kind), "ann-index")
        counts = [np.zeros(t["leaves"], np.int64) for t in forest]  # at most trees x sample_rows / 4 numbers
        for r in index.groupBy("tree", "leaf").agg(F.sum("n").alias("n")).toLocalIterator():
            counts[r["tree"]][r["leaf"]] = r["n"]
        queries = vectors.where(is_query(F.col("vec_id")))
        blocks = max(1, -(-queries.count() // query_block))
        probes = probe_leaves(queries, forest, dim, counts, budget, block_rows, blocks)
        salts = index.groupBy("tree", "leaf").agg(F.greatest(F.lit(1), F.ceil(F.sum("n") / block_rows)).cast("int").alias("salts"))
        dealt = (index.join(salts, ["tree", "leaf"])
                 .select("tree", "leaf", F.pmod(F.xxhash64("part"), F.col("salts")).cast("int").alias("salt"),
                         F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "ids", "vectors"))

        def rerank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty or right.empty:
                return pd.DataFrame({"query_id": pd.Series([], dtype="int64"), "vec_id": pd.Series([], dtype="int64"),
                                     "score": pd.Series([], dtype="float64")})
            ids = np.frombuffer(b"".join(left["ids"]), "<i8")
            data = np.frombuffer(b"".join(left["vectors"]), kind).reshape(-1, dim).astype(np.float64)
            asked = np.frombuffer(b"".join(right["vector"]), "<f8").reshape(-1, dim)
            return nearest_in(ids, data, right["query_id"].to_numpy(), asked, k)

        key = ["tree", "leaf", "salt", "block"]
        found = dealt.groupBy(*key).cogroup(probes.groupBy(*key)).applyInPandas(rerank, FOUND)
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (best.withColumn("rank", F.row_number().over(rank).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
