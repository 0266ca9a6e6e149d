"""Ranked lexical search of query texts in all documents: presence masks, evaluated by descending maximum score.

Terms are the maximal runs of ASCII letters and digits and of bytes beyond ASCII, A-Z lower-cased. The score of a document is
the sum, over a query's terms with repeats, of w * ((10**9 * tf) div (1000 * tf + 12 * m)) in 64-bit integers, where w is
floor(1000 * ln((2 N + 2) / (2 df + 1))) and m = 75 + ((25 * n * N) div L); N documents hold terms, L of them with
repeats, n in this document.

Shape: queries go through in blocks of about ``block_bytes`` of text, each block against all documents:

1. one pass turns chunks of documents into postings of the block's terms (document in the chunk, tf), written to the shared folder;
   tasks add up their document frequencies, one number per term moves;
2. per chunk and query, each term sets its bit in the masks of the documents it occurs in; documents with equal masks are
   one group. A group's maximum is the sum of its terms' largest values in the chunk. Groups are evaluated exactly, from the
   largest maximum down, until ``top`` documents are found that all score higher than what any group left can reach. A
   task carries its best ``top`` documents of each query from chunk to chunk and returns only those;
3. Spark ranks the tasks' best per query.

Only a block's query terms and their weights are broadcast, bounded by the block (a query's rows stay together).

Defined results: null text has no terms; documents of score 0 are never returned; equal scores go to the smaller id, null ids
last; repeated document rows are documents each; equal query rows count once, different texts under one item_id (null
included) are one query with all their terms; without terms on either side there are no rows. Other columns are dropped.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from demand.llm.common import LOWER_ARRAY, chunks, discard, flat, pack, string_array, text_bytes, texts, unpack, written, written_at

CHUNK_BYTES = 8 << 20
BLOCK_BYTES = 4 << 20
#: Letters and digits (lower-cased) and bytes beyond ASCII; all else is a space.
TERM_BYTES = np.where([b >= 128 or chr(b).isalnum() for b in range(256)], LOWER_ARRAY, 32).astype(np.uint8)
INDEX = "rows int, some long, terms long, ids binary, sizes binary, term binary, df binary, doc binary, tf binary"
INDEX_SCHEMA = pa.schema([("rows", pa.int32()), ("some", pa.int64()), ("terms", pa.int64()),
                          *[(x, pa.binary()) for x in ("ids", "sizes", "term", "df", "doc", "tf")]])


def split_terms(column):
    """(all terms as a string array, terms per text) of a string column without nulls."""
    data, offsets = flat(column)
    split = pc.ascii_split_whitespace(string_array(TERM_BYTES[data], offsets))
    values, bounds = split.flatten(), split.offsets.to_numpy()
    keep = pc.not_equal(values, "")
    before = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])
    return values.filter(keep), np.diff(before[bounds])


def _postings(block):
    """Chunks of documents -> one row of postings of the block's terms each."""

    def run(batches):
        vocabulary = pa.array(block.value["terms"], pa.large_string())
        for batch in chunks(batches, CHUNK_BYTES):
            terms, sizes = split_terms(batch.column("text"))
            number = pc.index_in(terms, value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            known = number >= 0
            key, tf = np.unique(number[known] * len(sizes) + doc[known], return_counts=True)
            term, df = np.unique(key // len(sizes), return_counts=True)
            ids = batch.column("doc_id")
            null = ids.is_null().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_pylist([{
                "rows": len(sizes), "some": int((sizes > 0).sum()), "terms": int(sizes.sum()),
                "ids": pack(np.stack([ids.fill_null(0).to_numpy(), null.astype(np.int64)]), np.int64), "sizes": pack(sizes, np.int64),
                "term": pack(term, np.int32), "df": pack(df, np.int32), "doc": pack(key % len(sizes), np.int32), "tf": pack(tf, np.int32)}], INDEX_SCHEMA)

    return run


def _frequencies(n_terms: int):
    """Document frequencies of a task's chunks: one row per term that occurs."""

    def run(batches):
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            for term, df in zip(batch.column("term").to_pylist(), batch.column("df").to_pylist(), strict=True):
                total[unpack(term, np.int32)] += unpack(df, np.int32)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], names=["term", "df"])

    return run


class Best:
    """The best ``top`` documents of one query so far: by score, then smaller id, null ids last."""

    def __init__(self, top: int):
        self.top = top
        self.score, self.null, self.id = (np.empty(0, np.int64) for _ in range(3))

    def add(self, score, null, id_) -> None:
        score, null, id_ = np.append(self.score, score), np.append(self.null, null), np.append(self.id, id_)
        first = np.lexsort((id_, null, -score))[:self.top]
        self.score, self.null, self.id = score[first], null[first], id_[first]

    def least(self) -> int:
        """What a document has to reach to get in (ties may)."""
        return int(self.score[-1]) if len(self.score) == self.top else 1


class Postings:
    """One chunk: per term that occurs its documents and their values w * saturation, and the largest of them."""

    def __init__(self, row: dict, weight: np.ndarray, n_docs: int, n_terms: int):
        self.ids, self.null = unpack(row["ids"], np.int64).reshape(2, -1)
        size, tf = unpack(row["sizes"], np.int64), unpack(row["tf"], np.int32).astype(np.int64)
        self.term, df = unpack(row["term"], np.int32), unpack(row["df"], np.int32)
        self.doc = unpack(row["doc"], np.int32)
        self.cut = np.concatenate([[0], np.cumsum(df, dtype=np.int64)])
        m = 75 + (25 * size * n_docs) // max(1, n_terms)
        self.value = np.repeat(weight[self.term], df) * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[self.doc]))
        self.most = np.maximum.reduceat(self.value, self.cut[:-1]) if len(df) else np.empty(0, np.int64)

    def masks(self, slots) -> np.ndarray:
        """Per document the bits of the terms at ``slots`` that it holds, 64 to a column."""
        masks = np.zeros((len(self.ids), -(-len(slots) // 64)), np.uint64)
        for j, s in enumerate(slots):
            masks[self.doc[self.cut[s]:self.cut[s + 1]], j // 64] |= np.uint64(1 << (j % 64))
        return masks

    def exact(self, docs, masks, slots, repeats) -> np.ndarray:
        """Scores of some documents with the given masks."""
        score = np.zeros(len(docs), np.int64)
        for j, (s, r) in enumerate(zip(slots, repeats, strict=True)):
            has = np.flatnonzero((masks[:, j // 64] >> np.uint64(j % 64)) & np.uint64(1))
            if len(has):
                a, b = self.cut[s], self.cut[s + 1]
                score[has] += r * self.value[a + np.searchsorted(self.doc[a:b], docs[has])]
        return score

    def search(self, terms: np.ndarray, repeats: np.ndarray, best: Best) -> int:
        """Add the chunk's documents that belong to the best of the query; returns how many were evaluated."""
        at = np.searchsorted(self.term, terms)
        here = np.flatnonzero(at < len(self.term))
        here = here[self.term[at[here]] == terms[here]]
        slots, repeats = at[here].tolist(), repeats[here].tolist()
        if not slots:
            return 0
        masks = self.masks(slots)
        docs = np.flatnonzero(masks.any(axis=1))
        masks = masks[docs]
        order = np.lexsort(masks.T)  # documents of one mask stand together, in ascending order
        docs, masks = docs[order], masks[order]
        first = np.flatnonzero(np.concatenate([[True], (masks[1:] != masks[:-1]).any(axis=1)]))
        size = np.diff(np.append(first, len(docs)))
        distinct = masks[first]
        most = np.zeros(len(first), np.int64)
        for j, (s, r) in enumerate(zip(slots, repeats, strict=True)):
            most += np.where((distinct[:, j // 64] >> np.uint64(j % 64)) & np.uint64(1), r * self.most[s], 0)
        descending = np.argsort(-most, kind="stable")
        most, done, evaluated = most[descending], 0, 0
        step = best.top
        while done < len(most) and most[done] >= best.least():
            # at least one group, more while they may still matter and hold at most `step` documents
            upto = max(done + 1, done + int(np.searchsorted(np.cumsum(size[descending[done:]]), step, side="right")))
            upto = min(upto, int(np.searchsorted(-most, -best.least(), side="right")))
            groups = descending[done:upto]
            rows = np.repeat(first[groups] - np.concatenate([[0], np.cumsum(size[groups])[:-1]]), size[groups]) + np.arange(int(size[groups].sum()))
            score = self.exact(docs[rows], masks[rows], slots, repeats)
            good = score >= best.least()
            best.add(score[good], self.null[docs[rows[good]]], self.ids[docs[rows[good]]])
            done, step, evaluated = upto, step * 2, evaluated + len(rows)
        return evaluated


def _best(block, item_type, top: int, n_docs: int, n_terms: int):
    """A task's best documents of every query over all its chunks."""

    def run(batches):
        queries, weight = block.value["queries"], block.value["weight"]
        best = [Best(top) for _ in queries]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                chunk = Postings(row, weight, n_docs, n_terms)
                for (_, terms, repeats), found in zip(queries, best, strict=True):
                    chunk.search(terms, repeats, found)
        for (item, _, _), found in zip(queries, best, strict=True):
            if n := len(found.score):
                yield pa.RecordBatch.from_arrays([
                    pa.array([item] * n, item_type), pa.array(found.id, pa.int64(), mask=found.null > 0), pa.array(found.score, pa.int64())],
                    names=["item_id", "doc_id", "score"])

    return run


def _queries(rows):
    """Terms of a block in order, and per query (item_id, term numbers ascending, repeats)."""
    texts_ = pa.array([r["text"] or "" for r in rows], pa.large_string())
    terms, sizes = split_terms(texts_)
    vocabulary = sorted(set(terms.to_pylist()), key=lambda x: x.encode())
    number = {x: i for i, x in enumerate(vocabulary)}
    all_terms = np.fromiter((number[x] for x in terms.to_pylist()), np.int64, len(terms))
    of_item: dict = {}
    for r, part in zip(rows, np.split(all_terms, np.cumsum(sizes)[:-1]), strict=True):
        of_item.setdefault(r["item_id"], []).append(part)
    return vocabulary, [(item, *np.unique(np.concatenate(parts), return_counts=True)) for item, parts in of_item.items()]


def search(docs: DataFrame, items: DataFrame, top: int = 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each query's ``top`` best documents with a score above 0."""
    from pyspark.sql.pandas.types import to_arrow_type
    docs = texts(docs)
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    items = items.select("item_id", "text").distinct()
    item = items.schema["item_id"]
    blocks = max(1, -(-text_bytes(items) // block_bytes))
    schema = StructType([item, StructField("doc_id", LongType()), StructField("score", LongType())])
    of_item = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    results = []
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()  # about block_bytes of query text
        vocabulary, queries = _queries(rows) if rows else ([], [])
        terms = sc.broadcast({"terms": vocabulary})
        index, path = written_at(docs.mapInArrow(_postings(terms), INDEX), "ranked-postings")
        sums = index.agg(F.sum("some").alias("n"), F.sum("terms").alias("l")).first()
        n, length = sums["n"] or 0, sums["l"] or 0
        df = np.zeros(len(vocabulary), np.int64)
        for r in index.select("term", "df").mapInArrow(_frequencies(len(vocabulary)), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
            df[r["term"]] = r["df"]
        weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        block = sc.broadcast({"queries": queries, "weight": weight})
        found = index.mapInArrow(_best(block, to_arrow_type(item.dataType), top, n, length), schema)
        ranked = found.withColumn("rank", F.row_number().over(of_item)).where(F.col("rank") <= top)
        results.append(written(ranked.select("item_id", "rank", "doc_id", "score"), "ranked-best"))
        discard(spark, path)
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
