"""Token-id shards compressed by Re-Pair grammars, with random-access decoding.

Documents are ordered by doc_id (nulls first; equal ids by text) over range partitions; a *shard* is a bounded chunk
of one partition. In a shard, Re-Pair counts all adjacent id pairs, replaces the most frequent ones by new
nonterminals (left to right, without overlaps), and does so again on the shorter sequence until
no pair occurs ``least`` times. A shard row holds the rules, the expansion length of each, the sequence and
the documents' lengths; ids from ``a`` to ``b`` decode from the symbols that cover them, found by the running sum
of expansion lengths. Shards are written by Spark's Parquet writer to the shared folder.

Many pairs are replaced per round (at most ``per_round``, the most frequent), counted exactly: a table of hashed pairs only
leaves out places whose slot has fewer than ``least`` pairs. Pairs that overlap take every other place, so the grammar may
differ from one-pair-at-a-time Re-Pair; the decoded ids never do.

Defined results: a null text is empty and has just the end id; repeated rows are kept. Other columns are dropped.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demand.llm.common import bucket_count, chunks, pack, span_index, text_bytes, texts, unpack, written
from demand.llm.tokenizing import encode, with_end

SHARDS = "part int, shard int, n_tokens long, n_docs long, base long, rules binary, expansion binary, sequence binary, docs binary"
SHARD_SCHEMA = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_tokens", pa.int64()), ("n_docs", pa.int64()), ("base", pa.int64()),
                          *[(x, pa.binary()) for x in ("rules", "expansion", "sequence", "docs")]])
SLOTS = 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _slots(pair: np.ndarray) -> np.ndarray:
    return (pair * MULTIPLIER >> np.uint64(64 - SLOTS)).astype(np.int64)


def _find(name: np.ndarray, pair: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indices of the pairs that are among the sorted ``name``, index of the name of each); ``slot`` is theirs."""
    here = _slots(name)
    first = np.full(1 << SLOTS, -1, np.int32)
    first[here] = np.arange(len(name))
    rule = first[slot]
    some = np.flatnonzero(rule >= 0)
    rule = rule[some]
    miss = np.flatnonzero(name[rule] != pair[some])  # another name may share the slot
    rule[miss] = np.minimum(np.searchsorted(name, pair[some[miss]]), len(name) - 1)
    mine = name[rule] == pair[some]
    return some[mine], rule[mine]


def compress(ids: np.ndarray, base: int, rounds: int | None = None, per_round: int = 8192, least: int = 8):
    """(rules as pairs of symbols, expansion length per rule, sequence); symbol base + i is rule i."""
    seq = ids.astype(np.uint32)
    rules, length = np.empty((0, 2), np.uint32), np.empty(0, np.int64)
    done, most = 0, per_round
    place = np.arange(max(len(seq) - 1, 0))  # a rare pair never gets more frequent: its places stay out until a neighbour is replaced
    while len(place) and (rounds is None or done < rounds):
        pair = seq[place].astype(np.uint64)
        pair <<= np.uint64(32)
        pair |= seq[place + 1]
        slot = _slots(pair)
        done += 1
        often = (np.bincount(slot, minlength=1 << SLOTS) >= least)[slot]  # no frequent pair is outside these slots
        place, pair, slot = place[often], pair[often], slot[often]
        near = np.sort(pair)
        head = np.flatnonzero(np.concatenate([[True], near[1:] != near[:-1]])) if len(near) else np.empty(0, np.int64)
        count = np.diff(np.append(head, len(near)))
        name, count = near[head][count >= least], count[count >= least]
        if not len(name):
            break
        best = np.sort(np.argsort(-count, kind="stable")[:most])
        name = name[best]
        chosen, rule = _find(name, pair, slot)
        at = place[chosen]  # every other place of a run of overlapping pairs is taken
        head = np.concatenate([[True], np.diff(at) > 1])
        rank = np.arange(len(at)) - np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
        even = rank & 1 == 0
        at, rule = at[even], rule[even]
        worth = np.bincount(rule, minlength=len(name)) >= max(least // 2, 1)
        if not worth.any():  # pairs took each other's places: fewer of them, at last the most frequent alone
            most = max(1, min(most, len(name)) // 8)
            continue
        most = per_round
        if not worth.all():
            at, rule = at[worth[rule]], rule[worth[rule]]
        new = name[worth]
        left, right = (new >> np.uint64(32)).astype(np.uint32), (new & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        size = lambda s: np.where(s < base, 1, np.append(length, 0)[np.maximum(s.astype(np.int64) - base, -1)])
        seq[at] = (base + len(rules) + np.cumsum(worth) - 1).astype(np.uint32)[rule]
        kept, open_ = np.ones(len(seq), bool), np.zeros(len(seq), bool)
        kept[at + 1] = False
        open_[place] = True
        open_[at] = True
        open_[np.maximum(at - 1, 0)] = True
        length = np.concatenate([length, size(left) + size(right)])
        rules = np.concatenate([rules, np.stack([left, right], axis=1)])
        seq = seq[kept]
        place = np.flatnonzero(open_[kept][:-1])
    return rules, length, seq


def expand(seq: np.ndarray, rules: np.ndarray, base: int, length: np.ndarray | None = None) -> np.ndarray:
    """The ids of a sequence of symbols; with the rules' expansion lengths each rule is expanded once."""
    seq = seq.astype(np.uint32)
    if length is not None:
        known = np.concatenate([np.arange(base, dtype=np.uint32), expand(np.arange(base, base + len(rules)), rules, base)])
        stop = base + np.cumsum(length)
        first, size = np.concatenate([np.arange(base), stop - length]), np.concatenate([np.ones(base, np.int64), length])
        return known[span_index(first[seq], size[seq])]
    while (deep := seq >= base).any():
        out = np.repeat(seq, 1 + deep)
        at = (np.cumsum(1 + deep) - 1)[deep]
        rule = rules[seq[deep] - np.uint32(base)]
        out[at - 1], out[at] = rule[:, 0], rule[:, 1]
        seq = out
    return seq


def decode_range(seq: np.ndarray, rules: np.ndarray, length: np.ndarray, base: int, a: int, b: int) -> np.ndarray:
    """Ids a .. b-1 of a shard, from the symbols that cover them."""
    size = np.where(seq < base, 1, np.append(length, 0)[np.maximum(seq.astype(np.int64) - base, -1)])
    stop = np.cumsum(size)
    i, j = int(np.searchsorted(stop, a, side="right")), int(np.searchsorted(stop, b, side="left"))
    before = int(stop[i] - size[i]) if i < len(seq) else 0
    return expand(seq[i:j + 1], rules, base)[a - before:b - before]


def encode_shards(docs: DataFrame, path: str, end_id: int, base: int, shard_bytes: int = 8 << 20) -> DataFrame:
    """Shard rows of all documents in ascending doc_id order."""
    docs = texts(docs)
    n = bucket_count(text_bytes(docs), 2 * shard_bytes)
    tie = F.xxhash64("text")
    ordered = docs.withColumn("tie", tie).repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        for shard, batch in enumerate(chunks(batches, shard_bytes)):
            ids, count = with_end(*encode(batch.column("text"), path, spaced=True), end_id)
            rules, length, seq = compress(ids, base)
            doc = batch.column("doc_id")
            table = np.stack([doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False), count], axis=1)
            yield pa.RecordBatch.from_pylist([{
                "part": part, "shard": shard, "n_tokens": len(ids), "n_docs": len(count), "base": base, "rules": pack(rules, "<u4"),
                "expansion": pack(length, "<i8"), "sequence": pack(seq, "<u4"), "docs": pack(table, "<i8")}], SHARD_SCHEMA)

    return ordered.mapInArrow(run, SHARDS)


def shard_starts(shards: DataFrame) -> DataFrame:
    """``shards`` with ``start``, the ids of all shards before: a running sum over one short row per shard."""
    order = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("part", "shard", "n_tokens").withColumn("start", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
    return shards.join(starts.drop("n_tokens"), ["part", "shard"])


def decoded(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the shards' decoded ids."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                docs = unpack(row["docs"], "<i8").reshape(-1, 3)
                rules, length = unpack(row["rules"], "<u4").reshape(-1, 2), unpack(row["expansion"], "<i8")
                ids = expand(unpack(row["sequence"], "<u4"), rules, row["base"], length).astype("<u4")
                if len(ids) != row["n_tokens"]:
                    raise ValueError("a shard decodes to another length")
                raw, stop = memoryview(ids.tobytes()), np.cumsum(docs[:, 2])
                first = stop - docs[:, 2]
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(first.tolist(), stop.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs[:, 0], mask=docs[:, 1] == 1), pa.array(row["start"] + first), pa.array(docs[:, 2]), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shard_starts(shards).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str, end_id: int, base: int) -> DataFrame:
    """Write the shards, read them back and decode them."""
    return decoded(written(encode_shards(docs, path, end_id, base), "repair-shards"))
