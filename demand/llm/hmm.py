"""Language-model scoring with a hidden Markov model trained on the whole corpus by Baum-Welch.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of the text (A-Z lower-cased) and one end token. Training has two steps.
``iterations`` Baum-Welch passes over all training documents find the states with tied emissions: words hashed to
``classes`` classes share them. A last pass unties them: the expected counts of every single word in every state are
added up over the corpus and become that word's own weights, P(word | state) = (1 - MIX) * W(word, state) / W(state)
+ MIX * (c + 1) / (N + V + 1), with corpus counts c and W = c times the word's state shares, kept in 1/255; one place is
left for unknown words, so each state's probabilities add up to 1. A text's score is the exact log10 likelihood of that
model by the scaled forward recursion.

Shape: one pass turns bounded chunks of documents into *stores* (word numbers and classes per chunk, written once to the
shared folder) and into (word, training count) lists per bucket of words. Passes read the stores in place; only the last
one sends words' shares to the buckets, which add them up over all chunks and answer each chunk with its words' counts and
shares. What the model holds grows with the vocabulary and never leaves the buckets; the driver sees states x classes sums.

Defined results: a null text has only the end token; repeated rows are scored (and counted) each; null ids are
never held out; without training documents all counts are 0 and every token has probability 1. Other columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demand.llm.common import (LOWER_ARRAY, bucket_count, chunks, flat, lean, lean_group, pack, piece_hashes, span_index,
                               string_array, text_bytes, texts, unpack, written)

MIX = 0.2
CLASSES = 4096
LEVELS = 255  # a word's state shares are kept in whole parts of this
CHUNK_BYTES = 6 << 20
PARTS = "kind int, bucket int, chunk long, a binary, b binary, c binary, d binary"
PART_SCHEMA = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int64()), *[(x, pa.binary()) for x in "abcd"]])
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def tokens(column):
    """(distinct words as a string array, word number of each token, tokens per text) of a column without nulls."""
    data, offsets = flat(column)
    split = pc.ascii_split_whitespace(string_array(LOWER_ARRAY[data], offsets))
    values, bounds = split.flatten(), split.offsets.to_numpy()
    keep = pc.not_equal(values, "")
    count = np.add.reduceat(np.append(keep.to_numpy(zero_copy_only=False), False).astype(np.int64), bounds[:-1])
    count[np.diff(bounds) == 0] = 0
    coded = values.filter(keep).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), count


def _parts(buckets: int, classes: int):
    """Chunks of documents -> one store row (kind 0) and one row of words per bucket (kind 1)."""

    def run(batches):
        from pyspark import TaskContext
        chunk = TaskContext.get().partitionId() << 32
        for batch in chunks(batches, CHUNK_BYTES):
            words, number, count = tokens(batch.column("text"))
            train = batch.column("train").to_numpy(zero_copy_only=False)
            hashed = piece_hashes(*flat(words)) if len(words) else np.empty(0, np.uint64)
            bucket = (hashed % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")  # words are kept in bucket order, so answers need no places
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            number = place[number]
            words, hashed, bucket = words.take(pa.array(order)), hashed[order], bucket[order]
            own = ((hashed >> np.uint64(20)) % np.uint64(classes)).astype(np.uint16)
            seen = np.bincount(number[np.repeat(train, count)], minlength=len(words))
            cut = np.searchsorted(bucket, np.arange(buckets + 1))
            ids = batch.column("doc_id").fill_null(-1).to_numpy()
            null = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_pylist([{
                "kind": 0, "bucket": 0, "chunk": chunk, "a": pack(number, np.uint32), "b": pack(own),
                "c": pack(np.stack([ids, count, train.astype(np.int64) + 2 * null], axis=1), np.int64), "d": pack(np.diff(cut), np.uint32)}], PART_SCHEMA)
            rows = []
            for b in np.flatnonzero(np.diff(cut)).tolist():
                part = words.slice(cut[b], cut[b + 1] - cut[b])
                text, at = flat(part)
                rows.append({"kind": 1, "bucket": b, "chunk": chunk, "a": pack(text.tobytes()), "b": pack(np.diff(at), np.uint32),
                             "c": pack(seen[cut[b]:cut[b + 1]], np.uint32), "d": b""})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, PART_SCHEMA)
            chunk += 1

    return lean(run)


def _count(states: int):
    """One bucket: counts and state shares of its words over all chunks; an answer per chunk (kind 2) and sums (kind 3).

    The group of bucket -1 has no words but the chunks' expected states of the end token."""

    def run(key, lists, shares):
        bucket = key[0].as_py()
        rows = []
        if bucket < 0:
            total = sum((unpack(a, np.float64) for a in shares.column("a").to_pylist()), np.zeros(states))
            rows = [(3, -1, pack(total), b"")]
        elif lists.num_rows:
            of = dict(zip(shares.column("chunk").to_pylist(), shares.column("a").to_pylist(), strict=True))
            words, sizes, seen, share = [], [], [], []
            for chunk, a, b, c in zip(*[lists.column(x).to_pylist() for x in ("chunk", "a", "b", "c")], strict=True):
                n = unpack(b, np.uint32)
                words.append(string_array(unpack(a), np.concatenate([[0], np.cumsum(n.astype(np.int64))])))
                sizes.append(len(n))
                seen.append(unpack(c, np.uint32).astype(np.int64))
                share.append(whole_shares(unpack(of[chunk], np.uint8).reshape(-1, states - 1)))
            coded = pa.chunked_array(words).combine_chunks().dictionary_encode()
            number, seen, share = coded.indices.to_numpy(zero_copy_only=False), np.concatenate(seen), np.concatenate(share)
            size = len(coded.dictionary)
            total = np.bincount(number, weights=seen, minlength=size).astype(np.int64)
            weight = np.stack([np.bincount(number, weights=seen * share[:, k], minlength=size) for k in range(states)], axis=1)
            share = levels(weight / np.maximum(weight.sum(axis=1, keepdims=True), 1))
            sums = np.concatenate([[total.sum(), (total > 0).sum()], (total[:, None] * whole_shares(share)).sum(axis=0)])
            cut = np.cumsum(sizes)[:-1]
            rows = [(3, -1, pack(sums, np.int64), b"")] + [
                (2, chunk, pack(a, np.int64), pack(b, np.uint8)) for chunk, a, b in
                zip(lists.column("chunk").to_pylist(), np.split(total[number], cut), np.split(share[number], cut), strict=True)]
        return pa.Table.from_pylist([{"kind": k, "bucket": bucket, "chunk": c, "a": a, "b": b, "c": b"", "d": b""} for k, c, a, b in rows], PART_SCHEMA)

    return lean_group(run)


def levels(share: np.ndarray) -> np.ndarray:
    """Shares of all states but the first, in whole parts of LEVELS."""
    return np.rint(share[:, 1:] * LEVELS).astype(np.uint8)


def whole_shares(part: np.ndarray) -> np.ndarray:
    """(words, states) parts: the first state has what the others leave of LEVELS."""
    part = part.astype(np.int64)
    return np.concatenate([np.maximum(0, LEVELS - part.sum(axis=1, keepdims=True)), part], axis=1)


class Model:
    """start (K), move (K x K) and emit (K x classes + 1) of the chain; the last class is the end token."""

    def __init__(self, states: int, classes: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.start = np.full(states, 1 / states)
        self.move = np.full((states, states), 0.1 / max(1, states - 1))
        np.fill_diagonal(self.move, 0.9 if states > 1 else 1.0)
        emit = np.exp(rng.normal(size=(states, classes + 1)))
        emit[:, -1] = emit.mean()
        self.emit = emit / emit.sum(axis=1, keepdims=True)

    def learned(self, start, move, emit, prior: float = 1.0):
        """The next model from expected counts; the prior keeps every probability above 0."""
        out = Model.__new__(Model)
        out.start = (start + prior) / (start + prior).sum()
        out.move = (move + prior) / (move + prior).sum(axis=1, keepdims=True)
        unigram = emit.sum(axis=0) + 1e-3
        emit = emit + prior * len(unigram) * 0.01 * unigram / unigram.sum()
        out.emit = emit / emit.sum(axis=1, keepdims=True)
        return out


def by_time(count: np.ndarray):
    """Places of tokens in time order (step 0 of all texts, longest first, then step 1, ...): (place, active per step)."""
    order = np.argsort(-count, kind="stable")
    size = count[order]
    active = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right")
    first = (np.cumsum(count) - count)[order]
    step = np.repeat(np.arange(len(active)), active)
    return order, first[span_index(np.zeros(len(active), np.int64), active)] + step, active


def forward(model: Model, emitted: np.ndarray, active: np.ndarray):
    """Scaled forward recursion over time-ordered emissions: (alpha rows, scale per token)."""
    n = int(active.sum())
    alpha = np.empty((n, len(model.start)))
    scale = np.empty(n)
    at, last = 0, None
    for m in active.tolist():
        a = emitted[at:at + m] * (model.start if last is None else last[:m] @ model.move)
        s = a.sum(axis=1)
        a /= s[:, None]
        alpha[at:at + m], scale[at:at + m] = a, s
        last, at = a, at + m
    return alpha, scale


def expected(model: Model, classes: np.ndarray, active: np.ndarray):
    """Expected counts of starts, moves and emissions of time-ordered class numbers, and each token's state probabilities."""
    emitted = model.emit.T[classes]
    alpha, scale = forward(model, emitted, active)
    k = len(model.start)
    move, emit = np.zeros((k, k)), np.zeros(model.emit.shape)
    gamma = np.empty_like(alpha)
    end = len(classes)
    beta = None  # scaled backward value of the step after, for the texts active there
    for t in range(len(active) - 1, -1, -1):
        m = int(active[t])
        at = end - m
        now = np.ones((m, k))
        if beta is not None:
            n = len(beta)
            ahead = emitted[end:end + n] * beta / scale[end:end + n, None]
            move += alpha[at:at + n].T @ ahead
            now[:n] = ahead @ model.move.T
        gamma[at:end] = alpha[at:end] * now
        beta, end = now, at
    for i in range(k):
        emit[i] = np.bincount(classes, weights=gamma[:, i], minlength=emit.shape[1])
    return gamma[:int(active[0])].sum(axis=0) if len(active) else np.zeros(k), move * model.move, emit, gamma


def _sequences(a: bytes, b: bytes, c: bytes, end_class: int):
    """(document table, token number incl. -1 for ends, class per token, tokens per text) of a store."""
    number, own, docs = unpack(a, np.uint32).astype(np.int64), unpack(b, np.uint16).astype(np.int64), unpack(c, np.int64).reshape(-1, 3)
    size = docs[:, 1] + 1
    full = np.full(int(size.sum()), -1, np.int64)
    full[span_index(np.cumsum(size) - size, docs[:, 1])] = number
    cls = np.append(own, end_class)[full]
    return docs, full, cls, size


def _expect(model: Model, end_class: int):
    def run(batches):
        k, c = model.emit.shape
        start, move, emit, some = np.zeros(k), np.zeros((k, k)), np.zeros((k, c)), False
        for batch in batches:
            for a, b, d in zip(*[batch.column(x).to_pylist() for x in "abc"], strict=True):
                docs, _, cls, size = _sequences(a, b, d, end_class)
                train = docs[:, 2] % 2 == 1
                cls, size = cls[np.repeat(train, size)], size[train]
                if not len(size):
                    continue
                _, place, active = by_time(size)
                s, m, e, _ = expected(model, cls[place], active)
                start, move, emit, some = start + s, move + m, emit + e, True
        if some:  # one row per state and kind of count
            rows = [start] + list(move) + list(emit)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), pa.array(rows, pa.list_(pa.float64()))], names=["row", "sums"])

    return lean(run)


def _untie(model: Model, end_class: int):
    """Chunks -> per bucket the state shares of their words, and (bucket -1) the expected states of the end token."""
    states = len(model.start)

    def run(batches):
        for batch in batches:
            for chunk, a, b, c, d in zip(*[batch.column(x).to_pylist() for x in ("chunk", "a", "b", "c", "d")], strict=True):
                docs, number, cls, size = _sequences(a, b, c, end_class)
                words = len(unpack(b, np.uint16))
                train = docs[:, 2] % 2 == 1
                keep = np.repeat(train, size)
                number, cls, size = number[keep], cls[keep], size[train]
                found = np.zeros((words + 1, states))
                if len(size):
                    _, place, active = by_time(size)
                    number, gamma = number[place] % (words + 1), expected(model, cls[place], active)[3]  # the end is after all words
                    found = np.stack([np.bincount(number, weights=gamma[:, k], minlength=words + 1) for k in range(states)], axis=1)
                part = levels(found[:-1] / np.maximum(found[:-1].sum(axis=1, keepdims=True), 1e-9))
                cut = np.concatenate([[0], np.cumsum(unpack(d, np.uint32).astype(np.int64))])
                rows = [(-1, pack(found[-1]))] + [(k, pack(part[cut[k]:cut[k + 1]], np.uint8)) for k in np.flatnonzero(np.diff(cut)).tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int64()),
                                                  pa.array([x for _, x in rows], pa.binary())], names=["bucket", "chunk", "a"])

    return lean(run)


def emissions(weight: np.ndarray, size: np.ndarray, unigram: np.ndarray) -> np.ndarray:
    """P(word | state) per word: its weight among the state's, mixed with the corpus; a state without weights has the corpus alone."""
    have = size > 0
    return np.where(have, (1 - MIX) / np.where(have, size, 1.0), 0.0) * weight + np.where(have, MIX, 1.0) * unigram[:, None]


def train(store: DataFrame, states: int, classes: int, iterations: int) -> Model:
    """Baum-Welch over all stores; per iteration each task returns 1 + 2 x states rows of sums."""
    model = Model(states, classes)
    for _ in range(iterations):
        sums = (store.select("a", "b", "c").mapInArrow(_expect(model, classes), "row int, sums array<double>")
                .select("row", F.posexplode("sums").alias("i", "x")).groupBy("row", "i").agg(F.sum("x").alias("x")).toPandas())
        if sums.empty:
            return model
        counts = [np.zeros(states), np.zeros((states, states)), np.zeros((states, classes + 1))]
        row, i, x = sums["row"].to_numpy(), sums["i"].to_numpy(), sums["x"].to_numpy()
        counts[0][i[row == 0]] = x[row == 0]
        mid, last = (row > 0) & (row <= states), row > states
        counts[1][row[mid] - 1, i[mid]] = x[mid]
        counts[2][row[last] - 1 - states, i[last]] = x[last]
        model = model.learned(*counts)
    return model


def score(docs: DataFrame, held_out: Column, states: int = 4, classes: int = CLASSES, iterations: int = 4) -> DataFrame:
    """One row per document: held_out, n_tokens, n_known, train_tokens, base_score (unigram) and score (the chain)."""
    docs = texts(docs.withColumn("train", ~F.coalesce(held_out, F.lit(False))), "train")
    buckets = bucket_count(text_bytes(docs))
    parts = written(docs.mapInArrow(_parts(buckets, classes), PARTS), "hmm-parts", "kind")
    store = parts.where("kind = 0").select("chunk", "a", "b", "c", "d")
    model = train(store, states, classes, iterations)
    shares = store.mapInArrow(_untie(model, classes), "bucket int, chunk long, a binary")
    lists = parts.where("kind = 1").select("bucket", "chunk", "a", "b", "c")
    counted = written(lists.groupBy("bucket").cogroup(shares.groupBy("bucket")).applyInArrow(_count(states), PARTS), "hmm-counts", "kind")

    total, kinds, size, end = 0, 0, np.zeros(states), np.zeros(states)
    for r in counted.where("kind = 3").select("bucket", "a").toLocalIterator():  # 2 + states numbers a bucket
        if r["bucket"] < 0:
            end = unpack(r["a"], np.float64)
        else:
            sums = unpack(r["a"], np.int64)
            total, kinds, size = total + int(sums[0]), kinds + int(sums[1]), size + sums[2:] / LEVELS
    ends = docs.where("train").count()
    total, kinds, size = total + ends, kinds + (ends > 0), size + end
    log_total = float(np.log10(total + kinds + 1))

    def finish(key, mine, answers):
        out = []
        by_bucket = sorted(zip(*[answers.column(x).to_pylist() for x in ("bucket", "a", "b")], strict=True))
        count = np.concatenate([np.empty(0, np.int64), *[unpack(x, np.int64) for _, x, _ in by_bucket], [ends]])
        part = np.concatenate([np.empty((0, states - 1), np.uint8), *[unpack(x, np.uint8).reshape(-1, states - 1) for _, _, x in by_bucket]])
        weight = np.concatenate([count[:-1, None] * whole_shares(part) / LEVELS, end[None]])
        emit = emissions(weight, size, (count + 1.0) / (total + kinds + 1))
        log_c = np.log10(count + 1.0)
        for a, b, c in zip(*[mine.column(x).to_pylist() for x in "abc"], strict=True):
            rows, number, _, length = _sequences(a, b, c, classes)
            first = np.cumsum(length) - length
            _, at, active = by_time(length)
            _, scale = forward(model, emit[number[at]], active)
            chain = np.empty(len(number))
            chain[at] = np.log10(scale)
            flag = rows[:, 2]
            out.append(pa.table({
                "doc_id": pa.array(rows[:, 0], pa.int64(), mask=flag >= 2), "held_out": flag % 2 == 0, "n_tokens": length,
                "n_known": np.add.reduceat((count[number] > 0).astype(np.int64), first), "train_tokens": np.full(len(length), total),
                "base_score": np.add.reduceat(log_c[number], first) - length * log_total, "score": np.add.reduceat(chain, first)}))
        return pa.concat_tables(out)

    answers = counted.where("kind = 2").select("chunk", "bucket", "a", "b")
    return store.select("chunk", "a", "b", "c").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(lean_group(finish), SCORED)
