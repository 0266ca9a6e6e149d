"""Operators on documents against brute force on a small corpus with nulls, odd texts, copies and long texts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from demand.llm import components, decontaminate, hmm, lang_crf, ngram_join, packing, repair, suffix_dedup, tokenizing
from demand.llm.common import unpack

WORD_BPE, BYTE_BPE = tokenizing.tokenizer_path("word_bpe_49k.json"), tokenizing.tokenizer_path("byte_bpe_50k.json")


def plain_ids(path, texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


# ---- tokenizing, Re-Pair, packing

@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab'S  \n\t\u00a0\u2003.É9ſİ|<>endoftx", max_size=40), min_size=1, max_size=6))
def test_encode_is_plain_encoding(texts):
    for path, spaced in ((WORD_BPE, False), (BYTE_BPE, True)):
        ids, count = tokenizing.encode(pa.array(texts, pa.string()), path, spaced)
        want = plain_ids(path, texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])] == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab'S1\n\t\u00a0\u0085\x1c.É9\u0120|<>endoftx", min_size=1, max_size=12), min_size=1, max_size=200))
def test_words_in_lines_are_plain_encoding(words):
    tokenizing.forget()
    texts = [" ".join(words), *words]
    ids, count = tokenizing.encode(pa.array(texts, pa.string()), BYTE_BPE, True)
    assert [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])] == plain_ids(BYTE_BPE, texts)


def test_new_words_share_tokenizer_calls(monkeypatch):
    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer, self.texts = tokenizer, 0

        def encode_batch_fast(self, texts, **more):
            self.texts += len(texts)
            return self.tokenizer.encode_batch_fast(texts, **more)

    tokenizing.forget()
    coder = tokenizing._coder(BYTE_BPE)
    counting = Counting(coder.tokenizer)
    monkeypatch.setattr(coder, "tokenizer", counting)
    text = " ".join(f"w{i}é.\nnext{i}" for i in range(5000))
    ids, _ = tokenizing.encode(pa.array([text]), BYTE_BPE, True)
    assert ids.tolist() == plain_ids(BYTE_BPE, [text])[0]
    assert counting.texts < 5000 / 20


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=300), st.integers(1, 50), st.integers(2, 6))
def test_repair_round_trip(values, per_round, least):
    ids = np.array(values, np.uint32)
    rules, length, seq = repair.compress(ids, 4, rounds=5, per_round=per_round, least=least)
    assert repair.expand(seq, rules, 4).tolist() == values
    assert [len(repair.expand(np.array([4 + i]), rules, 4)) for i in range(len(rules))] == length.tolist()
    for a in range(0, len(values), 37):
        b = min(len(values), a + 50)
        assert repair.decode_range(seq, rules, length, 4, a, b).tolist() == values[a:b]


def test_repair_compresses():
    ids = np.tile(np.arange(50, dtype=np.uint32), 200)
    rules, _, seq = repair.compress(ids, 50, rounds=6)
    assert len(seq) + 2 * len(rules) < len(ids) / 10


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=300), st.integers(1, 50), st.integers(2, 6))
def test_repair_goes_on_until_no_pair_is_frequent(values, per_round, least):
    rules, length, seq = repair.compress(np.array(values, np.uint32), 4, per_round=per_round, least=least)
    pairs = zip(seq[:-1].tolist(), seq[1:].tolist(), strict=True)
    assert max(Counter(pairs).values(), default=0) < least
    assert repair.expand(seq, rules, 4, length).tolist() == values


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=300), st.integers(1, 50), st.integers(2, 6))
def test_repair_grammar_does_not_depend_on_slots(values, per_round, least):
    ids, slots = np.array(values, np.uint32), repair.SLOTS
    want = repair.compress(ids, 6, per_round=per_round, least=least)
    try:
        repair.SLOTS = 2  # most pairs share their slot
        got = repair.compress(ids, 6, per_round=per_round, least=least)
    finally:
        repair.SLOTS = slots
    assert all(a.tolist() == b.tolist() for a, b in zip(want, got, strict=True))
    assert repair.expand(got[2], got[0], 6, got[1]).tolist() == values


def test_repair_rounds_look_at_open_places_only(monkeypatch):
    looked, bincount = [], np.bincount
    monkeypatch.setattr(repair.np, "bincount", lambda x, **more: (looked.append(len(x)) if more.get("minlength", 0) > 1 << 19 else None, bincount(x, **more))[1])
    ids = np.concatenate([np.arange(50_000), np.tile(np.arange(50_000, 50_064), 40)]).astype(np.uint32)
    rules, length, seq = repair.compress(ids, 60_000)
    assert len(looked) > 3 and looked[0] == len(ids) - 1 and max(looked[1:]) < len(ids) / 10  # rare pairs are looked at once
    assert (repair.expand(seq, rules, 60_000, length) == ids).all()


def test_repair_covers_long_repeats():
    rng = np.random.default_rng(4)
    passage = rng.integers(0, 40000, 500)
    ids = np.concatenate([x for _ in range(20) for x in (passage, rng.integers(0, 40000, 3000))]).astype(np.uint32)
    rules, length, seq = repair.compress(ids, 40000)
    assert length.max() >= 400 and len(seq) < 20 * 3000 + 20 * 20
    assert (repair.expand(seq, rules, 40000, length) == ids).all()


def test_round_trip(documents, corpus, no_documents):
    got = repair.round_trip(documents, BYTE_BPE, 2, 50257)
    ids = [x + [2] for x in plain_ids(BYTE_BPE, [t for _, t in corpus])]
    at, want = 0, []
    same = sorted(zip([i for i, _ in corpus], ids, strict=True), key=lambda x: (x[0] is not None, x[0] or 0))
    for i, x in same:
        want.append((i, at, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        at += len(x)
    mine = rows_of(got, "doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted((i, n, c) for i, _, n, c in mine if i is not None) == sorted((i, n, c) for i, _, n, c in want if i is not None)
    assert [x for x in mine if x[0] not in (7, None)] == sorted((x for x in want if x[0] not in (7, None)), key=str)  # doc_id 7 stands on three rows
    assert repair.round_trip(no_documents, BYTE_BPE, 2, 50257).count() == 0


def packed_well(rows, capacity):
    by = defaultdict(list)
    for seq, offset, length in rows:
        by[seq].append((offset, length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing(documents, corpus, no_documents):
    got = packing.pack(documents, WORD_BPE, capacity=256, group_bins=8).collect()
    want = []
    for (i, _), ids in zip(corpus, plain_ids(WORD_BPE, [t for _, t in corpus]), strict=True):
        ids = ids + [1]
        for n, a in enumerate(range(0, len(ids), 256)):
            part = ids[a:a + 256]
            want.append((i, n, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got if r["doc_id"] is not None) == sorted(
        x for x in want if x[0] is not None) and len(got) == len(want)
    bins = packed_well([(r["sequence_id"], r["offset"], r["length"]) for r in got], 256)
    assert bins <= math.ceil(sum(x[3] for x in want) / 256) + 1
    assert packing.pack(no_documents, WORD_BPE).count() == 0


def test_packing_in_more_than_128_groups(spark):
    """A sequence_id holds the group above 24 bits for the bin: group 128 and up need a long."""
    docs = spark.createDataFrame([(i, " ".join(["the"] * 35)) for i in range(100)], "doc_id long, text string").repartition(3)
    got = packing.pack(docs, WORD_BPE, capacity=12, group_bins=1).collect()
    want = [(i, n, 12 * n, 12) for i in range(100) for n in range(3)]  # 36 ids a document with its end: three full pieces
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"]) for r in got) == want
    assert packed_well([(r["sequence_id"], r["offset"], r["length"]) for r in got], 12) == 300
    grp = {r["sequence_id"] >> 24 for r in got}
    assert min(grp) >= 0 and 128 <= max(grp) < 300


def test_search_beats_best_fit():
    lengths = [6, 6, 6, 5, 5, 5, 4, 4, 4, 3, 3, 3] * 4  # best fit decreasing wastes room at capacity 15
    plain = packing.best_fit(lengths, 15)
    better = packing.pack_lengths(lengths, 15)
    assert sorted(i for b in better for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 15 for b in better)
    assert len(better) <= len(plain)
    square = lambda bins: sum(sum(lengths[i] for i in b) ** 2 for b in bins)
    assert square(better) >= square(plain)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80))
def test_pack_lengths(lengths):
    bins = packing.pack_lengths(lengths, 30)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(0 < sum(lengths[i] for i in b) <= 30 for b in bins)
    assert len(bins) <= len(packing.best_fit(lengths, 30))


# ---- Jaccard join

def shingle_set(w):
    return set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def joined(sets, ids, roots=False):
    """The smallest id of each set's component, or a number of the component itself."""
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                up[root(i)] = root(j)
    if roots:
        return [root(i) for i in range(len(sets))]
    least = {}
    for i in range(len(sets)):
        if ids[i] is not None:
            least[root(i)] = min(ids[i], least.get(root(i), ids[i]))
    return [least.get(root(i)) for i in range(len(sets))]


@pytest.mark.parametrize("n2, k2, slot", [(2, 1, 3000), (3, 1, 2)])
def test_jaccard(documents, corpus, split_words, n2, k2, slot):
    sets = [shingle_set(split_words(t)) for _, t in corpus]
    want = [(i, len(s), c) for (i, _), s, c in zip(corpus, sets, joined(sets, [i for i, _ in corpus]), strict=True)]
    assert rows_of(ngram_join.join(documents, n2, k2, slot), "doc_id", "n_shingles", "component_id") == sorted(want, key=str)


def test_one_of_each(documents, corpus, split_words, no_documents):
    got = ngram_join.one_of_each(documents)
    assert got.columns == documents.columns
    sets = [shingle_set(split_words(t)) for _, t in corpus]
    empty = sum(not s for s in sets)
    groups = len({c for s, c in zip(sets, joined(sets, [], roots=True), strict=True) if s})
    assert got.count() == empty + groups
    assert ngram_join.join(no_documents).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40) if i % 7] + [(100, 50), (50, 70), (3, 3), (200, 200)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    got = {tuple(r) for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(x, root(x)) for x in up if x != 200}


# ---- suffix dedup

def repeats(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        out.append(gone)
    return out


@pytest.mark.parametrize("length, gram", [(200, 32), (24, 5)])
def test_suffix_dedup(documents, corpus, length, gram):
    texts = [(t or "").encode() for _, t in corpus]
    want = []
    for (i, _), t, gone in zip(corpus, texts, repeats(texts, length), strict=True):
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    got = suffix_dedup.removed(documents, length, gram)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=str)


def test_hot_grams_are_dealt_by_window(spark, monkeypatch):
    """A passage in every document: no bucket sorts the contexts of its gram, and the bytes removed stay the same."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = text(90)
    rows = [(i, text(rng.randint(0, 60)) + passage + text(rng.randint(0, 60))) for i in range(120)] + [(200, passage + passage), (201, None), (202, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = rows_of(suffix_dedup.removed(df, 40, 12, hot=1 << 30), *columns)
    parts = {}

    def watched(frame, name, *more):
        parts[name] = written(frame, name, *more)
        return parts[name]

    written = suffix_dedup.written
    monkeypatch.setattr(suffix_dedup, "written", watched)
    for hot in (1, 50):
        assert rows_of(suffix_dedup.removed(df, 40, 12, hot=hot), *columns) == want
        sorted_ = [np.frombuffer(unpack(r["b"]), np.uint64) for r in parts["suffix-contexts"].where("kind = 3").collect()]
        assert max(Counter(np.concatenate([*sorted_, np.empty(0, np.uint64)]).tolist()).values(), default=0) <= hot
        assert parts["suffix-contexts"].where("kind = 5").count() > 0


def test_dedup_texts(documents, corpus, no_documents):
    got = suffix_dedup.dedup_texts(documents)
    assert got.columns == documents.columns and got.count() == len(corpus)
    texts = [(t or "").encode() for _, t in corpus]
    kept = sorted(re.sub("\ufffd", "", np.frombuffer(t, np.uint8)[~g].tobytes().decode(errors="replace")) for t, g in zip(texts, repeats(texts, 200), strict=True))
    assert sorted(r["text"] for r in got.collect()) == kept
    assert suffix_dedup.removed(no_documents).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=40), min_size=1, max_size=5))
def test_windows_of_contexts(texts):
    """Anchors, contexts and the suffix sort on tiny alphabets, without Spark."""
    length, gram = 8, 3
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    h, place, first, last = suffix_dedup.anchors(data, offsets, length, gram)
    want_windows = [a + i for a, t in zip(offsets.tolist(), texts, strict=False) for i in range(len(t) - length + 1)]
    assert sorted(w for f, e in zip(first, last, strict=True) for w in range(f, e + 1)) == want_windows
    gone = np.zeros(len(data), bool)
    raw = data.tobytes()
    for g in np.unique(h):
        rows = np.flatnonzero(h == g)
        by = defaultdict(list)
        for r in rows:
            by[(int(place[r] - first[r]), raw[first[r]:last[r] + length])].append(r)
        keys = list(by)
        size = np.array([len(x) for _, x in keys])
        ctx = suffix_dedup.Contexts(np.frombuffer(b"".join(x for _, x in keys), np.uint8), np.cumsum(size) - size, size)
        lead = np.array([x for x, _ in keys])
        found = suffix_dedup.repeated_windows(ctx, np.zeros(len(keys), int), lead, length)
        for c, d in found.tolist():
            for r in by[keys[c]]:
                w = first[r] + lead[c] - d
                gone[w:w + length] = True
        for members in by.values():
            if len(members) > 1:
                for r in members:
                    gone[first[r]:last[r] + length] = True
    want = repeats([t.encode() for t in texts], length)
    assert gone.tolist() == [bool(x) for g in want for x in g]


def test_long_texts_are_cut_into_windows_once():
    offsets = np.array([0, 50, 1000, 1000, 1030])
    windows = [w for a, b in suffix_dedup.pieces(offsets, 20, 100) for w in range(a, b - 19)]
    assert windows == [w for a, b in zip(offsets[:-1], offsets[1:], strict=True) for w in range(a, b - 19)]


def test_hash_collisions_are_sorted_by_bytes(monkeypatch):
    blob = np.frombuffer(b"abcabdabcx", np.uint8)
    ctx = suffix_dedup.Contexts(blob, np.array([0, 3, 6]), np.array([3, 3, 4]))
    at = np.zeros(3, int)
    good = suffix_dedup.neighbours(ctx, np.zeros(3, int), at)
    ctx.prefix[:] = 0  # every hash alike
    order, ext = suffix_dedup.neighbours(ctx, np.zeros(3, int), at)
    assert order.tolist() == good[0].tolist() == [0, 2, 1] and ext.tolist() == good[1].tolist() == [-1, 3, 2]


# ---- benchmark decontamination

def phrase_hits(docs, items, window):
    phrases = defaultdict(set)
    for i, text in items:
        w = decontaminate.words_of(text) if text is not None and i is not None else []
        for k in range(max(1, len(w) - window + 1) if w else 0):
            phrases[tuple(w[k:k + window])].add(str(i))
    sizes, out = {len(p) for p in phrases}, []
    for i, text in docs:
        w = decontaminate.words_of(text or "")
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (p := tuple(w[k:k + n])) in phrases:
                    hit.update(range(k, k + n))
                    found |= phrases[p]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1_000_000, 40])
def test_decontaminate(spark, documents, corpus, no_documents, block):
    items = [(1, corpus[5][1]), (2, corpus[60][1].upper()), (30, "one two"), (4, None), (5, ""), (None, "one two three"), (6, corpus[68][1]), (6, corpus[69][1]), (7, "12")]
    bench = spark.createDataFrame([(*x, "z") for x in items], "item_id long, text string, n_words string")
    marked = decontaminate.mark(documents, bench, block_phrases=block)
    got = rows_of(decontaminate.digest(marked), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == phrase_hits(corpus, items, 10) and sum(x[5] for x in got) >= 10
    cut = decontaminate.without_spans(marked)
    for r in cut.collect():
        left = decontaminate.words_of(r["text"])
        assert len(left) == r["n_words"] - r["n_hit"]
    assert decontaminate.mark(no_documents, bench).count() == 0
    assert decontaminate.mark(documents, bench.limit(0)).where("n_hit > 0").count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=4), min_size=1, max_size=5))
def test_fm_index(ids, phrases):
    block = decontaminate.Phrases([])
    block.size = np.array([len(p) for p in phrases])
    block.ids = np.zeros((len(phrases), 4), np.int64)
    for i, p in enumerate(phrases):
        block.ids[i, :len(p)] = p
    ids = np.array(ids, np.int64)
    at, which = decontaminate.find(ids, np.zeros(len(ids), np.int64), block, sample=3)
    want = sorted((k, n) for n, p in enumerate(phrases) for k in range(len(ids) - len(p) + 1) if ids[k:k + len(p)].tolist() == p)
    assert sorted(zip(at.tolist(), which.tolist(), strict=True)) == want


# ---- language model

def test_hmm_base_and_counts(documents, corpus, split_words, no_documents):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    got = hmm.score(documents, F.crc32(F.col("doc_id").cast("string")) % 7 == 2, iterations=2)
    words = [[*split_words(t), None] for _, t in corpus]
    c = Counter(w for (i, _), ws in zip(corpus, words, strict=True) if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted(((i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6))
                   for (i, _), ws in zip(corpus, words, strict=True)), key=str)
    rows = got.collect()
    assert sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows), key=str) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)
    assert hmm.score(no_documents, F.col("doc_id") == 1).count() == 0
    nothing_learned = hmm.score(documents.limit(5), F.lit(True)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"]) for r in nothing_learned} == {(0, 0, 0.0)}


def paths_of(model, emitted):
    """(path, its joint probability) of one short text."""
    from itertools import product
    for z in product(range(len(model.start)), repeat=len(emitted)):
        p = model.start[z[0]] * emitted[0][z[0]]
        for i in range(1, len(emitted)):
            p *= model.move[z[i - 1], z[i]] * emitted[i][z[i]]
        yield z, p


def counts_of(model, texts, emit):
    """Expected starts, moves and states per token by enumeration."""
    k = len(model.start)
    start, move, tokens = np.zeros(k), np.zeros((k, k)), []
    for t in texts:
        paths = list(paths_of(model, [emit(x) for x in t]))
        total = sum(p for _, p in paths)
        gamma = np.zeros((len(t), k))
        for z, p in paths:
            start[z[0]] += p / total
            for i, s in enumerate(z):
                gamma[i, s] += p / total
                if i:
                    move[z[i - 1], s] += p / total
        tokens += [*zip(t, gamma, strict=True)]
    return start, move, tokens


def test_forward_and_expected_counts_by_enumeration():
    model = hmm.Model(3, 4, seed=1)
    texts = [[0, 2, 4], [4], [3, 3, 0, 1, 4]]
    size = np.array([len(t) for t in texts])
    flat = np.array([c for t in texts for c in t])
    _, place, active = hmm.by_time(size)
    _, scale = hmm.forward(model, model.emit.T[flat[place]], active)
    logs = np.empty(len(flat))
    logs[place] = np.log(scale)
    want = [math.log(sum(p for _, p in paths_of(model, [model.emit[:, c] for c in t]))) for t in texts]
    assert np.allclose(np.add.reduceat(logs, np.cumsum(size) - size), want)
    start, move, tokens = counts_of(model, texts, lambda c: model.emit[:, c])
    emit = np.zeros((3, 5))
    for c, g in tokens:
        emit[:, c] += g
    got = hmm.expected(model, flat[place], active)
    for a, b in zip(got, (start, move, emit, np.array([g for _, g in tokens])[place]), strict=True):
        assert np.allclose(a, b)


@pytest.mark.parametrize(("parts", "passes"), [(1, 1), (4, 2)])
def test_hmm_score_by_enumeration(spark, split_words, parts, passes):
    """Whole scores through the operator: tied passes, untied word weights, unknown words and ends, all paths spelled out."""
    corpus = [(1, "a b A c"), (2, "b a"), (3, None), (4, "c new b"), (5, "a\tb"), (6, "c c a"), (7, "")]
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(parts)
    words = {i: [*split_words(t or ""), None] for i, t in corpus}
    train = [words[i] for i in words if i != 4]
    c = Counter(w for ws in train for w in ws)
    n, v = sum(c.values()), len(c)
    classes = 3

    def class_of(w):
        if w is None:
            return classes
        return int(hmm.piece_hashes(*hmm.flat(pa.array([w], pa.large_string())))[0] >> np.uint64(20)) % classes
    model = hmm.Model(2, classes)
    for _ in range(passes):
        start, move, tokens = counts_of(model, train, lambda w: model.emit[:, class_of(w)])  # noqa: B023
        emit = np.zeros((2, classes + 1))
        for w, g in tokens:
            emit[:, class_of(w)] += g
        model = model.learned(start, move, emit)
    weight = {w: np.zeros(2) for w in c}
    for w, g in counts_of(model, train, lambda w: model.emit[:, class_of(w)])[2]:
        weight[w] += g
    size = sum(weight.values())

    def emission(w):
        return (1 - hmm.MIX) * weight.get(w, np.zeros(2)) / size + hmm.MIX * (c[w] + 1) / (n + v + 1)
    assert np.allclose(sum(emission(w) for w in [*c, "unknown"]), 1)
    want = {i: math.log10(sum(p for _, p in paths_of(model, [emission(w) for w in words[i]]))) for i in words}
    got = {r["doc_id"]: r["score"] for r in hmm.score(docs, F.col("doc_id") == 4, states=2, classes=classes, iterations=passes).collect()}
    assert got == pytest.approx(want, abs=4 * 0.5 / hmm.LEVELS)  # shares are kept in 1/255: at most half of that each
    assert got == pytest.approx(want, rel=4e-3)


def test_baum_welch_raises_the_likelihood(spark, documents):
    scores = [hmm.score(documents, F.lit(False), iterations=n).agg(F.sum("score")).first()[0] for n in (1, 4)]
    assert scores[1] > scores[0]


# ---- language ID

def language_rows():
    import random
    rng = random.Random(9)
    parts = {"en": ["the", "ing", "wh", "sh", "th"], "fr": ["eau", "ou", "é", "que", "aux"], "de": ["sch", "ü", "ung", "ein", "ich"]}
    rows = []
    for i in range(240):
        lang = ["en", "fr", "de"][i % 3]
        rows.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 60))), lang))
    return rows


def test_language_id(spark):
    rows = language_rows()
    odd = [(1000, None, "en"), (1001, "", "en"), (1002, "12 -- 3", "fr"), (1003, rows[0][1], None), (1004, (rows[1][1] + " ") * 800, None), (None, rows[2][1], None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + odd], "doc_id long, text string, lang string, lang_pred string, score int")
    held = F.col("doc_id") % 5 == 0
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in lang_crf.identify(df, ~held).collect()}
    right = [got[i][0] == lang for i, _, lang in rows if i % 5 == 0]
    assert sum(right) >= 0.95 * len(right)
    assert [got[i] for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert (got[1003][0], got[1004][0], got[None][0]) == ("en", "fr", "de")
    assert all(0 <= s <= 1 for _, s in got.values())
    assert {r["lang_pred"] for r in lang_crf.identify(df, F.lit(False)).collect()} == {"und"}
    assert lang_crf.identify(df.limit(0), F.lit(True)).count() == 0


def test_marginals_by_enumeration():
    from itertools import product
    rng = np.random.default_rng(0)
    tagger = lang_crf.Tagger(["a", "b"], np.zeros((4, 2)), [], [], np.zeros(2), rng.normal(size=(2, 2)), rng.normal(size=2))
    sizes, score = np.array([3, 1, 4]), rng.normal(size=(8, 2))
    _, place, active = hmm.by_time(sizes)
    p = np.empty((8, 2))
    p[place] = lang_crf.marginals(*lang_crf.one_sided(tagger, np.exp(score[place]), active))
    at = 0
    for n in sizes.tolist():
        want = np.zeros((n, 2))
        for z in product(range(2), repeat=n):
            w = math.exp(tagger.start[z[0]] + sum(score[at + i, y] for i, y in enumerate(z)) + sum(tagger.move[a, b] for a, b in zip(z, z[1:], strict=False)))
            for i, y in enumerate(z):
                want[i, y] += w
        assert np.allclose(p[at:at + n], want / want.sum(axis=1, keepdims=True))
        at += n


def test_code_switched_words_are_labelled_apart(spark):
    rows = language_rows()
    tagger = lang_crf.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    text = " ".join(rows[0][1].split()[:8] * 3 + rows[1][1].split()[:4] * 2)
    lang, score = lang_crf.predict_texts(tagger, pa.array([text]))
    assert lang == ["en"] and 0.5 < score[0] < 0.95


def test_every_byte_of_long_words_is_read(spark):
    rng = random.Random(3)
    chars = {"ja": "あいうえおかきくけこ", "zh": "的一是不了人我在有他"}
    text = lambda lang, n: "".join(rng.choice(chars[lang]) for _ in range(n))
    long = ["é" * 40, "a" * 25, "short", text("ja", 33), "x" * 24]
    cut, n = lang_crf.cut_long(pa.array(long))
    assert n.tolist() == [4, 2, 1, 5, 1] and "".join(cut.to_pylist()) == "".join(long)
    assert max(len(x.encode()) for x in cut.to_pylist()) <= 2 * lang_crf.SIDE
    rows = [(i, text(lang, 60), lang) for i in range(60) for lang in chars]
    tagger = lang_crf.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    inside = text("ja", 4) + text("zh", 300) + text("ja", 4)  # both ends in another language
    (lang,), (score,) = lang_crf.predict_texts(tagger, pa.array([inside]))
    assert lang == "zh" and 0.8 < score < 1
