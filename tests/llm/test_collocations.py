"""Collocation mining against plain counting: dealt slots, coarse buckets, salted parts, odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from demand.llm import collocations

FIRST = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOW = str.maketrans(FIRST, FIRST.lower())


def mined(rows, least, top, longest=4):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    f = {p: c for p, c in f.items() if c >= least}
    covered = {}
    for (lang, *w), c in f.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                covered[lang, *w[i:i + k]] = max(covered.get((lang, *w[i:i + k]), 0), c)
    out = {}
    for (lang, *w), a in f.items():
        if len(w) >= 2 and 100 * covered.get((lang, *w), 0) < 80 * a:
            score, _, l, r = min((2_000_000 * a // (f[lang, *w[:k]] + f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted(((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items()
                   for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = ["the", "of", "a", "new", "york", "stock", "ex-change", "É", "é", "to", "x" * 300, " ", "<b>", "'s"]
    rows = [(rng.choice(["en", "fr", None, "und", ""]),
             "".join(rng.choice(words[:rng.choice([3, 8, 14])]) + rng.choice([" ", "  ", "\t", " ", ". ", "\n", " ! "]) for _ in range(rng.randint(0, 120))))
            for _ in range(150)]
    rows += [("en", "New York Stock ex-change rose; the new york stock market fell")] * 40
    rows += [("en", "the " * 9000), ("en", None), ("en", ""), (None, None), ("de", " .,;:!? "), ("fr", "a b"), ("en", "end."), ("en", "start")]
    return rows


SETTINGS = [{}, {"per_bucket": 200}, {"per_bucket": 400, "coarse_buckets": 3, "per_salt": 2}, {"per_bucket": 30}]


@pytest.mark.parametrize("settings", SETTINGS, ids=str)
def test_against_counting(spark, rows, settings, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 5000)
    docs = spark.createDataFrame([(i % 7, lang, t, "x", 1) for i, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string, phrase string, n int")
    got = collocations.mine(docs.repartition(4), least=5, top=60, **settings)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = mined(rows, 5, 60)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert len({r[0] for r in want}) >= 3


def test_longest_two_and_empty(spark, rows, no_documents):
    docs = spark.createDataFrame([(i, lang, t) for i, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string")
    got = sorted((tuple(r) for r in collocations.mine(docs, longest=2, least=5, top=2000).collect()), key=str)
    assert got == mined(rows, 5, 2000, 2)
    assert collocations.mine(no_documents).count() == 0


@pytest.mark.parametrize("dealt", [False, True])
def test_quicksort(dealt):
    rng = np.random.default_rng(3)
    context = rng.integers(0, 6, (4, 3000)).astype(np.int32)
    end = rng.integers(1, 6, 3000)
    for d in range(1, 4):
        context[d, end <= d] = -1
    weight = rng.integers(1, 4, 3000)
    want = Counter()
    for c, w in zip(context.T.tolist(), weight.tolist(), strict=True):
        for d in range(1, 5):
            if c[d - 1] >= 0:
                want[tuple(c[:d])] += w
    pointer, depth, total = collocations.equal_parts(context, weight, 40, dealt=dealt)
    got = {tuple(context[:d, p].tolist()): t for p, d, t in zip(pointer, depth, total, strict=True)}
    assert len(got) == len(pointer)
    assert got == {p: w for p, w in want.items() if w >= 40 or dealt and len(p) < 4}


def test_exact_beyond_64_bits(spark):
    """Counts whose products pass 64 bits."""
    big = 2 ** 60
    rows = [("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "a b", 2, big - 1)]
    phrases = spark.createDataFrame(rows, "lang string, phrase string, k int, f long")
    saved = collocations.frequent
    collocations.frequent = lambda *a: (phrases, spark.createDataFrame([("en", 5)], "lang string, n long"))
    try:
        r = collocations.mine(None).collect()[0]
    finally:
        collocations.frequent = saved
    assert (r.a, r.l, r.r, r.score) == (big - 1, big, big + 1, 2_000_000 * (big - 1) // (2 * big + 1))


def test_router_bounds_buckets():
    counts = np.array([5, 0, 40, 3, 9, 100, 1])
    router = collocations.Router(counts, 10)
    alone = {}
    for slot, n in enumerate(counts.tolist()):
        if not router.parts[slot]:
            alone[router.of_slot[slot]] = alone.get(router.of_slot[slot], 0) + n
    assert max(alone.values()) < 20 and router.parts.tolist() == [0, 0, 4, 0, 0, 10, 0]
    spans = [range(router.of_slot[s], router.of_slot[s] + router.parts[s]) for s in (2, 5)]
    assert not set(spans[0]) & set(spans[1]) and not (set(spans[0]) | set(spans[1])) & set(alone)
    assert router.buckets == max(spans[1]) + 1
