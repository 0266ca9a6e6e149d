"""Ranked search against scoring every document, the early end of the masks, blocks of queries, odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from demand.llm import ranked_search

TERM = re.compile(r"[0-9a-z\u0080-\U0010ffff]+")
FIRST = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def terms(text):
    return TERM.findall((text or "").translate(str.maketrans(FIRST, FIRST.lower())))


def ranked(docs, items, top=20):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, length = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(x for _, b in bags for x in b)
    queries = {}
    for i, t in set(items):
        queries.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, q in queries.items():
        scored = []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n_docs // max(1, length)
            score = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10 ** 9 * b[x] // (1000 * b[x] + 12 * m))
                        for x, r in q.items() if b[x])
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def items(corpus):
    rng = random.Random(8)
    vocabulary = sorted({w for _, t in corpus for w in terms(t)})
    out = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 40)))) for i in range(30)]
    out += [(100, None), (101, ""), (102, "-- ?"), (103, "unheard of words"), (104, corpus[3][1]), (105, " ".join(rng.choices(vocabulary, k=400))),
            (106, "the"), (106, "the"), (106, "of the"), (None, "THE an"), (107, corpus[3][1])]
    return out


@pytest.mark.parametrize("block_bytes", [1 << 22, 2000])
def test_against_scoring_all(spark, corpus, documents, items, block_bytes, monkeypatch):
    monkeypatch.setattr(ranked_search, "CHUNK_BYTES", 20_000)
    frame = spark.createDataFrame([(i, t, 3, "x") for i, t in items], "item_id long, text string, rank int, doc_id string")
    got = ranked_search.search(documents, frame, block_bytes=block_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == ranked(corpus, items)


def test_string_items_and_top(spark, corpus, documents, items):
    frame = spark.createDataFrame([(f"q{i}", t) for i, t in items], "item_id string, text string")
    got = sorted((tuple(r) for r in ranked_search.search(documents, frame, top=3).collect()), key=str)
    assert got == ranked(corpus, [(f"q{i}", t) for i, t in items], top=3)


def test_empty_tables(spark, documents, no_documents):
    items = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert ranked_search.search(no_documents, items).count() == 0
    assert ranked_search.search(documents, items.limit(0)).count() == 0


def test_groups_that_cannot_win_are_left():
    """One rare term decides: documents that hold only the common one are not evaluated."""
    n = 5000
    docs = [np.arange(n), np.arange(30)]
    row = {"ids": np.stack([np.arange(n), np.zeros(n)]), "sizes": np.full(n, 10), "term": np.arange(2), "df": [n, 30],
           "doc": np.concatenate(docs), "tf": np.ones(n + 30)}
    kinds = {"ids": np.int64, "sizes": np.int64}
    row = {k: ranked_search.pack(v, kinds.get(k, np.int32)) for k, v in row.items()}
    chunk = ranked_search.Postings(row, np.array([1, 8000]), n, 10 * n)
    best = ranked_search.Best(20)
    assert chunk.search(np.array([0, 1]), np.array([1, 1]), best) == 30
    assert best.id.tolist() == list(range(20))
