"""URL rules, perspective rotation and forest search against plain Python."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from demand.llm import ann, chat, url_filter


# ---- URL rules

URLS = [None, "", "no scheme", "http://", "http:///x", "http://org", "http://ORG/", "https://a.Example.ORG/es/1?q=/x", "http://example.org/en/1#f",
        "http://example.org/en/10/2", "http://myexample.org/es/", "x://a.com/fr/", "x://com/fr/x", "x://a.com/de/x", "x://a.com/de", "http://a://b/c",
        "http://org?x/", "http://a.org/%C3%A9/\u00e9\U0010ffff", "http://" + "a." * 50 + "org/deep", "http://example.org/en/1" + "y" * 5000]
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"),
         ("example.org", "/en/", "allow"), ("example.org", "/en/10", "allow"), ("org", "/é/", "block"), ("org", "/é/é", "allow"), ("", "/x", "block"),
         ("com", "/fr/", "block"), (None, "/", "block"), ("a.com", None, "block"), ("a.com", "/", None), ("example.org", "", "block")]


def judged(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, after = rest[:cut].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), rest[cut:]
    path = after[:min([after.find(c) for c in "?#" if c in after], default=len(after))]
    best = None
    for h, p, v in rules:
        if None not in (h, p, v) and (host == h or h and host.endswith("." + h)) and path.startswith(p):
            best = max(best or (), (len(h), len(p), h + p, v))
    return host, path, best[2] if best else None, best[3] if best else "allow"


@pytest.mark.parametrize("salt", [200_000, 2])
def test_urls(spark, salt):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(3, URLS[7], "x", "y"), (None, URLS[8], "x", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = [tuple(r) for r in url_filter.judge_urls(pages, rules, rows_per_salt=salt).collect()]
    want = [(i, *judged(u, RULES)) for i, u, *_ in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_urls_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert url_filter.judge_urls(pages, rules).count() == 0
    one = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert url_filter.judge_urls(one, rules, default="block").collect()[0]["verdict"] == "block"


# ---- chat

def rotated(rows, size):
    out, by_conv = [], {}
    for c, t, r, x in rows:
        by_conv.setdefault(c, []).append((-math.inf if t is None else t, r or "unknown", x or ""))
    for c, messages in by_conv.items():
        messages.sort()
        for p in {m[1] for m in messages}:
            for k in range(0, len(messages), size):
                text, mask, spans = "", "", []
                for _, who, x in messages[k:k + size]:
                    text += "<|assistant|>\n" if who == p else f"<|user name={who}|>\n"
                    if who == p:
                        spans.append((len(text), len(text) + len(x)))
                    mask += "01"[who == p]
                    text += x + "<|end|>\n"
                out.append((c, p, k // size, len(mask), text, mask, tuple(spans), sum(b - a for a, b in spans)))
    return sorted(out, key=str)


def test_rotate(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "bob", None]), rng.choice(["hi", "é ü", "", None, "x" * 9000]))
            for c in (1, 2, None) for t in [0, 1, 1, 2, None, 1500, 2, 4000]]
    rows += [(9, t, "ab"[t % 2], str(t)) for t in range(2600)] + [(1, 0, "user", "hi")] * 2
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, chunk string")
    got = chat.rotate(df, turns_per_chunk=100).collect()
    flat = sorted(((r["conv_id"], r["perspective"], r["chunk"], r["n_messages"], r["rendered"], r["mask"],
                    tuple((x["start"], x["end"]) for x in r["spans"]), r["n_target_chars"]) for r in got), key=str)
    assert flat == rotated(rows, 100)
    assert chat.rotate(df.limit(0)).count() == 0


# ---- nearest neighbours

def exact(rows, queries, k):
    out = {}
    for q, v in rows:
        if q not in queries:
            continue
        near = {}
        for i, w in rows:
            if i != q:
                d = math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w, strict=True)))
                near[i] = min(d, near.get(i, math.inf))
        out[q] = sorted((d, i) for i, d in near.items())[:k]
    return out


def test_forest_search(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 12))
    rows = [(i, (centres[i % 6] + 0.4 * rng.normal(size=12)).tolist()) for i in range(1500)]
    rows += [(5000 + i, rows[10][1]) for i in range(400)]  # copies: ties and a full leaf
    bad = [(6000, None), (6001, []), (6002, [0.0] * 12), (6003, [math.nan] + [1.0] * 11), (6004, [math.inf] + [1.0] * 11),
           (6005, [None] + [1.0] * 11), (6006, [1.0] * 5), (None, rows[0][1]), (6100, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows + bad], "vec_id long, embedding array<double>, score int")
    got = ann.search(df, lambda i: i % 100 == 0, trees=6, leaves=16, inspect_share=0.9, block_rows=100, query_block=7).collect()
    want = exact(rows, {i for i, _ in rows if i % 100 == 0}, 10)
    found = {}
    for r in got:
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["score"], r["vec_id"])
    assert set(found) == set(want)
    hits = 0
    for q, best in want.items():
        mine = [found[q][n] for n in sorted(found[q])]
        assert sorted(found[q]) == list(range(1, 11)) and mine == sorted(mine)
        hits += len({i for _, i in mine} & {i for _, i in best})
    assert hits >= 0.9 * 10 * len(want)
    everything = ann.search(df, lambda i: i % 100 == 0, trees=2, leaves=4, inspect_share=9.0).collect()
    assert {(r["query_id"], r["rank"]): (round(r["score"], 9), r["vec_id"]) for r in everything} == {
        (q, n + 1): (round(d, 9), i) for q, best in want.items() for n, (d, i) in enumerate(best)}


def test_forest_search_small(spark):
    schema = "vec_id long, embedding array<float>"
    assert ann.search(spark.createDataFrame([], schema), lambda i: i % 100 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [1.0, 1.0]), (200, [1.0, 0.5])], schema)
    got = [tuple(r) for r in ann.search(few, lambda i: i % 100 == 0).orderBy("query_id", "rank").collect()]
    assert [(q, n, i) for q, n, i, _ in got] == [(0, 1, 200), (0, 2, 1), (200, 1, 0), (200, 2, 1)]


def test_repeated_ids_do_not_crowd_out_others(spark):
    rng = np.random.default_rng(6)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(60, 4)).tolist()) for _ in range(12)]
    ids, data = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    shuffled = rng.permutation(len(ids))
    near = ann.nearest_in(ids[shuffled], data[shuffled], np.array([0, 7]), np.array([rows[0][1], rows[84][1]]), 10)
    for q, best in exact(rows, {0, 7}, 10).items():
        mine = near[near["query_id"] == q]
        assert list(zip(mine["score"].round(9), mine["vec_id"], strict=True)) == [(round(d, 9), i) for d, i in best]


@pytest.mark.parametrize("copies", [1, 30])
def test_few_ids_are_all_found(spark, copies):
    rng = np.random.default_rng(9)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(11, 8)).tolist()) for _ in range(copies)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = Counter(r["query_id"] for r in ann.search(df, lambda i: i >= 0).collect())
    assert got == {i: 10 for i in range(11)}


@pytest.mark.parametrize(("queries", "blocks"), [(5_000, 2), (20_000, 5), (100_000, 25)])
def test_query_blocks_are_even_for_ids_with_a_common_factor(queries, blocks):
    size = np.bincount(ann.query_blocks(np.arange(queries) * 100, blocks), minlength=blocks)
    assert size.min() > 0.9 * queries / blocks and size.max() < 1.1 * queries / blocks


def _nearest_by_hand(ids, data, query_ids, queries, k):
    out = []
    for q, v in zip(query_ids, queries, strict=True):
        best = {}
        for i, d in zip(ids.tolist(), np.sqrt(((data - v) ** 2).sum(axis=1)).tolist(), strict=True):
            if i != q and d < best.get(i, math.inf):
                best[i] = d
        out += [(int(q), i, d) for d, i in sorted((d, i) for i, d in best.items())[:k]]
    return out


@pytest.mark.parametrize("case", ["plain", "copies", "far from zero", "grid", "huge", "few", "one"])
def test_products_lose_no_neighbour(case, monkeypatch):
    """Rows whose products cancel, ties without end, values whose squares overflow: same ids and same doubles."""
    rng = np.random.default_rng(17)
    n = {"few": 7, "one": 1}.get(case, 400)
    data = rng.normal(size=(n, 5))
    ids = rng.permutation(n).astype(np.int64)
    if case == "copies":
        ids = ids % 60
    if case == "far from zero":
        data = 1e9 + np.round(data, 1)  # distances of 0.1 at coordinates of 1e9
    if case == "grid":
        data = np.round(data)
    if case == "huge":
        data[::3] *= 1e160
    query_ids = np.concatenate([ids[:40], [10_000]])
    queries = np.concatenate([data[:40], data[:1]])
    monkeypatch.setattr(ann, "CELLS", 3000)
    with np.errstate(over="ignore"):
        want = _nearest_by_hand(ids, data, query_ids, queries, 10)
        got = ann.nearest_in(ids, data, query_ids, queries, 10)
    assert list(got.itertuples(index=False, name=None)) == want
