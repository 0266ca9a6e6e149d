"""License scans against plain Python: base phrases at all places, templates by their rare words, odd rows."""

import random
import re
from collections import Counter

import pytest

from demand.llm import licenses

WORD = re.compile(r"[0-9a-z\u0080-\U0010ffff]+")
FIRST = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text):
    return WORD.findall((text or "").translate(str.maketrans(FIRST, FIRST.lower())))


def scanned(rows, rare=4, least_rare=2, least_share=0.8):
    """One digest row per (doc_id, text): every start of every template is tried."""
    seen = Counter(x for _, t in rows for x in set(words(t)))
    out = []
    for doc_id, text in rows:
        w, base, places = words(text), [], []
        entries = [(label, t.split(), t.split(), True) for label, t in licenses.PHRASES]
        entries += [(label, t.split(), key.split(), False) for label, t, key in licenses.TEMPLATES]
        for label, ws, key, phrase in entries:
            if phrase:
                found = [s for s in range(len(w)) if w[s:s + len(ws)] == ws]
                base += [(s, label) for s in found]
                places += [(label, 1.0) for _ in found]
                continue
            chosen = set(sorted(set(ws), key=lambda x: (seen[x], x))[:rare])
            spot = [i for i, x in enumerate(ws) if x in chosen]
            k = next(i for i in range(len(ws)) if ws[i:i + len(key)] == key)
            for s in range(-len(ws), len(w)):
                stand = [0 <= s + i < len(w) and w[s + i] == x for i, x in enumerate(ws)]
                if sum(stand) >= least_share * len(ws) and all(stand[k:k + len(key)]) and sum(stand[i] for i in spot) >= min(least_rare, len(spot)):
                    places.append((label, sum(stand) / len(ws)))
        labels = ",".join(sorted({p for p, _ in places}))
        out.append((doc_id, len(w), len(base), min((s for s, _ in base), default=None), max((s for s, _ in base), default=None),
                    ",".join(sorted({p for _, p in base})), labels, max((x for _, x in places), default=0.0)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    notices = [t for _, t, _ in licenses.TEMPLATES] + [t for _, t in licenses.PHRASES]
    plain = "the of a license public rights by cc under general all reserved version word é 2 0".split()
    out = [(0, None), (1, ""), (2, "., -"), (3, "CC-BY! cc_by cc by-NC 4.0"), (4, "all rights reserved"), (4, "all rights reserved"),
           (5, "All Rights RESERVED." * 2000), (6, "allé rights reserved all rights reservedé"), (None, "General Public License general public\nlicense"),
           (7, "apache license, version 2.0"), (8, "under the apache license version 2"), (9, "x " * 50_000 + "cc by" + " y" * 10)]
    for i in range(200):
        parts = []
        for _ in range(rng.randint(1, 6)):
            w = rng.choice(notices).split()
            for _ in range(rng.choice([0, 0, 1, 2])):  # a changed word, or a lost one
                k = rng.randrange(len(w))
                w[k:k + 1] = rng.choice([["other"], [], [w[k].upper()]])
            parts += w + rng.choices(plain, k=rng.randint(0, 8))
        out.append((100 + i, rng.choice([" ", ". ", "\n", "-"]).join(parts)))
    return out


def test_against_every_start(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", [1], 2, 3) for i, t in rows], "doc_id long, text string, w string, codes array<int>, places int, score int")
    got = sorted((tuple(r) for r in licenses.digest(licenses.scan(docs)).collect()), key=str)
    want = scanned(rows)
    assert got == want
    assert any(0 < r[-1] < 1 for r in want) and any(r[5] and r[6] != r[5] for r in want)


def test_places_and_empty_table(spark, no_documents):
    assert licenses.digest(licenses.scan(no_documents)).count() == 0
    docs = spark.createDataFrame([(1, "released under the mit license. all rights reserved")], "doc_id long, text string")
    places = licenses.scan(docs).collect()[0]["places"]
    assert sorted((p["label"], p["start"], p["share"], p["phrase"]) for p in places) == [("mit", 0, 1.0, False), ("reserved", 5, 1.0, True)]


def test_stays_native(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plan = licenses.digest(licenses.scan(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
