"""The pipeline against its parts by brute force, and the registered queries against their SQL and plain Python."""

import os
from functools import partial

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from demand.llm import catalog
from demand.llm.tokenizing import tokenizer_path

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def views():
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SMALL}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_sql_twins(spark, views, name):
    got = catalog.queries()[name](spark, SMALL).toPandas()
    want = views.execute(catalog.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = lambda df: sorted(map(tuple, df[columns].astype(object).where(df[columns].notna(), None).values.tolist()), key=str)
    assert rows(got) == rows(want)


def test_every_operator_is_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))


def test_stages(spark, views):
    """Each stage on what the one before kept; the decisions against brute force."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").cache()
    columns = docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    kept = {}
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SMALL).cache()
        assert frame.columns == columns
        kept[name] = {r["doc_id"]: r["text"] for r in frame.collect()}
        assert len(kept[name]) == frame.count()
    known, one, cut, clean = kept.values()
    assert known == {i: t for i, t in texts.items() if i in known} and len(known) >= 0.97 * len(texts)

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}

    sets = {i: shingles(t) for i, t in known.items()}
    group = {i: i for i in known}
    for i in sorted(sets):
        for j in sorted(sets):
            if j < i and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((group[i], group[j]))
                group = {k: a if g == b else g for k, g in group.items()}
    assert set(one) == set(group.values())

    seen = {}
    for i, t in one.items():
        raw = t.encode()
        for k in range(len(raw) - 199):
            seen.setdefault(raw[k:k + 200], []).append(i)
    repeated = {i for who in seen.values() if len(who) > 1 for i in who}
    assert {i for i, t in one.items() if cut.get(i) != t} <= repeated
    assert all(cut.get(i) != one[i] for i in repeated)

    items = [t.lower() for (t,) in views.execute("select text from benchmark").fetchall()]
    from demand.llm.decontaminate import words_of
    phrases = {tuple(w[k:k + 10]) for w in map(words_of, items) for k in range(max(1, len(w) - 9))}
    has = lambda t: any(tuple(w[k:k + 10]) in phrases for w in [words_of(t)] for k in range(len(w) - 9))
    assert {i for i, t in cut.items() if clean.get(i) != t} == {i for i, t in cut.items() if has(t)}
    assert not any(has(t) for t in clean.values())

    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    rows = corpus_pipeline.STAGES[-1][1](spark, frame, SMALL).collect()
    size = {}
    for r in rows:
        size[r["doc_id"]] = size.get(r["doc_id"], 0) + r["length"]
    assert size == {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in clean.items()}


def test_odd_rows_pass(spark, tmp_path):
    """Null ids and texts, repeated rows and an empty table go through every stage."""
    bench = spark.createDataFrame([(1, "alpha beta gamma"), (None, None)], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, f"some plain words number {i} and then some more of them", "en", "s", 1) for i in range(30)]
    rows += [(50 + i, f"autres mots français numéro {i} et puis encore quelques autres", "fr", "s", 1) for i in range(30)]
    rows += [(None, "words without an id but with text", None, None, None), (None, None, "en", None, None), (99, "", None, "s", 0), rows[0], rows[0],
             (98, "xx alpha beta gamma yy", "en", "s", 1)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len([r for r in got if r["doc_id"] == 0]) == 1 and not [r for r in got if r["doc_id"] == 99]
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    bench.write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_own_columns_and_long_texts_come_through(spark, tmp_path):
    """Columns named like those of the operators keep their values; a very long text passes."""
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    own = {"lang_pred": "mine", "score": 7.5, "n_words": 3, "n_hit": 4, "hit_items": "own", "hit_spans": "too", "component": 9, "tkey": 8}
    rows = [(i, f"some plain words number {i} and then some more of them", "en", "s", 1, *own.values()) for i in range(20)]
    rows += [(50 + i, f"autres mots français numéro {i} et puis encore quelques autres", "fr", "s", 1, *own.values()) for i in range(20)]
    rows += [(90, " ".join(f"plain words number {i} of them" for i in range(60_000)), "en", "s", 1, *own.values()),
             (91, "some words then alpha beta gamma and then some more", "en", "s", 1, *own.values())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, lang_pred string, score double, "
                                       "n_words int, n_hit int, hit_items string, hit_spans string, component int, tkey int").cache()
    columns, frame = docs.columns, docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, str(tmp_path)).cache()
        assert frame.columns == columns and frame.dtypes == docs.dtypes
        kept = frame.collect()
        assert kept and all(r[c] == x for r in kept for c, x in own.items())
    assert {r["doc_id"]: r["text"] for r in kept}[91] == "some words then  and then some more"
    assert len({r["doc_id"]: r["text"] for r in kept}[90]) > 500_000
    packed = corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path)).where("doc_id = 90").collect()
    assert len(packed) > 40 and sorted(r["piece"] for r in packed) == list(range(len(packed)))


def test_last_stage_packs_more_than_128_groups(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(corpus_pipeline.packing, "pack", partial(corpus_pipeline.packing.pack, capacity=12, group_bins=1))
    docs = spark.createDataFrame([(i, " ".join(["the"] * 35), "en", "s", 139) for i in range(100)],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["piece"]) for r in got) == [(i, n) for i in range(100) for n in range(3)]
    assert len({r["sequence_id"] for r in got}) == 300 and max(r["sequence_id"] >> 24 for r in got) >= 128
