"""One query per operator of this subpackage over the driver's tables, and its DuckDB twin where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demand.llm.common import table

#: The rules of the url query.
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def _rules_sql() -> str:
    return "VALUES " + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


def op2_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand.llm import ann
    return ann.search(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0)


def held_out_language(doc_id):
    """True for the documents that language ID never learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def op3_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand.llm import lang_crf
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out_language(F.col("doc_id")))
    return lang_crf.identify(docs, ~F.col("held_out")).select("doc_id", "held_out", "lang_pred", "score")


def op4_url_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand.llm import url_filter
    rules = spark.sql(f"SELECT * FROM {_rules_sql()} AS r(host, path, verdict)")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand.llm import suffix_dedup
    return suffix_dedup.removed(table(spark, sf_dir, "documents"))


def op6_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand.llm import chat
    return chat.rotate(table(spark, sf_dir, "conversations")).withColumn("spans", chat.spans_text(F.col("spans")))


def op1_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand.llm import packing
    from demand.llm.tokenizing import tokenizer_path
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op7_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand.llm import ngram_join
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand.llm import decontaminate
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.mark(docs, table(spark, sf_dir, "benchmark")))


def op9_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand.llm import repair
    from demand.llm.tokenizing import tokenizer_path
    return repair.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2, base=50257)


def op10_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand.llm import hmm
    return hmm.score(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


def op11_phrase_quicksort(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand.llm import collocations
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_mask_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand.llm import ranked_search
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from demand.llm import licenses
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


OP4_SQL = f"""
WITH r(host, path, verdict) AS ({_rules_sql()}),
u AS (SELECT page_id, CASE WHEN url IS NOT NULL AND strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
m AS (SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
             row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host) DESC NULLS LAST, length(r.path) DESC) AS rn
      FROM p LEFT JOIN r ON (p.host = r.host OR suffix(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE rn = 1
"""

OP6_SQL = """
WITH n AS (SELECT conv_id, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS pos
           FROM conversations),
s AS (SELECT DISTINCT conv_id, speaker AS perspective FROM n),
x AS (SELECT n.conv_id, s.perspective, n.pos // 256 AS chunk, n.pos, n.text, n.speaker = s.perspective AS mine,
             CASE WHEN n.speaker = s.perspective THEN '<|assistant|>' || chr(10) ELSE '<|user name=' || n.speaker || '|>' || chr(10) END AS head
      FROM n JOIN s ON n.conv_id IS NOT DISTINCT FROM s.conv_id),
o AS (SELECT *, coalesce(sum(length(head) + length(text) + 8) OVER (PARTITION BY conv_id, perspective, chunk ORDER BY pos
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS place FROM x)
SELECT conv_id, perspective, chunk, count(*) AS n_messages,
       string_agg(head || text || '<|end|>' || chr(10), '' ORDER BY pos) AS rendered,
       string_agg(CASE WHEN mine THEN '1' ELSE '0' END, '' ORDER BY pos) AS mask,
       coalesce(string_agg(CAST(CAST(place AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(place + length(text) AS BIGINT) AS VARCHAR), ',' ORDER BY pos)
                FILTER (WHERE mine), '') AS spans,
       CAST(coalesce(sum(length(text)) FILTER (WHERE mine), 0) AS BIGINT) AS n_target_chars
FROM o GROUP BY conv_id, perspective, chunk
"""

# Words end at every byte that is no digit, letter or part of a non-ASCII character; as characters, that is U+0080 and up.
OP8_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, i, i + least(len(w), 10) - 1) AS p
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS p
       FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) CROSS JOIN sizes WHERE i + n - 1 <= len(w)),
occ AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.p = bw.p),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""



OP11_SQL = """
WITH p AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents)),
g AS (SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 5) AS r(k) WHERE len(w) >= k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 30),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
cut AS (SELECT c.lang, c.phrase, c.k, c.a, j, fl.f AS l, fr.f AS r, CAST((CAST(2000000 AS HUGEINT) * c.a) // (fl.f + fr.f) AS BIGINT) AS score
        FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
        JOIN f fl ON fl.lang = c.lang AND fl.phrase = array_to_string(list_slice(c.w, 1, j), ' ')
        JOIN f fr ON fr.lang = c.lang AND fr.phrase = array_to_string(list_slice(c.w, j + 1, c.k), ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
longer AS (SELECT lang, phrase, max(f) AS f FROM (
             SELECT lang, a AS f, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase
             FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c WHERE k >= 3)))
           GROUP BY lang, phrase)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best LEFT JOIN longer USING (lang, phrase) JOIN n USING (lang)
WHERE longer.f IS NULL OR CAST(longer.f AS HUGEINT) * 100 < CAST(a AS HUGEINT) * 80
QUALIFY rank <= 2000
"""


OP12_SQL = """
WITH q AS (SELECT item_id, term, count(*) AS r
           FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
                 FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item_id, term),
d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
s AS (SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d),
f AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY rid, term),
t AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM f GROUP BY term), s),
v AS (SELECT rid, doc_id, 75 + (25 * len(w) * n_docs) // n_terms AS m FROM d, s WHERE len(w) > 0),
x AS (SELECT q.item_id, v.rid, any_value(v.doc_id) AS doc_id, CAST(sum(q.r * t.w * ((1000000000 * f.tf) // (1000 * f.tf + 12 * v.m))) AS BIGINT) AS score
      FROM q JOIN f USING (term) JOIN t USING (term) JOIN v USING (rid) GROUP BY q.item_id, v.rid)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM x WHERE score > 0 QUALIFY rank <= 20
"""


def _licenses_sql() -> str:
    """Starts by the rarest words of each wording, words compared by relative position, key phrases verified."""
    from demand.llm import licenses
    rows = [f"({t}, '{label}', {len(ws)}, {len(key)}, {phrase}, {i}, '{x}', {i in key})"
            for t, (label, ws, key, phrase) in enumerate(licenses._entries(licenses.PHRASES, licenses.TEMPLATES)) for i, x in enumerate(ws)]
    return f"""
WITH t(t, label, n, n_key, phrase, i, x, is_key) AS (VALUES {", ".join(rows)}),
d AS (SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
o AS MATERIALIZED (SELECT * FROM (SELECT rid, unnest(w) AS x, unnest(range(len(w))) AS p FROM d) WHERE x IN (SELECT x FROM t)),
f AS (SELECT x, count(DISTINCT rid) AS df FROM o GROUP BY x),
r AS (SELECT t, x FROM (SELECT t, x, phrase, row_number() OVER (PARTITION BY t ORDER BY df, x) AS k
                        FROM (SELECT DISTINCT t.t, t.x, t.phrase, coalesce(f.df, 0) AS df FROM t LEFT JOIN f USING (x)))
      WHERE k <= CASE WHEN phrase THEN 1 ELSE 4 END),
tr AS (SELECT t.*, r.x IS NOT NULL AS rare FROM t LEFT JOIN r USING (t, x)),
need AS (SELECT t, least(2, count(*)) AS n_rare FROM tr WHERE rare GROUP BY t),
s AS (SELECT DISTINCT o.rid, tr.t, o.p - tr.i AS start FROM o JOIN tr ON o.x = tr.x AND tr.rare),
m AS (SELECT s.rid, s.t, s.start, any_value(tr.label) AS label, any_value(tr.phrase) AS phrase, count(*) / any_value(tr.n) AS share
      FROM s JOIN tr USING (t) JOIN o ON o.rid = s.rid AND o.x = tr.x AND o.p = s.start + tr.i JOIN need USING (t)
      GROUP BY s.rid, s.t, s.start
      HAVING count(*) FILTER (tr.is_key) = any_value(tr.n_key) AND count(*) FILTER (tr.rare) >= any_value(need.n_rare)
         AND count(*) / any_value(tr.n) >= CASE WHEN any_value(tr.phrase) THEN 1 ELSE 0.8 END),
g AS (SELECT rid, count(*) FILTER (phrase) AS n_base, min(start) FILTER (phrase) AS first_word, max(start) FILTER (phrase) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
             max(share) AS score FROM m GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN g USING (rid)
"""


QUERIES = {
    "op1_swap_packing": op1_swap_packing,
    "op2_rp_forest": op2_rp_forest,
    "op3_crf_language": op3_crf_language,
    "op4_url_sweep": op4_url_sweep,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_perspectives": op6_perspectives,
    "op7_partenum": op7_partenum,
    "op8_fm_index": op8_fm_index,
    "op9_repair": op9_repair,
    "op10_hmm": op10_hmm,
    "op11_phrase_quicksort": op11_phrase_quicksort,
    "op12_mask_search": op12_mask_search,
    "op13_license_index": op13_license_index,
}
ORACLES = {"op4_url_sweep": OP4_SQL, "op6_perspectives": OP6_SQL, "op8_fm_index": OP8_SQL,
           "op11_phrase_quicksort": OP11_SQL, "op12_mask_search": OP12_SQL, "op13_license_index": _licenses_sql()}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
