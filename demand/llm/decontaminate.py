"""Benchmark decontamination with one FM-index per shard of training text.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z (digits, small letters, everything that is
not ASCII). A test phrase is a window of ``window`` consecutive words of a benchmark item; an item with
fewer words, but not none, is one phrase. A document word inside any occurrence of a phrase is *hit*.

Per shard (a bounded chunk of documents): words outside the benchmark's vocabulary cannot be in an occurrence,
so the text is cut there and stretches shorter than the shortest phrase fall away (exact, not a heuristic). The rest
is a sequence of word ids with a separator after each stretch; its suffix array (prefix doubling that re-sorts
only tied groups) gives the Burrows-Wheeler transform, kept as a wavelet tree of bit vectors with rank counts.
All phrases are searched backward at once; occurrences are located by walking back to sampled suffix
positions (every ``sample`` words and each stretch start); overlapping occurrences are merged to spans.

The phrases are broadcast in blocks of at most ``block_phrases``; one block is one pass, more blocks are
more passes whose spans are merged per document. Documents are never shuffled.

Defined results: a null text has no words; items with null id or without words give no phrase; repeated items and
documents are kept; an empty benchmark hits nothing. Other columns of the documents are passed on.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from demand.llm.common import chunks, flat, lean, runs, span_index, string_array

#: Small letters, digits and bytes of non-ASCII characters as they are, capitals lowered, the rest a space.
WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
WORD_ARRAY = np.frombuffer(WORD_BYTES, np.uint8)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split()


# ---- phrases -------------------------------------------------------------------------------------------------------

def phrases(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id string, phrase string): distinct windows of each item."""

    def run(batches):
        for batch in batches:
            ids, out = batch.column("item_id").to_pylist(), []
            for item, text in zip(ids, batch.column("text").to_pylist(), strict=True):
                w = words_of(text)
                for i in range(max(1, len(w) - window + 1) if w else 0):
                    out.append((item, b" ".join(w[i:i + window]).decode()))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string())],
                                             names=["item_id", "phrase"])

    rows = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    return (rows.select(F.col("item_id").cast("string").alias("item_id"), "text")
            .mapInArrow(run, "item_id string, phrase string").distinct())


class Phrases:
    """One block of phrases as word ids (from 1), by phrase, with the items of each phrase."""

    def __init__(self, rows):
        by_phrase: dict[str, list[str]] = {}
        for r in rows:
            by_phrase.setdefault(r["phrase"], []).append(r["item_id"])
        split = [p.split(" ") for p in by_phrase]
        self.vocabulary = list(dict.fromkeys(chain.from_iterable(split)))
        number = {w: i + 1 for i, w in enumerate(self.vocabulary)}
        self.size = np.array([len(s) for s in split], np.int64)
        self.ids = np.zeros((len(split), int(self.size.max()) if len(split) else 0), np.int64)
        for i, s in enumerate(split):
            self.ids[i, :len(s)] = [number[w] for w in s]
        self.items = list(by_phrase.values())


# ---- index -------------------------------------------------------------------------------------------------------

def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of ids in which 0 separates; separators differ from each other and sort first, in text order."""
    n = len(text)
    if n == 0:
        return np.empty(0, np.int64)
    sep = np.flatnonzero(text == 0)
    key = text.astype(np.int64) + len(sep)
    key[sep] = np.arange(len(sep))
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    new = np.concatenate([[True], np.diff(key[order]) != 0])
    heads = np.flatnonzero(new)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))  # a tied group has its first place as rank
    width = 1
    while True:
        tied = np.flatnonzero(~new | ~np.append(new[1:], True))  # places of groups with two or more members
        if not len(tied):
            return order
        at = order[tied]
        after = at + width
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        first = rank[at]
        sub = np.lexsort((second, first))
        order[tied] = at[sub]
        f, s = first[sub], second[sub]
        new[tied[1:]] = (f[1:] != f[:-1]) | (s[1:] != s[:-1])
        new[tied[0]] = True
        heads = np.flatnonzero(new[tied])
        rank[order[tied]] = np.repeat(tied[heads], np.diff(np.append(heads, len(tied))))
        width *= 2


class FMIndex:
    """Counts, wavelet tree of the transform, and sampled positions of a separated id sequence."""

    def __init__(self, text: np.ndarray, sampled: np.ndarray):
        order = suffix_array(text)
        n = len(text)
        symbols = text[order - 1] if n else text
        self.n = n
        self.levels = max(1, int(text.max() if n else 0).bit_length())
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << self.levels))])
        self.ones, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (symbols >> level) & 1
            count = np.zeros(n + 1, np.int32)
            np.cumsum(bit, out=count[1:])
            self.ones.append(count)
            self.zeros.append(n - int(count[-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        kept = sampled[order]
        self.kept = np.concatenate([[0], np.cumsum(kept)]).astype(np.int32)
        self.places = order[kept]

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before row i of the transform."""
        low = np.zeros_like(i)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = (symbol >> (self.levels - 1 - k)) & 1 == 1
            low, i = (np.where(bit, zeros + ones[low], low - ones[low]), np.where(bit, zeros + ones[i], i - ones[i]))
        return i - low

    def back(self, row: np.ndarray) -> np.ndarray:
        """Row of the suffix one place earlier (not across a separator)."""
        symbol, i, low = np.zeros_like(row), row, np.zeros_like(row)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            bit = ones[i + 1] - ones[i] == 1
            symbol = symbol * 2 + bit
            low, i = (np.where(bit, zeros + ones[low], low - ones[low]), np.where(bit, zeros + ones[i], i - ones[i]))
        return self.first[symbol] + i - low

    def search(self, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of all phrases by backward search; empty where a phrase does not occur."""
        low, high = np.zeros(len(size), np.int64), np.full(len(size), self.n, np.int64)
        live = np.arange(len(size))
        for step in range(int(size.max()) if len(size) else 0):
            ended = size[live] <= step
            live = live[(low[live] < high[live]) & ~ended]
            if not len(live):
                break
            c = ids[live, size[live] - 1 - step]
            known = c < len(self.first) - 1
            high[live[~known]] = low[live[~known]]
            live, c = live[known], c[known]
            low[live] = self.first[c] + self.rank(c, low[live])
            high[live] = self.first[c] + self.rank(c, high[live])
        return low, np.maximum(low, high)

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Text position of each row."""
        place, steps, open_ = np.empty(len(row), np.int64), 0, np.arange(len(row))
        while len(open_):
            there = self.kept[row + 1] > self.kept[row]
            place[open_[there]] = self.places[self.kept[row[there]]] + steps
            open_, row = open_[~there], self.back(row[~there])
            steps += 1
        return place


def find(ids: np.ndarray, doc_of: np.ndarray, block: Phrases, sample: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(word position, phrase) of every occurrence in a shard; ids: 0 is a word outside the vocabulary."""
    none = np.empty(0, np.int64)
    if not len(block.size) or not len(ids):
        return none, none
    least = int(block.size.min())
    known = ids > 0
    edge = np.flatnonzero(known & np.concatenate([[True], ~known[:-1] | (np.diff(doc_of) != 0)]))
    stop = np.flatnonzero(known & np.concatenate([~known[1:] | (np.diff(doc_of) != 0), [True]])) + 1
    long = stop - edge >= least
    edge, stop = edge[long], stop[long]
    if not len(edge):
        return none, none
    size = stop - edge
    start = np.cumsum(size + 1) - (size + 1)  # of each stretch in the reduced text, a separator after each
    text = np.zeros(int(size.sum()) + len(size), np.int64)
    inside = span_index(start, size)
    word = span_index(edge, size)
    text[inside] = ids[word]
    word_at = np.zeros(len(text), np.int64)
    word_at[inside] = word
    sampled = np.ones(len(text), bool)
    sampled[inside] = (inside - np.repeat(start, size)) % sample == 0
    index = FMIndex(text, sampled)
    low, high = index.search(block.ids, block.size)
    count = high - low
    row = span_index(low, count)
    return word_at[index.locate(row)], np.repeat(np.arange(len(count)), count)


# ---- documents ---------------------------------------------------------------------------------------------------

def shard_hits(column, block: Phrases, vocabulary: pa.Array):
    """Per document of a chunk: word count; hit flag per word; word offsets; (document, phrase) pairs; normalised bytes."""
    data, offsets = flat(column)
    lowered = WORD_ARRAY[data]
    words = pc.ascii_split_whitespace(string_array(lowered, offsets))
    values, bounds = words.flatten(), words.offsets.to_numpy()
    blank = pc.equal(values, "").to_numpy(zero_copy_only=False)  # the split gives empty pieces at the ends
    keep = ~blank
    count = np.add.reduceat(np.append(keep, False).astype(np.int64), bounds[:-1])
    count[np.diff(bounds) == 0] = 0
    ids = pc.fill_null(pc.add(pc.index_in(values, value_set=vocabulary), 1), 0).to_numpy(zero_copy_only=False)[keep].astype(np.int64)
    first = np.concatenate([[0], np.cumsum(count)])
    doc_of = np.repeat(np.arange(len(count)), count)
    place, phrase = find(ids, doc_of, block)
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, place, 1)
    np.add.at(edge, place + block.size[phrase] if len(phrase) else place, -1)
    hit = np.cumsum(edge)[:-1] > 0
    pairs = np.unique(np.stack([doc_of[place], phrase], axis=1), axis=0) if len(place) else np.empty((0, 2), np.int64)
    return count, first, hit, pairs, lowered, offsets


def _rows(batch, block: Phrases, vocabulary, fields):
    count, first, hit, pairs, lowered, offsets = shard_hits(batch.column("text"), block, vocabulary)
    items: list[set] = [set() for _ in count]
    for d, p in pairs.tolist():
        items[d].update(block.items[p])
    spans: list[list] = [[] for _ in count]
    if hit.any():
        solid = lowered != 32
        starts, ends = [], []
        for i in np.unique(pairs[:, 0]).tolist():  # only documents with a hit need byte places
            s, e = runs(solid[offsets[i]:offsets[i + 1]])
            a, b = runs(hit[first[i]:first[i + 1]])
            starts, ends = s[a].tolist(), e[b - 1].tolist()
            spans[i] = [{"start": x, "end": y} for x, y in zip(starts, ends, strict=True)]
    n_hit = np.diff(np.concatenate([[0], np.cumsum(hit)])[first])
    more = [pa.array(count, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
    return pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *fields])


#: Bytes of text in one index.
SHARD_BYTES = 6 << 20
NEW = ("n_words", "n_hit", "hit_items", "hit_spans")
SPANS = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))


def mark(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_phrases: int = 1_000_000, cut: bool = False) -> DataFrame:
    """``docs`` (null texts empty) with n_words, n_hit, hit_items (sorted strings) and hit_spans (merged byte ranges).

    ``cut``: the hit spans are cut from the texts as well, by the same tasks if one pass does."""
    docs = docs.drop(*NEW).withColumn("text", F.coalesce("text", F.lit("")))
    schema = StructType([*docs.schema.fields, StructField(NEW[0], LongType()), StructField(NEW[1], LongType()),
                         StructField(NEW[2], ArrayType(StringType())), StructField(NEW[3], SPANS)])
    found = phrases(benchmark, window)
    n = found.count()
    passes = max(1, -(-n // block_phrases))
    sc = docs.sparkSession.sparkContext

    def one_pass(rows):
        block = sc.broadcast(Phrases(rows))  # at most block_phrases phrases of at most `window` words

        def run(batches):
            vocabulary = pa.array(block.value.vocabulary, pa.large_string())
            for chunk in chunks(batches, SHARD_BYTES):
                rows = _rows(chunk, block.value, vocabulary, NEW)
                yield _without_spans(rows) if cut and passes == 1 else rows

        return docs.mapInArrow(lean(run), schema)

    if passes == 1:
        return one_pass(found.collect())
    slot = F.pmod(F.xxhash64("phrase"), F.lit(passes))
    parts = [one_pass(found.where(slot == i).collect()) for i in range(passes)]
    merged = _merge(parts, docs.columns, passes)
    return without_spans(merged) if cut else merged


def _merge(parts: list[DataFrame], columns: list[str], passes: int) -> DataFrame:
    """One row per document from its rows of all passes; equal documents are counted, merged once and repeated."""
    marked = parts[0].withColumn("__pass", F.lit(0))
    for i, p in enumerate(parts[1:], 1):
        marked = marked.unionByName(p.withColumn("__pass", F.lit(i)))
    key = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    once = (marked.withColumn("__key", key).groupBy("__key", "__pass")
            .agg(F.count("*").alias("__copies"), *[F.first(c).alias(c) for c in (*columns, *NEW)]))
    place = Window.partitionBy("__key").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    spans = (once.select("__key", F.explode("hit_spans").alias("x")).select("__key", F.col("x.start").alias("s"), F.col("x.end").alias("e"))
             .withColumn("apart", F.coalesce((F.col("s") > F.max("e").over(place)), F.lit(True)).cast("int"))
             .withColumn("run", F.sum("apart").over(Window.partitionBy("__key").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy("__key", "run").agg(F.min("s").alias("start"), F.max("e").alias("end"))
             .groupBy("__key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("hit_spans")))
    docs = (once.groupBy("__key").agg(F.first("__copies").alias("__copies"), *[F.first(c).alias(c) for c in (*columns, "n_words")],
                                      F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_items")))).alias("hit_items"))
            .join(spans, "__key", "left"))

    def count_words(batches):
        for batch in batches:
            texts, spans_, out = batch.column("text").to_pylist(), batch.column("hit_spans").to_pylist(), []
            for text, found in zip(texts, spans_, strict=True):
                raw = text.encode()
                out.append(sum(len(raw[x["start"]:x["end"]].translate(WORD_BYTES).split()) for x in found or []))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*batch.schema.names, "n_hit"])

    docs = docs.withColumn("hit_spans", F.coalesce("hit_spans", F.array().cast(SPANS)))
    docs = docs.mapInArrow(count_words, StructType([*docs.schema.fields, StructField("n_hit", LongType())]))
    return (docs.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
            .select(*columns, *NEW))


def digest(marked: DataFrame) -> DataFrame:
    """The query's columns from ``mark``."""
    return marked.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def _without_spans(batch):
    out = []
    for text, spans in zip(batch.column("text").to_pylist(), batch.column("hit_spans").to_pylist(), strict=True):
        if spans:
            raw, at, kept = text.encode(), 0, []
            for x in spans:
                kept.append(raw[at:x["start"]])
                at = x["end"]
            text = b"".join([*kept, raw[at:]]).decode()
        out.append(text)
    return batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(out, pa.string()))


def without_spans(marked: DataFrame) -> DataFrame:
    """``mark``'s documents with the hit spans cut from their texts."""
    return marked.mapInArrow(lean(lambda batches: map(_without_spans, batches)), marked.schema)
