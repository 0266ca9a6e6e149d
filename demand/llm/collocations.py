"""Phrase collocations by multikey three-way quicksort of suffix pointers, to the depth of the longest phrase.

A text is lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words ``[^\\x20\\x09]+``. A suffix
pointer is a place in a piece; its first words, up to ``longest``, are its context. All counts are per language.

1. *Routing by leading words.* One pass counts, over all texts, the pointers per slot of a hash of (language, first two
   words); slots follow the input (65,536 to 4,194,304) and make up buckets of at most about ``per_bucket`` pointers.
   A slot that alone holds more is dealt over several buckets by all words of the context.
2. A second pass combines equal contexts of a chunk of text into one pointer with a weight and sends each bucket its
   contexts (binary values: words and word numbers), through coarse buckets first if there are over 1,024.
3. Per bucket the pointers are sorted by three-way partitions: all parts advance together, those less or greater than
   the pivot stay at their depth, equal ones go to the next word. The weight of an equal part is the count of its phrase;
   parts lighter than ``least`` are abandoned, as no phrase in them can be frequent. Where a slot was dealt, its
   shorter phrases come out as partial sums and are abandoned only after Spark added them up.
4. Scores, containment in longer phrases and ranks are joins and aggregates of frequent phrases; parts used by
   very many phrases are salted.

Nothing that grows with the vocabulary is broadcast or collected, only the slots' counts.

Defined results: null text is empty, null language ``und``; repeated rows count each; ids play no part; ties as in ``mine``;
without frequent phrases there are no rows. Other columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demand.llm.common import LOWER_ARRAY, chunks, flat, mix, pack, piece_hashes, small_side, string_array, text_bytes, texts, unpack, written

CHUNK_BYTES = 8 << 20
PER_BUCKET = 1_500_000
COARSE = 1024
#: 0 part of a word, 1 between words, 2 between pieces.
KIND = np.zeros(256, np.uint8)
KIND[[32, 9]] = 1
KIND[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2
SPACED = np.where(KIND > 0, 32, LOWER_ARRAY).astype(np.uint8)
BLOBS = "bucket int, kind int, lang string, words binary, sizes binary, context binary, weight binary"
BLOB_SCHEMA = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("lang", pa.string()),
                         *[(x, pa.binary()) for x in ("words", "sizes", "context", "weight")]])
COUNTED = "lang string, phrase string, f long"
COUNTED_SCHEMA = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])
#: Kinds of contexts: one word; a whole context, its slot in one bucket; a whole context of a slot that was dealt.
WORD, WHOLE, DEALT = 1, 2, 3


def suffixes(column, longest: int):
    """(distinct words, context of each pointer as word numbers, -1 beyond its piece: longest x pointers)."""
    data, offsets = flat(column)
    kind = KIND[data]
    values = pc.ascii_split_whitespace(string_array(SPACED[data], offsets)).flatten()
    coded = values.filter(pc.not_equal(values, "")).dictionary_encode()
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    inside = kind == 0
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    start = np.flatnonzero(inside & ~before)
    piece = np.cumsum(kind == 2)[start] + np.searchsorted(offsets, start, side="right")  # grows at either border
    follows = np.zeros(len(number), bool)
    follows[:-1] = piece[1:] == piece[:-1]
    context = np.full((longest, len(number)), -1, np.int32)
    context[0] = number
    for d in range(1, longest):
        context[d, :-1] = np.where(follows[:-1], context[d - 1, 1:], -1)
    return coded.dictionary, context


def _by_language(batches):
    """(language, texts) of bounded chunks."""
    for batch in chunks(batches, CHUNK_BYTES):
        lang = batch.column("lang")
        for x in pc.unique(lang).to_pylist():
            yield x, batch.column("text").filter(pc.equal(lang, x))


class Router:
    """Buckets of contexts: ``of_slot`` (bucket of a slot, or the first of its buckets), ``parts`` (over how many it is dealt)."""

    def __init__(self, counts: np.ndarray, per_bucket: int):
        self.parts = np.where(counts > per_bucket, -(-counts // per_bucket), 0)
        alone = np.where(self.parts > 0, 0, counts)
        self.of_slot = np.cumsum(alone) // max(1, per_bucket)
        n = int(self.of_slot[-1]) + 1
        dealt = self.parts > 0
        self.of_slot[dealt] = n + np.cumsum(self.parts[dealt]) - self.parts[dealt]
        self.buckets = n + int(self.parts.sum())

    def route(self, hashed, lang: str, context):
        """(bucket, kind) of whole contexts and their words' hashes."""
        slot = slots(hashed, lang, context[:2], len(self.parts))
        bucket, parts = self.of_slot[slot], self.parts[slot]
        dealt = np.flatnonzero(parts)
        if len(dealt):
            whole = _hash(hashed, lang, context[:, dealt])
            bucket[dealt] += (whole >> np.uint64(8)).astype(np.int64) % parts[dealt]
        return bucket, np.where(parts > 0, DEALT, WHOLE)


def _hash(hashed, lang: str, context):
    """64-bit hash of contexts (words by their hashes, so alike in all tasks)."""
    data = np.frombuffer(lang.encode(), np.uint8)
    h = np.full(context.shape[1], piece_hashes(data, np.array([0, len(data)]))[0], np.uint64)
    with_none = np.append(hashed, np.uint64(0))
    for row in context:
        h = mix(h + with_none[row])
    return h


def slots(hashed, lang: str, context, n: int):
    return (_hash(hashed, lang, context) % np.uint64(n)).astype(np.int64)


def _slot_counts(n_slots: int, longest: int):
    """Pointers per slot, added up over a task's chunks."""

    def run(batches):
        total = np.zeros(n_slots, np.int64)
        for lang, column in _by_language(batches):
            words, context = suffixes(column, min(2, longest))
            hashed = piece_hashes(*flat(words))
            total += np.bincount(slots(hashed, lang, np.arange(len(words))[None], n_slots), minlength=n_slots)
            if longest > 1:
                total += np.bincount(slots(hashed, lang, context[:, context[1] >= 0], n_slots), minlength=n_slots)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], names=["slot", "n"])

    return run


def _combined(bucket, kind, context, weight):
    """Equal contexts of a bucket as one, ordered by bucket: (bucket, kind, context, weight)."""
    if not len(bucket):
        return bucket, kind, context, weight
    h = np.zeros(len(bucket), np.uint64)
    for row in context:
        h = (h + row.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    order = np.argsort((bucket.astype(np.uint64) << np.uint64(32)) | (h >> np.uint64(32)))
    bucket, context, kind = bucket[order], context[:, order], kind[order]
    new = np.ones(len(bucket), bool)  # equal hashes of unequal contexts only leave some of them uncombined
    new[1:] = (bucket[1:] != bucket[:-1]) | (context[:, 1:] != context[:, :-1]).any(axis=0)
    first = np.flatnonzero(new)
    return bucket[first], kind[first], context[:, first], np.add.reduceat(weight[order], first)


def _blobs(lang: str, words, bucket, kind, context, weight):
    """One row per bucket and kind: the words its contexts use, and their contexts."""
    cut = np.concatenate([[0], np.flatnonzero((bucket[1:] != bucket[:-1]) | (kind[1:] != kind[:-1])) + 1, [len(bucket)]]) if len(bucket) else [0]
    rows = []
    place = np.empty(len(words) + 1, np.int64)
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        part = context[:, a:b]
        used = np.zeros(len(words) + 1, bool)
        used[part.ravel()] = True  # -1 is the last
        used[-1] = False
        ids = np.flatnonzero(used)
        place[ids] = np.arange(1, len(ids) + 1)
        place[-1] = 0
        data, offsets = flat(words.take(pa.array(ids)))
        width = np.uint16 if len(ids) < 65_535 else np.uint32
        rows.append({"bucket": int(bucket[a]), "kind": int(kind[a]), "lang": lang, "words": pack(data.tobytes()), "sizes": pack(np.diff(offsets), np.uint32),
                     "context": bytes([width().itemsize]) + pack(place[part], width), "weight": pack(weight[a:b], np.int64)})
    return pa.RecordBatch.from_pylist(rows, BLOB_SCHEMA)


def _opened(rows, longest: int):
    """(distinct words, contexts, weights) of the blobs of one language and kind."""
    words, sizes, contexts, weights = [], [], [], []
    for w, s, c, n in rows:
        size = unpack(s, np.uint32).astype(np.int64)
        words.append(string_array(unpack(w), np.concatenate([[0], np.cumsum(size)])))
        sizes.append(len(size))
        weights.append(unpack(n, np.int64))
        contexts.append(unpack(c[1:], np.uint16 if c[0] == 2 else np.uint32).reshape(-1, len(weights[-1])))
    coded = pa.chunked_array(words).combine_chunks().dictionary_encode()
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    first = np.concatenate([[0], np.cumsum(sizes)])
    context = np.concatenate([np.append(number[a:b], np.int32(-1))[c.astype(np.int64) - 1] for a, b, c in zip(first[:-1], first[1:], contexts, strict=True)], axis=1)
    return coded.dictionary, context, np.concatenate(weights)


def _routed(router, longest: int, coarse: int):
    """Chunks of documents -> blobs of combined contexts per (coarse) bucket."""

    def run(batches):
        route = router.value
        for lang, column in _by_language(batches):
            words, context = suffixes(column, longest)
            if not len(words):
                continue
            hashed = piece_hashes(*flat(words))
            one = np.arange(len(words), dtype=np.int32)[None]
            bucket = route.of_slot[slots(hashed, lang, one, len(route.parts))] // coarse
            order = np.argsort(bucket, kind="stable")
            yield _blobs(lang, words, bucket[order], np.full(len(words), WORD), one[:, order], np.bincount(context[0], minlength=len(words))[order])
            if longest > 1:
                context = context[:, context[1] >= 0]
                bucket, kind = route.route(hashed, lang, context)
                yield _blobs(lang, words, *_by_kind(*_combined(bucket // coarse, kind, context, np.ones(len(bucket), np.int64))))

    return run


def _by_kind(bucket, kind, context, weight):
    if not len(bucket) or (kind == kind[0]).all():
        return bucket, kind, context, weight
    order = np.lexsort((kind, bucket))
    return bucket[order], kind[order], context[:, order], weight[order]


def _refined(router, longest: int, at_most: int):
    """Blobs of coarse buckets (in their order) -> blobs of buckets; at most about ``at_most`` contexts are held at a time."""

    def split(held):
        route = router.value
        for (lang, kind), rows in held.items():
            words, context, weight = _opened(rows, longest)
            hashed = piece_hashes(*flat(words))
            if kind == WORD:
                bucket = route.of_slot[slots(hashed, lang, context[:1], len(route.parts))]
            else:
                bucket, _ = route.route(hashed, lang, context)
            yield _blobs(lang, words, *_combined(bucket, np.full(len(bucket), kind), context, weight))

    def run(batches):
        held, size, at = {}, 0, None
        for batch in batches:
            for r in batch.to_pylist():
                if held and (r["bucket"] != at or size > at_most):
                    yield from split(held)
                    held, size = {}, 0
                at = r["bucket"]
                held.setdefault((r["lang"], r["kind"]), []).append((r["words"], r["sizes"], r["context"], r["weight"]))
                size += len(r["context"])  # compressed bytes: a context has one at least, in practice several
        if held:
            yield from split(held)

    return run


def equal_parts(context: np.ndarray, weight: np.ndarray, least: int, report: int = 1, dealt: bool = False):
    """Multikey three-way quicksort of pointers; all parts take one partition step together.

    context: depth x pointers, -1 beyond the end. Returns (pointer, depth, weight) of every part whose members agree in their
    first ``depth`` >= ``report`` words. Parts lighter than ``least`` are abandoned, if ``dealt`` only at full depth."""
    longest = len(context)
    index = np.arange(context.shape[1])
    size, depth = np.array([len(index)]), np.array([0])
    found = []
    bound = 1 if dealt else least
    while len(index):
        part = np.repeat(np.arange(len(size)), size)
        key = context[depth[part], index]
        alive = key >= 0  # pointers whose piece ends here
        total = np.zeros(len(size), np.int64)
        some = size > 0
        total[some] = np.add.reduceat(np.where(alive, weight[index], 0), (np.cumsum(size) - size)[some])
        keep = alive & (total >= bound)[part]
        if not keep.all():
            index, part, key = index[keep], part[keep], key[keep]
            size = np.bincount(part, minlength=len(size))
            some = size > 0
            part = (np.cumsum(some) - 1)[part]
            size, depth = size[some], depth[some]
            if not len(index):
                break
        start = np.cumsum(size) - size
        a, b, c = key[start], key[start + size // 2], key[start + size - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))[part]
        less, more = key < pivot, key > pivot
        n_less, n_more = np.add.reduceat(less, start, dtype=np.int64), np.add.reduceat(more, start, dtype=np.int64)
        n_same = size - n_less - n_more
        before_less, before_more = np.cumsum(less) - less, np.cumsum(more) - more
        rank_less, rank_more = before_less - before_less[start][part], before_more - before_more[start][part]
        within = np.arange(len(index)) - start[part]
        place = start[part] + np.where(less, rank_less, np.where(more, (n_less + n_same)[part] + rank_more, n_less[part] + within - rank_less - rank_more))
        moved = np.empty_like(index)
        moved[place] = index
        running = np.concatenate([[0], np.cumsum(weight[moved])])
        sums = running[start + n_less + n_same] - running[start + n_less]
        deeper = depth + 1
        told = (deeper >= report) & (sums >= np.where(deeper == longest, least, bound))
        if told.any():
            found.append((moved[(start + n_less)[told]], deeper[told], sums[told]))
        size = np.stack([n_less, np.where(deeper < longest, n_same, 0), n_more], axis=1).ravel()
        ended = (deeper >= longest)[part] & (within >= n_less[part]) & (within < (n_less + n_same)[part])
        index = moved[~ended]
        depth = np.stack([depth, deeper, depth], axis=1).ravel()
        depth, size = depth[size > 0], size[size > 0]
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _count(least: int, longest: int):
    """One bucket: (lang, phrase, f) of its frequent phrases (partial sums of dealt slots); phrase null: all its words of a language."""

    def run(table):
        held: dict = {}
        columns = [table.column(x).to_pylist() for x in ("lang", "kind", "words", "sizes", "context", "weight")]
        for lang, kind, *row in zip(*columns, strict=True):
            held.setdefault((lang, kind), []).append(row)
        out = []
        for (lang, kind), rows in held.items():
            words, context, weight = _opened(rows, longest)
            if kind == WORD:
                out.append(pa.table([pa.array([lang], pa.string()), pa.array([None], pa.string()), pa.array([int(weight.sum())], pa.int64())], schema=COUNTED_SCHEMA))
            pointer, depth, total = equal_parts(context, weight, least, report=1 if kind == WORD else 2, dealt=kind == DEALT)
            for d in np.unique(depth).tolist():
                at = pointer[depth == d]
                phrase = words.take(pa.array(context[0][at]))
                for k in range(1, d):
                    phrase = pc.binary_join_element_wise(phrase, words.take(pa.array(context[k][at])), pa.scalar(" ", words.type))
                out.append(pa.table([pa.array([lang] * len(at), pa.string()), phrase.cast(pa.string()), pa.array(total[depth == d], pa.int64())], schema=COUNTED_SCHEMA))
        return pa.concat_tables(out) if out else COUNTED_SCHEMA.empty_table()

    return run


def frequent(docs: DataFrame, longest: int = 4, least: int = 30, per_bucket: int = PER_BUCKET, coarse_buckets: int = COARSE) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, k, f) of all phrases with f >= least, (lang, n) of all languages), both written."""
    lang = F.coalesce(F.col("lang"), F.lit("und")).alias("lang")
    docs = texts(docs, lang).drop("doc_id")
    sc = docs.sparkSession.sparkContext
    wanted = text_bytes(docs) // 5 // per_bucket * 64  # about a pointer per five bytes, 64 slots a bucket
    n_slots = min(1 << 22, max(1 << 16, 1 << int(wanted).bit_length()))
    counts = np.zeros(n_slots, np.int64)
    for r in docs.mapInArrow(_slot_counts(n_slots, longest), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r["slot"]] = r["n"]
    made = Router(counts, per_bucket)
    router = sc.broadcast(made)
    coarse = max(1, -(-made.buckets // coarse_buckets))
    blobs = docs.mapInArrow(_routed(router, longest, coarse), BLOBS)
    if coarse > 1:
        tasks = max(1, int(counts.sum()) // per_bucket)
        salt = F.pmod(F.xxhash64("words"), F.lit(max(1, tasks // coarse_buckets)))
        blobs = blobs.repartition(tasks, "bucket", salt).sortWithinPartitions("bucket").mapInArrow(_refined(router, longest, 16 << 20), BLOBS)
    counted = written(blobs.repartition(made.buckets, "bucket").groupBy("bucket").applyInArrow(_count(least, longest), COUNTED), "phrases-counted")
    phrases = (counted.where("phrase IS NOT NULL").groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
               .withColumn("k", F.size(F.split("phrase", " "))))
    return (written(phrases.select("lang", "phrase", "k", "f"), "phrases-frequent"),
            written(counted.where("phrase IS NULL").groupBy("lang").agg(F.sum("f").alias("n")), "phrases-words"))


def _with_parts(cuts: DataFrame, phrases: DataFrame, per_salt: int) -> DataFrame:
    """``cuts`` (lang, phrase, part, ...) with the count of their part; a part of over ``per_salt`` cuts is dealt over several tasks."""
    hot = cuts.groupBy("lang", "part").agg(F.count("*").alias("uses")).where(F.col("uses") > per_salt)
    hot = small_side(hot.select("lang", "part", F.ceil(F.col("uses") / per_salt).cast("int").alias("salts")))
    salts = F.coalesce("salts", F.lit(1))
    left = cuts.join(hot, ["lang", "part"], "left").withColumn("salt", F.pmod(F.xxhash64("phrase"), salts).cast("int")).drop("salts")
    right = (phrases.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f")).join(hot, ["lang", "part"], "left")
             .withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts"))
    return left.join(right, ["lang", "part", "salt"])


def mine(docs: DataFrame, longest: int = 4, least: int = 30, top: int = 2000, per_salt: int = 50_000, per_bucket: int = PER_BUCKET,
         coarse_buckets: int = COARSE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to ``longest`` words that occur ``least`` times.

    Score: floor(2000000 a / (l + r)) of the lowest-scoring cut in two (ties: the shortest first part); phrases of
    which a longer one holds at least 80 % of the occurrences are left out. By score, then a, then phrase (bytes)."""
    phrases, words = frequent(docs, longest, least, per_bucket, coarse_buckets)
    candidates = phrases.where("k >= 2").select("lang", "phrase", "k", F.col("f").alias("a"))
    first = F.expr("substring_index(phrase, ' ', j)")
    cuts = (candidates.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("j"))
            .withColumn("first", first).withColumn("rest", F.expr("substring(phrase, length(first) + 2)"))
            .select("lang", "phrase", "a", F.explode(F.array(F.struct("j", F.lit("l").alias("side"), F.col("first").alias("part")),
                                                             F.struct("j", F.lit("r").alias("side"), F.col("rest").alias("part")))).alias("x"))
            .select("lang", "phrase", "a", "x.j", "x.side", "x.part"))
    of = lambda j, side: F.max(F.when((F.col("j") == j) & (F.col("side") == side), F.col("part_f")))
    sides = _with_parts(cuts, phrases, per_salt).groupBy("lang", "phrase", "a").agg(
        *[of(j, s).alias(f"{s}{j}") for j in range(1, longest) for s in "lr"])
    exact = "(CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(20, 0))) div (CAST(l{j} AS DECIMAL(20, 0)) + CAST(r{j} AS DECIMAL(20, 0)))"
    cut = F.array_min(F.array(*[F.when(F.col(f"l{j}").isNotNull(), F.struct(F.expr(exact.format(j=j)).alias("score"), F.lit(j).alias("j"), F.col(f"l{j}").alias("l"), F.col(f"r{j}").alias("r")))
                                for j in range(1, longest)]))
    scored = sides.select("lang", "phrase", "a", cut.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    split = F.split("phrase", " ")
    inside = F.explode(F.expr("flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), i -> array_join(slice(w, i, m), ' '))))"))
    covers = (phrases.where("k >= 3").withColumn("w", split).select("lang", "f", inside.alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    apart = scored.join(covers, ["lang", "phrase"], "left").where(
        "longer IS NULL OR CAST(longer AS DECIMAL(20, 0)) * 100 < CAST(a AS DECIMAL(20, 0)) * 80")
    rank = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = apart.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
