"""N-gram Jaccard self-join by PartEnum signatures, reported as components.

A document's set holds the 64-bit hashes of its distinct 5-word shingles (words ``[^\\x20\\x09-\\x0D]+`` after
lower-casing A-Z; fewer words: the whole sequence as one). Documents with equal sets form a *class* (a hash of the set).

*Signatures.* Sizes fall in bands [4^i, 4^(i+1)); a band also takes the sets just above it that a member could
still resemble. In a band the feature domain is hashed to groups of ``n2`` partitions, and for each group all subsets
of ``n2 - k2`` partitions are enumerated: a signature is the set's (non-empty) projection on such a subset. Let r be a
set and s a set with Jaccard >= 3/4: at most K = |r| / 3 features differ, so at most K' = K * C(n2-1, n2-k2-1) of r's signatures
are missing in s, and the other way round. With signatures in one global order, the least common one therefore is among
the first K' + 1 of both: only these are kept, and sufficiently similar sets share one. r must have more than K' signatures for
that; partitions are so many that it does, and a set that had not would stop the job rather than lose links.

*Order.* Rare first, by the binary logarithm of how often a signature's rarest shingle occurs. Those with a shingle that occurs
in one set only can match nothing and are not even sent, so a set with enough text of its own sends nothing; and sets that share
a common line or passage do not meet for that, as long as a third of their signatures is rarer. How often a shingle occurs
is counted by buckets from 24 bits of its hash, for all shingles of all documents; a chance collision only moves a
signature in the order, which may be any, as long as it is one.

A set of which more than a quarter occurs nowhere else cannot be similar to any and is left out at once.

*Candidates.* Signatures travel as blobs by bucket; a bucket yields the lists of classes that share one; lists that
overlap form candidate components.

*Verification* is exact, on whole texts. The classes of a component meet in one block; a component of more than
``block_classes`` is dealt to blocks in two steps: all its classes meet one head (that with the least text of its own), and those
not linked to it then meet all others, block by block. In a block a class is compared with all classes not yet in its component
that pass two upper bounds (sizes with shingles that occur nowhere else; bits that differ between bitmaps of the two sets), by
100 * intersection >= 75 * union. The links found give the final components.

Defined results: null and empty texts have an empty set and are linked with nothing; repeated rows are copies; the smallest
non-null doc_id names the component. Other columns are dropped.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demand.llm.common import (BASE, LOWER_ARRAY, bucket_count, chunks, discard, flat, lean, lean_group, mix, pack, pack_planes, piece_hashes,
                               powers, small_side, span_index, string_array, text_bytes, texts, unpack, unpack_planes,
                               written, written_at)
from demand.llm.components import components

SHINGLE, NUM, DEN = 5, 75, 100
CHUNK_BYTES = 4 << 20
PARTS = "kind int, bucket int, chunk long, a binary, b binary"
PART_SCHEMA = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])


# ---- sets --------------------------------------------------------------------------------------------------------

def shingle_sets(column, n: int = SHINGLE):
    """(hashes, size per text): the distinct shingle hashes of each text, ascending."""
    data, offsets = flat(column)
    split = pc.ascii_split_whitespace(string_array(LOWER_ARRAY[data], offsets))
    values, bounds = split.flatten(), split.offsets.to_numpy()
    raw, at = flat(values)
    some = np.diff(at) > 0
    count = np.add.reduceat(np.append(some, False).astype(np.int64), bounds[:-1]) if len(bounds) > 1 else np.empty(0, np.int64)
    count[np.diff(bounds) == 0] = 0
    word = piece_hashes(raw, at)[some]
    weight = powers(BASE ^ 0x5555AAAA, n + 1)[1:]
    total = np.zeros(len(word), np.uint64)
    for j in range(min(n, len(word))):
        total[:len(word) - j] += word[j:] * weight[j]
    doc = np.repeat(np.arange(len(count)), count)
    left = np.repeat(np.cumsum(count), count) - np.arange(len(word))  # words from here to the end of the text
    whole = left >= n
    short = np.flatnonzero((count > 0) & (count < n))
    first = (np.cumsum(count) - count)[short]
    brief = np.zeros(len(short), np.uint64)
    for j in range(n - 1):
        there = count[short] > j
        brief[there] += word[first[there] + j] * weight[j]
    brief += count[short].astype(np.uint64)
    hashes = mix(np.concatenate([total[whole], brief]))
    doc = np.concatenate([doc[whole], short])
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (np.diff(doc) != 0) | (hashes[1:] != hashes[:-1])
    return hashes[new], np.bincount(doc[new], minlength=len(count))


def classes_of(hashes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Class of each set (as a non-negative long); -1 for an empty set."""
    start = np.cumsum(size) - size
    out = np.full(len(size), -1, np.int64)
    some = np.flatnonzero(size)
    if len(some):
        a = np.add.reduceat(mix(hashes ^ np.uint64(0xA5A5A5A55A5A5A5A)), start[some])
        b = np.bitwise_xor.reduceat(hashes * np.uint64(BASE), start[some])
        out[some] = (mix(a + mix(b) + size[some].astype(np.uint64)) >> np.uint64(1)).astype(np.int64)
    return out


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """100 * |x & y| >= 75 * |x | y| of two ascending arrays of distinct values."""
    small, large = sorted((len(x), len(y)))
    if DEN * small < NUM * large:
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return DEN * common >= NUM * (len(both) - common)


# ---- signatures ---------------------------------------------------------------------------------------------------

def _band_members(size: np.ndarray):
    """(band, text numbers) of every band with its own sets and those just above it."""
    size = np.asarray(size)
    if not size.max(initial=0):
        return
    for band in range(int(size.max()).bit_length() // 2 + 1):
        low, high = 4 ** band, 4 ** (band + 1)
        rows = np.flatnonzero((size >= low) & (NUM * size <= DEN * (high - 1)))
        if len(rows):
            yield band, rows


def signatures(hashes: np.ndarray, size: np.ndarray, level: np.ndarray, n2: int = 2, k2: int = 1):
    """(signature, text number) to send for each set; ``level``: per shingle, how common it is (0: in no other set)."""
    start = np.cumsum(size) - size
    heavy = level
    own = np.bincount(np.repeat(np.arange(len(size)), size)[level == 0], minlength=len(size))
    keep = n2 - k2
    out_sig, out_doc = [], []
    for band, rows in _band_members(size):
        n = size[rows]
        take = np.repeat(start[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        h, doc, w = hashes[take], np.repeat(np.arange(len(rows)), n), heavy[take]
        limit = DEN * 4 ** (band + 1) // NUM
        # small sets: one partition per feature; else about twice as many partitions as features
        cell = h if band < 3 else mix(h ^ np.uint64(band)) % np.uint64(2 * n2 * limit)
        group, member = cell // np.uint64(n2), (cell % np.uint64(n2)).astype(np.int64)
        sig, owner, light = [], [], []
        for number, subset in enumerate(combinations(range(n2), keep)):
            inside = np.isin(member, subset)
            order = np.lexsort((group[inside], doc[inside]))
            d, g, x, y = doc[inside][order], group[inside][order], mix(h[inside][order]), w[inside][order]
            if not len(d):
                continue
            head = np.flatnonzero(np.concatenate([[True], (np.diff(d) != 0) | (g[1:] != g[:-1])]))
            total = np.add.reduceat(x, head)
            sig.append(mix(total + mix(g[head] * np.uint64(64) + np.uint64(number)) + np.uint64(band)))
            owner.append(d[head])
            light.append(np.minimum.reduceat(y, head))
        sig, owner, light = np.concatenate(sig), np.concatenate(owner), np.concatenate(light)
        order = np.lexsort((sig, light, owner))
        sig, owner, light = sig[order], owner[order], light[order]
        have = np.bincount(owner, minlength=len(rows))
        need = (n * (DEN - NUM) // NUM) * comb(n2 - 1, keep - 1) + 1
        if (have < need).any():
            raise ValueError("a set has too few partitions for a certain signature; use more partitions")
        place = np.arange(len(owner)) - np.repeat(np.cumsum(have) - have, have)
        alive = 4 * own[rows] <= n  # similar sets share three quarters of each
        kept = (place < need[owner]) & (light > 0) & alive[owner]
        out_sig.append(sig[kept])
        out_doc.append(rows[owner[kept]])
    if not out_sig:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(out_sig), np.concatenate(out_doc)


# ---- jobs --------------------------------------------------------------------------------------------------------

BITS = np.uint64(24)


def _keys(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 24 further bits of each shingle, in one number."""
    bucket = hashes % np.uint64(buckets)
    return (bucket << BITS | hashes >> (np.uint64(64) - BITS)).astype(np.int64)


def _store(buckets: int):
    """Chunks -> documents with size and class (kind 0), the texts of the chunk's classes (kind 1), and their shingles' keys
    per bucket (kind 2): ascending, with the number of the chunk's classes that have them (255 at most)."""

    def run(batches):
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        for chunk in chunks(batches, CHUNK_BYTES):
            hashes, size = shingle_sets(chunk.column("text"))
            cls = classes_of(hashes, size)
            ids = chunk.column("doc_id")
            rows = [{"kind": 0, "bucket": 0, "chunk": number, "b": b"", "a": pack(np.stack(
                [ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), size, cls, chunk.column("tkey").to_numpy()],
                axis=1), np.int64)}]
            _, one = np.unique(cls, return_index=True)  # copies within the chunk count once
            one = np.sort(one[size[one] > 0])
            if len(one):
                text, at = flat(chunk.column("text").take(pa.array(one)))
                rows.append({"kind": 1, "bucket": 0, "chunk": number, "a": pack(text.tobytes(), level=3), "b": pack(np.diff(at), np.int64)})
                keys, times = np.unique(_keys(hashes[span_index((np.cumsum(size) - size)[one], size[one])], buckets), return_counts=True)
                cut = np.searchsorted(keys >> int(BITS), np.arange(buckets + 1))
                rows += [{"kind": 2, "bucket": b, "chunk": number, "a": pack_planes(np.diff(keys[cut[b]:cut[b + 1]], prepend=b << int(BITS))),
                          "b": pack(np.minimum(times[cut[b]:cut[b + 1]], 255), np.uint8)} for b in np.flatnonzero(np.diff(cut)).tolist()]
            yield pa.RecordBatch.from_pylist(rows, PART_SCHEMA)
            number += 1

    return run


def _key_levels(key, table):
    """One bucket: for each chunk the level of each key: the binary logarithm of how often it occurs (0: once), 30 at most."""
    keys = [np.cumsum(unpack_planes(x).astype(np.int64)) for x in table.column("a").to_pylist()]
    times = np.concatenate([unpack(x, np.uint8) for x in table.column("b").to_pylist()])
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    levels = np.minimum(np.log2(np.bincount(place, weights=times)), 30).astype(np.uint8)[place]
    cut = np.cumsum([len(x) for x in keys])[:-1]
    return pa.Table.from_pylist([{"kind": 3, "bucket": key[0].as_py(), "chunk": c, "a": pack(x), "b": b""}
                                 for c, x in zip(table.column("chunk").to_pylist(), np.split(levels, cut), strict=True)], PART_SCHEMA)


def _signed(buckets: int, n2: int, k2: int):
    """A chunk's stored texts and answers -> signatures with classes per bucket (kind 4), and the texts of classes that
    sent any (kind 5, with the number of shingles that occur nowhere else)."""

    def run(key, mine, answers):
        rows, flags = [], dict(zip(answers.column("bucket").to_pylist(), answers.column("a").to_pylist(), strict=True))
        for a, b in zip(mine.column("a").to_pylist(), mine.column("b").to_pylist(), strict=True):
            column = string_array(unpack(a), np.concatenate([[0], np.cumsum(unpack(b, np.int64))]))
            hashes, size = shingle_sets(column)
            cls = classes_of(hashes, size)
            keys, place = np.unique(_keys(hashes, buckets), return_inverse=True)
            cut = np.searchsorted(keys >> int(BITS), np.arange(buckets + 1))
            level = np.zeros(len(keys), np.uint8)
            for n, raw in flags.items():
                level[cut[n]:cut[n + 1]] = unpack(raw, np.uint8)
            level = level[place]
            sig, doc = signatures(hashes, size, level, n2, k2)
            bucket = (sig % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            sig, owner = sig[order], cls[doc[order]]
            at = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rows += [{"kind": 4, "bucket": n, "chunk": 0, "a": pack(sig[at[n]:at[n + 1]]), "b": pack(owner[at[n]:at[n + 1]])}
                     for n in np.flatnonzero(np.diff(at)).tolist()]
            alone = np.bincount(np.repeat(np.arange(len(size)), size)[level == 0], minlength=len(size))
            rows += [{"kind": 5, "bucket": int(alone[i]), "chunk": int(cls[i]), "a": column[i].as_py().encode(), "b": b""}
                     for i in np.unique(doc).tolist()]
        return pa.Table.from_pylist(rows, PART_SCHEMA)

    return run


def _lists(table):
    """One bucket: the distinct lists of two or more classes that share a signature."""
    sig = np.concatenate([unpack(x, np.uint64) for x in table.column("a").to_pylist()])
    cls = np.concatenate([unpack(x, np.int64) for x in table.column("b").to_pylist()])
    order = np.argsort(sig, kind="stable")
    sig, cls = sig[order], cls[order]
    multi = np.zeros(len(sig), bool)
    same = sig[1:] == sig[:-1]
    multi[1:] |= same
    multi[:-1] |= same
    sig, cls = sig[multi], cls[multi]
    order = np.lexsort((cls, sig))
    sig, cls = sig[order], cls[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (cls[1:] != cls[:-1])
    sig, cls = sig[new], cls[new]
    head = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.empty(0, np.int64)
    size = np.diff(np.append(head, len(sig)))
    many = np.repeat(size > 1, size)
    cls, size = cls[many], size[size > 1]
    if not len(size):
        return pa.table({"list": pa.array([], pa.int64()), "members": pa.array([], pa.list_(pa.int64()))})
    head = np.cumsum(size) - size
    name = mix(np.add.reduceat(mix(cls.view(np.uint64)), head) + size.astype(np.uint64))
    _, one = np.unique(name, return_index=True)
    lists = pa.ListArray.from_arrays(pa.array(np.append(head, len(cls)), pa.int32()), pa.array(cls)).take(pa.array(one))
    return pa.table({"list": pa.array(name[one].view(np.int64)), "members": lists})


WORDS = 64


class Block:
    """Sets of some classes, with the bounds that rule pairs out, and the labels of their components so far."""

    def __init__(self, table):
        _, one = np.unique(table.column("cls").to_numpy(), return_index=True)  # a class may stand in several chunks
        table = table.take(pa.array(one))
        self.cls, self.own = table.column("cls").to_numpy(), table.column("own").to_numpy().astype(np.int64)
        self.sets, self.bits = [], np.zeros((len(self.cls), WORDS), np.uint64)
        for i in range(0, len(self.cls), 512):
            hashes, size = shingle_sets(table.column("text").slice(i, 512))
            self.sets += np.split(hashes, np.cumsum(size)[:-1])
            slot = np.repeat(np.arange(len(size)), size) * (64 * WORDS) + (hashes % np.uint64(64 * WORDS)).astype(np.int64)
            odd = (np.bincount(slot, minlength=len(size) * 64 * WORDS) & 1).astype(np.uint8)  # each feature flips its bit
            self.bits[i:i + len(size)] = np.packbits(odd).view(np.uint64).reshape(-1, WORDS)
        self.size = np.array([len(x) for x in self.sets], np.int64)
        self.label = np.arange(len(self.cls))

    def possible(self, x: int) -> np.ndarray:
        """Classes outside x's component that no bound rules out."""
        both = self.size[x] + self.size
        most = np.minimum(self.size[x] - self.own[x], self.size - self.own)
        y = np.flatnonzero((DEN * most >= NUM * (both - most)) & (self.label != self.label[x]))
        differ = np.bitwise_count(self.bits[y] ^ self.bits[x]).sum(axis=1, dtype=np.int64)
        return y[differ * (DEN + NUM) <= (DEN - NUM) * both[y]]

    def link(self, order) -> list[tuple[int, int]]:
        """Links of the classes in ``order`` with all others, as a forest."""
        links = []
        for x in order:
            for y in self.possible(x).tolist():
                if self.label[y] != self.label[x] and similar(self.sets[x], self.sets[y]):
                    links.append((int(self.cls[x]), int(self.cls[y])))
                    self.label[self.label == self.label[y]] = self.label[x]
        return links


def _links(rows) -> pa.Table:
    return pa.table({"a": pa.array([x for x, _ in rows], pa.int64()), "b": pa.array([y for _, y in rows], pa.int64())})


def _component(table):
    """All links of one small component, as a forest."""
    block = Block(table)
    return _links(block.link(np.argsort(block.own, kind="stable").tolist()))


FIELDS = ["cls", "own", "text"]


def _other(table):
    """The classes of a cogroup's right side (its columns have names of their own)."""
    return table.select(["x_" + f for f in FIELDS]).rename_columns(FIELDS)


def _with_head(left, right):
    """Of one block of a large component: (head, class) for classes linked to the head, (class, class) for others."""
    if not left.num_rows or not right.num_rows:
        return _links([])
    head = right.column("x_cls")[0].as_py()
    block = Block(pa.concat_tables([left.select(FIELDS), _other(right)]))
    at = int(np.searchsorted(block.cls, head))
    near = {y for y in block.possible(at).tolist() if similar(block.sets[at], block.sets[y])}
    return _links([(head, c) if i in near else (c, c) for i, c in enumerate(block.cls.tolist()) if c != head])


def _with_rest(left, right):
    """Links of the classes on the right, not linked to the head, with those on the left."""
    if not left.num_rows or not right.num_rows:
        return _links([])
    block = Block(pa.concat_tables([left.select(FIELDS), _other(right)]))
    linked = np.unique(left.column("cls").to_numpy()[left.column("linked").to_numpy(zero_copy_only=False)])
    block.label[np.isin(block.cls, linked)] = len(block.cls)  # all of them are linked to the head
    return _links(block.link(np.flatnonzero(np.isin(block.cls, right.column("x_cls").to_numpy())).tolist()))


def _large(rows: DataFrame, block_classes: int) -> DataFrame:
    """Links of components with more than ``block_classes`` classes."""
    slot = lambda n: F.pmod(F.xxhash64("cls"), n).cast("int")
    blocks = (rows.groupBy("component").agg(F.ceil(F.count("*") / block_classes).cast("int").alias("blocks"),
                                            F.min_by("cls", F.struct("own", "cls")).alias("head")))
    rows = rows.join(small_side(blocks), "component").withColumn("slot", slot(F.col("blocks")))
    theirs = [F.col(f).alias("x_" + f) for f in FIELDS]
    heads = (rows.where("cls = head").dropDuplicates(["component"])
             .select(F.col("component").alias("of"), *theirs, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("at")))
    first = written(rows.select("component", "slot", *FIELDS).groupBy("component", "slot")
                    .cogroup(heads.groupBy("of", "at")).applyInArrow(lean_group(_with_head), "a long, b long"), "jaccard-heads")
    rest = first.where("a = b").select(F.col("a").alias("cls")).distinct().withColumn("rest", F.lit(True))
    rows = rows.join(small_side(rest), "cls", "left").withColumn("rest", F.coalesce("rest", F.lit(False)))
    parts = (rows.where("rest").groupBy("component").agg(F.ceil(F.count("*") / block_classes).cast("int").alias("parts")))
    asked = (rows.where("rest").join(small_side(parts), "component").dropDuplicates(["cls"])
             .select(F.col("component").alias("of"), *theirs, F.pmod(F.xxhash64("cls", F.lit(1)), F.col("parts")).cast("int").alias("with"),
                     F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("at")))
    every = (rows.join(small_side(parts), "component").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("component", "part", "slot", *FIELDS, (~F.col("rest")).alias("linked")))
    more = (every.groupBy("component", "part", "slot").cogroup(asked.groupBy("of", "with", "at"))
            .applyInArrow(lean_group(_with_rest), "a long, b long"))
    return first.where("a != b").unionByName(more)


def join(docs: DataFrame, n2: int = 2, k2: int = 1, block_classes: int = 3000) -> DataFrame:
    """(doc_id, n_shingles, tkey, component, component_id) of every document; tkey is a hash of its text."""
    docs = texts(docs).withColumn("tkey", F.xxhash64("text"))
    buckets = bucket_count(text_bytes(docs))
    parts, path = written_at(docs.mapInArrow(lean(_store(buckets)), PARTS), "jaccard-parts", "kind")
    shared = parts.where("kind = 2").select("bucket", "chunk", "a", "b").groupBy("bucket").applyInArrow(lean_group(_key_levels), PARTS)
    signed = written(parts.where("kind = 1").select("chunk", "a", "b").groupBy("chunk")
                     .cogroup(shared.select(F.col("chunk").alias("of"), "bucket", "a").groupBy("of"))
                     .applyInArrow(lean_group(_signed(buckets, n2, k2)), PARTS), "jaccard-signed", "kind")
    for kind in (1, 2):
        discard(docs.sparkSession, f"{path}/kind={kind}")

    def rows(batches):
        for batch in batches:
            for a in batch.column("a").to_pylist():
                t = unpack(a, np.int64).reshape(-1, 5)
                yield pa.RecordBatch.from_arrays([pa.array(t[:, 0], mask=t[:, 1] == 1), pa.array(t[:, 2]), pa.array(t[:, 3]), pa.array(t[:, 4])],
                                                 names=["doc_id", "n_shingles", "cls", "tkey"])

    members = parts.where("kind = 0").select("a").mapInArrow(lean(rows), "doc_id long, n_shingles long, cls long, tkey long")
    lists = written(signed.where("kind = 4").select("bucket", "a", "b").groupBy("bucket")
                    .applyInArrow(lean_group(_lists), "list long, members array<long>")
                    .groupBy("list").agg(F.first("members").alias("members")), "jaccard-lists")
    near = written(components(lists.select(F.col("members")[0].alias("a"), F.explode("members").alias("b"))), "jaccard-near")
    size = near.groupBy("component").agg(F.count("*").alias("classes"))
    sets = (signed.where("kind = 5").select(F.col("chunk").alias("cls"), F.col("bucket").alias("own"), F.col("a").cast("string").alias("text"))
            .join(small_side(near.join(size, "component").withColumnRenamed("node", "cls")), "cls"))
    small = (sets.where(F.col("classes") <= block_classes).select("component", "cls", "own", "text")
             .groupBy("component").applyInArrow(lean_group(_component), "a long, b long"))
    large = written(sets.where(F.col("classes") > block_classes).select("component", "cls", "own", "text"), "jaccard-large")
    links = written(small.unionByName(_large(large, block_classes)), "jaccard-links")
    linked = components(links).select(F.col("node").alias("cls"), "component")
    placed = written(members.join(linked, "cls", "left").withColumn("component", F.coalesce("component", "cls")), "jaccard-members")
    smallest = placed.where("cls >= 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return (placed.where("cls >= 0").join(smallest, "component")
            .unionByName(placed.where("cls < 0").withColumn("component_id", F.col("doc_id")))
            .select("doc_id", "n_shingles", "tkey", "component", "component_id"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each component (the smallest non-null doc_id); those with empty sets all stay."""
    found = join(docs, **options)
    key = {"__null": F.col("doc_id").isNull(), "__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0))}
    named = found.withColumns(key)
    first = (named.where("n_shingles > 0").groupBy("component").agg(F.min(F.struct("__null", "__id", "tkey")).alias("x"))
             .select("x.*").withColumnRenamed("tkey", "__tkey"))
    rows = docs.withColumns(key).withColumn("__tkey", F.xxhash64(F.coalesce("text", F.lit(""))))
    kept = rows.join(first, ["__null", "__id", "__tkey"], "left_semi").dropDuplicates(["__null", "__id", "__tkey"])
    empty = rows.where(F.coalesce(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(True)))
    return kept.unionByName(empty).select(*docs.columns)
