"""Suffix-array dedup: remove every byte covered by a 200-byte string that starts anywhere else.

*Anchors.* Equal strings must meet in one task without moving all suffixes there. In every window of ``length``
bytes the smallest hashed ``GRAM``-gram (leftmost of ties) is its anchor, so equal windows have equal anchors at the
same place, and consecutive windows share one. Anchors whose gram occurs once cannot be in a repeated window; the
others' *contexts* (the bytes of all their windows) go to a bucket by gram, copies within a chunk only once.

*Suffix sort.* In a bucket, contexts that occur twice have all windows repeated. The rest of a gram's contexts are sorted by
what follows the anchor, and again by what precedes it, read backward: a mergesort over all grams at once whose
comparisons find the common extension by binary search over prefix polynomial hashes, in logarithmic time. Neighbours'
extensions are then compared byte by byte; a collision would have the bucket sorted by plain bytes. Two windows at one
place before their anchor are equal if no neighbour between them in the first order extends less than the bytes after the
anchor, nor in the second less than the bytes before it: both are running counts, and equal pairs of counts mark
repeated windows.

*Hot grams.* A gram with more than ``HOT`` places (a passage in many documents, whose edges differ in each) is not sorted in
one bucket: its windows, distinct per chunk, are dealt by 128-bit digests of their bytes, and repeated digests mark them.

Answers go back per chunk as window ranges; a chunk's stored texts are cut there. Texts are stored once
in the shared folder; grams travel as 8 bytes, contexts only for repeated grams.

Defined results: strings are judged on the input; matches never cross documents; a text shorter than ``length`` keeps all its
bytes; null texts are empty; repeated rows are copies and lose what repeats. A cut inside a character leaves
bytes that are not UTF-8: the query's checksum takes the bytes, ``dedup_texts`` widens such a cut to whole characters.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from demand.llm.common import BASE, bucket_count, chunks, flat, lean, lean_group, mix, pack, powers, runs, span_index, text_bytes, unpack, written

LENGTH, GRAM = 200, 32
#: Places of a gram from which its windows are compared one by one, dealt by their digests.
HOT = 4096
CHUNK_BYTES = 4 << 20
PARTS = "kind int, bucket int, chunk long, a binary, b binary, c binary, d binary"
PART_SCHEMA = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int64()), *[(x, pa.binary()) for x in "abcd"]])
INVERSE = pow(BASE, -1, 1 << 64)


# ---- anchors -----------------------------------------------------------------------------------------------------

def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the gram at each place, by prefix hashes; equal grams hash alike at any place."""
    n = len(data)
    if n < gram:
        return np.empty(0, np.uint64)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=prefix[1:])
    return mix((prefix[gram:] - prefix[:-gram]) * powers(INVERSE, n - gram + 1))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(gram hash, anchor place, first window, last window) of every run of windows that share an anchor."""
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none, none, none
    hashed = gram_hashes(data, gram)
    bits = np.uint64(max(1, len(data).bit_length()))
    places = np.arange(len(hashed), dtype=np.uint64)
    least = sliding_min((hashed >> bits) << bits | places, length - gram + 1)
    start = np.arange(len(least))
    end_of = np.repeat(offsets[1:], np.diff(offsets))[:len(least)]
    whole = start + length <= end_of
    anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = whole & np.concatenate([[True], (anchor[1:] != anchor[:-1]) | ~whole[:-1]])
    first = np.flatnonzero(new)
    stop = whole & np.concatenate([(anchor[1:] != anchor[:-1]) | ~whole[1:], [True]])
    last = np.flatnonzero(stop)
    return hashed[anchor[first]], anchor[first], first, last


def pieces(offsets: np.ndarray, length: int, most: int):
    """Byte ranges that hold every window once: long texts overlap by length - 1 bytes. (start, end) per range."""
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        while b - a > most:
            yield a, a + most
            a += most - length + 1
        yield a, b


# ---- suffix sort ------------------------------------------------------------------------------------------------

class Contexts:
    """Byte strings in a row, with hashes of all their prefixes."""

    def __init__(self, blob: np.ndarray, start: np.ndarray, size: np.ndarray):
        self.blob, self.start, self.size = blob, start, size
        place = np.arange(len(blob)) - np.repeat(start, size)
        most = int(size.max(initial=0)) + 1
        self.prefix = np.zeros(len(blob) + 1, np.uint64)
        np.cumsum((blob.astype(np.uint64) + np.uint64(1)) * powers(BASE, most)[place], out=self.prefix[1:])
        self.inverse = powers(INVERSE, most)

    def common(self, x, y, at_x, at_y):
        """Length of the common extension of suffixes at ``at`` of contexts x and y: binary search over hashes."""
        a, b = self.start[x] + at_x, self.start[y] + at_y
        low, high = np.zeros(len(x), np.int64), np.minimum(self.size[x] - at_x, self.size[y] - at_y)
        pa_, pb, ia, ib = self.prefix[a], self.prefix[b], self.inverse[at_x], self.inverse[at_y]
        while (open_ := low < high).any():
            mid = (low + high + 1) // 2
            same = (self.prefix[a + mid] - pa_) * ia == (self.prefix[b + mid] - pb) * ib
            low = np.where(open_ & same, mid, low)
            high = np.where(open_ & ~same, mid - 1, high)
        return low

    def less(self, x, y, at_x, at_y):
        """Suffix of x before that of y; a prefix comes first, ties by number."""
        n = self.common(x, y, at_x, at_y)
        ends_x, ends_y = at_x + n >= self.size[x], at_y + n >= self.size[y]
        last = len(self.blob) - 1
        bx, by = self.blob[np.minimum(self.start[x] + at_x + n, last)], self.blob[np.minimum(self.start[y] + at_y + n, last)]
        return np.where(ends_x | ends_y, np.where(ends_x & ends_y, x < y, ends_x), bx < by)

    def bytes_of(self, x: int, at: int) -> bytes:
        return self.blob[self.start[x] + at:self.start[x] + self.size[x]].tobytes()


def suffix_sort(ctx: Contexts, group: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Mergesort of the suffixes ``at`` of all contexts within their (contiguous) groups."""
    n = len(group)
    order = np.arange(n)
    head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else np.empty(0, np.int64)
    size = np.diff(np.append(head, n))
    local = np.arange(n) - np.repeat(head, size)
    base, total = np.repeat(head, size), np.repeat(size, size)
    width = 1
    while width < size.max(initial=1):
        run = local // width
        other = base + (run ^ 1) * width  # the run it merges with
        stop = np.minimum(other + width, base + total)
        live = np.flatnonzero(other < base + total)
        lo, hi = other[live].copy(), stop[live].copy()
        me = order[live]
        while (open_ := np.flatnonzero(lo < hi)).size:  # how many of the other run come before me
            mid = (lo[open_] + hi[open_]) // 2
            peer, own = order[mid], me[open_]
            before = ctx.less(peer, own, at[peer], at[own])
            lo[open_] = np.where(before, mid + 1, lo[open_])
            hi[open_] = np.where(before, hi[open_], mid)
        target = np.arange(n)
        merged = base[live] + (run[live] // 2) * 2 * width
        target[live] = merged + (local[live] - run[live] * width) + (lo - other[live])
        new = np.empty_like(order)
        new[target] = order
        order = new
        width *= 2
    return order


def neighbours(ctx: Contexts, group: np.ndarray, at: np.ndarray):
    """(order, common extension of each place with the one before; -1 at a group's head), verified by bytes."""
    order = suffix_sort(ctx, group, at)
    n = len(order)
    ext = np.full(n, -1, np.int64)
    inner = np.flatnonzero(group[order[1:]] == group[order[:-1]]) + 1 if n else np.empty(0, np.int64)
    x, y = order[inner - 1], order[inner]
    ext[inner] = ctx.common(x, y, at[x], at[y])
    if _wrong(ctx, x, y, at, ext[inner]):  # a hash collision: sort by the bytes themselves
        order = np.array(sorted(range(n), key=lambda i: (group[i], ctx.bytes_of(i, at[i]), i)), np.int64)
        x, y = order[inner - 1], order[inner]
        ext[inner] = [_bytes_in_common(ctx.bytes_of(i, at[i]), ctx.bytes_of(j, at[j])) for i, j in zip(x.tolist(), y.tolist(), strict=True)]
    return order, ext


def _wrong(ctx: Contexts, x, y, at, ext) -> bool:
    """Whether some extension covers different bytes, or is not the longest, or is out of order."""
    for i in range(0, len(x), 50_000):
        s = slice(i, i + 50_000)
        a, b, n = ctx.start[x[s]] + at[x[s]], ctx.start[y[s]] + at[y[s]], ext[s]
        if (ctx.blob[span_index(a, n)] != ctx.blob[span_index(b, n)]).any():
            return True
        ends_x, ends_y = at[x[s]] + n >= ctx.size[x[s]], at[y[s]] + n >= ctx.size[y[s]]
        inner = ~ends_x & ~ends_y
        if (ctx.blob[(a + n)[inner]] >= ctx.blob[(b + n)[inner]]).any() or (ends_y & ~ends_x).any():
            return True
    return False


def _bytes_in_common(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    differ = np.frombuffer(x, np.uint8, n) != np.frombuffer(y, np.uint8, n)
    return int(differ.argmax()) if differ.any() else n


def repeated_windows(ctx: Contexts, group: np.ndarray, lead: np.ndarray, length: int):
    """(context, distance) of windows equal to a window of another context of their group.

    ``lead`` is the anchor's place in a context: window ``d`` starts d bytes before it, for d = lead, lead - 1, ...
    down to lead + length - size. Contexts of a group differ and stand together."""
    back = Contexts(ctx.blob[np.repeat(2 * ctx.start + ctx.size - 1, ctx.size) - np.arange(len(ctx.blob))], ctx.start, ctx.size)
    right, right_ext = neighbours(ctx, group, lead)
    left, left_ext = neighbours(back, group, ctx.size - lead)
    right_place, left_place = np.empty_like(right), np.empty_like(left)
    right_place[right], left_place[left] = np.arange(len(right)), np.arange(len(left))
    least, most = lead + length - ctx.size, lead
    found = []
    for d in range(int(least.min(initial=0)), int(most.max(initial=-1)) + 1):
        here = np.flatnonzero((least <= d) & (d <= most))
        if len(here) < 2:
            continue
        key = np.cumsum(right_ext < length - d)[right_place[here]] * np.int64(len(group) + 1) + np.cumsum(left_ext < d)[left_place[here]]
        order = np.argsort(key, kind="stable")
        same = np.diff(key[order]) == 0
        twin = np.zeros(len(here), bool)
        twin[1:] |= same
        twin[:-1] |= same
        rows = here[order[twin]]
        found.append(np.stack([rows, np.full(len(rows), d)], axis=1))
    return np.concatenate(found) if found else np.empty((0, 2), np.int64)


# ---- jobs --------------------------------------------------------------------------------------------------------

def _store(buckets: int, length: int, gram: int, carry: list[str]):
    """Chunks -> stored texts with anchors (kind 0) and the distinct grams per bucket (kind 1)."""

    def run(batches):
        from pyspark import TaskContext
        chunk = TaskContext.get().partitionId() << 32
        for batch in chunks(batches, CHUNK_BYTES):
            data, offsets = flat(batch.column("text"))
            found = []
            if len(data) <= 2 * CHUNK_BYTES:
                found.append(anchors(data, offsets, length, gram))
            else:  # one very long text
                for a, b in pieces(offsets, length, CHUNK_BYTES):
                    h, p, f, last = anchors(data[a:b], np.array([0, b - a]), length, gram)
                    found.append((h, p + a, f + a, last + a))
            h, p, f, last = [np.concatenate(x) for x in zip(*found, strict=True)]
            names, number, count = np.unique(h, return_inverse=True, return_counts=True)
            bucket = (names % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")  # grams in bucket order: answers are one flag per gram
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            with pa.BufferOutputStream() as sink:
                kept = pa.Table.from_batches([batch.select(carry)])
                with pa.ipc.new_stream(sink, kept.schema) as writer:
                    writer.write_table(kept)
                raw = sink.getvalue().to_pybytes()
            yield pa.RecordBatch.from_pylist([{
                "kind": 0, "bucket": 0, "chunk": chunk, "a": pack(raw), "b": pack(np.stack([p, p - f, last - f]), np.int32),
                "c": pack(place[number], np.int32), "d": pack(names[order])}], PART_SCHEMA)
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            names, many = names[order], count[order]
            rows = [{"kind": 1, "bucket": b, "chunk": chunk, "a": pack(names[cut[b]:cut[b + 1]]),
                     "b": pack(many[cut[b]:cut[b + 1]], np.int32), "c": b"", "d": b""} for b in np.flatnonzero(np.diff(cut)).tolist()]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, PART_SCHEMA)
            chunk += 1

    return run


def _repeated_grams(hot: int):
    """One bucket: for each chunk a flag per gram, whether it occurs twice anywhere, and one whether more than ``hot`` times."""

    def run(key, table):
        names = [unpack(x, np.uint64) for x in table.column("a").to_pylist()]
        many = np.concatenate([unpack(x, np.int32) for x in table.column("b").to_pylist()])
        _, number = np.unique(np.concatenate(names), return_inverse=True)
        total = np.bincount(number, weights=many)[number]
        cut = np.cumsum([len(x) for x in names])[:-1]
        return pa.Table.from_pylist([{"kind": 2, "bucket": key[0].as_py(), "chunk": c, "a": pack(np.packbits(x > 1)),
                                      "b": pack(np.packbits(x > hot)), "c": b"", "d": b""}
                                     for c, x in zip(table.column("chunk").to_pylist(), np.split(total, cut), strict=True)], PART_SCHEMA)

    return run


def _distinct(digests: np.ndarray):
    """(distinct rows of an n x 2 array, number of each row)."""
    order = np.lexsort((digests[:, 1], digests[:, 0]))
    ordered = digests[order]
    new = np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(axis=1)]) if len(order) else np.empty(0, bool)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], number


def _window_digests(raw: bytes, first: np.ndarray, span: np.ndarray, buckets: int, length: int):
    """Distinct 128-bit digests of all windows of some contexts in bucket order, the number of each window, cuts per bucket."""
    out = bytearray()
    for f, s in zip(first.tolist(), span.tolist(), strict=True):
        for w in range(f, f + s + 1):
            out += hashlib.blake2b(raw[w:w + length], digest_size=16).digest()
    names, number = _distinct(np.frombuffer(out, "<u8").reshape(-1, 2))
    bucket = (names[:, 0] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return names[order], place[number], np.searchsorted(bucket[order], np.arange(buckets + 1))


def _window_runs(who: np.ndarray, window: np.ndarray) -> np.ndarray:
    """(context, first window, last window) of runs of consecutive windows, ordered by context and window."""
    new = np.concatenate([[True], (np.diff(who) != 0) | (np.diff(window) != 1)]) if len(who) else np.empty(0, bool)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(who)) - 1 if len(head) else head
    return np.stack([who[head], window[head], window[tail]], axis=1)


def _opened(store, what):
    """The parts of a store row: (bytes, offsets), anchors, gram numbers, grams."""
    table = pa.ipc.open_stream(unpack(store["a"])).read_all()
    place, lead, span = unpack(store["b"], np.int32).astype(np.int64).reshape(3, -1)
    return table, (place - lead, lead, span), unpack(store["c"], np.int32), unpack(store["d"], np.uint64)


def _representatives(store, answers, buckets: int, length: int):
    """Of a chunk's anchors with repeated grams: a number each, and per number (distinct context) its parts, by bucket.

    The same call on the same rows gives the same numbers, so ranges come back by number."""
    table, (first, lead, span), number, names = _opened(store, None)
    data, offsets = flat(table.column("text"))
    flags, hot = np.zeros(len(names), bool), np.zeros(len(names), bool)
    cut = np.searchsorted((names % np.uint64(buckets)).astype(np.int64), np.arange(buckets + 1))
    for b, twice, often in answers:
        flags[cut[b]:cut[b + 1]] = np.unpackbits(unpack(twice, np.uint8), count=cut[b + 1] - cut[b])
        hot[cut[b]:cut[b + 1]] = np.unpackbits(unpack(often, np.uint8), count=cut[b + 1] - cut[b])
    rows = np.flatnonzero(flags[number])
    rows = rows[np.argsort(number[rows], kind="stable")]
    first, lead, span, number = first[rows], lead[rows], span[rows], number[rows]
    known: dict[tuple, int] = {}
    raw, rep = data.tobytes(), np.empty(len(rows), np.int64)
    for i, (f, l, s, n) in enumerate(zip(first.tolist(), lead.tolist(), span.tolist(), number.tolist(), strict=True)):
        rep[i] = known.setdefault((n, l, raw[f:f + s + length]), len(known))
    one = np.unique(rep, return_index=True)[1]
    return table, data, offsets, first, span, rep, one, lead, names[number[one]], np.bincount(rep, minlength=len(one)), hot[number[one]]


def _contexts(buckets: int, length: int):
    def run(key, mine, answers):
        flags = list(zip(*[answers.column(x).to_pylist() for x in "bucket a b".split()], strict=True))
        rows = []
        for store in mine.to_pylist():
            _, data, _, first, span, _, one, lead, names, count, hot = _representatives(store, flags, buckets, length)
            few = np.flatnonzero(~hot)
            bucket = (names[few] % np.uint64(buckets)).astype(np.int64)  # ascending, as grams are in bucket order
            cut = np.searchsorted(bucket, np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cut)).tolist():
                own = few[cut[b]:cut[b + 1]]
                part = one[own]
                size = span[part] + length
                rows.append({"kind": 3, "bucket": b, "chunk": store["chunk"], "a": pack(data[span_index(first[part], size)]),
                             "b": pack(names[own]), "c": pack(np.stack([size, lead[part], count[own] > 1]), np.int32),
                             "d": pack(own, np.int64)})
            if hot.any():
                part = one[hot]
                digests, number, cut = _window_digests(data.tobytes(), first[part], span[part], buckets, length)
                many = np.bincount(number, weights=np.repeat(count[hot], span[part] + 1)) > 1
                rows += [{"kind": 5, "bucket": b, "chunk": store["chunk"], "a": pack(digests[cut[b]:cut[b + 1]], "<u8"),
                          "b": pack(many[cut[b]:cut[b + 1]], np.uint8), "c": b"", "d": b""} for b in np.flatnonzero(np.diff(cut)).tolist()]
        return pa.Table.from_pylist(rows, PART_SCHEMA)

    return run


def _repeated_digests(key, table) -> list[dict]:
    """One bucket: for each chunk a flag per digest, whether its window occurs twice anywhere."""
    names = [unpack(x, "<u8").reshape(-1, 2) for x in table.column("a").to_pylist()]
    many = np.concatenate([unpack(x, np.uint8) for x in table.column("b").to_pylist()])
    number = _distinct(np.concatenate(names))[1]
    flags = (np.bincount(number, weights=1 + many) > 1)[number]
    cut = np.cumsum([len(x) for x in names])[:-1]
    return [{"kind": 6, "bucket": key[0].as_py(), "chunk": c, "a": pack(np.packbits(x)), "b": b"", "c": b"", "d": b""}
            for c, x in zip(table.column("chunk").to_pylist(), np.split(flags, cut), strict=True)]


def _resolve(length: int):
    """One bucket: ranges of repeated windows per chunk, as (context number, first window, last window); flags of digests."""

    def run(key, table):
        hot = table.filter(pc.equal(table.column("kind"), 5))
        table = table.filter(pc.equal(table.column("kind"), 3))
        rows = _repeated_digests(key, hot) if hot.num_rows else []
        if not table.num_rows:
            return pa.Table.from_pylist(rows, PART_SCHEMA)
        chunk, base, names, parts, blobs = [], [], [], [], []
        for c, a, b, m, d in zip(*[table.column(x).to_pylist() for x in ("chunk", "a", "b", "c", "d")], strict=True):
            blobs.append(unpack(a, np.uint8))
            names.append(unpack(b, np.uint64))
            parts.append(unpack(m, np.int32).astype(np.int64).reshape(3, -1))
            chunk.append(np.full(len(names[-1]), c))
            base.append(unpack(d, np.int64))
        blob, names, chunk, base = np.concatenate(blobs), np.concatenate(names), np.concatenate(chunk), np.concatenate(base)
        size, lead, many = np.concatenate(parts, axis=1)
        start, raw = np.cumsum(size) - size, blob.tobytes()
        known: dict[tuple, int] = {}
        cls = np.empty(len(names), np.int64)
        for i, (n, s, z, l) in enumerate(zip(names.tolist(), start.tolist(), size.tolist(), lead.tolist(), strict=True)):
            cls[i] = known.setdefault((n, l, raw[s:s + z]), len(known))
        one = np.unique(cls, return_index=True)[1]
        twice = np.bincount(cls, weights=1 + many) > 1
        # grams with several contexts of which some occur once: sort those
        order = np.argsort(names[one], kind="stable")
        _, group, members = np.unique(names[one][order], return_inverse=True, return_counts=True)
        single = np.bincount(group, weights=~twice[order]) > 0
        hard = order[((members > 1) & single)[group]]
        spans = [np.stack([np.flatnonzero(twice), np.zeros(twice.sum(), np.int64), (size - length)[one][twice]], axis=1)]
        if len(hard):
            own = one[hard]
            z = size[own]
            ctx = Contexts(blob[span_index(start[own], z)], np.cumsum(z) - z, z)
            _, group = np.unique(names[own], return_inverse=True)
            found = repeated_windows(ctx, group, lead[own], length)
            found = found[~twice[hard[found[:, 0]]]]
            window = lead[own][found[:, 0]] - found[:, 1]
            order = np.lexsort((window, found[:, 0]))
            same = _window_runs(found[order, 0], window[order])
            spans.append(np.concatenate([hard[same[:, :1]], same[:, 1:]], axis=1))
        spans = np.concatenate(spans)
        # every chunk's context of a class gets the class's ranges
        spans = spans[np.argsort(spans[:, 0], kind="stable")]
        lo, hi = np.searchsorted(spans[:, 0], cls), np.searchsorted(spans[:, 0], cls, side="right")
        pick, owner = span_index(lo, hi - lo), np.repeat(np.arange(len(cls)), hi - lo)
        out = np.stack([base[owner], spans[pick, 1], spans[pick, 2]], axis=1)
        for c in np.unique(chunk[owner]).tolist():
            rows.append({"kind": 4, "bucket": key[0].as_py(), "chunk": c, "a": pack(out[chunk[owner] == c], np.int64), "b": b"", "c": b"", "d": b""})
        return pa.Table.from_pylist(rows, PART_SCHEMA)

    return run


def _cover(store, answers, ranges, windows, buckets: int, length: int):
    """(table, bytes, offsets, removed flag per byte) of a chunk."""
    table, data, offsets, first, span, rep, one, *_, hot = _representatives(store, answers, buckets, length)
    if hot.any():
        part = one[hot]
        digests, number, cut = _window_digests(data.tobytes(), first[part], span[part], buckets, length)
        flags = np.zeros(len(digests), bool)
        for b, raw in windows:
            flags[cut[b]:cut[b + 1]] = np.unpackbits(unpack(raw, np.uint8), count=cut[b + 1] - cut[b])
        hit, n = flags[number], span[part] + 1
        ranges = [*ranges, _window_runs(np.repeat(np.flatnonzero(hot), n)[hit], span_index(np.zeros(len(n), np.int64), n)[hit])]
    edge = np.zeros(len(data) + 1, np.int32)
    if ranges:
        out = np.concatenate(ranges)
        out = out[np.argsort(out[:, 0], kind="stable")]
        lo, hi = np.searchsorted(out[:, 0], rep), np.searchsorted(out[:, 0], rep, side="right")
        pick, owner = span_index(lo, hi - lo), np.repeat(np.arange(len(rep)), hi - lo)
        np.add.at(edge, first[owner] + out[pick, 1], 1)
        np.add.at(edge, first[owner] + out[pick, 2] + length, -1)
    return table, data, offsets, np.cumsum(edge[:-1]) > 0


def _digest(table, data, offsets, gone):
    n = np.diff(offsets)
    total = np.concatenate([[0], np.cumsum(gone)])
    head = gone & np.concatenate([[True], ~gone[:-1]])
    if len(gone):
        head[offsets[:-1][n > 0]] = gone[offsets[:-1][n > 0]]
    heads = np.concatenate([[0], np.cumsum(head)])
    sha = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        kept = data[a:b] if total[b] == total[a] else data[a:b][~gone[a:b]]
        sha.append(hashlib.sha256(kept.tobytes()).hexdigest())
    return pa.table({"doc_id": table.column("doc_id").cast(pa.int64()), "n_bytes": pa.array(n, pa.int64()),
                     "n_removed": pa.array(total[offsets[1:]] - total[offsets[:-1]], pa.int64()),
                     "n_spans": pa.array(heads[offsets[1:]] - heads[offsets[:-1]], pa.int64()), "kept_sha256": sha})


def _cut(table, data, offsets, gone):
    """The table with its texts cut; a cut inside a character takes the whole character."""
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        part, flag = data[a:b], gone[a:b]
        if flag.any():
            char = np.cumsum((part & 0xC0) != 0x80) - 1
            hit = np.bincount(char, weights=flag)[char] > 0
            part = part[~hit]
        out.append(part.tobytes().decode())
    return table.set_column(table.schema.get_field_index("text"), "text", pa.array(out, pa.string()))


def _run(docs: DataFrame, finish, schema, length: int, gram: int, hot: int) -> DataFrame:
    """Store, find repeated grams, resolve their contexts, and finish every chunk with its removed bytes."""
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    carry = docs.columns
    buckets = bucket_count(text_bytes(docs))
    parts = written(docs.mapInArrow(lean(_store(buckets, length, gram, carry)), PARTS), "suffix-parts", "kind")
    store = parts.where("kind = 0").select("chunk", "a", "b", "c", "d")
    flags = written(parts.where("kind = 1").select("bucket", "chunk", "a", "b").groupBy("bucket").applyInArrow(lean_group(_repeated_grams(hot)), PARTS), "suffix-grams")
    asked = flags.select("chunk", "bucket", "a", "b")
    contexts = written(store.groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInArrow(lean_group(_contexts(buckets, length)), PARTS), "suffix-contexts")
    ranges = written(contexts.select("kind", "bucket", "chunk", "a", "b", "c", "d").groupBy("bucket").applyInArrow(lean_group(_resolve(length)), PARTS), "suffix-ranges")
    both = flags.unionByName(ranges).select(F.col("chunk").alias("of"), "kind", "bucket", "a", "b")

    def run(key, mine, answers):
        rows = list(zip(*[answers.column(x).to_pylist() for x in ("kind", "bucket", "a", "b")], strict=True))
        bits, found = [(b, a, o) for k, b, a, o in rows if k == 2], [unpack(a, np.int64).reshape(-1, 3) for k, _, a, _ in rows if k == 4]
        windows = [(b, a) for k, b, a, _ in rows if k == 6]
        return pa.concat_tables([finish(*_cover(x, bits, found, windows, buckets, length)) for x in mine.to_pylist()])

    return store.groupBy("chunk").cogroup(both.groupBy("of")).applyInArrow(lean_group(run), schema)


def removed(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    return _run(docs.select("doc_id", "text"), _digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", length, gram, hot)


def dedup_texts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``docs`` with the repeated strings cut from ``text`` (null texts empty); all columns stay."""
    schema = StructType([StructField("text", StringType()) if f.name == "text" else f for f in docs.schema.fields])
    return _run(docs, _cut, schema, length, gram, hot)
