"""Best-fit packing of tokenized documents, improved by swap-based local search.

Documents become token ids with an end id; only those longer than ``capacity`` are cut, into pieces of ``capacity``.
Pieces are dealt to groups of about ``group_bins`` sequences by a hash. In a group, best-fit decreasing fills the bins;
then the search takes the least filled underfull bins and moves a piece, exchanges one for one, or
two for one with another underfull bin, whenever that raises the sum of squared fills, so fills drift apart and bins
run empty. Bins that stay below ``keep_fill`` are opened again: their pieces from all groups are dealt to fewer
groups and packed anew, until one group is left or a round no longer halves them.

Scale: a group is bounded by tokens and by pieces; ids never leave the task that made them (only lengths and
checksums are shuffled); rounds shrink at least by half. ``max_passes`` bounds the search in a group, not the rows.

Defined results: a null text is empty and takes one place (its end id); repeated rows are packed each. An empty table
gives no rows. Other columns are dropped.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demand.llm.common import chunks, lean, lean_group, texts, written
from demand.llm.tokenizing import encode, forget, with_end

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, uid long, grp int, bin int, offset long, fill long"


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """One row per piece with the checksum of its ids."""

    def run(batches):
        for batch in chunks(batches, 8 << 20):
            ids, count = with_end(*encode(batch.column("text"), path, spaced=False), end_id)
            raw, stop = memoryview(ids.astype("<u4").tobytes()), np.cumsum(count)
            parts = -(-count // capacity)
            doc = np.repeat(np.arange(len(count)), parts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * capacity
            length = np.minimum(capacity, count[doc] - start)
            at = (stop - count)[doc] + start
            crc = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
        forget()

    return texts(docs).mapInArrow(lean(run), PIECES)


# ---- one group ---------------------------------------------------------------------------------------------------

def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: lists of item numbers."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        wide = rooms >> n
        if wide:
            room = n + (wide & -wide).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[b].append(i)
        else:
            b, room = len(bins), capacity
            bins.append([i])
        room -= n
        if room:
            by_room.setdefault(room, []).append(b)
            rooms |= 1 << room
    return bins


class Search:
    """Local search over the underfull bins of a group; each step raises the sum of squared fills."""

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bins = {k: sorted(b, key=lambda i: lengths[i]) for k, b in enumerate(bins)}
        self.fill = {k: sum(lengths[i] for i in b) for k, b in self.bins.items()}

    def _put(self, k, add=(), drop=()):
        b = self.bins[k]
        for i in drop:
            b.remove(i)
            self.fill[k] -= self.lengths[i]
        for i in add:
            insort(b, i, key=lambda j: self.lengths[j])
            self.fill[k] += self.lengths[i]

    def _gain(self, victim, k) -> bool:
        """Move, exchange one for one or two for one from ``victim`` into bin ``k``; the fullest result wins."""
        mine, theirs, size = self.bins[victim], self.bins[k], self.lengths
        room, need = self.capacity - self.fill[k], max(1, self.fill[victim] - self.fill[k] + 1)
        if need > room:
            return False
        sizes = [size[i] for i in mine]
        best = (need - 1, None)
        j = bisect_right(sizes, room) - 1  # the largest piece that fits moves over
        if j >= 0 and sizes[j] > best[0]:
            best = (sizes[j], ((mine[j],), ()))
        last = None
        for o in theirs:
            if best[0] == room:
                break
            out = size[o]
            if out == last:
                continue
            last = out
            j = bisect_right(sizes, room + out) - 1  # one for one
            if j >= 0 and sizes[j] - out > best[0]:
                best = (sizes[j] - out, ((mine[j],), (o,)))
            lo, hi = 0, len(sizes) - 1  # two for one: the pair with the largest sum that fits
            while lo < hi and best[0] < room:
                got = sizes[lo] + sizes[hi] - out
                if got > room:
                    hi -= 1
                else:
                    if got > best[0]:
                        best = (got, ((mine[lo], mine[hi]), (o,)))
                    lo += 1
        if best[1] is None:
            return False
        give, take = best[1]
        self._put(victim, add=take, drop=give)
        self._put(k, add=give, drop=take)
        return True

    def run(self, max_passes: int, neighbours: int) -> list[list[int]]:
        """Empty the least filled bins into fuller ones, the fullest first. Past ``neighbours`` of them a victim goes on only
        until one gained; without a gain it has met a bin of every larger fill, and waits until a bin changes."""
        changes, failed = 0, {}
        for _ in range(max_passes):
            open_ = sorted((k for k, f in self.fill.items() if f < self.capacity), key=lambda k: self.fill[k])
            changed = False
            for victim in open_:
                if not self.bins[victim] or failed.get(victim) == changes:
                    continue
                fuller = sorted((k for k in open_ if k != victim and self.bins[k] and self.fill[k] < self.capacity),
                                key=lambda k: -self.fill[k])
                gained, met = False, set()
                for n, k in enumerate(fuller):
                    if n >= neighbours and gained:
                        break
                    if self.fill[k] >= self.fill[victim]:
                        if n >= neighbours and self.fill[k] in met:
                            continue
                        met.add(self.fill[k])
                        while self.bins[victim] and self.fill[k] < self.capacity and self._gain(victim, k):
                            gained = changed = True
                            changes += 1
                    if not self.bins[victim]:
                        break
                if not gained:
                    failed[victim] = changes
            if not changed:
                break
        return [b for b in self.bins.values() if b]


def pack_lengths(lengths: list[int], capacity: int, max_passes: int = 20, neighbours: int = 64) -> list[list[int]]:
    """Bins as lists of item numbers."""
    return Search(best_fit(lengths, capacity), lengths, capacity).run(max_passes, neighbours)


# ---- all groups --------------------------------------------------------------------------------------------------

def pack(docs: DataFrame, path: str, end_id: int = 1, capacity: int = 4096, group_bins: int = 1024, group_pieces: int = 50_000,
         keep_fill: float = 0.995, max_passes: int = 20) -> DataFrame:
    """Every piece with its sequence_id and offset there."""
    left = written(pieces(docs, path, end_id, capacity).withColumn("uid", F.monotonically_increasing_id()), "packing-pieces")
    done, before, level = [], None, 0

    def pack_group(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "uid"], ascending=[False, True], ignore_index=True)
        lengths = group["length"].tolist()
        place, offset, fill = np.zeros(len(lengths), np.int32), np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for k, members in enumerate(pack_lengths(lengths, capacity, max_passes)):
            size = group["length"].to_numpy()[members]
            place[members], offset[members], fill[members] = k, np.cumsum(size) - size, size.sum()
        return group.assign(bin=place, offset=offset, fill=fill)

    while True:
        size = left.agg(F.count("*").alias("n"), F.sum("length").alias("t")).first()
        groups = max(1, -(-(size["t"] or 0) // (capacity * group_bins)), -(-size["n"] // group_pieces))
        dealt = left.withColumn("grp", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(groups)).cast("int"))
        packed = written(dealt.groupBy("grp").applyInPandas(lean_group(pack_group), PACKED), f"packing-{level}")
        last = groups == 1 or before is not None and 2 * size["n"] > before
        full = F.lit(True) if last else F.col("fill") >= int(capacity * keep_fill)
        done.append(packed.where(full).withColumn("level", F.lit(level)))
        if last:
            break
        left, before, level = packed.where(~full).select(*left.columns), size["n"], level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    # grp as a long: Spark takes 1 << 24 for an int, and from group 128 on the product is none
    sequence = F.col("level") * F.lit(1 << 56) + F.col("grp").cast("long") * F.lit(1 << 24) + F.col("bin")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset")
