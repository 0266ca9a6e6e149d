"""Shared helpers: shared-storage tables, bounded text chunks, binary blobs, numpy hashing.

Several operators move *blobs* instead of single rows: a task turns a bounded chunk of documents into
numpy arrays, packs the part meant for each bucket into one binary value, and Spark shuffles those
values by bucket. A blob is bounded by its chunk, a bucket by the number of buckets, which follows
the size of the input (``bucket_count``).
"""

from __future__ import annotations

import ctypes
from functools import wraps
from inspect import signature

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demand.session import scratch_path

CHUNK_BYTES = 16 << 20
#: ASCII capitals to small letters, all other bytes as they are.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
LOWER_ARRAY = np.frombuffer(LOWER, np.uint8)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    return written_at(df, name, partition_by)[0]


def written_at(df: DataFrame, name: str, partition_by: str | None = None) -> tuple[DataFrame, str]:
    """``written``, and the path."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    out = df.write.partitionBy(partition_by) if partition_by else df.write
    schema = df.schema
    out.parquet(path)
    return spark.read.schema(schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no later step reads (every later step reads a written result of it)."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def hashed_sample(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """At most ``n`` rows of ``df``, those with the smallest hashes of ``columns``, with the hash as ``h``.

    Only hashes are ranked over all rows; whole rows move once it is known which are chosen."""
    h = F.xxhash64(*columns)
    last = df.select(h.alias("h")).orderBy("h").limit(n).agg(F.max("h")).first()[0]
    chosen = df.where(h <= F.lit(last)) if last is not None else df.limit(0)
    return chosen.withColumn("h", h).orderBy("h").limit(n)


def small_side(df: DataFrame, most_rows: int = 200_000) -> DataFrame:
    """``df`` (a few numbers a row) marked for broadcast if it has at most ``most_rows`` rows, counted."""
    return F.broadcast(df) if df.count() <= most_rows else df


def texts(docs: DataFrame, *more: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, *more) with null texts as empty strings; other columns are dropped."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more)


def _give_back() -> None:
    """Free memory of this worker goes back to the system: Arrow's pool, and what malloc keeps of freed arrays."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library has its own way
        pass


def lean(run):
    """A task function over batches that leaves no free memory behind: a worker serves tasks of many stages."""
    @wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            _give_back()
    return task


def lean_group(run):
    """The same for a function of one group (of one to three arguments, which Spark counts)."""
    def call(*args):
        try:
            return run(*args)
        finally:
            _give_back()
    return [lambda a: call(a), lambda a, b: call(a, b), lambda a, b, c: call(a, b, c)][len(signature(run).parameters) - 1]


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """Bytes of all texts: one aggregate, used only to choose a number of buckets."""
    return docs.agg(F.sum(F.octet_length(text_col)).alias("b")).first()["b"] or 0


def bucket_count(n_bytes: int, per_bucket: int = 8 << 20, least: int = 12) -> int:
    return max(least, -(-n_bytes // per_bucket))


def chunks(batches, max_bytes: int = CHUNK_BYTES, text_col: str = "text"):
    """Slices of Arrow batches holding at most ``max_bytes`` of text (or one row)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        offsets = flat(batch.column(text_col))[1]
        i = 0
        while i < n:
            j = int(np.searchsorted(offsets, offsets[i] + max_bytes, side="right")) - 1
            j = min(n, max(j, i + 1))
            yield batch.slice(i, j - i)
            i = j


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array without nulls; offsets start at 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, width, count=column.offset + len(column) + 1)[column.offset:].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def string_array(data, offsets: np.ndarray) -> pa.Array:
    """A string array over bytes and offsets (the inverse of ``flat``)."""
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)])


def pack(values, dtype=None, level: int = 1) -> bytes:
    raw = values if isinstance(values, bytes) else np.ascontiguousarray(values, dtype).tobytes()
    return zstandard.ZstdCompressor(level=level).compress(raw)


def pack_planes(values) -> bytes:
    """32-bit numbers, their low bytes first, then the next ones: small gaps compress better apart."""
    return pack(np.ascontiguousarray(np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def unpack_planes(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(unpack(blob, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def unpack(blob: bytes, dtype=None):
    raw = zstandard.ZstdDecompressor().decompress(blob)
    return raw if dtype is None else np.frombuffer(raw, dtype)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser (splitmix64): spreads all bits of a 64-bit value; a bijection."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    if n > 1:
        out[1:] = np.uint64(base % (1 << 64))
        np.multiply.accumulate(out, out=out)
    return out[:n]


BASE = 0x9E3779B97F4A7C15


def piece_hashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each piece data[offsets[i]:offsets[i+1]]; pieces may be empty."""
    n = len(offsets) - 1
    out = np.zeros(n, np.uint64)
    size = np.diff(offsets)
    some = np.flatnonzero(size)
    if len(some):
        place = np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], size)
        terms = (data[offsets[0]:offsets[-1]].astype(np.uint64) + np.uint64(1)) * powers(BASE, int(size.max()))[place]
        out[some] = np.add.reduceat(terms, offsets[some] - offsets[0])
    return mix(out ^ (size.astype(np.uint64) << np.uint64(1)))


def span_index(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges start .. start+length-1."""
    ends = np.cumsum(lengths)
    out = np.repeat(starts - (ends - lengths), lengths)
    out += np.arange(len(out))
    return out


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the maximal runs of True."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
