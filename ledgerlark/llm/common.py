"""Helpers shared by the corpus operators: work folders, vectorised word hashing, graph components."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(pattern: str) -> np.ndarray:
    """256 booleans: which bytes belong to a word. `space`: all but ASCII white space; `alnum`: 0-9 a-z and every byte from 0x80."""
    table = np.ones(256, dtype=bool)
    if pattern == "space":
        table[[0x20, *range(0x09, 0x0E)]] = False
    elif pattern == "alnum":
        table[:0x30] = table[0x3A:0x61] = table[0x7B:0x80] = False
    else:
        raise ValueError(pattern)
    return table


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, a folder of our own, but only on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if root is None and known.isDefined():
        root = known.get()
    if root is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir is unset; on a cluster it has to name a folder that all executors share")
        root = _own_root.setdefault("root", tempfile.mkdtemp(prefix="ledgerlark-"))
    if not known.isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_own_root: dict[str, str] = {}


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; it is deleted when the session's JVM ends, if not before."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(at)  # only a path that exists can be marked; what is written there overwrites it
    fs.deleteOnExit(at)
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: the lineage ends there, and lost executors cost no more than their own tasks."""
    path = work_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.work_path = path
    return out


def rows_of(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the driver's as a DataFrame. They go as Arrow batches: plain lists would start a Python worker on every core."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    wanted = to_arrow_schema(StructType.fromDDL(schema))
    columns = list(zip(*rows)) or [[] for _ in wanted]
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, wanted)], schema=wanted), StructType.fromDDL(schema))


def discard(*tables: DataFrame | None) -> None:
    """Deletes tables of saved() that nothing reads any more."""
    for df in tables:
        if df is not None and hasattr(df, "work_path"):
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(df.work_path)
            at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


#: Up to this size, as it lies in memory, a table is broadcast.
BROADCAST_BYTES = 64 << 20


def frame_bytes(df: DataFrame) -> int:
    """What the rows of df take in a hash table about: 64 bytes a row, 8 a value, and the bytes of strings, binaries and arrays."""
    size = F.lit(64 + 8 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind in ("string", "binary"):
            size += F.coalesce(F.octet_length(f.name), F.lit(0))
        elif kind == "array":
            size += 16 * F.coalesce(F.size(f.name), F.lit(0))
    return df.agg(F.sum(size)).first()[0] or 0


def small(df: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """df, to be broadcast if it takes no more than `most_bytes`. df is read for that, so it should be a written table."""
    return F.broadcast(df) if frame_bytes(df) <= most_bytes else df


#: Bytes and rows of an Arrow batch: a task holds one batch, its slices, and no more.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 4096


def mapped(df: DataFrame, run, schema) -> DataFrame:
    """df.mapInArrow with batches bounded by bytes, whose workers give freed memory back to the system when a task ends:
    workers are used again, and memory that allocators keep counts against the executor."""
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)):
        now = int(re.match(r"-?\d+", str(conf.get(key)))[0])
        if not 0 < now <= most:
            conf.set(key, str(most))

    def inner(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes

            import pyarrow as pa

            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return df.mapInArrow(inner, schema)


def fmix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3 (public domain), on a fresh array."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
CHUNK = 1 << 17
_powers: list[np.ndarray] = []


def powers() -> list[np.ndarray]:
    """The first CHUNK + 1 powers of BASE and of its inverse, modulo 2**64."""
    if not _powers:
        for base in (BASE, INVERSE):
            x = np.full(CHUNK + 1, base, dtype=np.uint64)
            x[0] = 1
            _powers.append(np.cumprod(x, dtype=np.uint64))
    return _powers


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of each span of bytes, in order and without overlap, the sum of (byte + 1) * BASE ** (distance to its end); by chunks of
    CHUNK bytes, so that memory doesn't grow with raw, nor with a span."""
    up, down = powers()
    out = np.zeros(len(starts), np.uint64)

    def sums(a: int, b: int) -> np.ndarray:
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum((raw[a:b].astype(np.uint64) + np.uint64(1)) * down[: b - a], out=total[1:])
        return total

    k = 0
    while k < len(starts):
        at = int(starts[k])
        stop = min(len(raw), at + CHUNK)
        last = int(np.searchsorted(ends, stop, side="right"))
        if last > k:
            total, a, b = sums(at, stop), starts[k:last] - at, ends[k:last] - at
            out[k:last] = (total[b] - total[a]) * up[b]
            k = last
        else:  # one span of more than a chunk
            value, end = 0, int(ends[k])
            while at < end:
                stop = min(end, at + CHUNK)
                value = (value * int(up[stop - at]) + int(sums(at, stop)[-1]) * int(up[stop - at])) & 0xFFFFFFFFFFFFFFFF
                at = stop
            out[k] = value
            k += 1
    return out


def text_bytes(column, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """An Arrow string column as bytes, A-Z lower-cased if asked for, and row offsets; nulls are empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return LOWER[raw] if lower else raw, offsets - offsets[0]


def words(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray, cuts: np.ndarray | None = None):
    """Hash of every word (64 bits), its first and end byte, and for each row the number of words before it (one more than
    rows). cuts: places where another word begins though the bytes on both sides belong to words."""
    n = len(raw)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
    inside = table[raw]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    first = offsets[:-1]
    before[first[first < n]] = False
    if cuts is not None:
        before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    if cuts is not None:
        after[cuts - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    hashes = fmix(span_hashes(raw, starts, ends))
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def mb_slices(offsets: np.ndarray, limit: int = 1 << 18):
    """Row ranges of about `limit` bytes each, one row at least: what the arrays of one step hold is bounded by this or the longest row."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j
        i = j


def row_slices(column, limit: int = 1 << 18, most: int = 256):
    """Row ranges of an Arrow string column of about `limit` bytes and at most `most` rows each, one row at least."""
    import pyarrow as pa
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(column.cast(pa.large_string())), 0).to_numpy(zero_copy_only=False)
    for i, j in mb_slices(np.concatenate([[0], np.cumsum(size, dtype=np.int64)]), limit):
        for k in range(i, j, most):
            yield k, min(j, k + most)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[i], starts[i]+1, ... of lengths[i] each, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "cc") -> DataFrame:
    """Connected components of an edge list as (id, component), component the smallest id; ids without an edge have no row.

    Each round every node points at the smallest id among itself and its neighbours, pointers are shortened, and edges
    are rewritten between the targets. A component loses half of its local minima a round at least, so rounds grow with
    the logarithm of the size. Every step is a join or aggregate with map-side combining; nothing is collected.
    """
    spark = edges.sparkSession
    edges = saved(
        edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), name)
    labels: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("to"))
        for _ in range(2):
            hop = point.select(F.col("id").alias("h"), F.col("to").alias("next"))
            point = point.join(hop, point["to"] == hop["h"]).select("id", F.col("next").alias("to"))
        point = saved(point, name)
        left, right = point.select(F.col("id").alias("a"), F.col("to").alias("ta")), point.select(F.col("id").alias("b"), F.col("to").alias("tb"))
        fewer = saved(
            edges.join(left, "a").join(right, "b").where("ta <> tb")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), name)
        if labels is None:
            labels, old = point, None
        else:
            moved = point.select(F.col("id").alias("to"), F.col("to").alias("next"))
            old, labels = labels, saved(labels.join(moved, "to", "left").select("id", F.coalesce("next", "to").alias("to")), name)
            discard(point)
        discard(edges, old)
        edges = fewer
    discard(edges)
    if labels is None:
        return rows_of(spark, [], "id long, component long")
    return labels.select("id", F.col("to").alias("component"))
