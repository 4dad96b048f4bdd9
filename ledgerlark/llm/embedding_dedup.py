"""Near duplicates among embeddings, with binary codes of randomly rotated vectors.

Stored of a unit vector o: its code, the signs of its rotation, one bit a dimension; the correction factor
f = <sign/sqrt(D), o>; its rotation in four bits a dimension, randomly rounded, so right on average. For a unit vector q,
<sign/sqrt(D), q> / f is an unbiased estimate of <o, q>; its error stays within bound * sqrt((1 - f^2) / f^2 / (D - 1) + what
the rounding of q adds) but for a probability that falls with exp(-bound^2). It is counted from the bits of o's code and q's
four bit planes. Pairs whose upper bound is below the threshold are done with; for all others the vectors themselves are
fetched and recomputed exactly in double precision, and only those at the threshold or above link.

Pairs are formed among vectors that agree in some group of code bits (several tables of k bits, k growing with the logarithm
of the number of vectors, tables enough for the wanted recall at the threshold itself; recall=1 compares all with all). A
group larger than a block is cut into blocks, and each pair of blocks is a task of its own; a pair counts in the first table
in which it meets. Only codes travel through the tables; tasks return numbers of links and spanning edges, never pairs.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, discard, fmix, mapped, saved, small


def rotation(dims: int, rows: int, seed: int) -> np.ndarray:
    """`rows` unit directions: whole random rotations, one after the other."""
    rng, out = np.random.default_rng([seed, dims]), []
    while sum(map(len, out)) < rows:
        q, r = np.linalg.qr(rng.normal(size=(dims, dims)))
        out.append(q * np.sign(np.diag(r)))
    return np.concatenate(out)[:rows]


def tables_for(n: int, threshold: float, recall: float, bucket: int = 512) -> tuple[int, int]:
    """Bits of a table and number of tables, so that a pair at the threshold meets with probability `recall`; for 1 one table
    without bits, in which all meet."""
    if recall >= 1:
        return 0, 1
    bits = min(24, max(1, round(math.log2(max(n, 1) / bucket)) if n > bucket else 1))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


PLANES = 4


def packed_bits(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words, filled up with zeros."""
    n, d = bits.shape
    out = np.zeros((n, -(-d // 64) * 64), np.uint8)
    out[:, :d] = bits
    return np.packbits(out, axis=1, bitorder="little").view(np.uint64)


@dataclass
class Codes:
    """Codes of n vectors: words of sign bits, PLANES bit planes, and (f, low, step, sum) of each; words of table bits."""

    signs: np.ndarray
    planes: np.ndarray
    scalars: np.ndarray
    tables: np.ndarray
    dims: int

    def rows(self) -> list[bytes]:
        whole = np.concatenate([x.reshape(len(x), -1).view(np.uint8) for x in (self.signs, self.planes, self.scalars, self.tables)], axis=1)
        return [r.tobytes() for r in whole]

    @classmethod
    def of(cls, rows: list[bytes], dims: int) -> Codes:
        raw = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
        w = -(-dims // 64)
        cut = np.cumsum([8 * w, 8 * w * PLANES, 16])
        signs, planes, scalars, tables = (np.ascontiguousarray(x) for x in np.split(raw, cut, axis=1))
        return cls(signs.view(np.uint64), planes.view(np.uint64).reshape(len(rows), PLANES, w), scalars.view(np.float32), tables.view(np.uint64) if tables.shape[1] else np.zeros((len(rows), 0), np.uint64), dims)

    def take(self, at: np.ndarray) -> Codes:
        return Codes(self.signs[at], self.planes[at], self.scalars[at], self.tables[at], self.dims)


def encode(unit: np.ndarray, keys: np.ndarray, turned: np.ndarray, table_planes: np.ndarray) -> Codes:
    """Codes of unit vectors; the random rounding hashes key and dimension, so a rerun gives the same."""
    n, d = unit.shape
    rotated = unit @ turned.T
    low, high = rotated.min(axis=1), rotated.max(axis=1)
    step = np.maximum((high - low) / ((1 << PLANES) - 1), 1e-30)
    noise = (fmix(keys.astype(np.int64).view(np.uint64)[:, None] + np.arange(1, d + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    level = np.minimum(np.floor((rotated - low[:, None]) / step[:, None] + noise), (1 << PLANES) - 1).astype(np.uint8)
    planes = np.stack([packed_bits((level >> b) & 1) for b in range(PLANES)], axis=1)
    total = d * low + step * level.sum(axis=1)
    scalars = np.stack([np.abs(rotated).sum(axis=1) / math.sqrt(d), low, step, total], axis=1).astype(np.float32)
    tables = packed_bits(unit @ table_planes.T >= 0) if len(table_planes) else np.zeros((n, 0), np.uint64)
    return Codes(packed_bits(rotated >= 0), planes, scalars, tables, d)


def estimates(x: Codes, y: Codes, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of the inner products of x (rows, by their codes) with y (columns, by their planes), and error bounds."""
    d, (f, _, _, _), (_, low, step, total) = x.dims, x.scalars.T.astype(np.float64), y.scalars.T.astype(np.float64)
    ones = np.bitwise_count(x.signs).sum(axis=1, dtype=np.int64)
    both = np.zeros((len(x.signs), len(y.signs)), np.int32)
    for b in range(PLANES):
        for w in range(x.signs.shape[1]):
            both += np.bitwise_count(x.signs[:, None, w] & y.planes[None, :, b, w]).astype(np.int32) << b
    dot = 2 * (ones[:, None] * low + both * step) - total
    est = dot / (math.sqrt(d) * f[:, None])
    own = np.maximum(0, 1 - f**2) / f**2 / max(1, d - 1)
    return est, bound * np.sqrt(own[:, None] + (step / 2) ** 2 / (f**2)[:, None])


def undecided(x: Codes, y: Codes, threshold: float, bound: float, n_tables: int, bits: int, table: int, same: bool, tile: int = 512):
    """(row, column) numbers of the pairs that may reach the threshold and don't agree in a table before `table`; of equal sides
    each pair once."""
    for a in range(0, len(x.signs), tile):
        for b in range(0, len(y.signs), tile):
            if same and b + tile <= a:
                continue
            p, q = x.take(np.arange(a, min(a + tile, len(x.signs)))), y.take(np.arange(b, min(b + tile, len(y.signs))))
            if math.isinf(bound):
                hit = np.ones((len(p.signs), len(q.signs)), bool)
            else:
                est, error = estimates(p, q, bound)
                hit = est >= threshold - error - 1e-4
            i, j = np.nonzero(hit)
            i, j = i + a, j + b
            if same:
                i, j = i[i < j], j[i < j]
            for t in range(table):  # they met in an earlier table
                stay = ~agree(x, i, y, j, t, bits)
                i, j = i[stay], j[stay]
            yield i, j


def agree(x: Codes, i: np.ndarray, y: Codes, j: np.ndarray, table: int, bits: int) -> np.ndarray:
    """Whether the vectors i of x and j of y have the same bits in a table."""
    out = np.ones(len(i), bool)
    at, stop = table * bits, (table + 1) * bits
    while at < stop:
        w, o = divmod(at, 64)
        n = min(64 - o, stop - at)
        out &= ((x.tables[i, w] ^ y.tables[j, w]) >> np.uint64(o)) & np.uint64((1 << n) - 1) == 0
        at += n
    return out


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each number's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def prepare(vectors: DataFrame, vector: str) -> DataFrame:
    """vec_id, key (hash of the unit vector), dims and the unit vector as bytes; nulls for vectors that can't
    be compared: null, empty, zero, or with null or non-finite components."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keys, dims, raws = [], [], []
            for v in batch.column(vector):
                key = dim = raw = None
                if v.is_valid and len(v.values):
                    x = np.asarray(v.values.to_numpy(zero_copy_only=False), dtype=np.float64)
                    if v.values.null_count == 0 and np.isfinite(x).all() and (big := np.abs(x).max()) > 0:
                        x = x / big  # no overflow, no underflow in the norm
                        raw = (x / np.sqrt((x * x).sum()) + 0.0).tobytes()
                        dim, key = len(x), int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)
                keys.append(key)
                dims.append(dim)
                raws.append(raw)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(keys, pa.int64()), pa.array(dims, pa.int32()), pa.array(raws, pa.binary())], ["vec_id", "key", "dims", "unit"])

    return mapped(vectors.select("vec_id", vector), run, "vec_id long, key long, dims int, unit binary")


def dedup(vectors: DataFrame, vector: str = "embedding", threshold: float = 0.9, recall: float = 0.995, bound: float = 4.0, block: int = 1024, seed: int = 3) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of vectors.

    Vectors that can't be compared link with nothing and are kept; vectors of different lengths don't link. Equal directions
    are one node with a multiplicity, so copies cost nothing. component_id is the smallest non-null vec_id of the component;
    a row without vec_id is kept only if its component has no id at all. recall is the share of pairs at the threshold itself
    that meet in a table (of closer pairs more do); recall=1 compares all vectors by blocks, each pair exactly.
    """
    rows = saved(prepare(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vector), vector), "vectors")
    nodes = saved(rows.where("key is not null").groupBy("key").agg(F.count("*").alias("copies"), F.first("dims").alias("dims"), F.first("unit").alias("unit")), "nodes")
    bits, n_tables = tables_for(nodes.count(), threshold, recall)
    bound = math.inf if recall >= 1 else bound

    def code(batches):
        import pyarrow as pa

        made: dict[int, tuple] = {}
        for batch in batches:
            dims = np.array(batch.column("dims").to_pylist())
            for d in np.unique(dims).tolist():
                if d not in made:
                    made[d] = rotation(d, d, seed + 1), rotation(d, bits * n_tables, seed) if bits else np.zeros((0, d))
                own = batch.take(pa.array(np.flatnonzero(dims == d)))
                unit = np.stack([np.frombuffer(u.as_py(), np.float64) for u in own.column("unit")])
                codes = encode(unit, np.array(own.column("key").to_pylist(), np.int64), *made[d])
                yield pa.RecordBatch.from_arrays([own.column("key"), own.column("dims"), pa.array(codes.rows(), pa.binary())], ["key", "dims", "code"])

    coded = saved(mapped(nodes.select("key", "dims", "unit"), code, "key long, dims int, code binary"), "codes")

    def deal(batches):
        import pyarrow as pa

        for batch in batches:
            dims = np.array(batch.column("dims").to_pylist())
            for d in np.unique(dims).tolist():
                own = batch.take(pa.array(np.flatnonzero(dims == d)))
                codes = Codes.of([c.as_py() for c in own.column("code")], d)
                for t in range(n_tables):
                    cell = np.zeros(len(codes.signs), np.int64)
                    for k in range(bits):
                        w, o = divmod(t * bits + k, 64)
                        cell |= ((codes.tables[:, w] >> np.uint64(o)).astype(np.int64) & 1) << k
                    # dims, table and cell in one number
                    yield pa.RecordBatch.from_arrays([pa.array((np.int64(d) << 44) | (np.int64(t) << 24) | cell), own.column("key"), own.column("code")], ["bin", "key", "code"])

    dealt = mapped(coded, deal, "bin long, key long, code binary")
    # a cell's size is counted without its codes; cells larger than a block are dealt to all pairs of its blocks
    sizes = small(saved(dealt.groupBy("bin").agg(F.count("*").alias("size")).where(F.col("size") > block).select("bin", F.ceil(F.col("size") / block).cast("int").alias("parts")), "sizes"))
    dealt = dealt.join(sizes, "bin", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("key"), F.col("parts"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)))
    pair = F.least("own", "other") * F.lit(1 << 32) + F.greatest("own", "other")
    dealt = dealt.select("bin", pair.alias("pair"), "own", "key", "code")

    def by_task(batches, columns):
        """Groups of rows with the same bin and pair, as lists of columns."""
        now, held = None, []
        for batch in batches:
            for b, p, *rest in zip(*(batch.column(c).to_pylist() for c in ("bin", "pair", *columns))):
                if (b, p) != now:
                    if len(held) > 1:
                        yield *now, [list(c) for c in zip(*held)]
                    now, held = (b, p), []
                held.append(rest)
        if len(held) > 1:
            yield *now, [list(c) for c in zip(*held)]

    def pairs_of(bin_, pair_, own, codes):
        """Undecided pairs of a task, as numbers in its rows."""
        d, t, low, high = bin_ >> 44, (bin_ >> 24) & ((1 << 20) - 1), pair_ >> 32, pair_ & ((1 << 32) - 1)
        own, codes = np.array(own), Codes.of(codes, d)
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        if len(left) and len(right):
            x, y = codes.take(left), codes.take(right)
            for i, j in undecided(x, y, threshold, bound, n_tables, bits, t, low == high):
                if len(i):
                    yield left[i], right[j]

    def sift(batches):
        import pyarrow as pa

        for bin_, pair_, (own, key, codes) in by_task(batches, ("own", "key", "code")):
            wanted = np.zeros(len(key), bool)
            for i, j in pairs_of(bin_, pair_, own, codes):
                wanted[i] = wanted[j] = True
            at = np.flatnonzero(wanted).tolist()
            if at:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ([bin_] * len(at), [pair_] * len(at), [own[k] for k in at], [key[k] for k in at])], ["bin", "pair", "own", "key"])

    task = ["bin", "pair"]
    wanted = saved(mapped(dealt.repartition(*task).sortWithinPartitions(*task), sift, "bin long, pair long, own long, key long"), "wanted")
    exact = small(wanted).join(nodes.select("key", "copies", "unit"), "key").join(coded.select("key", "code"), "key")

    def find(batches):
        import pyarrow as pa

        for bin_, pair_, (own, key, copies, units, codes) in by_task(batches, ("own", "key", "copies", "unit", "code")):
            unit = np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)
            copies, links, a, b = np.array(copies), np.zeros(len(key), np.int64), [], []
            for i, j in pairs_of(bin_, pair_, own, codes):
                for k in range(0, len(i), 1 << 14):
                    p, q = i[k : k + (1 << 14)], j[k : k + (1 << 14)]
                    sure = np.einsum("ij,ij->i", unit[p], unit[q]) >= threshold
                    p, q = p[sure], q[sure]
                    np.add.at(links, p, copies[q])
                    np.add.at(links, q, copies[p])
                    a.append(p)
                    b.append(q)
            if links.any():
                root, at, keys = roots(len(key), np.concatenate(a), np.concatenate(b)), np.flatnonzero(links), np.array(key, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys[at]), pa.array(links[at]), pa.array(keys[root[at]])], ["key", "links", "root"])

    found = saved(mapped(exact.repartition(*task).sortWithinPartitions(*task), find, "key long, links long, root long"), "found")
    discard(coded, wanted)
    labels = components(found.select("key", "root"), "key", "root")
    graph = saved(
        nodes.select("key", "copies").join(found.groupBy("key").agg(F.sum("links").alias("links")), "key", "left").join(labels.withColumnRenamed("id", "key"), "key", "left")
        .select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "key").alias("label")), "graph")
    least = rows.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("least")).join(graph, "key").groupBy("label").agg(F.min("least").alias("least"))
    graph = graph.join(least, "label", "left").select("key", "n_links", "least")
    out = rows.select("vec_id", "key").join(graph, "key", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("least", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: All pairs in double precision, and the smallest id reachable.
ORACLE_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT DISTINCT a AS id, a AS c FROM l UNION SELECT l.b AS id, r.c FROM r JOIN l ON l.a = r.id AND r.c < l.b),
m AS (SELECT id, min(c) AS c FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(coalesce(m.c, e.vec_id), e.vec_id) AS component_id, coalesce(m.c, e.vec_id) >= e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN m ON m.id = e.vec_id
"""
