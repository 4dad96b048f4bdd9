"""Exact top-k by integer inner product as a Voronoi kNN join.

One more coordinate, sqrt(M^2 - |s|^2) with M the largest norm, turns the greatest inner product into the least distance:
|q - s|^2 = |q|^2 + M^2 - 2 <q, s>. Pivots are fitted on a bounded sample; every row belongs to the cell of its nearest pivot.
A cell's summary is its number of rows, its least and greatest distance to the pivot and the k + 1 least ones. From the summaries
alone follow, by the triangle inequality,

- for each query and each group of queries (those of one cell) a distance within which k other rows lie for certain;
- for each cell the distance from its pivot under which no group needs a row: such rows go no further;
- for each query the cells that can hold a row near enough: to these, and no others, the query is sent.

Of the two sides the queries are the replicated one, so a data row travels once at most. A cell larger than a block is cut into
blocks by a hash of the row number, so that copies spread; a task holds one block, the queries stream past it, and for each
the k best rows of the block leave. The k best of all blocks are a window with a limit that Spark applies before the shuffle too.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, mapped, rows_of, saved

#: Rows the pivots are fitted on, and the most numbers that these may hold together.
SAMPLE_ROWS, SAMPLE_VALUES = 4096, 1 << 21
#: Bytes of a block's matrix in double precision, and scores that are held at a time.
BLOCK_BYTES, SCORES = 16 << 20, 1 << 20
LONG = (-(1 << 63), (1 << 63) - 1)


def packed(x: np.ndarray) -> bytes:
    """Whole numbers as the narrowest of 16-bit and 32-bit integers and doubles that holds them; the width tells which."""
    most = np.abs(x).max(initial=0)
    return x.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.float64).tobytes()


def unpacked(rows: list[bytes], dims: int) -> np.ndarray:
    kinds = {2: np.int16, 4: np.int32, 8: np.float64}
    return np.stack([np.frombuffer(r, kinds[len(r) // dims]).astype(np.float64) for r in rows]) if dims else np.zeros((len(rows), 0))


def prepare(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """vec_id, dims, v (floor(scale * component), packed) and norm of the vectors that take part."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            ids, dims, raws, norms = [], [], [], []
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("vector")):
                if not v.is_valid or v.values.null_count:
                    continue
                with np.errstate(over="ignore", invalid="ignore"):
                    x = np.floor(scale * np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64))
                    if not np.isfinite(x).all():
                        continue
                    ids.append(i)
                    dims.append(len(x))
                    raws.append(packed(x))
                    norms.append(float(np.sqrt((x * x).sum())))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(raws, pa.binary()), pa.array(norms, pa.float64())], ["vec_id", "dims", "v", "norm"])

    return mapped(vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector")), run, "vec_id long, dims int, v binary, norm double")


def raised(x: np.ndarray, most: float, data: bool) -> np.ndarray:
    """x with the further coordinate: of data what its norm lacks, of queries 0."""
    with np.errstate(over="ignore", invalid="ignore"):
        return np.concatenate([x, np.sqrt(np.maximum(0, most * most - (x * x).sum(axis=1)))[:, None] if data else np.zeros((len(x), 1))], axis=1)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return np.sqrt(np.maximum(0, (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * x @ pivots.T))


def fit_pivots(sample: np.ndarray, count: int, seed: int, rounds: int = 4) -> np.ndarray:
    """Means of the sample's rows around `count` of them, moved a few times."""
    pivots = sample[np.random.default_rng(seed).choice(len(sample), min(count, len(sample)), replace=False)]
    for _ in range(rounds):
        near = distances(sample, pivots).argmin(axis=1)
        size = np.bincount(near, minlength=len(pivots))
        total = np.zeros_like(pivots)
        np.add.at(total, near, sample)
        pivots = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], pivots)
    return pivots


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers as 64-bit integers; beyond that range its nearest end."""
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1] < 1 << 53:
        return (q @ x.T).astype(np.int64)  # every sum is exact in double precision
    q, x = ([[int(c) for c in row] for row in side] for side in (q, x))
    return np.array([[min(max(sum(map(int.__mul__, a, b)), LONG[0]), LONG[1]) for b in x] for a in q], np.int64).reshape(len(q), len(x))


def top_k(vectors: DataFrame, is_query, k: int = 10, key: str = "vec_id", vector: str = "embedding", scale: float = 1024, pivots: int | None = None, block_bytes: int = BLOCK_BYTES, seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of `vectors` where is_query (a column of vec_id) holds, the k rows other than
    itself with the greatest inner product of floor(scale * component), all if there are fewer.

    Ties go to the smaller vec_id, rows without one last. Vectors that are null, or hold null, non-finite or after scaling
    infinite components, take no part; vectors of different lengths aren't compared; empty vectors score 0 with each other. Rows
    that share a vec_id are rows of their own, as queries and as candidates. Scores are exact; one beyond a long counts as its
    nearest end. With `pivots` None a query meets about as many pivots as there are rows for each query, 256 at most.
    """
    rows = saved(prepare(vectors, key, vector, scale), "vectors")
    asked = is_query(F.col("vec_id"))
    n, n_queries, most, widest = rows.agg(F.count("*"), F.count(F.when(asked, 1)), F.max("norm"), F.max("dims")).first()
    if not n_queries:
        return rows_of(rows.sparkSession, [], "query_id long, rank int, vec_id long, score long")
    wanted = pivots or max(1, min(256, n // 256, n // n_queries))
    sample: dict[int, list[bytes]] = {}
    for r in rows.select("dims", "v").orderBy(F.xxhash64("vec_id", "v"), "v").limit(max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // max(widest, 1)))).collect():
        sample.setdefault(r["dims"], []).append(bytes(r["v"]))
    drawn = sum(map(len, sample.values()))
    # vectors of a length that the sample lacks have one pivot, the origin
    of_dims = {d: fit_pivots(raised(unpacked(v, d), most, True), max(1, round(wanted * len(v) / drawn)), seed) for d, v in sample.items()}

    def pivots_of(d: int) -> np.ndarray:
        return of_dims.get(d, np.zeros((1, d + 1)))

    def by_length(batch):
        import pyarrow as pa

        dims = np.array(batch.column("dims").to_pylist(), np.int64)
        for d in np.unique(dims).tolist():
            yield d, batch.take(pa.array(np.flatnonzero(dims == d)))

    def assign(batches):
        import pyarrow as pa

        for batch in batches:
            for d, own in by_length(batch):
                away = distances(raised(unpacked(own.column("v").to_pylist(), d), most, True), pivots_of(d))
                near = away.argmin(axis=1)
                cell = near + (np.int64(d) << 16)
                yield pa.RecordBatch.from_arrays([own.column("vec_id"), own.column("dims"), own.column("v"), pa.array(cell), pa.array(away[np.arange(len(near)), near])], ["vec_id", "dims", "v", "cell", "away"])

    data = saved(mapped(rows.select("vec_id", "dims", "v"), assign, "vec_id long, dims int, v binary, cell long, away double").withColumn("row", F.monotonically_increasing_id()), "cells")

    # summaries: as many rows as pivots, and k + 1 distances each
    least = data.select("cell", "away", F.row_number().over(Window.partitionBy("cell").orderBy("away")).alias("at")).where(F.col("at") <= k + 1)
    nearest: dict[int, list[float]] = {}
    for r in least.groupBy("cell").agg(F.sort_array(F.collect_list("away")).alias("near")).collect():
        nearest[r["cell"]] = r["near"]
    summary = data.groupBy("cell").agg(F.count("*").alias("n"), F.min("away").alias("low"), F.max("away").alias("high")).collect()
    cells: dict[int, list] = {}
    for r in sorted(summary, key=lambda r: r["cell"]):
        cells.setdefault(r["cell"] >> 16, []).append(r)
    block = {d: max(64, block_bytes // (8 * (d + 1))) for d in cells}
    parts = {r["cell"]: -(-r["n"] // block[d]) for d, found in cells.items() for r in found}
    table = {d: (np.array([r["cell"] for r in found]), np.array([r["low"] for r in found]), np.array([r["high"] for r in found]),
                 np.array([x for r in found for x in nearest[r["cell"]]]), np.repeat(np.arange(len(found)), [len(nearest[r["cell"]]) for r in found])) for d, found in cells.items()}

    def within(away: np.ndarray, d: int) -> np.ndarray:
        """By row of distances to the cells' pivots: a distance within which k + 1 rows lie, the query's own among them."""
        bounds = away[:, table[d][4]] + table[d][3]
        return np.partition(bounds, k, axis=1)[:, k] if bounds.shape[1] > k else np.full(len(away), math.inf)

    slack = 1e-6 * (1 + most)
    queries = data.where(asked).select("vec_id", "dims", "v", "row")

    def group(batches):
        """Nearest pivot of each query and its distance, as greatest by pivot of the partition."""
        import pyarrow as pa

        far: dict[int, float] = {}
        for batch in batches:
            for d, own in by_length(batch):
                away = distances(raised(unpacked(own.column("v").to_pylist(), d), most, False), pivots_of(d)[table[d][0] & 0xFFFF])
                near = away.argmin(axis=1)
                for j, x in zip(table[d][0][near].tolist(), away[np.arange(len(near)), near].tolist()):
                    far[j] = max(far.get(j, 0.0), x)
        yield pa.RecordBatch.from_arrays([pa.array(list(far), pa.int64()), pa.array(list(far.values()), pa.float64())], ["cell", "far"])

    floor: dict[int, float] = {}  # by cell: rows nearer to the pivot are needed by no group
    groups = mapped(queries.select("dims", "v"), group, "cell long, far double").groupBy("cell").agg(F.max("far").alias("far")).collect()
    for d in cells:
        own = [r for r in groups if r["cell"] >> 16 == d]
        centres = pivots_of(d)[table[d][0] & 0xFFFF]
        if own:
            far = np.array([r["far"] for r in own])
            apart = distances(pivots_of(d)[[r["cell"] & 0xFFFF for r in own]], centres)
            reach = far + within(apart, d)  # of the whole group
            with np.errstate(invalid="ignore"):
                low = (apart - far[:, None] - reach[:, None]).min(axis=0) - slack
            floor |= {j: x if x == x else -math.inf for j, x in zip(table[d][0].tolist(), low.tolist())}

    def send(batches):
        """Each query once for every block of every cell that can hold one of its k nearest, with its least useful score."""
        import pyarrow as pa

        for batch in batches:
            for d, own in by_length(batch):
                x = unpacked(own.column("v").to_pylist(), d)
                cell, low, high, _, _ = table[d]
                away = distances(raised(x, most, False), pivots_of(d)[cell & 0xFFFF])
                reach = within(away, d)
                with np.errstate(invalid="ignore", over="ignore"):
                    skip = np.maximum(away - high, low - away) > reach[:, None] + slack
                    score = ((x * x).sum(axis=1) + most * most - (reach + slack) ** 2) / 2
                score = np.where(np.isfinite(score), score, -math.inf)
                i, j = np.nonzero(~skip)
                copies = np.array([parts[c] for c in cell.tolist()])[j]
                i, j = np.repeat(i, copies), np.repeat(j, copies)
                part = np.arange(len(i)) - np.repeat(np.cumsum(copies) - copies, copies)
                for a in range(0, len(i), 4096):
                    at = pa.array(i[a : a + 4096])
                    yield pa.RecordBatch.from_arrays([pa.array(cell[j[a : a + 4096]]), pa.array(part[a : a + 4096]), *(own.column(c).take(at) for c in ("vec_id", "dims", "v", "row")), pa.array(score[i[a : a + 4096]])], ["cell", "block", "vec_id", "dims", "v", "row", "least"])

    sent = mapped(queries, send, "cell long, block long, vec_id long, dims int, v binary, row long, least double")
    limits = rows_of(rows.sparkSession, [(c, p, floor.get(c, math.inf)) for c, p in parts.items()], "cell long, parts long, floor double")
    needed = data.join(F.broadcast(limits), "cell").where("away >= floor").select("cell", F.pmod(F.xxhash64("row"), "parts").alias("block"), "vec_id", "dims", "v", "row", F.lit(None).cast("double").alias("least"))

    def solve(batches):
        import pyarrow as pa

        now, held, matrix, ids, own, holes = None, [], None, None, None, None
        names = ("cell", "block", "vec_id", "dims", "v", "row", "least")
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in names]
            edges = [0, *(t for t in range(1, batch.num_rows) if (columns[0][t], columns[1][t], columns[6][t] is None) != (columns[0][t - 1], columns[1][t - 1], columns[6][t - 1] is None)), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                cell, part, d, is_data = columns[0][a], columns[1][a], columns[3][a], columns[6][a] is None
                if (cell, part) != now:
                    now, held, matrix = (cell, part), [], None
                if is_data:
                    held.append((columns[2][a:b], columns[5][a:b], unpacked(columns[4][a:b], d)))
                    continue
                if not held:
                    continue  # no row of the block is needed
                if matrix is None:
                    ids, own, matrix = sum((h[0] for h in held), []), np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
                    order = np.array(sorted(range(len(ids)), key=lambda t: (ids[t] is None, ids[t] or 0)))  # ties: the smaller column
                    holes = np.array([ids[t] is None for t in order])
                    ids, own, matrix, held = np.array([ids[t] or 0 for t in order], np.int64), own[order], matrix[order], [None]
                size = max(1, SCORES // len(ids))
                for c in range(a, b, size):
                    stop = min(b, c + size)
                    scores = products(unpacked(columns[4][c:stop], d), matrix)
                    rows_, least_ = np.array(columns[5][c:stop]), np.array(columns[6][c:stop])
                    fit = (own[None, :] != rows_[:, None]) & (scores >= least_[:, None])
                    if len(ids) > k:
                        fit &= scores >= np.partition(scores, len(ids) - k - 1, axis=1)[:, len(ids) - k - 1, None]  # k + 1 rows, as one may be the query
                    i, j = np.nonzero(fit)
                    order = np.lexsort((j, ~scores[i, j], i))
                    i, j = i[order], j[order]
                    count = np.bincount(i, minlength=stop - c)
                    rank = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
                    i, j = i[rank < k], j[rank < k]
                    if len(i):
                        yield pa.RecordBatch.from_arrays([pa.array(rows_[i]), pa.array([columns[2][c + t] for t in i.tolist()], pa.int64()), pa.array(ids[j], mask=holes[j]), pa.array(scores[i, j])], ["row", "query_id", "vec_id", "score"])

    met = needed.unionByName(sent).repartition("cell", "block").sortWithinPartitions("cell", "block", F.col("least").isNotNull())
    found = mapped(met, solve, "row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    out = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    discard(rows)
    return out


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda i: i % 100 == 0)


#: Every query against every row.
ORACLE_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(list_zip(q.e, d.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q, v d WHERE q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
