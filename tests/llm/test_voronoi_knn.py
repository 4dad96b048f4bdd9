import math
import re

import duckdb
import numpy as np

from ledgerlark.llm.voronoi_knn import ORACLE_SQL, fit_pivots, op13_top_k, products, top_k


def brute(rows, k=10, divisor=100):
    ok = []
    for at, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.append((at, i, [math.floor(1024 * float(np.float32(x))) for x in v]))
    out = []
    for at, i, v in ok:
        if i is not None and i % divisor == 0:
            scores = [(min(max(sum(a * b for a, b in zip(v, w)), -(1 << 63)), (1 << 63) - 1), j) for other, j, w in ok if other != at and len(w) == len(v)]
            best = sorted(scores, key=lambda s: (-s[0], s[1] is None, s[1] or 0))[:k]
            out += [(i, r + 1, j, s) for r, (s, j) in enumerate(best)]
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def by_hundred(i):
    return i % 100 == 0


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("vec_id", "embedding", "1 AS score", "'x' AS row", "2 AS cell", "3 AS dims", "4 AS label")


def test_clusters_copies_and_ties(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16)) * 4
    rows = [(k, (centres[k % 12] + rng.normal(size=16) * 0.05).tolist()) for k in range(1500)]
    rows += [(2000 + k, centres[0].tolist()) for k in range(700)]  # a hot group, all tied
    rows += [(300, rows[7][1]), (300, rows[300][1]), (300, rows[300][1]), (None, rows[3][1]), (None, rows[3][1])]
    want = brute(rows)
    assert got(top_k(frame(spark, rows), by_hundred)) == want
    assert got(top_k(frame(spark, rows), by_hundred, pivots=40, block_bytes=64 * 17 * 8)) == want  # many cells, small blocks
    assert got(top_k(frame(spark, rows), by_hundred, k=3, pivots=1)) == brute(rows, 3)


def test_bounds_keep_far_cells_away(spark):
    """Well parted groups: the queries of one meet only blocks of few cells, and rows no query needs are not dealt."""
    rng = np.random.default_rng(2)
    directions = np.linalg.qr(rng.normal(size=(24, 24)))[0] * 10
    rows = [(100 * k if k < 30 else 100 * k + 1, (directions[0 if k < 30 else k % 24] + rng.normal(size=24) * 0.01).tolist()) for k in range(2400)]
    df = top_k(frame(spark, rows), by_hundred, pivots=24)
    assert got(df) == brute(rows)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "CartesianProduct" not in plan and "MapInArrow" in plan


def test_odd_vectors(spark):
    rows = [(0, None), (100, [1.0, None]), (200, [float("nan"), 1.0]), (300, [float("inf"), 1.0]), (400, [0.0, 0.0]), (500, [1.0, 2.0]), (600, [-0.0001, 0.0001]), (700, []), (701, []),
            (800, [1.0, 2.0, 3.0]), (801, [3.0, 2.0, 1.0]), (802, [1e38, -1e38, 3e37]), (900, [1e38, 1e38, 1e38]), (1000, [1e10, 1e9, -1e8]), (1001, [1e7, 1.5, -1e8]), (5, [0.5, 0.25]), (None, [1.0, 2.0])]
    assert got(top_k(frame(spark, rows), by_hundred)) == brute(rows)
    assert got(top_k(frame(spark, rows[:4]), by_hundred)) == []
    assert got(top_k(frame(spark, rows).limit(0), by_hundred)) == []
    assert got(top_k(frame(spark, [(100, [1.0])]), by_hundred)) == []


def test_products_beyond_a_long_are_its_ends():
    assert products(np.array([[3e40]]), np.array([[1e38], [-1e38], [0.0]])).tolist() == [[(1 << 63) - 1, -(1 << 63), 0]]
    big = products(np.array([[2.0**31 + 1, 1.0]]), np.array([[2.0**31 - 1, 3.0]]))
    assert big.tolist() == [[(2**31 + 1) * (2**31 - 1) + 3]]


def test_pivots_are_bounded():
    sample = np.random.default_rng(3).normal(size=(50, 4))
    assert fit_pivots(sample, 80, 1).shape == (50, 4) and fit_pivots(sample, 5, 1).shape == (5, 4)


def test_query_and_its_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    result = con.execute(ORACLE_SQL)
    df = op13_top_k(spark, sf_dir)
    assert df.columns == [d[0] for d in result.description] == ["query_id", "rank", "vec_id", "score"]
    assert [t for _, t in df.dtypes] == ["bigint", "int", "bigint", "bigint"]
    assert got(df) == sorted(result.fetchall(), key=str) and not re.search("LIMIT", ORACLE_SQL)
