"""Best matches by matrix blocks beside all pairs of a cluster."""

import random

import numpy as np

from ledgerlark.operators import blocking
from ledgerlark.plans import catalogue


def tables(spark, n=160, copies=40):
    rng, r = np.random.default_rng(3), random.Random(3)
    centres = rng.normal(size=(4, 12))
    vector = lambda k: (centres[k % 4] + rng.normal(size=12) * 0.4).tolist()
    shared = vector(0)
    source = [(f"E{k:03d}", f"legal {k}", f"other {k}", None if k % 17 == 0 else shared if k < copies else vector(k), None if k % 23 == 0 else shared if k < copies else vector(k + 1), k % 4, None if k % 11 == 0 else (k + k % 2) % 4) for k in range(n)]
    source += [("E005", "twice", "twice too", shared, shared, 0, 0), ("E200", "short", "short", [1.0, 2.0], [2.0, 1.0], 1, 1), ("E201", "zero", "zero", [0.0] * 12, [0.0] * 12, 1, 2), ("E202", "odd", "odd", [None] + [1.0] * 11, [1.0] * 12, 1, 2), ("E203", "lost", "lost", vector(1), vector(1), None, None)]
    rows = [(f"s{k}", f"name {k}", shared if k % 9 == 0 else vector(k), r.choice([0, 1, 2, 3, 3, 9])) for k in range(90)] + [("s1", "again", vector(2), 2), ("x", "null", None, 1), ("y", "none", vector(1), None), ("z", "short", [1.0, 2.0], 1)]
    return (spark.createDataFrame(rows, "supplier_id string, supplier_name string, in_emb array<float>, input_cluster_id int"),
            spark.createDataFrame(source, "entity_id string, legal_name string, merchant_name string, ln_emb array<float>, mn_emb array<float>, legal_cluster_id int, merchant_cluster_id int"))


def found(df):
    return sorted((r.supplier_id, r["rank"], r.entity_id, round(r.matched_score, 9), r.best_match_name, r.is_matched) for r in df.collect())


def test_blocks_equal_all_pairs(spark):
    rows, source = tables(spark)
    for least, top in ((0.6, 1), (-1.0, 3), (0.9, 200)):
        want = found(blocking.best_matches(blocking.cluster_pairs(rows, source), least, top))
        got = blocking.block_matches(rows, source, least, top)
        if top == 1:
            assert found(got) == want and len(want) > 40
        else:  # a row may meet the same entity twice, as two rows of the source; which comes first isn't told by ties
            assert [x[:4] for x in found(got)] == [x[:4] for x in want]
        assert [x[:4] for x in found(blocking.block_matches(rows, source, least, top, block=7, stream=5))] == [x[:4] for x in want]
    assert blocking.block_matches(rows.limit(0), source).count() == blocking.block_matches(rows, source.limit(0)).count() == 0


def test_a_task_holds_a_block_and_emits_its_best(spark):
    rows, source = tables(spark, 60, 60)
    plan = blocking.block_matches(rows, source, 0.6, 1, block=10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "CartesianProduct" not in plan and "WindowGroupLimit" in plan


def test_catalogue_uses_blocks(spark, sf_dir):
    plan = catalogue.cluster_best_match(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan


def test_embedding_is_the_sum_of_its_grams(spark):
    """Beside Spark's own hash, gram by gram."""
    from pyspark.sql import functions as F

    texts = [None, "", "a", "alpha bakery", "ää ö漢字", "x" * 300] + [f"name {k} of {k * k}" for k in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    padded = df.select("k", F.concat(F.lit(" "), F.coalesce("t", F.lit("")), F.lit(" ")).alias("p"))
    grams = padded.select("k", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("p") - 2, F.lit(1))), lambda i: F.substr("p", i, F.lit(3)))).alias("g"))
    cells = grams.select("k", F.pmod(F.xxhash64("g"), F.lit(16)).alias("c"), F.when(F.pmod(F.shiftright(F.xxhash64("g"), 32), F.lit(2)) == 0, 1).otherwise(-1).alias("s")).groupBy("k", "c").agg(F.sum("s").alias("s"))
    want = {k: [0.0] * 16 for k in range(len(texts))}
    for r in cells.collect():
        want[r.k][r.c] = float(r.s)
    assert {r.k: r.e for r in df.select("k", blocking.hashing_embedder(16)(F.col("t")).alias("e")).collect()} == want


def test_all_cosines_equal_the_expression_without_a_join(spark):
    from pyspark.sql import functions as F

    from ledgerlark.functions import scalar

    rows = [(i, [float((i * 7 + k * 3) % 11 - 5) for k in range(4)]) for i in range(40)] + [(40, [0.0] * 4), (41, None), (42, [1.0, None, 2.0, 3.0]), (43, [1.0, 2.0]), (44, []), (45, [])]
    both = spark.createDataFrame(rows, "id long, v array<float>")
    a, b = both.where("id % 3 = 0 or id > 39").selectExpr("id a_id", "v a"), both.selectExpr("id b_id", "v b")
    want = a.crossJoin(b).where("a_id <> b_id").select("a_id", "b_id", F.round(scalar.cosine(F.col("a"), F.col("b")), 4)).collect()
    got = blocking.all_cosines(a, b, block=7, stream=9, chunk=10)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want))
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
