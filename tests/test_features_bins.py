"""Sums below the multiplying join, and quantile states that merge."""

import math
import random

from pyspark.sql import functions as F

from ledgerlark.operators import bins, features
from ledgerlark.plans import catalogue


def sample(spark):
    r = random.Random(2)
    clearing = [(r.randint(0, 30), r.choice(["01", "1", "02", "2", "x", "3"]), r.choice(["2024-01-05", "2024-01-25", "2023-06-01", "2022-01-01", "bad"]), r.choice([0.0, 1.5, 20.0, -1.0, None]), r.choice([0, 1, 3, None]), r.choice(["MCP", "A", "B", None]), r.choice(["8", "9C", "1"])) for _ in range(3000)]
    c = spark.createDataFrame(clearing, "dw_merch_location_id long, dw_merch_region_cd string, process_date string, dw_net_pd_amt double, dw_net_pd_cnt long, product_cd string, pds1_paypass_acct_nbr_type_ind string")
    places = spark.createDataFrame([(i, 100 + i // 2, r.choice(["01", "2"])) for i in range(28)] + [(3, 101, "01"), (5, 777, "02")], "old_loc_id long, merchant_market_hierarchy_id long, cleansed_business_region_code string")
    entities = spark.createDataFrame([(f"E{k}", str(k % 3), [str(100 + k % 16), str(100 + k % 7)], str(k % 3)) for k in range(90)] + [("E1", "0", ["101", "101"], "1"), ("none", "0", [], "1"), ("null", "0", None, "1")], "entity_id string, mcc_code string, mmh_id array<string>, region_code string")
    return c, places, entities


def test_metrics_below_the_join_equal_those_above_it(spark):
    c, places, entities = sample(spark)
    for keys in (["entity_id", "dw_merch_region_cd"], ["mcc_code"], ["entity_id"]):
        above = features.transaction_metrics(features.merchant_transactions(c, places, entities, "2024-01-30", ["01", "2"]), "2024-01-30", keys, 10)
        below = features.merchant_metrics(c, places, entities, "2024-01-30", ["01", "2"], keys, window=10)
        assert above.columns == below.columns
        rounded = lambda df: sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)
        assert rounded(above) == rounded(below) and above.count() > 3


def test_what_meets_the_entities_does_not_grow_with_clearing(spark):
    c, places, entities = sample(spark)
    rows = features.located_clearing(c, places, "2024-01-30", ["01", "2"])
    states = features.transaction_states(rows, "2024-01-30", ["merchant_market_hierarchy_id", "__place_region", "dw_merch_region_cd"], 10)
    again = features.transaction_states(rows.unionByName(rows).unionByName(rows), "2024-01-30", ["merchant_market_hierarchy_id", "__place_region", "dw_merch_region_cd"], 10)
    products = rows.select("merchant_market_hierarchy_id", "__place_region", "dw_merch_region_cd", "product_cd").distinct().count()
    assert states.count() == again.count() == products < rows.count() / 2
    assert features.with_entities(states, entities).count() < features.with_entities(rows, entities).count() / 2


def test_features_of_the_catalogue_sum_before_they_join(spark, sf_dir):
    plan = catalogue.txn_features(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("LeftOuter")
    assert plan.index("Aggregate") < join < plan.rindex("Aggregate")


def exact(values, n_bins):
    v = sorted(values)
    return [v[max(1, math.ceil(i * len(v) / n_bins)) - 1] for i in range(n_bins + 1)]


def test_merged_states_equal_rebuilt_ones(spark):
    r = random.Random(5)
    values = [r.choice([r.uniform(-5, 5), float(r.randint(0, 3)), 1e9, 0.0]) for _ in range(900)]
    rows = spark.createDataFrame([(k, v, k % 7) for k, v in enumerate(values)] + [(1000, None, 3), (1001, float("nan"), None)], "k int, v double, w int")
    whole = bins.value_counts(rows, ["v"], ["w"])
    merged = bins.merged_counts(*(bins.value_counts(rows.where(F.col("k") % 5 == i), ["v"], ["w"]) for i in range(5)))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect()))
    for n_bins in (100, 7, 1):
        got = {x.metric: (x.is_negated, x.q) for x in bins.quantiles_of(merged, n_bins).collect()}
        assert got == {"v": (False, exact(values, n_bins)), "w": (True, exact([-float(k % 7) for k in range(900)] + [-3.0], n_bins))}
    few = {x.metric: x.q for x in bins.quantiles_of(bins.value_counts(rows.where("k < 3"), ["v"])).collect()}
    assert few == {"v": exact(values[:3], 100)}
    assert bins.quantiles_of(bins.value_counts(rows.where("k < 0"), ["v"])).count() == 0


def test_digits_bound_the_state(spark):
    r = random.Random(6)
    values = [r.choice([-1, 1]) * 10 ** r.uniform(-3, 4) for _ in range(4000)] + [0.0, float("inf")]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    state = bins.value_counts(rows, ["v"], digits=2)
    assert state.count() <= 2 * 90 * 8 + 2
    got, want = bins.quantiles_of(state).first().q, exact(values, 100)
    assert all(abs(a - b) <= 0.05 * abs(b) + 1e-12 or a == b for a, b in zip(got, want))


def test_bins_from_stored_counts(spark):
    from ledgerlark.plans.jobs import merchant_inference

    c, places, entities = sample(spark)
    rows = features.merchant_metrics(c, places, entities, "2024-01-30", ["01", "2"])
    one = bins.value_counts(rows, bins.HIGHER, bins.LOWER)
    _, q = merchant_inference(c, places, entities, "2024-01-30", ["01", "2"], lambda *columns: F.lit(0.5), counts=one)
    assert {(x.metric, tuple(x.q)) for x in q.collect()} == {(x.metric, tuple(x.q)) for x in bins.quantiles_of(one).collect()}


def test_ranges_are_numbered_once_for_both_sides_of_the_join(spark):
    n = 20_000
    q = bins.quantiles_of(bins.value_counts(spark.range(0, n, 1, 8).select((F.col("id") * 7919 % n).cast("double").alias("v")), ["v"]))
    # a number that is made when the plan is run differs between two runs of a large table's ranges
    assert "partition_id" not in q._jdf.queryExecution().optimizedPlan().toString().lower()
    assert q.first().q == [float(max(1, math.ceil(i * n / 100)) - 1) for i in range(101)]
