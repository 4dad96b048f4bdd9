"""Rollups stored by one layout are joined without a shuffle."""

from ledgerlark.operators import ledger
from ledgerlark.plans import catalogue


def test_stored_rollups_join_as_they_lie(spark, sf_dir):
    suppliers = ledger.each_period(catalogue.table(spark, sf_dir, "supplier").selectExpr("concat('M', s_suppkey % 7) AS merchant_id", "cast(s_suppkey AS string) AS supplier_id"))
    parts = [suppliers, catalogue.rolled_invoices(spark, sf_dir), catalogue.rolled_orders(spark, sf_dir), catalogue.rolled_payments(spark, sf_dir)]
    want = ledger.final_metrics(*parts)
    names = [f"rollup_{k}" for k in range(4)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        stored = [ledger.store_rollup(p, n, 8) for p, n in zip(parts, names)]
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables that are large
        got = ledger.final_metrics(*stored)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan
        fresh = want._jdf.queryExecution().executedPlan().toString()
        assert fresh.count("Exchange hashpartitioning(date_period") == 4  # each rollup's own, none for the joins
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 0
        rolled = ledger.merchant_rollup(got)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in rolled[rolled.index("SortMergeJoin"):]  # what is shuffled is summed up
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")
