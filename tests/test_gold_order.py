"""Which of several rows of one id goes into gold."""

from pyspark.sql import functions as F

from ledgerlark.plans import jobs


def test_first_rows_are_whole_and_told_by_their_values(spark):
    rows = [("k", None, "z", 1), ("k", "b", "a", 9), ("k", "b", "a", 2), ("n", None, None, None), (None, "x", "y", 3), (None, "w", None, 4)]
    for order in (rows, rows[::-1]):
        got = jobs.first_rows(spark.createDataFrame(order, "key string, a string, b string, c int").repartition(3), "key")
        assert got.columns == ["key", "a", "b", "c"] and sorted(map(tuple, got.collect()), key=str) == sorted([("k", "b", "a", 2), ("n", None, None, None), (None, "w", None, 4)], key=str)


def test_two_summary_rows_of_one_id(spark):
    fields = [c for c in jobs.FROM_SUMMARY if c != "mmh_id"]
    summary = lambda first: spark.createDataFrame([(*(f"{tag}-{c}" for c in fields), ids) for tag, ids in (("b", "7,8"), ("a", "8,9"))][:: 1 if first else -1], ", ".join(f"{c} string" for c in fields) + ", mmh_id string")
    categories = spark.createDataFrame([("5", "g2", None), ("5", "g1", "i1"), ("5", None, "i0")], "mcc_code string, mcc_group string, industry_classification_code string")
    rows = spark.createDataFrame([("s7", "7", "5", 0.8), ("s8", "8", "5", 0.8), ("s0", "0", "6", 0.1)], "supplier_id string, matched_mmhid string, matched_mmc_code string, matched_score double")
    for c in set(jobs.RENAMED.values()) - set(rows.columns):
        rows = rows.withColumn(c, F.lit(None).cast("string"))
    for first in (True, False):
        got = {r.supplier_id: r for r in jobs.with_summary(rows, categories, summary(first)).collect()}
        assert len(got) == 3 and got["s8"][fields[0]] == f"a-{fields[0]}" and got["s7"][fields[0]] == f"b-{fields[0]}" and (got["s7"].mcc_group, got["s7"].industry_classification_code) == ("g1", "i1") and got["s0"].mcc_group is None
