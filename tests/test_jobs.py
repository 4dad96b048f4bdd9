import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.operators import bins, clearing, features, ledger
from ledgerlark.plans import catalogue, jobs
from ledgerlark.schemas import CLEARING, ERP_GOLD, ERP_TRACKER, MATCHED, PAYABLES_GOLD, PAYABLES_TRACKER
from ledgerlark.sources.tables import VersionedTable
from ledgerlark.streaming.incremental import stream_clearing


@pytest.fixture
def reference(spark):
    categories = spark.createDataFrame([("55", "G", "I"), ("55", "G", "I")], "mcc_code string, mcc_group string, industry_classification_code string")
    summary = spark.createDataFrame([("M1,M2", "YES", 0.8)], "mmh_id string, card_acceptor string, propensity_score double")
    for c in jobs.FROM_SUMMARY:
        if c not in summary.columns:
            summary = summary.withColumn(c, F.lit(None).cast("string"))
    return categories, summary


def matcher(rows):
    out = rows.select("supplier_id").distinct().select("supplier_id", F.lit("E1").alias("entity_id"), F.lit("M2").alias("matched_mmhid"), F.lit("55").alias("matched_mmc_code"), F.lit(0.72).alias("matched_score"))
    return out.unionByName(out.withColumn("matched_score", F.lit(0.1)))  # a second, worse match


def test_payables_job(spark, tmp_path, reference):
    text = "supplier_id supplier_name street_address city state postal_code country phone_number email_address payment_terms payment_method currency merchant_id file_id file_original_name issuer_id".split()
    numbers = [f"total_{k}_of_{w}" for w in ("invoices", "purchase_orders", "payments_paid", "payments_due", "payments_open") for k in ("number", "amount")] + ["transaction_count", "annual_target_spend"]
    raw = spark.createDataFrame([(i,) for i in range(3)], "i int").select(*(F.concat(F.lit(f"{c}-"), F.col("i") % 2).alias(c) for c in text if c not in ("file_id", "payment_method")), F.lit("f1").alias("file_id"), F.lit("visa").alias("payment_method"), *(F.lit(2).alias(c) for c in numbers), F.to_timestamp(F.lit("2024-01-01")).alias("ingestion_ts"))
    terms, methods = spark.createDataFrame([("PAYMENT_TERMS-0", 5)], "payment_term string, days int"), spark.createDataFrame([("VISA", "card")], "src_payment_method string, sme_payment_method string")
    shape = raw.limit(0)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in PAYABLES_GOLD])
    gold = VersionedTable(spark, str(tmp_path / "gold"), schema)
    t = jobs.Tables(*reference, gold, VersionedTable(spark, str(tmp_path / "tracker"), PAYABLES_TRACKER))
    assert jobs.run_payables(spark, raw, terms, methods, matcher, t, "f1") and not jobs.run_payables(spark, raw, terms, methods, matcher, t, "f1")
    rows = gold.read().collect()
    assert len(rows) == 3 and {r.confidence for r in rows} == {"Medium"} and {r.mcc_group for r in rows} == {"G"} and {r.card_acceptor for r in rows} == {"YES"} and {r.mmh_id for r in rows} == {"M2"} and {r.is_matched for r in rows} == {"Y"}
    with pytest.raises(Exception):
        jobs.run_payables(spark, raw.drop("city"), terms, methods, matcher, t, "f2")
    assert {r.file_id: (r.status, r.record_count) for r in t.tracker.read().collect()} == {"f1": ("SUCCESS", 3), "f2": ("FAILED", 0)} and shape.count() == 0


def test_ledger_job(spark, tmp_path, reference):
    day = F.to_date(F.lit("2024-12-20"))
    rows = spark.createDataFrame([("m1", "s1"), ("m1", "s2"), ("m2", "s1")], "merchant_id string, supplier_id string").withColumns({"soft_delete": F.lit(False), "modified_date": day, "amount": F.lit(5).cast("decimal(15,2)"), "status": F.lit("OPEN"), "due_date": day, "payment_terms": F.lit("x"), "payment_method": F.lit(" visa")})
    suppliers = rows.select("merchant_id", "supplier_id", "soft_delete", *(F.lit("t").alias(c) for c in "supplier_name street_address city state postal_code country phone_number email_address currency issuer_id".split()), F.to_timestamp(F.lit("2024-01-01")).alias("ingestion_ts"))
    suppliers = suppliers.unionByName(suppliers.withColumn("ingestion_ts", F.to_timestamp(F.lit("2023-01-01"))))
    methods = spark.createDataFrame([("Visa", "card")], "src_payment_method string, sme_payment_method string")
    metrics = ledger.ledger_metrics(suppliers, rows, rows, rows, methods, "2024-12-31", ["m1"])
    assert metrics.count() == 6
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ERP_GOLD])
    gold = VersionedTable(spark, str(tmp_path / "gold"), schema)
    t = jobs.Tables(*reference, gold, VersionedTable(spark, str(tmp_path / "tracker"), ERP_TRACKER))
    for _ in range(2):
        jobs.run_ledger(spark, metrics, matcher, t, ["m1"], "r1")
    got = gold.read().collect()
    assert len(got) == 6 and {r.all_suppliers_total_number_of_payments for r in got} == {"2"} and {r.all_suppliers_card_accepting_suppliers for r in got} == {"2"}
    assert [r.status for r in t.tracker.read().collect()] == ["SUCCEEDED"]
    with pytest.raises(ValueError):
        jobs.run_ledger(spark, metrics, matcher, t, ["m1"], "")


def test_clearing_job_and_stream(spark, tmp_path, sf_dir):
    core, other = (x.drop("user_id") for x in catalogue.clearing_details(spark, sf_dir))
    want = clearing.clearing_rollup(core, other)
    path = str(tmp_path / "clearing")
    done = spark.createDataFrame([], CLEARING)
    written = jobs.run_clearing(core, other, done, path, ["01", "02"], "2024-01-10", "2024-01-12")
    days = want.where("process_date between '2024-01-10' and '2024-01-12'")
    assert written.agg(F.sum("n_rows")).first()[0] == days.count() == spark.read.parquet(path).count()
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    core.write.parquet(source)
    arrivals = spark.readStream.schema(core.schema).parquet(source)
    for _ in range(2):  # a replay changes nothing
        stream_clearing(arrivals, lambda: spark.read.parquet(source), lambda: other, out, str(tmp_path / f"cp{_}")).awaitTermination(120)
        assert spark.read.parquet(out).count() == want.count()


def test_merchant_inference_and_summary(spark, sf_dir):
    entities = catalogue.entity_rows(spark, sf_dir)
    args = (catalogue.clearing_table(spark, sf_dir), catalogue.location_rows(spark, sf_dir), entities, "2024-01-30", ["01", "02"], bins.logistic([1.0] * 5, -1.0))
    rows, q = jobs.merchant_inference(*args)
    assert {r.metric for r in q.select("metric").collect()} == {*bins.HIGHER, *bins.LOWER}
    got = rows.collect()
    assert got and all(0 <= r.propensity_score <= 1 and r.propensity_score_label in ("HIGH", "MEDIUM", "LOW") for r in got)
    again, same = jobs.merchant_inference(*args, stored_bins=q)
    assert same is q and again.count() == len(got)
    assert bins.rebuild_due(q, "2024-06-30") and bins.rebuild_due(q.limit(0), "2024-01-30") and not bins.rebuild_due(q, "2024-03-31")
    assert features.latest_snapshot(rows.unionByName(rows.withColumn("refreshed_date", F.lit("2023-01-01").cast("date")))).count() == len(got) and len(MATCHED) == 23


def test_table_partitions_are_replaced_and_others_stay(spark):
    from ledgerlark.sources.tables import overwrite_table_partitions

    spark.sql("DROP TABLE IF EXISTS parts_of_days")
    frame = lambda rows: spark.createDataFrame(rows, "x int, day string")
    overwrite_table_partitions(frame([(1, "a"), (2, "b")]), "parts_of_days", ["day"])
    overwrite_table_partitions(frame([(3, "b"), (4, "c")]).select("day", "x"), "parts_of_days", ["day"])
    overwrite_table_partitions(frame([]), "parts_of_days", ["day"])
    assert sorted(map(tuple, spark.table("parts_of_days").collect())) == [(1, "a"), (3, "b"), (4, "c")]
    with pytest.raises(ValueError, match="has no columns y"):
        overwrite_table_partitions(frame([(5, "a")]).selectExpr("x", "day", "1 as y"), "parts_of_days", ["day"])
    with pytest.raises(ValueError, match="partitioned by day"):
        overwrite_table_partitions(frame([(5, "a")]), "parts_of_days", ["x"])
    assert spark.table("parts_of_days").count() == 3


def test_union_fills_missing_columns(spark):
    from ledgerlark.sources.tables import union_with_missing

    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3, 4)], "y int, z int")
    assert sorted(map(tuple, union_with_missing(a, b, a.limit(0)).collect()), key=repr) == [(1, 2, None), (None, 3, 4)]
    with pytest.raises(ValueError):
        union_with_missing()
