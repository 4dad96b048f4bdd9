import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import bins, blocking, clearing, ledger, matching, payables
from ledgerlark.schemas import CLEARING, ERP_GOLD, PAYABLES_GOLD, PAYABLES_TRACKER
from ledgerlark.sources import tables


def test_contracts():
    assert len(PAYABLES_GOLD) == 88 and len(ERP_GOLD) == 77 and len(CLEARING.fields) == 11 and len(set(PAYABLES_GOLD)) == 88


def test_periods_nest(spark):
    rows = [("m", "s", f"2024-12-{31 - k:02d}" if k < 31 else None, 1.0) for k in (0, 30)] + [("m", "s", d, 1.0) for d in ("2024-12-01", "2024-10-02", "2024-10-01", "2024-01-01", "2023-12-31")]
    df = spark.createDataFrame(rows, "merchant_id string, supplier_id string, d string, amount double").select("*", F.to_date("d").alias("modified_date"), F.lit(False).alias("soft_delete"), F.lit(" open").alias("status"), F.lit(None).cast("string").alias("payment_terms"), F.to_date("d").alias("due_date"))
    got = {r.date_period: r for r in ledger.invoice_rollup(ledger.live_rows(df, "2024-12-31"), "2024-12-31").collect()}
    assert {p: r.total_number_of_invoices for p, r in got.items()} == {"monthly": 3, "quarterly": 4, "yearly": 6}
    assert got["yearly"].payment_terms == [] and got["yearly"].total_number_of_payments_due == 5


def test_soft_deleted_and_null_are_left_out(spark):
    df = spark.createDataFrame([("m", True, "2024-12-30"), ("m", None, "2024-12-30"), ("m", False, "2024-12-30"), ("n", False, "2024-12-30")], "merchant_id string, soft_delete boolean, d string").withColumn("modified_date", F.to_date("d"))
    assert ledger.live_rows(df, "2024-12-31", ["m"]).count() == 1


def test_totals_without_a_single_partition(spark, sf_dir):
    from ledgerlark.plans.catalogue import ap_totals

    plan = ap_totals(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "BroadcastNestedLoopJoin" in plan


def test_bins_cover_the_line_once(spark):
    rows = spark.createDataFrame([(i, float(i % 37), 1.0) for i in range(500)] + [(900, None, 1.0), (901, float("nan"), 1.0), (902, 5.0, 0.0), (903, 5.0, None)], "id int, v double, spend double")
    q = bins.exact_quantiles(rows.where("v = v"), "v").cache()
    table = bins.bin_table(q).orderBy("bin_idx").collect()
    assert len(table) == 100 and table[0].prev_hi == float("-inf") and table[-1].hi == float("inf") and all(a.hi == b.prev_hi for a, b in zip(table, table[1:]))
    scored = {r.id: r.v_percentile for r in bins.score(rows, q, ["v"], "spend").collect()}
    assert len(scored) == 504 and scored[900] is None and scored[901] is None and scored[902] == 0.0 and scored[903] is None
    first = {r.id: next(t.bin_idx for t in table if t.prev_hi < r.v <= t.hi) for r in rows.where("id < 500").collect()}
    assert all(abs(scored[i] - (2 * b + 1) / 200) <= 0.0051 for i, b in first.items())
    approx = bins.quantiles(rows.where("v = v"), ["v"], ["id"]).collect()
    assert {r.metric: (len(r.q), r.is_negated) for r in approx} == {"v": (101, False), "id": (101, True)}


def test_cascade(spark):
    rows = spark.createDataFrame(
        [(1, "Acme Foods", "1 Main St", "Berlin", "10115", "DEU", ""), (2, "Nothing", "", "", "", "DEU", ""), (3, "Shop DBA Acme Foods", "", "", "", "DEU", ""), (4, "acme", "", "", "", "FRA", ""), (5, "Acme Foodz", "", "berlin", "", "DEU", "")],
        "row_id int, norm_supplier_name string, norm_street_address string, norm_city string, norm_postal_code string, norm_country string, full_form_state string")
    entities = spark.createDataFrame([("E2", "Acme Foods", "Other", "1 Main Street", "Berlin", "", "10115", "DEU"), ("E1", "Acme Foods", "Other", "1 Main Street", "Berlin", "", "10115", "DEU")],
                                     "entity_id string, legal_name string, dba_name string, street_address string, city string, state string, postal_code string, country string")
    got = {r.row_id: r for r in matching.cascade(rows, entities).collect()}
    assert len(got) == 5 and got[1].entity_id == "E1" and got[1].matched_rule == "Filter_Rule1" and got[1].matched_score >= 0.85
    assert got[2].matched_rule == "no_match" and got[2].matched_score == 0 and got[2].successful == "N" and got[4].successful == "N"
    assert got[3].matched_rule.endswith("_DBA_Part2") and got[5].successful == "Y"


def test_cascade_tests_every_pair_that_a_rule_accepts(spark, monkeypatch):
    names = ["Fedx", "Max", "a", "ab Co", "Foods Acme", "Acme", "Shop DBA Delta Air", "Kuehne-Nagel", "Inter national", "X1 2", "Bäcker", "Siemen", "Walmrt Stores", "Maxwel House", ""]
    others = [("Fedex", ""), ("Maxwell", "House"), ("Alpha", "abco"), ("ab company", "x"), ("Acme Best Foods", ""), ("Acmee", "The acmeland"), ("Delta Airr", ""), ("KuehneNagel", None), ("International", "Inter"), ("X12", "2 X1"), ("Backer", "Bäckerei"), ("Simens", "AG"), ("Wal-mart Store", ""), ("House Maxwell", "")]
    rows = spark.createDataFrame([(i, n, "", "Rome" if i == 9 else "", "", "DEU", "") for i, n in enumerate(names)], "row_id int, norm_supplier_name string, norm_street_address string, norm_city string, norm_postal_code string, norm_country string, full_form_state string")
    entities = spark.createDataFrame([(f"E{i:02d}", *n, "", "rome" if i == 3 else "", "", "", "DEU") for i, n in enumerate(others)], "entity_id string, legal_name string, dba_name string, street_address string, city string, state string, postal_code string, country string")
    got = sorted(map(tuple, matching.cascade(rows, entities).collect()))
    assert [r[1] for r in got[:2]] == ["E00", "E01"]
    monkeypatch.setattr(matching, "candidates", lambda a, b: a.select("row_id").crossJoin(b.select("entity_id")))
    assert got == sorted(map(tuple, matching.cascade(rows, entities).collect()))


def test_hybrid_match_uses_the_cache(spark):
    rows = spark.createDataFrame([(1, "h1", "Acme", "", "", "", "DEU", ""), (2, "h2", "Acme", "", "", "", "DEU", "")], "row_id int, request_hash string, norm_supplier_name string, norm_street_address string, norm_city string, norm_postal_code string, norm_country string, full_form_state string")
    entities = spark.createDataFrame([("E", "Acme", "", "", "", "", "", "DEU")], "entity_id string, legal_name string, dba_name string, street_address string, city string, state string, postal_code string, country string")
    cache = spark.createDataFrame([("h1", "C1", 0.9, "r", "2024-01-05"), ("h1", "C2", 0.9, "r", "2024-01-06"), ("h2", "C3", 0.9, "r", "2023-01-01")], "request_hash string, entity_id string, matched_score double, matched_rule string, t string").withColumn("audit_ts", F.to_timestamp("t"))
    results, new = matching.hybrid_match(rows, entities, cache, "2024-01-07")
    assert {r.row_id: r.entity_id for r in results.collect()} == {1: "C2", 2: "E"} and [r.request_hash for r in new.collect()] == ["h2"]


def test_missing_days_without_any_partition(spark):
    done = spark.createDataFrame([("1", "2024-01-02")], "dw_merch_region_cd string, process_date string")
    got = [(r.region, str(r.day)) for r in clearing.missing_days(done, ["1", "2"], "2024-01-03", "2024-01-04").collect()]
    assert sorted(got) == [("1", "2024-01-03"), ("1", "2024-01-04"), ("2", "2024-01-03"), ("2", "2024-01-04")]
    assert clearing.missing_days(done, ["1"], "2024-01-01", "2024-01-01").count() == 0


def test_versioned_table_and_tracker(spark, tmp_path):
    t = tables.VersionedTable(spark, str(tmp_path / "t"), "k string, v int")
    assert t.read().count() == 0
    t.write(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int"))
    keys = spark.createDataFrame([("a",), ("c",)], "k string")
    t.upsert(spark.createDataFrame([("c", 9)], "k string, v int"), keys, ["k"])
    assert sorted(map(tuple, t.read().collect())) == [("b", 3), ("c", 9)]
    tracker = spark.createDataFrame([("f1", None, None, 0.0, 0, "IN-PROGRESS", None), ("f2", None, None, 0.0, 0, "FAILED", None), ("f3", None, None, 0.0, 0, None, None)], PAYABLES_TRACKER)
    assert [tables.already_processed(tracker, f) for f in ("f1", "f2", "f3", "f4")] == [True, False, False, False]


def test_versioned_table_is_never_half_written(spark, tmp_path, monkeypatch):
    shape = "k string, v int"
    t = tables.VersionedTable(spark, str(tmp_path / "t"), shape, by=["k"], buckets=8)
    row = lambda *r: spark.createDataFrame(list(r), shape)
    key = lambda *k: spark.createDataFrame([(x,) for x in k], "k string")
    t.write(row(*((f"k{i}", i) for i in range(40))))
    before = t._folders(1)
    t.upsert(row(("k3", 300), ("k3", 301)), key("k3", "k4"), ["k"])
    after = t._folders(2)
    assert sum(before[b] != after.get(b) for b in before) <= 2 and any(before[b] == after.get(b) for b in before)  # touched buckets only
    want = sorted([(f"k{i}", i) for i in range(40) if i not in (3, 4)] + [("k3", 300), ("k3", 301)])
    assert sorted(map(tuple, t.read().collect())) == want and len(t.read(1).collect()) == 40
    for step in ("_put", "_commit"):  # a crash at either step leaves the old table
        with monkeypatch.context() as m:
            m.setattr(tables.VersionedTable, step, lambda *a: (_ for _ in ()).throw(OSError("gone")))
            with pytest.raises(OSError):
                t.upsert(row(("k9", 0)), key("k9"), ["k"])
        assert sorted(map(tuple, t.read().collect())) == want and t.version() == 2
    with pytest.raises(tables.Conflict):  # someone else committed after version 1 was read
        t.write(row(("x", 1)), base=1)
    assert t.version() == 2
    t.upsert(row(("k1", 7)), key("k1", "none"), ["k"])
    assert ("k1", 7) in set(map(tuple, t.read().collect())) and t.version() == 3
    for f in (tmp_path / "t" / "commits").iterdir():
        f.unlink()
    with pytest.raises(RuntimeError):  # data without commits is no empty table
        t.read()


def test_run_audit(spark):
    from datetime import datetime

    a, b = datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 2, 500_000)
    tables.append_run_audit(spark, "audit_t", [], a, b)
    assert not spark.catalog.tableExists("audit_t")
    tables.append_run_audit(spark, "audit_t", ["m1", "m2"], a, b)
    tables.append_run_audit(spark, "audit_t", ["m3"], a, b)
    assert sorted((r.merchant_id, r.time_taken, r.status) for r in spark.table("audit_t").collect()) == [(f"m{i}", 2.5, "SUCCESS") for i in (1, 2, 3)]
    spark.sql("DROP TABLE audit_t")


def test_suppliers_are_matched_from_raw_rows(spark):
    from ledgerlark.plans.jobs import JobConfig, rule_matcher, with_matches

    names = spark.createDataFrame([("United States", "US")], "country_name string, country_code_2alpha string")
    aliases = spark.createDataFrame([("usa", "United States")], "alias string, country_name string")
    fields = "supplier_id string, supplier_name string, street_address string, city string, state string, postal_code string, country string"
    rows = spark.createDataFrame([("1", "Alpha Bakery", "1 Main St", "Reno", "NV", "89501", "USA"), ("2", " Alpha  Bakery", "1 Main St", "Reno", "NV", "89501", "usa"), ("3", "Zzz", None, None, None, None, "USA")], fields)
    entities = spark.createDataFrame([("E1", "Alpha Bakery", "", "1 Main St", "Reno", "Nevada", "89501", "United States")], "entity_id string, legal_name string, dba_name string, street_address string, city string, state string, postal_code string, country string")
    cache = spark.createDataFrame([], "request_hash string, entity_id string, matched_score double, matched_rule string, audit_ts timestamp")
    got = {r.supplier_id: r for r in rule_matcher(entities, cache, names, aliases, "2024-01-01")(rows).collect()}
    assert got["1"].entity_id == "E1" and got["1"].successful == "Y" and got["3"].successful == "N" and len(got) == 3
    assert JobConfig.of(["--min-match-score", "0.9"]).min_match_score == 0.9
    with pytest.raises(ValueError):
        JobConfig(match_type="other")
    ties = spark.createDataFrame([("1", "E2", 0.9), ("1", "E1", 0.9), ("1", "E0", 0.1), ("2", None, None)], "supplier_id string, entity_id string, matched_score double")
    best = {r.supplier_id: (r.entity_id, r.is_matched) for r in with_matches(rows.select("supplier_id"), ties).collect()}
    assert best == {"1": ("E1", "Y"), "2": (None, "N"), "3": (None, "N")}


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "p")
    row = lambda d, v: spark.createDataFrame([(d, v)], "d string, v int")
    tables.overwrite_partitions(row("1", 1).unionByName(row("2", 2)), path, ["d"])
    tables.overwrite_partitions(row("2", 5), path, ["d"])
    assert sorted((str(r.d), r.v) for r in spark.read.parquet(path).collect()) == [("1", 1), ("2", 5)]
    tables.create_table(spark, "sink_t", "v int, d string", ["d"])
    tables.append(row("1", 1), "sink_t")
    tables.append(row("2", 2).select("v", "d"), "sink_t")
    assert sorted((r.v, r.d) for r in spark.table("sink_t").collect()) == [(1, "1"), (2, "2")]
    assert tables.drop_partition(spark, "sink_t", d="1") and spark.table("sink_t").count() == 1 and not tables.drop_partition(spark, "none_t", d="1")
    spark.sql("DROP TABLE sink_t")


def test_embedding_matcher(spark):
    names = ["Alpha Bakery", "Beta Motors", "Gamma Flowers", "Delta Pharmacy"]
    source = blocking.embed_source(spark.createDataFrame(
        [(i, 100 + i, None, n, "1 st", "1", "s", "de") for i, n in enumerate(names)], "old_loc_id long, merchant_market_hierarchy_id long, cleansed_legal_corporate_name string, cleansed_merchant_name string, cleansed_merchant_street_addr string, cleansed_merchant_postal_code string, cleansed_state_province_code string, cleansed_country_code string"), blocking.hashing_embedder())
    model = blocking.fit_clusters(source, k=2)
    rows = spark.createDataFrame([("s1", "Alpha Bakery", None, "DE"), ("s2", "Qqqq", "x", "DE"), ("s3", "Beta Motors", "", "DE")], "supplier_id string, supplier_name string, street_address string, country string")
    audit = spark.createDataFrame([("Beta Motors", "", "DE", "OLD", "Y", 0.7)], "supplier_name string, street_address string, country string, entity_id string, is_matched string, matched_score double")
    result, new = blocking.match_suppliers(rows, source, audit, model, blocking.hashing_embedder(), 0.5)
    got = {r.supplier_id: r for r in result.collect()}
    assert set(got) == {"s1", "s2", "s3"} and got["s3"].entity_id == "OLD" and got["s2"].is_matched == "N" and got["s2"].matched_score == 0
    assert [r.entity_id for r in new.collect()] == ["0000001c"]


def test_payables_odd_rows(spark):
    rows = spark.createDataFrame([("a", "X", "VISA", 0, 0, None, None, 1, "2024-01-01"), ("b", None, None, 1, 1, 2.0, 3.0, None, "2024-01-01"), ("b", "x", "zzz", 1, None, 2.0, None, 2, "2024-01-01")], "supplier_id string, payment_terms string, payment_method string, total_number_of_payments_paid int, total_number_of_payments_open int, total_amount_of_payments_paid double, total_amount_of_payments_open double, total_number_of_invoices int, t string").withColumn("ingestion_ts", F.to_timestamp("t"))
    terms, methods = spark.createDataFrame([("x", 30)], "payment_term string, days int"), spark.createDataFrame([("visa", "card")], "src_payment_method string, sme_payment_method string")
    got = payables.enrich(rows, terms, methods).collect()
    assert len(got) == 3 and {r.all_suppliers_total_number_of_suppliers for r in got} == {3} and {r.all_suppliers_total_spend for r in got} == {7.0}
    assert sorted((r.supplier_id, str(r.next_payment_date), r.average_ticket) for r in got if r.payment_terms) == [("a", "2024-01-31", None), ("b", "2024-01-31", 2.0)]


def test_cascade_loses_no_pair_that_a_rule_accepts(spark, monkeypatch):
    """The cascade over its candidates beside the cascade over all pairs."""
    names = ["Craft Works", "Kraft Works", "ab", "Abacus Trading", "Fedx", "Fedex", "Max", "Maxwell Sons", "Blue River Foods", "River Foods Blue", "Zeta", "Omega Paper Co", "Omga Paper", "Delta DBA Craft"]
    places = [("Reno", "Nevada", "89501", "1 Main St"), ("", "", "", ""), ("Bonn", "", "53111", "2 Rue X")]
    rows = [(f"r{i}-{k}", n, *p, "US") for i, n in enumerate(names) for k, p in enumerate(places)]
    fields = "row_id string, norm_supplier_name string, norm_city string, full_form_state string, norm_postal_code string, norm_street_address string, norm_country string"
    own = spark.createDataFrame(rows, fields)
    other = spark.createDataFrame([(f"E{i}-{k}", n, names[-1 - i] if k else "", p[0], p[1], p[2], p[3], "US" if i % 5 else "DE") for i, n in enumerate(names) for k, p in enumerate(places)],
                                  "entity_id string, legal_name string, dba_name string, city string, state string, postal_code string, street_address string, country string")
    got = sorted(map(tuple, matching.cascade(own, other).collect()), key=str)
    monkeypatch.setattr(matching, "candidates", lambda a, b: a.select("row_id").crossJoin(b.select("entity_id")))
    assert got == sorted(map(tuple, matching.cascade(own, other).collect()), key=str)
    assert sum(r[-1] == "Y" for r in got) > len(rows) // 2


def test_only_ties_for_the_best_score_are_sorted_whole(spark):
    from ledgerlark.plans.jobs import with_matches

    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "supplier_id string")
    found = spark.createDataFrame([("a", "E2", 0.5), ("a", "E1", 0.5), ("a", "E0", 0.4), ("a", "E9", float("nan")), ("b", "E3", None), ("b", "E4", float("nan"))], "supplier_id string, entity_id string, matched_score double")
    out = with_matches(rows, found)
    assert {r.supplier_id: r.entity_id for r in out.collect()} == {"a": "E1", "b": "E4", "c": None}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[supplier_id" in plan
