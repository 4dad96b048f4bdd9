"""Registered queries of the library on the driver's tables, each beside its SQL.

The adapters give the tables the shapes the operators expect: suppliers and customers are suppliers and merchants, line items
are invoices and payments, orders purchase orders, events clearing details. Dates are literal, arrays are joined texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import attributes, scalar, similarity, text
from ..operators import bins, blocking, clearing, features, ledger, matching, payables
from ..sources import tables
from . import jobs

AS_OF = "2001-11-05"
METHODS = [("R", "card"), ("A", "check"), ("n ", "ach")]
TERMS = [("net r", 30), ("NET A", 45)]
METHODS_SQL = "(VALUES ('R', 'card'), ('A', 'check'), ('n ', 'ach')) AS pm(src, dst)"
TERMS_SQL = "(VALUES ('net r', 30), ('NET A', 45)) AS pt(term, days)"
money = lambda c: F.col(c).cast("decimal(15,2)")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*(F.col(c).cast("double").alias(c) if c in columns else F.col(c) for c in df.columns))


def payable_rows(spark: SparkSession, d: str) -> DataFrame:
    item, supplier = table(spark, d, "lineitem"), table(spark, d, "supplier")
    paid, price = F.col("l_linestatus") == "F", money("l_extendedprice")
    rows = item.groupBy("l_suppkey", "l_returnflag").agg(
        F.count("*").alias("total_number_of_invoices"), F.count(F.when(paid, 1)).alias("total_number_of_payments_paid"), F.count(F.when(~paid & (F.col("l_quantity") > 10), 1)).alias("total_number_of_payments_open"),
        F.sum(F.when(paid, price)).alias("total_amount_of_payments_paid"), F.sum(F.when(~paid & (F.col("l_quantity") > 10), price)).alias("total_amount_of_payments_open"), F.max("l_shipdate").alias("ingestion_ts"))
    return rows.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name"), F.concat(F.lit("Net "), "l_returnflag").alias("payment_terms"), F.col("l_returnflag").alias("payment_method"), *rows.columns[2:])


PAYABLE_SQL = f"""
raw AS (
  SELECT l_suppkey AS supplier_id, s_name AS supplier_name, l_returnflag AS m, count(*) AS n_inv, count(*) FILTER (l_linestatus = 'F') AS n_paid, count(*) FILTER (l_linestatus <> 'F' AND l_quantity > 10) AS n_open,
    sum(CAST(l_extendedprice AS DECIMAL(15,2))) FILTER (l_linestatus = 'F') AS a_paid, sum(CAST(l_extendedprice AS DECIMAL(15,2))) FILTER (l_linestatus <> 'F' AND l_quantity > 10) AS a_open, max(l_shipdate) AS ts
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
ap AS (
  SELECT raw.*, pt.days, pm.dst AS mapped, coalesce(n_paid, 0) + coalesce(n_open, 0) AS n, coalesce(a_paid, 0) + coalesce(a_open, 0) AS spend
  FROM raw LEFT JOIN {TERMS_SQL} ON lower('Net ' || raw.m) = lower(pt.term) LEFT JOIN {METHODS_SQL} ON lower(raw.m) = lower(pm.src)),
c AS (
  SELECT *, CASE WHEN mapped = 'card' THEN spend ELSE 0 END AS card, CASE WHEN mapped = 'eft' THEN spend ELSE 0 END AS eft, CASE WHEN mapped = 'check' THEN spend ELSE 0 END AS cheque,
    CASE WHEN mapped = 'ach' THEN spend ELSE 0 END AS ach, CASE WHEN mapped IS NULL OR mapped NOT IN ('card', 'eft', 'check', 'ach') THEN spend ELSE 0 END AS other FROM ap)
"""


def mapped_payables(spark: SparkSession, d: str) -> DataFrame:
    return payables.map_terms_and_methods(payable_rows(spark, d), tables.local_rows(spark, TERMS, "payment_term string, days int"), tables.local_rows(spark, METHODS, "src_payment_method string, sme_payment_method string"))


def ap_enrich(spark, d):
    return mapped_payables(spark, d).select("supplier_id", "payment_method", "payment_term_days", "mapped_payment_method", "total_number_of_invoices")


def ap_contrib(spark, d):
    out = payables.contributions(mapped_payables(spark, d))
    spent = [f"total_spent_by_{m}" for m in (*payables.METHODS, "other")]
    return out.select("supplier_id", "payment_method", F.round(F.col("average_ticket").cast("double"), 2).alias("average_ticket"), F.col("total_spend").cast("double").alias("total_spend"), *(F.col(c).cast("double").alias(c) for c in spent))


def ap_totals(spark, d):
    out = payables.with_totals(payables.contributions(mapped_payables(spark, d)))
    names = [*payables.TOTALS, "all_suppliers_total_number_of_suppliers"]
    return out.select("supplier_id", "payment_method", *(F.col(c).cast("double").alias(c) for c in names))


def ap_due_date(spark, d):
    return payables.with_due_dates(mapped_payables(spark, d)).select("supplier_id", "payment_method", F.date_format("next_payment_date", "yyyy-MM-dd").alias("next_payment_date"))


def confidence(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderkey") % 100 / 100).alias("score"))
    return rows.select("o_orderkey", scalar.confidence_tier(F.col("score")).alias("confidence"), scalar.propensity_tier(F.round("score", 2)).alias("propensity"))


def quarter_label(spark, d):
    return table(spark, d, "orders").groupBy(scalar.quarter_label(F.col("o_orderdate").cast("date")).alias("quarter")).agg(F.count("*").alias("n"))


def recency_flags(spark, d):
    month = lambda hit: F.trunc(F.max(F.when(hit, F.col("o_orderdate"))).cast("date"), "month")
    rows = table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(month(F.lit(True)).alias("any"), month(F.col("o_orderstatus") == "P").alias("own"))
    recency = scalar.months_since(F.lit("2001-11-01").cast("date"), F.col("any"))
    return rows.select("c_custkey", recency.cast("long").alias("recency"), scalar.history_flag(F.col("any"), F.col("own")).alias("history"), scalar.card_acceptor(recency, F.when(F.col("c_custkey") % 3 > 0, "id").otherwise("")).alias("acceptor"))


def latest_version(spark, d):
    return ledger.latest_version(table(spark, d, "events").select("event_id", "ts", "user_id", "event_type"), ["user_id"], "ts", ["event_id"]).select("user_id", "event_id", "event_type")


def period_expand(spark, d):
    return ledger.each_period(table(spark, d, "supplier").select("s_suppkey", "s_name")).select("date_period", "s_suppkey", "s_name")


def ledger_rows(spark, d):
    """Line items as invoices and payments of seven merchants, all of the last year."""
    item = table(spark, d, "lineitem").select(
        F.concat(F.lit("M"), F.col("l_suppkey") % 7).alias("merchant_id"), F.col("l_suppkey").cast("string").alias("supplier_id"), F.col("l_returnflag").alias("payment_terms"), F.col("l_returnflag").alias("payment_method"),
        F.when(F.col("l_linestatus") == "O", " open").when(F.col("l_quantity") > 25, "Paid ").otherwise("submitted").alias("status"), money("l_extendedprice").alias("amount"),
        F.date_add(F.col("l_shipdate").cast("date"), F.col("l_linenumber") * 10 - 30).alias("due_date"), F.col("l_shipdate").cast("date").alias("modified_date"), (F.col("l_linenumber") == 7).alias("soft_delete"))
    return ledger.live_rows(item, AS_OF)


LEDGER_SQL = f"""
led AS (
  SELECT * FROM (
    SELECT 'M' || (l_suppkey % 7) AS merchant_id, CAST(l_suppkey AS VARCHAR) AS supplier_id, l_returnflag AS m, CASE WHEN l_linestatus = 'O' THEN 'OPEN' WHEN l_quantity > 25 THEN 'PAID' ELSE 'SUBMITTED' END AS st,
      CAST(l_extendedprice AS DECIMAL(15,2)) AS amount, CAST(l_shipdate AS DATE) + CAST(l_linenumber * 10 - 30 AS INTEGER) AS due, CAST(l_shipdate AS DATE) AS mod FROM lineitem WHERE l_linenumber <> 7)
  WHERE mod >= DATE '{AS_OF}' - 365),
per AS (SELECT p.date_period, led.* FROM led JOIN (VALUES ('monthly', 30), ('quarterly', 90), ('yearly', 365)) AS p(date_period, days) ON mod >= DATE '{AS_OF}' - p.days),
inv AS (
  SELECT date_period, merchant_id, supplier_id, string_agg(DISTINCT m, ',' ORDER BY m) AS payment_terms, count(*) AS n_inv, CAST(sum(amount) AS DOUBLE) AS a_inv, count(*) FILTER (st = 'PAID') AS n_paid, CAST(coalesce(sum(amount) FILTER (st = 'PAID'), 0) AS DOUBLE) AS a_paid,
    count(*) FILTER (st IN ('OPEN', 'SUBMITTED') AND due < DATE '{AS_OF}') AS n_due, CAST(coalesce(sum(amount) FILTER (st IN ('OPEN', 'SUBMITTED') AND due < DATE '{AS_OF}'), 0) AS DOUBLE) AS a_due, count(*) FILTER (st = 'OPEN') AS n_open,
    CAST(coalesce(sum(amount) FILTER (st = 'OPEN'), 0) AS DOUBLE) AS a_open, strftime(min(due) FILTER (st IN ('OPEN', 'SUBMITTED') AND due >= DATE '{AS_OF}'), '%Y-%m-%d') AS next_payment_date
  FROM per GROUP BY ALL),
pay AS (
  SELECT date_period, merchant_id, supplier_id, coalesce(string_agg(DISTINCT dst, ',' ORDER BY dst), '') AS payment_method, count(*) AS n, CAST(max(CASE WHEN dst = 'card' THEN 1 ELSE 0 END) AS BIGINT) AS accepts, CAST(sum(amount) AS DOUBLE) AS spend,
    CAST(sum(CASE WHEN dst = 'card' THEN amount ELSE 0 END) AS DOUBLE) AS card, CAST(sum(CASE WHEN dst = 'check' THEN amount ELSE 0 END) AS DOUBLE) AS cheque, CAST(sum(CASE WHEN dst = 'ach' THEN amount ELSE 0 END) AS DOUBLE) AS ach,
    CAST(sum(CASE WHEN dst IS NULL OR dst NOT IN ('card', 'check', 'ach') THEN amount ELSE 0 END) AS DOUBLE) AS other
  FROM per LEFT JOIN {METHODS_SQL} ON lower(trim(per.m)) = lower(pm.src) GROUP BY ALL),
po AS (
  SELECT date_period, 'M' || (o_custkey % 7) AS merchant_id, CAST(o_custkey % 100 AS VARCHAR) AS supplier_id, count(*) FILTER (o_orderstatus IN ('O', 'F')) AS n_po, CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) FILTER (o_orderstatus IN ('O', 'F')) AS DOUBLE) AS a_po
  FROM orders JOIN (VALUES ('monthly', 30), ('quarterly', 90), ('yearly', 365)) AS p(date_period, days) ON CAST(o_orderdate AS DATE) >= DATE '{AS_OF}' - p.days GROUP BY ALL),
sup AS (SELECT p.date_period, 'M' || (s_suppkey % 7) AS merchant_id, CAST(s_suppkey AS VARCHAR) AS supplier_id FROM supplier, (VALUES ('monthly'), ('quarterly'), ('yearly')) AS p(date_period)),
fin AS (
  SELECT sup.*, coalesce(n_inv, 0) AS n_inv, coalesce(a_inv, 0) AS a_inv, coalesce(n_po, 0) AS n_po, coalesce(a_po, 0) AS a_po, coalesce(n_paid, 0) AS n_paid, coalesce(n_due, 0) AS n_due, coalesce(n_open, 0) AS n_open, coalesce(spend, 0) AS spend, accepts
  FROM sup LEFT JOIN po USING (date_period, merchant_id, supplier_id) LEFT JOIN inv USING (date_period, merchant_id, supplier_id) LEFT JOIN pay USING (date_period, merchant_id, supplier_id))
"""


def rolled_invoices(spark, d):
    return ledger.invoice_rollup(ledger_rows(spark, d), AS_OF)


def invoice_rollup(spark, d):
    r = rolled_invoices(spark, d)
    return r.select(
        *ledger.KEYS, F.concat_ws(",", "payment_terms").alias("payment_terms"), F.col("total_number_of_invoices").alias("n_inv"), F.col("total_amount_of_invoices").cast("double").alias("a_inv"),
        F.col("total_number_of_payments_paid").alias("n_paid"), F.col("total_amount_of_payments_paid").cast("double").alias("a_paid"), F.col("total_number_of_payments_due").alias("n_due"),
        F.col("total_amount_of_payments_due").cast("double").alias("a_due"), F.col("total_number_of_payments_open").alias("n_open"), F.col("total_amount_of_payments_open").cast("double").alias("a_open"),
        F.date_format("next_payment_date", "yyyy-MM-dd").alias("next_payment_date"))


def rolled_orders(spark, d):
    status = F.when(F.col("o_orderstatus") == "O", "submitted").when(F.col("o_orderstatus") == "F", " Billed").otherwise("draft")
    rows = table(spark, d, "orders").select(
        F.concat(F.lit("M"), F.col("o_custkey") % 7).alias("merchant_id"), (F.col("o_custkey") % 100).cast("string").alias("supplier_id"), status.alias("status"), money("o_totalprice").alias("amount"),
        F.col("o_orderdate").cast("date").alias("modified_date"), F.lit(False).alias("soft_delete"))
    return ledger.order_rollup(ledger.live_rows(rows, AS_OF), AS_OF)


def po_rollup(spark, d):
    return rolled_orders(spark, d).select(*ledger.KEYS, F.col("total_number_of_purchase_orders").alias("n_po"), F.col("total_amount_of_purchase_orders").cast("double").alias("a_po"))


def rolled_payments(spark, d):
    methods = tables.local_rows(spark, METHODS, "src_payment_method string, sme_payment_method string")
    return ledger.payment_rollup(ledger.map_methods(ledger_rows(spark, d), methods), AS_OF)


def payment_rollup(spark, d):
    names = {"total_amount_spend": "spend", "total_spent_by_card": "card", "total_spent_by_cheque": "cheque", "total_spent_by_ach": "ach", "total_spent_by_other": "other"}
    return rolled_payments(spark, d).select(
        *ledger.KEYS, F.concat_ws(",", "payment_method").alias("payment_method"), F.col("total_number_of_payments").alias("n"), F.col("total_number_of_card_accepting_suppliers").alias("accepts"), *(F.col(c).cast("double").alias(n) for c, n in names.items()))


def metrics(spark, d):
    suppliers = table(spark, d, "supplier").select(F.concat(F.lit("M"), F.col("s_suppkey") % 7).alias("merchant_id"), F.col("s_suppkey").cast("string").alias("supplier_id"))
    return ledger.final_metrics(ledger.each_period(suppliers), rolled_invoices(spark, d), rolled_orders(spark, d), rolled_payments(spark, d))


def final_metrics(spark, d):
    names = {"total_number_of_invoices": "n_inv", "total_number_of_purchase_orders": "n_po", "total_number_of_payments_paid": "n_paid", "total_number_of_payments_due": "n_due", "total_number_of_payments_open": "n_open"}
    amounts = {"total_amount_of_invoices": "a_inv", "total_amount_of_purchase_orders": "a_po", "total_amount_spend": "spend"}
    return metrics(spark, d).select(*ledger.KEYS, *(F.col(c).cast("long").alias(n) for c, n in names.items()), *(F.col(c).cast("double").alias(n) for c, n in amounts.items()), F.col("total_number_of_card_accepting_suppliers").alias("accepts"))


def merchant_rollup(spark, d):
    m = ledger.merchant_rollup(metrics(spark, d))
    return m.select("merchant_id", "date_period", *(F.col(c).cast("long").alias(c) for c in m.columns[2:]))


def clearing_details(spark, d):
    """Events as clearing details of two sources: even users in one, odd ones in the other."""
    e = table(spark, d, "events")
    rows = e.select(
        (F.col("user_id") % 50).alias("dw_merch_location_id"), F.when(F.col("user_id") % 3 == 0, "8").otherwise("1").alias("pds1_paypass_acct_nbr_type_ind"), (F.col("user_id") % 5).alias("dw_issuer_id"), (F.col("user_id") % 5).alias("de93_issuer_id"),
        F.lit("USA").alias("dw_merch_country_cd"), F.when(F.col("event_type") == "purchase", "MCP").otherwise(F.col("event_type")).alias("dw_product_cd"), F.date_format("ts", "yyyy-MM-dd").alias("local_txn_date"), F.date_format("ts", "yyyy-MM-dd").alias("de12_txn_date"),
        F.date_format("ts", "yyyy-MM-dd").alias("dw_process_date"), F.concat(F.lit("0"), F.col("user_id") % 2 + 1).alias("dw_merch_region_cd"), F.when(F.col("event_id") % 4 == 0, "05").when(F.col("event_id") % 4 == 1, "00").otherwise("20").alias("de3_cardholder_txn_type"),
        F.col("value").cast("decimal(18,4)").alias("de4_txn_amt"), F.lit(1).cast("long").alias("dw_net_pd_cnt"), F.col("value").cast("decimal(18,4)").alias("dw_net_pd_amt"), F.col("user_id"))
    return rows.where("user_id % 2 = 0"), rows.where("user_id % 2 = 1")


CLEARING_SQL = """
clr AS (
  SELECT user_id % 50 AS loc, CASE WHEN user_id % 3 = 0 THEN '8' ELSE '1' END AS acct, user_id % 5 AS issuer, CASE WHEN user_id % 2 = 0 THEN 'CORE' ELSE 'GCO' END AS source_type, CASE WHEN event_type = 'purchase' THEN 'MCP' ELSE event_type END AS product_cd,
    strftime(ts, '%Y-%m-%d') AS process_date, '0' || (user_id % 2 + 1) AS region, count(*) AS cnt, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS amt
  FROM events WHERE event_id % 4 <> 0 AND CAST(value AS DECIMAL(18,4)) >= 1 GROUP BY ALL)
"""


def clearing_table(spark, d):
    return clearing.clearing_rollup(*clearing_details(spark, d))


def clearing_union_agg(spark, d):
    return clearing_table(spark, d).select(
        F.col("dw_merch_location_id").alias("loc"), F.col("pds1_paypass_acct_nbr_type_ind").alias("acct"), F.col("dw_issuer_id").alias("issuer"), "source_type", "product_cd", "process_date", F.col("dw_merch_region_cd").alias("region"),
        F.col("dw_net_pd_cnt").alias("cnt"), F.round("dw_net_pd_amt", 2).alias("amt"))


def clearing_missing_days(spark, d):
    out = clearing.missing_days(clearing_table(spark, d).where("process_date < '2024-01-20' or dw_merch_region_cd <> '01'"), ["01", "02", "03"], "2024-01-28", "2024-02-02")
    return out.select("region", F.date_format("day", "yyyy-MM-dd").alias("day"))


def entity_rows(spark, d):
    c = table(spark, d, "customer")
    ids = F.when(F.col("c_custkey") % 8 == 0, F.array((F.col("c_custkey") % 50).cast("string"), F.lit("x"))).otherwise(F.array((F.col("c_custkey") % 50).cast("string")))
    return c.select(F.concat(F.lit("E"), "c_custkey").alias("entity_id"), (F.col("c_nationkey") % 10).cast("string").alias("mcc_code"), ids.alias("mmh_id"), F.concat((F.col("c_custkey") % 3 + 1).cast("string")).alias("region_code"))


def location_rows(spark, d):
    return spark.range(50).select(F.col("id").alias("old_loc_id"), (F.col("id") + F.when(F.col("id") % 5 == 0, 1).otherwise(0)).alias("merchant_market_hierarchy_id"), F.concat(F.lit("0"), F.col("id") % 2 + 1).alias("cleansed_business_region_code"))


FEATURE_SQL = CLEARING_SQL + """,
loc AS (SELECT range AS id, range + CASE WHEN range % 5 = 0 THEN 1 ELSE 0 END AS mmh, range % 2 + 1 AS region FROM range(50)),
ent AS (SELECT 'E' || c_custkey AS entity_id, c_custkey % 50 AS mmh, c_custkey % 3 + 1 AS region FROM customer),
txn AS (SELECT clr.*, ent.entity_id FROM clr JOIN loc ON clr.loc = loc.id AND CAST(clr.region AS INTEGER) = loc.region LEFT JOIN ent ON loc.mmh = ent.mmh AND loc.region = ent.region),
feat AS (
  SELECT entity_id, region, round(sum(CASE WHEN process_date >= '2024-01-21' THEN amt ELSE 0 END), 2) AS value_90, sum(CASE WHEN process_date >= '2024-01-21' THEN cnt ELSE 0 END) AS vol_90,
    round(max(amt) FILTER (process_date >= '2024-01-21') - min(amt) FILTER (process_date >= '2024-01-21'), 2) AS amt_range, count(DISTINCT product_cd) FILTER (process_date >= '2024-01-21') AS products, max(process_date) AS last_day,
    sum(cnt) AS matched, round(sum(amt) / sum(cnt), 3) AS avg_amt, max(process_date) FILTER (product_cd = 'MCP') AS comm, max(process_date) FILTER (acct IN ('8', '8C', '9', '9C')) AS ctrl, CAST(date_diff('day', CAST(max(process_date) AS DATE), DATE '2024-01-30') AS BIGINT) AS days_since
  FROM txn GROUP BY entity_id, region)
"""


def feature_rows(spark, d):
    return features.merchant_metrics(clearing_table(spark, d), location_rows(spark, d), entity_rows(spark, d), "2024-01-30", ["01", "2"], window=10)


def txn_features(spark, d):
    r = feature_rows(spark, d)
    return r.select(
        "entity_id", F.col("dw_merch_region_cd").alias("region"), F.round("total_txn_value_past_90", 2).alias("value_90"), F.col("total_txn_vol_past_90").cast("long").alias("vol_90"), F.round("txn_amt_range_past_90", 2).alias("amt_range"),
        F.col("distinct_product_cd_past_90").alias("products"), F.col("most_recent_txn_date").alias("last_day"), F.col("matched_trans_count").alias("matched"), F.round("avg_tran_amt", 3).alias("avg_amt"),
        F.col("recent_comm_hist_txn_dt").alias("comm"), F.col("recent_in_crntl_hist_txn_dt").alias("ctrl"), F.col("days_since_most_recent_txn").cast("long").alias("days_since"))


def feature_join(spark, d):
    e = entity_rows(spark, d)
    for c in "url region_name dba_name sic naics address_line1 city state_province country_cd postcode aggr_merch_name aggr_merch_id parent_aggr_merch_name parent_aggr_merch_id industry clearing_last_seen_date auth_last_seen_date zi_c_last_updated_date".split():
        e = e.withColumn(c, F.lit(None).cast("string"))
    inference = feature_rows(spark, d).withColumn("refreshed_date", F.lit("2024-01-30").cast("date")).withColumn("propensity_score", F.lit(0.5)).withColumn("propensity_score_label", F.lit("LOW"))
    s = features.merchant_summary(inference, e, category_rows(spark, d), "2024-02-15")
    return s.select("entity_id", "mcc_code", "mcc_group", "industry_classification_code", F.col("matched_trans_count").alias("matched"), "commercial_history", "in_control_history", "mmh_id", "card_acceptor")


def category_rows(spark, d):
    p = table(spark, d, "part").select((F.col("p_size") % 10).cast("string").alias("merchant_category_code"), F.col("p_brand").alias("merchant_mcc_group_name"), F.col("p_type").alias("classification_code"), F.when(F.col("p_partkey") % 2 == 0, 20).otherwise(10).alias("LEVEL_NUMBER"))
    return features.category_dim(p)


CATEGORY_SQL = "cat AS (SELECT CAST(p_size % 10 AS VARCHAR) AS mcc_code, min(p_brand) AS mcc_group_name, min(p_type) AS classification_code FROM part WHERE p_partkey % 2 = 0 GROUP BY 1)"


def price_quantiles(spark, d):
    return bins.exact_quantiles(table(spark, d, "customer"), "c_acctbal")


QUANTILE_SQL = """
ranked AS (SELECT c_acctbal AS v, row_number() OVER (ORDER BY c_acctbal) AS rn, count(*) OVER () AS n FROM customer WHERE c_acctbal IS NOT NULL),
qs AS (SELECT i, v FROM ranked JOIN (SELECT range AS i FROM range(101)) ON rn = greatest(1, (i * n + 99) // 100)),
bin AS (SELECT i - 1 AS bin_idx, CASE WHEN i = 1 THEN '-Infinity'::DOUBLE ELSE lag(v) OVER (ORDER BY i) END AS prev_hi, CASE WHEN i = 100 THEN 'Infinity'::DOUBLE ELSE v END AS hi FROM (SELECT * FROM qs WHERE i >= 1))
"""


def percentile_bins(spark, d):
    return bins.bin_table(price_quantiles(spark, d)).select(F.col("bin_idx").cast("long").alias("bin_idx"), *(F.when(F.abs(c) != float("inf"), F.col(c)).alias(c) for c in ("prev_hi", "hi")), F.round("pct_lower", 2).alias("pct_lower"))


def bin_score(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal", F.when(F.col("c_custkey") % 10 == 0, 0.0).otherwise(1.0).alias("spend"))
    return bins.score(rows, price_quantiles(spark, d), ["c_acctbal"], "spend").select("c_custkey", F.col("c_acctbal_percentile").alias("percentile"))


def propensity_label(spark, d):
    scored = bin_score(spark, d)
    return bins.propensity(scored, bins.logistic([2.0], -0.5), ["percentile"]).select("c_custkey", "propensity_score", "propensity_score_label")


def top_n_by_key(spark, d):
    item = table(spark, d, "lineitem").select("l_suppkey", "l_extendedprice", "l_orderkey", "l_partkey").distinct()
    return ledger.latest_version(item, ["l_suppkey"], "l_extendedprice", ["l_orderkey", "l_partkey"])


def id_explode(spark, d):
    return entity_rows(spark, d).select("entity_id", F.explode("mmh_id").alias("mmh_id"))


def normalize_text(spark, d):
    p = table(spark, d, "part")
    raw = F.concat(F.col("p_name"), F.lit("  &-"), F.col("p_brand"), F.lit("\t. "))
    return p.select("p_partkey", text.normalize_text(raw).alias("plain"), text.remove_special(raw).alias("kept"), text.normalize_city(raw).alias("city"))


def cleanse_name(spark, d):
    c = table(spark, d, "customer")
    end = F.element_at(F.array(*map(F.lit, [" Inc.", ".com", "Foods Co", "_LTD", " texaco", ", llc"])), (F.col("c_custkey") % 6 + 1).cast("int"))
    return c.select("c_custkey", text.cleanse_name(F.concat("c_name", end)).alias("name"))


POSTAL_FORMS = ["null", "12", "00000", "11111", "12345678901", "0001234", "12212", "12345-6789", "K1A 0B1"]


def postal_valid(spark, d):
    code = F.coalesce(F.try_element_at(F.array(*map(F.lit, POSTAL_FORMS)), (F.col("s_suppkey") % 12 + 1).cast("int")), F.col("s_suppkey").cast("string"))
    s = table(spark, d, "supplier").withColumn("code", code)
    return s.select("s_suppkey", text.valid_postal(F.col("code")).alias("valid"), text.postal_comparable(F.col("code"), F.when(F.col("s_suppkey") % 2 == 0, "usa").otherwise("CAN")).alias("comparable"))


def state_norm(spark, d):
    state = F.element_at(F.array(*map(F.lit, ["ca", " NY ", "Bavaria", "QC", "X1", ""])), (F.col("s_suppkey") % 6 + 1).cast("int"))
    s = table(spark, d, "supplier").withColumn("state", state)
    return s.select("s_suppkey", text.normalize_state(F.col("state"), F.when(F.col("s_suppkey") % 4 < 2, "USA").otherwise("CAN")).alias("norm_state"), text.state_full_form(F.col("state")).alias("full_form"))


def country_resolve(spark, d):
    n = table(spark, d, "nation")
    names = n.where("n_nationkey % 3 > 0").select(F.initcap("n_name").alias("country_name"), F.concat(F.lit("N"), "n_nationkey").alias("country_code_2alpha"))
    aliases = n.where("n_nationkey % 2 = 0").select(F.concat(F.lit("a"), "n_nationkey").alias("alias"), F.col("n_name").alias("country_name"))
    rows = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit(" A"), "n_nationkey")).otherwise(F.col("n_name")).alias("country"))
    return text.resolve_country(rows, "country", names, aliases).select("s_suppkey", "norm_country", "country_iso2")


def dba_split(spark, d):
    c = table(spark, d, "customer").withColumn("full", F.when(F.col("c_custkey") % 3 == 0, F.concat("c_name", F.lit(" DBA "), "c_mktsegment")).otherwise(F.concat("c_name", F.lit(" Goodbar"))))
    before, after = text.dba_parts(F.col("full"))
    return c.select("c_custkey", before.alias("before"), after.alias("after"))


def request_hash(spark, d):
    s = table(spark, d, "supplier")
    return s.select("s_suppkey", text.request_hash(F.col("s_name"), F.col("s_nationkey"), F.lit(None).cast("string"), F.concat(F.lit(" É"), "s_suppkey")).alias("request_hash"))


def entity_json(c: DataFrame) -> DataFrame:
    f = '{"Name":[{"value":"%s"}],"Address":[{"value":{"City":[{"value":"C%s"}],"Country":[{"value":"USA"}],"StateProvince":[{"value":"ca"}]}}],"SIC":[{"value":{"Type":[{"value":"SIC4"}],"Code":[{"lookupCode":"1"}]}},{"value":{"Type":[{"value":"SIC8"}],"Code":[{"lookupCode":"S%s"}]}}]}'
    return c.withColumn("json", F.format_string(f, "c_name", "c_nationkey", "c_custkey"))


def json_attrs(spark, d):
    rows = entity_json(table(spark, d, "customer")).select("c_custkey", *attributes.entity_attributes(F.col("json")))
    return rows.select("c_custkey", "matched_mmh_name", "matched_city", "matched_state", "matched_sic", "matched_dba_name")


def response_json(spark, d):
    """Customers as answers of a match service: even ones with two rules of two entities, those divisible by 5 without any."""
    c = entity_json(table(spark, d, "customer")).withColumn("uri", F.concat(F.lit("entities/E"), "c_custkey"))
    entity = F.concat(F.lit('{"uri":"'), F.col("uri"), F.lit('","attributes":'), F.col("json"), F.lit("}"))
    other = F.lit('{"uri":"entities/other","attributes":{}}')
    second = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit(',"r2":{"u2":'), (F.col("c_custkey") % 7 / 10).cast("string"), F.lit("}"))).otherwise("")
    objects = F.concat(F.lit('{"r1":['), entity, F.lit(","), other, F.lit('],"r2":['), other, F.lit("]}"))
    full = F.concat(F.lit('{"relevance":{"r1":{"u1":0.35}'), second, F.lit('},"object":'), objects, F.lit("}"))
    return c.select("c_custkey", F.when(F.col("c_custkey") % 5 == 0, "{}").otherwise(full).alias("answer"), F.concat(F.lit('{"entities":['), entity, F.lit(","), other, F.lit("]}")).alias("search"))


def match_response(spark, d):
    rows = response_json(spark, d).select("c_custkey", *attributes.match_response(F.col("answer"), F.col("c_custkey").cast("string"), F.lit(None)))
    return rows.select("supplier_id", "entity_id", "matched_mmh_name", "matched_city", "matched_sic", "matched_score", "matched_rule", "successful", "request_hash")


def search_response(spark, d):
    rows = response_json(spark, d).select("c_custkey", F.posexplode(attributes.search_results(F.col("search"))).alias("place", "entity"))
    return rows.select("c_custkey", "place", *attributes.search_entity(F.col("entity"))).select("c_custkey", "place", "entity_id", "matched_mmh_name", "matched_city", "matched_state")


def cluster_match_accepted(spark, d):
    """The matcher's own threshold: vectors and their opposites, of which none below 0.60 is a match."""
    rows, source = embedding_sources(spark, d)
    turned = rows.withColumn("in_emb", F.when(F.col("supplier_id").cast("long") % 2 == 0, F.transform("in_emb", lambda x: -x)).otherwise(F.col("in_emb")))
    return blocking.block_matches(turned, source).select("supplier_id", "entity_id", F.round("matched_score", 4).alias("matched_score"))


def best_rule(spark, d):
    relevance = F.create_map(
        F.lit("r1"), F.create_map(F.lit("u1"), F.col("s_suppkey") % 5 / 10.0, F.lit("u2"), F.lit(9.0)), F.lit("r2"), F.create_map(F.lit("u1"), F.col("s_suppkey") % 3 / 10.0), F.lit("r3"), F.create_map(F.lit("u1"), F.lit(0.1)))
    s = table(spark, d, "supplier").withColumn("best", attributes.best_rule(relevance))
    return s.select("s_suppkey", F.round("best.score", 2).alias("score"), F.col("best.rule").alias("rule"), attributes.entity_id(F.concat(F.lit("entities/"), "s_suppkey")).alias("entity_id"))


def name_similarity(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", F.round(similarity.name_similarity(F.col("p_name"), F.col("p_type"), F.col("p_brand")), 6).alias("similarity"))


def match_score(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 41 / 40.0).alias("n"), (F.col("o_custkey") % 11 / 10.0).alias("a"), (F.col("o_orderkey") % 2 == 0).alias("geo"), (F.col("o_custkey") % 3 == 0).alias("st"), (F.col("o_custkey") % 2 == 0).alias("broad"))
    return o.select("o_orderkey", F.round(matching.match_score(F.col("n"), F.col("a"), F.col("geo"), F.col("st"), F.col("broad")), 6).alias("score"))


def cascade_rows(spark, d):
    """Suppliers as requests and as entities under slightly other names; the nation is the country, the balance a postal code."""
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    s = s.withColumn("code", F.concat(F.lit("1"), F.lpad(F.col("s_suppkey").cast("string"), 4, "0")))
    rows = s.select(F.col("s_suppkey").alias("row_id"), F.when(F.col("s_suppkey") % 5 == 0, F.concat(F.lit("Shop DBA "), "s_name")).otherwise(F.col("s_name")).alias("norm_supplier_name"), F.concat(F.col("s_suppkey"), F.lit(" Main Street")).alias("norm_street_address"), F.when(F.col("s_suppkey") % 3 == 0, "").otherwise("Town").alias("norm_city"), F.col("code").alias("norm_postal_code"), F.col("n_name").alias("norm_country"), F.lit("").alias("full_form_state"))
    entities = s.where("s_suppkey % 7 > 0").select(F.concat(F.lit("E"), "s_suppkey").alias("entity_id"), F.concat("s_name", F.lit(" Inc")).alias("legal_name"), F.col("s_name").alias("dba_name"), F.concat(F.col("s_suppkey"), F.lit(" Main St")).alias("street_address"), F.lit("town").alias("city"), F.lit("").alias("state"), F.col("code").alias("postal_code"), F.col("n_name").alias("country"))
    return rows, entities


def rule_cascade(spark, d):
    return matching.cascade(*cascade_rows(spark, d)).select("row_id", "entity_id", F.round("matched_score", 6).alias("matched_score"), "matched_rule", "successful")


def address_similarity(spark, d):
    """Addresses of suppliers beside those of others, some with noise words on both sides or one."""
    s, k = table(spark, d, "supplier"), F.col("s_suppkey")
    a = F.concat(F.when(k % 3 == 0, "PO Box ").otherwise(""), k, F.lit(" Main  Street"), F.when(k % 4 == 0, " Unit 5").otherwise(""))
    b = F.when(k % 11 > 0, F.concat(F.when(k % 6 == 0, "po box ").otherwise(""), k * 7 % 100, F.lit(" main st."), F.when(k % 8 == 0, ", unit 9").otherwise("")))
    return s.select("s_suppkey", F.round(similarity.address_similarity(a, b), 6).alias("similarity"))


def hybrid_rows(spark, d):
    """The cascade's rows; every fourth has a fresh answer in the cache, the ones after them an old one."""
    rows, entities = cascade_rows(spark, d)
    rows = rows.withColumn("request_hash", F.concat(F.lit("h"), "row_id"))
    day = F.when(F.col("row_id") % 4 == 0, "2024-01-05").when(F.col("row_id") % 4 == 1, "2023-12-01")
    cache = rows.select("request_hash", F.concat(F.lit("C"), "row_id").alias("entity_id"), F.lit(0.9).alias("matched_score"), F.lit("cached").alias("matched_rule"), F.to_timestamp(day).alias("audit_ts")).where("audit_ts is not null")
    return matching.hybrid_match(rows, entities, cache, "2024-01-07")


def hybrid_match(spark, d):
    return hybrid_rows(spark, d)[0].select("row_id", "request_hash", "entity_id", F.round("matched_score", 6).alias("matched_score"), "matched_rule", "successful")


def hybrid_new_rows(spark, d):
    return hybrid_rows(spark, d)[1].select("request_hash", "entity_id", F.round("matched_score", 6).alias("matched_score"), "matched_rule")


def cached(spark, d):
    e = table(spark, d, "events")
    cache = e.select(F.col("user_id").cast("string").alias("request_hash"), F.concat(F.lit("E"), "event_id").alias("entity_id"), F.col("ts").alias("audit_ts"))
    requests = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("request_hash"))
    return matching.cache_lookup(requests, cache, "2024-01-30", 7)


def cache_lookup(spark, d):
    return cached(spark, d)[0].select("request_hash", "entity_id")


def cache_split(spark, d):
    return cached(spark, d)[1].select("request_hash")


def audit_antijoin(spark, d):
    rows = table(spark, d, "supplier").select(F.col("s_name").alias("supplier_name"), F.when(F.col("s_suppkey") % 5 > 0, F.lit("a")).alias("street_address"), F.col("s_nationkey").cast("string").alias("country"), "s_suppkey")
    return blocking.unaudited(rows, rows.where("s_suppkey % 2 = 0")).select("s_suppkey", "supplier_name")


def base62_id(spark, d):
    c = table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") * F.lit(7_919_000_003) - F.lit(7_919_000_003)).alias("n"))
    return c.select("c_custkey", scalar.base62_8(F.col("n")).alias("code"))


def cosine_pairs(spark, d):
    """The query set, every vector whose id is divisible by 100, beside all vectors."""
    e = table(spark, d, "embeddings")
    a, b = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("a_id"), F.col("embedding").alias("a")), e.select(F.col("vec_id").alias("b_id"), F.col("embedding").alias("b"))
    return blocking.all_cosines(a, b)


def embedding_sources(spark, d):
    e = table(spark, d, "embeddings")
    source = e.select(F.concat(F.lit("E"), "vec_id").alias("entity_id"), F.lit("legal").alias("legal_name"), F.lit("other").alias("merchant_name"), F.col("embedding").alias("ln_emb"), F.col("embedding").alias("mn_emb"), F.col("label").alias("legal_cluster_id"), ((F.col("label") + F.col("vec_id").cast("int") % 2) % 10).alias("merchant_cluster_id"))
    rows = e.select((-F.col("vec_id")).cast("string").alias("supplier_id"), F.transform("embedding", lambda x: -x).alias("in_emb"), F.col("label").alias("input_cluster_id"))
    return rows, source


def cluster_best_match(spark, d):
    out = blocking.block_matches(*embedding_sources(spark, d), -1.0)
    return out.select("supplier_id", F.col("entity_id"), F.round("matched_score", 4).alias("matched_score"), "best_match_name")


def kmeans_blocks(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("ln_emb"), F.col("embedding").alias("mn_emb"))
    return blocking.with_cluster(e, blocking.fit_clusters(e, k=10, iterations=10), "ln_emb", "cluster").select("vec_id", "cluster")


def upsert_by_key(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    keys = o.where("o_orderstatus = 'P'").select("o_custkey").distinct()
    new = o.join(keys, "o_custkey", "left_semi").where("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("N")).select(*o.columns)
    return tables.replaced(o, new, keys, ["o_custkey"])


def merge_tracker(spark, d):
    t = table(spark, d, "orders").groupBy(F.concat("o_orderpriority", F.lit(" ")).alias("file_id")).agg(F.count("*").alias("record_count")).withColumn("status", F.lit("IN-PROGRESS"))
    change = spark.createDataFrame([("1-URGENT", 7, "SUCCESS"), ("9-NEW", 1, "FAILED")], "file_id string, record_count long, status string")
    return tables.merged(t, change, "file_id", ["record_count", "status"])


def text_repair(spark, d):
    k = F.col("p_partkey")
    t = F.when(k % 5 == 0, None).when(k % 4 == 0, F.concat("p_name", F.lit("\tcaf\u00c3\u00a9"))).when(k % 4 == 1, F.concat("p_name", F.lit("\u221a\u00e2b")))
    t = t.when(k % 4 == 2, F.concat(F.lit("\x01 "), "p_name", F.lit("  x "))).otherwise(F.repeat(F.concat("p_name", F.lit(" ")), 20))
    return table(spark, d, "part").select("p_partkey", text.clean_text(t).alias("cleaned"), F.length(text.fix_encoding(t)).alias("n_fixed"))


def place_match(spark, d):
    k, code = F.col("c_custkey"), F.lpad(F.col("c_custkey").cast("string"), 5, "9")
    city = F.when(k % 3 == 0, F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit("  x"))).when(k % 3 == 1, "").otherwise(F.col("c_mktsegment"))
    other = F.when(k % 4 == 0, F.concat(code, F.lit("-1234"))).when(k % 4 == 1, F.concat(F.lit("A"), code)).when(k % 4 == 2, None).otherwise(F.concat(code, F.lit(" 77")))
    country = F.when(k % 2 == 0, "USA").otherwise("CAN")
    return table(spark, d, "customer").select("c_custkey", text.city_match(F.concat("c_mktsegment", F.lit(" X")), F.when(k % 3 == 2, F.concat(city, F.lit("\tx"))).otherwise(city)).alias("city"),
                                              text.postal_match(code, other, country).alias("postal"))


def supplier_normalized(spark, d):
    k = F.col("s_suppkey")
    rows = table(spark, d, "supplier").select(
        "s_suppkey", F.concat(F.lit(" "), "s_name", F.lit("\x02 Inc.")).alias("supplier_name"), F.concat(F.lit("1  Main"), k).alias("street_address"), F.when(k % 3 > 0, "Par  is").alias("city"),
        F.when(k % 2 == 0, "00000").otherwise(F.concat(F.lit("1-"), F.lpad(k.cast("string"), 4, "7"))).alias("postal_code"), F.when(k % 2 == 0, " ca").otherwise("Bavaria").alias("state"),
        F.when(k % 4 == 0, "USA").otherwise("DEU").alias("norm_country"), F.lit("").alias("country_iso2"))
    return text.normalize_rows(rows).select("s_suppkey", "norm_supplier_name", "norm_street_address", "norm_city", "norm_postal_code", "cleansed_supplier_name", "norm_state", "full_form_state")


def entity_request(spark, d):
    s = table(spark, d, "supplier")
    json = attributes.entity_request(F.when(F.col("s_suppkey") % 3 > 0, F.col("s_suppkey").cast("string")), F.col("s_name"), F.lit("1 Main"), F.lit(None).cast("string"), F.lit("CA"), F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string"))
    return s.select("s_suppkey", json.alias("request"))


def matched_suppliers(spark, d):
    """Every supplier's best part offer as its match: of equal scores the smallest entity id."""
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").alias("supplier_id"), "s_name")
    item = table(spark, d, "lineitem").where("l_suppkey % 4 > 0").select("l_suppkey", "l_partkey", "l_quantity")
    found = item.select(F.col("l_suppkey").alias("supplier_id"), F.format_string("E%08d", "l_partkey").alias("entity_id"), F.col("l_partkey").cast("string").alias("matched_mmhid"),
                        (F.col("l_partkey") % 10).cast("string").alias("matched_mmc_code"), (F.col("l_quantity").cast("double") / 50).alias("matched_score"))
    return rows, jobs.with_matches(rows, found)


def match_join(spark, d):
    return matched_suppliers(spark, d)[1].select("supplier_id", "entity_id", "is_matched", F.round("matched_score", 6).alias("matched_score"))


def summary_join(spark, d):
    part = table(spark, d, "part")
    cats = part.where("p_size % 10 > 2").select((F.col("p_size") % 10).cast("string").alias("mcc_code"), F.concat(F.lit("g"), F.col("p_size") % 10).alias("mcc_group"), F.lit("i").alias("industry_classification_code"))
    ids = F.concat_ws(",", F.col("p_partkey").cast("string"), F.concat(F.lit("x"), "p_partkey"))
    summary = part.where("p_partkey % 3 > 0").select(*(F.concat("p_brand", F.lit(f"-{c}")).alias(c) for c in jobs.FROM_SUMMARY), ids.alias("mmh_id"))
    out = jobs.with_summary(matched_suppliers(spark, d)[1], cats, summary)
    return out.select("supplier_id", "mcc_code", "mcc_group", "mmh_id", "card_acceptor", "commercial_recency", "confidence", "cleansed_city_name")


MATCHED_SQL = """m AS (SELECT l_suppkey, l_partkey, CAST(l_quantity AS DOUBLE) / 50 AS s, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_partkey) AS rn FROM lineitem WHERE l_suppkey % 4 > 0),
j AS (SELECT s_suppkey, l_partkey, s FROM supplier LEFT JOIN m ON s_suppkey = l_suppkey AND rn = 1)"""


def latest_days(spark, d):
    done, regions = clearing_table(spark, d), ["01", "02", "03"]
    each = [clearing.latest_day(done, r).select(F.lit(r).alias("region"), "latest") for r in regions]
    return tables.union_with_missing(*each, clearing.latest_day(done)).select("region", F.col("latest").cast("string").alias("latest"))


def union_columns(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    c = table(spark, d, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"))
    return tables.union_with_missing(s, c).select("name", "nation", "segment")


def quantile_ranks(spark, d):
    """The approximate quantiles the jobs take, each beside whether its rank is within one and the stated error of the wanted one."""
    rows = table(spark, d, "customer").select("c_acctbal")
    q = bins.quantiles(rows, ["c_acctbal"]).select(F.posexplode("q").alias("i", "v"))
    counts = rows.crossJoin(F.broadcast(q)).groupBy("i").agg(F.count_if(F.col("c_acctbal") < F.col("v")).alias("below"), F.count_if(F.col("c_acctbal") <= F.col("v")).alias("upto"), F.count("c_acctbal").alias("n"))
    at, free = F.col("i") * F.col("n") / 100, 1 + F.col("n") / 10_000
    return counts.select("i", ((F.col("below") <= at + free) & (F.col("upto") >= at - free)).alias("near"), "n")


def order_folder(spark, d):
    """Orders as a folder of Parquet, partitioned by year."""
    path = tables.work_folder(spark, "orders")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("double").alias("o_totalprice"), F.year("o_orderdate").alias("o_year"))
    tables.overwrite_partitions(o, path, ["o_year"])
    return path


def table_scan(spark, d):
    return tables.scan(spark, order_folder(spark, d), schema="o_orderkey long, o_totalprice double, o_year int")


def folder_partitions(spark, d):
    return tables.partitions_of(tables.scan(spark, order_folder(spark, d)), ["o_year"])


def folder_manifest(spark, d):
    """Rows of each partition by the manifest of its files, which reads no column."""
    m = tables.file_manifest(tables.scan(spark, order_folder(spark, d)), ["o_year"])
    return m.where("bytes > 0").groupBy("o_year").agg(F.sum("n_rows").alias("n_rows"), F.bool_and(F.col("path").contains(F.concat(F.lit("o_year="), "o_year"))).alias("in_place"))


def csv_scan(spark, d):
    """Orders as CSV lines, some with a letter for a number, some cut short; what can be read, and the bad lines as they stand."""
    path, k = tables.work_folder(spark, "lines"), F.col("o_orderkey")
    fields = [k.cast("string"), F.when(k % 50 == 0, "x").otherwise(F.col("o_custkey").cast("string")), F.col("o_totalprice").cast("decimal(15,2)").cast("string"), F.col("o_orderstatus")]
    table(spark, d, "orders").select(F.when(k % 77 == 0, fields[0]).otherwise(F.concat_ws(",", *fields)).alias("value")).write.mode("overwrite").text(path)
    good, bad = tables.csv_rows(tables.scan_csv(spark, path, "o_orderkey long, o_custkey long, o_totalprice double, o_orderstatus string", header=False))
    return good.unionByName(bad, allowMissingColumns=True)


def quantile_values(spark, d):
    """Exact quantiles of order values and, negated, of keys, from one state a year of orders, stored apart and merged."""
    o = table(spark, d, "orders").select(F.col("o_totalprice").cast("double").alias("price"), (F.col("o_custkey") % 1000).alias("key"), F.year("o_orderdate").alias("year"))
    states = [bins.value_counts(o.where(F.col("year") % 4 == k), ["price"], ["key"]) for k in range(4)]
    q = bins.quantiles_of(bins.merged_counts(*states))
    return q.select("metric", F.posexplode("q").alias("i", "v")).select("metric", "i", F.round("v", 4).alias("v"))


def quantile_digits(spark, d):
    """The same of values rounded to three significant digits, the bounded state."""
    o = table(spark, d, "orders").select(F.col("o_totalprice").cast("double").alias("price"))
    return bins.quantiles_of(bins.value_counts(o, ["price"], digits=3)).select(F.posexplode("q").alias("i", "v")).select("i", F.round("v", 4).alias("v"))


QUERIES = {f.__name__: f for f in (
    ap_enrich, ap_contrib, ap_totals, ap_due_date, quarter_label, recency_flags, latest_version, period_expand, invoice_rollup, po_rollup, payment_rollup, final_metrics, merchant_rollup, clearing_union_agg, clearing_missing_days,
    txn_features, feature_join, percentile_bins, bin_score, propensity_label, top_n_by_key, id_explode, normalize_text, cleanse_name, postal_valid, state_norm, country_resolve, dba_split, request_hash, json_attrs, match_response, search_response, cluster_match_accepted, best_rule,
    name_similarity, match_score, rule_cascade, cache_lookup, cache_split, audit_antijoin, base62_id, cosine_pairs, cluster_best_match, kmeans_blocks, upsert_by_key, merge_tracker, text_repair, place_match, supplier_normalized, entity_request, match_join, summary_join, latest_days, union_columns, quantile_ranks, quantile_values, quantile_digits, table_scan, folder_partitions, folder_manifest, csv_scan, address_similarity, hybrid_match, hybrid_new_rows)}
QUERIES |= {"confidence_tier": confidence, "category_dim": category_rows}

#: The 15 rules over all pairs of a country. Own states are empty, so rules that ask for the state never hold and two states agree.
CASCADE_SQL = r"""
WITH RECURSIVE s AS (SELECT s_suppkey AS k, s_name, n_name AS country, '1' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS code FROM supplier JOIN nation ON s_nationkey = n_nationkey),
own AS (SELECT k, CASE WHEN k % 5 = 0 THEN 'Shop DBA ' || s_name ELSE s_name END AS name, country, code, k % 3 > 0 AS town, k || ' main street' AS street FROM s),
ent AS (SELECT k AS e, country AS e_country, code AS e_code, k || ' main st' AS e_street, lower(s_name || ' Inc') AS legal, lower(s_name) AS dba FROM s WHERE k % 7 > 0),
tried AS (SELECT k, 0 AS variant, '' AS suffix, name AS t FROM own UNION ALL SELECT k, 1, '_DBA_Part1', 'Shop' FROM own WHERE k % 5 = 0
  UNION ALL SELECT k, 2, '_DBA_Part2', name[10:] FROM own WHERE k % 5 = 0 UNION ALL SELECT k, 3, '_CleansedName', lower(name) FROM own),
plain AS (SELECT DISTINCT x, list_aggregate(list_sort(string_split(trim(regexp_replace(regexp_replace(x, '[^a-z0-9\s]', '', 'g'), '\s+', ' ', 'g')), ' ')), 'string_agg', ' ') AS y
  FROM (SELECT lower(t) AS x FROM tried UNION SELECT legal FROM ent UNION SELECT dba FROM ent)),
pair AS (SELECT own.k, e, town, town OR starts_with(e_code, code) AS geo, starts_with(e_code, code) AS postal, street, e_street, legal, dba FROM own JOIN ent ON country = e_country),
tok AS (SELECT DISTINCT street, e_street, list_aggregate(list_sort(list_filter(string_split(street, ' '), lambda x: list_contains(string_split(e_street, ' '), x))), 'string_agg', ' ') AS both_,
  list_aggregate(list_sort(list_filter(string_split(street, ' '), lambda x: NOT list_contains(string_split(e_street, ' '), x))), 'string_agg', ' ') AS one,
  list_aggregate(list_sort(list_filter(string_split(e_street, ' '), lambda x: NOT list_contains(string_split(street, ' '), x))), 'string_agg', ' ') AS two FROM pair),
ends AS (SELECT street, e_street, CASE WHEN length(street) <= length(e_street) THEN street ELSE e_street END AS a, CASE WHEN length(street) <= length(e_street) THEN e_street ELSE street END AS b FROM tok
  UNION SELECT street, e_street, e_street, street FROM tok WHERE length(street) = length(e_street)),
slide AS (SELECT street, e_street, a, b[greatest(i.range, 0) + 1 : least(i.range + length(a), length(b))] AS w FROM ends, LATERAL (SELECT range FROM range(1 - length(a), length(b))) AS i),
need AS (SELECT a, w AS b FROM slide UNION SELECT both_ || ' ' || one, both_ || ' ' || two FROM tok
  UNION SELECT p.y, q.y FROM tried JOIN pair USING (k) JOIN plain p ON p.x = lower(t) JOIN plain q ON q.x = legal OR q.x = dba),
d AS (SELECT a, b, 0 AS j, list_transform(range(length(a) + 1), lambda x: 0) AS row FROM need
  UNION ALL SELECT a, b, j + 1, list_reduce(range(1, length(a) + 1), lambda acc, i: list_append(acc, CASE WHEN a[i] = b[j + 1] THEN row[i] + 1 ELSE greatest(row[i + 1], acc[len(acc)]) END), [CAST(0 AS BIGINT)]) FROM d WHERE j < length(b)),
lcs AS (SELECT a, b, 2.0::DOUBLE * row[len(row)] / (length(a) + length(b)) AS ratio FROM d WHERE j = length(b)),
addr AS (SELECT tok.street, tok.e_street, greatest(max(l.ratio), max(f.ratio), max(2.0::DOUBLE * length(both_) / (2 * length(both_) + 1 + least(length(one), length(two))))) AS address
  FROM tok JOIN slide USING (street, e_street) JOIN lcs l ON l.a = slide.a AND l.b = w JOIN lcs f ON f.a = both_ || ' ' || one AND f.b = both_ || ' ' || two GROUP BY 1, 2),
sim AS (SELECT pair.*, variant, suffix, t, lower(t) AS n, x.ratio AS rl, y.ratio AS rd, greatest(x.ratio, y.ratio) AS r, address AS ad FROM pair JOIN tried USING (k) JOIN addr USING (street, e_street)
  JOIN plain p ON p.x = lower(t) JOIN plain q ON q.x = legal JOIN plain z ON z.x = dba JOIN lcs x ON x.a = p.y AND x.b = q.y JOIN lcs y ON y.a = p.y AND y.b = z.y),
scored AS (SELECT *, (r - 0.9) / (1.0 - 0.9) AS bn, (r - 0.8) / (1.0 - 0.8) AS bp, (ad - 0.8) / (1.0 - 0.8) AS ba FROM sim),
narrow AS (SELECT *, CAST(CASE WHEN r >= 0.9 AND ad >= 0.8 AND geo THEN least(0.85 + 0.05 * bn + 0.03 * ba, 0.99) WHEN r >= 0.9 AND geo THEN least(0.80 + 0.05 * bn, 0.90) WHEN r >= 0.8 AND ad >= 0.8 AND geo THEN least(0.80 + 0.10 * bp, 0.90)
  WHEN r >= 0.8 AND geo THEN least(0.75 + 0.15 * bp, 0.88) WHEN r >= 0.9 THEN least(0.80 + 0.10 * bn, 0.85) WHEN r >= 0.8 THEN least(0.65 + 0.15 * bp, 0.78) ELSE 0 END AS DOUBLE) AS low FROM scored),
broad AS (SELECT *, CASE WHEN r >= 0.8 THEN low ELSE r END AS high,
  list_transform([legal, dba], lambda o: len(list_filter(string_split(trim(regexp_replace(regexp_replace(n, '[^a-z0-9\s]', '', 'g'), '\s+', ' ', 'g')), ' '), lambda w: NOT list_contains(string_split(trim(regexp_replace(regexp_replace(o, '[^a-z0-9\s]', '', 'g'), '\s+', ' ', 'g')), ' '), w))) = 0) AS words,
  len(list_filter(list_concat(string_split(legal, ' '), string_split(dba, ' ')), lambda w: starts_with(w, n))) > 0 AS prefix FROM narrow),
hits AS (SELECT k, e, variant, suffix, u.rule, u.score FROM broad, LATERAL (VALUES
  (1, low, (rl >= 0.8 OR rd >= 0.8) AND town AND postal AND ad >= 0.8, 0.80), (4, low, (rl >= 0.8 OR n = dba) AND town, 0.75), (5, low, rl >= 0.8 AND town, 0.75), (7, low, (rl >= 0.8 OR rd >= 0.8) AND postal, 0.75),
  (8, low, rd >= 0.8 AND postal, 0.50), (9, low, ad >= 0.8 AND town, 0.50), (10, high, n = legal OR n = dba, 0.70), (11, high, starts_with(dba, n), 0.75), (12, high, rl >= 0.8 OR rd >= 0.8, 0.0),
  (13, high, words[2], 0.0), (14, high, words[1], 0.0), (15, high, prefix, 0.0)) AS u(rule, score, holds, least_) WHERE u.holds AND u.score > 0 AND u.score >= u.least_),
best AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY rule, variant, score DESC, 'E' || e) AS rn FROM hits)
SELECT own.k AS row_id, 'E' || e AS entity_id, round(coalesce(score, 0), 6) AS matched_score, coalesce('Filter_Rule' || rule || suffix, 'no_match') AS matched_rule, CASE WHEN e IS NULL THEN 'N' ELSE 'Y' END AS successful
FROM own LEFT JOIN best ON own.k = best.k AND rn = 1
"""

#: Token-set and sliding ratio of plain addresses, without the first of each noise word that stands in both.
ADDRESS_SQL = r"""
WITH RECURSIVE r AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 = 0 THEN 'po box ' ELSE '' END || s_suppkey || ' main street' || CASE WHEN s_suppkey % 4 = 0 THEN ' unit 5' ELSE '' END AS a,
  CASE WHEN s_suppkey % 6 = 0 THEN 'po box ' ELSE '' END || (s_suppkey * 7 % 100) || ' main st' || CASE WHEN s_suppkey % 8 = 0 THEN ' unit 9' ELSE '' END AS b FROM supplier WHERE s_suppkey % 11 > 0),
n AS (SELECT k, CASE WHEN k % 6 = 0 THEN a[8:] ELSE a END AS a, CASE WHEN k % 6 = 0 THEN b[8:] ELSE b END AS b FROM r),
p AS (SELECT k, CASE WHEN k % 8 = 0 THEN replace(a, 'unit ', '') ELSE a END AS x, CASE WHEN k % 8 = 0 THEN replace(b, 'unit ', '') ELSE b END AS y FROM n),
t AS (SELECT *, list_distinct(string_split(x, ' ')) AS u, list_distinct(string_split(y, ' ')) AS v FROM p),
tok AS (SELECT k, x, y, list_aggregate(list_sort(list_filter(u, lambda w: list_contains(v, w))), 'string_agg', ' ') AS s, list_aggregate(list_sort(list_filter(u, lambda w: NOT list_contains(v, w))), 'string_agg', ' ') AS one, list_aggregate(list_sort(list_filter(v, lambda w: NOT list_contains(u, w))), 'string_agg', ' ') AS two FROM t),
ends AS (SELECT k, CASE WHEN length(x) <= length(y) THEN x ELSE y END AS a, CASE WHEN length(x) <= length(y) THEN y ELSE x END AS b FROM tok UNION SELECT k, y, x FROM tok WHERE length(x) = length(y)),
slide AS (SELECT k, a, b[greatest(i.range, 0) + 1 : least(i.range + length(a), length(b))] AS b FROM ends, LATERAL (SELECT range FROM range(1 - length(a), length(b))) AS i),
need AS (SELECT k, a, b FROM slide UNION SELECT k, s || ' ' || one, s || ' ' || two FROM tok WHERE one IS NOT NULL AND two IS NOT NULL),
d AS (SELECT k, a, b, 0 AS j, list_transform(range(length(a) + 1), lambda x: 0) AS row FROM need
  UNION ALL SELECT k, a, b, j + 1, list_reduce(range(1, length(a) + 1), lambda acc, i: list_append(acc, CASE WHEN a[i] = b[j + 1] THEN row[i] + 1 ELSE greatest(row[i + 1], acc[len(acc)]) END), [CAST(0 AS BIGINT)]) FROM d WHERE j < length(b)),
best AS (SELECT k, max(2.0::DOUBLE * row[len(row)] / (length(a) + length(b))) AS ratio FROM d WHERE j = length(b) GROUP BY k)
SELECT s_suppkey, CASE WHEN s_suppkey % 11 = 0 THEN 0.0 WHEN s IS NOT NULL AND (one IS NULL OR two IS NULL) THEN 1.0 ELSE round(greatest(ratio, coalesce(2.0::DOUBLE * length(s) / (2 * length(s) + 1 + least(length(one), length(two))), 0)), 6) END::DOUBLE AS similarity
FROM supplier LEFT JOIN tok ON tok.k = s_suppkey LEFT JOIN best ON best.k = s_suppkey
"""

SQL = {
    "ap_enrich": f"WITH {PAYABLE_SQL} SELECT supplier_id, m AS payment_method, days AS payment_term_days, mapped AS mapped_payment_method, n_inv AS total_number_of_invoices FROM c",
    "ap_contrib": f"""WITH {PAYABLE_SQL} SELECT supplier_id, m AS payment_method, CASE WHEN n <> 0 THEN round(CAST(spend AS DOUBLE) / n, 2) END AS average_ticket, CAST(spend AS DOUBLE) AS total_spend, CAST(card AS DOUBLE) AS total_spent_by_card,
      CAST(eft AS DOUBLE) AS total_spent_by_eft, CAST(cheque AS DOUBLE) AS total_spent_by_cheque, CAST(ach AS DOUBLE) AS total_spent_by_ach, CAST(other AS DOUBLE) AS total_spent_by_other FROM c""",
    "ap_totals": f"""WITH {PAYABLE_SQL} SELECT supplier_id, m AS payment_method, CAST(sum(n) OVER () AS DOUBLE) AS all_suppliers_total_number_of_payment, CAST(sum(n_inv) OVER () AS DOUBLE) AS all_suppliers_total_number_of_invoices,
      CAST(sum(spend) OVER () AS DOUBLE) AS all_suppliers_total_spend, CAST(sum(card) OVER () AS DOUBLE) AS all_supplier_total_spent_by_card, CAST(sum(eft) OVER () AS DOUBLE) AS all_supplier_total_spent_by_eft,
      CAST(sum(cheque) OVER () AS DOUBLE) AS all_supplier_total_spent_by_cheque, CAST(sum(ach) OVER () AS DOUBLE) AS all_supplier_total_spent_by_ach, CAST(sum(other) OVER () AS DOUBLE) AS all_supplier_total_spent_by_other,
      CAST(sum(CASE WHEN mapped = 'card' THEN 1 ELSE 0 END) OVER () AS DOUBLE) AS all_suppliers_total_card_accepting_suppliers, CAST(count(*) OVER () AS DOUBLE) AS all_suppliers_total_number_of_suppliers FROM c""",
    "ap_due_date": f"WITH {PAYABLE_SQL} SELECT supplier_id, m AS payment_method, strftime(CAST(ts AS DATE) + days, '%Y-%m-%d') AS next_payment_date FROM c",
    "confidence_tier": """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'Low' WHEN s >= 0.75 THEN 'High' WHEN s >= 0.70 THEN 'Medium' ELSE 'Low' END AS confidence,
      CASE WHEN o_orderkey % 11 = 0 THEN 'LOW' WHEN s > 0.7 THEN 'HIGH' WHEN s > 0.6 THEN 'MEDIUM' ELSE 'LOW' END AS propensity FROM (SELECT o_orderkey, CAST(o_orderkey % 100 AS DOUBLE) / 100 AS s FROM orders)""",
    "quarter_label": "SELECT year(o_orderdate) || '_' || quarter(o_orderdate) AS quarter, count(*) AS n FROM orders GROUP BY 1",
    "recency_flags": """WITH r AS (SELECT c_custkey, date_trunc('month', max(o_orderdate)) AS a, date_trunc('month', max(o_orderdate) FILTER (o_orderstatus = 'P')) AS o FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1)
      SELECT c_custkey, date_diff('month', CAST(a AS DATE), DATE '2001-11-01') AS recency, CASE WHEN a IS NULL THEN NULL WHEN o IS NOT NULL THEN 'YES' ELSE 'NO' END AS history, CASE WHEN a IS NULL THEN NULL WHEN c_custkey % 3 > 0 THEN 'YES' ELSE 'NO' END AS acceptor FROM r""",
    "latest_version": "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1",
    "period_expand": "SELECT date_period, s_suppkey, s_name FROM supplier, (VALUES ('monthly'), ('quarterly'), ('yearly')) AS p(date_period)",
    "invoice_rollup": f"WITH {LEDGER_SQL} SELECT * FROM inv", "po_rollup": f"WITH {LEDGER_SQL} SELECT * FROM po", "payment_rollup": f"WITH {LEDGER_SQL} SELECT * FROM pay", "final_metrics": f"WITH {LEDGER_SQL} SELECT * FROM fin",
    "merchant_rollup": f"""WITH {LEDGER_SQL} SELECT merchant_id, date_period, CAST(sum(n_paid + n_open) AS BIGINT) AS all_suppliers_total_number_of_payments, count(DISTINCT supplier_id) AS all_suppliers_total_number_of_suppliers,
      CAST(sum(n_inv) AS BIGINT) AS all_suppliers_total_number_of_invoices, count(DISTINCT CASE WHEN accepts > 0 THEN supplier_id END) AS all_suppliers_card_accepting_suppliers FROM fin GROUP BY ALL""",
    "clearing_union_agg": f"WITH {CLEARING_SQL} SELECT loc, acct, issuer, source_type, product_cd, process_date, region, cnt, round(amt, 2) AS amt FROM clr",
    "clearing_missing_days": f"""WITH {CLEARING_SQL}, last AS (SELECT region, max(CAST(process_date AS DATE)) AS d FROM clr WHERE process_date < '2024-01-20' OR region <> '01' GROUP BY 1)
      SELECT r.region, strftime(unnest(generate_series(coalesce(last.d + 1, DATE '2024-01-28'), DATE '2024-02-02', INTERVAL 1 DAY)), '%Y-%m-%d') AS day FROM (VALUES ('01'), ('02'), ('03')) AS r(region) LEFT JOIN last USING (region)""",
    "txn_features": f"WITH {FEATURE_SQL} SELECT entity_id, region, value_90, CAST(vol_90 AS BIGINT) AS vol_90, amt_range, products, last_day, CAST(matched AS BIGINT) AS matched, avg_amt, comm, ctrl, days_since FROM feat",
    "feature_join": f"""WITH {FEATURE_SQL}, {CATEGORY_SQL}, e AS (SELECT 'E' || c_custkey AS entity_id, CAST(c_nationkey % 10 AS VARCHAR) AS mcc_code, c_custkey % 50 || CASE WHEN c_custkey % 8 = 0 THEN ',x' ELSE '' END AS mmh_id, c_custkey % 3 + 1 AS region FROM customer)
      SELECT e.entity_id, e.mcc_code, cat.mcc_group_name AS mcc_group, cat.classification_code AS industry_classification_code, CAST(f.matched AS BIGINT) AS matched, CASE WHEN f.last_day IS NULL THEN NULL WHEN f.comm IS NOT NULL THEN 'YES' ELSE 'NO' END AS commercial_history,
        CASE WHEN f.last_day IS NULL THEN NULL WHEN f.ctrl IS NOT NULL THEN 'YES' ELSE 'NO' END AS in_control_history, e.mmh_id, CASE WHEN f.last_day IS NULL THEN NULL ELSE 'YES' END AS card_acceptor
      FROM e LEFT JOIN feat f ON f.entity_id = e.entity_id AND CAST(f.region AS INTEGER) = e.region LEFT JOIN cat ON cat.mcc_code = e.mcc_code""",
    "percentile_bins": f"WITH {QUANTILE_SQL} SELECT bin_idx, CASE WHEN NOT isinf(prev_hi) THEN prev_hi END AS prev_hi, CASE WHEN NOT isinf(hi) THEN hi END AS hi, round(CAST(bin_idx AS DOUBLE) / 100, 2) AS pct_lower FROM bin",
    "bin_score": f"WITH {QUANTILE_SQL} SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 0.0 ELSE CAST(round(CAST(2 * bin_idx + 1 AS DECIMAL(10,3)) / 200, 3) AS DECIMAL(10,3))::DECIMAL(10,2)::DOUBLE END AS percentile FROM customer JOIN bin ON c_acctbal > prev_hi AND c_acctbal <= hi",
    "propensity_label": f"""WITH {QUANTILE_SQL}, p AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 0.0 ELSE CAST(floor((2 * bin_idx + 2) / 2) AS DOUBLE) / 100 END AS x FROM customer JOIN bin ON c_acctbal > prev_hi AND c_acctbal <= hi), s AS (SELECT c_custkey, round(1 / (1 + exp(-(2.0 * x - 0.5))), 2) AS y FROM p)
      SELECT c_custkey, CAST(y AS DOUBLE) AS propensity_score, CASE WHEN y > 0.7 THEN 'HIGH' WHEN y > 0.6 THEN 'MEDIUM' ELSE 'LOW' END AS propensity_score_label FROM s""",
    "category_dim": f"WITH {CATEGORY_SQL} SELECT * FROM cat",
    "top_n_by_key": "SELECT l_suppkey, l_extendedprice, l_orderkey, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey DESC, l_partkey DESC) AS rn FROM (SELECT DISTINCT l_suppkey, l_extendedprice, l_orderkey, l_partkey FROM lineitem)) WHERE rn = 1",
    "id_explode": "SELECT 'E' || c_custkey AS entity_id, unnest(CASE WHEN c_custkey % 8 = 0 THEN [CAST(c_custkey % 50 AS VARCHAR), 'x'] ELSE [CAST(c_custkey % 50 AS VARCHAR)] END) AS mmh_id FROM customer",
    "normalize_text": r"""WITH r AS (SELECT p_partkey, p_name || '  &-' || p_brand || chr(9) || '. ' AS t FROM part)
      SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(t), '[^a-z0-9\s]', '', 'g'), '\s+', ' ', 'g')) AS plain, trim(regexp_replace(regexp_replace(t, '[^a-zA-Z0-9\s]', '', 'g'), '\s+', ' ', 'g')) AS kept, trim(regexp_replace(lower(t), '\s+', ' ', 'g')) AS city FROM r""",
    "cleanse_name": r"""WITH r AS (SELECT c_custkey, c_name || ([' Inc.', '.com', 'Foods Co', '_LTD', ' texaco', ', llc'])[c_custkey % 6 + 1] AS t FROM customer),
      a AS (SELECT c_custkey, trim(regexp_replace(lower(regexp_replace(t, '([a-z])([A-Z])', '\1 \2', 'g')), '\.(com|org|net|io|co|gov|edu|biz|info|us|uk|ca)$', '')) AS t FROM r),
      b AS (SELECT c_custkey, trim(regexp_replace(t, '(?:inc|inc\.|corporation|corp|corp\.|llc|l\.l\.c\.|co|co\.|company|limited|ltd|ltd\.)$', '')) AS t FROM a), c AS (SELECT c_custkey, trim(regexp_replace(regexp_replace(t, '[-_.,]', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM b)
      SELECT c_custkey, regexp_replace(regexp_replace(t, '([a-zA-Z])(\d)', '\1 \2', 'g'), '(\d)([a-zA-Z])', '\1 \2', 'g') AS name FROM c""",
    "postal_valid": r"""WITH r AS (SELECT s_suppkey, coalesce((['null', '12', '00000', '11111', '12345678901', '0001234', '12212', '12345-6789', 'K1A 0B1'])[s_suppkey % 12 + 1], CAST(s_suppkey AS VARCHAR)) AS c FROM supplier), q AS (SELECT *, regexp_replace(c, '\D', '', 'g') AS dg FROM r)
      SELECT s_suppkey, NOT (lower(c) IN ('null', 'none', 'n/a', 'na', '-') OR length(c) < 3 OR c IN ('12212', '90021', '852', '853') OR regexp_full_match(dg, '0+') OR (regexp_full_match(c, '\d+') AND replace(c, c[1], '') = '') OR regexp_full_match(c, '\d{11,}')
        OR (length(dg) > 6 AND starts_with(dg, '000'))) AS valid, CASE WHEN s_suppkey % 2 = 0 THEN dg[1:5] ELSE regexp_replace(upper(c), '[\s.\-]', '', 'g') END AS comparable FROM q""",
    "state_norm": """WITH r AS (SELECT s_suppkey, (['ca', ' NY ', 'Bavaria', 'QC', 'X1', ''])[s_suppkey % 6 + 1] AS t, s_suppkey % 4 < 2 AS usa FROM supplier)
      SELECT s_suppkey, CASE WHEN regexp_full_match(upper(trim(t)), '[A-Z]{2}') THEN CASE WHEN usa THEN 'USA-' ELSE '' END || upper(trim(t)) ELSE trim(t) END AS norm_state,
        coalesce(map {'CA': 'CALIFORNIA', 'NY': 'NEW YORK', 'QC': 'QUEBEC'}[upper(trim(t))], trim(t)) AS full_form FROM r""",
    "country_resolve": """WITH r AS (SELECT s_suppkey, s_suppkey % 2 = 0 AS al, n_nationkey AS k, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey), q AS (SELECT *, CASE WHEN al AND k % 2 = 0 THEN n_name WHEN al THEN 'A' || k ELSE n_name END AS c FROM r)
      SELECT s_suppkey, c AS norm_country, CASE WHEN c = n_name AND k % 3 > 0 THEN 'N' || k ELSE '' END AS country_iso2 FROM q""",
    "dba_split": "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE c_name || ' Goo' END AS before, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE 'r' END AS after FROM customer",
    "request_hash": "SELECT s_suppkey, sha256(lower(trim(s_name)) || chr(31) || s_nationkey || chr(31) || 'none' || chr(31) || 'é' || s_suppkey) AS request_hash FROM supplier",
    "json_attrs": "SELECT c_custkey, c_name AS matched_mmh_name, 'C' || c_nationkey AS matched_city, 'USA-CA' AS matched_state, 'S' || c_custkey AS matched_sic, '' AS matched_dba_name FROM customer",
    "match_response": """WITH r AS (SELECT *, c_custkey % 5 = 0 AS gone, c_custkey % 2 = 0 AND c_custkey % 7 > 3 AS second FROM customer)
      SELECT CAST(c_custkey AS VARCHAR) AS supplier_id, CASE WHEN gone THEN '' WHEN second THEN 'other' ELSE 'E' || c_custkey END AS entity_id, CASE WHEN gone OR second THEN '' ELSE c_name END AS matched_mmh_name,
        CASE WHEN gone OR second THEN '' ELSE 'C' || c_nationkey END AS matched_city, CASE WHEN gone OR second THEN '' ELSE 'S' || c_custkey END AS matched_sic, CASE WHEN gone THEN 0.0 WHEN second THEN CAST(c_custkey % 7 AS DOUBLE) / 10 ELSE 0.35 END::DOUBLE AS matched_score,
        CASE WHEN gone THEN '' WHEN second THEN 'r2' ELSE 'r1' END AS matched_rule, CASE WHEN gone THEN 'N' ELSE 'Y' END AS successful, '' AS request_hash FROM r""",
    "search_response": """SELECT c_custkey, CAST(0 AS INTEGER) AS place, 'E' || c_custkey AS entity_id, c_name AS matched_mmh_name, 'C' || c_nationkey AS matched_city, 'USA-CA' AS matched_state FROM customer
      UNION ALL SELECT c_custkey, 1, 'other', '', '', '' FROM customer""",
    "cluster_match_accepted": """WITH p AS (SELECT a.vec_id AS i, b.vec_id AS j, (CASE WHEN a.vec_id % 2 = 0 THEN 1 ELSE -1 END) * list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s FROM embeddings a JOIN embeddings b ON a.label = b.label OR a.label = (b.label + b.vec_id % 2) % 10)
      SELECT CAST(-i AS VARCHAR) AS supplier_id, 'E' || j AS entity_id, round(s, 4) AS matched_score FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY s DESC, 'E' || j) AS rn FROM p WHERE s >= 0.60) WHERE rn = 1""",
    "best_rule": """SELECT s_suppkey, CAST(greatest(s_suppkey % 5, s_suppkey % 3, 1) AS DOUBLE) / 10 AS score, CASE WHEN s_suppkey % 5 >= greatest(s_suppkey % 3, 1) THEN 'r1' WHEN s_suppkey % 3 >= 1 THEN 'r2' ELSE 'r3' END AS rule, CAST(s_suppkey AS VARCHAR) AS entity_id FROM supplier""",
    "name_similarity": """WITH RECURSIVE w AS (
        SELECT p_partkey, k, list_aggregate(list_sort(string_split(trim(regexp_replace(regexp_replace(p_name, '[^a-zA-Z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')), ' ')), 'string_agg', ' ') AS a,
          list_aggregate(list_sort(string_split(trim(regexp_replace(regexp_replace(o, '[^a-zA-Z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')), ' ')), 'string_agg', ' ') AS b FROM part, LATERAL (VALUES (1, p_type), (2, p_brand)) AS v(k, o)),
      d AS (SELECT *, 0 AS j, list_transform(range(length(a) + 1), lambda x: 0) AS row FROM w
        UNION ALL SELECT p_partkey, k, a, b, j + 1, list_reduce(range(1, length(a) + 1), lambda acc, i: list_append(acc, CASE WHEN a[i] = b[j + 1] THEN row[i] + 1 ELSE greatest(row[i + 1], acc[len(acc)]) END), [CAST(0 AS BIGINT)]) FROM d WHERE j < length(b))
      SELECT p_partkey, round(max(2.0 * row[len(row)] / (length(a) + length(b))), 6)::DOUBLE AS similarity FROM d WHERE j = length(b) GROUP BY 1""",
    "match_score": """WITH r AS (SELECT o_orderkey, CAST(o_orderkey % 41 AS DOUBLE) / 40 AS n, CAST(o_custkey % 11 AS DOUBLE) / 10 AS a, o_orderkey % 2 = 0 AS geo, o_custkey % 3 = 0 AS st, o_custkey % 2 = 0 AS broad FROM orders), b AS (SELECT *, (n - 0.9) / (1.0 - 0.9) AS bn, (n - 0.8) / (1.0 - 0.8) AS bp, (a - 0.8) / (1.0 - 0.8) AS ba FROM r)
      SELECT o_orderkey, round(CAST(CASE WHEN n >= 0.9 AND a >= 0.8 AND geo THEN least(0.85 + 0.05 * bn + 0.03 * ba, 0.99) WHEN n >= 0.9 AND geo THEN least(0.80 + 0.05 * bn, 0.90) WHEN n >= 0.8 AND a >= 0.8 AND geo THEN least(0.80 + 0.10 * bp, 0.90) WHEN n >= 0.8 AND geo THEN least(0.75 + 0.15 * bp, 0.88)
        WHEN n >= 0.9 AND st THEN least(0.80 + 0.10 * bn, 0.85) WHEN n >= 0.9 THEN least(0.80 + 0.05 * bn, 0.88) WHEN n >= 0.8 THEN least(0.65 + 0.15 * bp, 0.78) WHEN broad THEN n ELSE 0.0 END AS DOUBLE), 6) AS score FROM b""",
    "rule_cascade": CASCADE_SQL, "address_similarity": ADDRESS_SQL,
    "hybrid_match": f"""SELECT row_id, 'h' || row_id AS request_hash, CASE WHEN row_id % 4 = 0 THEN 'C' || row_id ELSE entity_id END AS entity_id, CASE WHEN row_id % 4 = 0 THEN 0.9 ELSE matched_score END AS matched_score,
      CASE WHEN row_id % 4 = 0 THEN 'cached' ELSE matched_rule END AS matched_rule, CASE WHEN row_id % 4 = 0 THEN 'Y' ELSE successful END AS successful FROM ({CASCADE_SQL})""",
    "hybrid_new_rows": f"SELECT 'h' || row_id AS request_hash, entity_id, matched_score, matched_rule FROM ({CASCADE_SQL}) WHERE row_id % 4 > 0 AND entity_id IS NOT NULL",
    "cache_lookup": "SELECT c.c_custkey::VARCHAR AS request_hash, 'E' || e.event_id AS entity_id FROM customer c JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, 'E' || event_id) AS rn FROM events WHERE ts >= TIMESTAMP '2024-01-23') e ON e.user_id = c.c_custkey AND e.rn = 1",
    "cache_split": "SELECT c_custkey::VARCHAR AS request_hash FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-23')",
    "audit_antijoin": "SELECT s_suppkey, s_name AS supplier_name FROM supplier WHERE NOT (s_suppkey % 2 = 0 AND s_suppkey % 5 > 0)",
    "base62_id": """WITH r AS (SELECT c_custkey, greatest(0, (c_custkey - 1) * 7919000003) AS n FROM customer)
      SELECT c_custkey, list_aggregate(list_transform([7, 6, 5, 4, 3, 2, 1, 0], lambda k: '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz'[CAST((n // CAST(62::HUGEINT ** k AS BIGINT)) % 62 + 1 AS BIGINT)]), 'string_agg', '') AS code FROM r""",
    "cosine_pairs": "SELECT a.vec_id AS a_id, b.vec_id AS b_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 4) AS cosine FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0",
    "cluster_best_match": """WITH p AS (SELECT a.vec_id AS i, b.vec_id AS j, -list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS s FROM embeddings a JOIN embeddings b ON a.label = b.label OR a.label = (b.label + b.vec_id % 2) % 10)
      SELECT CAST(-i AS VARCHAR) AS supplier_id, 'E' || j AS entity_id, round(s, 4) AS matched_score, 'other' AS best_match_name FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY s DESC, 'E' || j) AS rn FROM p WHERE s >= -1.0) WHERE rn = 1""",
    "upsert_by_key": "WITH k AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P') SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey NOT IN (SELECT * FROM k) UNION ALL SELECT o_orderkey, o_custkey, 'N' FROM orders WHERE o_custkey IN (SELECT * FROM k) AND o_orderkey % 2 = 0",
    "merge_tracker": "SELECT o_orderpriority || ' ' AS file_id, CASE WHEN o_orderpriority = '1-URGENT' THEN 7 ELSE count(*) END AS record_count, CASE WHEN o_orderpriority = '1-URGENT' THEN 'SUCCESS' ELSE 'IN-PROGRESS' END AS status FROM orders GROUP BY o_orderpriority UNION ALL SELECT '9-NEW', 1, 'FAILED'",
    "text_repair": r"""WITH r AS (SELECT p_partkey, p_name, p_partkey % 5 = 0 AS gone, p_partkey % 4 AS k, trim(repeat(p_name || ' ', 20)) AS many FROM part)
      SELECT p_partkey, CASE WHEN gone THEN '' WHEN k = 0 THEN p_name || ' café' WHEN k = 1 THEN p_name || 'Éb' WHEN k = 2 THEN p_name || ' x' ELSE trim(many[1:200]) END AS cleaned,
        CAST(CASE WHEN gone THEN 0 WHEN k = 0 THEN length(p_name) + 5 WHEN k = 1 THEN length(p_name) + 2 WHEN k = 2 THEN length(p_name) + 6 ELSE 20 * (length(p_name) + 1) END AS INTEGER) AS n_fixed FROM r""",
    "place_match": "SELECT c_custkey, c_custkey % 3 <> 1 AS city, c_custkey % 4 IN (0, 3) AS postal FROM customer",
    "supplier_normalized": """SELECT s_suppkey, s_name || ' Inc.' AS norm_supplier_name, '1 Main' || s_suppkey AS norm_street_address, CASE WHEN s_suppkey % 3 > 0 THEN 'Par is' ELSE '' END AS norm_city,
      CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE '1-' || CASE WHEN length(CAST(s_suppkey AS VARCHAR)) < 4 THEN lpad(CAST(s_suppkey AS VARCHAR), 4, '7') ELSE CAST(s_suppkey AS VARCHAR)[1:4] END END AS norm_postal_code, lower(s_name) AS cleansed_supplier_name,
      CASE WHEN s_suppkey % 4 = 0 THEN 'USA-CA' WHEN s_suppkey % 2 = 0 THEN 'CA' ELSE 'Bavaria' END AS norm_state, CASE WHEN s_suppkey % 2 = 0 THEN 'CALIFORNIA' ELSE 'Bavaria' END AS full_form_state FROM supplier""",
    "entity_request": """SELECT s_suppkey, CAST(to_json({'attributes': {'DoingBusinessAsName': [{'value': s_name}], 'Name': [{'value': s_name}], 'Address': [{'value': {'AddressLine1': [{'value': '1 Main'}], 'Country': [{'value': CAST(s_nationkey AS VARCHAR)}],
      'City': [{'value': ''}], 'StateProvince': [{'value': 'CA'}], 'PostalCode': [{'value': {'PostalCode': [{'value': CAST(s_suppkey AS VARCHAR)}]}}]}}]}, 'crosswalks': [{'value': CASE WHEN s_suppkey % 3 > 0 THEN CAST(s_suppkey AS VARCHAR) ELSE '1_1' END}]}) AS VARCHAR) AS request FROM supplier""",
    "match_join": f"WITH {MATCHED_SQL} SELECT s_suppkey AS supplier_id, printf('E%08d', l_partkey) AS entity_id, CASE WHEN l_partkey IS NULL THEN 'N' ELSE 'Y' END AS is_matched, round(s, 6) AS matched_score FROM j",
    "summary_join": f"""WITH {MATCHED_SQL}, p AS (SELECT p_partkey, p_brand FROM part WHERE p_partkey % 3 > 0), c AS (SELECT DISTINCT p_size % 10 AS k FROM part WHERE p_size % 10 > 2)
      SELECT s_suppkey AS supplier_id, CAST(l_partkey % 10 AS VARCHAR) AS mcc_code, 'g' || k AS mcc_group, CAST(l_partkey AS VARCHAR) AS mmh_id, p_brand || '-card_acceptor' AS card_acceptor, p_brand || '-commercial_recency' AS commercial_recency,
        CASE WHEN s >= 0.75 THEN 'High' WHEN s >= 0.70 THEN 'Medium' ELSE 'Low' END AS confidence, CAST(NULL AS VARCHAR) AS cleansed_city_name FROM j LEFT JOIN p ON l_partkey = p_partkey LEFT JOIN c ON l_partkey % 10 = k""",
    "latest_days": f"WITH {CLEARING_SQL} SELECT r.region, CAST(max(CAST(process_date AS DATE)) AS VARCHAR) AS latest FROM (VALUES ('01'), ('02'), ('03'), (NULL)) AS r(region) LEFT JOIN clr ON r.region IS NULL OR clr.region = r.region GROUP BY 1",
    "union_columns": "SELECT s_name AS name, s_nationkey AS nation, CAST(NULL AS VARCHAR) AS segment FROM supplier UNION ALL SELECT c_name, NULL, c_mktsegment FROM customer",
    "table_scan": "SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders",
    "folder_partitions": "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders",
    "folder_manifest": "SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year, count(*) AS n_rows, TRUE AS in_place FROM orders GROUP BY 1",
    "csv_scan": """SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderstatus, CAST(NULL AS VARCHAR) AS bad_line FROM orders WHERE o_orderkey % 77 > 0 AND o_orderkey % 50 > 0
      UNION ALL SELECT NULL, NULL, NULL, NULL, CASE WHEN o_orderkey % 77 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE o_orderkey || ',x,' || CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS VARCHAR) || ',' || o_orderstatus END FROM orders WHERE o_orderkey % 77 = 0 OR o_orderkey % 50 = 0""",
    "quantile_values": """WITH v AS (SELECT 'price' AS metric, CAST(o_totalprice AS DOUBLE) AS v FROM orders UNION ALL SELECT 'key', -CAST(o_custkey % 1000 AS DOUBLE) FROM orders),
      r AS (SELECT metric, v, row_number() OVER (PARTITION BY metric ORDER BY v) AS r, count(*) OVER (PARTITION BY metric) AS n FROM v)
      SELECT r.metric, CAST(i.range AS INTEGER) AS i, round(r.v, 4) AS v FROM range(101) i JOIN r ON r.r = greatest(1, (i.range * r.n + 99) // 100)""",
    "quantile_digits": """WITH e AS (SELECT CAST(o_totalprice AS DOUBLE) AS v, pow(10.0, 2 - floor(log10(CAST(o_totalprice AS DOUBLE)))) AS u FROM orders), r AS (SELECT round(v * u) / u AS v, row_number() OVER (ORDER BY round(v * u) / u) AS r, count(*) OVER () AS n FROM e)
      SELECT CAST(i.range AS INTEGER) AS i, round(r.v, 4) AS v FROM range(101) i JOIN r ON r.r = greatest(1, (i.range * r.n + 99) // 100)""",
    "quantile_ranks": "SELECT CAST(range AS INTEGER) AS i, TRUE AS near, (SELECT count(c_acctbal) FROM customer) AS n FROM range(101)",
}
