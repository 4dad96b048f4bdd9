"""ERP ledgers: latest supplier versions, rolling 30/90/365-day rollups, supplier and merchant metrics.

The periods nest, so one scan is enough: rows of the last year meet a three-row broadcast of periods and are grouped once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import zero

PERIODS = [("monthly", 30), ("quarterly", 90), ("yearly", 365)]
KEYS = ["date_period", "merchant_id", "supplier_id"]
PIPELINE, DUE, ORDERED = ["PAID", "SUBMITTED", "PARTIALLY_PAID", "OPEN"], ["OPEN", "SUBMITTED"], ["SUBMITTED", "AUTHORIZED", "BILLED"]


def live_rows(rows: DataFrame, as_of: str, merchants: Sequence[str] | None = None, days: int = 365) -> DataFrame:
    """Rows of the merchants that aren't soft-deleted (null counts as deleted) and changed in the last `days` days."""
    out = rows.where(~F.col("soft_delete") & (F.col("modified_date") >= F.date_sub(F.lit(as_of).cast("date"), days)))
    return out.where(F.col("merchant_id").isin(*merchants)) if merchants is not None else out


def latest_version(rows: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row of each key with the largest `order`; `ties` decide among equal ones, largest first."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc(), *(F.col(t).desc() for t in ties))
    return rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def period_table(df: DataFrame) -> DataFrame:
    return F.broadcast(df.sparkSession.createDataFrame(PERIODS, "date_period string, __days int"))


def each_period(rows: DataFrame) -> DataFrame:
    """Every row once for each period."""
    return rows.crossJoin(period_table(rows)).drop("__days")


def in_periods(rows: DataFrame, as_of: str, changed: str = "modified_date") -> DataFrame:
    """Every row once for each period it falls in; the year takes all rows, as they are of the last year already."""
    periods = period_table(rows)
    within = (F.col(changed).cast("date") >= F.date_sub(F.lit(as_of).cast("date"), F.col("__days"))) | (F.col("date_period") == "yearly")
    return rows.crossJoin(periods).where(within).drop("__days")


def invoice_rollup(invoices: DataFrame, as_of: str) -> DataFrame:
    status, amount, today = F.upper(F.trim("status")), zero("amount"), F.lit(as_of).cast("date")
    count = lambda hit: F.count(F.when(hit, 1))
    total = lambda hit: F.sum(F.when(hit, amount).otherwise(0))
    paid, open_, due = status == "PAID", status == "OPEN", status.isin(*DUE) & (F.col("due_date") < today)
    return in_periods(invoices, as_of).groupBy(*KEYS).agg(
        F.sort_array(F.collect_set("payment_terms")).alias("payment_terms"), F.count("*").alias("total_number_of_invoices"), count(status.isin(*PIPELINE)).alias("total_number_of_payments_paid_tbg"),
        F.sum(amount).alias("total_amount_of_invoices"), count(paid).alias("total_number_of_payments_paid"), total(paid).alias("total_amount_of_payments_paid"),
        count(due).alias("total_number_of_payments_due"), total(due).alias("total_amount_of_payments_due"), count(open_).alias("total_number_of_payments_open"), total(open_).alias("total_amount_of_payments_open"),
        F.min(F.when(status.isin(*DUE) & (F.col("due_date") >= today), F.col("due_date"))).alias("next_payment_date"))


def order_rollup(orders: DataFrame, as_of: str) -> DataFrame:
    """Counts and sums of the orders under way; the sum is null where there are none."""
    hit = F.upper(F.trim("status")).isin(*ORDERED)
    return in_periods(orders, as_of).groupBy(*KEYS).agg(F.count(F.when(hit, 1)).alias("total_number_of_purchase_orders"), F.sum(F.when(hit, zero("amount"))).alias("total_amount_of_purchase_orders"))


def map_methods(payments: DataFrame, methods: DataFrame) -> DataFrame:
    """payments with mapped_payment_method; only the payments' side is trimmed."""
    m = methods.select(F.lower("src_payment_method").alias("__method"), F.col("sme_payment_method").alias("mapped_payment_method"))
    return payments.join(m, F.lower(F.trim(payments["payment_method"])) == m["__method"], "left").drop("__method")


def payment_rollup(payments: DataFrame, as_of: str) -> DataFrame:
    method, amount = F.upper("mapped_payment_method"), zero("amount")
    total = lambda hit: F.sum(F.when(hit, amount).otherwise(0))
    return in_periods(payments, as_of).groupBy(*KEYS).agg(
        F.sort_array(F.collect_set("mapped_payment_method")).alias("payment_method"), F.count("*").alias("total_number_of_payments"),
        F.max(F.when(method == "CARD", 1).otherwise(0)).cast("long").alias("total_number_of_card_accepting_suppliers"), F.sum(amount).alias("total_amount_spend"),
        total(method == "CARD").alias("total_spent_by_card"), total(method == "CHECK").alias("total_spent_by_cheque"), total(method == "ACH").alias("total_spent_by_ach"),
        total(method.isNull() | ~method.isin("CARD", "CHECK", "ACH")).alias("total_spent_by_other"))


def store_rollup(rows: DataFrame, table: str, buckets: int = 64) -> DataFrame:
    """Writes suppliers by period, or a rollup, as a catalog table bucketed by KEYS, and reads it back. final_metrics() of tables
    with the same number of buckets joins them as they lie. Buckets are by all three keys, not by the merchant alone: one merchant
    may hold a large part of all rows, and its rollup sums up before it shuffles anyway."""
    rows.repartition(buckets, *KEYS).write.mode("overwrite").bucketBy(buckets, *KEYS).sortBy(*KEYS).saveAsTable(table)
    return rows.sparkSession.table(table)


def final_metrics(suppliers: DataFrame, invoices: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Suppliers by period beside their rollups, zeros where a rollup has no row. All four meet on the same key."""
    out = suppliers
    for part in (orders, invoices, payments):
        out = out.join(part, KEYS, "left")
    keep = {"payment_method", "payment_terms", "next_payment_date", "total_number_of_card_accepting_suppliers"}
    numbers = [c for part in (invoices, orders, payments) for c in part.columns if c not in keep and c not in KEYS]
    return out.select(*suppliers.columns, *(c for c in keep if c in out.columns), *(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in numbers), F.lit(0).cast("decimal(38,2)").alias("total_spent_by_eft"))


def merchant_rollup(metrics: DataFrame) -> DataFrame:
    """One row for each merchant and period, from supplier metrics without duplicates."""
    return metrics.groupBy("merchant_id", "date_period").agg(
        F.sum(F.col("total_number_of_payments_paid") + F.col("total_number_of_payments_open")).alias("all_suppliers_total_number_of_payments"),
        F.countDistinct("supplier_id").alias("all_suppliers_total_number_of_suppliers"), F.sum("total_number_of_payments_paid_tbg").alias("all_suppliers_total_number_of_invoices"),
        F.countDistinct(F.when(F.col("total_number_of_card_accepting_suppliers") > 0, F.col("supplier_id"))).alias("all_suppliers_card_accepting_suppliers"))


def with_merchant_rollup(metrics: DataFrame) -> DataFrame:
    return metrics.join(merchant_rollup(metrics), ["merchant_id", "date_period"], "left")


def ledger_metrics(suppliers: DataFrame, invoices: DataFrame, orders: DataFrame, payments: DataFrame, methods: DataFrame, as_of: str, merchants: Sequence[str] | None = None) -> DataFrame:
    """From raw ledgers to supplier metrics: the whole chain."""
    live = suppliers.where(~F.col("soft_delete"))
    live = live.where(F.col("merchant_id").isin(*merchants)) if merchants is not None else live
    latest = each_period(latest_version(live, ["merchant_id", "supplier_id"], "ingestion_ts").drop("ingestion_ts", "soft_delete"))
    return final_metrics(
        latest, invoice_rollup(live_rows(invoices, as_of, merchants), as_of), order_rollup(live_rows(orders, as_of, merchants), as_of),
        payment_rollup(map_methods(live_rows(payments, as_of, merchants), methods), as_of))
