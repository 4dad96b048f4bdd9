"""Payables (AP) enrichment: mapping joins, per-row spend, grand totals, due dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import method_is, method_is_other, next_payment_date, ticket_average, zero

METHODS = {"card": "card", "eft": "eft", "cheque": "check", "ach": "ach"}


def map_terms_and_methods(rows: DataFrame, terms: DataFrame, methods: DataFrame) -> DataFrame:
    """rows with payment_term_days and mapped_payment_method, joined without regard to case; a key that a mapping holds twice
    gives two rows. The mappings are small by nature; Spark broadcasts them below its own size limit and shuffles above it."""
    t = terms.select(F.lower("payment_term").alias("__term"), F.col("days").alias("payment_term_days"))
    m = methods.select(F.lower("src_payment_method").alias("__method"), F.col("sme_payment_method").alias("mapped_payment_method"))
    out = rows.join(t, F.lower(rows["payment_terms"]) == t["__term"], "left")
    return out.join(m, F.lower(out["payment_method"]) == m["__method"], "left").drop("__term", "__method")


def contributions(rows: DataFrame) -> DataFrame:
    """Per-row average ticket, counts and spend by method; an unknown or missing method is `other`."""
    spend = zero("total_amount_of_payments_open") + zero("total_amount_of_payments_paid")
    count = zero("total_number_of_payments_open") + zero("total_number_of_payments_paid")
    method = F.col("mapped_payment_method")
    part = lambda hit: F.when(hit, spend).otherwise(F.lit(0.0))
    return rows.select(
        "*", ticket_average(spend, count).alias("average_ticket"), count.alias("c_total_number_of_payment"), zero("total_number_of_invoices").alias("c_total_number_of_invoices"),
        spend.alias("total_spend"), *(part(method_is(method, m)).alias(f"total_spent_by_{name}") for name, m in METHODS.items()),
        part(method_is_other(method, *METHODS.values())).alias("total_spent_by_other"), F.when(method_is(method, "card"), 1).otherwise(0).alias("c_card_accepting_suppliers"))


TOTALS = {
    "all_suppliers_total_number_of_payment": "c_total_number_of_payment", "all_suppliers_total_number_of_invoices": "c_total_number_of_invoices", "all_suppliers_total_spend": "total_spend",
    **{f"all_supplier_total_spent_by_{m}": f"total_spent_by_{m}" for m in (*METHODS, "other")}, "all_suppliers_total_card_accepting_suppliers": "c_card_accepting_suppliers",
}


def grand_totals(rows: DataFrame) -> DataFrame:
    """One row of sums and the number of suppliers."""
    return rows.agg(*(F.sum(c).alias(name) for name, c in TOTALS.items()), F.count("*").alias("all_suppliers_total_number_of_suppliers"))


def with_totals(rows: DataFrame) -> DataFrame:
    """rows beside their grand totals: a partial aggregate and a one-row broadcast, never all rows in one partition."""
    return rows.crossJoin(F.broadcast(grand_totals(rows)))


def with_due_dates(rows: DataFrame) -> DataFrame:
    return rows.withColumn("next_payment_date", next_payment_date(F.col("ingestion_ts"), F.col("payment_term_days")))


def enrich(rows: DataFrame, terms: DataFrame, methods: DataFrame, file_id: str | None = None) -> DataFrame:
    """The whole chain, for one file if file_id is given."""
    rows = rows.where(F.col("file_id") == file_id) if file_id is not None else rows
    return map_terms_and_methods(rows, terms, methods).transform(contributions).transform(with_totals).transform(with_due_dates)
