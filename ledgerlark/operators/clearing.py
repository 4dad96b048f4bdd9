"""Daily clearing aggregation of two sources, and which days are still to do. All days of a run are one Spark job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TYPES = ["00", "09", "20"]
KEYS = ["dw_merch_location_id", "pds1_paypass_acct_nbr_type_ind", "dw_issuer_id", "source_type", "dw_merch_country_cd", "product_cd", "local_txn_date", "process_date", "dw_merch_region_cd"]


def clearing_source(rows: DataFrame, tag: str, issuer: str, txn_date: str) -> DataFrame:
    """One source in the common shape: transactions of the known types from an amount of 1."""
    hit = rows.where(F.col("de3_cardholder_txn_type").isin(*TYPES) & (F.col("de4_txn_amt") >= 1))
    text = lambda c, name: F.col(c).cast("string").alias(name)
    return hit.select(
        F.col("dw_merch_location_id").cast("long").alias("dw_merch_location_id"), text("pds1_paypass_acct_nbr_type_ind", "pds1_paypass_acct_nbr_type_ind"), F.col(issuer).cast("long").alias("dw_issuer_id"),
        F.lit(tag).alias("source_type"), text("dw_merch_country_cd", "dw_merch_country_cd"), text("dw_product_cd", "product_cd"), text(txn_date, "local_txn_date"),
        "dw_net_pd_cnt", "dw_net_pd_amt", text("dw_process_date", "process_date"), text("dw_merch_region_cd", "dw_merch_region_cd"))


def clearing_rollup(core: DataFrame, other: DataFrame, days: list[str] | None = None, regions: list[str] | None = None) -> DataFrame:
    """Counts and amounts (4 decimals) by key of both sources, in one aggregation."""
    rows = clearing_source(core, "CORE", "dw_issuer_id", "local_txn_date").unionByName(clearing_source(other, "GCO", "de93_issuer_id", "de12_txn_date"))
    if days is not None:
        rows = rows.where(F.col("process_date").isin(*days))
    if regions is not None:
        rows = rows.where(F.col("dw_merch_region_cd").isin(*regions))
    return rows.groupBy(*KEYS).agg(F.sum("dw_net_pd_cnt").cast("long").alias("dw_net_pd_cnt"), F.round(F.sum("dw_net_pd_amt"), 4).cast("double").alias("dw_net_pd_amt"))


def latest_day(table: DataFrame, region: str | None = None) -> DataFrame:
    """One row: the last processed day, null without any."""
    rows = table.where(F.col("dw_merch_region_cd") == region) if region is not None else table
    return rows.agg(F.max(F.to_date("process_date")).alias("latest"))


def missing_days(done: DataFrame, regions: list[str], start: str, end: str) -> DataFrame:
    """(region, day) from the day after the last processed one of each region, or from `start`, to `end`."""
    spark = done.sparkSession
    last = done.groupBy(F.col("dw_merch_region_cd").alias("region")).agg(F.max(F.to_date("process_date")).alias("latest"))
    rows = spark.createDataFrame([(r,) for r in regions], "region string").join(last, "region", "left")
    first, until = F.coalesce(F.date_add("latest", 1), F.lit(start).cast("date")), F.lit(end).cast("date")
    return rows.where(first <= until).select("region", F.explode(F.sequence(first, until)).alias("day"))
