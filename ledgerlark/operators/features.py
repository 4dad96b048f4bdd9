"""Merchant features from clearing aggregates: joins to master entities, rolling metrics, categories, the summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import card_acceptor, history_flag, months_since

IN_CONTROL = ["8", "8C", "9", "9C"]


def region_number(column: str) -> Column:
    return F.expr(f"try_cast({column} as int)")


def located_clearing(clearing: DataFrame, locations: DataFrame, as_of: str, regions: Sequence[str], days: int = 365) -> DataFrame:
    """Clearing rows of the last `days` days with an amount of 0 or more, at known locations, with __place_region. Regions compare as
    numbers, so `01` and `1` are one; text that isn't a day or number matches nothing."""
    day, end = F.expr("try_to_date(process_date)"), F.lit(as_of).cast("date")
    wanted = [int(r) for r in regions]
    rows = clearing.where(region_number("dw_merch_region_cd").isin(*wanted) & day.between(F.date_sub(end, days - 1), end) & (F.col("dw_net_pd_amt") >= 0)).withColumn("__region", region_number("dw_merch_region_cd"))
    places = locations.select(F.col("old_loc_id").alias("__loc"), "merchant_market_hierarchy_id", region_number("cleansed_business_region_code").alias("__place_region")).where(F.col("__place_region").isin(*wanted))
    return rows.join(places, (F.col("dw_merch_location_id") == F.col("__loc")) & (F.col("__region") == F.col("__place_region"))).drop("__region", "__loc")


def with_entities(rows: DataFrame, entities: DataFrame) -> DataFrame:
    """Rows with merchant_market_hierarchy_id and __place_region beside each entity that lists the id, in its region; rows of no
    entity once."""
    known = entities.select("entity_id", "mcc_code", F.explode("mmh_id").alias("__mmh"), region_number("region_code").alias("__entity_region"))
    out = rows.join(known, (F.col("merchant_market_hierarchy_id").cast("string") == F.col("__mmh").cast("string")) & (F.col("__place_region") == F.col("__entity_region")), "left")
    return out.drop("__place_region", "__mmh", "__entity_region")


def merchant_transactions(clearing: DataFrame, locations: DataFrame, entities: DataFrame, as_of: str, regions: Sequence[str], days: int = 365) -> DataFrame:
    """The rows of located_clearing() beside their entities: as many rows as clearing rows times entities. Metrics don't need them,
    see merchant_metrics()."""
    return with_entities(located_clearing(clearing, locations, as_of, regions, days), entities)


def transaction_states(rows: DataFrame, as_of: str, keys: Sequence[str], days: int = 90) -> DataFrame:
    """By keys and product_cd what the metrics are made of: sums, extremes and last days, of all rows and of the `days` days up to
    as_of. States of more keys merge into those of fewer, so they can be made below a join that multiplies rows."""
    end = F.lit(as_of).cast("date")
    inside = F.to_date("process_date").between(F.date_sub(end, days - 1), end)
    amount, count = F.coalesce("dw_net_pd_amt", F.lit(0.0)), F.coalesce("dw_net_pd_cnt", F.lit(0))
    own = F.when(inside, amount)
    last = lambda hit: F.max(F.when(hit, F.col("process_date")))
    return rows.groupBy(*keys, "product_cd").agg(
        F.sum(F.when(inside, amount).otherwise(0.0)).alias("__value"), F.sum(F.when(inside, count).otherwise(0)).alias("__volume"), F.max(own).alias("__most"), F.min(own).alias("__least"), F.max(inside).alias("__inside"),
        F.max("process_date").alias("__last"), F.sum("dw_net_pd_amt").alias("__amount"), F.sum("dw_net_pd_cnt").alias("__count"),
        last(F.col("product_cd") == "MCP").alias("__commercial"), last(F.col("pds1_paypass_acct_nbr_type_ind").isin(*IN_CONTROL)).alias("__in_control"))


def metrics_of_states(states: DataFrame, as_of: str, keys: Sequence[str]) -> DataFrame:
    """The metrics by keys, from states by these keys or more."""
    total = F.sum("__count")
    out = states.groupBy(*keys).agg(
        F.sum("__value").alias("total_txn_value_past_90"), F.sum("__volume").alias("total_txn_vol_past_90"), (F.max("__most") - F.min("__least")).alias("txn_amt_range_past_90"),
        F.countDistinct(F.when(F.col("__inside"), F.col("product_cd"))).alias("distinct_product_cd_past_90"), F.max("__last").alias("most_recent_txn_date"), F.max("__most").alias("max_amt_90d"), F.min("__least").alias("min_amt_90d"),
        F.round(F.when(total != 0, F.sum("__amount") / total).otherwise(0), 5).alias("avg_tran_amt"), total.alias("matched_trans_count"),
        F.max("__commercial").alias("recent_comm_hist_txn_dt"), F.max("__in_control").alias("recent_in_crntl_hist_txn_dt"))
    return out.withColumn("avg_daily_vol_past_90", F.col("total_txn_vol_past_90") / F.lit(90.0)).withColumn("days_since_most_recent_txn", F.datediff(F.lit(as_of).cast("date"), F.to_date("most_recent_txn_date")))


def transaction_metrics(rows: DataFrame, as_of: str, keys: Sequence[str], days: int = 90) -> DataFrame:
    """Sums, extremes and last days by key; the window is the `days` days up to as_of, averages and last days cover all rows."""
    return metrics_of_states(transaction_states(rows, as_of, keys, days), as_of, keys)


def merchant_metrics(clearing: DataFrame, locations: DataFrame, entities: DataFrame, as_of: str, regions: Sequence[str], keys: Sequence[str] = ("entity_id", "dw_merch_region_cd"), days: int = 365, window: int = 90) -> DataFrame:
    """transaction_metrics(merchant_transactions(...)), summed up before the join that multiplies: what meets the entities is one
    state for each hierarchy id, region and product, however many clearing rows there are. keys: among entity_id, mcc_code,
    merchant_market_hierarchy_id and dw_merch_region_cd."""
    rows = located_clearing(clearing, locations, as_of, regions, days)
    states = transaction_states(rows, as_of, ["merchant_market_hierarchy_id", "__place_region", "dw_merch_region_cd"], window)
    return metrics_of_states(with_entities(states, entities), as_of, keys)


def category_dim(hierarchy: DataFrame, level: int = 20) -> DataFrame:
    """One row a category code: the smallest group name and classification of the level."""
    return hierarchy.where(F.col("LEVEL_NUMBER") == level).groupBy(F.col("merchant_category_code").alias("mcc_code")).agg(
        F.min("merchant_mcc_group_name").alias("mcc_group_name"), F.min("classification_code").alias("classification_code"))


def latest_snapshot(rows: DataFrame, day: str = "refreshed_date") -> DataFrame:
    """Rows of the last day, by a one-row broadcast."""
    return rows.join(F.broadcast(rows.agg(F.max(day).alias("__last"))), F.col(day) == F.col("__last")).drop("__last")


def merchant_summary(inference: DataFrame, entities: DataFrame, categories: DataFrame, as_of: str) -> DataFrame:
    """Every entity with its features, if it has any, and category."""
    end, c, e = F.lit(as_of).cast("date"), latest_snapshot(inference).alias("c"), entities.alias("e")
    both = (F.col("c.entity_id") == F.col("e.entity_id")) & (F.expr("try_cast(c.dw_merch_region_cd as int)") == F.expr("try_cast(e.region_code as int)"))
    rows = e.join(c, both, "left").join(categories.alias("m"), F.col("e.mcc_code") == F.col("m.mcc_code"), "left")
    recent, comm, ctrl = (F.col(f"c.{x}") for x in ("most_recent_txn_date", "recent_comm_hist_txn_dt", "recent_in_crntl_hist_txn_dt"))
    ids = F.concat_ws(",", F.col("e.mmh_id"))
    recency = months_since(end, recent).cast("string")
    return rows.select(
        F.col("e.entity_id"), F.col("e.url").alias("supplier_website_url"), F.col("e.region_name").alias("region"), F.col("e.mcc_code"), F.col("e.dba_name").alias("supplier_alias_name"),
        F.col("m.classification_code").alias("industry_classification_code"), F.lit("CARD").alias("preferred_payment_method"), F.col("c.propensity_score"), recency.alias("transaction_recency"), F.col("e.sic"),
        F.lit(None).cast("string").alias("suggested_talking_points"), F.col("e.dba_name").alias("cleansed_supplier_name"), F.col("e.address_line1").alias("cleansed_address_line_1"), F.col("e.city").alias("cleansed_city_name"),
        F.col("e.state_province").alias("Cleansed_state_Or_province_name"), F.col("e.country_cd").alias("cleansed_country_code"), F.col("e.postcode").alias("cleansed_postal_code"),
        F.col("e.aggr_merch_name").alias("aggregate_merchant_name"), F.col("e.aggr_merch_id").alias("aggregate_merchant_id"), F.col("e.parent_aggr_merch_name").alias("parent_aggregate_merchant_name"),
        F.col("e.parent_aggr_merch_id").alias("parent_aggregate_merchant_id"), F.col("m.mcc_group_name").alias("mcc_group"), F.col("e.region_name").alias("business_region_name"),
        history_flag(recent, comm).alias("commercial_history"), months_since(end, comm).alias("commercial_recency"), F.col("e.clearing_last_seen_date").cast("string").alias("clearing_last_seen_date"),
        F.col("e.auth_last_seen_date").cast("string").alias("auth_last_seen_date"), F.col("c.avg_tran_amt").cast("double").alias("avg_tran_amt"), F.col("c.matched_trans_count"),
        history_flag(recent, ctrl).alias("in_control_history"), months_since(end, ctrl).alias("in_control_recency"), F.col("e.zi_c_last_updated_date").cast("string").alias("last_update_date"),
        F.col("e.naics").alias("customer_naics"), F.col("c.propensity_score_label"), F.col("e.region_code").alias("dw_merch_region_cd"), F.col("e.industry"), ids.alias("mmh_id"), card_acceptor(recency, ids).alias("card_acceptor"))
