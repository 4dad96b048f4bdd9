"""Column contracts of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Output columns of the payables gold table, in order.
PAYABLES_GOLD = [
    "file_id", "file_original_name", "entity_id", "supplier_id", "supplier_name", "street_address", "city", "state", "postal_code", "country",
    "phone_number", "email_address", "payment_method", "payment_terms", "currency", "total_number_of_invoices", "total_amount_of_invoices",
    "total_number_of_purchase_orders", "total_amount_of_purchase_orders", "total_number_of_payments_paid", "total_amount_of_payments_paid",
    "total_number_of_payments_due", "total_amount_of_payments_due", "total_number_of_payments_open", "total_amount_of_payments_open", "merchant_id",
    "annual_target_spend", "transaction_count", "average_ticket", "total_spend", "total_spent_by_card", "total_spent_by_eft", "total_spent_by_cheque",
    "total_spent_by_ach", "total_spent_by_other", "issuer_id", "payment_term_days", "mapped_payment_method", "all_suppliers_total_number_of_payment",
    "all_suppliers_total_number_of_suppliers", "all_suppliers_total_number_of_invoices", "all_suppliers_total_spend", "all_supplier_total_spent_by_card",
    "all_supplier_total_spent_by_eft", "all_supplier_total_spent_by_cheque", "all_supplier_total_spent_by_ach", "all_supplier_total_spent_by_other",
    "all_suppliers_total_card_accepting_suppliers", "next_payment_date", "is_matched", "supplier_website_url", "region", "mcc_code",
    "supplier_alias_name", "industry_classification_code", "preferred_payment_method", "propensity_score", "transaction_recency", "sic",
    "suggested_talking_points", "cleansed_supplier_name", "cleansed_address_line_1", "cleansed_city_name", "Cleansed_state_Or_province_name",
    "cleansed_country_code", "cleansed_postal_code", "aggregate_merchant_name", "aggregate_merchant_id", "parent_aggregate_merchant_name",
    "parent_aggregate_merchant_id", "mcc_group", "business_region_name", "commercial_history", "commercial_recency", "clearing_last_seen_date",
    "auth_last_seen_date", "avg_tran_amt", "matched_trans_count", "in_control_history", "in_control_recency", "last_update_date", "customer_naics",
    "mmh_id", "card_acceptor", "propensity_score_label", "dw_merch_region_cd", "confidence", "industry",
]

# Output columns of the ERP gold table, in order.
ERP_GOLD = [
    "entity_id", "supplier_name", "merchant_id", "date_period", "supplier_id", "street_address", "city", "state", "postal_code", "country",
    "phone_number", "email_address", "currency", "payment_method", "payment_terms", "total_number_of_invoices", "total_amount_of_invoices",
    "total_number_of_purchase_orders", "total_amount_of_purchase_orders", "total_number_of_payments_paid", "total_amount_of_payments_paid",
    "total_number_of_payments_due", "total_amount_of_payments_due", "total_number_of_payments_open", "total_amount_of_payments_open",
    "total_amount_spend", "total_spent_by_cheque", "total_spent_by_card", "total_spent_by_ach", "total_spent_by_eft", "total_spent_by_other",
    "next_payment_date", "annual_target_spend", "transaction_count", "average_ticket", "is_matched", "supplier_website_url", "region", "mcc_code",
    "supplier_alias_name", "industry_classification_code", "preferred_payment_method", "propensity_score", "transaction_recency", "sic",
    "suggested_talking_points", "cleansed_supplier_name", "cleansed_address_line_1", "cleansed_city_name", "Cleansed_state_Or_province_name",
    "cleansed_country_code", "cleansed_postal_code", "aggregate_merchant_name", "aggregate_merchant_id", "parent_aggregate_merchant_name",
    "parent_aggregate_merchant_id", "mcc_group", "business_region_name", "commercial_history", "commercial_recency", "clearing_last_seen_date",
    "auth_last_seen_date", "avg_tran_amt", "matched_trans_count", "industry", "in_control_history", "in_control_recency", "last_update_date",
    "customer_naics", "mmh_id", "card_acceptor", "confidence", "propensity_score_label", "all_suppliers_total_number_of_payments",
    "all_suppliers_total_number_of_suppliers", "all_suppliers_total_number_of_invoices", "all_suppliers_card_accepting_suppliers",
]

# Attributes a match carries over from the master entity.
MATCHED = [
    "matched_mmhid", "matched_dba_name", "matched_mmh_name", "matched_street_address", "matched_city", "matched_state", "matched_postal_code",
    "matched_country", "matched_industry", "matched_url", "matched_mmc_code", "matched_sic", "matched_naics", "matched_clearing_last_seen_date",
    "matched_auth_last_seen_date", "matched_zi_c_last_updated_date", "matched_agg_merch_id", "matched_agg_merch_name", "matched_parent_agg_merch_id",
    "matched_parent_agg_merch_name", "matched_region_code", "matched_region_name", "matched_country_cd",
]

MATCH_RESULT = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("supplier_id", "entity_id", *MATCHED)]
    + [T.StructField("matched_score", T.DoubleType()), T.StructField("matched_rule", T.StringType()), T.StructField("successful", T.StringType()), T.StructField("match_response_time", T.DoubleType())]
    + [T.StructField(c, T.StringType()) for c in ("match_request", "match_response", "request_hash")])

CLEARING = T.StructType([
    T.StructField("dw_merch_location_id", T.LongType()), T.StructField("pds1_paypass_acct_nbr_type_ind", T.StringType()), T.StructField("dw_issuer_id", T.LongType()),
    T.StructField("source_type", T.StringType()), T.StructField("dw_merch_country_cd", T.StringType()), T.StructField("product_cd", T.StringType()),
    T.StructField("local_txn_date", T.StringType()), T.StructField("dw_net_pd_cnt", T.LongType()), T.StructField("dw_net_pd_amt", T.DoubleType()),
    T.StructField("process_date", T.StringType()), T.StructField("dw_merch_region_cd", T.StringType())])

PAYABLES_TRACKER = "file_id string, start_dt timestamp, last_processed_dt timestamp, total_time_taken double, record_count int, status string, comment string"
ERP_TRACKER = "run_id string, merchant_ids string, number_of_merchants int, start_time timestamp, end_time timestamp, time_taken_seconds double, status string, error_message string, updated_at timestamp"


def require_columns(df: DataFrame, columns) -> DataFrame:
    """df itself, or an error that names the missing columns. Called before a projection, so the message says what's wrong."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
