"""The jobs: payables file → gold, ERP merchants → gold, clearing catch-up, merchant inference and summary."""

from __future__ import annotations

from dataclasses import dataclass, fields
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import confidence_tier
from ..operators import bins, clearing, features, ledger, payables
from ..operators.matching import match_suppliers
from ..schemas import ERP_GOLD, MATCHED, PAYABLES_GOLD, require_columns
from ..sources.tables import VersionedTable, already_processed, manifest, merged, overwrite_partitions

# Gold column and the matched attribute it comes from.
RENAMED = {
    "supplier_website_url": "matched_url", "sic": "matched_sic", "cleansed_address_line_1": "matched_street_address", "cleansed_city_name": "matched_city", "Cleansed_state_Or_province_name": "matched_state",
    "cleansed_country_code": "matched_country_cd", "cleansed_postal_code": "matched_postal_code", "aggregate_merchant_name": "matched_agg_merch_name", "aggregate_merchant_id": "matched_agg_merch_id",
    "parent_aggregate_merchant_name": "matched_parent_agg_merch_name", "parent_aggregate_merchant_id": "matched_parent_agg_merch_id", "clearing_last_seen_date": "matched_clearing_last_seen_date",
    "auth_last_seen_date": "matched_auth_last_seen_date", "last_update_date": "matched_zi_c_last_updated_date", "customer_naics": "matched_naics", "dw_merch_region_cd": "matched_region_code",
    "industry": "matched_industry", "supplier_alias_name": "matched_dba_name", "cleansed_supplier_name": "matched_dba_name", "business_region_name": "matched_region_name", "region": "matched_region_name",
}
# Columns of the merchant summary that a match carries over.
FROM_SUMMARY = [
    "preferred_payment_method", "propensity_score", "transaction_recency", "suggested_talking_points", "commercial_history",
    "commercial_recency", "avg_tran_amt", "matched_trans_count", "in_control_history", "in_control_recency", "propensity_score_label",
    "card_acceptor",
]


@dataclass
class Tables:
    """Where a job reads and writes."""

    categories: DataFrame
    summary: DataFrame
    gold: VersionedTable
    tracker: VersionedTable


def with_matches(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """rows beside their match by supplier_id; of several matches of one id the one with the highest score is taken whole, of equal
    ones that with the smallest entity_id, so rows don't multiply. A matcher that gives only some attributes leaves the others
    null. Rows below the best score of their id leave by a hashed minimum first, so that only ties
    are sorted whole; the hashed join sorts neither side."""
    least = matches.groupBy("supplier_id").agg(F.min(-F.col("matched_score")).alias("__least")).withColumnRenamed("supplier_id", "__id")
    matches = matches.join(least.hint("shuffle_hash"), (F.col("supplier_id") == F.col("__id")) & (-F.col("matched_score")).eqNullSafe(F.col("__least"))).drop("__id", "__least")
    for c in (*MATCHED, "is_matched"):
        if c not in matches.columns:
            matches = matches.withColumn(c, F.lit(None).cast("string"))
    taken = ("entity_id", *MATCHED, "is_matched", "matched_score")
    best = F.min_by(F.struct(*taken), F.struct(F.col("matched_score").isNull(), -F.col("matched_score"), F.col("entity_id").isNull(), F.col("entity_id"), F.xxhash64(*taken)))
    one = matches.groupBy("supplier_id").agg(best.alias("__m")).select("supplier_id", *(F.col(f"__m.{c}").alias(c) for c in taken))
    return rows.join(one, "supplier_id", "left").withColumn("is_matched", F.when(F.coalesce("entity_id", F.lit("")) != "", "Y").otherwise("N"))


def first_rows(rows: DataFrame, key: str) -> DataFrame:
    """One row of each key, whole: the first by its other columns in their order, nulls last."""
    others = [c for c in rows.columns if c != key]
    order = F.struct(*(x for c in others for x in (F.col(c).isNull().alias(f"{c}__null"), F.col(c))))
    return rows.groupBy(key).agg(F.min(order).alias("__first")).select(*(F.col(c) if c == key else F.col(f"__first.{c}").alias(c) for c in rows.columns))


def with_summary(rows: DataFrame, categories: DataFrame, summary: DataFrame) -> DataFrame:
    """rows with category, merchant summary, gold names and confidence. The summary's ids are comma-joined lists, so they are
    split before the join. Of several rows of a category code or of an id one is taken whole: the one that comes first by its
    values, column by column, nulls last. Only ids that rows ask for are sorted for that."""
    cats = first_rows(categories.select("mcc_code", "mcc_group", "industry_classification_code"), "mcc_code")
    out = rows.join(cats, rows["matched_mmc_code"] == cats["mcc_code"], "left").withColumn("mcc_code", F.coalesce("mcc_code", "matched_mmc_code"))
    asked = rows.select(F.col("matched_mmhid").alias("mmh_id")).distinct().hint("shuffle_hash")
    ids = first_rows(summary.select(*FROM_SUMMARY, F.explode(F.split("mmh_id", ",")).alias("mmh_id")).join(asked, "mmh_id", "left_semi"), "mmh_id")
    out = out.join(ids, out["matched_mmhid"] == ids["mmh_id"], "left").withColumn("mmh_id", F.coalesce("mmh_id", "matched_mmhid"))
    return out.withColumns({new: F.col(old) for new, old in RENAMED.items()}).withColumn("confidence", confidence_tier(F.col("matched_score")))


@dataclass(frozen=True)
class JobConfig:
    """What a job can be told beside its tables; the values are the defaults. Remote calls have no part here, so neither have
    their batch sizes, retries and secrets."""

    match_cache_expiry_days: int = 7
    min_match_score: float = 0.80
    match_type: str = "rules"
    clusters: int = 100
    cluster_iterations: int = 20
    cluster_seed: int = 42

    def __post_init__(self):
        if self.match_type not in ("rules", "embeddings"):
            raise ValueError(f"match_type is rules or embeddings, not {self.match_type}")
        if not 0 <= self.min_match_score <= 1 or self.match_cache_expiry_days < 0:
            raise ValueError("min_match_score lies from 0 to 1, match_cache_expiry_days from 0 on")

    @classmethod
    def of(cls, arguments: list[str]) -> JobConfig:
        """From `--min-match-score 0.9` and the like; an unknown name is an error."""
        import argparse

        parser = argparse.ArgumentParser(allow_abbrev=False)
        for f in fields(cls):
            parser.add_argument("--" + f.name.replace("_", "-"), type=type(f.default), default=f.default)
        return cls(**vars(parser.parse_args(arguments)))


def rule_matcher(entities: DataFrame, cache: DataFrame, names: DataFrame, aliases: DataFrame, as_of: str, config: JobConfig = JobConfig()):
    """A matcher for the jobs: normalise, cache, cascade, least score."""
    return lambda rows: match_suppliers(rows, entities, cache, names, aliases, as_of, config.match_cache_expiry_days, config.min_match_score)[0]


def track(tables: Tables, change: dict, key: str, updated: list[str]) -> None:
    old = tables.tracker.read()
    row = tables.tracker.spark.createDataFrame([tuple(change.get(f.name) for f in old.schema.fields)], old.schema)
    tables.tracker.write(merged(old, row, key, updated))


def run_payables(spark: SparkSession, raw: DataFrame, terms: DataFrame, methods: DataFrame, matcher, tables: Tables, file_id: str) -> bool:
    """One payables file to gold. False if it was done before; a failure is recorded and raised. matcher: rows → matches."""
    if already_processed(tables.tracker.read(), file_id):
        return False
    start = datetime.now(timezone.utc).replace(tzinfo=None)
    state = {"file_id": file_id, "start_dt": start, "last_processed_dt": start, "total_time_taken": 0.0, "record_count": 0, "status": "IN-PROGRESS"}
    updated = ["last_processed_dt", "total_time_taken", "record_count", "status", "comment"]
    track(tables, state, "file_id", updated)
    try:
        rows = payables.enrich(raw, terms, methods, file_id).withColumn("payment_terms", F.array("payment_terms")).withColumn("payment_method", F.array("mapped_payment_method"))
        out = with_summary(with_matches(rows, matcher(rows)), tables.categories, tables.summary)
        gold = require_columns(out, PAYABLES_GOLD).select(*PAYABLES_GOLD)
        tables.gold.upsert(gold, spark.createDataFrame([(file_id,)], "file_id string"), ["file_id"])
        state |= {"status": "SUCCESS", "record_count": tables.gold.read().where(F.col("file_id") == file_id).count()}
    except Exception as e:
        state |= {"status": "FAILED", "comment": str(e)[:5000]}
        raise
    finally:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        track(tables, state | {"last_processed_dt": now, "total_time_taken": (now - start).total_seconds()}, "file_id", updated)
    return True


def run_ledger(spark: SparkSession, metrics: DataFrame, matcher, tables: Tables, merchants: list[str], run_id: str) -> None:
    """ERP supplier metrics (operators.ledger.ledger_metrics) to gold, for these merchants, under a run id."""
    if not run_id:
        raise ValueError("a run id is needed")
    start = datetime.now(timezone.utc).replace(tzinfo=None)
    state = {"run_id": run_id, "merchant_ids": ",".join(merchants), "number_of_merchants": len(merchants), "start_time": start, "status": "RUNNING", "updated_at": start}
    updated = ["end_time", "time_taken_seconds", "status", "error_message", "updated_at"]
    track(tables, state, "run_id", updated)
    try:
        unique = metrics.dropDuplicates(["supplier_id", "supplier_name", "state", "city", "postal_code", "country", "street_address"])
        rolled = ledger.with_merchant_rollup(metrics)  # before the joins, which may not add rows to the sums
        out = with_summary(with_matches(rolled, matcher(unique)), tables.categories, tables.summary)
        out = out.withColumn("annual_target_spend", F.lit(0).cast("decimal(38,2)")).withColumn("transaction_count", F.lit(0).cast("long")).withColumn("average_ticket", F.lit(0).cast("decimal(38,2)"))
        gold = require_columns(out, ERP_GOLD).select(*ERP_GOLD)
        tables.gold.upsert(gold, spark.createDataFrame([(m,) for m in merchants], "merchant_id string"), ["merchant_id"])
        state |= {"status": "SUCCEEDED"}
    except Exception as e:
        state |= {"status": "FAILED", "error_message": str(e)[:5000]}
        raise
    finally:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        track(tables, state | {"end_time": now, "time_taken_seconds": (now - start).total_seconds(), "updated_at": now}, "run_id", updated)


def run_clearing(core: DataFrame, other: DataFrame, done: DataFrame, path: str, regions: list[str], start: str, end: str) -> DataFrame:
    """All missing days of all regions in one job; the manifest of what was written."""
    todo = clearing.missing_days(done, regions, start, end).select(F.col("region").alias("dw_merch_region_cd"), F.date_format("day", "yyyy-MM-dd").alias("process_date"))
    rows = clearing.clearing_rollup(core, other, regions=regions).join(F.broadcast(todo), ["dw_merch_region_cd", "process_date"], "left_semi")
    overwrite_partitions(rows, path, ["dw_merch_region_cd", "process_date"])
    written = core.sparkSession.read.parquet(path).withColumn("process_date", F.col("process_date").cast("string"))
    return manifest(written.join(F.broadcast(todo.withColumn("dw_merch_region_cd", F.col("dw_merch_region_cd").cast(written.schema["dw_merch_region_cd"].dataType))), ["dw_merch_region_cd", "process_date"], "left_semi"), "clearing", path)


def merchant_inference(clearing_rows: DataFrame, locations: DataFrame, entities: DataFrame, as_of: str, regions: list[str], scorer, stored_bins: DataFrame | None = None, counts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(features with percentiles and propensity, bins used). Stored bins hold for their quarter. counts: stored value counts of
    other merchants, say of other regions, whose values the new bins are to cover besides; the bins are exact then."""
    rows = features.merchant_metrics(clearing_rows, locations, entities, as_of, regions)
    if stored_bins is None or bins.rebuild_due(stored_bins, as_of):
        made = bins.quantiles(rows, bins.HIGHER, bins.LOWER) if counts is None else bins.quantiles_of(bins.merged_counts(counts, bins.value_counts(rows, bins.HIGHER, bins.LOWER)))
        q = made.withColumn("generated_at", F.lit(as_of).cast("date"))
    else:
        q = stored_bins
    wanted = [f"{m}_percentile" for m in (*bins.HIGHER[1:], *bins.LOWER)]
    out = bins.propensity(bins.score(rows, q, bins.HIGHER + bins.LOWER), scorer, wanted)
    return out.withColumn("suggested_talking_points", F.lit(None).cast("string")).withColumn("refreshed_date", F.lit(as_of).cast("date")), q
