"""Percentile bins and scores. Bins are bounds in one row, looked up by binary search in an array: no range join, no copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import propensity_tier
from ..sources.tables import work_folder

HIGHER = ["avg_daily_vol_past_90", "total_txn_value_past_90", "total_txn_vol_past_90", "txn_amt_range_past_90", "distinct_product_cd_past_90"]
LOWER = ["days_since_most_recent_txn"]


def quantiles(rows: DataFrame, metrics: Sequence[str], negated: Sequence[str] = (), bins: int = 100, accuracy: int = 10_000) -> DataFrame:
    """(metric, is_negated, q): approximate quantiles at i / bins, of all metrics in one aggregation."""
    at = F.array(*(F.lit(i / bins) for i in range(bins + 1)))
    value = {**{m: F.col(m) for m in metrics}, **{m: -F.col(m) for m in negated}}
    one = rows.agg(*(F.percentile_approx(v, at, accuracy).cast("array<double>").alias(m) for m, v in value.items()))
    cells = [F.struct(F.lit(m).alias("metric"), F.lit(m in negated).alias("is_negated"), F.col(m).alias("q")) for m in value]
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def value_counts(rows: DataFrame, metrics: Sequence[str], negated: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """(metric, is_negated, v, c): how often each value occurs, the state that exact quantiles are made of; nulls and NaN don't
    count. States of days or partitions can be stored and merged. With `digits` values are rounded to so many significant digits
    first: a state then has under 10 ** digits values for each power of ten, and a quantile is right to half a unit of the last."""
    value = {**{m: F.col(m) for m in metrics}, **{m: -F.col(m) for m in negated}}
    cells = F.array(*(F.struct(F.lit(m).alias("metric"), F.lit(m in negated).alias("is_negated"), v.cast("double").alias("v")) for m, v in value.items()))
    out = rows.select(F.explode(cells).alias("k")).select("k.*").where(F.col("v").isNotNull() & ~F.isnan("v"))
    if digits is not None:
        unit = F.pow(F.lit(10.0), digits - 1 - F.floor(F.log10(F.abs("v"))))
        out = out.withColumn("v", F.when((F.col("v") == 0) | (F.abs("v") == float("inf")), F.col("v")).otherwise(F.round(F.col("v") * unit) / unit))
    return out.groupBy("metric", "is_negated", "v").agg(F.count("*").alias("c"))


def merged_counts(*states: DataFrame) -> DataFrame:
    """One state of several: the same, to the last digit, as the state of all their rows."""
    whole = states[0]
    for s in states[1:]:
        whole = whole.unionByName(s)
    return whole.groupBy("metric", "is_negated", "v").agg(F.sum("c").alias("c"))


def quantiles_of(counts: DataFrame, bins: int = 100) -> DataFrame:
    """(metric, is_negated, q) from value counts: exact quantiles of all metrics, by integer ranks max(1, ceil(i * n / bins)).
    Counts are summed up by range partition, so no partition holds all values of a metric unless they are few. Their numbers are
    written with the rows: the bounds of ranges are drawn anew each time a plan is run, and both sides of the join need the same."""
    path = work_folder(counts.sparkSession, "ranges")
    counts.repartitionByRange("metric", "v").withColumn("p", F.spark_partition_id()).write.mode("overwrite").parquet(path)
    parts = counts.sparkSession.read.parquet(path)
    parts = parts.withColumn("inside", F.sum("c").over(Window.partitionBy("metric", "p").orderBy("v")))
    ahead = parts.groupBy("metric", "p").agg(F.sum("c").alias("own"))  # a row for each partition and metric
    ahead = ahead.withColumn("before", F.sum("own").over(Window.partitionBy("metric").orderBy("p")) - F.col("own")).withColumn("n", F.sum("own").over(Window.partitionBy("metric")))
    upto = parts.join(F.broadcast(ahead.select("metric", "p", "before", "n")), ["metric", "p"]).select("metric", "is_negated", "v", (F.col("before") + F.col("inside")).alias("upto"), "c", "n")
    # the numbers i whose rank lies in (upto - c, upto]; a value with no rank in it gives none
    first, last = F.expr(f"greatest(0, ((upto - c) * {bins}) div n)"), F.expr(f"least({bins}, (upto * {bins}) div n + 1)")
    rank = lambda i: F.greatest(F.lit(1).cast("long"), F.floor((i * F.col("n") + (bins - 1)) / bins))
    hit = upto.withColumn("i", F.explode(F.filter(F.sequence(first.cast("int"), last.cast("int")), lambda i: (rank(i) <= F.col("upto")) & (rank(i) > F.col("upto") - F.col("c")))))
    return hit.groupBy("metric", "is_negated").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("q"))


def exact_quantiles(rows: DataFrame, metric: str, bins: int = 100) -> DataFrame:
    """The exact table for one metric; one row without bounds where no row has a value."""
    q = quantiles_of(value_counts(rows, [metric]), bins)
    one = rows.sparkSession.range(1).select(F.lit(metric).alias("metric"), F.lit(False).alias("is_negated"))
    return one.join(q.drop("is_negated"), "metric", "left").select("metric", "is_negated", F.coalesce("q", F.array().cast("array<double>")).alias("q"))


def bin_table(q: DataFrame) -> DataFrame:
    """One row a bin: (prev_hi, hi], the outer bounds infinite, and its share of percentiles."""
    rows = q.select("metric", "is_negated", F.size("q").alias("n"), F.posexplode("q").alias("idx", "hi")).where("idx >= 1").withColumn("bin_idx", F.col("idx") - 1)
    w = Window.partitionBy("metric").orderBy("bin_idx")
    rows = rows.withColumn("prev_hi", F.when(F.col("bin_idx") == 0, F.lit(float("-inf"))).otherwise(F.lag("hi").over(w)))
    rows = rows.withColumn("hi", F.when(F.col("idx") == F.col("n") - 1, F.lit(float("inf"))).otherwise(F.col("hi")))
    last = F.col("n") - 1
    return rows.select("metric", "bin_idx", "prev_hi", "hi", (F.col("bin_idx") / last).alias("pct_lower"), ((F.col("bin_idx") + 1) / last).alias("pct_upper"), "is_negated")


def bin_of(value: Column, q: Column) -> Column:
    """Number of the bin (lower, upper] that holds the value: how many inner bounds are below it."""
    inner = F.slice(q, 2, F.size(q) - 2)
    return F.when(value.isNotNull() & ~F.isnan(value), F.size(F.filter(inner, lambda b: b < value)))


def score(rows: DataFrame, q: DataFrame, metrics: Sequence[str], spend: str = "total_txn_value_past_90") -> DataFrame:
    """rows with {metric}_percentile: the middle of its bin, 0 for merchants without spend, null for a null or NaN metric or spend.
    The bounds are one row of a few hundred numbers for each metric, broadcast whatever the size of rows."""
    bounds = q.where(F.col("metric").isin(*metrics)).groupBy().agg(F.map_from_entries(F.collect_list(F.struct("metric", F.struct("is_negated", "q")))).alias("__bounds"))
    out = rows.crossJoin(F.broadcast(bounds))
    for m in metrics:
        own, value = F.try_element_at(F.col("__bounds"), F.lit(m)), F.col(m).cast("double")
        value = F.when(own["is_negated"], -value).otherwise(value)
        bins = (F.size(own["q"]) - 1).cast("decimal(10,0)")
        middle = F.round((bin_of(value, own["q"]) * 2 + 1).cast("decimal(10,0)") / (bins * 2), 2).cast("double")
        out = out.withColumn(f"{m}_percentile", F.when(F.col(spend) == 0, 0.0).when(F.col(spend) != 0, middle))
    return out.drop("__bounds")


def rebuild_due(stored: DataFrame, latest_day: str) -> bool:
    """Whether the bins are of another quarter than the day before latest_day, or there are none."""
    last = stored.agg(F.max("generated_at").alias("d")).select(F.year("d").alias("y"), F.quarter("d").alias("q")).first()
    now = stored.sparkSession.range(1).select(F.date_sub(F.lit(latest_day).cast("date"), 1).alias("d")).select(F.year("d").alias("y"), F.quarter("d").alias("q")).first()
    return tuple(last) != tuple(now)


def propensity(rows: DataFrame, scorer, features: Sequence[str]) -> DataFrame:
    """rows with propensity_score (2 decimals) and its tier. scorer: columns → column, an expression or a pandas UDF; nulls
    among the numbers count as 0, as they do in training."""
    filled = rows.fillna(0)
    return filled.withColumn("propensity_score", F.round(scorer(*(F.col(f) for f in features)), 2)).withColumn("propensity_score_label", propensity_tier(F.col("propensity_score")))


def logistic(weights: Sequence[float], bias: float):
    """A scorer without Python: logistic regression as an expression."""
    return lambda *columns: 1 / (1 + F.exp(-(sum((c * w for c, w in zip(columns, weights)), F.lit(bias)))))
