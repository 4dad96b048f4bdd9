"""Data selection by importance resampling: two generative models of hashed n-grams, one of target text and one of all
text; a document's weight is the ratio of its probabilities, and the Gumbel top-k of log weights is a sample without
replacement in proportion to the weights."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_BYTES, byte_class, fmix, mapped, mb_slices, saved, small, text_bytes, words


def buckets_of(raw: np.ndarray, offsets: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash bucket and row of every word and every pair of adjacent words."""
    hashes, _, _, ends = words(raw, offsets, byte_class("alnum"))
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(ends))
    pair = owner[1:] == owner[:-1]
    both = fmix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])[pair]
    found = np.concatenate([hashes, both]) % np.uint64(n_buckets)
    return found.astype(np.int64), np.concatenate([owner, owner[1:][pair]])


def fit_ratio(docs: DataFrame, is_target: str, text: str = "text", n_buckets: int = 10_000) -> np.ndarray:
    """log p(bucket | target) - log p(bucket | all text), with one added to every count; counts cover all rows of docs."""
    rows = docs.select(F.col(text).cast("string").alias("text"), F.coalesce(F.col(is_target), F.lit(False)).alias("target"))

    def run(batches):
        import pyarrow as pa

        counts = np.zeros((2, n_buckets), np.int64)
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            target = np.array(batch.column("target").to_pylist(), dtype=bool)
            for i, j in mb_slices(offsets):
                b, owner = buckets_of(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n_buckets)
                counts[0] += np.bincount(b, minlength=n_buckets)
                counts[1] += np.bincount(b[target[i:j][owner]], minlength=n_buckets)
        at = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_pydict({"bucket": at, "raw": counts[0, at], "target": counts[1, at]})

    made = np.ones((2, n_buckets))
    for r in mapped(rows, run, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        made[:, r["bucket"]] += r["raw"], r["target"]
    made /= made.sum(axis=1, keepdims=True)
    return np.log(made[1]) - np.log(made[0])


def score(docs: DataFrame, ratio: np.ndarray, text: str = "text") -> DataFrame:
    """docs without text, with n_grams and log_weight; null, empty and wordless texts have 0 n-grams and a null weight."""
    added = ["n_grams", "log_weight"]
    rows = docs.drop(*added).withColumn(text, F.col(text).cast("string"))
    kept = [f for f in rows.schema.fields if f.name != text]
    out = T.StructType([*kept, T.StructField("n_grams", T.LongType()), T.StructField("log_weight", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches):
        import pyarrow as pa

        known = shared.value
        for batch in batches:
            raw, offsets = text_bytes(batch.column(text))
            n, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for i, j in mb_slices(offsets):
                b, owner = buckets_of(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], len(known))
                n[i:j] = np.bincount(owner, minlength=j - i)
                total[i:j] = np.bincount(owner, weights=known[b], minlength=j - i)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(n), pa.array(total, mask=n == 0)], [*(f.name for f in kept), *added])

    return mapped(rows, run, out)


def kth_largest(df: DataFrame, column: str, k: int, few: int = 10_000) -> float | None:
    """The k-th largest value, by counting in ever finer bins until `few` rows or one value remain; null for an empty frame."""
    values = df.select(F.col(column).alias("v")).where("v is not null")
    while True:
        low, high, n = values.agg(F.min("v"), F.max("v"), F.count("v")).first()
        if not n:
            return None
        if low == high or k >= n:
            return low
        if n <= few:
            return values.orderBy(F.col("v").desc()).limit(k).agg(F.min("v")).first()[0]
        width = (high - low) / 1024
        counts = dict(values.groupBy(F.least(F.lit(1023), F.floor((F.col("v") - low) / width)).alias("bin")).count().collect())
        for b in sorted(counts, reverse=True):
            if k <= counts[b]:
                break
            k -= counts[b]
        values = values.where(F.least(F.lit(1023), F.floor((F.col("v") - low) / width)) == b)


def resample(scored: DataFrame, keep: float = 0.75, seed: int = 11) -> DataFrame:
    """scored with gumbel_key and selected: the ceil(keep * n) largest of log_weight plus Gumbel noise, n the rows with a weight.

    The noise is a hash of doc_id and the seed, so a rerun draws the same sample. Rows tied with the last are selected too.
    """
    u = (F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    rows = saved(scored.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(u))), "scored")
    n = rows.where("log_weight is not null").count()
    last = kth_largest(rows, "gumbel_key", max(1, -(-int(n * keep * 1_000_000) // 1_000_000))) if n else None
    return rows.withColumn("selected", F.coalesce(F.col("gumbel_key") >= F.lit(last), F.lit(False)) if last is not None else F.lit(False))


def select_quality(docs: DataFrame, labels: DataFrame, keep: float = 0.75, n_buckets: int = 10_000, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_grams, log_weight, gumbel_key and selected of every document; the target model learns from documents with a
    label of quality 1. Label ids are broadcast up to `broadcast_bytes`, else joined with a shuffle."""
    good = small(saved(labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct().withColumn("is_target", F.lit(True)), "targets"), broadcast_bytes)
    rows = docs.select("doc_id", "text")
    ratio = fit_ratio(rows.join(good, "doc_id", "left"), "is_target", n_buckets=n_buckets)
    return resample(score(rows, ratio), keep)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
