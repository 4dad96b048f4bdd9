"""Corpus pipeline: language ID, near-duplicate join, benchmark decontamination, mixing, token output.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps, with the columns of documents; the last returns the
token index. run() writes every stage as Parquet to the cluster's shared folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import decontaminate, lang_id, mixing, ngram_join, token_output
from ledgerlark.llm.common import saved, small, work_path

#: Near copies share this percentage of their shingles of so many words; op3's query has a rule of its own.
NEAR = {"size": 5, "percent": 80}
#: Ids of a token segment: half of the operator's own default, as executors come here with the memory of four stages before.
SEGMENT_IDS = 500_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that get a language; `und`, texts without a letter of any script, goes. Short clean texts may have a
    cosine near 0 with every language, so no cosine is a ground to reject. Where no row has a label the letters decide."""
    model = lang_id.fit_profiles(docs.where(lang_id.fold() != 2))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    known = lang_id.identify(docs, model)
    return known.where(F.col("lang_pred") != "und").select(*docs.columns)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies: the one with the smallest doc_id, a row without one only where none has an id.
    Rows are told apart by themselves, not by their doc_id: rows of one id with different texts are judged each by its own text,
    and of equal rows one stays. Rows without words are no copies and all stay."""
    rows, ids = docs.agg(F.count("*"), F.countDistinct("doc_id")).first()
    if rows == ids:  # each doc_id names one row
        groups = saved(ngram_join.join(docs, **NEAR), "groups")
        gone = saved(groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id"), "gone")
        return docs.join(small(gone), "doc_id", "left_anti").select(*docs.columns)
    own = "__row"
    keyed = saved(docs.withColumn(own, F.monotonically_increasing_id()), "rows")
    groups = ngram_join.join(keyed.select(F.col(own).alias("doc_id"), "text"), **NEAR).select(F.col("doc_id").alias(own), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(own)))
    kept = saved(keyed.select(own, "doc_id").join(groups, own).groupBy("component_id").agg(first.alias("first")).select(f"first.{own}"), "kept")
    return keyed.join(small(kept), own, "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in which no window of a benchmark item occurs."""
    found = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where("n_hit = 0").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the sample whose tokens follow the target weights of source, language and topic."""
    return mixing.mix(docs, keep_text=True).where("selected").select(*docs.columns)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token index of the documents left, read back from the segments: doc_id, start, n_tokens, ids_crc32."""
    return token_output.token_output(spark, docs, segment_ids=SEGMENT_IDS)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", join_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: SQL can't express the stages; tests compare each with a brute-force version.
ORACLE_SQL = None
