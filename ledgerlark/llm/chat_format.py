"""Chat formatting: logged snapshots of growing conversations are collapsed to the maximal ones, then rendered. DataFrame
functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved

KEY = ["h1", "h2", "h3"]
PART = 1 << 40  # sums of 2**23 parts fit a long


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """Turns in order with `pos` (from 1), the number of turns `n`, and the rolling hash h1-h3 of the turns up to each.

    Turns are ordered by turn (null first), role, text; rows of a conversation that repeat all three count once. The hash is
    three sums of 40 bits over (pos, role, text); nulls differ from empty strings.
    """
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    same = F.lit(True)
    for c in ("turn", "role", "text"):
        same = same & F.col(c).eqNullSafe(F.lag(c).over(order))
    rows = rows.withColumn("again", same & (F.row_number().over(order) > 1)).where(~F.col("again")).drop("again")
    rows = rows.withColumn("pos", F.row_number().over(order).cast("long"))
    hashed = lambda seed: F.pmod(F.xxhash64(F.lit(seed), "pos", F.col("role").isNull(), "role", F.col("text").isNull(), "text"), F.lit(PART))
    whole = Window.partitionBy("conv_id")
    return rows.select("*", *(F.sum(hashed(k)).over(order).alias(c) for k, c in enumerate(KEY, 1)), F.max("pos").over(whole).alias("n"))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of the conversations that no longer one begins with; of equal ones the smallest conv_id,
    n_copies is how many there are. Rows without conv_id are one conversation."""
    prefixes = saved(turn_prefixes(turns).select("conv_id", "pos", "n", *KEY), "prefixes")
    full = prefixes.where("pos = n").groupBy("n", *KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    begun = prefixes.where("pos < n").groupBy(F.col("pos").alias("n"), *KEY).agg(F.lit(1).alias("one"))
    return full.join(begun, ["n", *KEY], "left_anti").select("conv_id", F.col("n").alias("n_turns"), "n_copies")


def render(role, text):
    """One turn of the chat template; a null role is `unknown`, a null text empty."""
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("unknown")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("\n<|end|>\n"))


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies and the rendered text of every maximal conversation. A task holds a conversation at a time."""
    kept = saved(maximal_conversations(turns), "maximal")
    rows = turn_prefixes(turns).select("conv_id", "pos", "role", "text")
    known = kept.withColumnRenamed("conv_id", "kept_id")
    rows = rows.join(known, rows["conv_id"].eqNullSafe(known["kept_id"])).select("conv_id", "n_turns", "n_copies", "pos", render(F.col("role"), F.col("text")).alias("said"))
    lines = rows.groupBy("conv_id", "n_turns", "n_copies").agg(F.sort_array(F.collect_list(F.struct("pos", "said"))).alias("all"))
    return lines.select("conv_id", "n_turns", "n_copies", F.array_join(F.transform("all", lambda x: x["said"]), "").alias("text"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE_SQL = r"""
WITH d AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
t AS (
  SELECT conv_id, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
    '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10) AS said
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)),
p AS (SELECT conv_id, pos, n, string_agg(said, '' ORDER BY pos) OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS pre FROM t),
f AS (SELECT min(conv_id) AS conv_id, n, pre, count(*) AS n_copies FROM p WHERE pos = n GROUP BY n, pre)
SELECT conv_id, n AS n_turns, n_copies, pre AS text FROM f
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos < p.n AND p.pos = f.n AND p.pre = f.pre)
"""
