"""Exact similarity join of names by their ratio 2 * LCS / (|a| + |b|), over an index of rare letter pairs.

With x and y letters and a common subsequence of length l, two names share at least 3l + 1 - x - y of their letter pairs (one pad
before, one behind, repeated pairs counted): a letter left out breaks two pairs, one put in breaks one. For a ratio of `percent`
that is a share of either name's pairs, so two such names meet in some pair among the rarest ones of each: only those are
joined. What meets must then have lengths that allow the ratio, enough pairs in common, and last the ratio itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import ALPHABET, let, letter_codes, letter_masks, plain_words, ratio

#: Letters of plain names with the pads; a pair of them is a number below PAIRS.
LETTERS = f"{ALPHABET}^$"
BASE = len(LETTERS) + 1
PAIRS = BASE * BASE


def plain_name(name: Column) -> Column:
    """A name as its ratio sees it: a-z, 0-9 and single spaces, words in order."""
    return plain_words(F.lower(name))


def letter_pairs(plain: Column) -> Column:
    """The number of each two neighbouring letters of ^name$; one more than the name has letters."""
    padded = F.concat(F.lit("^"), plain, F.lit("$"))
    at = lambda s, i: F.instr(F.lit(LETTERS), s.substr(i, F.lit(1)))
    return let(padded, lambda s: F.transform(F.sequence(F.lit(1), F.length(s) - 1), lambda i: at(s, i) * BASE + at(s, i + 1)))


def rarity(names: DataFrame) -> Column:
    """By pair its place in the order from the rarest to the most frequent among `names`. PAIRS counts at most are collected."""
    counts = {r["pair"]: r["count"] for r in names.select(F.explode(letter_pairs(F.col("name"))).alias("pair")).groupBy("pair").count().collect()}
    place = {pair: k for k, pair in enumerate(sorted(range(PAIRS), key=lambda p: (counts.get(p, 0), p)))}
    return F.lit([place[p] for p in range(PAIRS)])


def prefix_length(n: Column, percent: int) -> Column:
    """How many of the rarest of its n + 1 pairs a name has to show, so that all names of the ratio meet it."""
    # shared pairs >= (3p - 200) / 200 * (x + y) + 1 with y >= x * p / (200 - p), rounded up
    least = F.floor(((3 * percent - 200) * n + (200 - percent) - 1) / (200 - percent)) + 1
    return (n + 2 - least).cast("int")


def least_shared(x: Column, y: Column, percent: int) -> Column:
    return 3 * F.ceil((x + y) * percent / 200) + 1 - x - y


def indexed(names: DataFrame, order: Column, percent: int) -> DataFrame:
    """grp, name, n, pairs (rarest first, each with its count so far) of the distinct names with a letter."""
    ranked = F.array_sort(F.transform(letter_pairs(F.col("name")), lambda p: F.element_at(order, p + 1)))
    numbered = let(ranked, lambda s: F.transform(s, lambda r, i: r * 65536 + i + 1 - F.array_position(s, r)))
    return names.where("name <> ''").select("grp", "name").distinct().select("grp", "name", F.length("name").alias("n"), numbered.alias("pairs"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df shuffled by keys into as many partitions as the session has for shuffles. Spark merges small ones by their bytes; it leaves
    a number that is asked for, which is what a stage of many steps on short rows needs."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def similar_names(left: DataFrame, right: DataFrame, percent: int = 80) -> DataFrame:
    """grp, name, other, ratio of every two names of one group, from left and from right, whose ratio is `percent` or more (over 67).

    left and right: grp and name, names as plain_name() makes them. Null groups meet nothing; empty names are left out; repeated
    names count once. Spark splits the partitions of frequent pairs; the result has no pair twice.
    """
    if not 200 / 3 < percent <= 100:
        raise ValueError("letter pairs say something from a ratio of .67 on")
    order = rarity(right)
    a, b = indexed(left, order, percent), indexed(right, order, percent)
    shown = lambda d: d.select("grp", "name", "n", F.explode(F.slice("pairs", F.lit(1), prefix_length(F.col("n"), percent))).alias("pair"))
    x, y = F.col("n"), F.col("m")
    met = shown(a).join(shown(b).select("grp", "pair", F.col("name").alias("other"), F.col("n").alias("m")), ["grp", "pair"])
    met = met.where(percent * (x + y) <= 200 * F.least(x, y)).select("grp", "name", "other").distinct()
    own = a.withColumn("masks", letter_masks(F.col("name")))
    theirs = b.select("grp", F.col("name").alias("other"), F.col("n").alias("m"), F.col("pairs").alias("other_pairs"), letter_codes(F.col("name")).alias("codes"))
    full = spread(met.join(own, ["grp", "name"]), "grp", "other").join(theirs, ["grp", "other"])
    full = full.where(F.size(F.array_intersect("pairs", "other_pairs")) >= least_shared(x, y, percent))
    return full.select("grp", "name", "other", ratio(F.col("name"), F.col("other"), F.col("masks"), F.col("codes")).alias("ratio")).where(F.col("ratio") >= percent / 100)
