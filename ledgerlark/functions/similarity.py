"""String similarity. Ratios are 2 * LCS / (|a| + |b|), the longest common subsequence counted bit-parallel (Hyyro 2004), as
expressions; one Arrow function slides the shorter address along the longer, for the rows that still need it."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import remove_special

NOISE = ("po box", "unit")
#: Letters of the shorter text that fit one word of the bit-parallel count: the sum of two such words is still a long.
WORD = 62


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def letters(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.split(text, "")).otherwise(F.array().cast("array<string>"))


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))


def _masks(short: Column, first: Column, last: Column) -> Column:
    """By letter the places in short[first, last) as bits."""
    zero = F.lit(0).cast("long")

    def mask(letter: Column) -> Column:
        return F.aggregate(F.transform(short, lambda c, i: F.when((c == letter) & (i >= first) & (i < last), _bit(i - first)).otherwise(zero)), zero, lambda x, y: x.bitwiseOR(y))

    return F.map_from_entries(F.transform(F.array_distinct(short), lambda letter: F.struct(letter.alias("k"), mask(letter).alias("v"))))


#: Letters of plain names and addresses; a letter's code is its place here, from 1 on.
ALPHABET = " 0123456789abcdefghijklmnopqrstuvwxyz"


def letter_codes(text: Column) -> Column:
    """The codes of the letters of a plain text."""
    return F.transform(letters(text), lambda c: F.instr(F.lit(ALPHABET), c))


def letter_masks(text: Column) -> Column:
    """What coded_lcs() needs of the plain text it counts against: by code its places as bits; null beyond WORD letters."""
    zero = F.lit(0).cast("long")
    mask = lambda s, k: F.aggregate(F.transform(s, lambda c, i: F.when((c == k) & (k > 0), _bit(i)).otherwise(zero)), zero, lambda x, y: x.bitwiseOR(y))
    return let(letter_codes(text), lambda s: F.when(F.size(s) <= WORD, F.transform(F.sequence(F.lit(0), F.lit(len(ALPHABET))), lambda k: mask(s, k))))


def _count_rises(n: Column, steps: Column) -> Column:
    """LCS of a text of n letters and another, by the places as bits of each letter of the other. State: a bit for each of the n, 0
    where the count rises; each letter adds the state's bits at its places, so that carries move the rises down."""
    full = _bit(n) - 1
    step = lambda v, m: (v + v.bitwiseAND(m)).bitwiseOR(v.bitwiseAND(F.bitwise_not(m))).bitwiseAND(full)
    return n - F.bit_count(F.aggregate(steps, full, step))


def coded_lcs(masks: Column, n: Column, codes: Column) -> Column:
    """Length of the longest common subsequence of a plain text of n letters with these masks and the one of these codes."""
    return _count_rises(n, F.transform(codes, lambda c: masks[c]))


def _many_words_lcs(short: Column, n: Column, others: Column) -> Column:
    """The same for texts of any length: the state is an array of words, and each hands its carry to the next."""
    zero, words = F.lit(0).cast("long"), F.sequence(F.lit(0), F.floor((n - 1) / WORD).cast("int"))
    start = F.struct(F.array().cast("array<long>").alias("out"), zero.alias("carry"))

    def add(x: Column) -> Column:
        total = x["v"] + x["v"].bitwiseAND(x["m"]) + x["carry"]
        kept = total.bitwiseOR(x["v"].bitwiseAND(F.bitwise_not(x["m"]))).bitwiseAND(x["full"])
        return F.struct(F.concat(x["out"], F.array(kept)).alias("out"), F.call_function("shiftright", total, F.lit(WORD)).alias("carry"))

    def fold(t: Column) -> Column:
        def step(v: Column, c: Column) -> Column:
            one = lambda acc, i: let(F.struct(acc["out"].alias("out"), acc["carry"].alias("carry"), v[i].alias("v"), F.coalesce(F.try_element_at(t["masks"][i], c), zero).alias("m"), t["full"][i].alias("full")), add)
            return F.aggregate(words, start, one, lambda acc: acc["out"])

        return n - F.aggregate(F.aggregate(others, t["full"], step), F.lit(0), lambda x, w: x + F.bit_count(w))

    masks, full = F.transform(words, lambda w: _masks(short, w * WORD, (w + 1) * WORD)), F.transform(words, lambda w: _bit(F.least(F.lit(WORD), n - w * WORD)) - 1)
    return let(F.struct(masks.alias("masks"), full.alias("full")), fold)


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two texts of any length."""
    def count(s: Column) -> Column:
        one = let(_masks(s["short"], F.lit(0), s["n"]), lambda m: _count_rises(s["n"], F.transform(s["long"], lambda c: F.coalesce(F.try_element_at(m, c), F.lit(0).cast("long")))))
        return F.when(s["n"] == 0, 0).when(s["n"] <= WORD, one).otherwise(_many_words_lcs(s["short"], s["n"], s["long"]))

    swap = F.length(a) > F.length(b)
    pair = F.struct(letters(F.when(swap, b).otherwise(a)).alias("short"), letters(F.when(swap, a).otherwise(b)).alias("long"), F.least(F.length(a), F.length(b)).alias("n"))
    return let(pair, count)


def ratio(a: Column, b: Column, masks: Column | None = None, codes: Column | None = None) -> Column:
    """2 * LCS / (|a| + |b|); 1 if both are empty. masks and codes: letter_masks(a) and letter_codes(b), where they are at hand."""
    size, common = F.length(a) + F.length(b), lcs_length(a, b)
    if masks is not None:
        common = F.when(masks.isNotNull(), coded_lcs(masks, F.length(a), codes)).otherwise(common)
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(2 * common / size)


def sorted_words(text: Column) -> Column:
    return F.array_join(F.array_sort(F.split(text, " ")), " ")


def plain_words(name: Column) -> Column:
    """Special characters removed, words in order."""
    return sorted_words(remove_special(name))


def name_similarity(name: Column, legal: Column, other: Column) -> Column:
    """The higher token-sort ratio with the legal and the other name, special characters removed."""
    return let(plain_words(name), lambda n: F.array_max(F.transform(F.array(legal, other), lambda o: let(plain_words(o), lambda x: ratio(n, x)))))


def token_set_ratio(a: Column, b: Column) -> Column:
    """Best ratio among the shared tokens and each side's, of texts with single spaces; 1 if one side's tokens are all shared; 0 if
    either has none. Both sides start with the shared tokens, so only the rest is compared letter by letter."""

    def compare(s: Column) -> Column:
        shared, one, two = (F.array_join(F.array_sort(x), " ") for x in (F.array_intersect(s["x"], s["y"]), F.array_except(s["x"], s["y"]), F.array_except(s["y"], s["x"])))

        def best(t: Column) -> Column:
            n, x, y = F.length(t["shared"]), F.length(t["one"]), F.length(t["two"])
            lead = F.when(n > 0, n + 1).otherwise(0)
            whole = 2 * (lead + lcs_length(t["one"], t["two"])) / (2 * lead + x + y)
            parts = F.when(n > 0, 2 * n / (2 * n + 1 + F.least(x, y))).otherwise(0.0)
            return F.when((n > 0) & ((x == 0) | (y == 0)), 1.0).otherwise(F.greatest(whole, parts))

        return F.when((F.size(s["x"]) == 0) | (F.size(s["y"]) == 0), 0.0).otherwise(let(F.struct(shared.alias("shared"), one.alias("one"), two.alias("two")), best))

    tokens = lambda c: F.array_remove(F.array_distinct(F.split(c, " ")), "")
    return let(F.struct(tokens(a).alias("x"), tokens(b).alias("y")), compare)


def bag(text: Column) -> Column:
    """The letters of a text, each with its count so far: the intersection of two such sets is the one of the bags of letters."""
    return let(F.array_sort(letters(text)), lambda s: F.transform(s, lambda c, i: F.concat(c, (i + 1 - F.array_position(s, c)).cast("string"))))


def partial_bound(a: Column, b: Column) -> Column:
    """What no stretch of the longer text can exceed: with m letters in common, 2m / (|shorter| + m)."""
    shared = F.size(F.array_intersect(bag(a), bag(b)))
    return let(shared, lambda m: F.when(m == 0, 0.0).otherwise(2 * m / (F.least(F.length(a), F.length(b)) + m)))


def lcs(a: str, b: str) -> int:
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = state = (1 << len(a)) - 1
    for ch in b:
        u = state & masks.get(ch, 0)
        state = ((state + u) | (state - u)) & full
    return len(a) - state.bit_count()


def partial_ratio(a: str, b: str, over: float = 0.0) -> float:
    """Best ratio of the shorter text with any stretch of the longer one of its length, or shorter at the ends; `over` if none is
    above it. Stretches are tried by what their letters in common allow, which one more step of the window changes by two letters."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return max(over, float(not b))
    best = over
    for x, y in ((a, b), (b, a)) if len(a) == len(b) else ((a, b),):
        need, here, common, tried = Counter(x), Counter(), 0, []
        for start in range(1 - len(x), len(y)):
            come, gone = start + len(x) - 1, start - 1
            if come < len(y):
                here[y[come]] += 1
                common += here[y[come]] <= need[y[come]]
            if gone >= 0:
                common -= here[y[gone]] <= need[y[gone]]
                here[y[gone]] -= 1
            low, high = max(0, start), min(len(y), start + len(x))
            tried.append((2 * common / (len(x) + high - low), low, high))
        for bound, low, high in sorted(tried, reverse=True):
            if bound <= best:
                break
            best = max(best, 2 * lcs(x, y[low:high]) / (len(x) + high - low))
    return best


def token_set(a: str, b: str) -> float:
    """token_set_ratio() of two texts."""
    x, y = ({t for t in s.split(" ") if t} for s in (a, b))
    if not x or not y:
        return 0.0
    shared, one, two = (" ".join(sorted(t)) for t in (x & y, x - y, y - x))
    if shared and not (one and two):
        return 1.0
    lead = len(shared) + 1 if shared else 0
    whole = 2 * (lead + lcs(one, two)) / (2 * lead + len(one) + len(two))
    return max(whole, 2 * len(shared) / (2 * len(shared) + 1 + min(len(one), len(two))) if shared else 0.0)


def _without_noise(a: str, b: str) -> tuple[str, str]:
    for word in NOISE:
        if word in a and word in b:
            a, b = (" ".join(t.replace(word, " ", 1).split()) for t in (a, b))
    return a, b


def address_value(a: str, b: str) -> float:
    """address_similarity() of two plain addresses."""
    a, b = _without_noise(a, b)
    return partial_ratio(a, b, token_set(a, b))


@F.pandas_udf(T.DoubleType())
def _partial_ratio(a: pd.Series, b: pd.Series, over: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else partial_ratio(x, y, o) for x, y, o in zip(a, b, over)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _quiet_partial_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([partial_ratio(*_without_noise(x, y)) for x, y in zip(a, b)], dtype="float64")


def plain_address(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9\s]", " "), r"\s+", " "))


def without_noise(a: Column, b: Column) -> tuple[Column, Column]:
    """Both plain addresses without the first of each noise word that stands in both."""
    for word in NOISE:
        both = a.contains(word) & b.contains(word)
        cut = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, rf"^(.*?){word}", "$1 "), r"\s+", " "))  # noqa: B023, E731
        a, b = F.when(both, cut(a)).otherwise(a), F.when(both, cut(b)).otherwise(b)
    return a, b


def _quiet_tokens(s: Column) -> Column:
    x, y = without_noise(s["x"], s["y"])
    return let(F.struct(x.alias("x"), y.alias("y")), lambda t: token_set_ratio(t["x"], t["y"]))


def address_similarity(a: Column, b: Column) -> Column:
    """The higher of token-set and partial ratio without shared noise words; 0 if either is empty."""
    some = (F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "")
    x, y = plain_address(a), plain_address(b)
    return F.when(some, F.greatest(let(F.struct(x.alias("x"), y.alias("y")), _quiet_tokens), _quiet_partial_ratio(x, y))).otherwise(0.0)


def with_address_similarity(df: DataFrame, name: str, a: Column, b: Column, least: float, wanted: Column) -> DataFrame:
    """df with address_similarity(a, b) as column `name`, 0 where `wanted` isn't true; what is below `least` may come out lower than
    it is. Letters in common bound the sliding ratio, and it is computed only where it could still raise the result to `least`:
    `slides` of the struct column `name`__steps, which is kept so that this can be counted."""
    some = (F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "") & F.coalesce(wanted, F.lit(False))

    def cleaned(s: Column) -> Column:
        x, y = without_noise(s["x"], s["y"])
        return let(F.struct(x.alias("x"), y.alias("y")), lambda t: let(F.struct(t["x"].alias("x"), t["y"].alias("y"), token_set_ratio(t["x"], t["y"]).alias("tokens")), bounded))

    def bounded(s: Column) -> Column:
        empty = F.length(s["x"]) + F.length(s["y"]) == 0  # two empty texts are alike
        slides = F.when(s["tokens"] >= 1, False).otherwise(empty | let(partial_bound(s["x"], s["y"]), lambda m: (m > s["tokens"]) & (m >= least)))
        return F.struct(s["x"].alias("x"), s["y"].alias("y"), s["tokens"].alias("tokens"), slides.alias("slides"))

    steps = f"{name}__steps"
    # a column of its own, read more than once: Python functions take no argument with a lambda inside
    df = df.withColumn(steps, F.when(some, let(F.struct(plain_address(a).alias("x"), plain_address(b).alias("y")), cleaned)))
    x, y = (F.when(F.col(f"{steps}.slides"), F.col(f"{steps}.{c}")) for c in ("x", "y"))
    return df.withColumn(name, F.coalesce(F.greatest(F.col(f"{steps}.tokens"), _partial_ratio(x, y, F.coalesce(f"{steps}.tokens", F.lit(0.0)))), F.lit(0.0)))


def boost(value: Column, threshold: float, weight: float) -> Column:
    """0 below the threshold, rising to `weight` at 1."""
    return F.when(value < threshold, 0.0).otherwise(weight * (value - threshold) / (1.0 - threshold))
