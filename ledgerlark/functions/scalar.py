"""Scalar expressions: amounts, tiers, dates, identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def zero(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0))


def ticket_average(amount: Column, count: Column) -> Column:
    """amount / count, null for a count of 0."""
    return F.when(count != 0, amount / count)


def method_is(method: Column, *names: str) -> Column:
    return F.lower(method).isin(*names)


def method_is_other(method: Column, *known: str) -> Column:
    """Neither of the known methods, or no method."""
    return method.isNull() | ~F.lower(method).isin(*known)


def next_payment_date(ingested: Column, term_days: Column) -> Column:
    return F.when(term_days.isNotNull(), F.date_add(ingested.cast("date"), term_days.cast("int")))


def confidence_tier(score: Column) -> Column:
    """High from .75, Medium from .70, else (also without score) Low."""
    return F.when(score >= 0.75, "High").when(score >= 0.70, "Medium").otherwise("Low")


def propensity_tier(score: Column) -> Column:
    """HIGH above .7, MEDIUM above .6, else LOW; for a score that is rounded already."""
    return F.when(score > 0.7, "HIGH").when(score > 0.6, "MEDIUM").otherwise("LOW")


def quarter_label(day: Column) -> Column:
    return F.when(day.isNotNull(), F.concat_ws("_", F.year(day), F.quarter(day)))


def months_since(as_of: Column, day: Column) -> Column:
    return F.months_between(as_of, day).cast("int")


def history_flag(any_date: Column, own_date: Column) -> Column:
    """Null without any transaction, YES with one of the kind, else NO."""
    return F.when(any_date.isNull(), F.lit(None).cast("string")).when(own_date.isNotNull(), "YES").otherwise("NO")


def card_acceptor(recency: Column, ids: Column) -> Column:
    """Null without recency, YES with an id text that isn't empty, else NO."""
    return F.when(recency.isNull(), F.lit(None).cast("string")).when(F.coalesce(ids, F.lit("")) != "", "YES").otherwise("NO")


def base62_8(number: Column) -> Column:
    """The last eight base-62 digits (digits, capitals, small letters), left-padded with 0; 0 and negative give eight zeros."""
    n = F.greatest(number.cast("long"), F.lit(0).cast("long"))
    # every digit from the number itself: chained remainders name each other and double the expression with each digit
    digit = lambda k: F.lit(BASE62).substr((F.call_function("div", n, F.lit(62**k).cast("long")) % 62 + 1).cast("int"), F.lit(1))
    return F.when(number.isNull(), F.lit("")).otherwise(F.concat(*map(digit, reversed(range(8)))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; null if either is null, 0 if a norm is 0, null for unequal lengths."""
    fold = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    dot = fold(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))
    norm = lambda x: F.sqrt(fold(F.transform(x, lambda v: v.cast("double") * v.cast("double"))))
    both = norm(a) * norm(b)
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when(both == 0, 0.0).otherwise(dot / both)


def unit(a: Column) -> Column:
    """The vector over its length; null for a null or zero one."""
    norm = F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.when(norm > 0, F.transform(a, lambda x: x.cast("double") / norm))


def dot(a: Column, b: Column) -> Column:
    """Inner product; of unit vectors their cosine."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def best_name(legal_score: Column, other_score: Column, legal: Column, other: Column) -> Column:
    """The legal name if its score is strictly higher, else the other."""
    return F.when(legal_score > other_score, legal).otherwise(other)


def percentile_midpoint(bin_index: Column, bins: int = 100) -> Column:
    """Middle of a bin of equal shares, from integers and rounded to 2: bin 0 of 100 gives .01."""
    return F.round((bin_index * 2 + 1).cast("decimal(10,0)") / F.lit(2 * bins).cast("decimal(10,0)"), 2).cast("double")


def matched_flag(entity_id: Column) -> Column:
    return F.when(F.coalesce(entity_id, F.lit("")) != "", "Y").otherwise("N")
