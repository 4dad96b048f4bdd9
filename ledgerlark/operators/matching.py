"""Rule-based matching of suppliers to master entities: hash cache, candidate blocking, scoring, the 15-rule cascade.

The cascade is evaluated at once: every candidate pair is tested under every rule and name variant, and the first passing
(rule, variant) with the best score wins by one windowed pick. Candidates are the pairs that can win: of alike names by
leading_pairs(), else by equi-joins on hashes of whole keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import matched_flag
from ..functions.similarity import boost, let, letter_codes, letter_masks, plain_address, ratio, with_address_similarity
from ..functions.text import (
    cleanse_name, city_match, dba_parts, filled, normalize_city, normalize_rows, normalize_text, postal_comparable, postal_match, request_hash, resolve_country)
from ..sources.tables import work_folder
from .leading_pairs import leading_pairs
from .similar_names import plain_name, spread

#: A name is fuzzily equal from this token-sort ratio.
FUZZY = 0.80
#: An address agrees from this similarity.
STREET = 0.80


@dataclass(frozen=True)
class Rule:
    """name: how the name must agree with (legal, dba): fuzzy, equal, starts, words, prefix, or none; place: further conditions."""

    number: int
    legal: str | None
    dba: str | None
    place: tuple[str, ...]
    least: float

    @property
    def label(self) -> str:
        return f"Filter_Rule{self.number}"

    @property
    def broad(self) -> bool:
        return self.number >= 10


# The rules in order with their least scores; all of them also ask for the same country.
RULES = [
    Rule(1, "fuzzy", "fuzzy", ("city", "postal", "street"), 0.80), Rule(2, "equal", "equal", ("city in", "state"), 0.80), Rule(3, "fuzzy", "fuzzy", ("city", "state"), 0.80),
    Rule(4, "fuzzy", "equal", ("city starts",), 0.75), Rule(5, "fuzzy", None, ("city",), 0.75), Rule(6, "fuzzy", "fuzzy", ("state",), 0.75), Rule(7, "fuzzy", "fuzzy", ("postal",), 0.75),
    Rule(8, None, "fuzzy", ("postal",), 0.50), Rule(9, None, None, ("street", "city"), 0.50), Rule(10, "equal", "equal", (), 0.70), Rule(11, None, "starts", (), 0.75),
    Rule(12, "fuzzy", "fuzzy", (), 0.0), Rule(13, None, "words", (), 0.0), Rule(14, "words", None, (), 0.0), Rule(15, "prefix", "prefix", (), 0.0),
]


def match_score(name: Column, address: Column, geo: Column, state: Column, broad: Column) -> Column:
    """Score of a pair from its name and address similarity and agreements; the first case that holds decides."""
    strong, partial, street = name >= 0.90, name >= 0.80, address >= 0.80
    capped = lambda base, most, *boosts: F.least(F.lit(base) + sum(boosts, F.lit(0.0)), F.lit(most))
    return (
        F.when(strong & street & geo, capped(0.85, 0.99, boost(name, 0.90, 0.05), boost(address, 0.80, 0.03)))
        .when(strong & geo, capped(0.80, 0.90, boost(name, 0.90, 0.05)))
        .when(partial & street & geo, capped(0.80, 0.90, boost(name, 0.80, 0.10)))
        .when(partial & geo, capped(0.75, 0.88, boost(name, 0.80, 0.15)))
        .when(strong & state, capped(0.80, 0.85, boost(name, 0.90, 0.10)))
        .when(strong, capped(0.80, 0.88, boost(name, 0.90, 0.05)))
        .when(partial, capped(0.65, 0.78, boost(name, 0.80, 0.15)))
        .when(broad, name).otherwise(0.0))


def name_agreements(name: Column, other: Column, ratio: Column) -> dict[str, Column]:
    """Every way a name can agree with another; ratio is their similarity."""
    other, name = F.lower(filled(other)), F.lower(filled(name))
    some, words = (name != "") & (other != ""), F.split(normalize_text(other), " ")
    return {
        "fuzzy": some & (ratio >= FUZZY), "equal": some & (name == other), "starts": some & other.startswith(name),
        "words": some & (F.size(F.array_except(F.split(normalize_text(name), " "), words)) == 0), "prefix": some & F.exists(F.split(other, r"\s+"), lambda w: w.startswith(name)),
    }


def place_agreements(own: dict[str, Column], entity: dict[str, Column], street: Column) -> dict[str, Column]:
    """Every further condition of the rules. Empty own fields meet none."""
    city, other_city = normalize_city(own["city"]), normalize_city(entity["city"])
    return {
        "city": city_match(own["city"], entity["city"]), "city in": (city != "") & other_city.contains(city), "city starts": (city != "") & other_city.startswith(city),
        "state": (filled(own["state"]) != "") & (F.lower(filled(own["state"])) == F.lower(filled(entity["state"]))), "postal": postal_match(own["postal_code"], entity["postal_code"], own["country"]), "street": street >= STREET,
    }


def rule_holds(rule: Rule) -> Column:
    """Whether a pair meets a rule, from its agreements as columns __legal, __dba and __place."""
    out = F.lit(True)
    if rule.legal or rule.dba:
        out = F.lit(False)
        for side, kind in (("__legal", rule.legal), ("__dba", rule.dba)):
            out = out | F.col(side)[kind] if kind else out
    for p in rule.place:
        out = out & F.col("__place")[p]
    return out


def variants(name: Column) -> Column:
    """The names to try for a name: (variant, name, suffix) for the full one, before and after `dba`, and the cleansed one; empty
    and repeated ones are left out."""
    before, after = dba_parts(name)
    names = [(name, ""), (before, "_DBA_Part1"), (after, "_DBA_Part2"), (cleanse_name(name), "_CleansedName")]
    cells = F.array(*(F.struct(F.lit(i).alias("variant"), filled(n).alias("name"), F.lit(s).alias("suffix")) for i, (n, s) in enumerate(names)))
    return let(cells, lambda c: F.filter(c, lambda x: (x["name"] != "") & ~F.exists(c, lambda y: (y["variant"] < x["variant"]) & (y["name"] == x["name"]))))


def name_variants(rows: DataFrame) -> DataFrame:
    """Each row once for each name to try."""
    return rows.withColumn("__v", F.explode(variants(F.col("norm_supplier_name")))).select("*", "__v.variant", F.col("__v.name").alias("tried_name"), F.col("__v.suffix").alias("suffix")).drop("__v")


def exact_keys(group: Column, keys: dict[str, Column]) -> Column:
    """Hashes of (group, kind, whole key) for arrays of keys by kind; empty and null keys are left out. A collision is a candidate
    more and changes no result."""
    def hashed(kind: str) -> Column:
        return F.transform(F.filter(keys[kind], lambda k: k != ""), lambda k: F.xxhash64(group, F.lit(kind), k))

    return F.array_distinct(F.concat(*map(hashed, keys)))


def prefixes(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: text.substr(F.lit(1), i))).otherwise(F.array().cast("array<string>"))


def request_keys(name: Column) -> dict[str, Column]:
    """A tried name whole, for names that equal it, start with it or have a word that does; its longest word, for those that hold
    all its words."""
    longest = F.array_max(F.transform(F.split(normalize_text(name), " "), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    whole = F.array(F.lower(name))
    return {"equal": whole, "starts": whole, "prefix": whole, "word": F.array(longest)}


def entity_keys(legal: Column, dba: Column) -> dict[str, Column]:
    """The same of an entity, by what the rules ask of each name: all prefixes of its dba name and of every word, whole names and words."""
    both = [filled(legal), filled(dba)]
    starts = F.flatten(F.transform(F.concat(*(F.split(F.lower(n), r"\s+") for n in both)), prefixes))
    return {"equal": F.array(*map(F.lower, both)), "starts": prefixes(F.lower(both[1])), "prefix": starts, "word": F.concat(*(F.split(normalize_text(n), " ") for n in both))}


def candidates(rows: DataFrame, entities: DataFrame, least: float | None = None) -> DataFrame:
    """(row_id, entity_id) once each, of one country: every pair that can be the cascade's choice for its row. Columns that are not
    there read as empty.

    Rules 1 to 10 and 12 ask for alike names, or equal ones, which are alike: leading_pairs() compares names and gives the pairs that
    no other comes before. The other ways to agree of rules 11 to 15 are equal keys, asked for rows that no rule up to 10 settles.
    Names without a Latin letter or digit, whose ratios say nothing, meet by equal keys only.
    """
    def of(df: DataFrame, column: str) -> Column:
        return filled(F.col(column)) if column in df.columns else F.lit("")

    def present(text: Column, value: Column) -> Column:
        return F.when(text != "", value)

    own, entity = (lambda c: of(rows, c)), (lambda c: of(entities, c))
    country = F.upper(own("norm_country")), F.upper(entity("country"))
    tried = F.transform(variants(F.col("norm_supplier_name")), lambda v: F.struct(v["variant"].alias("variant"), plain_name(v["name"]).alias("plain"), F.lower(v["name"]).alias("lower")))
    asked = rows.select(
        "row_id", country[0].alias("grp"), tried.alias("tried"), present(own("norm_city"), normalize_city(own("norm_city"))).alias("city"), F.lower(own("full_form_state")).alias("state"),
        postal_comparable(own("norm_postal_code"), own("norm_country")).alias("code"), present(own("norm_street_address"), plain_address(own("norm_street_address"))).alias("street"))
    asked = asked.withColumn("odd", F.exists("tried", lambda v: v["plain"] == ""))
    known = entities.select(
        "entity_id", country[1].alias("grp"), plain_name(entity("legal_name")).alias("legal"), plain_name(entity("dba_name")).alias("dba"), F.lower(entity("legal_name")).alias("legal_whole"), F.lower(entity("dba_name")).alias("dba_whole"),
        present(entity("city"), normalize_city(entity("city"))).alias("city"), F.lower(entity("state")).alias("state"), postal_comparable(entity("postal_code"), entity("country")).alias("code"),
        present(entity("street_address"), plain_address(entity("street_address"))).alias("street"))
    path = work_folder(rows.sparkSession, "leading")  # read twice, and written once
    leading_pairs(asked, known, RULES, floors(least), FUZZY).write.mode("overwrite").parquet(path)
    leading = rows.sparkSession.read.parquet(path)
    open_rows = name_variants(rows.join(leading.where("settled").select("row_id").distinct(), "row_id", "left_anti")).select("row_id", F.upper(filled(F.col("norm_country"))).alias("grp"), "tried_name")
    a = open_rows.select("row_id", F.explode(exact_keys(F.col("grp"), request_keys(F.col("tried_name")))).alias("k")).distinct()
    b = entities.select("entity_id", F.explode(exact_keys(country[1], entity_keys(F.col("legal_name"), F.col("dba_name")))).alias("k"))
    return spread(leading.select("row_id", "entity_id").unionByName(a.join(b, "k").select("row_id", "entity_id")), "row_id", "entity_id").distinct()


def floors(least: float | None) -> list[float]:
    """The least score of each rule, where none below `least` counts."""
    return [r.least if least is None else max(r.least, least) for r in RULES]


def cascade(rows: DataFrame, entities: DataFrame, least: float | None = None) -> DataFrame:
    """One row a row_id: entity_id, matched_score, matched_rule and successful, `no_match`, 0 and N where no rule gives a match.

    rows: row_id and the norm_ fields, full_form_state; entities: entity_id, legal_name, dba_name, street_address, city, state,
    postal_code, country. Of equal scores under one rule and variant the smallest entity_id wins.
    """
    # what depends on one side only is made before the pairs: plain names, codes, masks
    tried = F.transform(variants(F.col("norm_supplier_name")), lambda v: let(plain_name(v["name"]), lambda n: F.struct(v["variant"].alias("variant"), v["name"].alias("name"), v["suffix"].alias("suffix"), n.alias("plain"), letter_masks(n).alias("masks"))))
    known = entities.select("entity_id", *(F.col(c).alias(f"e_{c}") for c in ("legal_name", "dba_name", "street_address", "city", "state", "postal_code", "country")))
    sides = [let(plain_name(filled(F.col(f"e_{s}_name"))), lambda n: F.struct(n.alias("plain"), letter_codes(n).alias("codes"))) for s in ("legal", "dba")]
    pairs = (candidates(rows, entities) if least is None else candidates(rows, entities, least)).join(rows.withColumn("__tried", tried), "row_id").join(known.withColumn("__sides", F.array(*sides)), "entity_id")
    pairs = pairs.where(F.upper(filled(F.col("norm_country"))) == F.upper(filled(F.col("e_country"))))
    own = {"city": F.col("norm_city"), "state": F.col("full_form_state"), "postal_code": F.col("norm_postal_code"), "country": F.col("norm_country")}
    entity = {"city": F.col("e_city"), "state": F.col("e_state"), "postal_code": F.col("e_postal_code")}
    geo = city_match(own["city"], entity["city"]) | postal_match(own["postal_code"], entity["postal_code"], own["country"])
    state = F.lower(filled(own["state"])) == F.lower(filled(entity["state"]))  # two empty states agree
    packed = lambda found: F.struct(*(c.alias(k) for k, c in found.items()))
    # each similarity and agreement is one column, which all rules share

    def ratios(v: Column) -> Column:
        """A name to try with its ratios to both names; one without a Latin letter or digit is like any other."""
        both = F.when(v["plain"] == "", F.array(F.lit(1.0), F.lit(1.0))).otherwise(F.transform("__sides", lambda x: ratio(v["plain"], x["plain"], v["masks"], x["codes"])))
        return let(both, lambda r: F.struct(v["variant"].alias("variant"), v["name"].alias("tried_name"), v["suffix"].alias("suffix"), F.array_max(r).alias("__name"), r[0].alias("__legal_ratio"), r[1].alias("__dba_ratio")))

    pairs = pairs.withColumn("__tested", F.transform("__tried", ratios)).drop("__tried", "__sides")
    # the address counts from STREET on, and only in scores of alike names at one place: rules 1 and 9 have no other
    pairs = with_address_similarity(pairs, "__street", F.col("norm_street_address"), F.col("e_street_address"), STREET, geo & F.exists("__tested", lambda v: v["__name"] >= FUZZY))
    pairs = pairs.withColumn("__v", F.explode("__tested")).select("*", "__v.*")
    pairs = pairs.withColumns({
        "__geo": geo, "__state": state, "__place": packed(place_agreements(own, entity, F.col("__street"))),
        **{f"__{s}": packed(name_agreements(F.col("tried_name"), F.col(f"e_{s}_name"), F.col(f"__{s}_ratio"))) for s in ("legal", "dba")}})
    found = F.struct("__name", "__street", "__geo", "__state", "__place", "__legal", "__dba")
    pairs = pairs.select("row_id", "entity_id", "variant", "suffix", F.explode(F.array(found)).alias("__k")).select("*", "__k.*")  # a generator: else the optimizer copies each agreement into every rule
    pairs = pairs.withColumns({f"__score_{b}": match_score(F.col("__name"), F.col("__street"), F.col("__geo"), F.col("__state"), F.lit(b == "broad")) for b in ("broad", "narrow")})
    tried = []
    for r, floor in zip(RULES, floors(least)):
        score = F.col("__score_broad" if r.broad else "__score_narrow")
        tried.append(F.when(rule_holds(r) & (score > 0) & (score >= floor), F.struct(F.lit(r.number).alias("rule"), score.alias("score"))))
    hits = pairs.withColumn("__hit", F.explode(F.array_compact(F.array(*tried)))).select("row_id", "entity_id", "variant", "suffix", F.col("__hit.rule").alias("rule"), F.col("__hit.score").alias("score"))
    w = Window.partitionBy("row_id").orderBy("rule", "variant", F.col("score").desc(), "entity_id")
    best = hits.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").select("row_id", "entity_id", F.col("score").alias("matched_score"), F.concat(F.lit("Filter_Rule"), F.col("rule").cast("string"), F.col("suffix")).alias("matched_rule"))
    return rows.select("row_id").join(best, "row_id", "left").select(
        "row_id", "entity_id", F.coalesce("matched_score", F.lit(0.0)).alias("matched_score"), F.coalesce("matched_rule", F.lit("no_match")).alias("matched_rule"), F.when(F.col("entity_id").isNotNull(), "Y").otherwise("N").alias("successful"))


def cache_lookup(requests: DataFrame, cache: DataFrame, as_of: str, days: int = 7) -> tuple[DataFrame, DataFrame]:
    """(hits, misses): requests beside the newest cached row of their hash that isn't older than `days` days, and the rest."""
    fresh = cache.where(F.col("audit_ts") >= F.date_sub(F.lit(as_of).cast("date"), days)).join(requests.select("request_hash").distinct(), "request_hash", "left_semi")
    newest = fresh.withColumn("__rn", F.row_number().over(Window.partitionBy("request_hash").orderBy(F.col("audit_ts").desc(), "entity_id"))).where("__rn = 1").drop("__rn")
    return requests.join(newest, "request_hash"), requests.join(newest, "request_hash", "left_anti")


def accept(matches: DataFrame, least: float = 0.80) -> DataFrame:
    """Matches with an entity and a score of at least `least`."""
    return matches.where((filled(F.col("entity_id")) != "") & (F.col("matched_score") >= least))


def hybrid_match(rows: DataFrame, entities: DataFrame, cache: DataFrame, as_of: str, days: int = 7) -> tuple[DataFrame, DataFrame]:
    """(results, new cache rows) for rows with row_id and request_hash: cached answers, the cascade for the others."""
    hits, misses = cache_lookup(rows, cache.select("request_hash", "entity_id", "matched_score", "matched_rule", "audit_ts"), as_of, days)
    found = cascade(misses, entities).join(misses.select("row_id", "request_hash"), "row_id")
    columns = ["row_id", "entity_id", "matched_score", "matched_rule", "request_hash"]
    results = hits.select(*columns).unionByName(found.select(*columns)).withColumn("successful", matched_flag(F.col("entity_id")))
    return results, found.where(F.col("entity_id").isNotNull()).select("request_hash", "entity_id", "matched_score", "matched_rule")


REQUEST = ("norm_supplier_name", "norm_street_address", "norm_city", "norm_state", "norm_postal_code", "norm_country")


def match_suppliers(rows: DataFrame, entities: DataFrame, cache: DataFrame, names: DataFrame, aliases: DataFrame, as_of: str, days: int = 7, least: float | None = None) -> tuple[DataFrame, DataFrame]:
    """hybrid_match() from raw supplier rows: countries resolved, fields normalised, hash and row_id made of them. Rows that read
    the same once normalised are asked once; results come back for every row, by supplier_id. least: only matches from this
    score on count, the others read as unmatched."""
    ready = normalize_rows(resolve_country(rows, "country", names, aliases)).withColumn("request_hash", request_hash(*map(F.col, REQUEST))).withColumn("row_id", F.col("request_hash"))
    asked = ready.dropDuplicates(["request_hash"])
    results, fresh = hybrid_match(asked, entities, cache, as_of, days)
    if least is not None:
        good = accept(results, least).select("row_id").withColumn("__good", F.lit(True))
        results = results.join(good, "row_id", "left").select(
            "row_id", F.when(F.col("__good"), F.col("entity_id")).otherwise("").alias("entity_id"), F.when(F.col("__good"), F.col("matched_score")).otherwise(0.0).alias("matched_score"), "matched_rule", "request_hash",
            F.when(F.col("__good"), "Y").otherwise("N").alias("successful"))
    back = results.select("request_hash", "entity_id", "matched_score", "matched_rule", "successful")
    return ready.select("supplier_id", "request_hash").join(back, "request_hash"), fresh
