"""Reading nested entity JSON: attributes are lists of {"value": ...}, of which the first counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import normalize_state


def attribute(json: Column, *path: str) -> Column:
    """The text at a path, the first element taken wherever a list stands; empty for what isn't there or isn't text."""
    options = ["$"]
    for key in path:
        options = [f"{o}.{key}" if o == "$" else f"{o}{'' if o.endswith('.value') and key != 'value' else '[0]'}.{key}" for o in options]
    found = F.coalesce(*(F.get_json_object(json, f"{o}{t}") for o in options for t in ("[0].value", ".value", "[0]", "")))
    return F.when(found.rlike(r"^\s*[\[{]"), "").otherwise(F.coalesce(found, F.lit("")))


SIC = "array<struct<value:struct<Type:array<struct<value:string>>,Code:array<struct<lookupCode:string>>>>>"


def sic8(json: Column) -> Column:
    """Code of the first SIC entry of type SIC8."""
    entries = F.filter(F.from_json(F.get_json_object(json, "$.SIC"), SIC), lambda x: F.try_element_at(x["value"]["Type"], F.lit(1))["value"] == "SIC8")
    return F.coalesce(F.try_element_at(F.try_element_at(entries, F.lit(1))["value"]["Code"], F.lit(1))["lookupCode"], F.lit(""))


def best_rule(relevance: Column) -> Column:
    """struct(score, rule) of a map rule → (uri → score): the first uri's score counts, the highest above 0 wins, the first rule
    of equal ones."""
    first = F.transform(F.map_entries(relevance), lambda e: F.struct(F.coalesce(F.try_element_at(F.map_values(e["value"]), F.lit(1)), F.lit(0.0)).alias("score"), e["key"].alias("rule")))
    start = F.struct(F.lit(0.0).alias("score"), F.lit("").alias("rule"))
    return F.aggregate(F.coalesce(first, F.array().cast("array<struct<score:double,rule:string>>")), start, lambda best, x: F.when(x["score"] > best["score"], x).otherwise(best))


def entity_id(uri: Column) -> Column:
    return F.coalesce(F.element_at(F.split(uri, "/"), -1), F.lit(""))


# Output column and the path of its attribute.
PATHS = {
    "matched_mmhid": ("MMHID",),
    "matched_dba_name": ("DoingBusinessAsName",),
    "matched_mmh_name": ("Name",),
    "matched_street_address": ("Address", "value", "AddressLine1",),
    "matched_city": ("Address", "value", "City",),
    "matched_postal_code": ("Address", "value", "PostalCode", "value", "PostalCode",),
    "matched_country": ("Address", "value", "Country",),
    "matched_industry": ("Industry", "value", "Code", "value",),
    "matched_url": ("URL", "value", "URLValue", "value",),
    "matched_mmc_code": ("MCC_Code", "value", "Code", "lookupCode",),
    "matched_naics": ("NAICS", "value", "Code", "lookupCode",),
    "matched_clearing_last_seen_date": ("CLEARING_LAST_SEEN_DATE", "value",),
    "matched_auth_last_seen_date": ("AUTH_LAST_SEEN_DATE", "value",),
    "matched_zi_c_last_updated_date": ("ZI_C_LAST_UPDATED_DATE", "value",),
    "matched_agg_merch_id": ("AggrMerchID",),
    "matched_agg_merch_name": ("AggrMerchName",),
    "matched_parent_agg_merch_id": ("ParentAggrMerchID",),
    "matched_parent_agg_merch_name": ("ParentAggregateMerchantName",),
    "matched_region_code": ("Address", "value", "FinanceRegioncode", "lookupRawValue",),
    "matched_region_name": ("Address", "value", "RegionName", "value",),
}


def entity_attributes(json: Column) -> list[Column]:
    """All attributes a match carries over."""
    get = lambda *path: attribute(json, *path)
    country = get("Address", "value", "Country", "lookupCode")
    iso3 = F.coalesce(F.get_json_object(json, "$.Address[0].value['ISO3166-3'][0].value"), F.lit(""))
    return [
        *(get(*p).alias(name) for name, p in PATHS.items()), sic8(json).alias("matched_sic"), normalize_state(get("Address", "value", "StateProvince"), get("Address", "value", "Country")).alias("matched_state"),
        F.when(iso3 != "", iso3).otherwise(country).alias("matched_country_cd")]


def entity_request(supplier_id: Column, name: Column, street: Column, city: Column, state: Column, postal: Column, country: Column) -> Column:
    """The nested JSON of a supplier row."""
    value = lambda c: F.array(F.struct(filled_text(c).alias("value")))
    crosswalk = F.array(F.struct(F.coalesce(supplier_id, F.lit("1_1")).alias("value")))
    address = F.struct(value(street).alias("AddressLine1"), value(country).alias("Country"), value(city).alias("City"), value(state).alias("StateProvince"), F.array(F.struct(F.struct(value(postal).alias("PostalCode")).alias("value"))).alias("PostalCode"))
    return F.to_json(F.struct(F.struct(value(name).alias("DoingBusinessAsName"), value(name).alias("Name"), F.array(F.struct(address.alias("value"))).alias("Address")).alias("attributes"), crosswalk.alias("crosswalks")))


def filled_text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def match_response(json: Column, supplier_id: Column, request_hash: Column) -> list[Column]:
    """Columns of one row of a match service's answer: the first entity under the best rule, its attributes, score and rule;
    empty attributes and N where there is none. What isn't JSON reads as an empty answer."""
    best = best_rule(F.from_json(F.get_json_object(json, "$.relevance"), "map<string,map<string,double>>"))
    by_rule = F.from_json(F.get_json_object(json, "$.object"), "map<string,string>")
    entity = F.get_json_object(F.try_element_at(by_rule, best["rule"]), "$[0]")
    found = entity_id(F.get_json_object(entity, "$.uri"))
    attributes = F.coalesce(F.get_json_object(entity, "$.attributes"), F.lit("{}"))
    return [
        filled_text(supplier_id).alias("supplier_id"), found.alias("entity_id"), *entity_attributes(attributes), best["score"].alias("matched_score"), best["rule"].alias("matched_rule"),
        F.when(found != "", "Y").otherwise("N").alias("successful"), filled_text(request_hash).alias("request_hash")]


def search_results(json: Column) -> Column:
    """The entities of a search service's answer as an array of JSON texts: under `entities`, or the answer itself if it is a list."""
    return F.coalesce(F.from_json(F.get_json_object(json, "$.entities"), "array<string>"), F.from_json(json, "array<string>"), F.array().cast("array<string>"))


def search_entity(json: Column) -> list[Column]:
    """Id and attributes of one entity of search_results()."""
    return [entity_id(F.get_json_object(json, "$.uri")).alias("entity_id"), *entity_attributes(F.coalesce(F.get_json_object(json, "$.attributes"), F.lit("{}")))]
