"""Text normalisation as column expressions; one Arrow function, for mojibake outside ASCII."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Mis-decoded sequences and what they stand for, applied in this order.
MOJIBAKE = [
    ("√â", "É"), ("√Ç", "Â"), ("√Å", "Á"), ("√É", "Ã"), ("√ì", "Ó"), ("√ç", "Í"), ("Ê", "É"), ("í", "Í"), ("√Ñ", "Ä"), ("√ñ", "ä"), ("√∂", "ö"), ("√§", "ç"), ("√£", "ã"),
    ("√°", "á"), ("√à", "à"), ("√º", "ú"), ("√´", "ô"), ("√ö", "Ö"), ("√ü", "Ü"), ("√Ä", "ä"), ("√â‰", "É"),
]
DOMAINS = "com|org|net|io|co|gov|edu|biz|info|us|uk|ca"
# Legal-form suffixes, tried in this order at the end of a name, without a word boundary.
LEGAL_FORMS = ["inc", "inc.", "corporation", "corp", "corp.", "llc", "l.l.c.", "co", "co.", "company", "limited", "ltd", "ltd."]
DUMMY_POSTAL_CODES = ["12212", "90021", "852", "853"]
NULL_WORDS = ["null", "none", "n/a", "na", "-"]

# States of the USA and provinces of Canada by their codes.
STATES = {
    "AL": "ALABAMA", "AK": "ALASKA", "AZ": "ARIZONA", "AR": "ARKANSAS", "CA": "CALIFORNIA", "CO": "COLORADO", "CT": "CONNECTICUT", "DE": "DELAWARE",
    "FL": "FLORIDA", "GA": "GEORGIA", "HI": "HAWAII", "ID": "IDAHO", "IL": "ILLINOIS", "IN": "INDIANA", "IA": "IOWA", "KS": "KANSAS",
    "KY": "KENTUCKY", "LA": "LOUISIANA", "ME": "MAINE", "MD": "MARYLAND", "MA": "MASSACHUSETTS", "MI": "MICHIGAN", "MN": "MINNESOTA",
    "MS": "MISSISSIPPI", "MO": "MISSOURI", "MT": "MONTANA", "NE": "NEBRASKA", "NV": "NEVADA", "NH": "NEW HAMPSHIRE", "NJ": "NEW JERSEY",
    "NM": "NEW MEXICO", "NY": "NEW YORK", "NC": "NORTH CAROLINA", "ND": "NORTH DAKOTA", "OH": "OHIO", "OK": "OKLAHOMA", "OR": "OREGON",
    "PA": "PENNSYLVANIA", "RI": "RHODE ISLAND", "SC": "SOUTH CAROLINA", "SD": "SOUTH DAKOTA", "TN": "TENNESSEE", "TX": "TEXAS", "UT": "UTAH",
    "VT": "VERMONT", "VA": "VIRGINIA", "WA": "WASHINGTON", "WV": "WEST VIRGINIA", "WI": "WISCONSIN", "WY": "WYOMING", "AB": "ALBERTA",
    "BC": "BRITISH COLUMBIA", "MB": "MANITOBA", "NB": "NEW BRUNSWICK", "NL": "NEWFOUNDLAND AND LABRADOR", "NS": "NOVA SCOTIA",
    "NT": "NORTHWEST TERRITORIES", "NU": "NUNAVUT", "ON": "ONTARIO", "PE": "PRINCE EDWARD ISLAND", "QC": "QUEBEC", "SK": "SASKATCHEWAN",
    "YT": "YUKON",
}


def filled(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def normalize_text(c: Column) -> Column:
    """Lower case, only a-z, 0-9 and single spaces; null is empty."""
    return collapse(F.regexp_replace(F.lower(filled(c)), r"[^a-z0-9\s]", ""))


def remove_special(c: Column) -> Column:
    return collapse(F.regexp_replace(filled(c), r"[^a-zA-Z0-9\s]", ""))


def normalize_city(c: Column) -> Column:
    return collapse(F.lower(filled(c)))


def cleanse_name(c: Column) -> Column:
    """Camel case split, lower case, one domain and one legal suffix dropped, separators to spaces, letters and digits parted."""
    out = F.lower(F.regexp_replace(filled(c), r"([a-z])([A-Z])", "$1 $2"))
    out = F.trim(F.regexp_replace(out, rf"\.({DOMAINS})$", ""))
    forms = "|".join(x.replace(".", r"\.") for x in LEGAL_FORMS)
    out = F.trim(F.regexp_replace(out, rf"(?:{forms})$", ""))
    out = collapse(F.regexp_replace(out, r"[-_.,]", " "))
    return F.regexp_replace(F.regexp_replace(out, r"([a-zA-Z])(\d)", "$1 $2"), r"(\d)([a-zA-Z])", "$1 $2")


def postal_comparable(postal: Column, country: Column) -> Column:
    """The first five digits for the USA; elsewhere capitals without spaces, dots and hyphens."""
    usa = F.upper(F.trim(filled(country))) == "USA"
    return F.when(usa, F.regexp_replace(filled(postal), r"\D", "").substr(1, 5)).otherwise(F.regexp_replace(F.upper(filled(postal)), r"[\s.\-]", ""))


def city_match(a: Column, b: Column) -> Column:
    return (filled(a) != "") & (filled(b) != "") & (normalize_city(a) == normalize_city(b))


def postal_match(own: Column, other: Column, country: Column) -> Column:
    """The other's comparable code starts with one's own; false where either is empty."""
    x, y = postal_comparable(own, country), postal_comparable(other, country)
    return (x != "") & (y != "") & y.startswith(x)


def normalize_state(state: Column, country: Column) -> Column:
    """Two letters: capitals, with `USA-` before them in the USA; anything else trimmed; null is empty."""
    code = F.upper(F.trim(filled(state)))
    two = code.rlike("^[A-Z]{2}$")
    return F.when(two & (country == "USA"), F.concat(F.lit("USA-"), code)).when(two, code).otherwise(F.trim(filled(state)))


def state_full_form(state: Column) -> Column:
    known = F.create_map(*(F.lit(x) for kv in STATES.items() for x in kv))
    return F.coalesce(F.try_element_at(known, F.upper(F.trim(filled(state)))), F.trim(filled(state)))


def valid_postal(postal: Column, is_country: Column | None = None) -> Column:
    """False for what can't be a postal code: null words, under 3 characters, known dummies, zeros or one digit only, over 10
    digits, over 6 digits with three zeros first, and country names."""
    code = F.trim(filled(postal))
    digits = F.regexp_replace(code, r"\D", "")
    bad = (
        F.lower(code).isin(*NULL_WORDS) | (F.length(code) < 3) | code.isin(*DUMMY_POSTAL_CODES) | digits.rlike("^0+$") | code.rlike(r"^(\d)\1*$")
        | code.rlike(r"^\d{11,}$") | ((F.length(digits) > 6) & digits.startswith("000")))
    return ~(bad | is_country) if is_country is not None else ~bad


def _repair(v: str) -> str:
    try:
        v = v.encode("latin-1").decode("utf-8")
    except UnicodeError:
        pass
    for wrong, right in MOJIBAKE:
        v = v.replace(wrong, right)
    return v


@F.pandas_udf(T.StringType())
def _repair_all(values: pd.Series) -> pd.Series:
    return values.map(_repair, na_action="ignore")


def fix_encoding(c: Column) -> Column:
    """Undoes UTF-8 read as Latin-1 and the known sequences; null is empty. ASCII text never reaches Python."""
    return F.when(filled(c).rlike(r"[^\x00-\x7F]"), _repair_all(filled(c))).otherwise(filled(c))


def clean_text(c: Column) -> Column:
    """Control characters to spaces, single spaces, repaired, at most 200 characters."""
    return F.trim(F.substring(fix_encoding(collapse(F.regexp_replace(filled(c), r"[\x00-\x1f\x7f]", " "))), 1, 200))


def dba_parts(name: Column) -> tuple[Column, Column]:
    """What stands before and after the first `dba` in any case; nulls without one."""
    has = F.lower(filled(name)).contains("dba")
    at = F.instr(F.lower(filled(name)), "dba")
    return F.when(has, F.trim(name.substr(F.lit(1), at - 1))), F.when(has, F.trim(name.substr(at + 3, F.length(name))))


def resolve_country(df: DataFrame, country: str, names: DataFrame, aliases: DataFrame) -> DataFrame:
    """df with norm_country and country_iso2: alias → name → code, else name → code, else the trimmed input and no code.

    names: country_name, country_code_2alpha; aliases: alias, country_name. Keys compare trimmed and in capitals; of equal keys
    the last by value wins. The lookups are country lists, small by nature, so Spark may broadcast them.
    """
    upper = lambda c: F.upper(F.trim(F.col(c)))
    codes = names.where("trim(country_name) <> '' and trim(country_code_2alpha) <> ''").groupBy(upper("country_name").alias("k")).agg(F.max(F.trim("country_code_2alpha")).alias("iso"))
    known = aliases.where("trim(alias) <> '' and trim(country_name) <> ''").groupBy(upper("alias").alias("ka")).agg(F.max(F.trim("country_name")).alias("named"))
    rows = df.withColumn("__raw", F.trim(filled(F.col(country)))).withColumn("__key", F.upper("__raw")).join(known, F.col("__key") == known["ka"], "left")
    rows = rows.withColumn("norm_country", F.coalesce("named", "__raw"))
    rows = rows.join(codes, F.upper("norm_country") == codes["k"], "left").withColumn("country_iso2", filled(F.col("iso")))
    return rows.drop("__raw", "__key", "ka", "named", "k", "iso")


def normalize_rows(df: DataFrame) -> DataFrame:
    """Supplier rows with their norm_ fields, cleansed name, state forms; norm_country and country_iso2 must be there already."""
    return df.select(
        "*", *(clean_text(F.col(c)).alias(f"norm_{c}") for c in ("supplier_name", "street_address", "city")),
        F.when(valid_postal(clean_text(F.col("postal_code"))), clean_text(F.col("postal_code"))).otherwise("").alias("norm_postal_code"),
        cleanse_name(clean_text(F.col("supplier_name"))).alias("cleansed_supplier_name"),
        normalize_state(clean_text(F.col("state")), F.col("norm_country")).alias("norm_state"), state_full_form(F.col("state")).alias("full_form_state"))


def request_hash(*fields: Column) -> Column:
    """SHA-256 of the trimmed lower-case fields, joined by unit separators; null reads `none`."""
    return F.sha2(F.concat_ws("\x1f", *(F.lower(F.trim(F.coalesce(c.cast("string"), F.lit("none")))) for c in fields)), 256)
