import pytest
from pyspark.sql import functions as F

from ledgerlark.functions import attributes, scalar, similarity, text


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_base62(spark):
    alphabet = scalar.BASE62

    def plain(n):
        out = ""
        while n > 0:
            n, r = divmod(n, 62)
            out = alphabet[r] + out
        return out.rjust(8, "0")[-8:]

    numbers = [0, -5, 61, 62, 62**8 + 5, 2**63 - 1, 123456789012345678]
    assert values(spark, [(n,) for n in numbers] + [(None,)], "n long", scalar.base62_8(F.col("n"))) == [(plain(n),) for n in numbers] + [("",)]


def test_tiers_and_flags(spark):
    assert values(spark, [(0.75,), (0.7,), (0.69,), (None,)], "s double", scalar.confidence_tier(F.col("s"))) == [("High",), ("Medium",), ("Low",), ("Low",)]
    assert values(spark, [(0.71,), (0.7,), (0.6,), (None,)], "s double", scalar.propensity_tier(F.col("s"))) == [("HIGH",), ("MEDIUM",), ("LOW",), ("LOW",)]
    rows = [(None, None), ("2024-01-01", None), ("2024-01-01", "2024-01-01")]
    assert values(spark, rows, "a string, b string", scalar.history_flag(F.col("a"), F.col("b"))) == [(None,), ("NO",), ("YES",)]
    assert values(spark, [(10, 0), (10, 4)], "a int, n int", scalar.ticket_average(F.col("a"), F.col("n"))) == [(None,), (2.5,)]
    assert [r[0] for r in values(spark, [(0,), (49,), (99,)], "b int", scalar.percentile_midpoint(F.col("b")))] == [0.01, 0.5, 1.0]


def test_cosine(spark):
    rows = [([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 2.0]), ([0.0, 0.0], [1.0, 0.0]), (None, [1.0]), ([1.0], [1.0, 2.0])]
    assert [r[0] for r in values(spark, rows, "a array<double>, b array<double>", scalar.cosine(F.col("a"), F.col("b")))] == [1.0, 0.0, 0.0, None, None]


@pytest.mark.parametrize("raw,want", [("AcmeFoods Inc.", "acme foods"), ("texaco", "texa"), ("Acme Co., Inc.", "acme co"), ("VEN0000002", "ven 0000002"), ("example.com", "example"), (None, ""), ("", "")])
def test_cleanse_name(spark, raw, want):
    assert values(spark, [(raw,)], "n string", text.cleanse_name(F.col("n"))) == [(want,)]


def test_postal_and_state(spark):
    bad = ["null", "12", "00000", "11111", "12345678901", "0001234", "12212", "", None]
    assert {r[0] for r in values(spark, [(b,) for b in bad], "p string", text.valid_postal(F.col("p")))} == {False}
    assert values(spark, [("12345-6789",), ("K1A 0B1",)], "p string", text.valid_postal(F.col("p"))) == [(True,), (True,)]
    rows = [("12345", "12345-6789", "USA"), ("k1a", "K1A 0B1", "CAN"), ("", "1", "USA"), ("999", "1", "USA")]
    assert [r[0] for r in values(spark, rows, "a string, b string, c string", text.postal_match(F.col("a"), F.col("b"), F.col("c")))] == [True, True, False, False]
    rows = [("ca", "USA"), (" qc ", "CAN"), ("Bavaria ", "DEU"), (None, "USA")]
    assert values(spark, rows, "s string, c string", text.normalize_state(F.col("s"), F.col("c")), text.state_full_form(F.col("s"))) == [("USA-CA", "CALIFORNIA"), ("QC", "QUEBEC"), ("Bavaria", "Bavaria"), ("", "")]


def test_clean_text(spark):
    rows = [("a\x01\tb  c",), ("√âcole",), ("Ã©t",), ("x" * 300,), (None,)]
    assert [r[0] for r in values(spark, rows, "t string", text.clean_text(F.col("t")))] == ["a b c", "École", "ét", "x" * 200, ""]


def test_similarity_against_plain_lcs(spark):
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
            row = new
        return row[-1]

    for a, b in [("kitten", "sitting"), ("", "a"), ("abcabc", "cbacba"), ("x" * 80, "xy" * 50)]:
        assert similarity.lcs(a, b) == lcs(a, b)
    assert values(spark, [("foo bar", "bar foo", "bar")], "a string, b string, c string", similarity.name_similarity(F.col("a"), F.col("b"), F.lit("")), similarity.token_set_ratio(F.col("a"), F.col("c"))) == [(1.0, 1.0)] and similarity.partial_ratio("bcd", "abcde") == 1
    rows = [("Acme, Foods", "foods acme", "zzz"), ("ab", "", "cd")]
    got = [r[0] for r in values(spark, rows, "a string, b string, c string", similarity.name_similarity(F.lower("a"), F.col("b"), F.col("c")))]
    assert got == [1.0, 0.0]
    rows = [("PO Box 12 Main", "po box 12 main st"), ("", "x"), ("unit 5", "unit 9")]
    got = [r[0] for r in values(spark, rows, "a string, b string", similarity.address_similarity(F.col("a"), F.col("b")))]
    assert got[0] == 1.0 and got[1] == 0.0 and got[2] < 0.5
    assert [round(r[0], 3) for r in values(spark, [(0.8,), (0.9,), (1.0,)], "n double", similarity.boost(F.col("n"), 0.9, 0.05))] == [0.0, 0.0, 0.05]


def test_attributes(spark):
    j = '{"Name":[{"value":"N"}],"Address":[{"value":{"PostalCode":[{"value":{"PostalCode":[{"value":"123"}]}}],"Country":[{"lookupCode":"USA","value":"x"}],"ISO3166-3":[{"value":"CAN"}]}}],"MCC_Code":[{"value":{"Code":[{"lookupCode":"55"}]}}],"SIC":[]}'
    cols = {c: i for i, c in enumerate(["matched_mmh_name", "matched_postal_code", "matched_mmc_code", "matched_sic", "matched_country_cd", "matched_url"])}
    row = spark.createDataFrame([(j,)], "j string").select(*attributes.entity_attributes(F.col("j"))).select(*cols).first()
    assert tuple(row) == ("N", "123", "55", "", "CAN", "")
    rows = [({"a": {"u": 0.5, "v": 9.0}, "b": {"u": 0.5}},), ({"a": {}},), (None,)]
    got = values(spark, rows, "r map<string,map<string,double>>", attributes.best_rule(F.col("r")))
    assert [tuple(g[0]) for g in got] == [(0.5, "a"), (0.0, ""), (0.0, "")]
    assert values(spark, [("entities/9",), ("",), (None,)], "u string", attributes.entity_id(F.col("u"))) == [("9",), ("",), ("",)]


def test_base62_does_not_grow_with_each_digit(spark):
    plan = spark.range(1).select(scalar.base62_8(F.col("id")).alias("code"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("id#") < 40
