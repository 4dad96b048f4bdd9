"""Ratios as expressions, and the similarity join of names, beside plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlark.functions import similarity
from ledgerlark.operators import leading_pairs, matching, similar_names
from ledgerlark.plans import catalogue


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def pairs_of_texts(seed, n):
    r = random.Random(seed)
    word = lambda k, most: "".join(r.choice("abcdefgh0123"[:k]) for _ in range(r.randint(1, most)))
    out = [("", ""), ("a", ""), ("", "b"), ("x" * 62, "x" * 62), ("x" * 63, "yx" * 40), ("ab" * 100, "ba" * 90), ("po box 1", "1 po box"), ("unit 5 a", "unit unit 6 a"), ("!!", "--")]
    for _ in range(n):
        k = r.randint(1, 12)
        a = " ".join(word(k, 9) for _ in range(r.randint(0, 5)))
        b = "".join(c for c in a if r.random() > 0.15) if r.random() < 0.5 else " ".join(word(k, 9) for _ in range(r.randint(0, 5)))
        out.append((a + word(k, 150) if r.random() < 0.1 else a, b + word(k, 150) if r.random() < 0.1 else b))
    return out


def plain_token_set(a, b):
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    shared = " ".join(sorted(x & y))
    if shared and (x <= y or y <= x):
        return 1.0
    r = lambda p, q: 2 * similarity.lcs(p, q) / (len(p) + len(q))
    full = [f"{shared} {' '.join(sorted(t))}".strip() for t in (x - y, y - x)]
    return max([r(*full)] + ([r(shared, full[0]), r(shared, full[1])] if shared else []))


def plain_partial(a, b):
    a, b = sorted((a, b), key=len)
    if not a:
        return float(not b)
    r = lambda p, q: 2 * similarity.lcs(p, q) / (len(p) + len(q))
    slide = lambda p, q: max(r(p, q[max(0, s) : s + len(p)]) for s in range(1 - len(p), len(q)))
    return max(slide(a, b), slide(b, a)) if len(a) == len(b) else slide(a, b)


def test_common_subsequence_of_any_length(spark):
    texts = pairs_of_texts(1, 300)
    df = spark.createDataFrame(texts, "a string, b string")
    coded = similarity.ratio(F.col("a"), F.col("b"), similarity.letter_masks(F.col("a")), similarity.letter_codes(F.col("b")))
    for a, b, n, r, c in rows_of(df, "a", "b", similarity.lcs_length(F.col("a"), F.col("b")), similarity.ratio(F.col("a"), F.col("b")), coded):
        want = similarity.lcs(a, b)
        assert n == want and r == (2 * want / (len(a) + len(b)) if a or b else 1.0)
        assert set(a + b) - set(similarity.ALPHABET) or c == r
    plan = df.select(similarity.name_similarity(F.col("a"), F.col("b"), F.lit("x")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_address_parts(spark):
    texts = pairs_of_texts(2, 250)
    df = spark.createDataFrame(texts, "a string, b string")
    for a, b, tokens, bound in rows_of(df, "a", "b", similarity.token_set_ratio(F.col("a"), F.col("b")), similarity.partial_bound(F.col("a"), F.col("b"))):
        assert tokens == pytest.approx(plain_token_set(a, b), abs=1e-12)
        partial = plain_partial(a, b)
        assert partial == similarity.partial_ratio(a, b) and (partial <= bound + 1e-12 or not a and not b)
        assert similarity.partial_ratio(a, b, 0.7) == max(partial, 0.7)


def test_sliding_ratio_only_where_it_can_matter(spark):
    texts = pairs_of_texts(3, 250) + [("12 main street", "main st 12"), ("12 main street", "99 elm grove"), ("1 a", "1 a")] * 20
    df = spark.createDataFrame([(i, a, b, i % 3 > 0) for i, (a, b) in enumerate(texts)], "i int, a string, b string, wanted boolean")
    exact = {i: x for i, x in rows_of(df, "i", similarity.address_similarity(F.col("a"), F.col("b")))}
    got = similarity.with_address_similarity(df, "s", F.col("a"), F.col("b"), 0.8, F.col("wanted"))
    found = rows_of(got, "i", "s", "wanted", F.coalesce("s__steps.slides", F.lit(False)))
    for i, s, wanted, _ in found:
        assert s == pytest.approx(exact[i]) if wanted and exact[i] >= 0.8 else s < 0.8
    slid = sum(x for _, _, _, x in found)
    assert 0 < slid < 0.7 * sum(w for _, _, w, _ in found) and not any(x and not w for _, _, w, x in found)


@pytest.mark.parametrize("percent", [70, 80, 93, 100])
def test_join_finds_every_pair_of_the_ratio(spark, percent):
    r = random.Random(percent)
    names = {"".join(r.choice("abc 1") for _ in range(r.randint(1, 16))) for _ in range(160)} | {"a", "b", "ab", "acme foods", "aaaaaaa", "aaaaaa"}
    names = sorted({" ".join(sorted(n.split())) for n in names} - {""})
    other = sorted({" ".join(sorted("".join(c for c in n + tail if r.random() > 0.12).split())) for n in names for tail in ("", "ab")} - {""})
    left = spark.createDataFrame([("g", n) for n in names] * 2 + [("h", n) for n in names[:9]] + [(None, "x"), ("g", "")], "grp string, name string")
    right = spark.createDataFrame([("g", n) for n in other] + [(None, "x"), ("g", ""), ("h", names[0])], "grp string, name string")
    got = sorted(map(tuple, similar_names.similar_names(left, right, percent).collect()))
    ratio = lambda a, b: 2 * similarity.lcs(a, b) / (len(a) + len(b))
    want = [("g", a, b, ratio(a, b)) for a in names for b in other] + [("h", a, names[0], ratio(a, names[0])) for a in names[:9]]
    assert got == sorted(x for x in want if x[3] >= percent / 100) and len(got) > 20


def test_the_bound_on_letter_pairs_holds():
    r = random.Random(9)
    for _ in range(3000):
        a, b = ("".join(r.choice("ab1") for _ in range(r.randint(1, 12))) for _ in range(2))
        grams = lambda s: [f"^{s}$"[i : i + 2] for i in range(len(s) + 1)]
        shared, rest = 0, grams(b)
        for g in grams(a):
            if g in rest:
                rest.remove(g)
                shared += 1
        assert shared >= 3 * similarity.lcs(a, b) + 1 - len(a) - len(b)


def test_few_candidates_among_names_with_a_common_start_and_end(spark):
    r = random.Random(4)
    word = lambda k: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(k))
    names = [f"Global {word(8)} {word(8)} {word(7)} Trading Company" for _ in range(300)]
    rows = spark.createDataFrame([(i, n, "DE", "1 st", "Bonn") for i, n in enumerate(names[:150])], "row_id int, norm_supplier_name string, norm_country string, norm_street_address string, norm_city string")
    entities = spark.createDataFrame([(f"E{i}", n, "Trading " + n[7:], "de", "1 st", "Bonn") for i, n in enumerate(names[75:])], "entity_id string, legal_name string, dba_name string, country string, street_address string, city string")
    found = matching.candidates(rows, entities)
    assert {(i, f"E{i - 75}") for i in range(75, 150)} <= {tuple(x) for x in found.collect()}
    assert found.count() < 0.1 * 150 * 225


def test_exact_keys_meet_what_the_other_rules_accept(spark):
    names, others = ["Max", "ab", "Acme Best", "X1", "zeta omega"], [("Maxwell", ""), ("House", "maxi"), ("q", "ab company"), ("Best of Acme", ""), ("", "zeta omega pi"), ("", "x11 y"), ("none", "none")]
    rows = spark.createDataFrame([(i, n, "DE") for i, n in enumerate(names)], "row_id int, norm_supplier_name string, norm_country string")
    entities = spark.createDataFrame([(f"E{i}", *n, "DE" if i != 5 else "FR") for i, n in enumerate(others)], "entity_id string, legal_name string, dba_name string, country string")
    assert {(0, "E0"), (0, "E1"), (1, "E2"), (2, "E3"), (4, "E4")} <= {tuple(x) for x in matching.candidates(rows, entities).collect()} and not [x for x in matching.candidates(rows, entities).collect() if x.entity_id in ("E5", "E6")]


def test_no_python_but_for_sliding_addresses(spark, sf_dir):
    plan = catalogue.rule_cascade(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "_partial_ratio" in plan


def test_only_pairs_that_can_win_among_names_all_alike(spark, monkeypatch):
    r = random.Random(8)
    number = lambda i: f"Vendor {i * 37 % 1000:06d}"
    long = "Amalgamated Warehousing and Distribution of the Northern Provinces " * 2
    rows = [(i, (f"Shop DBA {number(i)}", number(i), long + number(i))[i % 3], f"{i % 40} Main Street" if i % 4 else "", ("", "Town", "town hall")[i % 7 % 3], f"1{i % 30:03d}" if i % 6 else "", "DEU" if i % 9 else "FRA", "Bavaria" if i % 5 == 0 else "") for i in range(120)]
    rows += [(900, "アクメ DBA Vendor 000037", "", "Town", "", "DEU", ""), (901, "!!!", "", "Town", "", "DEU", "")]
    entities = [(f"E{j:03d}", (number(j) + " Inc", long + number(j), "!!!")[j % 8 // 3], number(r.randrange(60)), f"{j % 40} Main St", ("Town", "town hall", "")[j % 3], ("", "bavaria")[j % 2], f"1{j % 30:03d}-{j % 2}", "DEU" if j % 5 else "FRA") for j in range(130)]
    rows = spark.createDataFrame(rows, "row_id int, norm_supplier_name string, norm_street_address string, norm_city string, norm_postal_code string, norm_country string, full_form_state string")
    entities = spark.createDataFrame(entities, "entity_id string, legal_name string, dba_name string, street_address string, city string, state string, postal_code string, country string")
    whole = leading_pairs.leading_pairs
    monkeypatch.setattr(matching, "leading_pairs", lambda *a: whole(*a, block=16, cells=8))  # several blocks a country
    got, strict, found = sorted(map(tuple, matching.cascade(rows, entities).collect())), sorted(map(tuple, matching.cascade(rows, entities, 0.82).collect())), matching.candidates(rows, entities).where("row_id < 900").count()
    monkeypatch.setattr(matching, "candidates", lambda a, b, *least: a.select("row_id").where("row_id < 900").crossJoin(b.select("entity_id")).unionAll(whole_odd))
    whole_odd = spark.createDataFrame([(900, e.entity_id) for e in entities.collect() if e.country == "DEU" and max(2 * similarity.lcs(a, b) / (len(a) + len(b)) for a in ("dba vendor 000037", "000037 vendor") for b in (" ".join(sorted("".join(c for c in n.lower() if c.isalnum() or c == " ").split())) for n in (e.legal_name, e.dba_name))) >= 0.8] + [(901, e.entity_id) for e in entities.collect() if e.country == "DEU" and e.legal_name == "!!!"], "row_id int, entity_id string")
    assert got == sorted(map(tuple, matching.cascade(rows, entities).collect())) and strict == sorted(map(tuple, matching.cascade(rows, entities, 0.82).collect()))
    assert len({r[3] for r in got}) > 6 and found < 6 * 120  # of 15,600 pairs


def test_ratios_of_arrays_and_addresses_in_python(spark):
    texts = [(" ".join(a.split()), " ".join(b.split())) for a, b in pairs_of_texts(5, 200)]
    names = leading_pairs.Names([b for _, b in texts if set(b) <= set(similarity.ALPHABET)])
    for a in [a for a, _ in texts if a and set(a) <= set(similarity.ALPHABET)]:
        assert names.ratios(a, range(len(names.names))).tolist() == [2 * similarity.lcs(a, b) / (len(a) + len(b)) for b in names.names]
    df = spark.createDataFrame(texts, "a string, b string")
    for a, b, want, x, y in rows_of(df, "a", "b", similarity.address_similarity(F.col("a"), F.col("b")), similarity.plain_address(F.col("a")), similarity.plain_address(F.col("b"))):
        assert want == pytest.approx(similarity.address_value(x, y), abs=1e-12) or not (a and b)
