import math

import numpy as np
import pytest

from ledgerlark.llm import mixing
from ledgerlark.llm.common import small
from ledgerlark.llm.mixing import CLOSE, DIMS, NONE, fit_mix, fit_topics, measure, mix, op9_mixing, plan, rake, reachable


def shares(rows, d, weight):
    out = {}
    for r in rows:
        out[r[d] or NONE] = out.get(r[d] or NONE, 0.0) + weight(r)
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_marginals_are_met(spark, sf):
    d = f"/root/testdata/{sf}"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "source", "lang")
    fit = plan(docs)[1]
    assert fit.error <= CLOSE and fit.blend < 1
    rows = op9_mixing(spark, d).collect()
    total = sum(r.n_tokens for r in rows)
    assert len(rows) == docs.count()
    assert abs(sum(r.probability * r.n_tokens for r in rows) / total - 0.8) < 1e-6
    rate = sum(r.n_tokens for r in rows if r.selected) / total
    assert 0.7 < rate < 0.9
    kept = sum(r.n_tokens for r in rows if r.selected)
    for dim, want in zip(DIMS, fit.targets):
        expected = shares(rows, dim, lambda r: r.probability * r.n_tokens / (0.8 * total))
        assert all(abs(expected.get(v, 0.0) - t) < 1e-6 for v, t in want.items())
        drawn = shares(rows, dim, lambda r: r.n_tokens * r.selected / kept)
        for v, t in want.items():  # a Poisson sample: within five standard errors of its target
            spread = math.sqrt(sum((r.n_tokens / (0.8 * total)) ** 2 * r.probability * (1 - r.probability) * ((r[dim] == v) - t) ** 2 for r in rows))
            assert abs(drawn.get(v, 0.0) - t) < 5 * spread + 1e-6
    present = shares(rows, "lang", lambda r: r.n_tokens / total)
    assert all((fit.targets[1][v] > p) == (p < 0.3) for v, p in present.items())  # small languages gain, the large one loses


def brute_rake(cells, tokens, goals, start, rounds=3000):
    """The bounded fit by plain loops: each margin value's factor by bisection."""
    e = [start] * len(cells)
    for _ in range(rounds):
        for d, goal in enumerate(goals):
            for v, want in goal.items():
                own = [i for i, c in enumerate(cells) if c[d] == v]
                lo, hi = 0.0, 1e9
                for _ in range(100):
                    f = (lo + hi) / 2 if lo else min(hi, 1e-9) * 2 if hi < 1e-6 else math.sqrt(max(lo, 1e-12) * hi)
                    if sum(tokens[i] * min(1.0, e[i] * f) for i in own) < want:
                        lo = f
                    else:
                        hi = f
                for i in own:
                    e[i] *= hi
        worst = max(abs(sum(t * min(1.0, x) for t, x, c in zip(tokens, e, cells) if c[d] == v) - want) for d, goal in enumerate(goals) for v, want in goal.items())
        if worst < 1e-7 * sum(tokens):
            break
    return [min(1.0, x) for x in e]


def test_rake_against_brute_force():
    rng = np.random.default_rng(3)
    cells = [(f"s{a}", f"l{b}", f"t{c}") for a in range(4) for b in range(3) for c in range(3) if (a, b, c) != (0, 0, 0)]
    tokens = rng.integers(1, 1000, len(cells)).astype(float)
    codes = [np.unique([c[d] for c in cells], return_inverse=True) for d in range(3)]
    inside = np.minimum(1, 0.7 * rng.uniform(0.5, 2, len(cells)))  # goals that some probabilities meet, several at 1
    goals = [np.bincount(c, weights=tokens * inside) for _, c in codes]
    p, worst = rake([c for _, c in codes], goals, tokens, 0.7)
    assert worst <= CLOSE
    for (_, c), g in zip(codes, goals):
        assert np.abs(np.bincount(c, weights=tokens * p) - g).max() < 1e-6 * tokens.sum()
    want = brute_rake(cells, tokens.tolist(), [dict(zip(v, g)) for (v, _), g in zip(codes, goals)], 0.7)
    assert np.allclose(p, want, atol=1e-4) and (p == 1).any()


def test_reachable_shares():
    present = np.array([0.9, 0.06, 0.04, 0.0])
    got = reachable(present, 0.5, 0.8, 0.5)
    assert abs(got.sum() - 1) < 1e-12 and got[3] == 0 and got[1] <= 0.06 * 1.125 + 1e-12 and got[0] < 0.9
    assert np.allclose(reachable(present, 1.0, 0.8, 0.5), present) and np.allclose(reachable(present, 0.0, 1.0, 0.5), present)


def test_both_ways_agree_and_odd_rows(spark):
    rows = [(i, f"word{i} something{i % 3} " * (1 + i % 5), f"s{i % 2}", "en" if i % 3 else None) for i in range(60)] + [(None, None, None, None), (5, "", "s0", "en"), (6, "long " * 100_000, "s9", "en"), (6, "long " * 100_000, "s9", "en")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, lang string, topic string")
    a = mix(docs).collect()
    b = mix(docs, driver_cells=0).collect()
    key = lambda r: (str(r.doc_id), r.n_tokens, r.topic, r.selected)
    assert sorted(map(key, a)) == sorted(map(key, b)) and len(a) == len(rows)
    assert np.allclose(sorted(r.probability for r in a), sorted(r.probability for r in b), atol=1e-6)
    assert all(r.probability == 0 and not r.selected for r in a if r.n_tokens == 0)
    assert len({r.selected for r in a if r.doc_id == 6}) == 1
    assert mix(docs.limit(0)).count() == 0
    assert mix(docs.drop("lang")).count() == len(rows)


def test_given_targets_are_met_by_a_smaller_budget(spark):
    cells = spark.createDataFrame([("a", "en", "t0", 900.0), ("a", "fr", "t0", 50.0), ("b", "en", "t1", 100.0), ("b", "fr", "t0", 150.0), ("b", "fr", "t1", 0.0)], "source string, lang string, topic string, tokens double")
    targets = [{"a": 1.0, "b": 1.0, "missing": 3.0}, {"en": 1.0, "fr": 1.0}, {"t0": 0.8, "t1": 0.2}]
    fit = fit_mix(cells, 0.8, (1, 1, 1), targets)
    assert fit.error <= CLOSE and 0.05 < fit.budget <= 200 / 1200 * 2
    easy = [{"a": 950.0, "b": 250.0, "missing": 0.0}, {"en": 1000.0, "fr": 200.0}, {"t0": 1100.0, "t1": 100.0}]
    one, two = fit_mix(cells, 0.5, (1, 1, 1), easy), fit_mix(cells, 0.5, (1, 1, 1), easy, driver_cells=0)
    assert one.error <= CLOSE and two.error <= CLOSE and one.budget == two.budget
    assert np.allclose(*([r.probability for r in sorted(x.fitted.collect())] for x in (one, two)), atol=1e-6)
    p = {(r.c_source, r.c_lang, r.c_topic): r.probability for r in fit.fitted.collect()}
    kept = {k: x * t for k, x, t in ((("a", "en", "t0"), p["a", "en", "t0"], 900), (("a", "fr", "t0"), p["a", "fr", "t0"], 50), (("b", "en", "t1"), p["b", "en", "t1"], 100), (("b", "fr", "t0"), p["b", "fr", "t0"], 150))}
    whole = sum(kept.values())
    for d, v, t in ((0, "a", 0.5), (1, "en", 0.5), (2, "t1", 0.2)):
        assert abs(sum(x for k, x in kept.items() if k[d] == v) / whole - t) < 1e-6


def test_topics_are_clusters_of_word_use(spark):
    words = {"x": "garden flower meadow blossom petals", "y": "engine piston clutch gearbox exhaust"}
    rows = [(i, " ".join(np.random.default_rng(i).permutation((words["x" if i % 2 else "y"] + " people during").split())), "s", "en") for i in range(40)]
    docs = spark.createDataFrame(rows + [(99, "a of to", "s", "en"), (100, None, "s", None)], "doc_id long, text string, source string, lang string")
    topics = fit_topics(docs, n_topics=2)
    got = {r.doc_id: r.topic for r in measure(docs, topics).collect()}
    assert len({got[i] for i in range(0, 40, 2)}) == len({got[i] for i in range(1, 40, 2)}) == 1 and got[0] != got[1]
    assert got[99] == got[100] == NONE
    # the nearest centroid by plain loops
    from ledgerlark.llm.mixing import centred, word_vectors
    from ledgerlark.llm.common import text_bytes
    import pyarrow as pa
    for i in (0, 1, 17):
        v = centred(word_vectors(*text_bytes(pa.array([rows[i][1]])), 256, 6)[1], ["en"], topics)[0]
        cos = [sum(a * b for a, b in zip(v, c)) for c in topics.centroids]
        assert got[i] == f"t{cos.index(max(cos))}"


def test_topics_learn_from_every_document(spark):
    """More documents than a sample would hold, and one of them with words of its own: it is the farthest, so it is a centre."""
    common = spark.range(45_000).selectExpr("id AS doc_id", "concat('garden flower meadow people ', if(id % 2 = 0, 'blossom', 'petals')) AS text", "'s' AS source", "'en' AS lang")
    for odd in (7, 44_999, 50_000):
        docs = common.where(f"doc_id <> {odd}").unionAll(spark.createDataFrame([(odd, "engine piston clutch gearbox exhaust", "s", "en")], "doc_id long, text string, source string, lang string"))
        topics = fit_topics(docs, n_topics=3)
        got = {(r.topic, r.odd): r.n for r in measure(docs, topics).selectExpr("topic", f"doc_id = {odd} AS odd").groupBy("topic", "odd").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
        assert len(got) == 3 and [n for (_, own), n in got.items() if own] == [1]
    again = fit_topics(docs.repartition(7), n_topics=3)
    assert np.array_equal(again.centroids, topics.centroids) and np.array_equal(again.mean, topics.mean)


def test_means_of_many_languages_are_joined(spark, monkeypatch):
    """As many languages as documents, nulls among them: the same topics as with means on the driver, which gets none of them here."""
    rows = [(i, f"garden{i % 5} flower{i % 7} meadow{i % 3} people", "s", None if i % 50 == 0 else f"l{i % 1500}") for i in range(3000)] + [(3000, "a of", "s", "never"), (3001, None, "s", "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(3)
    few, many = fit_topics(docs, driver_langs=2000), fit_topics(docs)
    assert few.table is None and len(few.means) == 1471 and not many.means and many.table.count() == 1471
    assert np.array_equal(few.centroids, many.centroids) and np.array_equal(few.mean, many.mean)
    want = {r.doc_id: r.topic for r in measure(docs, few).collect()}
    for most in (1 << 26, 0):  # broadcast, shuffled
        monkeypatch.setattr(mixing, "small", lambda df, most=most: small(df, most))
        out = measure(docs, many)
        assert out.columns == ["doc_id", "source", "lang", "n_tokens", "topic"] and {r.doc_id: r.topic for r in out.collect()} == want and len(want) == 3002
    other = docs.selectExpr("doc_id", "text", "source", "concat(lang, 'x') AS lang")  # languages without a mean get that of all
    got = [sorted(map(tuple, measure(other, t).select("doc_id", "topic").collect())) for t in (few, many)]
    assert got[0] == got[1]
    assert mix(docs).count() == 3002
