import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlark.llm.periodic_runs import automaton, find_runs, op11_periodic_runs, runs_of, suspects, text_runs, tiled


def brute(words, least=24, power=3):
    """Every period of its own: stretches of equal words at distance q, kept if no smaller period holds all of it."""
    n, found = len(words), []
    for q in range(1, n // power + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            start, size = i, j + q - i
            i = j
            if size >= max(least, power * q) and not any(all(words[t] == words[t + p] for t in range(start, start + size - p)) for p in range(1, q)):
                found.append((start, size, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def changed(doc_id, text):
    words, h = re.findall(r"[^\x20\x09-\x0D]+", text or ""), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def answer(doc_id, text):
    words = changed(doc_id, text)
    runs, gone = brute(words), set()
    for s, size, q in runs:
        gone |= set(range(s + q, s + size))
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join(f"{s},{x},{q}\n" for s, x, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("least,power", [(24, 3), (6, 3), (4, 2), (10, 4)])
def test_runs_equal_brute_force(least, power):
    rng = np.random.default_rng(least)
    for k in range(150):
        letters, parts = int(rng.integers(1, 5)), []
        for _ in range(int(rng.integers(1, 7))):
            base = rng.integers(0, letters, int(rng.integers(1, 14))).tolist()
            parts += (base * int(rng.integers(1, 7)))[: int(rng.integers(1, 70))]
            parts += rng.integers(0, 50, int(rng.integers(0, 4))).tolist()
        want = brute(parts, least, power)
        assert runs_of(parts, least, power) == want
        assert text_runs([b"%d" % c for c in parts], least, power) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=120))
def test_runs_of_few_words(codes):
    assert text_runs([b"%d" % c for c in codes], 8, 3) == brute(codes, 8, 3)


def test_automaton_has_each_stretch_once():
    codes = [1, 2, 2, 1, 2, 2, 3, 1, 2]
    length, link, own = automaton(codes)
    distinct = {tuple(codes[i:j]) for i in range(len(codes)) for j in range(i + 1, len(codes) + 1)}
    assert sum(length[v] - length[link[v]] for v in range(1, len(length))) == len(distinct)
    assert sorted(x for x in own if x >= 0) == list(range(len(codes)))


def test_suspects_skip_what_cannot_hold_a_run():
    codes = np.array([*range(500), *([900, 901, 902] * 10), *range(1000, 1300), *range(1000, 1300)])
    assert suspects(codes, 24, 3) == [(500, 530)]


def test_odd_rows_and_long_texts(spark):
    line = "the same line again and "
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, line * 9), (5, line * 9), (5, "other text"), (None, line * 5), (None, None), (6, "a " * 24), (7, "a " * 23),
            (8, "\x0bé x y\x1fz " * 30), (9, "word " * 20000), (10, " ".join(f"w{k % 997}" for k in range(40000)))]
    rows += [(k, f"p{k} " + "x y z " * (k % 23) + "tail") for k in range(11, 120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'x' AS runs", "1 AS start", "2 AS key", "3 AS n_words")
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in find_runs(docs).collect()]
    want = []
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = [(0, len(words), 1)] if i == 9 else [(0, 40000, 997)] if i == 10 else brute(words)
        gone = {x for s, size, q in runs for x in range(s + q, s + size)}
        want.append((i, len(words), runs, " ".join(w for k, w in enumerate(words) if k not in gone)))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert find_runs(docs.limit(0)).count() == 0


def test_changed_words(spark):
    rows = [(k, " ".join(f"w{j}" for j in range(k % 37)) + " \n") for k in range(400)] + [(None, "a b c"), (70, None)]
    got = tiled(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], (r["text"] or "").split()) for r in got), key=str) == sorted(((i, changed(i, t)) for i, t in rows), key=str)


def test_query_equals_brute_force(spark, sf_dir, tmp_path):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect() if len(r["text"] or "") < 6000]
    docs += [(1000 + k, "begin " + "u v w x y " * 8 + "end") for k in range(40)] + [(5000, None), (5001, ""), (None, "a b " * 20)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = op11_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    assert sorted(map(tuple, got.collect()), key=str) == sorted((answer(i, t) for i, t in docs), key=str)
