import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlark.llm import ngram_join
from ledgerlark.llm.ngram_join import (
    Frequent, divide_skip, join, long_lists, need, op3_ngram_join, pairs_of_long_lists, pairs_of_short_lists, scan_postings, shingle_sets, sketches)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size=4):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def brute(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows]
    distinct = {}
    for i, s in sets:
        distinct.setdefault(s, []).append(i)
    keys = [k for k in distinct if k]
    parent = {k: k for k in keys}

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    by = {}
    for k in keys:
        for t in k:
            by.setdefault(t, []).append(k)
    for k in keys:
        seen = {}
        for t in k:
            for o in by[t]:
                seen[o] = seen.get(o, 0) + 1
        for o, n in seen.items():
            if o is not k and 100 * n >= percent * (len(k) + len(o) - n):
                parent[top(k)] = top(o)
    least = {}
    for k in keys:
        least[top(k)] = min(distinct[k] + [least.get(top(k), distinct[k][0])])
    return sorted((i, len(s), least[top(s)] if s else i) for i, s in sets)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), unique=True).map(sorted), max_size=12), st.lists(st.integers(1, 9), min_size=10, max_size=10), st.integers(0, 4))
def test_divide_skip(lists, least, always):
    want = [m for m in range(10) if sum(m in x for x in lists) >= least[m]]
    assert divide_skip(lists, least, always) == want


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(1)
    sets = [np.sort(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (3, 40, 900)]
    sets += [np.sort(np.concatenate([x[: len(x) * 9 // 10], rng.integers(0, 2**63, 5, dtype=np.uint64)])) for x in sets]
    bits = sketches(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    for a, x in enumerate(sets):
        for b, y in enumerate(sets):
            apart = sum(int(v).bit_count() for v in (bits[a] ^ bits[b]).view(np.uint64))
            assert apart <= len(set(x.tolist()) ^ set(y.tolist()))


def test_need():
    for a in range(1, 60):
        for b in range(1, 60):
            assert need(a, b, 85) == next((i for i in range(200) if 100 * i >= 85 * (a + b - i)))


def test_query_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in op3_ngram_join(spark, d).collect())
    assert got == brute(rows) and any(c != i for i, _, c in got)


def test_groups_chains_and_shared_passages(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    base, passage = [word() for _ in range(120)], [word() for _ in range(80)]
    texts = []
    for k in range(60):  # near copies of one text, each with changes of its own
        t = list(base)
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = word()
        texts.append(t)
    for k in range(60):  # a passage that fills most of each text
        texts.append(passage + [word() for _ in range(rng.randrange(0, 25))])
    for k in range(25):  # a chain: each text a little further
        base = base[5:] + [word() for _ in range(5)]
        texts.append(list(base))
    texts += [texts[3]] * 5 + [[word()] for _ in range(3)] + [["a", "b"], ["A", "B"], ["b", "a"]]
    rows = [(1000 - 7 * i, " ".join(t)) for i, t in enumerate(texts)] + [(5001, ""), (5002, None), (5003, " \t ")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, n long, token int")
    for kind in ({}, {"broadcast_bytes": 0, "longest": 5, "large": 2}):
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in join(docs, **kind).collect()) == brute(rows)


def test_pairs_of_short_and_long_lists_agree(spark):
    rng = np.random.default_rng(3)
    rows = [(int(t), int(d), int(80 + d % 30), int(d % 5)) for t in range(40) for d in rng.choice(200, rng.integers(2, 60), replace=False)]
    entries = spark.createDataFrame(rows, "token long, doc long, n long, component long")
    want = {}
    for t, d, n, c in rows:
        for u, e, m, k in rows:
            if t == u and d < e and c != k and n * 100 >= 85 * m and m * 100 >= 85 * n:
                want[d, e, n, m] = want.get((d, e, n, m), 0) + 1
    same = spark.createDataFrame([(d, 80 + d % 30, [7] * 16) for d in range(200)], "doc_id long, n long, sketch array<long>")
    for pairs in (pairs_of_short_lists(entries, 85, 500), pairs_of_long_lists(entries, same, 85)):
        got = {}
        for r in pairs.collect():
            got[tuple(r)[:4]] = got.get(tuple(r)[:4], 0) + r.lists
        assert got == want


def test_odd_rows(spark):
    rows = [(None, "one two three four five"), (3, "one two three four five"), (2, "one two three four five"), (2, "one two three four five"), (None, "only without an id"), (9, "w" * 300_000), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in join(docs).collect()), key=str)
    assert got == sorted([(None, 2, 2), (3, 2, 2), (2, 2, 2), (2, 2, 2), (None, 1, None), (9, 1, 9), (None, 0, None)], key=str)
    assert join(docs.limit(0)).count() == 0


def test_long_lists_take_one_step_in_python(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e g"), (3, "a b c d e f"), (None, "a b c d"), (4, "x"), (5, None)], "doc_id long, text string").coalesce(1)
    raw = np.frombuffer(b"a b c d e f", np.uint8)
    tokens, _ = shingle_sets(raw, np.array([0, len(raw)]), 4)  # a..d, b..e, c..f: the first two are in documents 1 and 2
    frequent = spark.sparkContext.broadcast(Frequent(tokens, np.arange(1, 4)))
    plans, write = [], ngram_join.saved

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(ngram_join, "saved", watched)
    rows = long_lists(scan_postings(docs, 4, 1, frequent, 8, True)).collect()
    assert sorted((r["doc"], r["n"], r["length"]) for r in rows) == [(1, 3, 2), (1, 3, 2), (2, 3, 2), (2, 3, 2)]
    assert {r["token"] for r in rows} <= set(tokens.view(np.int64).tolist())
    assert [p.count("MapInArrow") for p in plans] == [1]
