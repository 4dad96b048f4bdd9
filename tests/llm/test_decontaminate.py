import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlark.llm.decontaminate import FMIndex, decontaminate, merge_spans, op8_decontamination, remove_spans

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s or "")


def brute(docs, items, window=10):
    windows = {}
    for i, t in items:
        w = WORD.findall(low(t))
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(str(i))
    sizes = sorted({len(w) for w in windows})
    out = []
    for i, t in docs:
        w = WORD.findall(low(t))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=12), min_size=1, max_size=6), st.lists(st.integers(1, 3), min_size=1, max_size=4))
def test_fm_index_finds_every_place(runs, phrase):
    text = np.array([x for r in runs for x in [*r, 0]])
    index = FMIndex(text, 3, sample=3)
    lo, hi = index.search(np.array([phrase]))
    got = sorted(index.locate(np.arange(lo[0], hi[0])).tolist())
    assert got == [i for i in range(len(text)) if text[i : i + len(phrase)].tolist() == phrase]


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()
    got = sorted(map(tuple, op8_decontamination(spark, sf_dir).collect()), key=str)
    assert got == brute(docs, items) and any(r[5] for r in got)


def test_odd_rows_in_blocks(spark):
    items = spark.createDataFrame([(1, "One two THREE four"), (2, "four five"), (3, None), (4, "..."), (None, "zzz"), (5, "a b c d e f g h i j k l"), (5, "ünï"), (6, "four five")], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, "x ONE, two-three:four five y"), (None, "b c d e f g h i j k"), (4, "a b c d e f g h i j k l " * 300), (4, "ünï zzz"), (4, "ünï zzz"), (5, "w" * 300_000 + " four five")]
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, n_hit int, items string")
    for block in (16_000_000, 12):
        found = decontaminate(docs, items, block_chars=block).collect()
        got = sorted(((r.doc_id, r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.n_hit > 0) for r in found), key=str)
        assert got == brute(rows, [(r.item_id, r.text) for r in items.collect() if r.item_id is not None])
        by = {r.text: r for r in found}
        assert remove_spans(rows[2][1], [(s.start, s.end) for s in by[rows[2][1]].spans]) == "x  y"
    assert decontaminate(docs.limit(0), items).count() == 0
    assert decontaminate(docs, items.limit(0)).agg({"n_hit": "max"}).first()[0] == 0


def test_merge_spans():
    assert merge_spans([(5, 9), (0, 3), (3, 4), (8, 12)]) == [(0, 4), (5, 12)]
