import hashlib
import itertools
import re

import numpy as np

from ledgerlark.llm.fill_middle import CLASS, CLASSES, GO, MEMORY, POINT, SENTINEL, UNIT, fill_in_middle, op12_fill_middle, restored, scan
from pyspark.sql import functions as F

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def answer(doc_id, text):
    text = text or ""
    units, digest = UNITS.findall(text), hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h4 % 100 < 80
    return doc_id, n, "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}", text


def texts():
    rng = np.random.default_rng(5)
    letters = list("ab <<>>PSM\t\n\x0b\x1f") + ["é", "漢", "😀", " ", "<P>", "<S", "<"]
    out = ["", " ", "\n\t ", "a", " a", "a ", "<", "<P", "<P>", "x<S>y", "<<M>", "<P <S M>", "😀" * 50, "a<́P>", None]
    for k in range(600):
        chosen = letters if k % 3 == 0 else [x for x in letters if x not in ("<P>", ">")]
        out.append("".join(rng.choice(chosen, int(rng.integers(0, 60)))))
    return out + ["word <S " * 60000, "漢字 " * 30000, "x" * 300000]


def test_automaton_forgets():
    states = range(len(GO) // CLASSES)
    for word in itertools.product(range(CLASSES), repeat=MEMORY):
        ends = set()
        for s in states:
            for c in word:
                s = GO[s * CLASSES + c]
            ends.add(int(s))
        assert len(ends) == 1
    assert set(CLASS.tolist()) == set(range(CLASSES))


def test_scan_equals_a_walk_byte_by_byte():
    raw = np.frombuffer(b"\xff".join(t.encode() for t in texts()[:-3] if t is not None) + b"\xff", np.uint8)
    state, want = 0, []
    for c in CLASS[raw].tolist():
        want.append(state * CLASSES + c)
        state = int(GO[want[-1]])
    for lane in (2, 3, 64, 512, 1 << 20):
        assert scan(raw, lane).tolist() == want


def test_counts_of_transitions():
    for t in texts():
        taken = scan(np.frombuffer((t or "").encode() + b"\xff", np.uint8))
        assert (UNIT[taken].sum(), POINT[taken].sum(), SENTINEL[taken].sum()) == (len(UNITS.findall(t or "")), len(t or ""), len(re.findall("<[PSM]>", t or "")))


def test_outputs_and_restored_texts(spark):
    rows = [(k, t) for k, t in enumerate(texts())] + [(3, "again one"), (3, "again one"), (None, "no id here at all"), (None, None), (-7, "minus seven")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'z' AS form", "1 AS n", "2 AS key", "'q' AS output")
    made = fill_in_middle(docs).withColumn("restored", restored(F.col("output"), F.col("form")))
    got = sorted(map(tuple, made.collect()), key=str)
    assert got == sorted((answer(i, t) for i, t in rows), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert fill_in_middle(docs.limit(0)).count() == 0


def test_query(spark, sf_dir):
    want = []
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        *head, output, text = answer(r["doc_id"], r["text"])
        want.append((*head, *(hashlib.sha256(x.encode()).hexdigest() for x in (output, text))))
    got = op12_fill_middle(spark, sf_dir)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
