"""Language ID against plain loops over letters, trigrams and vectors."""

import math

import numpy as np

from ledgerlark.llm.lang_id import CLASSES, fit_profiles, fold, letter_classes, op1_language_id, predict

DIMS = 1024


def brute_vector(text, letters, classes):
    """Sum of bound trigrams of one text, one trigram at a time; None without a letter."""
    kinds = [int(classes[ord(c)]) for c in f"\n{text.lower()}\n"]
    if not any(kinds):
        return None, {}
    squeezed = [k for i, k in enumerate(kinds) if i == 0 or k or kinds[i - 1]]
    counts = {}
    for a, b, c in zip(squeezed, squeezed[1:], squeezed[2:]):
        counts[a, b, c] = counts.get((a, b, c), 0) + 1
    return counts, {t: np.roll(letters[t[0]], 2) * np.roll(letters[t[1]], 1) * letters[t[2]] for t in counts}


def unit(v):
    n = math.sqrt(sum(float(x) * float(x) for x in v))
    return v / n if n else v


def brute(rows, learn):
    letters = np.random.default_rng(7).choice(np.array([-1, 1], np.float32), (CLASSES, DIMS)).astype(np.float64)
    classes = letter_classes()
    made = {}
    for text, lang in learn:
        if text is None or lang is None:
            continue
        counts, vectors = brute_vector(text, letters, classes)
        if counts:
            norm = math.sqrt(sum(n * n for n in counts.values()))
            made[lang] = made.get(lang, 0) + sum(n / norm * vectors[t] for t, n in counts.items())
    names = sorted(made)
    protos = [unit(made[n]) for n in names]
    mean = sum(protos) / len(protos) if len(protos) > 1 else np.zeros(DIMS)
    protos = [unit(p - mean) for p in protos]
    out = []
    for text in rows:
        counts, vectors = brute_vector(text or "", letters, classes)
        if not counts:
            out.append(("und", {}))
            continue
        v = unit(unit(sum(n * vectors[t] for t, n in counts.items())) - mean)
        cos = {n: float(v @ p) for n, p in zip(names, protos)}
        out.append((max(names, key=lambda n: (round(cos[n], 6), [-ord(c) for c in n])), cos))
    return out


def test_query_against_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", (fold() != 2).alias("learn")).collect()
    want = brute([r.text for r in rows], [(r.text, r.lang) for r in rows if r.learn])
    got = {r.doc_id: r for r in op1_language_id(spark, sf_dir).collect()}
    for r, (lang, cos) in zip(rows, want):
        g = got[r.doc_id]
        best = sorted(cos.values(), reverse=True)
        if len(best) < 2 or best[0] - best[1] > 1e-4:  # single against double precision
            assert g.lang_pred == lang
        if cos:
            assert abs(g.cosine - best[0]) < 1e-4
            assert abs(g.score - 1 / sum(math.exp(16 * (c - best[0])) for c in best)) < 1e-2


def test_of_equal_languages_the_first_wins(spark):
    docs = spark.createDataFrame([(i, "the cat sat on the mat", lang) for i, lang in enumerate(("zz", "aa", "mm", "zz", "aa", "mm"))], "doc_id long, text string, lang string")
    model = fit_profiles(docs)
    assert model.languages == ["aa", "mm", "zz"]
    assert predict(["the cat", "on a mat"], model)[0] == ["aa", "aa"]
    assert fit_profiles(docs.unionByName(docs.where("lang = 'mm'")), most_languages=2).languages == ["aa", "mm"]
