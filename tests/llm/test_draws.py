"""Samples beside draws made again in Python: Spark's 64-bit hash of seed and id, Gumbel keys, the k largest, Poisson draws."""

import math
import struct

from xxhash import xxh64_intdigest

import corpus_pipeline
from ledgerlark.llm.mixing import mix, op9_mixing
from ledgerlark.llm.quality import op7_quality


def uniform(seed, doc_id):
    h = xxh64_intdigest(struct.pack("<q", doc_id), xxh64_intdigest(struct.pack("<i", seed), 42))
    return ((h - (h >> 63 << 64)) % (1 << 52)) / float(1 << 52)


def test_gumbel_sample(spark):
    rows = op7_quality(spark, "/root/testdata/sf0.01").collect()
    keys = {}
    for r in rows:
        if r.log_weight is None:
            assert r.gumbel_key is None and not r.selected
        else:
            keys[r.doc_id] = r.log_weight - math.log(-math.log(uniform(11, r.doc_id) + 0.5 / (1 << 52)))
            assert math.isclose(r.gumbel_key, keys[r.doc_id], rel_tol=1e-9, abs_tol=1e-9)
    first = sorted(keys, key=lambda i: -keys[i])[: math.ceil(0.75 * len(keys))]
    assert {r.doc_id for r in rows if r.selected} == set(first) and len(keys) > 900


def test_mixing_draws(spark):
    rows = op9_mixing(spark, "/root/testdata/sf0.01").collect()
    assert all(r.selected == (uniform(5, r.doc_id) < r.probability) for r in rows) and 0.5 < sum(r.selected for r in rows) / len(rows) < 1
    total = sum(r.n_tokens for r in rows)
    assert abs(sum(r.n_tokens * r.probability for r in rows) / total - 0.8) < 1e-6


def test_pipeline_keeps_what_is_drawn(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wanted = {r.doc_id for r in mix(docs).collect() if uniform(5, r.doc_id) < r.probability}
    assert {r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, "").select("doc_id").collect()} == wanted and wanted
