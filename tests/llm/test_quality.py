import numpy as np
import pyarrow as pa

from ledgerlark.llm.common import text_bytes
from ledgerlark.llm.quality import buckets_of, fit_ratio, kth_largest, op7_quality, resample, score, select_quality


def test_query_prefers_good_documents(spark):
    d = "/root/testdata/sf0.01"
    rows = op7_quality(spark, d).collect()
    n = sum(r.log_weight is not None for r in rows)
    assert len(rows) == 1000 and sum(r.selected for r in rows) == -(-n * 3 // 4)
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    share = lambda q: np.mean([r.selected for r in rows if label.get(r.doc_id) == q])
    assert share(1) > 0.8 > share(0) + 0.2


def test_scores_against_brute_force(spark):
    texts = ["a b c a b", "the cat sat", None, "", "...", "the the the cat", "B c"]
    docs = spark.createDataFrame([(i, t, i in (1, 5), 7) for i, t in enumerate(texts)], "doc_id long, text string, good boolean, n_grams int")
    ratio = fit_ratio(docs, "good", n_buckets=50)
    counts, per = np.ones((2, 50)), []
    for i, t in enumerate(texts):
        b, _ = buckets_of(*text_bytes(pa.array([t], pa.string())), 50)
        per.append(b)
        for k in b:
            counts[0, k] += 1
            counts[1, k] += i in (1, 5)
    counts /= counts.sum(axis=1, keepdims=True)
    assert np.allclose(ratio, np.log(counts[1]) - np.log(counts[0]))
    got = {r.doc_id: r for r in score(docs, ratio).collect()}
    for i, b in enumerate(per):
        assert got[i].n_grams == len(b) and ((got[i].log_weight is None) if not len(b) else abs(got[i].log_weight - ratio[b].sum()) < 1e-9)
    assert len(per[0]) == 9


def test_threshold_ties_and_empty(spark):
    rng = np.random.default_rng(1)
    v = [float(x) for x in rng.choice(np.round(rng.normal(size=700), 2), 3000)]
    df = spark.createDataFrame([(x,) for x in v] + [(None,)], "v double")
    for k in (1, 10, 1500, 3000):
        assert kth_largest(df, "v", k, few=50) == sorted(v)[-k]
    assert kth_largest(df.limit(0), "v", 3) is None
    docs = spark.createDataFrame([(None, "a b"), (1, None), (2, "x y"), (2, "x y")], "doc_id long, text string")
    labels = spark.createDataFrame([(2, 1), (2, 1), (None, 1), (1, None)], "doc_id long, quality int")
    for rows in (2_000_000, 0):
        got = select_quality(docs, labels, broadcast_bytes=rows).collect()
        assert len(got) == 4 and not next(r for r in got if r.doc_id == 1).selected
    assert select_quality(docs.limit(0), labels).count() == 0
    assert resample(spark.createDataFrame([(1, None)], "doc_id long, log_weight double")).first().selected is False
