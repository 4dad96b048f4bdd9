import numpy as np
import pyarrow as pa
import pytest

from ledgerlark.llm import common
from ledgerlark.llm.common import BASE, CHUNK, byte_class, components, discard, fmix, row_slices, saved, shared_root, text_bytes, words


def brute_hashes(texts, table):
    out = []
    for t in texts:
        word, own = None, []
        for byte in (t or "").lower().encode() + b" ":
            if table[byte]:
                word = ((word or 0) * int(BASE) + (byte + 1) * int(BASE)) & 0xFFFFFFFFFFFFFFFF
            elif word is not None:
                own.append(word)
                word = None
        out.append([int(x) for x in fmix(np.array(own, np.uint64))])
    return out


@pytest.mark.parametrize("kind", ["space", "alnum"])
def test_words_against_plain_loops(kind):
    rng = np.random.default_rng(0)
    texts = [" ".join("".join(rng.choice(list("abcé1-"), rng.integers(1, 9))) for _ in range(rng.integers(0, 60))) for _ in range(30)]
    texts += [None, "", " ", "x", "w" * (2 * CHUNK + 17) + " end", "a " * (CHUNK // 2) + "b" * CHUNK + " c", "long " * 100_000]
    table = byte_class(kind)
    hashes, starts, stops, ends = words(*text_bytes(pa.array(texts, pa.string())), table)
    got = [[int(h) for h in hashes[a:b]] for a, b in zip(ends[:-1], ends[1:])]
    assert got == brute_hashes(texts, table) and all(b > a for a, b in zip(starts, stops))


def test_slices_cover_all_rows():
    texts = ["a" * n for n in (0, 5, 900, 3, 3, 3, 5000, 0)] + [None]
    for limit, most in ((10, 2), (1000, 100), (1, 1)):
        got = list(row_slices(pa.array(texts, pa.string()), limit, most))
        assert [i for a, b in got for i in range(a, b)] == list(range(len(texts))) and all(b - a <= most for a, b in got)
    assert list(row_slices(pa.array([], pa.string()))) == []


def test_components_against_plain_search(spark):
    rng = np.random.default_rng(1)
    pairs = [tuple(map(int, p)) for p in rng.integers(0, 200, (150, 2))]
    best = {i: i for p in pairs for i in p}
    for _ in range(200):
        for a, b in pairs:
            best[a] = best[b] = min(best[a], best[b])
    got = {r.id: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: c for i, c in best.items() if any(i in p and p[0] != p[1] for p in pairs)}


def test_work_tables_can_be_deleted_and_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    t = saved(spark.range(5).toDF("id"), "x")
    assert t.count() == 5
    discard(t, None, spark.range(1))
    with pytest.raises(Exception):
        spark.read.parquet(t.work_path)

    class Cluster:
        master = "spark://host:7077"

        class _jsc:
            class sc:
                def getCheckpointDir(self):
                    return self

                def isDefined(self):
                    return False

    class Session:
        sparkContext = Cluster

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError):
        shared_root(Session)
    assert common.BATCH_BYTES <= 8 << 20
