import math

import numpy as np

from ledgerlark.llm.embedding_dedup import Codes, agree, dedup, encode, estimates, op2_embedding_dedup, rotation, tables_for


def brute(rows, threshold=0.9):
    ok = [(k, np.array(v, float) / np.abs(np.array(v, float)).max()) for k, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    links = {k: [m for m, w in ok if m != k and len(w) == len(v) and v @ w / math.sqrt((v @ v) * (w @ w)) >= threshold] for k, v in ok}
    out = []
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for m in links.get(todo.pop(), []):
                if m not in seen:
                    seen.add(m)
                    todo.append(m)
        c = min((rows[m][0] for m in seen if rows[m][0] is not None), default=None)
        out.append((i, len(links.get(k, [])), c, i == c))
    return sorted(out, key=str)


def near(rng, x, cos):
    y = rng.normal(size=len(x))
    y -= (y @ x) * x / (x @ x)
    return cos * x / np.linalg.norm(x) + math.sqrt(1 - cos * cos) * y / np.linalg.norm(y)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(400, 64)), rng.normal(size=(300, 64))
    y[:100] = [near(rng, v, 0.9) for v in x[:100]]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    errors = []
    for seed in range(10):
        turned = rotation(64, 64, seed)
        assert np.allclose(turned @ turned.T, np.eye(64))
        own, other = encode(x, np.arange(400), turned, turned[:30]), encode(y, np.arange(300) + 1000, turned, turned[:30])
        est, bound = estimates(own, other, 4.0)
        errors.append(est - x @ y.T)
        assert (np.abs(errors[-1]) <= bound).mean() > 0.9999
    assert abs(np.mean(errors)) < 2e-3


def test_groups_copies_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows, n = [], 0
    for size in (1, 2, 40, 7):
        base = rng.normal(size=64)
        for k in range(size):
            rows.append((900 - n, near(rng, base, 0.975).tolist()))
            n += 1
    rows += [(2000 + k, rng.normal(size=64).tolist()) for k in range(150)]
    chain = rng.normal(size=64)
    for k in range(12):
        chain = near(rng, chain, 0.93)
        rows.append((3000 - k, (chain * 5).tolist()))
    rows += [(10, rows[3][1]), (11, rows[3][1]), (11, rows[3][1]), (None, rows[3][1]), (None, rng.normal(size=64).tolist())]
    rows += [(4000, None), (4001, []), (4002, [0.0] * 64), (4003, [1.0, None]), (4004, [float("nan")] * 64), (4005, [float("inf"), 1.0]), (4006, [1.0, 0.0]), (4007, [1e-300, 0.0]), (4008, [1e300, 1e299])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, key string")
    for kind in ({"recall": 0.99999}, {"recall": 0.99999, "block": 8}):
        assert sorted(map(tuple, dedup(df, **kind).collect()), key=str) == brute(rows)
    assert dedup(df.limit(0)).count() == 0


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(1500, 64))
    other = np.array([near(rng, x, c) for x, c in zip(base, rng.uniform(0.9, 0.99, 1500))])
    rows = [(i, x.tolist()) for i, x in enumerate(np.concatenate([base, other]))]
    got = dedup(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    true = ((x @ x.T) >= 0.9).sum() - len(rows)
    found = sum(r.n_links for r in got)
    assert 0.98 * true <= found <= true
    assert tables_for(100, 0.9, 0.995)[0] == 1 and tables_for(51_200, 0.9, 0.995)[0] == 7


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted(map(tuple, op2_embedding_dedup(spark, sf_dir).collect()), key=str) == brute(rows)


def test_codes_round_trip_and_plain_bits():
    rng = np.random.default_rng(7)
    for d in (3, 64, 100):
        unit = rng.normal(size=(9, d))
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        turned, planes = rotation(d, d, 1), rotation(d, 75, 2)
        c = encode(unit, np.arange(9), turned, planes)
        back = Codes.of(c.rows(), d)
        assert all((getattr(c, n) == getattr(back, n)).all() for n in ("signs", "planes", "scalars", "tables"))
        assert len(c.rows()[0]) == 5 * 8 * -(-d // 64) + 16 + 16  # codes, not vectors, travel
        table_bits = (unit @ planes.T >= 0).reshape(9, 5, 15)
        for t in range(5):
            i, j = np.divmod(np.arange(81), 9)
            assert (agree(c, i, c, j, t, 15) == (table_bits[i, t] == table_bits[j, t]).all(axis=1)).all()
        # the estimate by plain sums over dimensions
        rotated = unit @ turned.T
        est, _ = estimates(c, c, 4.0)
        f, low, step, _ = c.scalars[1].astype(float)
        level = [sum(int(c.planes[1, b, k // 64] >> np.uint64(k % 64) & np.uint64(1)) << b for b in range(4)) for k in range(d)]
        want = sum((1 if rotated[0, k] >= 0 else -1) * (low + step * level[k]) for k in range(d)) / math.sqrt(d) / float(c.scalars[0, 0])
        assert abs(est[0, 1] - want) < 1e-4
        assert all(abs(low + step * level[k] - rotated[1, k]) <= step * 1.001 for k in range(d))


def test_the_exact_way_compares_all(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(60, 16))
    rows = [(i, x.tolist()) for i, x in enumerate(np.concatenate([base, [near(rng, x, c) for x, c in zip(base, rng.uniform(0.85, 0.95, 60))]]))]
    got = sorted(map(tuple, dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), recall=1, block=16).collect()), key=str)
    assert got == brute(rows)
