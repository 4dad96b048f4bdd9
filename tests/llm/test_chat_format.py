import duckdb

from ledgerlark.llm.chat_format import ORACLE_SQL, format_chats, op5_chat_format


def brute(rows):
    convs = {}
    for c, t, r, x in set(rows):
        convs.setdefault(c, []).append((t, r, x))
    low = lambda v: (v is not None, v if v is not None else 0)
    convs = {c: [(r, x) for _, r, x in sorted(v, key=lambda z: [(q is not None, q or (0 if i == 0 else "")) for i, q in enumerate(z)])] for c, v in convs.items()}
    out = []
    groups = {}
    for c, v in convs.items():
        groups.setdefault(tuple(v), []).append(c)
    for v, ids in groups.items():
        if not any(len(w) > len(v) and w[: len(v)] == v for w in groups):
            text = "".join(f"<|{'unknown' if r is None else r}|>\n{x or ''}\n<|end|>\n" for r, x in v)
            out.append((min((i for i in ids if i is not None), default=None), len(v), len(ids), text))
    return sorted(out, key=str)


def test_query_against_brute_force_and_sql(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, op5_chat_format(spark, sf_dir).collect()), key=str)
    assert got == brute(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    assert sorted(con.execute(ORACLE_SQL).fetchall(), key=str) == got


def test_snapshots_copies_nulls(spark):
    a, b, c = ("user", "hi"), ("assistant", "hello"), ("user", None)
    rows = [(i, t, *x) for i, conv in enumerate([[a], [a, b], [a, b, c], [a, b, ("user", "")], [a, b, c], [b]]) for t, x in enumerate(conv)]
    rows += [(9, 0, *a), (9, 0, *a), (9, None, None, None), (None, 0, "user", "x"), (None, 1, "user", "y"), (10, 0, "user", "x"), (11, 0, "user", "z" * 300_000)]
    turns = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn int, role string, text string, n int, h1 long")
    got = sorted(map(tuple, format_chats(turns).collect()), key=str)
    assert got == brute(rows) and {r[0] for r in got} == {2, 3, 5, 9, None, 11}
    assert format_chats(turns.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    plan = op5_chat_format(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
