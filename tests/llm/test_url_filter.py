from collections import defaultdict
from urllib.parse import urlsplit  # noqa: F401

from ledgerlark.llm.url_filter import RULES, filter_urls, op4_url_filter


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    cut = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:cut]


def rule_of(host, path):
    fits = [(len(r), r, v) for r, v in RULES for n, _, p in [r.partition("/")] if (host == n or host.endswith("." + n)) and path.startswith("/" + p)]
    return max(fits)[1:] if fits else (None, None)


def ranks(seeds, edges, d=0.85, n=20):
    total = defaultdict(float)
    for (s, _), w in edges.items():
        total[s] += w
    r = {h: (1 - d) * x for h, x in seeds.items()}
    base = dict(r)
    for _ in range(n):
        new = defaultdict(float, base)
        for (s, t), w in edges.items():
            new[t] += d * r.get(s, 0) * w / total[s]
        r = new
    return r


def brute(pages):
    info = [(i, *parse(u), h) for i, u, h in pages]
    hosts = defaultdict(list)
    edges = defaultdict(float)
    import re

    for i, host, path, html in info:
        hosts[host].append(rule_of(host, path)[1])
        for t in {x.lower() for x in re.findall(r'href="https?://([^/?#"]+)', html or "")}:
            if t != host and host:
                edges[host, t] += 1
    share = lambda v: {h: x.count(v) / len(x) for h, x in hosts.items() if h}
    trust, distrust = ranks(share("allow"), edges), ranks(share("block"), {(b, a): w for (a, b), w in edges.items()})
    out = []
    for i, host, path, _ in info:
        rule, verdict = rule_of(host, path)
        bad = distrust.get(host, 0) > trust.get(host, 0) and distrust.get(host, 0) >= 0.5 * 0.15
        out.append((i, host, path, rule, verdict or ("block" if bad else "allow")))
    return sorted(out, key=str)


def test_query_against_brute_force(spark, sf_dir):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert sorted(map(tuple, op4_url_filter(spark, sf_dir).collect()), key=str) == brute(pages)


def test_graph_and_odd_rows(spark):
    link = lambda *hosts: "".join(f'<a href="https://{h}/x">y</a>' for h in hosts)
    rows = [
        (1, "http://A.example.com/en/1", link("friend.org")), (2, "http://www.example.com/en/1", link("friend.org")), (3, "https://bad.net/es/1", link("far.io")), (4, "https://bad.net/fr/", None),
        (5, "http://linker.org/a", link("bad.net", "bad.net")), (6, "http://friend.org?x://y", link("FAR.io")), (7, None, "x"), (8, "no scheme", link("bad.net")), (8, "no scheme", link("bad.net")),
        (9, "http://notnet/es/", ""), (10, "x://net/es/#/fr/", ""), (None, "http://example.com", "q" * 100_000), (11, "http://com.example.org/en/", link("linker.org"))]
    pages = spark.createDataFrame([(*r, "z", 0.5) for r in rows], "page_id long, url string, html string, host string, trust double")
    for limit in (500_000, 0):
        got = filter_urls(pages, broadcast_bytes=limit).select("page_id", "host", "path", "rule", "verdict").collect()
        assert sorted(map(tuple, got), key=str) == brute(rows)
    assert {r.page_id: r.verdict for r in got}[5] == "block"
    assert filter_urls(pages.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    plan = op4_url_filter(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
