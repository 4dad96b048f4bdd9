"""Runs of repeated words inside a text, found by a suffix automaton.

A run is a stretch of words with smallest period q that neither neighbour extends. The automaton's states stand for the distinct
stretches of a text; a state's end positions are those of its children in the link tree, merged small into large as ordered
sets. Whenever two positions at distance d become neighbours in a state of length d or more, the stretches that end there
overlap or touch: a square of period d, which is extended to its run. Between neighbours no copy of the state ends, so d is the
smallest period of every run that is long enough to be asked for (a shorter one would put another end between them).

Only stretches whose k-grams all recur nearby can hold such a run; a hash filter cuts a text into these first, and the automaton
is built for each. It never loses a run, so most texts need no automaton, and its memory (about 1 kB a word) is that of the
longest stretch with recurring k-grams, not of the text.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BASE, fmix, mapped

#: White space between words, as a Java and Python pattern; bytes.split() cuts at the same six.
SPACE = r"[\x20\x09-\x0D]+"


def automaton(codes: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Lengths, links and own end positions (-1: none, a copied state) of the suffix automaton's states; state 0 is empty."""
    length, link, own, go = [0], [-1], [-1], [{}]
    last = 0
    for i, c in enumerate(codes):
        state = len(length)
        length.append(i + 1)
        link.append(0)
        own.append(i)
        go.append({})
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = state
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                copy = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                own.append(-1)
                go.append(go[q].copy())
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    return length, link, own


def runs_of(codes: list[int], least: int, power: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least `least` words and `power` periods (power 2 or more), by start and period."""
    length, link, own = automaton(codes)
    # a run of length l and period d makes neighbours at distance d in a state of length l - d; no shorter state is needed
    useful = min(max((power - 1) * d, least - d) for d in range(1, least + 1))
    order = sorted((v for v in range(1, len(length)) if length[v] >= useful), key=length.__getitem__, reverse=True)
    waiting: dict[int, list[list[int]]] = {}
    known: dict[int, tuple[list[int], list[int]]] = {}  # period -> starts and stops of its runs, which overlap by less than a period
    n = len(codes)
    for v in order:
        sets, size = waiting.pop(v, []), length[v]
        if own[v] >= 0:
            sets.append([-own[v]])
        ends = max(sets, key=len)  # positions are kept negative: a state's own one comes first in the text, so it goes to the list's end
        if len(sets) > 1:
            new = [e for s in sets if s is not ends for e in s]
            for e in new:
                insort(ends, e)
            for e in new:
                k = bisect_left(ends, e)
                for low, high in zip(ends[max(0, k - 1) : k + 1], ends[max(1, k) : k + 2]):
                    d = high - low
                    if not 0 < d <= size or size < (power - 1) * d or size + d < least:
                        continue
                    start, stop = -high - size + 1, -low + 1
                    starts, stops = known.setdefault(d, ([], []))
                    at = bisect_right(starts, start)
                    if at and stop <= stops[at - 1]:
                        continue
                    while start and codes[start - 1] == codes[start - 1 + d]:
                        start -= 1
                    while stop < n and codes[stop] == codes[stop - d]:
                        stop += 1
                    at = bisect_left(starts, start)
                    if at == len(starts) or starts[at] != start:
                        starts.insert(at, start)
                        stops.insert(at, stop)
        up = link[v]
        if length[up] >= useful:
            waiting.setdefault(up, []).append(ends)
    return sorted((start, stop - start, d) for d, (starts, stops) in known.items() for start, stop in zip(starts, stops))


def suspects(codes: np.ndarray, least: int, power: int) -> list[tuple[int, int]]:
    """Stretches (start, stop) outside of which no run lies: all their k-grams occur twice within a `power`-th of the stretch.
    In a run of length l and period q, l - 2q >= least * (power - 2) / power, so each k-gram of that length and one has a copy at
    distance q inside the run."""
    k = 1 + least * (power - 2) // power
    todo, out = [(0, len(codes))], []
    while todo:
        a, b = todo.pop()
        n = b - a
        if n < least:
            continue
        mixed, grams = fmix(codes[a:b].astype(np.uint64) + np.uint64(1)), np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            grams *= BASE
            grams += mixed[j : n - k + 1 + j]
        order = np.argsort(grams, kind="stable")
        ranked = grams[order]
        near = np.flatnonzero((ranked[1:] == ranked[:-1]) & (order[1:] - order[:-1] <= n // power))
        if not len(near):
            continue
        edge = np.zeros(n + 1, np.int32)
        starts = np.zeros(n - k + 1, np.int32)
        starts[order[near]] = starts[order[near + 1]] = 1
        edge[: n - k + 1] += starts
        edge[k:] -= starts
        inside = np.concatenate([[0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0]])
        turn = np.diff(inside)
        parts = list(zip((np.flatnonzero(turn == 1) + a).tolist(), (np.flatnonzero(turn == -1) + a).tolist()))
        if parts == [(a, b)]:
            out.append((a, b))
        else:
            todo += parts
    return sorted(out)


def text_runs(words: list[bytes], least: int, power: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs among words."""
    if len(words) < least:
        return []
    index: dict[bytes, int] = {}
    codes = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
    found = []
    for a, b in suspects(codes, least, power):
        found += [(start + a, size, period) for start, size, period in runs_of(codes[a:b].tolist(), least, power)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 24, power: int = 3) -> DataFrame:
    """key, n_words, runs (start, length and period in words, by start and period) and collapsed, the text that keeps of each run
    its first period, words joined by one space.

    Words are separated by ASCII white space. A null or empty text has no words and an empty collapsed text; rows that share a key
    or have none stay as they are; other columns are not looked at.
    """

    def run(batches):
        import pyarrow as pa

        fields = ("start", "length", "period")
        for batch in batches:
            counts, ends, spans, kept = [], [0], [], []
            for value in batch.column("text"):
                words = (value.as_py() or "").encode().split()
                found = text_runs(words, least, power)
                counts.append(len(words))
                spans += found
                ends.append(len(spans))
                if found:
                    edge = np.zeros(len(words) + 1, np.int64)
                    for start, size, period in found:
                        edge[start + period] += 1
                        edge[start + size] -= 1
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                kept.append(b" ".join(words))
            columns = np.array(spans, np.int64).reshape(-1, 3).T
            runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(c) for c in columns], list(fields)))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(counts, pa.int64()), runs, pa.array(kept, pa.binary()).cast(pa.string())], ["key", "n_words", "runs", "collapsed"])

    kind = docs.schema[key].dataType.simpleString()
    out = mapped(docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")), run, f"key {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return out.withColumnRenamed("key", key)


def tiled(docs: DataFrame) -> DataFrame:
    """doc_id and text; in every tenth document by crc32 of the id (a null id counts as the empty string) the words from a on
    repeat the p words from a."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), SPACE), "")
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, F.floor(h / 10)).alias("g")).withColumn("w", F.when(F.col("g").isNotNull(), words))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    copies = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), copies))
    changed = F.concat_ws(" ", F.slice(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), F.lit(1), F.col("n")))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def strongest(runs: Column) -> Column:
    """The run of greatest length / period, then smallest start, then smallest period; null if there is none."""

    def better(best: Column, x: Column) -> Column:
        left, right = x["length"] * best["period"], best["length"] * x["period"]  # compared as whole numbers
        first = (x["start"] < best["start"]) | (x["start"] == best["start"]) & (x["period"] < best["period"])
        return F.when(best.isNull() | (left > right) | (left == right) & first, x).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"), better)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(tiled(spark.read.parquet(f"{sf_dir}/documents.parquet"))).withColumn("best", strongest(F.col("runs")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
