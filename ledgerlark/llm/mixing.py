"""Mixing to target weights: iterative proportional fitting of token weights to source, language and topic marginals, then
a Poisson sample of the documents with the calibrated probabilities.

No document can be taken more than once, so the fit is one with a bound: probabilities are min(1, product of factors), and the
factors are raked until the expected tokens of every source, language and topic are its target. Cells (source, lang, topic)
are fitted on the driver up to a number of cells, else by joins; both ways take the same steps and stop by the same rule.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_class, discard, mapped, mb_slices, rows_of, saved, small, text_bytes, words

DIMS = ("source", "lang", "topic")
NONE = "(none)"
ROUNDS, CLOSE, STALL = 400, 1e-9, 15


def stalled(errors: list[float]) -> bool:
    """Whether the margins contradict each other: the largest error hasn't fallen by a fifth in STALL rounds."""
    return len(errors) > STALL and errors[-1] > 0.8 * errors[-1 - STALL]


#: Up to this number of languages their means go with the code of a task, else they are joined to the rows.
DRIVER_LANGS = 1024


@dataclass
class Topics:
    """Unit centroids (topic x bucket) of documents' hashed words, after the mean of a document's language is taken off. Means of
    more than DRIVER_LANGS languages are a written table (__lang, __mean) instead."""

    centroids: np.ndarray
    means: dict[str, np.ndarray] = field(default_factory=dict)
    mean: np.ndarray | None = None
    table: DataFrame | None = None

    def with_means(self, rows: DataFrame) -> DataFrame:
        """rows, with the column __mean of their language where the means are a table."""
        if self.table is None:
            return rows
        return rows.join(small(self.table), F.coalesce(F.col("lang").cast("string"), F.lit(NONE)) == F.col("__lang"), "left").drop("__lang")


def word_vectors(raw: np.ndarray, offsets: np.ndarray, buckets: int, long_word: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of each row, and the unit vector of 1 + log of the counts of its words of `long_word` bytes or more by hash bucket."""
    hashes, starts, stops, ends = words(raw, offsets, byte_class("alnum"))
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(ends))
    long = stops - starts >= long_word
    counts = np.bincount(owner[long] * buckets + (hashes[long] % np.uint64(buckets)).astype(np.int64), minlength=n * buckets).reshape(n, buckets)
    v = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0.0)
    return np.diff(ends), v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def centred(v: np.ndarray, langs: list[str], topics: Topics, joined=None) -> np.ndarray:
    """joined: the Arrow column __mean of the rows, where the means of languages are a table; null for a language without one."""
    if joined is None:
        means = np.array([topics.means.get(x, topics.mean) for x in langs])
    else:
        means = np.tile(topics.mean, (len(joined), 1))
        means[joined.is_valid().to_numpy(zero_copy_only=False)] = joined.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(topics.mean))
    out = v - means
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


#: Sums over documents are sums of whole numbers of this part of 1, so that they don't depend on the order of the rows.
UNIT = 1 << 24


def fit_topics(docs: DataFrame, n_topics: int = 8, buckets: int = 256, rounds: int = 25, long_word: int = 6, seed: int = 17, driver_langs: int = DRIVER_LANGS) -> Topics:
    """Spherical k-means of the hashed word vectors of all documents. The first centre is the document of the least hash of doc_id and
    text, each next one the document farthest from those so far. Vectors are written once, as two bytes a component; every round
    reads them and gives sums by centre, of which there are few. Of more than `driver_langs` languages no mean reaches the driver: they
    are joined to the vectors once, which then are written centred. Fewer different documents with long words than topics give as
    many topics as there are documents."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("lang")
    rows = docs.select(lang, F.col("text").cast("string").alias("text"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("key")).where("text is not null")

    def vectors(batches):
        import pyarrow as pa

        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            out = []
            for i, j in mb_slices(offsets):
                out += [v.astype("<f2").tobytes() if v.any() else None for v in word_vectors(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], buckets, long_word)[1]]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("lang"), pa.array(out, pa.binary())], ["key", "lang", "v"])

    held = saved(mapped(rows, vectors, "key long, lang string, v binary").where("v is not null"), "vectors")

    def read(batch) -> np.ndarray:
        return np.frombuffer(b"".join(batch.column("v").to_pylist()), "<f2").astype(np.float64).reshape(-1, buckets)

    def sums(batches):
        """Count and sum of each language's vectors."""
        import pyarrow as pa

        total: dict[str, np.ndarray] = {}

        def send():
            for name, x in total.items():
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([x.tolist()], pa.list_(pa.int64()))], ["name", "x"])
            total.clear()

        for batch in batches:
            names, own = np.unique(batch.column("lang").to_pylist(), return_inverse=True)
            add = np.zeros((len(names), buckets + 1))
            np.add.at(add, own, np.hstack([np.ones((len(own), 1)), np.rint(read(batch) * UNIT)]))
            for name, x in zip(names.tolist(), add.astype(np.int64)):
                total[name] = total.get(name, 0) + x
            if len(total) > 512:
                yield from send()
        yield from send()

    def summed(run, kind: str) -> DataFrame:
        parts = mapped(held, run, f"name {kind}, x array<long>").select("name", F.posexplode("x").alias("i", "x")).groupBy("name", "i").agg(F.sum("x").alias("x"))
        return parts.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("x")).select("name", "x.x")

    by_lang = saved(summed(sums, "string"), "languages")
    n_langs = by_lang.count()
    if not n_langs:
        return Topics(np.zeros((0, buckets)), {}, np.zeros(buckets))
    whole = np.array([r["x"] for r in by_lang.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).orderBy("i").collect()], np.float64)
    topics = Topics(np.zeros((0, buckets)), {}, whole[1:] / whole[0] / UNIT)
    few = n_langs <= driver_langs
    if few:
        topics.means = {r["name"]: np.array(r["x"][1:], np.float64) / r["x"][0] / UNIT for r in by_lang.collect()}
    else:
        mean = F.transform(F.slice("x", 2, buckets), lambda x: x.cast("double") / F.col("x")[0].cast("double") / F.lit(float(UNIT)))
        topics.table = saved(by_lang.select(F.col("name").alias("__lang"), mean.alias("__mean")), "means")
    model = replace(topics, table=None)  # for the tasks

    def centre(batches):
        import pyarrow as pa

        for batch in batches:
            x = centred(read(batch), [], model, batch.column("__mean"))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("lang"), pa.array([v.tobytes() for v in x], pa.binary())], ["key", "lang", "v"])

    def points(batch) -> np.ndarray:
        if few:
            return centred(read(batch), batch.column("lang").to_pylist(), model)
        return np.frombuffer(b"".join(batch.column("v").to_pylist()), np.float64).reshape(-1, buckets)

    if not few:
        old, held = held, saved(mapped(topics.with_means(held), centre, held.schema), "centred")
        discard(old)
    discard(by_lang)

    def farthest(centres: np.ndarray):
        """The document of a partition that is farthest from all centres (its highest cosine, to six places), of equal ones the least key."""
        def run(batches):
            import pyarrow as pa

            best = None
            for batch in batches:
                x, keys = points(batch), batch.column("key").to_numpy()
                near = (x @ centres.T).round(6).max(axis=1) if len(centres) else np.zeros(batch.num_rows)
                k = np.lexsort((keys, near))[0]
                if best is None or (near[k], keys[k]) < best[:2]:
                    best = near[k], keys[k], batch.column("lang")[k].as_py(), x[k].tobytes()
            if best:
                yield pa.RecordBatch.from_arrays([pa.array([float(best[0])]), pa.array([int(best[1])]), pa.array([best[2]]), pa.array([best[3]], pa.binary())], ["near", "key", "lang", "v"])

        return mapped(held, run, "near double, key long, lang string, v binary").orderBy("near", "key", "lang", "v").first()

    centres = np.zeros((0, buckets))
    while len(centres) < n_topics:
        r = farthest(centres)
        if len(centres) and r["near"] >= 1 - 1e-6:  # all documents are at a centre
            break
        centres = np.vstack([centres, np.frombuffer(r["v"], np.float64)])

    def assigned(centres: np.ndarray):
        def run(batches):
            import pyarrow as pa

            total = np.zeros((len(centres), buckets), np.int64)
            for batch in batches:
                x = points(batch)
                own = (x @ centres.T).round(6).argmax(axis=1)
                total += (np.eye(len(centres))[own].T @ np.rint(x * UNIT)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(centres)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.int64()))], ["name", "x"])

        return run

    for _ in range(rounds):
        total = np.array([r["x"] for r in sorted(summed(assigned(centres), "int").collect(), key=lambda r: r["name"])], np.float64) / UNIT
        size = np.linalg.norm(total, axis=1, keepdims=True)
        new = np.where(size > 1e-6, total / np.maximum(size, 1e-12), centres)
        done = np.allclose(new, centres, atol=1e-9)
        centres = new
        if done:
            break
    discard(held)
    topics.centroids = centres
    return topics


def measure(docs: DataFrame, topics: Topics, long_word: int = 6, text: str = "text", keep_text: bool = False) -> DataFrame:
    """docs with n_tokens (words) and topic `t0`, `t1`, ...: the centroid with the highest cosine (rounded to six places; the
    first of equal ones); without words of `long_word` bytes, or without text, `(none)`. Columns of these names are replaced."""
    added = ["n_tokens", "topic"]
    rows = docs.drop(*added).withColumn(text, F.col(text).cast("string"))
    kept = [f for f in rows.schema.fields if keep_text or f.name != text]
    out = T.StructType([*kept, T.StructField("n_tokens", T.LongType()), T.StructField("topic", T.StringType())])
    buckets, model, joined = topics.centroids.shape[1], replace(topics, table=None), topics.table is not None

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            raw, offsets = text_bytes(batch.column(text))
            langs = [NONE if x is None else x for x in batch.column("lang").cast(pa.string()).to_pylist()]
            means = batch.column("__mean") if joined else None
            n, names = [np.zeros(0, np.int64)], []
            for i, j in mb_slices(offsets):
                k, v = word_vectors(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], buckets, long_word)
                n.append(k)
                best = (centred(v, langs[i:j], model, means.slice(i, j - i) if joined else None) @ model.centroids.T).round(6).argmax(axis=1) if len(model.centroids) else np.zeros(j - i, int)
                names += [f"t{b}" if has and len(model.centroids) else NONE for b, has in zip(best, v.any(axis=1))]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(np.concatenate(n)), pa.array(names, pa.string())], [*(f.name for f in kept), *added])

    return mapped(topics.with_means(rows), run, out)


def reachable(present: np.ndarray, power: float, budget: float, reach: float) -> np.ndarray:
    """Shares in proportion to present**power, but none above its present share by more than `reach` of what the budget leaves
    room for; what is cut off goes to the others in proportion."""
    cap = present * (1 + reach * (1 / budget - 1))
    raised = np.where(present > 0, np.maximum(present, 1e-300) ** power, 0.0)
    full = np.zeros(len(present), bool)
    while True:
        rest = raised[~full].sum()
        c = (1 - cap[full].sum()) / rest if rest > 0 else 0.0
        over = ~full & (c * raised > cap * (1 + 1e-12))
        if not over.any():
            return np.where(full, cap, c * raised)
        full |= over


def rake(codes: list[np.ndarray], goals: list[np.ndarray], tokens: np.ndarray, start: float, rounds: int = ROUNDS, close: float = CLOSE) -> tuple[np.ndarray, float]:
    """Probabilities min(1, factors) of cells by which every margin expects its goal of tokens, and the largest error left, as a
    share of all. codes: margin value of each cell, by dimension; goals: expected tokens of each value.

    A step multiplies the cells of a margin value by what its cells below 1 need; cells at 1 leave it when their factor falls.
    """
    e, whole, errors = np.full(len(tokens), start), max(float(sum(goals[0])), 1e-300), []
    for r in range(rounds + 1):
        p = np.minimum(1.0, e)
        worst = max(float(np.abs(np.bincount(c, weights=tokens * p, minlength=len(g)) - g).max(initial=0)) for c, g in zip(codes, goals)) / whole
        errors.append(worst)
        if worst <= close or r == rounds or stalled(errors):
            return p, worst
        for c, g in zip(codes, goals):
            kept = np.bincount(c, weights=tokens * np.minimum(1.0, e), minlength=len(g))
            sure = np.bincount(c, weights=tokens * (e >= 1), minlength=len(g))
            free = kept - sure
            step = np.where((g > sure) & (free > 1e-12 * kept), (g - sure) / np.maximum(free, 1e-300), np.where(kept > 0, g / np.maximum(kept, 1e-300), 0.0))
            e = np.minimum(e * step[c], 1e9)
    raise AssertionError


def rake_frame(cells: DataFrame, goals: list[DataFrame], start: float, whole: float, rounds: int = ROUNDS, close: float = CLOSE) -> tuple[DataFrame, float]:
    """The same steps by joins and aggregates. goals: (dimension, goal) tables."""
    rows, t = cells.withColumn("e", F.lit(float(start))), F.col("tokens")
    held: DataFrame | None = None
    found: list[float] = []
    kept, sure = F.sum(t * F.least(F.lit(1.0), "e")), F.sum(F.when(F.col("e") >= 1, t).otherwise(0.0))
    for r in range(rounds + 1):
        errors = [rows.groupBy(d).agg(kept.alias("kept")).join(g, d, "full").select(F.abs(F.coalesce("kept", F.lit(0.0)) - F.coalesce("goal", F.lit(0.0))).alias("x")) for d, g in zip(DIMS, goals)]
        worst = float(errors[0].unionAll(errors[1]).unionAll(errors[2]).agg(F.max("x")).first()[0] or 0) / max(whole, 1e-300)
        found.append(worst)
        if worst <= close or r == rounds or stalled(found):
            return rows.withColumn("probability", F.least(F.lit(1.0), "e")).drop("e"), worst
        for d, g in zip(DIMS, goals):
            now = rows.groupBy(d).agg(kept.alias("kept"), sure.alias("sure")).join(g, d, "left").withColumn("goal", F.coalesce("goal", F.lit(0.0))).withColumn("free", F.col("kept") - F.col("sure"))
            step = now.select(d, F.when((F.col("goal") > F.col("sure")) & (F.col("free") > 1e-12 * F.col("kept")), (F.col("goal") - F.col("sure")) / F.col("free")).when(F.col("kept") > 0, F.col("goal") / F.col("kept")).otherwise(0.0).alias("step"))
            rows = rows.join(step, d).withColumn("e", F.least(F.col("e") * F.col("step"), F.lit(1e9))).drop("step")
        old, held = held, saved(rows, "rake")
        discard(old)
        rows = held
    raise AssertionError


@dataclass
class Mix:
    """The fit: cells with probabilities; expected tokens as a share of all; targets by value and how far they were moved
    towards the present shares (0: not at all); the largest margin error as a share of the expected tokens."""

    fitted: DataFrame
    budget: float
    targets: list[dict[str, float]] | None
    blend: float
    error: float


BLENDS = (0.0, 0.25, 0.5, 0.75, 0.875, 1.0)


def fit_mix(cells: DataFrame, budget: float, powers: tuple[float, float, float], targets: list[dict[str, float]] | None, reach: float = 0.5, driver_cells: int = 200_000) -> Mix:
    """Probabilities of the cells (source, lang, topic, tokens; a written table).

    Without targets, those of reachable() hold; three margins may still contradict each other, and then all targets move
    towards the present shares, by the first of BLENDS that can be met (the last always can). Given targets stay as they are,
    but for values without tokens, which are left out; the budget falls instead, to what the scarcest value allows and then by
    tenths until all are met.
    """
    spark, whole = cells.sparkSession, float(cells.agg(F.sum("tokens")).first()[0] or 0)
    names = ", ".join(f"c_{d} string" for d in DIMS)
    if not whole:
        return Mix(rows_of(spark, [], f"{names}, probability double"), 0.0, targets or [{}, {}, {}], 0.0, 0.0)
    on_driver = cells.count() <= driver_cells
    cells = cells.where("tokens > 0")
    if on_driver:
        held = cells.collect()
        tokens = np.array([r["tokens"] for r in held], float)
        values, codes = zip(*(np.unique([r[d] for r in held], return_inverse=True) for d in DIMS))
        present = [np.bincount(c, weights=tokens, minlength=len(v)) / whole for v, c in zip(values, codes)]

        def attempt(shares: list[np.ndarray], share: float):
            return rake(list(codes), [s * share * whole for s in shares], tokens, share)
    else:
        shares_of = [saved(cells.groupBy(d).agg((F.sum("tokens") / whole).alias("present")), "present") for d in DIMS]

        def attempt(shares: list[DataFrame], share: float):
            goals = [small(saved(x.select(d, (F.col("share") * share * whole).alias("goal")), "goal")) for d, x in zip(DIMS, shares)]
            return rake_frame(cells, goals, share, share * whole)

    def frame(p) -> DataFrame:
        if on_driver:
            return rows_of(spark, [(*(r[d] for d in DIMS), float(x)) for r, x in zip(held, p)], f"{names}, probability double")
        return saved(p.select(*(F.col(d).alias(f"c_{d}") for d in DIMS), "probability"), "fitted")

    def table(shares) -> list[dict[str, float]] | None:
        return [dict(zip(v.tolist(), s.tolist())) for v, s in zip(values, shares)] if on_driver else None

    if targets is not None:
        if on_driver:
            goal = [np.array([t.get(x, 0.0) for x in v]) for t, v in zip(targets, values)]
            shares = [g / max(g.sum(), 1e-300) for g in goal]
            allowed = min(float(np.min(p[s > 0] / s[s > 0], initial=1.0)) for p, s in zip(present, shares))
        else:
            wanted = [small(rows_of(spark, [(k, float(x)) for k, x in t.items()] or [(None, 0.0)], f"{d} string, goal double")) for d, t in zip(DIMS, targets)]
            both = [p.join(w, d, "left").withColumn("goal", F.coalesce("goal", F.lit(0.0))) for d, p, w in zip(DIMS, shares_of, wanted)]
            sums = [x.agg(F.sum("goal")).first()[0] or 1e-300 for x in both]
            shares = [x.select(d, "present", (F.col("goal") / s).alias("share")) for d, x, s in zip(DIMS, both, sums)]
            allowed = min(x.agg(F.min(F.when(F.col("share") > 0, F.col("present") / F.col("share")))).first()[0] or 1.0 for x in shares)
        share = min(budget, allowed)
        while True:
            p, error = attempt(shares, share)
            if error <= CLOSE or share < 1e-3:
                return Mix(frame(p), share, table(shares), 0.0, error)
            share *= 0.9
    for blend in BLENDS:
        if on_driver:
            shares = [(1 - blend) * reachable(p, k, budget, reach) + blend * p for p, k in zip(present, powers)]
        else:
            shares = [reachable_frame(x, d, k, budget, reach, blend) for x, d, k in zip(shares_of, DIMS, powers)]
        p, error = attempt(shares, budget)
        if error <= CLOSE or blend == 1:
            return Mix(frame(p), budget, table(shares), blend, error)
    raise AssertionError


def reachable_frame(present: DataFrame, d: str, power: float, budget: float, reach: float, blend: float) -> DataFrame:
    """(d, present, share): reachable() by aggregates; every round fixes the values at their cap."""
    rows = present.select(d, "present", (F.col("present") * (1 + reach * (1 / budget - 1))).alias("cap"), F.when(F.col("present") > 0, F.pow("present", F.lit(power))).otherwise(0.0).alias("raised"))
    c, full = 0.0, F.lit(False)
    while True:
        rest, capped = rows.agg(F.sum(F.when(~full, F.col("raised"))), F.sum(F.when(full, F.col("cap")))).first()
        c = (1 - (capped or 0.0)) / rest if rest else 0.0
        over = ~full & (F.lit(c) * F.col("raised") > F.col("cap") * (1 + 1e-12))
        if rows.where(over).isEmpty():
            return rows.select(d, "present", ((1 - blend) * F.when(full, F.col("cap")).otherwise(F.lit(c) * F.col("raised")) + blend * F.col("present")).alias("share"))
        rows = saved(rows.withColumn("full", full | over), "caps")
        full = F.col("full")


def plan(docs: DataFrame, budget: float = 0.8, powers: tuple[float, float, float] = (0.5, 0.5, 0.0), targets: list[dict[str, float]] | None = None, n_topics: int = 8, keep_text: bool = False, driver_cells: int = 200_000) -> tuple[DataFrame, Mix]:
    """docs with n_tokens and topic, and the fit of their cells."""
    docs = docs.drop("probability", "selected")
    for d in DIMS[:2]:
        if d not in docs.columns:
            docs = docs.withColumn(d, F.lit(None).cast("string"))
    topics = fit_topics(docs, n_topics)
    # measuring twice costs less than keeping the texts; without them the measures are kept
    rows = measure(docs, topics, keep_text=True) if keep_text else saved(measure(docs, topics), "measured")
    counted = measure(docs.select("source", "lang", "text"), topics) if keep_text else rows
    cell = [F.coalesce(F.col(d).cast("string"), F.lit(NONE)).alias(d) for d in DIMS]
    cells = saved(counted.select(*cell, "n_tokens").groupBy(*DIMS).agg(F.sum("n_tokens").cast("double").alias("tokens")), "cells")
    return rows, fit_mix(cells, budget, powers, targets, driver_cells=driver_cells)


def mix(docs: DataFrame, budget: float = 0.8, powers: tuple[float, float, float] = (0.5, 0.5, 0.0), targets: list[dict[str, float]] | None = None, n_topics: int = 8, seed: int = 5, keep_text: bool = False, driver_cells: int = 200_000) -> DataFrame:
    """docs with n_tokens, topic, probability and selected.

    targets: shares by value of source, lang and topic; else the present token shares to `powers`, as far as `budget` (expected
    tokens as a share of all) lets them be met: see fit_mix(). A null source or lang is the value `(none)`. Documents without
    words have probability 0. Draws hash doc_id and the seed, so a rerun, and every copy of a row, draws the same. An empty
    table gives an empty result; other columns pass through, those of the added names are replaced.
    """
    rows, fit = plan(docs, budget, powers, targets, n_topics, keep_text, driver_cells)
    on = [F.coalesce(rows[d].cast("string"), F.lit(NONE)) == fit.fitted[f"c_{d}"] for d in DIMS]
    u = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 52)).cast("double") / float(1 << 52)
    out = rows.join(small(fit.fitted), on, "left").drop(*(f"c_{d}" for d in DIMS))
    out = out.withColumn("probability", F.when(F.col("n_tokens") > 0, F.coalesce("probability", F.lit(0.0))).otherwise(0.0))
    return out.withColumn("selected", u < F.col("probability"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    return mix(docs).select("doc_id", "source", "lang", "topic", "n_tokens", "probability", "selected")
