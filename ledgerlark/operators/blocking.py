"""Embedding matcher: names embedded, blocked by k-means clusters, compared by cosine, audited."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import base62_8, best_name, cosine, dot, unit
from ..functions.text import normalize_text
from ..schemas import require_columns

KEYS = ["supplier_name", "street_address", "country"]
Embedder = Callable[[Column], Column]


def hashing_embedder(dims: int = 64) -> Embedder:
    """Signed counts of hashed letter trigrams (64-bit xxHash, Spark's seed) in one pass over a text; stands in for a hosted model and
    is the same everywhere. A null text reads as empty. The text's expression may hold no lambda, as of any Python function's."""

    @F.pandas_udf("array<float>")
    def counts(texts: pd.Series) -> pd.Series:
        from xxhash import xxh64_intdigest

        known: dict[str, tuple[int, int]] = {}  # grams of this batch

        def embed(text: str) -> np.ndarray:
            padded, out = f" {text} ", np.zeros(dims, np.float32)
            for i in range(max(len(padded) - 2, 1)):
                gram = padded[i : i + 3]
                if gram not in known:
                    h = xxh64_intdigest(gram.encode(), 42)
                    known[gram] = (h - (h >> 63 << 64)) % dims, 1 - 2 * (h >> 32 & 1)
                cell, sign = known[gram]
                out[cell] += sign
            return out

        return texts.map(embed)

    return lambda text: counts(F.coalesce(text, F.lit("")))


def embed_source(rows: DataFrame, embed: Embedder) -> DataFrame:
    """Master locations with ids, normalised fields and embeddings of both names; the legal name falls back to the other."""
    legal = F.coalesce("cleansed_legal_corporate_name", "cleansed_merchant_name")
    return rows.select(
        F.col("old_loc_id").cast("string").alias("loc_id"), base62_8(F.col("merchant_market_hierarchy_id")).alias("entity_id"), legal.alias("legal_name"), F.col("cleansed_merchant_name").alias("merchant_name"),
        normalize_text(F.col("cleansed_merchant_street_addr")).alias("street_addr"), F.col("cleansed_merchant_postal_code").alias("postal_code"), normalize_text(F.col("cleansed_state_province_code")).alias("state"),
        normalize_text(F.col("cleansed_country_code")).alias("country"), embed(normalize_text(legal)).alias("ln_emb"), embed(normalize_text(F.col("cleansed_merchant_name"))).alias("mn_emb"))


def fit_clusters(source: DataFrame, k: int = 100, seed: int = 42, iterations: int = 20):
    """k-means over both names' embeddings; rows without one teach nothing."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    both = source.select(F.col("ln_emb").alias("e")).unionByName(source.select(F.col("mn_emb").alias("e"))).where("e is not null")
    return KMeans(k=k, seed=seed, maxIter=iterations, predictionCol="cluster").fit(both.select(array_to_vector("e").alias("features")))


def with_cluster(rows: DataFrame, model, vector: str, name: str) -> DataFrame:
    """rows with the cluster of a vector; rows without the vector are left out."""
    from pyspark.ml.functions import array_to_vector

    return model.transform(rows.where(F.col(vector).isNotNull()).withColumn("features", array_to_vector(vector))).drop("features").withColumnRenamed("cluster", name)


def cluster_pairs(rows: DataFrame, source: DataFrame, cluster: str = "input_cluster_id") -> DataFrame:
    """Rows beside the source rows whose legal or other cluster is theirs: an equi-join on the exploded distinct clusters. Unit
    vectors are made once a row, before it meets its partners."""
    rows = rows.withColumn("in_unit", unit(F.col("in_emb")))
    source = source.withColumns({"ln_unit": unit(F.col("ln_emb")), "mn_unit": unit(F.col("mn_emb"))})
    spread = source.withColumn("__c", F.explode(F.array_distinct(F.array_compact(F.array("legal_cluster_id", "merchant_cluster_id")))))
    return rows.join(spread, rows[cluster] == spread["__c"]).drop("__c")


def best_matches(pairs: DataFrame, least: float = 0.60, top: int = 1) -> DataFrame:
    """The `top` best source rows of each supplier by the higher cosine of both names, from `least` on; ties by entity_id."""
    if "in_unit" in pairs.columns:  # of cluster_pairs()
        score = {n: F.when(F.size("in_emb") == F.size(f"{u}_emb"), F.coalesce(dot(F.col("in_unit"), F.col(f"{u}_unit")), F.lit(0.0))) for n, u in (("legal_name_score", "ln"), ("merchant_name_score", "mn"))}
    else:
        score = {n: cosine(F.col("in_emb"), F.col(u)) for n, u in (("legal_name_score", "ln_emb"), ("merchant_name_score", "mn_emb"))}
    scored = pairs.withColumns(score).drop("in_unit", "ln_unit", "mn_unit")
    scored = scored.withColumn("matched_score", F.greatest("legal_name_score", "merchant_name_score")).where(F.col("matched_score") >= least)
    scored = scored.withColumn("best_match_name", best_name(F.col("legal_name_score"), F.col("merchant_name_score"), F.col("legal_name"), F.col("merchant_name")))
    w = Window.partitionBy("supplier_id").orderBy(F.col("matched_score").desc(), "entity_id")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).withColumn("is_matched", F.lit("Y"))


def _units(vectors) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: the numbers of the vectors of that length and their unit vectors; a zero vector stays zero, one with a null or
    non-finite component counts as zero, nulls are left out."""
    at: dict[int, list[int]] = {}
    lists = vectors.to_pylist()
    for k, v in enumerate(lists):
        if v is not None:
            at.setdefault(len(v), []).append(k)
    out = {}
    for d, own in at.items():
        x = np.array([lists[k] for k in own], dtype=np.float64).reshape(len(own), d)
        x[~np.isfinite(x).all(axis=1)] = 0
        norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
        out[d] = np.array(own), x / np.where(norm > 0, norm, 1)
    return out


def block_matches(rows: DataFrame, source: DataFrame, least: float = 0.60, top: int = 1, cluster: str = "input_cluster_id", block: int = 4096, stream: int = 65_536) -> DataFrame:
    """best_matches(cluster_pairs(rows, source)) without pairs: unit vectors of a cluster are multiplied as matrices, and only the
    `top` best of a block leave a task.

    A cluster's source rows are dealt by a hash of all but their vectors to blocks of about `block`, its rows likewise to streams of
    about `stream`; each task holds one block and one Arrow batch of a stream. So copies of a vector and large clusters spread, a row travels once a block of its cluster, a
    source row once a stream. Scores near the last place are computed again pair by pair, so equal vectors have equal scores and
    ties go by entity_id. Part counts are a row a cluster, broadcast.
    """
    payload = lambda df, *drop: F.struct(*(F.col(c) for c in df.columns if c not in drop))
    known = source.withColumn("__c", F.explode(F.array_distinct(F.array_compact(F.array(F.col("legal_cluster_id").cast("long"), F.col("merchant_cluster_id").cast("long"))))))
    asked = rows.withColumn("__c", F.col(cluster).cast("long"))
    parts = known.groupBy("__c").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).join(asked.groupBy("__c").agg(F.ceil(F.count("*") / stream).cast("int").alias("streams")), "__c")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = lambda n, df, *drop: F.pmod(F.xxhash64(*(c for c in df.columns if c not in drop)), F.col(n)).cast("int")  # noqa: E731  the same in a rerun
    vector, own, other = "array<double>", payload(rows, "in_emb"), payload(source, "ln_emb", "mn_emb")
    blocks = known.join(F.broadcast(parts), "__c").withColumn("__block", dealt("blocks", source, "ln_emb", "mn_emb")).select("__c", "__block", every("streams").alias("__stream"), F.lit(0).alias("__kind"), F.col("ln_emb").cast(vector).alias("__a"), F.col("mn_emb").cast(vector).alias("__b"), other.alias("__s"))
    streams = asked.join(F.broadcast(parts), "__c").withColumn("__stream", dealt("streams", rows, "in_emb")).select("__c", every("blocks").alias("__block"), "__stream", F.lit(1).alias("__kind"), F.col("in_emb").cast(vector).alias("__a"), own.alias("__r"))
    task = ["__c", "__block", "__stream"]
    met = blocks.unionByName(streams, allowMissingColumns=True)
    met = met.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *task).sortWithinPartitions(*task, "__kind")

    def run(batches):
        import pyarrow as pa

        now, held, block_of = None, [], None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in (*task, "__kind"))))
            edges = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if keys[a][:3] != now:
                    now, held, block_of = keys[a][:3], [], None
                if keys[a][3] == 0:
                    held.append(part)
                elif held:
                    if block_of is None:
                        whole = pa.Table.from_batches(held).combine_chunks()
                        block_of = whole.column("__s").combine_chunks(), _units(whole.column("__a")), _units(whole.column("__b"))
                    for k in range(0, b - a, 512):
                        yield from best(part.slice(k, 512), *block_of)

    def best(part, payloads, legal, merchant):
        import pyarrow as pa

        n = len(payloads)
        ids = payloads.field("entity_id").to_pylist()
        order = np.argsort(np.array(["" if i is None else str(i) for i in ids]), kind="stable")
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        for d, (at, x) in _units(part.column("__a")).items():
            scores = np.full((2, len(at), n), -np.inf)
            for side, (others, y) in enumerate(t.get(d, (np.zeros(0, np.int64), np.zeros((0, d)))) for t in (legal, merchant)):
                scores[side][:, others] = x @ y.T
            high = scores.max(axis=0)
            kth = np.partition(high, n - top, axis=1)[:, n - top, None] if n > top else -np.inf
            i, j = np.nonzero(high >= np.maximum(kth, least) - 1e-9)
            exact = np.full((2, len(i)), -np.inf)
            for side, t in enumerate((legal, merchant)):
                if d in t:
                    row_of = np.full(n, -1)
                    row_of[t[d][0]] = np.arange(len(t[d][0]))
                    has = row_of[j] >= 0
                    exact[side, has] = (x[i[has]] * t[d][1][row_of[j[has]]]).sum(axis=1)
            score = exact.max(axis=0, initial=-np.inf)
            kept = np.lexsort((place[j], -score, i))
            kept = kept[score[kept] >= least]
            count = np.bincount(i[kept], minlength=len(at))
            rank = np.arange(len(kept)) - np.repeat(np.cumsum(count) - count, count)
            kept = kept[rank < top]
            if len(kept):
                cells = [pa.array(e, mask=~np.isfinite(e)) for e in exact[:, kept]]
                yield pa.RecordBatch.from_arrays([part.column("__r").take(pa.array(at[i[kept]])), payloads.take(pa.array(j[kept])), *cells], ["r", "s", "legal_name_score", "merchant_name_score"])

    kind = lambda struct: f"struct<{','.join(f'`{f.name}`:{f.dataType.simpleString()}' for f in struct)}>"
    found = met.mapInArrow(run, f"r {kind(streams.schema['__r'].dataType)}, s {kind(blocks.schema['__s'].dataType)}, legal_name_score double, merchant_name_score double")
    found = found.select("r.*", "s.*", "legal_name_score", "merchant_name_score").withColumn("matched_score", F.greatest("legal_name_score", "merchant_name_score"))
    found = found.withColumn("best_match_name", best_name(F.col("legal_name_score"), F.col("merchant_name_score"), F.col("legal_name"), F.col("merchant_name")))
    w = Window.partitionBy("supplier_id").orderBy(F.col("matched_score").desc(), "entity_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).withColumn("is_matched", F.lit("Y"))


def _by_length(vectors) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: the numbers of the vectors of that length and their components; vectors that are null or hold a null are left out."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    flat = vectors.flatten()
    values, missing = flat.to_numpy(zero_copy_only=False).astype(np.float64), flat.is_null().to_numpy(zero_copy_only=False)
    start = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
    out = {}
    for d in np.unique(lengths[lengths >= 0]).tolist():
        own = np.flatnonzero(lengths == d)
        at = start[own, None] + np.arange(d)
        whole = ~missing[at].any(axis=1)
        out[d] = own[whole], values[at[whole]]
    return out


def all_cosines(a: DataFrame, b: DataFrame, digits: int = 4, block: int = 16_384, stream: int = 65_536, chunk: int = 1 << 18) -> DataFrame:
    """(a_id, b_id, cosine) of every a (a_id, a) beside every b (b_id, b) of another id, rounded half up: scalar.cosine() by products
    of matrices. A task holds a block of a and one Arrow batch of a stream of b, and gives `chunk` pairs at a time."""
    blocks, streams = (max(1, -(-x.count() // n)) for x, n in ((a, block), (b, stream)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")  # noqa: E731  the same in a rerun
    held = a.select(dealt("a_id", blocks).alias("i"), every(streams).alias("j"), F.lit(0).alias("kind"), F.col("a_id").alias("id"), F.col("a").cast("array<double>").alias("v"))
    sent = b.select(every(blocks).alias("i"), dealt("b_id", streams).alias("j"), F.lit(1).alias("kind"), F.col("b_id").alias("id"), F.col("b").cast("array<double>").alias("v"))
    parts = max(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), blocks * streams)
    met = held.unionByName(sent).where("id is not null").repartition(parts, "i", "j").sortWithinPartitions("i", "j", "kind")

    def flags(vectors: dict, n: int) -> np.ndarray:
        """Which of n vectors are there whole, and which of these are zero."""
        out = np.zeros((2, n), bool)
        for rows, x in vectors.values():
            out[0, rows], out[1, rows] = True, ~x.any(axis=1)
        return out

    def pairs(own, part):
        import pyarrow as pa

        ids, other, columns = own.column("id").to_numpy(), part.column("id").to_numpy(), _by_length(own.column("v"))
        step = max(1, chunk // len(ids))
        for k in range(0, len(other), step):
            piece, theirs = part.slice(k, step), other[k : k + step]
            streamed = _by_length(piece.column("v"))
            cosines, (whole, zero), (own_whole, own_zero) = np.zeros((len(theirs), len(ids))), flags(streamed, len(theirs)), flags(columns, len(ids))
            known = np.outer(zero, own_whole) | np.outer(whole, own_zero)  # a zero vector has cosine 0 with one of any length
            for d, (rows, y) in streamed.items():
                at, x = columns.get(d, ((), None))
                if len(at) and len(rows):
                    with np.errstate(all="ignore"):
                        norms = np.sqrt((y * y).sum(axis=1))[:, None] * np.sqrt((x * x).sum(axis=1))
                        cosine = np.where(norms == 0, 0.0, y @ x.T / np.where(norms == 0, 1.0, norms))
                        cosines[np.ix_(rows, at)] = np.copysign(np.floor(np.abs(cosine) * 10**digits + 0.5) / 10**digits, cosine) + 0.0
                    known[np.ix_(rows, at)] = True
            kept = theirs[:, None] != ids
            a_ids, b_ids = np.broadcast_to(ids, kept.shape)[kept], np.broadcast_to(theirs[:, None], kept.shape)[kept]
            yield pa.RecordBatch.from_arrays([pa.array(a_ids), pa.array(b_ids), pa.array(cosines[kept], mask=~known[kept])], ["a_id", "b_id", "cosine"])

    def run(batches):
        import pyarrow as pa

        now, parts, own = None, [], None
        for batch in batches:
            i, j, kind = (batch.column(c).to_numpy() for c in ("i", "j", "kind"))
            edges = [0, *(np.flatnonzero((np.diff(i) != 0) | (np.diff(j) != 0) | (np.diff(kind) != 0)) + 1).tolist(), len(i)]
            for s, e in zip(edges, edges[1:]):
                if s == e:
                    continue
                part = batch.slice(s, e - s)
                if (i[s], j[s]) != now:
                    now, parts, own = (i[s], j[s]), [], None
                if kind[s] == 0:
                    parts.append(part)
                elif parts:
                    own = pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if own is None else own
                    yield from pairs(own, part)

    return met.mapInArrow(run, "a_id long, b_id long, cosine double")


def unaudited(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """Rows whose keys the audit doesn't have; a null never equals, so rows with one are always kept."""
    return rows.join(audit.select(*KEYS).distinct(), KEYS, "left_anti")


def with_audit(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """supplier_id, entity_id, is_matched and matched_score of each distinct row, N and 0 where the audit has none."""
    raw = rows.select("supplier_id", *KEYS).dropDuplicates()
    return raw.join(audit.select(*KEYS, "entity_id", "is_matched", "matched_score"), KEYS, "left").select(
        "supplier_id", "entity_id", F.coalesce("is_matched", F.lit("N")).alias("is_matched"), F.coalesce("matched_score", F.lit(0.0)).alias("matched_score"))


def match_suppliers(rows: DataFrame, source: DataFrame, audit: DataFrame, model, embed: Embedder, least: float = 0.60, top: int = 1) -> tuple[DataFrame, DataFrame]:
    """(result for all rows, new audit rows); all countries are one job, country is one of the keys."""
    for c in ("postal_code", "state"):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    require_columns(rows, ["supplier_id", "supplier_name", "state", "postal_code", "country", "street_address"])
    text = normalize_text(F.concat_ws(" ", normalize_text(F.col("supplier_name")), normalize_text(F.col("street_address"))))
    todo = with_cluster(unaudited(rows.withColumn("in_emb", embed(text)), audit), model, "in_emb", "input_cluster_id").select("supplier_id", *KEYS, "in_emb", "input_cluster_id")
    inside = with_cluster(with_cluster(source, model, "ln_emb", "legal_cluster_id"), model, "mn_emb", "merchant_cluster_id").drop("country")
    new = block_matches(todo, inside, least, top).select(*KEYS, "entity_id", "is_matched", "matched_score")
    return with_audit(rows, audit.select(*new.columns).unionByName(new)), new
