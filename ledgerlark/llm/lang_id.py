"""Language identification with hyperdimensional profiles.

Every letter class has a random +1/-1 vector. A trigram binds its three letters: the first one's vector is rotated twice,
the second's once, and the three are multiplied. A document bundles (adds) the vectors of its trigrams, a language bundles
its normalised training documents, and a document gets the language with the highest cosine. Both are centred on the mean
language first, so that what all languages share doesn't count. Cosines are rounded to six places, and of equal ones the
alphabetically first language wins, so that neither batches nor the order of sums decide.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mapped, row_slices

CLASSES = 128
SCALE = float(1 << 24)
SLICE = 1 << 19  # bytes of text counted at once


@dataclass
class Profiles:
    """Learned languages (sorted) and their centred unit prototypes."""

    languages: list[str]
    prototypes: np.ndarray
    mean: np.ndarray
    dims: int
    seed: int


_cache: dict = {}


def letter_classes() -> np.ndarray:
    """Code point → class: 0 for what is no letter, 1-26 for a-z, the other letters dealt over the rest."""
    if "classes" not in _cache:
        table = np.zeros(0x110000, np.uint8)
        alpha = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        code = np.arange(0x110000, dtype=np.uint64)
        spread = ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(CLASSES - 27)
        table[alpha] = (spread[alpha] + np.uint64(27)).astype(np.uint8)
        table[ord("a") : ord("z") + 1] = np.arange(1, 27)
        _cache["classes"] = table
    return _cache["classes"]


class TrigramVectors:
    """Vectors of trigrams as signed bytes, made when first met; the table has a fixed size, and is emptied when full."""

    def __init__(self, dims: int, seed: int, keep: int = 16_384):
        self.letters = np.random.default_rng(seed).choice(np.array([-1, 1], np.float32), (CLASSES, dims)).astype(np.int8)
        self.row, self.table = np.full(CLASSES**3, -1, np.int32), np.zeros((keep, dims), np.int8)
        self.n = 0

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Vectors of at most `keep` different trigrams."""
        new = keys[self.row[keys] < 0]
        if self.n + len(new) > len(self.table):
            self.row[:], self.n, new = -1, 0, keys
        for i in range(0, len(new), 1024):
            own = new[i : i + 1024]
            first, second, third = own >> 14, (own >> 7) & 127, own & 127
            self.table[self.n : self.n + len(own)] = np.roll(self.letters[first], 2, axis=1) * np.roll(self.letters[second], 1, axis=1) * self.letters[third]
            self.row[own] = np.arange(self.n, self.n + len(own))
            self.n += len(own)
        return self.table[self.row[keys]]

    def bundle(self, counts: np.ndarray, keys: np.ndarray, block: int = 2048) -> np.ndarray:
        """Sum of the trigrams' vectors for each row of counts, by blocks of trigrams."""
        out = np.zeros((len(counts), self.table.shape[1]), np.float32)
        for k in range(0, len(keys), block):
            out += counts[:, k : k + block] @ self.of(keys[k : k + block]).astype(np.float32)
        return out


def trigram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigrams, a count matrix (text x trigram), and whether each text has a letter."""
    lowered = [f"\n{(t or '').lower()}\n" for t in texts]
    size = np.fromiter(map(len, lowered), np.int64, len(texts))
    classes = letter_classes()[np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")]
    ends = np.cumsum(size)
    letters = np.concatenate([[0], np.cumsum(classes > 0)])
    has = letters[ends] > letters[ends - size]
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), size)
    stay = np.ones(len(classes), bool)  # of what is no letter, the first in a row stands for all
    stay[1:] = (classes[1:] != 0) | (classes[:-1] != 0)
    stay[ends - size] = True
    classes, owner = classes[stay].astype(np.int64), owner[stay]
    found = np.sort(((owner[2:] << 21) | (classes[:-2] << 14) | (classes[1:-1] << 7) | classes[2:])[owner[2:] == owner[:-2]])
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.zeros(0, np.int64)
    n, found = np.diff(np.append(first, len(found))), found[first]
    keys, place = np.unique(found & ((1 << 21) - 1), return_inverse=True)
    counts = np.zeros((len(texts), len(keys)), np.float32)
    counts[found >> 21, place] = n
    return keys, counts, has


def fit_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", dims: int = 1024, seed: int = 7, most_languages: int = 4096) -> Profiles:
    """Learns one prototype for each non-null value of `lang` from all rows of docs.

    Rows with a null language, null text or no letter teach nothing. What reaches the driver is one vector a language, of the
    `most_languages` languages with most rows (of equal ones the alphabetically first): a bound on the model, not on the rows.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))

    def run(batches):
        import pyarrow as pa

        vectors, sums, n_rows = TrigramVectors(dims, seed), {}, {}

        def send():
            for n, v in sums.items():
                yield pa.RecordBatch.from_pydict({"lang": [n] * dims, "dim": pa.array(range(dims), pa.int32()), "v": v, "n": [n_rows[n]] * dims})
            sums.clear()
            n_rows.clear()

        for batch in batches:
            for i, j in row_slices(batch.column("text"), SLICE, 512):
                langs = batch.column("lang").slice(i, j - i).to_pylist()
                keys, counts, has = trigram_counts(batch.column("text").slice(i, j - i).to_pylist())
                if not has.any():
                    continue
                counts /= np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-9)
                names = sorted(set(langs))
                member = np.array([[x == n for x in langs] for n in names], np.float32) * has
                for n, v, k in zip(names, vectors.bundle(member @ counts, keys), member.sum(axis=1)):
                    if k:
                        sums[n] = sums.get(n, 0) + np.rint(v.astype(np.float64) * SCALE).astype(np.int64)
                        n_rows[n] = n_rows.get(n, 0) + int(k)
                if len(sums) > 512:
                    yield from send()
        yield from send()

    sums = mapped(rows, run, "lang string, dim int, v long, n long").groupBy("lang", "dim").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    whole = sums.groupBy("lang").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("dim", "v"))).alias("vector"))  # dims entries a language
    best = whole.orderBy(F.col("n").desc(), "lang").limit(most_languages).select("lang", F.col("vector.v").alias("v"))
    found = sorted((r["lang"], np.array(r["v"], np.float64)) for r in best.toLocalIterator())
    languages = [n for n, _ in found]
    made = np.array([v for _, v in found]).reshape(len(found), dims) / SCALE
    made /= np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-9)
    mean = made.mean(axis=0) if len(languages) > 1 else np.zeros(dims)
    made -= mean
    made /= np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-9)
    return Profiles(languages, made.astype(np.float32), mean.astype(np.float32), dims, seed)


def predict(texts: list[str | None], model: Profiles, sharpness: float = 16.0, vectors: TrigramVectors | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score (softmax of the cosines times `sharpness`) and highest cosine of each text."""
    vectors = vectors or TrigramVectors(model.dims, model.seed)
    keys, counts, has = trigram_counts(texts)
    if not model.languages or not has.any():
        return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    v = vectors.bundle(counts, keys)
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
    v -= model.mean
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
    cos = (v @ model.prototypes.T).astype(np.float64).round(6)
    e = np.exp(sharpness * (cos - cos.max(axis=1, keepdims=True)))
    names = [model.languages[b] if h else "und" for b, h in zip(cos.argmax(axis=1), has)]
    return names, np.where(has, 1 / e.sum(axis=1), 0.0), np.where(has, cos.max(axis=1), 0.0)


ADDED = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("cosine", T.DoubleType())]


def identify(docs: DataFrame, model: Profiles, text: str = "text", keep_text: bool = True) -> DataFrame:
    """docs with lang_pred, score (0-1) and cosine; columns of these names in docs are replaced.

    Null, empty and letterless texts get `und`, 0 and 0. No shuffle; every other column passes through.
    """
    names = [n for n, _ in ADDED]
    rows = docs.drop(*names)
    out = T.StructType([f for f in rows.schema.fields if keep_text or f.name != text] + [T.StructField(n, k) for n, k in ADDED])

    def run(batches):
        import pyarrow as pa

        vectors = TrigramVectors(model.dims, model.seed)
        kept = [f.name for f in out.fields if f.name not in names]
        for batch in batches:
            lang, score, cosine = [], [np.zeros(0)], [np.zeros(0)]
            for i, j in row_slices(batch.column(text), SLICE, 512):
                x, y, z = predict(batch.column(text).slice(i, j - i).to_pylist(), model, vectors=vectors)
                lang += x
                score.append(y)
                cosine.append(z)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(lang, pa.string()), pa.array(np.concatenate(score)), pa.array(np.concatenate(cosine))], [*kept, *names])

    return mapped(rows, run, out)


def fold(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def language_id(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """Profiles from the documents outside fold 2, then every document's language. A null doc_id is in no fold: it isn't
    learned from, and held_out is false."""
    model = fit_profiles(docs.where(fold() != 2))
    rows = docs.withColumn("held_out", F.coalesce(fold() == 2, F.lit(False)))
    return identify(rows if keep_text else rows.select("doc_id", "held_out", "text"), model, keep_text=keep_text)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "held_out", "lang_pred", "score", "cosine")
