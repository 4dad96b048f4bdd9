"""Benchmark decontamination with an FM-index per training shard.

A shard is a slice of the documents of a task. Words that no benchmark item has can't be in an occurrence, so the shard's
index covers the runs of benchmark words that are long enough for a window, each ended by a separator. Windows are found by
backward search over wavelet-tree ranks, their places by walking to sampled suffix positions, and the places are merged into
removal spans. The benchmark is taken in blocks of bounded size; each block is one more pass over the shards, without a
shuffle.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_class, mapped, mb_slices, ragged, text_bytes, words

SAMPLE = 8


class WaveletTree:
    """Rank over a sequence of small numbers: one level a bit, values partitioned stably by it."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        values = values.astype(np.int64)
        for b in range(bits - 1, -1, -1):
            bit = (values >> b) & 1
            ones = np.concatenate([[0], np.cumsum(bit)])
            self.levels.append((ones, len(values) - int(ones[-1])))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        first, last = np.zeros_like(upto), upto
        for level, (ones, zeros) in enumerate(self.levels):
            one = (symbol >> (self.bits - 1 - level)) & 1
            a, b = ones[first], ones[last]
            first = np.where(one, zeros + a, first - a)
            last = np.where(one, zeros + b, last - b)
        return last - first

    def access(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for ones, zeros in self.levels:
            one = ones[at + 1] - ones[at]
            out = (out << 1) | one
            at = np.where(one == 1, zeros + ones[at], at - ones[at])
        return out


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; symbol 0 separates, and separators rank by their place, so no comparison crosses one."""
    n = len(text)
    stop = text == 0
    rank = text.astype(np.int64) + int(stop.sum())
    rank[stop] = np.arange(int(stop.sum()))
    order, step = np.argsort(rank, kind="stable"), 1
    fresh = np.empty(n, np.int64)
    fresh[order] = np.concatenate([[0], np.cumsum(np.diff(rank[order]) != 0)])
    rank = fresh
    while rank.max() < n - 1:
        second = np.zeros(n, np.int64)
        second[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        fresh = np.empty(n, np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank, step = fresh, step * 2
    return order


class FMIndex:
    """Text over 0 (separator, also last) and symbols 1..n_symbols."""

    def __init__(self, text: np.ndarray, n_symbols: int, sample: int = SAMPLE):
        order = suffix_order(text)
        bwt = text[order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols + 1))])
        self.tree = WaveletTree(bwt, max(1, int(n_symbols).bit_length()))
        starts = np.concatenate([[True], text[:-1] == 0])
        since = np.arange(len(text)) - np.flatnonzero(starts)[np.cumsum(starts) - 1]
        marked = (since[order] % sample) == 0  # a run's first position is sampled, so a walk never leaves its run
        self.marked = np.concatenate([[0], np.cumsum(marked)])
        self.samples = order[marked]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of phrases (rows of equal length), by backward search."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), int(self.before[-1]), np.int64)
        alive = np.arange(len(phrases))
        for k in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, k]
            lo[alive] = self.before[symbol] + self.tree.rank(symbol, lo[alive])
            hi[alive] = self.before[symbol] + self.tree.rank(symbol, hi[alive])
            alive = alive[hi[alive] > lo[alive]]
        found = np.zeros(len(phrases), bool)
        found[alive] = True
        return lo, np.where(found, hi, lo)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows."""
        rows, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.full(len(rows), -1, np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            r = rows[todo]
            here = self.marked[r + 1] > self.marked[r]
            out[todo[here]] = self.samples[self.marked[r[here]]] + steps[todo[here]]
            todo, r = todo[~here], r[~here]
            symbol = self.tree.access(r)
            rows[todo] = self.before[symbol] + self.tree.rank(symbol, r)
            steps[todo] += 1
        return out


@dataclass
class Phrases:
    """Windows of one block of the benchmark: sorted word hashes, a small filter of their low bits, the windows by length
    (symbols) and the items of each window."""

    vocabulary: np.ndarray
    filter: np.ndarray
    windows: dict[int, np.ndarray]
    item_of: dict[int, tuple[np.ndarray, np.ndarray]]
    items: list[str]

    @property
    def shortest(self) -> int:
        return min(self.windows, default=0)


def build_phrases(ids: list[str], texts: list[str | None], window: int) -> Phrases:
    """Distinct windows of the items; an item of fewer words than `window`, but not none, is one window."""
    import pyarrow as pa

    hashes, _, _, ends = words(*text_bytes(pa.array(texts, pa.string())), byte_class("alnum"))
    vocabulary, symbol = np.unique(hashes, return_inverse=True)
    symbol = symbol.astype(np.int64) + 1
    names = sorted(set(ids))
    number = {n: i for i, n in enumerate(names)}
    of_item, count = np.array([number[n] for n in ids], np.int64), np.diff(ends)
    windows, item_of = {}, {}
    for size in np.unique(np.minimum(count[count > 0], window)).tolist():
        own = np.flatnonzero(count == size if size < window else count >= window)
        n = count[own] - size + 1
        rows = symbol[ragged(ends[own], n)[:, None] + np.arange(size)].astype(np.int32)
        as_one = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.itemsize * size))).ravel()
        _, first, which = np.unique(as_one, return_index=True, return_inverse=True)
        pairs = np.unique(which.astype(np.int64) * len(names) + np.repeat(of_item[own], n))
        windows[size] = rows[first]
        item_of[size] = pairs % len(names), np.searchsorted(pairs // len(names), np.arange(len(first) + 1))
    low = np.zeros(1 << 20, bool)
    low[(vocabulary & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    return Phrases(vocabulary, low, windows, item_of, names)


def shard_hits(raw: np.ndarray, offsets: np.ndarray, phrases: Phrases):
    """Of the documents of one shard: words of each, (document, first byte, end byte) of the merged spans with their number of
    words, and the distinct (document, item) pairs."""
    none = np.zeros(0, np.int64)
    hashes, starts, stops, ends = words(raw, offsets, byte_class("alnum"))
    n_words = np.diff(ends)
    maybe = np.flatnonzero(phrases.filter[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)]) if phrases.windows else none
    at = np.searchsorted(phrases.vocabulary, hashes[maybe])
    at = np.minimum(at, max(0, len(phrases.vocabulary) - 1))
    sure = phrases.vocabulary[at] == hashes[maybe] if len(maybe) else np.zeros(0, bool)
    at, place = at[sure], maybe[sure]  # symbols less one, and word numbers in the shard
    if not len(place):
        return n_words, none, none, none, none, none, none
    owner = np.searchsorted(ends, place, side="right") - 1
    cut = np.concatenate([[True], (np.diff(place) != 1) | (np.diff(owner) != 0)])
    run = np.cumsum(cut) - 1
    long_enough = np.bincount(run)[run] >= phrases.shortest
    at, place, owner, cut = at[long_enough], place[long_enough], owner[long_enough], cut[long_enough]
    if not len(place):
        return n_words, none, none, none, none, none, none
    run = np.cumsum(cut) - 1
    spot = np.arange(len(place)) + run  # a separator stands after each run
    text = np.zeros(len(place) + int(run[-1]) + 1, np.int64)
    text[spot] = at + 1
    back = np.full(len(text), -1, np.int64)
    back[spot] = np.arange(len(place))
    index = FMIndex(text, len(phrases.vocabulary))
    cover, pairs = np.zeros(len(text) + 1, np.int64), []
    for size, windows in phrases.windows.items():
        lo, hi = index.search(windows)
        hit = np.flatnonzero(hi > lo)
        if not len(hit):
            continue
        counts = hi[hit] - lo[hit]
        found = index.locate(ragged(lo[hit], counts))
        np.add.at(cover, found, 1)
        np.add.at(cover, found + size, -1)
        items, begin = phrases.item_of[size]
        doc = owner[back[found]]
        which = np.unique(np.repeat(hit, counts) * len(offsets) + doc)  # a window counts once a document
        w, doc = which // len(offsets), which % len(offsets)
        k = begin[w + 1] - begin[w]
        pairs.append(np.repeat(doc, k) * len(phrases.items) + items[ragged(begin[w], k)])
    hit = (np.cumsum(cover)[:-1] > 0)[spot]
    pairs = np.unique(np.concatenate(pairs)) if pairs else none
    h = np.flatnonzero(hit)
    if not len(h):
        return n_words, none, none, none, none, none, none
    first = np.concatenate([[True], (np.diff(place[h]) != 1) | (np.diff(owner[h]) != 0)])
    last = np.concatenate([first[1:], [True]])
    group = np.cumsum(first) - 1
    a, b = place[h[first]], place[h[last]]
    return n_words, owner[h[first]], starts[a], stops[b], np.bincount(group), pairs // len(phrases.items), pairs % len(phrases.items)


SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
ADDED = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(SPAN)),
])


def one_pass(docs: DataFrame, phrases: Phrases, first: bool, text: str, keep_text: bool, shard_bytes: int) -> DataFrame:
    """Adds (first) or updates n_words, n_hit, items and spans (byte offsets of the UTF-8 text) with one block's hits."""
    names = ADDED.fieldNames()
    kept = [f for f in docs.schema.fields if f.name not in names and (keep_text or f.name != text)]
    out = T.StructType(kept + ADDED.fields)
    cast = docs.schema[text].dataType
    shared = docs.sparkSession.sparkContext.broadcast(phrases)

    def run(batches):
        import pyarrow as pa

        known = shared.value
        for batch in batches:
            raw, offsets = text_bytes(batch.column(text))
            n_words, spans, items = np.zeros(batch.num_rows, np.int64), {}, {}
            sizes: dict[int, int] = {}
            for i, j in mb_slices(offsets, shard_bytes):
                base = offsets[i]
                n, owner, a, b, size, doc, item = shard_hits(raw[base : offsets[j]], offsets[i : j + 1] - base, known)
                n_words[i:j] = n
                for d, s, e, k in zip(owner + i, a + base - offsets[owner + i], b + base - offsets[owner + i], size):
                    spans.setdefault(int(d), []).append((int(s), int(e)))
                    sizes[int(d)] = sizes.get(int(d), 0) + int(k)
                for d, x in zip(doc + i, item):
                    items.setdefault(int(d), []).append(known.items[x])
            rows_items = [sorted(items.get(d, [])) for d in range(batch.num_rows)]
            rows_spans = [spans.get(d, []) for d in range(batch.num_rows)]
            n_hit = [sizes.get(d, 0) for d in range(batch.num_rows)]
            if not first:
                old_items, old_spans, old_hit = (batch.column(c).to_pylist() for c in ("items", "spans", "n_hit"))
                for d in range(batch.num_rows):
                    rows_items[d] = sorted({*rows_items[d], *old_items[d]})
                    if rows_spans[d] and old_spans[d]:
                        rows_spans[d] = merge_spans([*rows_spans[d], *((s["start"], s["end"]) for s in old_spans[d])])
                        part = raw[offsets[d] : offsets[d + 1]]
                        n_hit[d] = sum(len(words(part[s:e], np.array([0, e - s]), byte_class("alnum"))[0]) for s, e in rows_spans[d])
                    elif old_spans[d]:
                        rows_spans[d], n_hit[d] = [(s["start"], s["end"]) for s in old_spans[d]], old_hit[d]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(n_words), pa.array(n_hit, pa.int64()), pa.array(rows_items, pa.list_(pa.string())),
                 pa.array([[{"start": s, "end": e} for s, e in r] for r in rows_spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                [*(f.name for f in kept), *names])

    assert isinstance(cast, T.StringType)
    return mapped(docs, run, out)


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, in order; spans that touch or overlap become one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, text: str = "text", keep_text: bool = True, block_chars: int = 4_000_000, shard_bytes: int = 1 << 23) -> DataFrame:
    """docs with n_words, n_hit (words in any occurrence of a window), items (ids as sorted strings) and spans (merged byte ranges).

    Columns of these names in docs are replaced. Null and empty texts have no words. Items without id or words are ignored;
    rows of the same item id add up. The driver and every worker hold one block of `block_chars` characters of the benchmark at
    a time, its windows as arrays of about 10 bytes a character.
    """
    known = items.select(F.col("item_id").cast("string").alias("id"), F.col("text").cast("string").alias("t")).where("id is not null and t is not null")
    chars = known.agg(F.sum(F.length("t"))).first()[0] or 0
    n_blocks = max(1, -(-int(chars) // block_chars))
    rows = docs.drop(*ADDED.fieldNames()).withColumn(text, F.col(text).cast("string"))
    for b in range(n_blocks):
        own = known.where(F.pmod(F.xxhash64("id", "t"), F.lit(n_blocks)) == b).distinct().collect()
        phrases = build_phrases([r["id"] for r in own], [r["t"] for r in own], window)
        rows = one_pass(rows, phrases, b == 0, text, keep_text or b + 1 < n_blocks, shard_bytes)
    return rows


def remove_spans(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the spans (byte offsets)."""
    if text is None or not spans:
        return text
    raw, at, parts = text.encode(), 0, []
    for s, e in spans:
        parts.append(raw[at:s])
        at = e
    return b"".join([*parts, raw[at:]]).decode()


EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep_text=False)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


#: Every 10-word window of the documents is compared with those of the items; items of fewer words are one window.
ORACLE_SQL = r"""
WITH RECURSIVE dw AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item, least(10, len(w)) AS size, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
cand AS (
  SELECT rid, size, p, array_to_string(w[p:p + size - 1], ' ') AS phrase
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM dw, sizes WHERE len(w) >= size)),
hits AS (SELECT c.rid, c.size, c.p, win.item FROM cand c JOIN win ON c.size = win.size AND c.phrase = win.phrase),
covered AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(p, p + size)) AS pos FROM (SELECT DISTINCT rid, size, p FROM hits)) GROUP BY rid),
found AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(f.n_items, 0) AS n_items,
  sha256(coalesce(f.names, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN covered c USING (rid) LEFT JOIN found f USING (rid)
"""
