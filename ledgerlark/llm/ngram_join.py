"""Set-similarity join of documents on word shingles, by T-occurrence search with DivideSkip.

A document is the set of its distinct shingle hashes; two link when intersection / union reaches the threshold. Then at
least T of the one's tokens are in the other, T a share of its size, so the rarest n - T + 1 of its n tokens (its short
lists) can't all miss; the other T - 1 lists, the long ones, are never merged but only probed.

1. One scan gives each document's size and set signature (equal sets are one class), and the frequent tokens of each task.
2. A second scan puts every document's short lists into an inverted index, tokens ordered from rare to frequent. A
   frequent token is in the bounded set that every task knows; its list is long and needed only by documents that consist of
   such tokens. Lists of one document are dropped.
3. Two documents that link meet in T less the rest of their lists of the short ones (T-occurrence on the index). Every list
   has a pivot, the document that shares most of its lists. A document is searched for with the pivot it meets in most lists, then, in large lists
   that still hold several components, with those lists' pivots, and at last with every document of another component that it
   meets often enough. So a pair is either in one component or tested itself: no link between components is lost, and groups
   of near copies cost a test a document, not one a pair.
4. A search groups documents by query: their lists, restricted to the query's tokens, are divided into short and long
   ones; short ones are merged with a heap, documents with enough occurrences are looked up in the long ones by bisection.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, byte_class, components, fmix, mapped, mb_slices, saved, small, text_bytes, words

#: A token is frequent in a task's block of about BLOCK tokens from LOCAL occurrences; all tasks know at most FREQUENT tokens.
BLOCK, LOCAL, FREQUENT = 1_000_000, 4, 1 << 18


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, in a row, and where each row's begin (one more than rows). A row of fewer
    words than `size`, but not none, is one shingle."""
    hashes, _, _, ends = words(raw, offsets, byte_class("space"))
    n_rows, count = len(offsets) - 1, np.diff(ends)
    owner = np.repeat(np.arange(n_rows), count)
    mixed = np.zeros(max(0, len(hashes) - size + 1), np.uint64)
    for k in range(size):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(mixed)]
    whole = owner[: len(mixed)] == owner[size - 1 :][: len(mixed)]
    tokens, owner_of = fmix(mixed[whole]), owner[: len(mixed)][whole]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        extra = []
        for d in short:
            h = np.uint64(count[d])
            for w in hashes[ends[d] : ends[d + 1]]:
                h = np.uint64((int(h) * 0xD6E8FEB86659FD93 + int(w)) & 0xFFFFFFFFFFFFFFFF)
            extra.append(h)
        tokens, owner_of = np.concatenate([tokens, fmix(np.array(extra, np.uint64))]), np.concatenate([owner_of, short])
        order = np.argsort(owner_of, kind="stable")
        tokens, owner_of = tokens[order], owner_of[order]
    bounds = np.searchsorted(owner_of, np.arange(n_rows + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a > 1:
            tokens[a:b].sort()
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (owner_of[1:] != owner_of[:-1])
    return tokens[fresh], np.searchsorted(owner_of[fresh], np.arange(n_rows + 1))


def signatures(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set."""
    out = []
    for salt in (np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25)):
        total = np.concatenate([[np.uint64(0)], np.cumsum(fmix(tokens ^ salt), dtype=np.uint64)])
        out.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return out[0], out[1]


def sketches(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """1024 parity bits of each set, as 16 longs: two sets differ in at least as many tokens as their sketches in bits."""
    out = np.zeros((len(bounds) - 1, 16), np.int64)
    for i in range(0, len(out), 256):
        j = min(i + 256, len(out))
        own = tokens[bounds[i] : bounds[j]]
        owner = np.repeat(np.arange(j - i), np.diff(bounds[i : j + 1]))
        parity = np.bincount(owner * 1024 + (own >> np.uint64(54)).astype(np.int64), minlength=(j - i) * 1024).reshape(j - i, 1024) & 1
        out[i:j] = np.packbits(parity.astype(np.uint8), axis=1).view(np.int64)
    return out


def need(a: int, b: int, percent: int) -> int:
    """Least intersection of sets of a and b tokens that link: percent * (a + b - i) <= 100 * i."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


class Frequent:
    """The frequent tokens in ascending order of frequency, looked up by a small filter and a sorted table."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.lexsort((tokens, counts))
        rank = np.empty(len(tokens), np.int64)
        rank[order] = np.arange(len(tokens))
        at = np.argsort(tokens)
        self.tokens, self.rank = tokens[at], rank[at]
        self.low = np.zeros(1 << 22, bool)
        self.low[(tokens & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def find(self, tokens: np.ndarray) -> np.ndarray:
        """Rank of each token, -1 if it isn't frequent."""
        out = np.full(len(tokens), -1, np.int64)
        if len(self.tokens):
            maybe = np.flatnonzero(self.low[(tokens & np.uint64((1 << 22) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.tokens, tokens[maybe]), len(self.tokens) - 1)
            sure = self.tokens[at] == tokens[maybe]
            out[maybe[sure]] = self.rank[at[sure]]
        return out


def divide_skip(lists: list[list[int]], least: list[int], always: int = 0) -> list[int]:
    """Members (numbers in the sorted lists) that occur in at least least[m] of the lists.

    The L longest lists are set aside, L one less than the smallest requirement (less `always`); the others are merged with a
    heap, and members with enough occurrences there are looked up in the long ones by bisection until the rest can't suffice.
    """
    t = min(least, default=1)
    lists = sorted((x for x in lists if x), key=len, reverse=True)
    skipped = min(max(0, t - 1 - always), len(lists))
    long, short = lists[:skipped], lists[skipped:]
    found, last, n = [], -1, 0

    def close(m: int, n: int) -> None:
        want = least[m]
        if n < want - len(long):
            return
        for k, x in enumerate(long):
            if n >= want or n + len(long) - k < want:
                break
            i = bisect_left(x, m)
            n += i < len(x) and x[i] == m
        if n >= want:
            found.append(m)

    for m in heapq.merge(*short):
        if m != last:
            if last >= 0:
                close(last, n)
            last, n = m, 0
        n += 1
    if last >= 0:
        close(last, n)
    return found


def search(query: np.ndarray, members: list[np.ndarray], percent: int) -> list[int]:
    """Numbers of the members that link with the query."""
    sizes = np.array([len(m) for m in members])
    tokens, owner = np.concatenate(members), np.repeat(np.arange(len(members)), sizes)
    at = np.minimum(np.searchsorted(query, tokens), len(query) - 1)
    hit = query[at] == tokens
    at, owner = at[hit], owner[hit]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order].tolist()
    cut = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
    return divide_skip([owner[a:b] for a, b in zip(cut[:-1], cut[1:])], [need(len(query), int(n), percent) for n in sizes])


def scan_sets(docs: DataFrame, size: int) -> DataFrame:
    """Rows of kind 0: doc_id, n, s1, s2, sketch of every document; of kind 1: token (n) and count (s1) of a task's frequent
    tokens."""

    def run(batches):
        import pyarrow as pa

        held, held_n, seen = [], 0, set()

        def flush():
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= LOCAL
            k = int(often.sum())
            return pa.RecordBatch.from_pydict({"kind": pa.array([1] * k, pa.int32()), "doc_id": pa.nulls(k, pa.int64()), "n": tokens[often].view(np.int64), "s1": counts[often], "s2": np.zeros(k, np.int64), "sketch": pa.nulls(k, pa.list_(pa.int64()))})

        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            n, s1, s2 = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            bits = np.zeros((batch.num_rows, 16), np.int64)
            for i, j in mb_slices(offsets):
                tokens, bounds = shingle_sets(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size)
                n[i:j] = np.diff(bounds)
                s1[i:j], s2[i:j] = signatures(tokens, bounds)
                bits[i:j] = sketches(tokens, bounds)
                for d, key in enumerate(zip(s1[i:j].tolist(), s2[i:j].tolist())):
                    if key not in seen and bounds[d + 1] > bounds[d]:
                        seen.add(key)
                        held.append(tokens[bounds[d] : bounds[d + 1]])
                        held_n += int(bounds[d + 1] - bounds[d])
                if held_n > BLOCK:
                    yield flush()
                    held, held_n = [], 0
            yield pa.RecordBatch.from_pydict({"kind": pa.array([0] * batch.num_rows, pa.int32()), "doc_id": batch.column("doc_id"), "n": n, "s1": s1, "s2": s2, "sketch": pa.ListArray.from_arrays(np.arange(0, 16 * len(n) + 1, 16, dtype=np.int32), bits.ravel())})
        if held:
            yield flush()

    return mapped(docs.select("doc_id", "text"), run, "kind int, doc_id long, n long, s1 long, s2 long, sketch array<long>")


def scan_postings(docs: DataFrame, size: int, percent: int, frequent, buckets: int, long: bool) -> DataFrame:
    """Short lists of every document. long: those of frequent tokens, as rows (token, doc, n); else of all others, as packed rows
    (bucket, tokens, doc ids, sizes). Rows of a task with equal sets count once; null ids have no lists."""

    def run(batches):
        import pyarrow as pa

        known, seen = frequent.value, set()
        held: list[tuple] = []
        held_n = 0

        def flush():
            token, doc, n = (np.concatenate(x) for x in zip(*held))
            if long:
                for k in range(0, len(token), 100_000):
                    yield pa.RecordBatch.from_pydict({"token": token[k : k + 100_000].view(np.int64), "doc": doc[k : k + 100_000], "n": n[k : k + 100_000]})
                return
            bucket = (token >> np.uint64(32)).astype(np.int64) % buckets
            order = np.lexsort((token, bucket))
            bucket = bucket[order]
            cut = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
            pack = lambda x, kind: [x[order[a:b]].astype(kind).tobytes() for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(bucket[cut[:-1]], pa.int32()), "token": pa.array(pack(token, "<u8"), pa.binary()), "doc": pa.array(pack(doc, "<i8"), pa.binary()), "n": pa.array(pack(n, "<u4"), pa.binary())})

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            raw, offsets = text_bytes(batch.column("text"))
            for i, j in mb_slices(offsets):
                tokens, bounds = shingle_sets(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size)
                s1, s2 = signatures(tokens, bounds)
                rank = known.find(tokens)
                for d in range(j - i):
                    a, b = int(bounds[d]), int(bounds[d + 1])
                    key = (int(s1[d]), int(s2[d]))
                    if a == b or ids[i + d] is None or key in seen:
                        continue
                    seen.add(key)
                    own, r = tokens[a:b], rank[a:b]
                    p, rare = prefix_size(b - a, percent), r < 0
                    first = own[rare][:p]
                    if long:
                        rest = np.flatnonzero(~rare)
                        first = own[rest[np.argsort(r[rest])][: p - len(first)]]
                    if len(first):
                        held.append((first, np.full(len(first), ids[i + d], np.int64), np.full(len(first), b - a, np.int64)))
                        held_n += len(first)
                if held_n > BLOCK:
                    yield from flush()
                    held, held_n = [], 0
        if held:
            yield from flush()

    return mapped(docs.select("doc_id", "text"), run, "token long, doc long, n long" if long else "bucket int, token binary, doc binary, n binary")


LISTS = "token long, doc long, n long, length long"


def rare_lists(postings: DataFrame, buckets: int) -> DataFrame:
    """Entries of all lists of two documents or more, of tokens that aren't frequent."""

    def run(batches):
        import pyarrow as pa

        parts = [(np.frombuffer(r["token"], "<u8"), np.frombuffer(r["doc"], "<i8"), np.frombuffer(r["n"], "<u4")) for b in batches for r in b.to_pylist()]
        if not parts:
            return
        token, doc, n = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((doc, token))
        token, doc, n = token[order], doc[order], n[order].astype(np.int64)
        cut = np.concatenate([[0], np.flatnonzero(np.diff(token)) + 1])
        length = np.diff(np.append(cut, len(token)))
        of = np.repeat(np.arange(len(cut)), length)
        stay = length[of] > 1
        at = np.flatnonzero(stay)
        for k in range(0, len(at), 100_000):
            x = at[k : k + 100_000]
            yield pa.RecordBatch.from_pydict({"token": token[x].view(np.int64), "doc": doc[x], "n": n[x], "length": length[of[x]]})

    return mapped(postings.repartition(buckets, "bucket"), run, LISTS)


def long_lists(postings: DataFrame) -> DataFrame:
    """Entries of the frequent tokens' lists of two documents or more; their lengths are a bounded table that is broadcast. The
    postings come as rows: a second step in Python would keep two workers a core alive, in all later stages too."""
    rows = saved(postings, "long")
    lengths = rows.groupBy("token").agg(F.count("*").alias("length")).where("length > 1")
    return rows.join(F.broadcast(lengths), "token").select("token", "doc", "n", "length")


def over_lists(rare: DataFrame, often: DataFrame, **found) -> DataFrame:
    """Entries beside aggregates over their list: a window for rare tokens, whose lists are short; for frequent ones, whose
    number is bounded, an aggregate and a broadcast."""
    w = Window.partitionBy("token")
    a = rare.select("*", *(c.over(w).alias(name) for name, c in found.items()))
    return a.unionByName(often.join(F.broadcast(often.groupBy("token").agg(*(c.alias(name) for name, c in found.items()))), "token"))


def with_pivots(rare: DataFrame, often: DataFrame, percent: int, broadcast_bytes: int) -> DataFrame:
    """Entries beside their list's pivot: the document with the largest share of its short lists shared, the smallest of equal
    ones. A text that others are near copies of shares all of its lists; its copies' changes are in lists of their own."""
    prefix = F.col("n") - F.floor((F.lit(percent) * F.col("n") + 99) / 100) + 1
    share = rare.unionByName(often).groupBy("doc", "n").agg(F.count("*").alias("c")).select("doc", (F.col("c") / prefix).alias("share")).groupBy("doc").agg(F.max("share").alias("share"))
    share = small(saved(share, "share"), broadcast_bytes)
    best = F.max(F.struct(F.col("share"), (-F.col("doc")).alias("minus"), F.col("n")))
    rows = over_lists(rare.withColumn("often", F.lit(False)).join(share, "doc"), often.withColumn("often", F.lit(True)).join(share, "doc"), p=best)
    return rows.select("token", "doc", "n", "length", "often", (-F.col("p.minus")).alias("pivot"), F.col("p.n").alias("pivot_n"))


def alike(pairs: DataFrame, base: DataFrame, percent: int) -> DataFrame:
    """The pairs (doc, pivot) whose sketches don't rule a link out."""
    own = base.where("n > 0").select("doc_id", "n", "sketch")
    x, y = (own.select(*(F.col(c).alias(f"{c}_{s}") for c in own.columns)) for s in "xy")
    both = pairs.join(x, pairs["doc"] == x["doc_id_x"]).join(y, F.col("pivot") == y["doc_id_y"])
    return both.where(sketches_allow(percent)).select("doc", "pivot").distinct()


def linked_pairs(docs: DataFrame, pairs: DataFrame, size: int, percent: int, broadcast_bytes: int, group: int = 256) -> DataFrame:
    """Of the pairs (doc, pivot) those that link, as (a, b). A query's documents are searched in groups of about `group`."""
    pairs = saved(pairs, "pairs")
    per_query = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / group).cast("int").alias("parts"))
    asked = pairs.join(per_query, "pivot").groupBy(F.col("doc").alias("id")).agg(F.collect_list(F.struct("pivot", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int").alias("part"))).alias("asked"))
    roles = per_query.select(F.col("pivot").alias("id"), "parts").join(asked, "id", "full")
    roles = small(saved(roles.select("id", F.coalesce("parts", F.lit(0)).alias("parts"), "asked"), "roles"), broadcast_bytes)
    rows = docs.select("doc_id", "text").join(roles, docs["doc_id"] == roles["id"]).select("id", "text", "parts", "asked")

    def spread(batches):
        import pyarrow as pa

        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            ids, parts, asked = (batch.column(c).to_pylist() for c in ("id", "parts", "asked"))
            for i, j in mb_slices(offsets):
                tokens, bounds = shingle_sets(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size)
                out = []
                for d in range(i, j):
                    own = tokens[bounds[d - i] : bounds[d - i + 1]].tobytes()
                    out += [(ids[d], k, 0, ids[d], own) for k in range(parts[d])]
                    out += [(x["pivot"], x["part"], 1, ids[d], own) for x in asked[d] or ()]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()))], ["query", "part", "role", "doc", "tokens"])

    sets = mapped(rows, spread, "query long, part int, role int, doc long, tokens binary")
    sets = sets.repartition("query", "part").sortWithinPartitions("query", "part", "role")

    def find(batches):
        import pyarrow as pa

        now, queries, members, ids = None, [], [], []
        links: list[tuple[int, int]] = []

        def close():
            for q in queries:
                if members:
                    links.extend((ids[m], now[0]) for m in search(q, members, percent))

        for batch in batches:
            for query, part, role, doc, own in zip(*(batch.column(c).to_pylist() for c in ("query", "part", "role", "doc", "tokens"))):
                if now != (query, part):
                    close()
                    now, queries, members, ids = (query, part), [], [], []
                own = np.frombuffer(own, np.uint64)
                if not len(own):
                    continue
                if role == 0:
                    queries.append(own)
                else:
                    members.append(own)
                    ids.append(doc)
                    if len(members) >= 2 * group:
                        close()
                        members, ids = [], []
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)], ["a", "b"])
                links = []
        close()
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)], ["a", "b"])

    return mapped(sets, find, "a long, b long")


PAIRS = "doc_x long, doc_y long, n_x long, n_y long, lists long"


def pairs_of_short_lists(entries: DataFrame, percent: int, held_most: int = 400_000) -> DataFrame:
    """Pairs of different components and fitting sizes, and in how many lists they meet, added up in each task before they
    leave it. A list is in one task whole; rare tokens' lists are short."""

    def run(batches):
        import pyarrow as pa

        held, held_n = [], 0

        def add_up():
            x, y, nx, ny, c = (np.concatenate(v) for v in zip(*held))
            order = np.lexsort((y, x))
            x, y, nx, ny, c = x[order], y[order], nx[order], ny[order], c[order]
            first = np.flatnonzero(np.concatenate([[True], (np.diff(x) != 0) | (np.diff(y) != 0)]))
            return x[first], y[first], nx[first], ny[first], np.add.reduceat(c, first)

        def emit():
            return pa.RecordBatch.from_arrays([pa.array(v) for v in add_up()], ["doc_x", "doc_y", "n_x", "n_y", "lists"])

        def meet(doc, n, comp):
            nonlocal held_n
            for i in range(0, len(doc), 512):  # by blocks, whatever a list's length
                for j in range(i, len(doc), 512):
                    a, b = np.meshgrid(np.arange(i, min(i + 512, len(doc))), np.arange(j, min(j + 512, len(doc))), indexing="ij")
                    a, b = a.ravel(), b.ravel()
                    hit = (a < b) & (comp[a] != comp[b]) & (n[a] * 100 >= n[b] * percent) & (n[b] * 100 >= n[a] * percent)
                    a, b = a[hit], b[hit]
                    low, high = np.where(doc[a] < doc[b], a, b), np.where(doc[a] < doc[b], b, a)
                    if len(low):
                        held.append((doc[low], doc[high], n[low], n[high], np.ones(len(low), np.int64)))
                        held_n += len(low)

        rest = None
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in ("token", "doc", "n", "component")]
            if rest is not None:
                cols = [np.concatenate([r, c]) for r, c in zip(rest, cols)]
            token = cols[0]
            cut = np.concatenate([[0], np.flatnonzero(np.diff(token)) + 1, [len(token)]])
            for a, b in zip(cut[:-2], cut[1:-1]):
                meet(*(c[a:b] for c in cols[1:]))
                if held_n > held_most:
                    small = add_up()
                    held[:], held_n = [small], len(small[0])
                    if held_n > held_most // 2:
                        yield emit()
                        held.clear()
                        held_n = 0
            rest = [c[cut[-2] :] for c in cols]
        if rest is not None:
            meet(*rest[1:])
        if held:
            yield emit()

    return mapped(entries.select("token", "doc", "n", "component").repartition("token").sortWithinPartitions("token"), run, PAIRS)


def pairs_of_long_lists(entries: DataFrame, base: DataFrame, percent: int) -> DataFrame:
    """The same for lists of frequent tokens, by a join whose large keys Spark splits; pairs whose sketches rule a link out are
    no rows of it. A document of several rows has each of their sketches; a list may then count twice, which only admits more."""
    own = base.where("n > 0").select(F.col("doc_id").alias("doc"), "n", "sketch")
    entries = entries.select("token", "doc", "n", "component").join(own, ["doc", "n"])
    x, y = (entries.select("token", *(F.col(c).alias(f"{c}_{s}") for c in ("doc", "n", "component", "sketch"))) for s in "xy")
    hit = (F.col("doc_x") < F.col("doc_y")) & (F.col("component_x") != F.col("component_y")) & fitting("n_x", "n_y", percent) & sketches_allow(percent)
    return x.join(y, "token").where(hit).groupBy("doc_x", "doc_y", "n_x", "n_y").agg(F.count("*").alias("lists"))


def sketches_allow(percent: int):
    """Whether sets of n_x and n_y tokens with sketch_x and sketch_y may link."""
    apart = F.aggregate(F.zip_with("sketch_x", "sketch_y", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, c: s + c)
    wanted = F.floor((F.lit(percent) * (F.col("n_x") + F.col("n_y")) + 99 + percent) / (100 + percent))
    return apart <= F.col("n_x") + F.col("n_y") - 2 * wanted


def fitting(a: str, b: str, percent: int):
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def enough(lists: str, a: str, b: str, percent: int):
    """Whether documents of a and b tokens that meet in so many short lists may link: up to the last short list of the one whose
    lists end first all common tokens are met, and the larger of what both have beyond their short lists bounds the rest."""
    wanted = F.floor((F.lit(percent) * (F.col(a) + F.col(b)) + 99 + percent) / (100 + percent))
    beyond = F.floor((F.lit(percent) * F.greatest(a, b) + 99) / 100) - 1
    return F.col(lists) >= wanted - beyond


def join(docs: DataFrame, size: int = 4, percent: int = 85, longest: int = 512, large: int = 64, tokens_a_bucket: int = 500_000, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_shingles, class_id (smallest doc_id of the same set) and component_id of every row of docs.

    Null, wordless and empty texts have the empty set and are classes and components of their own. Rows of the same doc_id are
    one document of the graph. A row without doc_id gets the ids of its class, null if the class has no other rows, and is no
    bridge between others. Broadcasts (ids that take part in a search) are tables of `broadcast_bytes` at most; beyond, the same joins shuffle.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scanned = saved(scan_sets(docs, size), "sets")
    base = scanned.where("kind = 0").select("doc_id", "n", "s1", "s2", "sketch")
    total = base.agg(F.sum("n")).first()[0] or 0
    buckets = max(8, int(total * (100 - percent) // 100 // tokens_a_bucket))
    often = scanned.where("kind = 1").groupBy(F.col("n").alias("token")).agg(F.sum("s1").alias("c")).orderBy(F.col("c").desc(), "token").limit(FREQUENT).collect()
    counts = {r["token"]: r["c"] for r in often}
    for _ in range(3):  # tokens whose lists turn out long become frequent ones
        frequent = spark.sparkContext.broadcast(Frequent(np.array(list(counts), np.int64).view(np.uint64), np.array(list(counts.values()), np.int64)))
        rare = saved(rare_lists(scan_postings(docs, size, percent, frequent, buckets, False), buckets), "rare")
        more = rare.where(F.col("length") > longest).groupBy("token").agg(F.max("length").alias("c")).orderBy(F.col("c").desc(), "token").limit(FREQUENT).collect()
        if not more or len(counts) + len(more) > 2 * FREQUENT:
            break
        counts |= {r["token"]: r["c"] for r in more}
    often = long_lists(scan_postings(docs, size, percent, frequent, buckets, True))
    lists = saved(with_pivots(rare, often, percent, broadcast_bytes), "lists")

    met = lists.where((F.col("doc") != F.col("pivot")) & fitting("n", "pivot_n", percent)).groupBy("doc", "pivot", "n", "pivot_n").agg(F.count("*").alias("lists")).where(enough("lists", "n", "pivot_n", percent))
    tested = met.groupBy("doc").agg(F.max(F.struct(F.col("lists"), (-F.col("pivot")).alias("minus"))).alias("m")).select("doc", (-F.col("m.minus")).alias("pivot"))
    tested = saved(tested, "first")
    links = saved(linked_pairs(docs, alike(tested, base, percent), size, percent, broadcast_bytes), "links")
    labels = components(links)
    for last in (False, True):
        known = small(saved(labels.withColumnRenamed("id", "doc"), "labels"), broadcast_bytes)
        entries = (lists if last else lists.where(F.col("length") > large)).join(known, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
        entries = over_lists(entries.where("not often"), entries.where("often"), low=F.min("component"), high=F.max("component")).where("low < high").drop("low", "high")
        if last:
            entries = saved(entries, "mixed")
            pairs = pairs_of_short_lists(entries.where("not often"), percent).unionByName(pairs_of_long_lists(entries.where("often"), base, percent))
            pairs = pairs.groupBy("doc_x", "doc_y", "n_x", "n_y").agg(F.sum("lists").alias("lists"))
            pairs = pairs.where(enough("lists", "n_x", "n_y", percent)).select(F.greatest("doc_x", "doc_y").alias("doc"), F.least("doc_x", "doc_y").alias("pivot"))
        else:
            own = known.select(F.col("doc").alias("pivot"), F.col("component").alias("pivot_component"))
            apart = entries.select("doc", "pivot", "component").distinct().join(own, "pivot", "left").where(F.col("component") != F.coalesce("pivot_component", "pivot")).select("doc", "pivot")
            pairs = met.join(apart, ["doc", "pivot"], "left_semi").select("doc", "pivot")
        either = tested.unionByName(tested.select(F.col("pivot").alias("doc"), F.col("doc").alias("pivot")))
        pairs = saved(pairs.distinct().join(either, ["doc", "pivot"], "left_anti"), "more")
        if not pairs.isEmpty():
            tested = tested.unionByName(pairs)
            links = saved(links.unionByName(linked_pairs(docs, alike(pairs, base, percent), size, percent, broadcast_bytes)), "links")
            labels = components(links)

    known = base.where("n > 0").join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    classes = saved(known.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("class_id"), F.min("component").alias("label")), "classes")
    smallest = classes.where("label is not null").groupBy("label").agg(F.min("class_id").alias("least"))
    classes = classes.join(smallest, "label", "left").select("n", "s1", "s2", "class_id", F.coalesce("least", "class_id").alias("component_id"))
    out = base.drop("sketch").join(classes, ["n", "s1", "s2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("component_id", "doc_id").alias("component_id"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
