"""Token-id output: byte-level BPE ids, Re-Pair compressed per segment, with random access to every document.

Layout of a segment (little endian): magic `RPK2`; u32 number of documents, number of rules, first rule symbol, number of
symbols, width of a symbol in bytes, number of ids; i64 doc ids; u8 null flags of doc ids; u32 symbols of each document;
u32 ids of each document; left, right and expansion length of each rule; the symbols. A rule's two sides are ids or
earlier rules. No rule spans two documents, so a document is decoded from its own symbols alone, and a position inside
it is found from the expansion lengths. Sides are as wide as symbols; a length is one or more of 7 bits, low ones first.
Segments are rows of a Parquet dataset written by Spark's committer: lost executors leave no partial files.
"""

from __future__ import annotations

import os
import struct
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fmix, mapped, mb_slices, ragged, text_bytes, words, work_path

MAGIC = b"RPK2"
SEGMENT_SCHEMA = "part int, seq int, n_docs long, n_ids long, blob binary"


@lru_cache(maxsize=1)
def _loaded(path: str, changed: int, size: int):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def loaded(path: str):
    """The tokenizer at `path`, one in a process for all of its tasks: each one that has encoded leaves some MB behind that no
    trim gives back, so one a task would let a worker grow with the number of its tasks."""
    at = os.stat(path)
    return _loaded(path, at.st_mtime_ns, at.st_size)


class Encoder:
    """Whole-text encoding with the tokenizers library, a vocabulary entry at a time.

    The byte-level pattern never lets a token cross the place before a single space that a non-space follows, nor one between
    an ASCII letter and another ASCII character (after an apostrophe or white space it may), so text is cut there, and each
    distinct piece (by a 64-bit hash) is encoded once and kept. Pieces that are one word of Latin letters go to the library's
    BPE model at once, all others through its whole pipeline. Text with two spaces in a row, with a space at its end, or with
    a special token's string is encoded in one piece. Texts over `chunk` bytes are cut at such spaces and encoded chunk by chunk.

    Pieces and their ids are kept in arrays of fixed size, about `held_bytes` in all; full, only those that were met again stay.
    """

    def __init__(self, path: str, keep: int = 1 << 19, chunk: int = 1 << 18):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; more threads would take those of others
        self.tokenizer, self.keep, self.chunk = loaded(path), keep, chunk
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.table = np.ones(256, bool)
        self.table[0x20] = False
        code = np.arange(256)
        self.letter = ((code >= 65) & (code <= 90)) | ((code >= 97) & (code <= 122))
        self.other = (code < 128) & ~self.letter & (code != 0x20)
        self.before_letter = self.other & (code != 0x27) & (code > 0x20) & (code != 0x7F)
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # the byte alphabet of byte-level BPE
        rest = [b for b in range(256) if b not in printable]
        self.alphabet = np.arange(256, dtype="<u2")
        self.alphabet[rest] = 256 + np.arange(len(rest))
        probe = " Probe"
        self.direct = [t.id for t in self.tokenizer.model.tokenize(self.mapped(np.frombuffer(probe.encode(), np.uint8)))] == self.whole(probe).tolist()
        bits = max(8, (4 * keep - 1).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slot_hash, self.slot_row = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
        self.flat, self.begin, self.length = np.zeros(6 * keep, np.uint32), np.zeros(keep, np.int32), np.zeros(keep, np.int32)
        self.key, self.again = np.zeros(keep, np.uint64), np.zeros(keep, bool)  # of each piece: its hash, whether it was met again
        self.reset()

    def reset(self) -> None:
        self.slot_hash[:] = 0
        self.slot_row[:] = -1
        self.again[:] = False
        self.n_pieces = self.n_flat = 0
        self.crowded: dict[int, int] = {}  # pieces whose slot another one has

    @property
    def held_bytes(self) -> int:
        """What the piece table holds at most."""
        return sum(x.nbytes for x in (self.slot_hash, self.slot_row, self.flat, self.begin, self.length, self.key, self.again)) + 100 * len(self.crowded)

    def mapped(self, raw: np.ndarray) -> str:
        """Bytes in the alphabet of byte-level BPE, one character each."""
        return self.alphabet[raw].tobytes().decode("utf-16-le")

    def latin(self, raw: np.ndarray) -> np.ndarray:
        """Which bytes belong to letters before U+0250."""
        good = self.letter[raw]
        lead, after = raw[:-1], raw[1:]
        two = (lead >= 0xC3) & (lead <= 0xC9) & ~((lead == 0xC9) & (after > 0x8F)) & ~((lead == 0xC3) & ((after == 0x97) | (after == 0xB7)))
        two |= (lead == 0xC2) & ((after == 0xAA) | (after == 0xB5) | (after == 0xBA))
        good[:-1] |= two
        good[1:] |= two
        return good

    def encoded(self, raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces of raw in a row, and the number of each piece's."""
        out: list = [()] * len(starts)
        direct = np.zeros(len(starts), bool)
        if self.direct:
            others = np.concatenate([[0], np.cumsum(~self.latin(raw))])
            first = starts + (raw[starts] == 0x20)
            direct = (others[stops] == others[first]) & (stops > first)
        if direct.any():
            text, tokenize = self.mapped(raw), self.tokenizer.model.tokenize
            for i, a, b in zip(np.flatnonzero(direct).tolist(), starts[direct].tolist(), stops[direct].tolist()):
                out[i] = tokenize(text[a:b])
        rest = np.flatnonzero(~direct)
        data = raw.tobytes()
        pieces = [data[a:b].decode() for a, b in zip(starts[rest].tolist(), stops[rest].tolist())]
        for i, e in zip(rest.tolist(), self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)):
            out[i] = e.ids
        size = np.fromiter(map(len, out), np.int64, len(out))
        ids = np.zeros(int(size.sum()), np.uint32)
        tokens = np.repeat(direct, size)
        ids[tokens] = [t.id for i in np.flatnonzero(direct).tolist() for t in out[i]]
        ids[~tokens] = [k for i in rest.tolist() for k in out[i]]
        return ids, size

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def rows_of(self, keys: np.ndarray) -> np.ndarray:
        """Number of each known piece, -1 for unknown ones."""
        slot = (keys >> self.shift).astype(np.int64)
        row = self.slot_row[slot]
        miss = np.flatnonzero((self.slot_hash[slot] != keys) | (row < 0))
        if len(miss):
            row[miss] = [self.crowded.get(k, -1) for k in keys[miss].tolist()] if self.crowded else -1
        return row

    def learn(self, keys: np.ndarray, raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> bool:
        """Keeps the ids of new pieces of raw; false if there is no room for them."""
        return self.n_pieces + len(keys) <= self.keep and self._put(keys, *self.encoded(raw, starts, stops))

    def _put(self, keys: np.ndarray, ids: np.ndarray, size: np.ndarray) -> bool:
        at, n = self.n_pieces, self.n_pieces + len(keys)
        if n > self.keep or self.n_flat + len(ids) > len(self.flat):
            return False
        self.flat[self.n_flat : self.n_flat + len(ids)] = ids
        self.begin[at:n] = self.n_flat + np.cumsum(size) - size
        self.length[at:n], self.key[at:n] = size, keys
        self.n_pieces, self.n_flat = n, self.n_flat + len(ids)
        rows = np.arange(at, n)
        slot = (keys >> self.shift).astype(np.int64)
        free = self.slot_row[slot] < 0
        slot, own, rows_free = slot[free], keys[free], rows[free]
        self.slot_hash[slot], self.slot_row[slot] = own, rows_free
        lost = np.concatenate([rows[~free], rows_free[self.slot_row[slot] != rows_free]])
        self.crowded.update(zip(keys[lost - at].tolist(), lost.tolist()))
        return True

    def squeeze(self) -> None:
        """Drops the pieces that were not met again since the last time; all, if the others take more than half of the room."""
        stay = np.flatnonzero(self.again[: self.n_pieces])
        keys, size = self.key[stay], self.length[stay].astype(np.int64)
        ids = self.flat[ragged(self.begin[stay].astype(np.int64), size)]
        self.reset()
        if 2 * len(stay) <= self.keep and 2 * len(ids) <= len(self.flat):
            self._put(keys, ids, size)

    def batch(self, column):
        """Of an Arrow column of texts, slice by slice: first row, the ids in a row, and the number of each text's; null and
        empty texts have none."""
        raw, offsets = text_bytes(column, lower=False)
        for i, j in mb_slices(offsets, self.chunk):
            own = raw[offsets[i] : offsets[j]]
            if j == i + 1 and len(own) > self.chunk:
                parts = [self._slice(part, np.array([0, len(part)], np.int64))[0] for part in self._chunks(own)]
                yield i, np.concatenate(parts), np.array([sum(map(len, parts))], np.int64)
            else:
                yield i, *self._slice(own, offsets[i : j + 1] - offsets[i])

    def _chunks(self, raw: np.ndarray):
        """A long text in parts of about `chunk` bytes, cut before single spaces between non-spaces; where there is none, longer."""
        at = 0
        while at < len(raw):
            stop, reach = at + self.chunk, 1 << 12
            while stop < len(raw):
                near = raw[stop - 1 : stop + reach]
                space = near == 0x20
                cut = np.flatnonzero(space[1:-1] & ~space[:-2] & ~space[2:])
                if len(cut):
                    stop += int(cut[0])
                    break
                stop, reach = stop + max(1, len(near) - 2), min(2 * reach, self.chunk)
                if stop >= len(raw) - 2:
                    stop = len(raw)
            yield raw[at : min(stop, len(raw))]
            at = stop

    def _slice(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(offsets) - 1
        space = raw == 0x20
        odd = np.zeros(n, bool)
        if len(raw):
            twice = np.flatnonzero(space[1:] & space[:-1]) + 1
            odd[np.searchsorted(offsets, twice, side="right") - 1] = True
            last = offsets[1:] - 1
            odd |= (np.diff(offsets) > 0) & space[np.maximum(last, 0)]
        data = raw.tobytes()
        if any(s in data for s in self.special):
            odd |= [any(s in data[a:b] for s in self.special) for a, b in zip(offsets[:-1], offsets[1:])]
        left, right = raw[:-1], raw[1:]
        cuts = np.flatnonzero((self.letter[left] & self.other[right]) | (self.before_letter[left] & self.letter[right])) + 1
        hashes, starts, stops, ends = words(raw, offsets, self.table, cuts)
        owner = np.repeat(np.arange(n), np.diff(ends))
        led = (starts > offsets[owner]) & (space[starts - 1] if len(raw) else False)  # a space stands before it
        keys = np.where(led, hashes, fmix(hashes + np.uint64(1)))
        if odd.any():
            stay = ~odd[owner]
            keys, starts, stops, owner, led = keys[stay], starts[stay], stops[stay], owner[stay], led[stay]
        rows = self.rows_of(keys)
        self.again[rows[rows >= 0]] = True
        if (rows < 0).any():
            rows = self._learned(keys, rows, raw, starts - led, stops)
            if rows is None:  # more pieces than the table can hold, even empty
                odd[:] = True
                rows, owner = np.zeros(0, np.int64), np.zeros(0, np.int64)
        size = self.length[rows].astype(np.int64)
        flat = self.flat[ragged(self.begin[rows].astype(np.int64), size)]
        counts = np.bincount(owner, weights=size, minlength=n).astype(np.int64)
        if not odd.any():
            return flat, counts
        parts, at = [], 0
        for d in range(n):
            if odd[d]:
                parts.append(self.whole(data[offsets[d] : offsets[d + 1]].decode()))
                counts[d] = len(parts[-1])
            else:
                parts.append(flat[at : at + counts[d]])
                at += int(counts[d])
        return np.concatenate(parts), counts

    def _learned(self, keys, rows, raw: np.ndarray, starts, stops):
        """Rows of all pieces after the missing ones are learned; if the table is full, room is made."""
        for make_room in (self.squeeze, self.reset, None):
            miss = np.flatnonzero(rows < 0)
            new, first, which = np.unique(keys[miss], return_index=True, return_inverse=True)
            at, n = miss[first], self.n_pieces
            if self.learn(new, raw, starts[at], stops[at]):
                rows[miss] = n + which
                return rows
            if make_room:
                make_room()
                rows = self.rows_of(keys)
        return None


def count_pairs(seq: np.ndarray, inside: np.ndarray, least: int):
    """The pair of adjacent symbols at each place, whether it can be replaced there (inside a document; in a run of one symbol
    every second place), and the pairs that can `least` times or more with that number."""
    same = np.flatnonzero((seq[:-1] == seq[1:]) & inside)
    if len(same):
        run = np.concatenate([[True], np.diff(same) != 1])
        since = np.arange(len(same)) - np.flatnonzero(run)[np.cumsum(run) - 1]
        inside = inside.copy()
        inside[same[since % 2 == 1]] = False
    kind, bits = (np.uint32, 16) if seq.dtype == np.uint16 else (np.uint64, 32)
    key = seq[:-1].astype(kind)
    key <<= kind(bits)
    key |= seq[1:]
    ordered = np.sort(key[inside])
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(ordered)))
    often = n >= least
    return key, inside, ordered[first[often]], n[often]


def pair_bucket(key: np.ndarray) -> np.ndarray:
    """20 bits of a multiplicative hash."""
    if key.dtype == np.uint32:
        return (key * np.uint32(0x9E3779B1)) >> np.uint32(12)
    return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.uint32)


#: A rule is stored in three symbols' room (two sides and a length), so it pays from four replacements.
PAYS = 4


def repair(seq: np.ndarray, counts: np.ndarray, first_rule: int, most_rules: int, least: int = PAYS):
    """Re-Pair: the most frequent pairs become nonterminals, again and again, until no pair pays for its rule.

    Each round takes many pairs, the most frequent first, two thirds of the room for rules at most; of pairs that overlap in
    the text the left one is replaced, and a pair that is left with fewer than `least` replacements stays for a later round.
    `most_rules` is the number of rules that symbols of two bytes can name, as one more would widen every symbol.
    seq: ids; counts: ids of each document. Returns symbols, symbols per document, rules (n x 2).
    """
    small = first_rule + most_rules <= 1 << 16
    seq = seq.astype(np.uint16 if small else np.uint32)
    bits = 16 if small else 32
    end = np.zeros(len(seq), bool)  # the last symbol of each document
    last = np.cumsum(counts)[counts > 0] - 1
    end[last] = True
    rules: list[np.ndarray] = []
    n_rules, batch = 0, most_rules
    slot = np.full(1 << 20, -1, np.int32)
    while len(seq) > 1 and n_rules < most_rules:
        key, can, pairs, n = count_pairs(seq, ~end[:-1], least)
        if not len(pairs):
            break
        room = most_rules - n_rules
        room = min(batch, room if room <= 2048 else room * 2 // 3)
        pairs = pairs[np.lexsort((pairs, -n))[:room]]
        bucket = pair_bucket(pairs)
        slot[bucket[::-1]] = np.arange(len(pairs), dtype=np.int32)[::-1]  # of pairs in one bucket the most frequent one goes first
        found = slot[pair_bucket(key)]
        slot[bucket] = -1
        at = np.flatnonzero((found >= 0) & can)
        found = found[at]
        hit = pairs[found] == key[at]
        at, found = at[hit], found[hit]
        run = np.concatenate([[True], np.diff(at) != 1])  # of adjacent matches every second one can be replaced
        since = np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]
        take = since % 2 == 0
        at, found = at[take], found[take]
        pays = np.bincount(found, minlength=len(pairs)) >= least
        if not pays.any():  # all were in each other's way; the most frequent pair alone always pays
            batch = max(1, min(batch, len(pairs)) // 4)
            continue
        at, found = at[pays[found]], (np.cumsum(pays) - 1)[found[pays[found]]]
        pairs, batch = pairs[pays].astype(np.uint64), most_rules
        seq[at] = first_rule + n_rules + found
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        end[at] = end[at + 1]
        seq, end = seq[stay], end[stay]
        rules.append(np.stack([pairs >> np.uint64(bits), pairs & np.uint64((1 << bits) - 1)], axis=1).astype(np.uint32))
        n_rules += len(pairs)
    per_doc = np.zeros(len(counts), np.int64)
    per_doc[counts > 0] = np.diff(np.concatenate([[-1], np.flatnonzero(end)]))
    return seq, per_doc, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def expansions(rules: np.ndarray, first_rule: int) -> np.ndarray:
    """Number of ids each rule stands for; a rule uses only ids and earlier rules."""
    size = np.ones(len(rules), np.int64)
    for _ in range(64):
        sides = np.where(rules >= first_rule, size[np.maximum(rules.astype(np.int64) - first_rule, 0)] if len(rules) else 1, 1)
        new = sides.sum(axis=1)
        if (new == size).all():
            break
        size = new
    return size


def pack_lengths(n: np.ndarray) -> bytes:
    """Numbers in bytes of 7 bits, low ones first; the top bit says that more follow."""
    out, shown = [], n.astype(np.int64)
    size = np.ones(len(n), np.int64)
    while (more := shown >> (7 * size)).any():
        size += more > 0
    place = ragged(np.zeros(len(n), np.int64), size)
    whole = np.repeat(shown, size)
    out = ((whole >> (7 * place)) & 127) | (np.where(place < np.repeat(size, size) - 1, 128, 0))
    return out.astype(np.uint8).tobytes()


def unpack_lengths(raw: np.ndarray, n: int) -> tuple[np.ndarray, int]:
    """n numbers from the start of raw, and the bytes they take."""
    last = np.flatnonzero(raw < 128)[:n]
    used = int(last[-1]) + 1 if n else 0
    first = np.concatenate([[0], last[:-1] + 1]) if n else np.zeros(0, np.int64)
    size = last - first + 1
    parts = (raw[:used].astype(np.int64) & 127) << (7 * ragged(np.zeros(n, np.int64), size))
    return np.add.reduceat(parts, first) if n else np.zeros(0, np.int64), used


def pack(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray, first_rule: int) -> bytes:
    """One segment; ids of all documents in a row, counts of each; first_rule: above every id."""
    room = (1 << 16) - first_rule
    wide = room < 4096
    symbols, per_doc, rules = repair(ids, counts, first_rule, (1 << 31) - first_rule if wide else room)
    width = 4 if wide else 2
    kind = f"<u{width}"
    return b"".join([
        MAGIC, struct.pack("<6I", len(counts), len(rules), first_rule, len(symbols), width, int(counts.sum())),
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.array([x is None for x in doc_ids], "u1").tobytes(),
        per_doc.astype("<u4").tobytes(), counts.astype("<u4").tobytes(),
        rules[:, 0].astype(kind).tobytes(), rules[:, 1].astype(kind).tobytes(), pack_lengths(expansions(rules, first_rule)),
        symbols.astype(kind).tobytes(),
    ])


class Segment:
    """Random-access reader of one segment."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a segment")
        docs, n_rules, self.first_rule, n, width, self.n_ids = struct.unpack_from("<6I", blob, 4)
        at = 28

        def read(kind: str, k: int) -> np.ndarray:
            nonlocal at
            x = np.frombuffer(blob, kind, k, at)
            at += x.nbytes
            return x

        ids, null = read("<i8", docs), read("u1", docs)
        self.doc_ids = [None if z else int(i) for i, z in zip(ids, null)]
        self.symbols_of, self.n_tokens = read("<u4", docs), read("<u4", docs)
        self.left, self.right = read(f"<u{width}", n_rules), read(f"<u{width}", n_rules)
        self.size, used = unpack_lengths(np.frombuffer(blob, np.uint8, -1, at), n_rules)
        at += used
        self.symbols = read(f"<u{width}", n)
        self.ends = np.cumsum(self.symbols_of, dtype=np.int64)
        self._flat: tuple[np.ndarray, np.ndarray] | None = None

    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        """Every rule's ids in a row, and where each begins."""
        if self._flat is None:
            size = self.size.astype(np.int64)
            begin = np.cumsum(size) - size
            owner = np.repeat(np.arange(len(size)), size)
            flat = np.arange(len(owner)) - begin[owner] if len(size) else np.zeros(0, np.int64)  # offset inside the rule
            symbol = owner + self.first_rule
            while (nested := symbol >= self.first_rule).any():
                at = np.flatnonzero(nested)
                rule = symbol[at] - self.first_rule
                left = self.left[rule].astype(np.int64)
                left_size = np.where(left >= self.first_rule, size[np.maximum(left - self.first_rule, 0)], 1)
                goes_right = flat[at] >= left_size
                symbol[at] = np.where(goes_right, self.right[rule], left)
                flat[at] -= np.where(goes_right, left_size, 0)
            self._flat = symbol.astype(np.uint32), begin
        return self._flat

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        flat, begin = self._table()
        symbols = symbols.astype(np.int64)
        rule = symbols - self.first_rule
        nested = rule >= 0
        safe = np.maximum(rule, 0)
        table = np.concatenate([flat, np.arange(self.first_rule, dtype=np.uint32)])
        start = np.where(nested, begin[safe] if len(begin) else 0, len(flat) + symbols)
        return table[ragged(start, np.where(nested, self.size[safe] if len(begin) else 1, 1).astype(np.int64))]

    def document(self, i: int) -> np.ndarray:
        return self.expand(self.symbols[self.ends[i] - self.symbols_of[i] : self.ends[i]])

    def token(self, i: int, k: int) -> int:
        """The k-th id of document i, by descending from the symbol that covers it; nothing else is expanded."""
        own = self.symbols[self.ends[i] - self.symbols_of[i] : self.ends[i]].astype(np.int64)
        size = np.where(own >= self.first_rule, self.size[np.maximum(own - self.first_rule, 0)] if len(self.size) else 1, 1)
        upto = np.cumsum(size)
        at = int(np.searchsorted(upto, k, side="right"))
        k -= int(upto[at] - size[at])
        s = int(own[at])
        while s >= self.first_rule:
            left = int(self.left[s - self.first_rule])
            n = int(self.size[left - self.first_rule]) if left >= self.first_rule else 1
            s, k = (left, k) if k < n else (int(self.right[s - self.first_rule]), k - n)
        return s


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 2, segment_ids: int = 1_000_000) -> None:
    """Encodes every text in ascending (doc_id, text) order and writes the segments to `path`.

    Null and empty texts are the end id alone; null doc ids come first; repeated doc ids stay as rows of their own; other
    columns are ignored. An empty table writes a dataset without rows. One range-partitioning shuffle. A task holds one Arrow
    batch, one segment's ids and one piece table of fixed size; a segment has about `segment_ids` ids, or one longer document.
    """
    part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    part = part.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = Encoder(tokenizer_path)  # its piece table is not kept between tasks: it would count in every later stage of the worker
        first_rule = max(encoder.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        own, seq, ids, counts, keys, held = TaskContext.get().partitionId(), 0, [], [], [], 0

        def segment():
            blob = pack(keys, np.concatenate(counts), np.concatenate(ids), first_rule)
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([own], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_docs": [len(keys)], "n_ids": [held], "blob": [blob]})

        for batch in batches:
            own_keys = batch.column("doc_id").to_pylist()
            for i, flat, n in encoder.batch(batch.column("text")):
                ends = np.cumsum(n + 1) - 1
                with_end = np.empty(len(flat) + len(n), np.uint32)
                text = np.ones(len(with_end), bool)
                text[ends] = False
                with_end[text], with_end[ends] = flat, end_id
                keys += own_keys[i : i + len(n)]
                ids.append(with_end)
                counts.append(n + 1)
                held += len(with_end)
                if held >= segment_ids:
                    yield segment()
                    seq, ids, counts, keys, held = seq + 1, [], [], [], 0
        if keys:
            yield segment()

    mapped(part, run, SEGMENT_SCHEMA).write.mode("overwrite").parquet(path, compression="zstd")


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents of the segments at `path`: doc_id, start (ids before it), n_tokens, ids_crc32, and `ids` on request.

    Only one row a part goes through the running total, not one a segment or document.
    """
    table = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    sizes = table.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = sizes.select("part", (F.sum("part_ids").over(Window.orderBy("part")) - F.col("part_ids")).alias("base"))
    inside = table.select("part", "seq", "n_ids").withColumn("ahead", F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids"))
    base = inside.join(before, "part").select("part", "seq", (F.col("base") + F.col("ahead")).alias("base"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for blob, part, seq in zip(batch.column("blob"), batch.column("part").to_pylist(), batch.column("seq").to_pylist()):
                s = Segment(blob.as_py())
                flat = s.expand(s.symbols).astype("<u4")
                ends = np.cumsum(s.n_tokens, dtype=np.int64)
                starts = ends - s.n_tokens
                out = {"part": pa.array([part] * len(ends), pa.int32()), "seq": pa.array([seq] * len(ends), pa.int32()),
                       "doc_id": pa.array(s.doc_ids, pa.int64()), "ahead": starts, "n_tokens": s.n_tokens.astype(np.int64),
                       "ids_crc32": np.array([zlib.crc32(flat[a:b]) for a, b in zip(starts, ends)], np.int64)}
                if with_ids:
                    out["ids"] = pa.array([flat[a:b].astype(np.int64) for a, b in zip(starts, ends)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(out)

    rows = mapped(table.select("part", "seq", "blob"), run, "part int, seq int, doc_id long, ahead long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else ""))
    out = rows.join(base, ["part", "seq"])
    columns = ["doc_id", (F.col("ahead") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"] + (["ids"] if with_ids else [])
    return out.select(*columns)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_output(spark: SparkSession, docs: DataFrame, tokenizer_path: str | None = None, end_id: int = 2, segment_ids: int = 1_000_000) -> DataFrame:
    """Writes docs as segments to a work folder of the cluster and returns what reading them back gives, which is the same for segments
    of any size: small ones take less memory in a task, and more time, as their rules run out later."""
    path = work_path(spark, "tokens")
    write_tokens(docs, tokenizer_path or default_tokenizer(), path, end_id, segment_ids)
    return read_tokens(spark, path)


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
