"""Fill-in-the-middle rewriting with a table-driven byte automaton.

One scan of the UTF-8 bytes by a transition table follows units (white space and the word after it), sentinels and continuation
bytes at once. It emits the number of the transition taken at every byte; the units, code points and sentinels of a text are
counts of such transitions, and a second pass over the emitted numbers finds the bytes at which to cut. The automaton forgets:
after two bytes its state no longer depends on the state before them. So the scan is run in lanes, all lanes a byte at a time,
each from two bytes before its start.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mapped, row_slices, text_bytes

#: What stands before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

# Classes of bytes; END stands between texts and in no text, as UTF-8 has no byte 0xFF.
BLANK, OTHER, CONTINUED, OPENS, NAMES, CLOSES, END = range(7)
CLASSES = 7
# States: at a text's start, after white space, in a word, after "<", after "<" and a name.
START, SPACE, WORD, OPENED, NAMED = range(5)


def byte_classes() -> np.ndarray:
    table = np.full(256, OTHER, np.uint8)
    table[[0x20, *range(0x09, 0x0E)]] = BLANK
    table[0x80:0xC0] = CONTINUED
    table[ord("<")], table[ord(">")], table[0xFF] = OPENS, CLOSES, END
    table[[ord(s[1]) for s in (PREFIX, SUFFIX, MIDDLE)]] = NAMES
    return table


def transitions() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By transition (state * CLASSES + class): next state, and whether it begins a unit, begins a code point, ends a sentinel."""
    go = np.full((5, CLASSES), WORD, np.uint8)
    go[:, BLANK], go[:, OPENS], go[:, END] = SPACE, OPENED, START
    go[OPENED, NAMES] = NAMED
    unit, point, sentinel = (np.zeros((5, CLASSES), bool) for _ in range(3))
    unit[START, :END] = True
    unit[[WORD, OPENED, NAMED], BLANK] = True
    point[:, [BLANK, OTHER, OPENS, NAMES, CLOSES]] = True
    sentinel[NAMED, CLOSES] = True
    return go.ravel(), unit.ravel(), point.ravel(), sentinel.ravel()


CLASS, (GO, UNIT, POINT, SENTINEL) = byte_classes(), transitions()
#: Bytes after which the state is the same from whichever state they are read.
MEMORY = 2


def scan(raw: np.ndarray, lane: int = 512) -> np.ndarray:
    """Number of the transition at every byte of texts that each end with END."""
    n = len(raw)
    lane = max(MEMORY, min(lane, n))
    lanes = -(-n // lane)
    classes = np.full(lanes * lane + MEMORY, END, np.uint8)
    np.take(CLASS, raw, out=classes[MEMORY : MEMORY + n], mode="clip")
    steps = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(classes, lane + MEMORY)[::lane].T)
    state, out, following = np.full(lanes, START * CLASSES, np.uint8), np.empty((lane + MEMORY, lanes), np.uint8), (GO * CLASSES).astype(np.uint8)
    for t in range(lane + MEMORY):
        np.add(state, steps[t], out=out[t])
        np.take(following, out[t], out=state, mode="clip")
    return np.ascontiguousarray(out[MEMORY:].T).ravel()[:n]


def drawn(key, seed: int) -> list[int]:
    """Four numbers of 32 bits from the id; a null id counts as the empty string."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """key, n (units), form (plain, psm or spm), prefix_chars and middle_chars (null if plain) and output of every text.

    A text is cut before two units drawn from its id. `percent` of the texts are rewritten, `spm_percent` of those with the suffix
    first; empty and null texts, and texts that hold a sentinel, stay plain. Rows that share an id are cut by the same numbers.
    What a task holds is a few times a slice of 1 MB, or the longest text.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for i, j in row_slices(batch.column("text"), 1 << 20, 4096):
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part.column("key"), *rewritten(part.column("key").to_pylist(), part.column("text"))], ["key", "n", "form", "prefix_chars", "middle_chars", "output"])

    def rewritten(keys, texts):
        import pyarrow as pa

        raw, offsets = text_bytes(texts, lower=False)
        rows = len(keys)
        stream = np.insert(raw, offsets[1:], 0xFF)
        starts, stops = offsets[:-1] + np.arange(rows), offsets[1:] + np.arange(rows)
        taken = scan(stream)
        units = np.add.reduceat(UNIT[taken], starts, dtype=np.int64)
        sentinels = np.add.reduceat(SENTINEL[taken], starts, dtype=np.int64)
        begins, points, first = np.flatnonzero(UNIT[taken]), POINT[taken], np.cumsum(units) - units
        forms, prefixes, middles, outputs = [], [], [], []
        for r, (a, b, n, f) in enumerate(zip(starts.tolist(), stops.tolist(), units.tolist(), first.tolist())):
            h1, h2, h3, h4 = drawn(keys[r], seed)
            if n == 0 or sentinels[r] or h3 % 100 >= percent:
                forms.append("plain")
                prefixes.append(None)
                middles.append(None)
                outputs.append(stream[a:b].tobytes())
                continue
            p, m = (int(begins[f + u]) if u < n else b for u in sorted((h1 % (n + 1), h2 % (n + 1))))
            prefix, middle, suffix = stream[a:p].tobytes(), stream[p:m].tobytes(), stream[m:b].tobytes()
            spm = h4 % 100 < spm_percent
            forms.append("spm" if spm else "psm")
            prefixes.append(int(np.count_nonzero(points[a:p])))
            middles.append(int(np.count_nonzero(points[p:m])))
            pieces = (SUFFIX.encode(), suffix, PREFIX.encode(), prefix, MIDDLE.encode(), middle) if spm else (PREFIX.encode(), prefix, SUFFIX.encode(), suffix, MIDDLE.encode(), middle)
            outputs.append(b"".join(pieces))
        return pa.array(units), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()), pa.array(outputs, pa.binary()).cast(pa.string())

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return mapped(rows, run, f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output string").withColumnRenamed("key", key)


def restored(output: Column, form: Column) -> Column:
    """The text again, from its output and form alone: a rewritten text holds each sentinel once."""

    def between(left: str, right: str | None) -> Column:
        start = F.instr(output, left) + 3
        return output.substr(start, (F.instr(output, right) - start) if right else F.length(output))

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))
