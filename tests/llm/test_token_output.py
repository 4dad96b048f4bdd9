import ctypes
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer, models

from ledgerlark.llm.common import work_path
from ledgerlark.llm.token_output import (
    PAYS, SEGMENT_SCHEMA, Encoder, Segment, default_tokenizer, loaded, op6_token_output, pack, pack_lengths, repair, token_output, unpack_lengths, write_tokens)

ODD = ["don't we'll I'D ''s a's'x", 'x1y2 3z*** aODD = [ODD = [ODD = [\n\nThe end.\nNext', 'A\n\nB', 'q.\n Z', None, "", " ", "  ", "a  b", "x \n y", "x\n\n b", "a \nb", "end ", " lead", "<|endoftext|> x <|endoftext|>", "ünï 中文 😀's it's", "a  b", "\t\tq   r", "w " * 5000, "same text here"]


def brute(texts):
    t = Tokenizer.from_file(default_tokenizer())
    return [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]


def test_pieces_equal_whole_texts():
    for keep in (3, 800_000):
        e = Encoder(default_tokenizer(), keep=keep)
        for texts in (ODD, ODD[::-1], ODD):
            got = []
            for _, ids, counts in e.batch(pa.array(texts, pa.string())):
                stops = np.cumsum(counts)
                got += [ids[a:b].tolist() + [2] for a, b in zip(stops - counts, stops)]
            assert got == brute(texts)


def test_segment_round_trip_and_random_access():
    rng = np.random.default_rng(0)
    ids = [rng.choice(30, n, p=np.arange(1, 31) / 465).astype(np.uint32) for n in (1, 700, 0, 3000, 5)]
    s = Segment(pack([5, None, 7, 7, 9], np.array([len(x) for x in ids]), np.concatenate(ids), 50_260))
    assert s.doc_ids == [5, None, 7, 7, 9] and len(s.left) > 3 and len(s.symbols) < 3000
    for i, x in enumerate(ids):
        assert (s.document(i) == x).all()
        for k in range(0, len(x), 97):
            assert s.token(i, k) == x[k]


def test_query_against_brute_force(spark, sf_dir):
    rows = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in op6_token_output(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    at = 0
    for r, ids in zip(rows, brute([r.text for r in rows])):
        g = got[r.doc_id]
        assert (g.start, g.n_tokens, g.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_nulls_ties_empty_and_clashing_columns(spark):
    docs = spark.createDataFrame([(None, "a b", 1, 2), (3, None, 1, 2), (3, "a b", 1, 2), (3, "a b", 1, 2)], "doc_id long, text string, start long, ids int")
    got = token_output(spark, docs).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 3, 3, 3] and [r.n_tokens for r in got] == [3, 1, 3, 3] and [r.start for r in got] == [0, 3, 4, 7]
    assert token_output(spark, docs.limit(0)).count() == 0


def test_piece_table_is_bounded():
    e = Encoder(default_tokenizer(), keep=2000)
    before = e.held_bytes
    texts = [" ".join(f"w{i}x{k}" for k in range(400)) for i in range(60)]
    for _ in range(2):
        got = [ids[a:b].tolist() + [2] for _, ids, counts in e.batch(pa.array(texts, pa.string())) for b, a in zip(np.cumsum(counts), np.cumsum(counts) - counts)]
        assert got == brute(texts)
    assert e.n_pieces <= 2000 and e.held_bytes <= before + 100 * 2000
    assert Encoder(default_tokenizer()).held_bytes < 64 << 20


def test_long_texts_are_cut_at_single_spaces():
    rng = np.random.default_rng(1)
    words = ["don't", "x1", "\n", "", " ", "naïve", "word.", "中文", "\t", "123", "<|endoftext|>"]
    texts = [" ".join(rng.choice(words, 4000)), "no-space-" * 3000, "x" + " " * 9000 + "y", "a b" * 20_000, "e " * 3000]
    e = Encoder(default_tokenizer(), chunk=1000)
    got = [(i, ids.tolist() + [2]) for i, ids, counts in e.batch(pa.array(texts, pa.string()))]
    assert [i for i, _ in got] == list(range(5)) and [x for _, x in got] == brute(texts)


def test_no_pair_is_left_that_pays():
    rng = np.random.default_rng(2)
    ids = [rng.choice(40, n, p=np.arange(1, 41) / 820).astype(np.uint32) for n in (5000, 3, 9000)] + [np.full(999, 7, np.uint32)]
    counts = np.array([len(x) for x in ids])
    symbols, per_doc, rules = repair(np.concatenate(ids), counts, 50_260, 15_276)
    assert len(rules) < 15_276 and per_doc.sum() == len(symbols)
    owner, used = np.repeat(np.arange(len(counts)), per_doc), {}
    k = 0
    while k + 1 < len(symbols):  # plain count of what could still be replaced
        if owner[k] == owner[k + 1]:
            used.setdefault((symbols[k], symbols[k + 1]), []).append(k)
        k += 1
    for (a, b), at in used.items():
        n, last = 0, -2
        for x in at:
            if x != last + 1 or a != b:
                n, last = n + 1, x
        assert n < PAYS
    few = repair(np.concatenate(ids), counts, 50_260, 10)[2]
    assert len(few) == 10


def test_segments_of_the_table_are_small(spark):
    path = work_path(spark, "small")
    write_tokens(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), default_tokenizer(), path)
    n, size = spark.read.schema(SEGMENT_SCHEMA).parquet(path).selectExpr("sum(n_ids)", "sum(length(blob))").first()
    assert size < 0.6 * 2 * n


def test_lengths_round_trip():
    n = np.array([1, 2, 127, 128, 16_383, 16_384, 2**31, 5])
    raw = np.frombuffer(pack_lengths(n) + b"\x01\x80", np.uint8)
    got, used = unpack_lengths(raw, len(n))
    assert (got == n).all() and used == len(raw) - 2
    assert unpack_lengths(raw, 0)[1] == 0 and pack_lengths(n[:0]) == b""


def test_pieces_met_again_stay_when_room_is_made():
    e = Encoder(default_tokenizer(), keep=64)
    texts = [" ".join(["x", "often", "again", *(f"{chr(97 + i)}{chr(97 + k)}q" for k in range(8))]) for i in range(26)]
    for _ in range(2):
        for x, want in zip(texts, brute(texts)):
            ((_, ids, _),) = e.batch(pa.array([x], pa.string()))
            assert ids.tolist() + [2] == want
    known = {tuple(e.flat[a : a + n].tolist()) for a, n in zip(e.begin[: e.n_pieces], e.length[: e.n_pieces])}
    assert {tuple(Tokenizer.from_file(default_tokenizer()).encode(w).ids) for w in (" often", " again")} <= known and e.n_pieces <= 64


def test_letters_of_the_direct_way():
    e = Encoder(default_tokenizer())
    for code in [*range(0x21, 0x2FF), 0x4E2D, 0x1F600]:
        raw = np.frombuffer(chr(code).encode(), np.uint8)
        assert e.latin(raw).all() == (chr(code).isalpha() and code < 0x250), hex(code)


def test_a_worker_does_not_grow_with_its_tasks():
    def held():
        pa.default_memory_pool().release_unused()
        ctypes.CDLL(None).malloc_trim(0)
        return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024

    rng = np.random.default_rng(0)

    def task():
        e = Encoder(default_tokenizer(), keep=1 << 16)
        texts = [" ".join("".join(map(chr, rng.integers(97, 123, k))) for k in rng.integers(2, 12, 2000)) for _ in range(10)]
        assert sum(len(ids) for _, ids, _ in e.batch(pa.array(texts))) > 0

    for _ in range(2):
        task()
    before = held()
    for _ in range(10):
        task()
    assert held() - before < 15


def test_a_tokenizer_written_anew_is_read_anew(tmp_path):
    path = tmp_path / "t.json"
    for words in (["a", "b"], ["a", "b", "c"]):
        Tokenizer(models.WordLevel({w: i for i, w in enumerate(words)}, unk_token="a")).save(str(path))
        assert loaded(str(path)).get_vocab_size() == len(words)
    assert loaded(str(path)) is loaded(str(path))
