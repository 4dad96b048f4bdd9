import corpus_pipeline as p
from ledgerlark.llm.lang_id import fit_profiles, fold, predict

from .test_decontaminate import brute as brute_hits
from . import test_ngram_join
from .test_ngram_join import brute as brute_groups
from .test_token_output import brute as brute_ids


def test_each_stage_against_brute_force(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(p.STAGES):
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        out = stage(spark, docs, d)
        out.write.parquet(path := str(tmp_path / name))
        out = spark.read.parquet(path)
        if k < 4:
            assert out.columns == columns
        left = {r.doc_id for r in out.select("doc_id").collect()}
        assert len(left) == out.count() and left
        if k == 0:
            model = fit_profiles(docs.where(fold() != 2))
            lang, _, _ = predict([t for _, t in before], model)
            assert left == {i for (i, _), x in zip(before, lang) if x != "und"}
        elif k == 1:
            assert left == {i for i, _, c in brute_groups(before) if i == c} and len(left) < len(before)
        elif k == 2:
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
            assert left == {r[0] for r in brute_hits(before, items) if not r[5]} and len(left) < len(before)
        elif k == 3:
            assert left < {i for i, _ in before} and len(left) > 0.6 * len(before)
        else:
            got, at = {r.doc_id: r for r in out.collect()}, 0
            for (i, _), ids in zip(sorted(before), brute_ids([t for _, t in sorted(before)])):
                assert (got[i].start, got[i].n_tokens) == (at, len(ids))
                at += len(ids)
        docs = out


def test_odd_rows_pass_through_all_stages(spark):
    text = "one two three four five six seven eight nine ten eleven"
    rows = [(None, text, "en", None, 1), (3, text, "en", "a", 1), (3, text, "en", "a", 1), (None, "other words stand here and stay", None, "a", 1), (None, "other words stand here and stay", None, "a", 1), (5, None, None, None, None), (6, "", "en", "b", 0), (7, "12 34", "en", "b", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    d = "/root/testdata/sf0.001"
    kept = p.identify_language(spark, docs, d)
    assert {(r.doc_id, r.text) for r in kept.collect()} == {(r[0], r[1]) for r in rows[:5]}
    kept = p.join_near_duplicates(spark, kept, d)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(3, text), (None, rows[3][1])], key=str)
    assert p.drop_contaminated(spark, kept, d).count() == 2
    p.mix_sources(spark, kept, d).collect()
    empty = docs.limit(0)
    for name, stage in p.STAGES:
        assert stage(spark, empty, d).count() == 0, name
    assert p.identify_language(spark, docs.selectExpr("doc_id", "text", "cast(null as string) as lang"), d).count() == 5


def test_near_copies_share_four_fifths_of_five_word_shingles(spark, monkeypatch):
    def text(k, *changed):
        return " ".join(f"x{k}w{i}" if i in changed else f"d{k}w{i}" for i in range(100))

    rows = [(1, text(1)), (2, text(1, 30, 60)), (3, text(2)), (4, text(2, 20, 50, 80)), (5, text(3)), (6, text(3, 40)), (7, text(4)), (8, text(4))]
    d = "/root/testdata/sf0.01"
    rows += [(r.doc_id + 100, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    kept = {r.doc_id for r in p.join_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), d).collect()}
    assert kept & set(range(9)) == {1, 3, 4, 5, 7}  # 86 of 106 shingles are enough, 81 of 111 aren't
    own = test_ngram_join.shingles
    monkeypatch.setattr(test_ngram_join, "shingles", lambda t: own(t, 5))
    assert kept == {i for i, _, c in brute_groups(rows, 80) if i == c}


def test_rows_of_one_id_with_different_texts_stay(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    docs = spark.createDataFrame([(3, a, 1), (3, b, 2), (3, b, 2), (4, a, 3), (5, " ".join(f"c{i}" for i in range(30)) + " x" * 200_000, 4)], "doc_id long, text string, component_id int")
    kept = p.join_near_duplicates(spark, docs, "").collect()
    assert sorted((r.doc_id, r.text[:2], r.component_id) for r in kept) == [(3, "a0", 1), (3, "b0", 2), (5, "c0", 4)]


def test_each_row_of_an_id_has_its_own_fate(spark):
    """Whether the smaller or the larger id holds two texts, what goes is the copy, and no text of its own is lost."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    for rows, want in (
            ([(3, a), (4, a), (4, b)], [(3, a), (4, b)]), ([(4, b), (4, a), (3, a)], [(3, a), (4, b)]), ([(3, a), (3, b), (4, b)], [(3, a), (3, b)]),
            ([(4, a), (4, b), (3, b), (5, a), (5, c)], [(3, b), (4, a), (5, c)]), ([(None, a), (4, a), (None, b), (None, b)], [(4, a), (None, b)]), ([(7, ""), (7, None), (7, "")], [(7, ""), (7, None), (7, "")])):
        kept = p.join_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
        assert sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)


def test_mixing_stage_learns_topics_from_every_document(spark):
    """One document with words of its own, among more than a sample would hold and by its hash in the last half: it is a topic, so
    it is drawn with the probability of a rare topic, .9, and not with its neighbours' of about .8."""
    text, between = "engine piston clutch gearbox exhaust", "pmod(xxhash64(5, id), 4503599627370496L) / 4503599627370496 between 0.82 and 0.89"
    odd = spark.range(45_000).where(f"{between} and pmod(xxhash64(17, id, '{text}'), 1024) > 512").agg({"id": "min"}).first()[0]
    docs = spark.range(45_000).selectExpr("id AS doc_id", f"if(id = {odd}, '{text}', concat('garden flower meadow people during ', if(id % 2 = 0, 'blossom', 'petals'))) AS text", "'en' AS lang", "'s' AS source")
    kept = {r.doc_id for r in p.mix_sources(spark, docs, "").select("doc_id").collect()}
    assert kept & {r.id for r in spark.range(45_000).where(between).collect()} == {odd}
