import zlib

from ledgerlark.llm.lang_id import fit_profiles, identify, language_id, op1_language_id


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op1_language_id(spark, d).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "en"), (2, "", "en"), (3, "12 !? 34", None), (None, "the cat and the dog of the house", "en"), (4, "le chat et la maison de la rue", "fr"),
         (5, "the house of the dog and the cat", "en"), (5, "the house of the dog and the cat", "en"), (6, "x" * 200_000, None)], "doc_id long, text string, lang string").selectExpr("*", "1 as score", "'a' as lang_pred")
    model = fit_profiles(docs)
    got = identify(docs, model).orderBy("doc_id").collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 8 and by[1].lang_pred == by[2].lang_pred == by[3].lang_pred == "und" and by[3].score == 0
    assert by[4].lang_pred == "fr" and by[5].lang_pred == "en" and by[6].text == "x" * 200_000
    assert language_id(docs.drop("score", "lang_pred")).where("doc_id is null").first().held_out is False


def test_empty_table_and_no_labels(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language_id(docs).count() == 0
    one = spark.createDataFrame([(1, "words", None)], docs.schema)
    assert language_id(one).first().lang_pred == "und"
