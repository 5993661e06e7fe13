import zlib

from fieldloom.llm import langid

SCHEMA = "doc_id long, text string, lang string, score string, lang_pred int"


def test_held_out_accuracy(spark, root):
    root = root.replace("sf0.001", "sf0.01")
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "lang").collect()}
    rows = langid.op2_language_id(spark, root).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)


def test_odd_rows(spark):
    rows = [(i, t, g, "s", 1) for i, (t, g) in enumerate([("the and of this", "en"), ("der die und das", "de")] * 20)]
    rows += [(100, None, "en", None, None), (101, "", None, None, None), (102, "12 34 !!", "en", None, None), (103, "und das", None, None, None),
             (104, "the of " * 20000, None, None, None), (None, "the", "en", None, None), (103, "und das", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = langid.train(df)
    got = langid.predict(df, model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert {by[i].lang_pred for i in (100, 101, 102)} == {"und"} and {by[i].score for i in (100, 101, 102)} == {0.0}
    assert by[103].lang_pred == "de" and by[104].lang_pred == "en" and by[None].lang_pred == "en"
    assert langid.predict(df.limit(0), model).count() == 0
    kept = langid.keep_known(spark, df, "")
    assert kept.columns == df.columns and {100, 101, 102}.isdisjoint({r.doc_id for r in kept.collect()})
    assert kept.count() == len(rows) - 3


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "abc", None, None, None)], SCHEMA)
    assert [(r.lang_pred, r.score) for r in langid.predict(df, langid.train(df)).collect()] == [("und", 0.0)]


def test_bounded_sample_is_about_as_large_as_asked(spark, root):
    docs = spark.read.parquet(f"{root.replace('sf0.001', 'sf0.01')}/documents.parquet")
    assert langid.predict(docs, langid.train(docs, rows=40)).where("lang_pred = 'und'").count() == 0
