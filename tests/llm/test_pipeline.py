"""The pipeline against brute-force versions of its stages, each on what the stage before kept."""

import public_tokenizers
import tiktoken

import corpus_pipeline
from fieldloom.llm import bpe, langid, pii
from tests.llm.test_packing import check_rows
from tests.llm.test_pii import plain
from tests.llm.test_simhash import brute as similar
from tests.llm.test_suffix import brute as repeats
from __spark_entry__ import queries


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_match_brute_force(spark, root):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "simhash_near_dedup", "suffix_array_dedup", "personal_data", "best_fit_packing"]
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns, before = docs.columns, rows_of(docs)

    known = stages["language_id"](spark, docs, root)
    predicted = rows_of(langid.predict(docs, langid.learned(docs)))
    first = rows_of(known)
    assert set(first) == {i for i, r in predicted.items() if r.lang_pred != "und" and r.score >= langid.REJECT_BELOW}
    assert len(first) >= 0.98 * len(before)

    distinct = stages["simhash_near_dedup"](spark, known, root)
    second = rows_of(distinct)
    _, label = similar([(i, r.text) for i, r in first.items()])
    assert set(second) == set(label.values())

    cut = stages["suffix_array_dedup"](spark, distinct, root)
    third = rows_of(cut)
    want = {i: n - gone for i, n, gone, _, _ in repeats([(i, (r.text or "").encode()) for i, r in second.items()])}
    assert set(third) == set(second)
    assert all(0 <= want[i] - len(r.text.encode()) <= 6 and r.n_chars == len(r.text) for i, r in third.items())

    masked = stages["personal_data"](spark, cut, root)
    fourth = rows_of(masked)
    assert set(fourth) == set(third) and masked.columns == cut.columns == distinct.columns == known.columns == columns
    assert not any(plain(r.text) for r in fourth.values())
    assert all(r.text == third[i].text for i, r in fourth.items() if not pii.windows(third[i].text))

    check_rows(stages["best_fit_packing"](spark, masked, root).collect(), {i: r.text for i, r in fourth.items()})


def test_registered_pipeline_gives_all_pieces(spark, root):
    assert queries()["pipeline"] is corpus_pipeline.run
    rows = corpus_pipeline.run(spark, root).collect()
    assert rows and set(rows[0].asDict()) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows)


def test_stages_take_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, doc string, spans int"
    rows = [(1, None, None, None, None, "x", 1), (2, "", "en", "s", 0, None, None), (3, "the and of it", "en", "s", 13, "x", 1), (3, "the and of it", "en", "s", 13, "x", 1), (None, "words here", None, None, 10, "y", 2)]
    for df in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, "")
            assert out.columns == df.columns, name
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, df, "").collect()


def test_tokenizers_agree():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    assert encoding.encode_ordinary("a b") == [64, 275]
