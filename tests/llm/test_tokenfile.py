import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import public_tokenizers
from fieldloom.llm import tokenfile
from fieldloom.storage import new_path

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(rows):
    """(doc_id, start, n_tokens, crc) in ascending order, each whole text through the library."""
    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_query_gives_the_ids_of_the_library(spark, root):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{root}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in tokenfile.op13_token_files(spark, root).collect())
    assert got == expected(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.text(), st.text(alphabet="aBcÀÖÿß×.,'s \t\ń Σ\u0085 <|>endoftx1!é")), min_size=1, max_size=6))
def test_words_give_the_ids_of_whole_texts(texts):
    import pyarrow as pa

    words, tokenizer = tokenfile.encoder_of(PATH), Tokenizer.from_file(PATH)
    texts = [t.encode("utf-8", "ignore").decode() for t in texts] + ["a<|endoftext|>b <|startoftext|>", "x ́y", "It'S He'LL d'eau. (ÀÉ)...x2 ½ª"]
    assert type(words) is tokenfile.Words
    ids, ends = words.encode(pa.array(texts))
    got = np.split(ids, ends[:-1])
    assert [g.tolist() for g in got] == [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def test_other_vocabularies_encode_whole_texts():
    import pyarrow as pa

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["two  blanks", None, " a\tb\n"]
    ids, ends = tokenfile.encoder_of(path).encode(pa.array(texts))
    want = Tokenizer.from_file(path)
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == [[*want.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=40), st.integers(0, 2**40), st.integers(0, 1500))
def test_monotone_sequences(values, step, many):
    seq = np.sort(np.array([*values, *(k * step % 2**64 for k in range(many))], np.uint64))
    code = tokenfile.encode_monotone(seq)
    read = tokenfile.Monotone(code)
    assert read.values().tolist() == seq.tolist()
    for k in {0, len(seq) // 2, len(seq) - 1} & set(range(len(seq))):
        assert read[k] == seq[k]
    assert read.values(len(seq) // 3, len(seq) // 2).tolist() == seq[len(seq) // 3:len(seq) // 2].tolist()


def test_boundaries_take_near_minimal_space():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 1000, 100_000))
    assert len(tokenfile.encode_monotone(ends)) * 8 / len(ends) < 2 + np.log2(ends[-1] / len(ends)) + 0.5


@pytest.mark.parametrize("shard_ids", [1, 7, 1 << 20])
def test_odd_documents(spark, shard_ids):
    long = "Wort  \n" * 30_000
    rows = [(5, "b a"), (5, "b a"), (5, "other"), (None, "none"), (None, None), (2, None), (3, ""), (4, " \t\n"), (-(2**63), "least"), (2**63 - 1, long), (9, "x" * 5000), (10, "café café")]
    df = spark.createDataFrame([(i, t, "n", 1, 2) for i, t in rows], "doc_id long, text string, part string, number int, tie int").repartition(3)
    path = new_path(spark, "tokens")
    tokenfile.write_tokens(df, PATH, path, shard_ids=shard_ids)
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in tokenfile.checksums(spark, path).collect())
    assert [r[0] for r in got] == np.cumsum([0, *(r[2] for r in got)])[:-1].tolist()
    assert [r[1] for r in got] == [i for i, *_ in expected(rows)]
    key = lambda r: (str(r[0]), r[1], r[2])                                                     # noqa: E731
    sums = sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in tokenfile.checksums(spark, path).collect()), key=key)
    assert sums == sorted(((i, n, crc) for i, _, n, crc in expected(rows)), key=key)
    back = {r.start: np.frombuffer(r.ids, "<u4") for r in tokenfile.read_tokens(spark, path).collect()}
    files = [tokenfile.Shard(r.content) for r in spark.read.format("binaryFile").load(path).collect() if r.length]
    assert len(files) == (len(rows) if shard_ids == 1 else len(files))
    for shard in files:
        for k in range(shard.documents):
            assert shard.tokens(k).tolist() == back[shard.first + int(shard.bounds(k, k + 1)[0])].tolist()


def test_no_documents_and_damaged_files(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    path = new_path(spark, "tokens")
    tokenfile.write_tokens(empty, PATH, path)
    assert tokenfile.checksums(spark, path).count() == 0
    with pytest.raises(ValueError):
        tokenfile.Shard(b"something else")
    whole = tokenfile.MAGIC + bytes(8) + tokenfile.shard_body(np.array([1, 2]), 0, np.array([1, 3]), np.array([5, 6, 7], "<u2"))
    assert tokenfile.Shard(whole).tokens(1).tolist() == [6, 7]
    with pytest.raises(ValueError):
        tokenfile.Shard(whole[:-2])
