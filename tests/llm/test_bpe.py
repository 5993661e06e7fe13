import hashlib
import random

import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldloom.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")
OURS = bpe.codec(PATH, P.PATTERN)
THEIRS = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def ids(text):
    return [int.from_bytes(b[i:i + 4], "little") for b in [OURS.encode(text)] for i in range(0, len(b), 4)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r\x0b\x0c\x1c\x1f\x85 　'stdlrvem.,!09aAbB"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_same_ids_as_the_library(text):
    assert ids(text) == THEIRS.encode_ordinary(text)
    assert OURS.decode(ids(text)) == text.encode()


def test_long_pieces_and_special_strings():
    random.seed(3)
    for text in ["a" * 3000, " " * 500 + "x", "ab" * 900 + " " + "".join(random.choices("abcdeé", k=2000)), "<|endoftext|> x", "don't we'll  go\n\n now "]:
        assert ids(text) == THEIRS.encode_ordinary(text)


def test_memo_is_bounded():
    small = bpe.ChunkEncoder(OURS._plain, 3)
    for text in ("a b c d e", "f g h i.", "a b c", "x\n\ny\nz b."):
        assert small(text) == OURS.encode(text)
    assert len(small.later) + len(small.later.older) < 12


def test_query_matches_the_library(spark, root):
    rows = {r.doc_id: r for r in bpe.op8_byte_bpe(spark, root).collect()}
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for d in docs:
        want = THEIRS.encode_ordinary(d.text or "")
        r = rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(want), hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_null_empty_repeated_and_no_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (None, "x y", 5), (3, "x y", 5), (3, "x y", 5)], "doc_id long, text string, ids int")
    rows = sorted((r.n_tokens, r.ids_sha256) for r in bpe.digests(df, PATH, P.PATTERN).collect())
    empty = hashlib.sha256(b"").hexdigest()
    assert rows[:2] == [(0, empty)] * 2 and len(set(rows[2:])) == 1 and rows[2][0] == 2
    assert bpe.digests(df.limit(0), PATH, P.PATTERN).count() == 0
    assert [list(r.ids) for r in bpe.encode_texts(df.where("doc_id = 3"), PATH, P.PATTERN).collect()] == [THEIRS.encode_ordinary("x y")] * 2
