import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fieldloom.llm import packing

PATH = P.path("byte_bpe_50k.json")


def check_plan(histogram, capacity, **options):
    runs, sequences = packing.plan(histogram, capacity, **options)
    held = defaultdict(list)
    for length, parts in runs.items():
        assert sum(p[1] for p in parts) == histogram[length]
        for _, number, sequence, offset in parts:
            for i in range(number):
                held[sequence + i].append((offset, length))
    assert len(held) == sequences
    for places in held.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return sequences


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), max_size=20), st.integers(1, 9), st.integers(2, 20))
def test_every_plan_is_gapless_and_whole(histogram, groups, large):
    check_plan(histogram, 30, groups=groups, large=large)


def test_plan_is_close_to_the_least_number():
    rng = np.random.default_rng(1)
    histogram = dict(Counter(rng.integers(1, 2049, 20_000).tolist()))
    least = -(-sum(n * c for n, c in histogram.items()) // 2048)
    assert check_plan(histogram, 2048) <= 1.01 * least
    assert check_plan({700: 1000}, 2048) == 500 and check_plan({}, 2048) == 0 and check_plan({1: 5000}, 2048) == 3


def check_rows(rows, texts):
    tokenizer = Tokenizer.from_file(PATH)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc_id, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for i, r in enumerate(sorted(by_doc[doc_id], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (i, at) and (i == 0 or r.length == 2048)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048


def test_query(spark, root):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text").collect()}
    rows = packing.op10_best_fit_packing(spark, root).collect()
    check_rows(rows, texts)
    assert len({r.sequence_id for r in rows}) <= 1.02 * -(-sum(r.length for r in rows) // 2048) + 1


@pytest.mark.parametrize("n", [2047, 2048, 2049, 4096])
def test_cuts_null_empty_and_clashing_columns(spark, n):
    texts = {1: None, 2: "", 3: " a" * (n - 1), 4: "<|endoftext|>  b\n\n c", 5: "a <|endoftext|> b", 6: "a <|endoftext | x"}
    df = spark.createDataFrame([(i, t, 7, 1) for i, t in texts.items()], "doc_id long, text string, length int, part int")
    check_rows(packing.pack(df, PATH).collect(), texts)
    assert packing.pack(df.limit(0), PATH).count() == 0
    twice = packing.pack(df.union(df), PATH).collect()
    assert len(twice) == 2 * packing.pack(df, PATH).count()


def test_special_tokens_and_other_files():
    import json

    encode = packing._encoder(PATH)
    assert np.frombuffer(encode("a <|endoftext|> b"), "<u4").tolist() == [64, 220, 50256, 275]
    stated = json.load(open(PATH))
    assert len(packing.byte_level_ranks(stated)) == 50_256
    assert packing.byte_level_ranks(stated | {"normalizer": {"type": "Lowercase"}}) is None
    model = stated["model"]
    assert packing.byte_level_ranks(stated | {"model": model | {"merges": model["merges"][1:]}}) is None
    swapped = [model["merges"][1], model["merges"][0], *model["merges"][2:]]
    assert packing.byte_level_ranks(stated | {"model": model | {"merges": swapped}}) is None
    path = P.path("word_bpe_49k.json")
    other = packing.TextEncoder(path)
    assert other.chunks is None and np.frombuffer(other("Ab  c"), "<u4").tolist() == Tokenizer.from_file(path).encode("Ab  c", add_special_tokens=False).ids
