import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fieldloom.llm import phrases
from tests.oracle import connect, differences


def brute(rows, threshold, top=2000, longest=5):
    """(lang, rank, phrase, a, l, r, n, score) by plain counting."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    cand = {g: a for g, a in f.items() if len(g) > 2 and a >= threshold}
    inside = set()
    for g, a in cand.items():
        for k in range(2, len(g) - 1):
            inside.update((g[0], *g[i:i + k]) for i in range(1, len(g) - k + 1) if a >= f[(g[0], *g[i:i + k])])
    out = {}
    for g, a in cand.items():
        if g not in inside:
            lang, *w = g
            score, cut = min((1000 * a * n[lang] // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[(lang, *w[:cut])], f[(lang, *w[cut:])]))
    return sorted((lang, r, p.decode(), -a, left, right, n[lang], -s) for lang, x in out.items() for r, (s, a, p, left, right) in enumerate(sorted(x)[:top], 1))


def test_query_matches_its_sql(spark, root):
    assert differences(phrases.op12_phrase_collocations(spark, root), connect(root), phrases.ORACLES["op12_phrase_collocations"]) == []


def odd_rows():
    rng = np.random.default_rng(3)
    words = ["a", "B", "new", "york", "city", "Ärger", "x" * 300, "日本"]
    rows = [(lang, " ".join(rng.choice(words, int(rng.integers(0, 40)), p=[.2, .1, .2, .2, .1, .1, .05, .05]))) for lang in ("en", "de", None) for _ in range(60)]
    rows += [("en", "New York city!New\tYork\vcity \x1f z ,, . " * 30)] * 5 + [("en", None), (None, ""), ("fr", " \t "), ("fr", "..."), ("", "a a a a a a a a a")]
    return rows + [("en", "a a a a a " * 2000)]


@pytest.mark.parametrize(("shards", "slot_bits", "block_bytes"), [(1, 20, 1 << 20), (3, 3, 500), (7, 1, 300)])
def test_matches_brute_force_whatever_the_shards_and_the_map(spark, shards, slot_bits, block_bytes):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, k int, phrase string").repartition(4)
    for threshold, top in ((6, 2000), (25, 7))[:1 + (shards == 1)]:
        got = sorted(tuple(r) for r in phrases.collocations(df, threshold=threshold, top=top, shards=shards, slot_bits=slot_bits, block_bytes=block_bytes).collect())
        assert got == brute(rows, threshold, top)


def test_longer_phrases_start_after_their_parts_and_see_each_shard_once():
    """Steps of one block: words in the first cycle, pairs for one cycle from the step after both words got there."""
    words, codes = phrases.words_of(pa.array(["a b a b. c"]))
    hashes = phrases.word_hashes("en", words)
    since = np.zeros(1 << 20, np.uint8)
    lengths = [[k for k, *_ in phrases.counted(words, hashes, codes, since, step, 3, 5)] for step in range(4)]
    assert lengths == [[1], [1], [1], []]
    since[phrases.slots(hashes[:1], len(since))], since[phrases.slots(hashes[1:2], len(since))] = 1, 2
    got = {step: [(k, t.to_pylist(), n.tolist(), last.tolist()) for k, t, n, last in phrases.counted(words, hashes, codes, since, step, 3, 5)] for step in (3, 4, 5)}
    assert got == {3: [(2, ["a b", "b a"], [2, 1], [4, 4])], 4: [(2, ["a b", "b a"], [2, 1], [4, 4])], 5: []}


def test_equal_hashes_are_told_apart_by_words():
    codes = np.array([0, 1, 0, 2, 0, 1], np.int32)
    first, n = phrases.distinct(codes, np.array([0, 2, 4]), 2, np.zeros(3, np.uint64))
    assert sorted(zip(codes[first + 1].tolist(), n.tolist())) == [(1, 2), (2, 1)]


def test_products_beyond_64_bits_are_exact(spark):
    a, n, left, right = 10**13 + 7, 10**15 + 3, 10**13 + 9, 10**13 + 11
    got = spark.sql(f"select (cast(1000 as decimal(4,0)) * cast({a} as decimal(18,0)) * cast({n} as decimal(18,0))) div (cast({left} as decimal(18,0)) * cast({right} as decimal(18,0))) s").first().s
    assert got == 1000 * a * n // (left * right)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(spark.createDataFrame([("en", None)], "lang string, text string")).count() == 0
