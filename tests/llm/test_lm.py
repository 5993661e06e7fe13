import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from fieldloom.llm import lm
from fieldloom.storage import shared_root

END = "<end>"


def words(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")), END]


def plain_model(train, share):
    """Log10 probability of a token list, straight from the definition with dictionaries of n-grams."""
    grams = [Counter(), Counter(), Counter()]
    for text in train:
        t = words(text)
        for k in range(3):
            grams[k].update(zip(*(t[i:] for i in range(k + 1)), strict=False))
    n, v = sum(grams[0].values()), len(grams[0])
    least = max(1.0, share * n)
    kept = [{g: c for g, c in table.items() if c >= least} for table in grams]
    follow = defaultdict(dict)
    for table in kept[1:]:
        for g, c in table.items():
            follow[g[:-1]][g[-1]] = c

    def chance(w, h):
        if not h:
            return (grams[0].get((w,), 0) + 1) / (n + v + 1)
        if h not in follow:
            return chance(w, h[1:])
        total = kept[len(h) - 1][h]
        seen = follow[h]
        if w in seen:
            return (seen[w] - 0.5) / total
        rest = (1 - sum(c - 0.5 for c in seen.values()) / total) / (1 - sum(chance(x, h[1:]) for x in seen))
        return rest * chance(w, h[1:])

    def score(text):
        t = words(text)
        return sum(math.log10(chance(w, tuple(t[max(0, i - 2):i]))) for i, w in enumerate(t))

    return grams[0], n, v, chance, score


def check(rows, texts, held, share):
    counts, n, v, _, score = plain_model([t for i, t in texts if not held(i)], share)
    assert len(rows) == len(texts)
    got = sorted(rows, key=lambda r: r.doc_id)
    for r, (i, text) in zip(got, sorted(texts, key=lambda x: x[0]), strict=True):
        t = words(text)
        base = sum(math.log10((counts.get((w,), 0) + 1) / (n + v + 1)) for w in t)
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i, held(i), len(t), sum((w,) in counts for w in t), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score(text), rel=1e-9)


def held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def test_query_matches_definition(spark, root):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text").collect()]
    check(lm.op3_lm_scoring(spark, root).collect(), texts, held, lm.SHARE)


@pytest.mark.parametrize("share", [0.0, 0.01, 0.2])
def test_small_corpora(spark, share):
    rng = np.random.default_rng(3)
    texts = [(i, " ".join(rng.choice(["A", "b", "c\t", "dé", "e"], rng.integers(0, 30)))) for i in range(60)]
    texts += [(100, None), (101, ""), (102, " \n"), (103, "unseen words A b"), (104, "a " * 5000)]
    df = spark.createDataFrame([(i, t, 3, "x") for i, t in texts], "doc_id long, text string, block int, bucket string")
    rows = lm.score(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, share=share, block_bytes=500).collect()
    check(rows, texts, held, share)


def test_probabilities_sum_to_one():
    train = ["a b c a b d", "b c a", "a b c d", "c c c"]
    counts, _, _, chance, _ = plain_model(train, 0.05)
    for h in [(), ("a",), ("a", "b"), ("b", "c"), ("c", "c"), ("zz",)]:
        assert sum(chance(w, h) for (w,) in counts) + chance("unseen", h) == pytest.approx(1)


def test_rare_grams_of_large_corpora_count(spark):
    """110,000 training tokens: by a share of 2e-5 what is seen twice would be left out."""
    rng = np.random.default_rng(4)
    texts = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 500) % 3000)) for i in range(250)] + [(900, "rare pair here"), (901, "rare pair here"), (903, "a rare pair here")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    rows = lm.score(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, block_bytes=100_000).collect()
    assert rows[0].train_tokens > 100_000
    check(rows, texts, held, 0.0)


def test_repeated_null_ids_and_nothing(spark):
    df = spark.createDataFrame([(1, "x y"), (1, "x y"), (None, "x"), (2, None)], "doc_id long, text string")
    rows = lm.score(df, F.lit(False)).collect()
    assert len(rows) == 4 and {r.train_tokens for r in rows} == {9}
    assert lm.score(df.limit(0), F.lit(False)).count() == 0
    alone = lm.score(df, F.lit(True)).collect()
    assert {r.n_known for r in alone} == {0} and all(r.base_score == r.score == 0 for r in alone)


class Hand:
    """Words a b c (places 0 to 2); pairs ab, bc, ca; of the triples abc alone is learned."""

    words, pairs, triples = np.array([4, 4, 2]), np.array([3, 2, 0]), np.array([2, 0])
    first, last = np.array([0, 1, 2]), np.array([1, 2, 0])
    head, tail = np.array([0, 1]), np.array([1, 2])


def test_a_traversal_takes_failure_arcs_until_a_state_goes_on():
    root, down, down2 = np.array([-1.0, -2.0, -3.0]), np.array([-10.0, -20.0, 0.0]), np.array([-100.0, 0.0, 0.0])
    automaton = lm.Automaton(Hand, 1.0, root, down, down2)
    ab, bc, abc = math.log10(2.5 / 4), math.log10(1.5 / 4), math.log10(1.5 / 3)
    assert automaton.score([0]) == -1 and automaton.score([]) == 0
    assert automaton.score([0, 1, 2]) == pytest.approx(-1 + ab + abc)
    assert automaton.score([1, 2]) == pytest.approx(-2 + bc)
    # after ab no a: to the state of b, then to the root; from there a has an arc for b
    assert automaton.score([0, 1, 0, 1]) == pytest.approx(-1 + ab - 100 - 20 - 1 + ab)
    # ca was never learned: c is no state, its failure arc is free
    assert automaton.score([0, 1, 2, 0]) == pytest.approx(-1 + ab + abc - 1)
    assert sorted(automaton.arcs) == sorted([1 * 3 + 1, 2 * 3 + 2, 4 * 3 + 2])


def test_numbers_and_sorted_rows_travel_whole():
    rng = np.random.default_rng(5)
    for x in ([], [0], [0, 0], [255, 256], [2**40, 1, 0], rng.integers(0, 2**62, 100)):
        assert lm.unpack(lm.pack(np.array(x, np.int64))).tolist() == list(x)
    for size in (0, 1, 500):
        rows = sorted(map(tuple, rng.integers(0, 6, (size, 3)).tolist()))
        columns = [np.array([r[k] for r in rows], np.int64) for k in range(3)]
        steps = lm.steps(columns)
        assert all((s >= 0).all() for s in steps) and [x.tolist() for x in lm.sorted_rows(steps)] == [x.tolist() for x in columns]


def test_words_split_at_ascii_blanks_only():
    texts = [b"not read", None, b"", b" A b\n\nC\xc3\x89 ", "x\x1cy\x85z\x0bq \x0c É Éİ".encode(), b"\t\r"]
    words, many = lm.words_of(pa.array(texts, pa.binary()).slice(1))
    want = [[w.encode() for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), (t or b"").decode())) if w] for t in texts[1:]]
    assert many.tolist() == [len(w) for w in want] and words.to_pylist() == [w for ws in want for w in ws]


def test_a_walk_in_stretches_is_the_walk(monkeypatch):
    root, down, down2 = np.array([-1.0, -2.0, -3.0]), np.array([-10.0, -20.0, 0.0]), np.array([-100.0, 0.0, 0.0])
    automaton = lm.Automaton(Hand, 1.0, root, down, down2)
    sizes = np.array([0, 1, 300, 2, 40])
    places = np.random.default_rng(6).integers(0, 3, sizes.sum())
    whole = automaton.walk(places, sizes)
    for stretch in (1, 2, 3, 7):
        monkeypatch.setattr(lm, "STRETCH", stretch)
        assert (automaton.walk(places, sizes) == whole).all()


def stored(folder):
    return sum(f.stat().st_size for f in Path(folder).rglob("*.parquet")) if Path(folder).exists() else 0


def test_what_is_exchanged_is_smaller_than_the_texts(spark):
    """All n-grams of 0.9 MB of texts go to their buckets and back; by 64-bit lists the tables took several times the texts."""
    rng = np.random.default_rng(7)
    texts = [(i, " ".join(f"word{int(x)}" for x in rng.zipf(1.2, 400) % 20000)) for i in range(300)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    folder = f"{shared_root(spark).removeprefix('file://')}/fieldloom"
    before = stored(folder)
    rows = lm.score(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, block_bytes=300_000).collect()
    taken, size = stored(folder) - before, sum(len(t) for _, t in texts)
    assert len(rows) == 300 and 0 < taken < size


def test_the_shuffles_of_a_write_end_with_it_and_the_setting_comes_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with pytest.raises(ValueError), lm._shuffles_end(spark):
        assert spark.conf.get(name) == "true"
        raise ValueError
    assert spark.conf.get(name) == before


def blocks_of(monkeypatch, task, *lists):
    """Blocks that a task makes of batches of texts, all of them learned."""
    monkeypatch.setattr(lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: task)))
    columns = [[pa.array(range(len(t)), pa.int64()), pa.array([False] * len(t)), pa.array(t, pa.binary())] for t in lists]
    return list(lm._blocks(1, 1000)(iter([pa.RecordBatch.from_arrays(c, names=["doc_id", "held_out", "text"]) for c in columns])))


def test_only_grams_that_other_blocks_may_have_are_asked_for(monkeypatch):
    blocks = [pa.Table.from_batches(blocks_of(monkeypatch, k, [f"a b c {w}".encode()])) for k, w in enumerate("xy")]
    asked = pa.concat_tables([pa.table({"block": b["block"], "bucket": pa.array([0]), "words": b["words"][0].as_py(), "counts": b["counts"][0].as_py()}) for b in blocks])
    replies = lm._answer(1)(asked)
    name = dict(zip(lm.unpack(replies["n"][1].as_py()).tolist(), lm._split(asked["words"][0].as_py()), strict=True))
    for kind, width, want in ((lm.PAIR, 2, {(b"a", b"b"), (b"b", b"c")}), (lm.TRIPLE, 3, {(b"a", b"b", b"c")})):
        asks = [lm._ask(1, kind)(b, replies.filter(pc.equal(replies["block"], b["block"][0]))) for b in blocks]
        columns = lm.sorted_rows([lm.unpack(asks[0][c][0].as_py()) for c in "uvw"[:width]])
        assert {tuple(name[x] for x in gram) for gram in zip(*(c.tolist() for c in columns), strict=True)} == want
        replies = pa.concat_tables([replies, lm._count(pa.concat_tables(asks))])
    assert replies["block"].null_count == 1 and replies["learned"][0].as_py() == 6


def test_empty_texts_fill_blocks_too(monkeypatch):
    assert [b["block"][0].as_py() for b in blocks_of(monkeypatch, 2, *[[None, b""] * 600] * 3)] == [2 << 32, (2 << 32) + 1, (2 << 32) + 2]
