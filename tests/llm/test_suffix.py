import hashlib
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldloom.llm import suffix

OUT = "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"


def brute(texts):
    """Rows for a list of (doc_id, bytes)."""
    seen = Counter(t[i:i + 200] for _, t in texts for i in range(len(t) - 199))
    rows = []
    for doc_id, t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - 199):
            if seen[t[i:i + 200]] > 1:
                gone[i + 1:i + 201] = True
        kept = bytes(b for b, g in zip(t, gone[1:-1]) if not g)
        rows.append((doc_id, len(t), int(gone.sum()), int((gone[1:] > gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(rows, key=str)


def got(df):
    return sorted((tuple(r[c] for c in OUT) for r in df.collect()), key=str)


def words(rng, n):
    return "".join(rng.choice("abcdefgh é") for _ in range(n))


def corpus():
    """Passages around the limit, shared left and right parts, chains, runs of one letter, hot lines with other surroundings."""
    rng = random.Random(4)
    hot, passage, other = words(rng, 230), words(rng, 400), words(rng, 260)
    texts = [None, "", "short", "a" * 199, "b" * 200, "b" * 200, "c" * 650, passage, passage, passage[:250] + words(rng, 50), words(rng, 90) + passage[100:]]
    texts += [words(rng, rng.randrange(120)) + hot[rng.randrange(20):] + words(rng, rng.randrange(200)) for _ in range(60)]
    for _ in range(80):
        a, b = sorted((rng.randrange(260), rng.randrange(260)))
        texts.append(words(rng, rng.randrange(40)) + other[a:b] + hot[:rng.randrange(230)] + passage[rng.randrange(200):][:rng.randrange(300)])
    return texts


def test_matches_brute_force(spark, monkeypatch):
    texts = corpus()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, doc int, seed string").repartition(5)
    want = brute([(i, (t or "").encode()) for i, t in enumerate(texts)])
    assert got(suffix.removals(df)) == want
    # every repeated seed hot: entries of single windows
    keys = suffix.keyed(df, "doc_id", "text").repartition(3)
    for options in ({"hot": 1}, {"hot": 20, "per_part": 15}, {"per_part": 5}):
        spans = {}
        for r in suffix.repeated_spans(keys, **options).collect():
            spans.setdefault(r.doc, set()).add((r.start, r.stop))
        for (doc_id, n, removed, runs, digest) in want:
            kept, found = suffix.kept_parts((texts[doc_id] or "").encode(), list(spans.get(doc_id, ())))
            assert (n - len(kept), found, hashlib.sha256(kept).hexdigest()) == (removed, runs, digest)


def test_query_matches_brute_force(spark, root):
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text").collect()
    assert got(suffix.op9_suffix_array_dedup(spark, root)) == brute([(r.doc_id, (r.text or "").encode()) for r in docs])


def test_passage_that_starts_a_text_on_its_anchor(spark):
    rng = random.Random(8)
    texts = []
    while len(texts) < 8:
        passage = "".join(rng.choice("abcdefgh ") for _ in range(200))
        place, near, far, _ = suffix.anchors(np.frombuffer(passage.encode(), np.uint8), np.array([200]))
        if (place[0], near[0], far[0]) == (0, 0, 0):
            texts += [passage, words(rng, 90) + passage + words(rng, 90)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute([(i, t.encode()) for i, t in enumerate(texts)])
    assert all(removed >= 200 for _, _, removed, _, _ in want)
    assert got(suffix.removals(df)) == want


def test_repeated_ids_null_ids_and_no_rows(spark):
    long, other = "x y z " * 60, "one two" * 50
    rows = [(1, long), (1, long), (None, other), (2, None), (1, other + "!"), (1, "tail")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(suffix.removals(df)) == brute([(i, (t or "").encode()) for i, t in rows])
    assert suffix.removals(df.limit(0)).count() == 0


def test_texts_without_an_id_whose_short_hashes_are_equal(spark):
    """Two texts with one 32-bit hash: the one repeats a passage of a third, the other has nothing that repeats."""
    passage = words(random.Random(3), 240)
    own = F.concat(F.sha2(F.col("id").cast("string"), 512), F.sha2((F.col("id") + 1).cast("string"), 512))
    text = F.concat(F.lpad(F.col("id").cast("string"), 7, "0"), F.when(F.col("id") % 2 == 0, F.lit(passage)).otherwise(own))
    made = spark.range(300_000).select("id", text.alias("text")).withColumn("h", F.hash("text", F.lit(1)))
    pair = made.groupBy("h").agg(F.max(F.when(F.col("id") % 2 == 0, F.col("text"))).alias("a"), F.max(F.when(F.col("id") % 2 == 1, F.col("text"))).alias("b")).where("a is not null and b is not null")
    a, b = pair.select("a", "b").first()
    for ids in ((None, None, 5), (7, 7, 7)):
        rows = list(zip(ids, (a, b, "third " + passage), strict=True))
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert got(suffix.removals(df)) == brute([(i, t.encode()) for i, t in rows])


def test_short_rows_first_do_not_decide_the_balance(spark):
    """Every part of the exchange has its share of the entries whatever rows come first."""
    rng = random.Random(6)
    passages = [words(rng, 300) for _ in range(120)]
    rows = ["short"] * 500 + [a + b for a, b in zip(passages, passages[1:] + passages[:1], strict=True)]
    for order in (rows, rows[::-1]):
        keys = suffix.keyed(spark.createDataFrame(list(enumerate(order)), "doc_id long, text string"), "doc_id", "text").collect()
        run = suffix.Run()
        for k in keys:
            place, near, far, _ = suffix.anchors(np.frombuffer(bytes(k.text), np.uint8), np.array([len(k.text)]))
            for p, x, y in zip(place.tolist(), near.tolist(), far.tolist(), strict=True):
                run.add(bytes(k.text), k.doc, k.mark, p << 17 | x << 9 | y << 1)
        sizes = [len(r["rest"][0]) for part in suffix._run_batches(run, 20) for r in [part.to_pydict()] if r["bucket"][0] is not None]
        assert len(sizes) == 20 and max(sizes) <= 3 * sum(sizes) / len(sizes)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=9).map(lambda b: bytes(x % 3 for x in b)), max_size=12), min_size=1, max_size=9))
def test_loser_tree_merges_runs(groups):
    runs = []
    for group in groups:
        run, last = [], b""
        for s in sorted(group):
            run.append((s, suffix.shared_prefix(last, s, 0)))
            last = s
        runs.append(run)
    last, out = b"", []
    for r, k, shared in suffix.merge(runs):
        now = runs[r][k][0]
        assert shared == suffix.shared_prefix(last, now, 0)
        out.append(now)
        last = now
    assert out == sorted(s for g in groups for s in g)
