import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.llm import bm25
from tests.oracle import connect, differences


def brute(rows, is_query, k):
    docs = [(i, Counter((t or "").lower().split())) for i, t in rows]
    average = sum(d.total() for _, d in docs) / len(docs)
    df = Counter(w for _, d in docs for w in d)
    out = {}
    for q, query in docs:
        if not is_query(q):
            continue
        found = []
        for i, d in docs:
            s = sum(c * math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * d[w] * 2.2 / (d[w] + 1.2 * (0.25 + 0.75 * d.total() / average)) for w, c in sorted(query.items()) if w in d)
            if s:
                found.append((-round(s, 9), i))
        out[q] = [(i, -s) for s, i in sorted(found)[:k]]
    return out


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_matches_oracle(spark, root, scale):
    root = root.replace("sf0.001", scale)
    assert differences(bm25.op4_bm25_top_k(spark, root), connect(root), bm25.ORACLES["op4_bm25_top_k"]) == []


def test_pruned_search_over_shards_and_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(bm25, "BLOCK", 4)
    monkeypatch.setattr(bm25, "FIRST_BLOCKS", 1)
    rng = np.random.default_rng(1)
    words = [f"w{int(x)}" for x in rng.zipf(1.3, 9000) if x < 2000]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 60)))) for i in range(300)]
    rows += [(300 + i, rows[i][1]) for i in range(40)] + [(400, None), (401, "")]
    df = spark.createDataFrame([(i, t, 1, 2.0) for i, t in rows], "doc_id long, text string, query_id int, score double")
    want = brute(rows, lambda i: i % 7 == 0, 5)
    got = {}
    for r in bm25.top_k(df, F.col("doc_id") % 7 == 0, k=5, shard_bytes=3000, query_bytes=2000).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.doc_id, r.score))
    assert set(got) == {q for q, found in want.items() if found}
    for q, found in got.items():
        assert [i for i, _ in found] == [i for i, _ in want[q]]
        assert [s for _, s in found] == pytest.approx([s for _, s in want[q]], abs=2e-6)


def test_odd_rows(spark):
    df = spark.createDataFrame([(0, "a b"), (0, "a b"), (None, "a b"), (1, "A"), (2, None), (100, None)], "doc_id long, text string")
    rows = bm25.top_k(df, F.col("doc_id") % 100 == 0).orderBy("rank").collect()
    assert [(r.query_id, r.doc_id) for r in rows] == [(0, 0)] * 4 + [(0, None)] * 2 + [(0, 1)] * 2
    assert bm25.top_k(df.limit(0), F.col("doc_id") % 100 == 0).count() == 0


def test_each_row_of_a_repeated_query_id_is_answered(spark):
    texts = [(100, "alpha beta"), (100, "gamma delta"), (1, "alpha"), (2, "delta gamma"), (3, "beta alpha"), (None, "gamma")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    rows = bm25.top_k(df, F.col("doc_id") % 100 == 0, query_bytes=5).collect()
    assert {r.query_id for r in rows} == {100}
    assert sorted((r.doc_id for r in rows), key=str) == sorted([100, 1, 3, 100, 2, None], key=str)
    assert sorted(r.rank for r in rows) == [1, 1, 2, 2, 3, 3]


def test_rows_of_a_search_grow_with_queries_not_with_shards(spark, monkeypatch):
    """A task merges its shards, so more shards make no more rows; all are searched, null ids and ties included."""
    made, write = {}, bm25.materialize
    monkeypatch.setattr(bm25, "materialize", lambda df, label: made.setdefault(label, write(df, label)))
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(f"w{int(x) % 40}" for x in rng.zipf(1.4, rng.integers(5, 40)))) for i in range(400)]
    rows += [(None, rows[0][1]), (1000, rows[0][1] + " only")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", property(lambda _: 1))
    got = bm25.top_k(df, F.col("doc_id") % 100 == 0, k=5, shard_bytes=1500).collect()
    assert made["index"].count() > 8
    queries = sum(i is not None and i % 100 == 0 for i, _ in rows)
    assert made["shard-best"].count() <= 2 * 5 * queries
    want = brute([(10**9 if i is None else i, t) for i, t in rows], lambda i: i % 100 == 0 and i < 10**9, 5)
    for q, found in want.items():
        mine = sorted((r.rank, r.doc_id, r.score) for r in got if r.query_id == q)
        assert [10**9 if i is None else i for _, i, _ in mine] == [i for i, _ in found]
        assert [s for *_, s in mine] == pytest.approx([s for _, s in found], abs=2e-6)


def _posted(rng, n, words):
    texts = [" ".join(f"w{int(x) % words}" for x in rng.zipf(1.3, rng.integers(5, 60))) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)]


def test_one_pass_over_the_index_serves_all_blocks_of_queries(spark, monkeypatch):
    passes, searches, count, search = [], [], bm25._frequencies, bm25._search
    monkeypatch.setattr(bm25, "_frequencies", lambda blob: (passes.append(1), count(blob))[1])
    monkeypatch.setattr(bm25, "_search", lambda *a: (searches.append(1), search(*a))[1])
    monkeypatch.setattr(bm25, "MERGED", 20, raising=False)
    rows = _posted(np.random.default_rng(3), 200, 90)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = bm25.top_k(df, F.col("doc_id") % 20 == 0, k=4, shard_bytes=2000, query_bytes=150).collect()
    assert len(searches) > 3 and len(passes) == 1
    want = brute(rows, lambda i: i % 20 == 0, 4)
    for q, found in want.items():
        assert [i for i, _ in found] == [r.doc_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q]


def _shard(rows, query):
    """A shard of the rows, and a block of that one query."""
    numbers = {w: i for i, w in enumerate(sorted(query))}
    batch = bm25.build_shard([i for i, _ in rows], [t.encode() for _, t in rows])
    row = {n: batch.column(n)[0].as_buffer() if n not in ("n", "words") else None for n in batch.schema.names}
    weights = np.array([6.0 if w == b"rare" else 1.0 for w in sorted(query)])
    return bm25.Shard(row, 20.0, numbers), (np.array([0, len(numbers)]), np.arange(len(numbers)), weights)


def test_bounds_are_asked_for_where_they_leave_postings_out(monkeypatch):
    monkeypatch.setattr(bm25, "BLOCK", 8)
    monkeypatch.setattr(bm25, "FIRST_BLOCKS", 2)
    rows = _posted(np.random.default_rng(4), 800, 400)
    rows += [(1000 + i, "rare " * 9 + f"v{i % 5}") for i in range(12)]
    summed, sums = [], bm25.Shard.summed
    monkeypatch.setattr(bm25.Shard, "summed", lambda self, start, stop, weights: (summed.append(int((stop - start).sum())), sums(self, start, stop, weights))[1])

    def search(query, least, bounded):
        shard, block = _shard(rows, query)
        summed.clear()
        left = np.array([bounded])
        (docs, scores), = shard.best(*block, 5, np.array([least]), left)
        order = np.lexsort((docs, -scores))[:5]
        return docs[order].tolist(), scores[order].tolist(), bool(left[0]), sum(summed), int(shard.first[-1])

    # few documents reach the bar: most postings stay unread, with or without one
    query = [b"rare", b"v1", *(f"w{i}".encode() for i in range(100, 110))]
    docs, scores, worth, read, all_of_them = search(query, 0.0, True)
    assert worth and read < all_of_them / 2
    assert search(query, 0.0, False)[:3] == (docs, scores, False)
    assert search(query, scores[-1], True)[:3] == (docs, scores, True) and sum(summed) < all_of_them / 2
    # a long query whose bounds bar nothing sums its lists, and does not ask for bounds in the next shard
    query = sorted({f"w{i}".encode() for i in range(20, 400)})
    docs, scores, worth, _, _ = search(query, 0.0, True)
    assert not worth and search(query, 0.0, False)[:2] == (docs, scores)


def test_wide_counts_and_many_documents_of_a_shard():
    texts = [b"a " * 70_000 + b"b", b"a b", b""] + [b"b c"] * 66_000
    batch = bm25.build_shard(list(range(len(texts))), texts)
    shard = bm25.Shard({n: batch.column(n)[0].as_buffer() if n not in ("n", "words") else None for n in batch.schema.names}, 2.0, {b"a": 0, b"c": 1, b"z": 2})
    assert shard.docs.tolist() == [0, 1, *range(3, 66_003)] and shard.counts[:3].tolist() == [70_000, 1, 1]
    assert len(bm25.build_shard([1], [b""]).column("docs")[0].as_py()) == 0


def test_shards_are_read_one_at_a_time_and_the_settings_come_back(spark):
    names = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"]
    before = [spark.conf.get(n) for n in names]
    with pytest.raises(ValueError), bm25._one_by_one(spark):
        assert [spark.conf.get(n) for n in names] == ["1", "1"]
        raise ValueError
    assert [spark.conf.get(n) for n in names] == before
