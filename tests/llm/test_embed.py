import math

import numpy as np

from fieldloom.llm import embed


def brute(rows):
    """(id, n_links, component) by row for (id, vector) rows; rows link whatever their ids."""
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, float)
        x = x / np.abs(x).max()
        return x / np.linalg.norm(x)

    units = [unit(v) for _, v in rows]
    near = [[k != j and a is not None and b is not None and len(a) == len(b) and a @ b >= 0.95 for j, b in enumerate(units)] for k, a in enumerate(units)]
    group = list(range(len(rows)))
    for k, linked in enumerate(near):
        for j in np.flatnonzero(linked):
            if group[j] != group[k]:
                old = group[j]
                group = [group[k] if g == old else g for g in group]
    least = {g: min((i for (i, _), h in zip(rows, group, strict=True) if h == g and i is not None), default=None) for g in set(group)}
    return [(i, int(sum(n)), least[g]) for (i, _), n, g in zip(rows, near, group, strict=True)]


def test_query_has_the_links_of_brute_force(spark, root):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{root}/embeddings.parquet").collect()]
    want = sorted(brute(rows))
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embed.op7_embedding_near_dedup(spark, root).collect())
    assert len(got) == len(want) and all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(g[1] for g in got) >= 0.98 * sum(w[1] for w in want)


def test_threshold_pairs_and_large_cells(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((150, 16))
    center = rng.standard_normal(16)
    vectors = [*base, *(base[:60] + 0.05 * rng.standard_normal((60, 16))), *(center + 0.08 * rng.standard_normal((90, 16)))]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, row int, cells int")
    want = sorted(brute(rows))
    for block in (7, 512):
        got = sorted((r.vec_id, r.n_links, r.component_id) for r in embed.near_duplicates(df, block=block).collect())
        assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
        assert sum(g[1] for g in got) >= 0.97 * sum(w[1] for w in want)


def test_recall_holds_for_vectors_outside_the_sample():
    rng = np.random.default_rng(6)

    def units(n):
        v = rng.standard_normal((n, 64))
        return v / np.linalg.norm(v, axis=1, keepdims=True)

    total = 4_000_000
    index = embed.Index(units(embed.sample_size(total)), total, 0.95)
    assert len(index.left) == 500
    some = units(400)
    turn = units(400)
    turn -= (turn * some).sum(1, keepdims=True) * some
    others = 0.95 * some + (1 - 0.95 ** 2) ** 0.5 * turn / np.linalg.norm(turn, axis=1, keepdims=True)
    found = [b[0] in a or a[0] in b for a, b in zip(index.cells(some), index.cells(others), strict=True)]
    assert np.mean(found) >= 0.98


def test_odd_vectors(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1e-30, 2e-30]), (8, [1e30, 2e30]),
            (9, [1.0, 2.0, 0.0]), (10, [1.0, 2.0, 0.0]), (None, [1.0, 2.0]), (11, [-1.0, -2.0]), (12, [5.0]), (13, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed.near_duplicates(df).collect()}
    assert got == {**{i: (0, i, True) for i in (1, 2, 3, 4, 5, 6, 11)}, 7: (2, 7, True), 8: (2, 7, False), 9: (1, 9, True), 10: (1, 9, False),
                   12: (1, 12, True), 13: (1, 12, False), None: (2, 7, False)}
    assert embed.near_duplicates(df.limit(0)).count() == 0


def results(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in embed.near_duplicates(df, **options).collect()), key=str)


def test_rows_link_whatever_their_ids(spark):
    v, w, near = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [1.0, 0.2, 0.0, 0.0]
    rows = [(1, v), (1, w), (2, v), (3, v), (None, v)]
    assert results(spark, rows) == sorted([(1, 3, 1), (1, 0, 1), (2, 3, 1), (3, 3, 1), (None, 3, 1)], key=str)
    # only a row without an id joins the two; a component of such rows alone has no id
    bridge = [(9, [1.0, 0.0]), (4, [0.9, 0.5]), (None, [0.97, 0.25]), (None, [0.0, 1.0]), (None, [-0.0, 1.0])]
    assert results(spark, bridge) == sorted(brute(bridge), key=str)
    assert {i for i, _, c in results(spark, bridge) if c == 4} == {4, 9, None}
    assert results(spark, [(1, v), (1, near), (None, w)]) == sorted([(1, 1, 1), (1, 1, 1), (None, 0, None)], key=str)


def test_a_third_of_equal_vectors_is_one_class(spark):
    rng = np.random.default_rng(9)
    hot = rng.standard_normal(8)
    rows = [(i, [float(x) for x in hot]) for i in range(3_000)] + [(9_000 + i, [float(x) for x in hot + 0.02 * rng.standard_normal(8)]) for i in range(5)]
    others = [(20_000 + i, [float(x) for x in rng.standard_normal(8)]) for i in range(40)]
    pair = brute([rows[0], *rows[3_000:], *others])
    linked = {i: n for i, n, _ in pair}
    assert linked[0] == 5 and all(linked[i] >= 5 for i, _ in rows[3_000:])
    got = {i: (n, c) for i, n, c in results(spark, rows + others)}
    assert {got[i] for i in range(3_000)} == {(3_004, 0)}
    assert all(got[i] == (2_999 + linked[i], 0) for i, _ in rows[3_000:])
