import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.llm import mining
from tests.oracle import connect, differences


def brute(rows, positives=5, negatives=3, scale=256):
    """Result rows for (id, label, vector) rows; anchors have an id divisible by 50."""
    fine = [(i, lab, tuple(math.floor(scale * x) for x in v)) for i, lab, v in rows if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, (i, lab, v) in enumerate(fine):
        if i is None or i % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j is None, j or 0, n, m) for n, (j, m, w) in enumerate(fine) if n != k and len(w) == len(v)]
        near = sorted(s for s in scored if s[4] == lab)[:positives]
        for p, pn, pid, *_ in near:
            hard = sorted(s for s in scored if s[4] != lab and 50 * -p <= 100 * -s[0] <= 95 * -p)[:negatives]
            out += [(i, None if pn else pid, r, None if nn else nid, -p, -n) for r, (n, nn, nid, *_) in enumerate(hard, 1)]
    return sorted(out, key=str)


def mined(df, **options):
    return sorted((tuple(r) for r in mining.hard_negatives(df, F.col("vec_id") % 50 == 0, F.col("label"), **options).collect()), key=str)


def test_query_matches_its_sql(spark, root):
    assert differences(mining.op11_hard_negatives(spark, root), connect(root), mining.ORACLES["op11_hard_negatives"]) == []


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (5, 2), (4, 1)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = mining.hilbert_keys(cells, bits)
    assert len(set(keys)) == len(cells)
    walk = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_for_all_rows_of_a_block():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    x, blocks = rng.integers(-300, 300, (20, 6)).astype(float), rng.integers(-300, 300, (4, 9, 6)).astype(float)
    maps = pa.table({"block": np.arange(4), "label": ["a"] * 4, "lo": [b.min(0).tobytes() for b in blocks], "hi": [b.max(0).tobytes() for b in blocks]})
    least, greatest = mining.Zones(maps, 6).bounds(x)
    products = np.einsum("ad,bnd->abn", x, blocks)
    assert (products.min(2) >= least).all() and (products.max(2) <= greatest).all()


def clustered(n, rng, labels=4, dims=8):
    centers = rng.standard_normal((labels * 3, dims))
    which = rng.integers(0, len(centers), n)
    return [(int(k), int(w % labels), [float(x) for x in 0.3 * centers[w] + 0.05 * rng.standard_normal(dims)]) for k, w in zip(range(n), which, strict=True)]


def test_clustered_rows_match_brute_force_and_blocks_are_skipped(spark):
    rows = clustered(1500, np.random.default_rng(4))
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<float>, block int, pack string").repartition(5)
    rounded = [(i, lab, [float(np.float32(x)) for x in v]) for i, lab, v in rows]
    want = brute(rounded)
    for options in ({"block": 16, "pack": 4}, {"block": 64, "pack": 3, "zone_bytes": 2000, "seeds": 1}):
        assert mined(df, **options) == want
    keyed = df.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").alias("id"), F.col("label").cast("string").alias("label"), (F.col("vec_id") % 50 == 0).alias("anchor"), F.col("embedding").cast("array<double>").alias("v"))
    index = mining.Index(keyed, 8, 256, block=16, pack=4)
    windows = index.packs.select(F.col("block").alias("pack"), F.lit(0).alias("idx"), F.lit(0).alias("w"), F.lit(30_000).cast("long").alias("lo"), F.lit(30_000).cast("long").alias("reached"), F.lit(mining.ALL).cast("long").alias("hi"))
    asked = sum(index._asked(windows, True, first).agg(F.sum(F.length("blocks") / 8)).first()[0] for first in (False, True))
    assert asked < 0.5 * index.packs.count() * index.total / 4


def test_ties_repeated_rows_and_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    same = [(50 * k, 1, [1.0, 2.0]) for k in range(1, 4)] + [(7, 1, [1.0, 2.0])] * 40
    rows = same + [(k, 2, [1.0, 1.5]) for k in (9, 3, 3, 12)] * 12 + [(None, 2, [1.0, 1.5]), (None, 1, [1.0, 2.0]), (100, 2, None), (100, None, [1.0, 2.0]), (100, 2, [1.0, None]), (100, 2, [nan, 1.0]), (100, 2, [inf, 1.0])]
    rows += [(200, 3, [0.0, 0.0]), (201, 3, [0.0, 0.0]), (250, 4, [-1.0, -2.0]), (251, 4, [1.0, 2.0]), (300, 5, [1.0]), (301, 5, [2.0]), (302, 6, [1.7]), (350, 7, []), (351, 7, []), (352, 8, []), (400, 9, [1.0, 1.0, 1.0]), (450, 1, [1e6, 1e6]), (451, 2, [7e5, 7e5])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(3)
    want = brute(rows)
    assert len({r[0] for r in want}) > 5
    for options in ({"block": 4, "pack": 2}, {}):
        assert mined(df, **options) == want
    assert mined(df.limit(0)) == [] and mined(df.where("vec_id is null")) == []
