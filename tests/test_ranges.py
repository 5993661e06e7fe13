"""Ranges as aligned blocks, lines of files with their numbers."""

import random

import pytest
from pyspark.sql import functions as F

from fieldloom.operators import ranges as R
from fieldloom.operators.ranking import with_running_total
from fieldloom.sources import speclines as S
from fieldloom.sources.textfiles import read_lines
from fieldloom.storage import new_path


def test_blocks_make_up_the_range_without_overlap(spark):
    rng = random.Random(3)
    pairs = [(a, a + rng.randrange(0, 200)) for a in (rng.randrange(-300, 300) for _ in range(80))] + [(0, 0), (-1, -1), (5, 4), (None, 3), (3, None), (-8, 7), (1, 1 << 40)]
    rows = spark.createDataFrame(pairs, "lo long, hi long").select("lo", "hi", R.aligned_blocks(F.col("lo"), F.col("hi")).alias("b")).collect()
    for r in rows:
        if r.lo is None or r.hi is None or r.hi < r.lo:
            assert not r.b
            continue
        spans = sorted((b.block << b.size, (b.block + 1 << b.size) - 1) for b in r.b)
        assert spans[0][0] == r.lo and spans[-1][1] == r.hi and all(x[1] + 1 == y[0] for x, y in zip(spans, spans[1:]))


def test_matches_brute_force_and_has_no_nested_loop(spark):
    rng = random.Random(5)
    ranges = [(rng.randrange(-2000, 2000), rng.choice([0, 1, 7, 500, 3000]), f"r{k}") for k in range(300)]
    numbers = [rng.randrange(-2500, 3500) for _ in range(400)] + [None]
    rs = spark.createDataFrame([(a, a + n, name) for a, n, name in ranges], "lo long, hi long, name string")
    ns = spark.createDataFrame([(x,) for x in numbers], "n long")
    found = R.match_ranges(ns, "n", rs)
    want = sorted((x, name) for x in numbers if x is not None for a, n, name in ranges if a <= x <= a + n)
    assert sorted((r.n, r.name) for r in found.collect()) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert R.match_ranges(ns, "n", rs.limit(0)).count() == 0


def test_a_million_ranges(spark):
    rs = spark.range(1_000_000).select((F.col("id") * 10).alias("lo"), (F.col("id") * 10 + F.col("id") % 25).alias("hi"), F.col("id").alias("priority"))
    ns = spark.range(0, 10_000_000, 997).select(F.col("id").alias("n"))
    found = R.match_ranges(ns, "n", rs)
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    got = {r.n: r.m for r in found.groupBy("n").agg(F.max("priority").alias("m")).collect()}
    for n in list(range(0, 10_000_000, 997))[::50]:
        hits = [k for k in range(max(0, n // 10 - 3), n // 10 + 1) if 10 * k <= n <= 10 * k + k % 25]
        assert got.get(n) == (max(hits) if hits else None)


def test_bounds_too_large_are_an_error(spark):
    rs = spark.createDataFrame([(0, 1 << 62)], "lo long, hi long")
    with pytest.raises(Exception, match="beyond"):
        R.match_ranges(spark.range(3), "id", rs).collect()


def test_categories_by_join_equal_the_conditional_expression(spark):
    codes = [str(n) for n in range(0, 9000, 7)] + ["01", "10", "3100-3105", "8003", "43", "x", "", "415", "3900", "3999", "4000", "710"]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(codes * 2)], "ord long, code string")
    both = S.categorize(rows, *S.category_table(spark), S.DEFAULT_CATEGORY).select("ord", "category", S.code_category(F.col("code")).alias("want")).collect()
    assert len(both) == len(codes) * 2 and all(r.category == r.want for r in both)


@pytest.fixture
def split_size(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}

    def use(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "0")

    yield use
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("size", [64, 1000, 1 << 27])
def test_lines_keep_their_numbers_whatever_the_splits(spark, split_size, size):
    split_size(size)
    path = new_path(spark, "texts")
    spark.range(0, 500, 1, 1).select(F.concat(F.lit("a"), F.col("id").cast("string"), F.repeat(F.lit("x"), (F.col("id") % 40).cast("int"))).alias("value")).write.text(f"{path}/a")
    spark.range(0, 90, 1, 1).select(F.when(F.col("id") % 3 == 0, "").otherwise(F.concat(F.lit("é"), F.col("id").cast("string"))).alias("value")).write.option("compression", "gzip").text(f"{path}/b/c")
    spark.range(0, 50, 1, 1).select(F.when(F.col("id") == 41, F.unhex(F.lit("41FF")).cast("string")).otherwise(F.lit("good")).alias("value")).write.text(f"{path}/bad")
    spark.range(0).select(F.lit("x").alias("value")).write.text(f"{path}/empty")
    lines, rejects = read_lines(spark, path)
    got = sorted((r.ord, r.line_no, r.line) for r in lines.collect())
    want = [f"a{i}{'x' * (i % 40)}" for i in range(500)] + ["" if i % 3 == 0 else f"é{i}" for i in range(90)]
    assert [g[2] for g in got] == want and [g[0] for g in got] == list(range(1, 591)) and [g[1] for g in got] == [*range(1, 501), *range(1, 91)]
    bad = {(r.file.split("/")[-2], r.reason, r.lines, r.first_bad) for r in rejects.collect()}
    assert ("bad", "not UTF-8", 50, 42) in bad and {b[1] for b in bad if b[0] == "empty"} <= {"empty"}


def test_no_lines(spark):
    path = new_path(spark, "texts")
    spark.range(0).select(F.lit("x").alias("value")).write.text(path)
    lines, rejects = read_lines(spark, path)
    assert lines.count() == 0 and {r.reason for r in rejects.collect()} <= {"empty"}


def test_running_total(spark):
    df = spark.createDataFrame([(i, i % 5 if i % 7 else None) for i in range(200)], "k int, n long").repartition(6)
    got = {r.k: r.t for r in with_running_total(df, ["k"], "n", "t").collect()}
    total = 0
    for i in range(200):
        assert got[i] == total
        total += i % 5 if i % 7 else 0
