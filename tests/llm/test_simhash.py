import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from fieldloom.llm import simhash
from fieldloom.llm.components import components

TEXTS = "doc_id long, text string, lang string, fp string, key int"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, linked):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def brute(rows):
    fps = {i: plain_fingerprint(t) for i, t in rows}
    ids = sorted(fps)
    linked = [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    return fps, plain_components(ids, linked)


def test_query_matches_brute_force(spark, root):
    docs = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text").collect()
    fps, label = brute([(r.doc_id, r.text) for r in docs])
    got = simhash.op6_simhash_near_dedup(spark, root).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{fps[i]:016x}", label[i]) for i in fps}


def test_odd_texts_and_clashing_columns(spark):
    long = "word " * 5000 + "Ä end"
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (6, long), (7, long), (8, "\x00 a b c é"), (9, "x\x0by\x0cz")]
    df = spark.createDataFrame([(i, t, "x", "clash", 1) for i, t in rows], TEXTS)
    fps, label = brute(rows)
    got = simhash.near_duplicates(df).collect()
    assert {r.doc_id: (r.fp % 2**64, r.component_id) for r in got} == {i: (fps[i], label[i]) for i in fps}
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    kept = simhash.keep_one(spark, df, "")
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(label.values()))


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    base = " ".join(f"w{i}" for i in range(400))
    near = next(t for t in (f"{base} tail {k}" for k in range(99)) if 0 < (plain_fingerprint(base) ^ plain_fingerprint(t)).bit_count() <= 3)
    rows = [(None, "only here, without an id"), (None, base), (2, near), (2, "another text of id two"), (3, "the same row"), (3, "the same row"),
            (None, "a pair without ids"), (None, "a pair without ids"), (1, "one"), (1, "quite another one")]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, key int").repartition(3)
    kept = sorted(((r.doc_id, r.text) for r in simhash.keep_one(spark, df, "").collect()), key=str)
    assert kept == sorted([rows[0], rows[2], rows[3], rows[4], rows[6], rows[8], rows[9]], key=str)
    alone = spark.createDataFrame([(None, base), (None, near)], "doc_id long, text string")
    assert simhash.keep_one(spark, alone, "").count() == 1


def test_rows_link_whatever_their_ids(spark, monkeypatch):
    """Fingerprints as given: a row without an id, or one whose id another row has, is a link like any other."""
    def plain(given):
        fps = spark.createDataFrame(given, "doc_id long, fp long")
        monkeypatch.setattr(simhash, "fingerprints", lambda docs, *_: fps)
        return sorted(((r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(fps).collect()), key=str)

    assert plain([(1, 0), (None, 7), (9, 63)]) == sorted([(1, 0, 1), (None, 7, 1), (9, 63, 1)], key=str)
    assert plain([(7, 1), (None, 3), (5, 31 << 0)]) == sorted([(7, 1, 5), (None, 3, 5), (5, 31, 5)], key=str)
    far = 0x0F0F0F0F0F0F0F0F
    assert plain([(2, 0), (2, far), (1, far), (None, -1)]) == sorted([(2, 0, 2), (2, far, 1), (1, far, 1), (None, -1, None)], key=str)


def test_long_lists_are_dealt_in_blocks(spark):
    rng = np.random.default_rng(5)
    base = int(rng.integers(1 << 62))
    fps = sorted({base ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for _ in range(300)})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(fps)], "fp long, rep long")
    linked = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3]
    want = {i: c for i, c in plain_components(range(len(fps)), linked).items()}
    for block in (7, 10_000):
        got = {r.id: r.component for r in components(simhash.links(df, block), "a", "b").collect()}
        assert {i: got.get(i, i) for i in want} == want


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(200, 400)] + [(0, i) for i in range(1, 90)] + [(500, 500), (None, 3), (900, 800), (900, 800)]
    got = {r.id: r.component for r in components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 200 for i in range(200, 401)}, **{i: 0 for i in range(90)}, 800: 800, 900: 800}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").agg(F.count("*")).first()[0] == 0
