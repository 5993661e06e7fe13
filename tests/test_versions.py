"""Versions of items at rest: compaction, switches, touched buckets."""

import pytest

from fieldloom.operators.upsert import ITEM_COLUMNS, ITEM_KEY
from fieldloom.storage import AlreadyThere, names_below, new_path, publish_text, read_text
from fieldloom.streaming import upsert_stream as T
from fieldloom.streaming import versions as V

TYPES = {"byte_length": "int", "decimal_scale": "int", "is_required": "boolean", "is_nullable": "boolean"}
SCHEMA = ", ".join(f"{c} {TYPES.get(c, 'string')}" for c in [*ITEM_KEY, *ITEM_COLUMNS]) + f", {T.SEQ} long"


@pytest.fixture
def batch(spark):
    def make(*rows):
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        return spark.createDataFrame([tuple(({"category": "c", "source_standard": "s"} | r).get(n) for n in names) for r in rows], SCHEMA)

    return make


@pytest.fixture
def store(spark, batch):
    return V.ItemStore(spark, new_path(spark, "store"), batch().schema, buckets=8)


def rows(df):
    return sorted((tuple(r) for r in df.select(*ITEM_KEY, *ITEM_COLUMNS).collect()), key=str)


def batches(batch):
    """Four batches; keys come back with other columns, one has no source, one comes in every batch."""
    return [batch(*[dict(name=f"n{k}", title=f"t{seq}" if (k + seq) % 3 else None, description=f"d{seq}" if seq % 2 else None, byte_length=seq if k % 4 == seq else None,
                         source_standard=None if k % 5 == 0 else "s", batch_seq=seq) for k in range(20) if k % 4 != seq or k == 0]) for seq in range(4)]


@pytest.mark.parametrize("order", [[0, 1, 2, 3], [3, 1, 0, 2]])
@pytest.mark.parametrize("after", [{0}, {1}, {1, 2}, {0, 1, 2, 3}])
def test_compaction_half_way_gives_the_plain_result(store, batch, order, after):
    parts = batches(batch)
    want = rows(T.current_items(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])))
    for epoch, k in enumerate(order):
        store.append(parts[k], epoch)
        if epoch in after:
            assert store.compact().through == epoch
    assert rows(store.current()) == want
    assert store.manifest().version == len(after)


def test_readers_keep_the_version_they_opened(store, batch):
    store.append(batch(dict(name="a", title="old", batch_seq=1)), 0)
    store.compact()
    opened = store.read()
    store.append(batch(dict(name="a", title="new", batch_seq=2), dict(name="b", title="b", batch_seq=2)), 1)
    between = store.read()
    store.compact()
    assert [r.title for r in opened.collect()] == ["old"]
    assert sorted(r.title for r in between.collect()) == ["b", "new", "old"]
    assert sorted(r.title for r in store.read().collect()) == ["b", "new"]      # the old title is needed no more
    assert sorted(r.title for r in store.read(version=1).collect()) == ["b", "new", "old"]


def test_only_touched_buckets_are_rewritten(spark, store, batch):
    base = batch(*[dict(name=f"n{k}", title="t", batch_seq=0) for k in range(100)])
    store.upsert(base)

    def files():
        got = store.manifest().folders
        return {b: (f, [n for n in names_below(spark, f"{store.path}/base/{f}/bucket={b}")]) for b, f in got.items()}

    before = files()
    assert len(before) == 8
    store.upsert(batch(dict(name="n7", description="more", batch_seq=1), dict(name="n7", category="other", title="x", batch_seq=1)))
    after = files()
    changed = {b for b in after if after[b] != before[b]}
    assert 1 <= len(changed) <= 2 and all(before[b][1] for b in before)
    got = {(r.category, r.name): (r.title, r.description) for r in store.current().collect()}
    assert len(got) == 101 and got["c", "n7"] == ("t", "more") and got["other", "n7"] == ("x", None)
    again = store.upsert(batch())
    assert again.folders == {b: f for b, (f, _) in after.items()} and rows(store.current()) == rows(store.current(version=2))


def test_one_of_two_writers_fails_and_leaves_nothing(spark, store, batch, monkeypatch):
    store.append(batch(dict(name="a", title="1", batch_seq=1)), 0)
    stale = store.manifest()
    store.compact()
    monkeypatch.setattr(store, "manifest", lambda version=None: stale)
    with pytest.raises(AlreadyThere):
        store.upsert(batch(dict(name="b", title="2", batch_seq=2)))
    monkeypatch.undo()
    assert [r.name for r in store.current().collect()] == ["a"]
    assert names_below(spark, f"{store.path}/base") == sorted(set(store.manifest().folders.values()))


def test_unfinished_and_repeated_epochs(spark, store, batch):
    part = batch(dict(name="a", title="1", batch_seq=1))
    store.append(part, 0)
    store.append(part, 0)
    part.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{store.log}/epoch=1")
    assert store.epochs() == [0] and store.read().count() == 1
    store.compact()
    store.append(batch(dict(name="z", title="replayed", batch_seq=9)), 0)
    assert [r.name for r in store.current().collect()] == ["a"]


def test_vacuum_keeps_what_kept_versions_read(spark, store, batch):
    for epoch in range(4):
        store.append(batch(dict(name="a", title=f"t{epoch}", batch_seq=epoch), dict(name=f"n{epoch}", title="x", batch_seq=epoch)), epoch)
        store.compact()
    last, before = rows(store.current()), rows(store.current(version=3))
    store.vacuum(keep=2)
    assert store.versions() == [3, 4] and store.epochs() == [3]
    assert rows(store.current()) == last and rows(store.current(version=3)) == before
    kept = {f for v in (3, 4) for f in store.manifest(v).folders.values()}
    assert all(names_below(spark, f"{store.path}/base/{f}") for f in kept)


def test_stream_compacts_as_it_goes(spark, store, batch):
    source, state = new_path(spark, "source"), new_path(spark, "state")
    for part in batches(batch):
        part.coalesce(1).write.mode("append").parquet(source)
    V.run(store, source, state, files_per_trigger=1, compact_every=3)
    want = rows(store.current())
    assert store.manifest().through == 2 and store.epochs(2) == [3]
    more = batch(dict(name="late", title="l", batch_seq=0))
    more.coalesce(1).write.mode("append").parquet(source)
    V.run(store, source, state, files_per_trigger=1, compact_every=3)
    assert rows(store.current()) == sorted([*want, *rows(more)], key=str)


def test_empty_store_and_published_texts(spark, store):
    assert store.current().count() == 0 and store.compact().version == 0
    path = f"{new_path(spark, 'texts')}/name"
    publish_text(spark, path, "é")
    assert read_text(spark, path) == "é"
    with pytest.raises(AlreadyThere):
        publish_text(spark, path, "other")
    assert read_text(spark, path) == "é"
