"""Search by term, table definitions, and upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rules import DIALECTS
from ..operators import schema as D
from ..operators import search as S
from ..operators import upsert as U
from ..sources.tables import view
from ..storage import materialize, new_path
from ..streaming import upsert_stream as T
from ..streaming import versions as V
from .catalog import _snapshot, catalog, normalized

TOP = 12
HIT = ["term_pos", "term", "category", "name"]


def _items(spark, root):
    return catalog(spark, root).select("category", "name", "title", "description")


def _terms(spark, root):
    return view(spark, root, "terms"), view(spark, root, "aliases")


def _resolved(spark, root):
    return S.resolve(_items(spark, root), *_terms(spark, root)).select("level", *HIT)


def top_n(spark, root):
    """The hits are written: counting them and ranking them are two passes."""
    return S.top_n(materialize(_resolved(spark, root), "hits"), TOP).select("rank", "level", "more", *HIT)


def _selection(spark, root):
    return _snapshot(spark, root, "selection", lambda: materialize(D.one_per_name(catalog(spark, root)), "selection"))


def columns(spark, root):
    return _snapshot(spark, root, "columns", lambda: materialize(D.table_columns(_selection(spark, root)).select(
        "table_name", "position", "column_name", "name", "data_type", "byte_length", "decimal_scale", "is_required",
        "is_fk", "target", "allowed_values", "description"), "columns"))


def levels(spark, root):
    return _snapshot(spark, root, "levels", lambda: D.creation_levels(_selection(spark, root)))


def table_text(spark, root):
    return D.create_table_lines(_selection(spark, root), columns(spark, root), levels(spark, root), DIALECTS)


SCRIPT_TERMS = ["invoice", "urgent"]


def _script_terms(spark, root):
    return view(spark, root, "terms").filter(F.col("term").isin(SCRIPT_TERMS))


def _script_selection(spark, root):
    """What two terms resolve to; tables that these refer to are outside."""
    hits = S.resolve(_items(spark, root), _script_terms(spark, root), view(spark, root, "aliases"))
    return materialize(D.selected_items(catalog(spark, root), hits), "script-items")


def selected_script(spark, root):
    return D.script_lines(_script_selection(spark, root), _script_terms(spark, root), DIALECTS)


def upsert_items(spark, root):
    """Every item is in the base or in what comes later, a sixth in both."""
    return U.upsert_raw_items(normalized(spark, root), F.expr("ord % 3 > 0 OR ord % 2 = 0"), F.expr("ord % 3 = 0"))


def upsert_stream(spark, root):
    """Four item batches as files, consumed by a stream, then read as current items."""
    batches = U.reduce_batch(normalized(spark, root).withColumn(T.SEQ, F.col("ord") % 4), T.SEQ)
    source, log, state = (new_path(spark, p) for p in ("batches", "log", "state"))
    batches.write.parquet(source)
    T.run(spark, batches.schema, source, log, state, files_per_trigger=2)
    return T.current_items(T.read_log(spark, batches.schema, log))


def upsert_stream_compacted(spark, root):
    """The same four batches, one in each epoch; every second epoch is followed by a compaction, so keys are compacted half-way."""
    batches = U.reduce_batch(normalized(spark, root).withColumn(T.SEQ, F.col("ord") % 4), T.SEQ)
    source, place, state = (new_path(spark, p) for p in ("batches", "store", "state"))
    batches.repartition(4, T.SEQ).write.parquet(source)
    store = V.ItemStore(spark, place, batches.schema)
    V.run(store, source, state, files_per_trigger=1, compact_every=2)
    return store.current()


def upsert_stored(spark, root):
    """A base at rest, in buckets, and what comes later put into it."""
    sides = {0: F.expr("ord % 3 > 0 OR ord % 2 = 0"), 1: F.expr("ord % 3 = 0")}
    batches = [U.reduce_batch(normalized(spark, root).filter(side).withColumn(T.SEQ, F.lit(seq).cast("bigint")), T.SEQ) for seq, side in sides.items()]
    store = V.ItemStore(spark, new_path(spark, "store"), batches[0].schema)
    for batch in batches:
        store.upsert(batch)
    return store.current()


QUERIES = {
    "term_match_theta": lambda s, r: S.term_matches(_items(s, r), _terms(s, r)[0]),
    "search_category": lambda s, r: S.search_category(_items(s, r), _terms(s, r)[0]).select(*HIT),
    "search_entity": lambda s, r: S.search_entity(_items(s, r), _terms(s, r)[0]).select(*HIT),
    "search_alias": lambda s, r: S.search_alias(_items(s, r), *_terms(s, r)).select(*HIT, "targets"),
    "search_keyword": lambda s, r: S.search_keyword(_items(s, r), _terms(s, r)[0]).select(*HIT),
    "resolve_terms": _resolved,
    "search_summary": lambda s, r: S.summary(_items(s, r), *_terms(s, r)),
    "search_topn": top_n,
    "search_union": lambda s, r: S.union_terms(_resolved(s, r)),
    "entity_table_defs": lambda s, r: columns(s, r).drop("allowed_values", "description"),
    "fk_edges": lambda s, r: D.foreign_keys(_selection(s, r)),
    "fk_edge_join": lambda s, r: D.table_edges(_selection(s, r)),
    "reverse_relations": lambda s, r: D.reverse_relations(_selection(s, r)).drop("place"),
    "external_refs": lambda s, r: D.external_references(_selection(s, r)),
    "dependency_levels": levels,
    "create_table_text": table_text,
    "create_table_plain": lambda s, r: D.plain_table_lines(_selection(s, r)),
    "create_table_selected": selected_script,
    "external_refs_selected": lambda s, r: D.external_references(_script_selection(s, r)),
    "upsert_items": upsert_items,
    "upsert_stream": upsert_stream,
    "upsert_stream_compacted": upsert_stream_compacted,
    "upsert_stored": upsert_stored,
}
