"""The projection for user interfaces and the invariant checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks as C
from ..operators import projection as P
from ..sources.tables import view
from ..storage import materialize
from .catalog import _snapshot, catalog, categories, merged


def groups(spark, root):
    """Groups are numbered once and written: ids must not change between uses."""
    return _snapshot(spark, root, "groups", lambda: materialize(
        P.ui_groups(catalog(spark, root), categories(spark, root)), "groups"))


def ui(spark, root):
    return P.ui_items(catalog(spark, root), groups(spark, root))


def written_ui(spark, root):
    """The projection as a table: the checks look at what users of it see."""
    return _snapshot(spark, root, "ui", lambda: materialize(ui(spark, root), "ui"))


def idempotent(spark, root):
    """A fresh build from the tables and the written catalog differ in nothing."""
    return C.content_difference(catalog(spark, root), merged(spark, root))


def damaged(spark, root):
    """What the comparison of two builds says of a copy with rows changed, lost and repeated."""
    items = catalog(spark, root)
    changed = F.when(F.col("first_ord") % 11 == 0, F.concat(F.coalesce("title", F.lit("")), F.lit("!"))).otherwise(F.col("title"))
    kept = items.filter("first_ord % 7 > 0").withColumn("title", changed)
    copy = kept.unionByName(kept.filter("first_ord % 13 = 0"))
    return C.content_difference(items, copy).select("category", "name", "title", "only_in")


def lost_groups(spark, root):
    """Items of the projection whose group is gone from a copy of the groups."""
    return C.missing_groups(written_ui(spark, root), groups(spark, root).filter("group_id % 5 > 0")).select("group_id", "name")


QUERIES = {
    "check_damaged_copy": damaged,
    "missing_group_damaged": lost_groups,
    "ui_groups": lambda s, r: groups(s, r),
    "ui_items": ui,
    "missing_group_anti": lambda s, r: C.missing_groups(written_ui(s, r), groups(s, r)).select("group_id", "name"),
    "check_nonempty": lambda s, r: C.nonempty(catalog(s, r), categories(s, r)),
    "check_description": lambda s, r: C.description(catalog(s, r)),
    "check_empty_category": lambda s, r: C.empty_category(catalog(s, r), categories(s, r)),
    "check_orphan_curated": lambda s, r: C.orphan_curated(catalog(s, r), view(s, r, "curated")),
    "check_ui_complete": lambda s, r: C.ui_complete(catalog(s, r), written_ui(s, r), groups(s, r)),
    "check_ui_lengths": lambda s, r: C.ui_lengths(written_ui(s, r)),
    "check_unique_key": lambda s, r: C.unique_key(catalog(s, r), written_ui(s, r)),
    "check_ui_fk": lambda s, r: C.ui_foreign_keys(written_ui(s, r), groups(s, r), categories(s, r)),
    "check_report": lambda s, r: C.report(catalog(s, r), categories(s, r), view(s, r, "curated"), written_ui(s, r), groups(s, r)),
    "check_idempotent": idempotent,
}
