"""Headline queries timed on one local session; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local threads.
The written catalog is built first and reported as its own entry, because the
queries that ask questions of it read that table.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fieldloom.plans.catalog import catalog  # noqa: E402
from fieldloom.plans.queries import all_queries  # noqa: E402
from fieldloom.session import local_session  # noqa: E402

HEADLINE = [
    "merged_catalog", "merge_report", "group_concepts", "merge_allowed_values", "related_concepts", "resolve_terms", "search_topn",
    "source_category_matrix", "coverage_by_category", "upsert_items", "upsert_stream", "json_entity_attrs", "json_field_list",
    "json_schema_props", "spec_line_parse", "strip_markup", "class_closure", "dependency_levels", "create_table_text", "ui_items",
    "check_report", "q_entity_fields", "q_shared_fields",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "fieldloom-bench")
    queries = all_queries()

    def run(key: str) -> float:
        start = time.perf_counter()
        queries[key](spark, root).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("group_concepts")               # warms up the JVM on one of the plans
    times = {}
    start = time.perf_counter()
    catalog(spark, root)
    times["catalog_build"] = round(time.perf_counter() - start, 3)
    for key in HEADLINE:
        times[key] = round(run(key), 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(root.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
