"""Merge, enrichment, reports, projection, search, schema, graph, ranking, upsert and checks."""
