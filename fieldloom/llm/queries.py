"""Registered queries of this package and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bm25, bpe, embed, langid, lm, mining, packing, phrases, pii, simhash, suffix, tokenfile, warc

MODULES = [bm25, bpe, embed, langid, lm, mining, packing, phrases, pii, simhash, suffix, tokenfile, warc]


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def llm_oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in getattr(module, "ORACLES", {}).items()}
