"""Corpus pipeline: language ID, near-dedup, repeated passages, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldloom.llm import langid, packing, pii, simhash, suffix
from fieldloom.llm.batches import table
from fieldloom.storage import materialize

STAGES = [
    ("language_id", langid.keep_known),
    ("simhash_near_dedup", simhash.keep_one),
    ("suffix_array_dedup", suffix.drop_repeats),
    ("personal_data", pii.mask_stage),
    ("best_fit_packing", packing.pack_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
