"""Fieldloom: metadata harmonization as Spark DataFrame jobs."""
