"""Helpers the operators share: reading tables, texts as bytes, sorted groups out of Arrow batches."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts of one Arrow batch are worked on in slices of about so many bytes.
SLICE_BYTES = 4 << 20


def workers_find_package(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package from where the driver has it; a cluster has it installed."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: str) -> Column:
    """A text column as UTF-8 bytes; null stays null."""
    return F.col(column).cast("binary")


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of a column's text, modulo ``modulus``; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def pieces(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``column`` holds about ``size`` bytes; one longer text is a slice of its own."""
    for batch in batches:
        ends = np.cumsum(_lengths(batch.column(column)))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def _lengths(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _numbers(column: pa.Array) -> np.ndarray:
    """A numeric column; lists of one length become the rows of a matrix."""
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return column.to_numpy(zero_copy_only=False)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """Numeric columns and the bounds of groups of equal ``keys``, from rows sorted by them.

    A group that goes on in the next batch is carried over, so each yielded
    chunk holds whole groups only; the caller bounds the size of a group.
    """
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = {n: _numbers(batch.column(n)) for n in batch.schema.names}
        rows = new if held is None else {n: np.concatenate([held[n], new[n]]) for n in new}
        n = len(rows[keys[0]])
        change = np.zeros(n - 1, bool)
        for key in keys:
            change |= rows[key][1:] != rows[key][:-1]
        cuts = np.flatnonzero(change) + 1
        if not len(cuts):
            held = rows
            continue
        last = cuts[-1]
        yield {k: v[:last] for k, v in rows.items()}, np.concatenate([[0], cuts])
        held = {k: v[last:].copy() for k, v in rows.items()}
    if held is not None and len(held[keys[0]]):
        yield held, np.array([0, len(held[keys[0]])])


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch from arrays or lists in the order of ``schema``."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
