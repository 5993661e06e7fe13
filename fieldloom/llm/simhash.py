"""Near duplicates by SimHash and a byte-position inverted index with count filtering.

A 64-bit fingerprint has eight positional bytes.  Two fingerprints that differ
in at most three bits differ in at most three bytes, so they share at least
five positional bytes.  The index has a posting list for the values of four
positions at a time.  Fourteen such sets of four (those whose numbers xor to
zero) are enough: whichever three positions differ, one of the sets avoids
them.  Pairs that meet in a list have their shared positional bytes tallied;
those with five or more are verified by their differing bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import materialize
from .batches import pieces, sorted_groups, table, utf8
from .components import components

#: Words of a shingle, seed of its hash, largest number of differing bits of a link.
SHINGLE, SEED, MAX_BITS = 3, 42, 3
#: Positional bytes that linked fingerprints share at least.
SHARED = 8 - MAX_BITS
#: A posting list beyond this length is dealt out as pairs of blocks of about this length.
BLOCK = 1024
#: Sets of byte positions of the posting lists.
POSITIONS = [c for c in combinations(range(8), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]
#: Words of one very long text are hashed in runs of so many.
RUN = 200_000


def _hashes(text: bytes | None) -> Iterator[list[int]]:
    """Hashes of the shingles of a text, in runs."""
    words = (text or b"").lower().split()        # bytes: A-Z only, and exactly the ASCII white space
    if not words:
        return
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        yield [digest(b" ".join(words), SEED)]
        return
    for at in range(0, len(words) - SHINGLE + 1, RUN):
        part = words[at:at + RUN + SHINGLE - 1]
        yield [digest(b" ".join(s), SEED) for s in zip(part, part[1:], part[2:], strict=False)]


def _bits(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How often each of 64 bits is set in each run of hashes."""
    return np.add.reduceat(np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64), starts, axis=0, dtype=np.int64)


def text_fingerprints(texts: list[bytes | None]) -> np.ndarray:
    """The fingerprint of each text; zero without words."""
    sums, totals = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    held: list[int] = []
    starts: list[int] = []
    owners: list[int] = []

    def flush() -> None:
        if held:
            np.add.at(sums, owners, _bits(np.array(held, np.uint64), np.array(starts)))
            held.clear(), starts.clear(), owners.clear()

    for i, text in enumerate(texts):
        for run in _hashes(text):
            starts.append(len(held))
            owners.append(i)
            held.extend(run)
            totals[i] += len(run)
            if len(held) >= RUN:
                flush()
    flush()
    return np.packbits(2 * sums > totals[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def _fingerprint_batches(batches):
    for part in pieces(batches, "text"):
        fps = text_fingerprints(part.column("text").to_pylist())
        names = [n for n in part.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(fps.view(np.int64))], names=[*names, "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long. Null and wordless texts have fingerprint zero."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text")).mapInArrow(_fingerprint_batches, "doc_id long, fp long")


POSTINGS = pa.schema([("key", pa.int64()), ("fp", pa.int64()), ("rep", pa.int64())])


def _posting_batches(batches):
    for part in batches:
        fp, rep = (part.column(n).to_numpy() for n in ("fp", "rep"))
        octets = fp.view(np.uint8).reshape(-1, 8).astype(np.int64)
        for k, (a, b, c, d) in enumerate(POSITIONS):
            key = k << 32 | octets[:, a] << 24 | octets[:, b] << 16 | octets[:, c] << 8 | octets[:, d]
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp), pa.array(rep)], schema=POSTINGS)


def linked(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of two blocks of fingerprints are links: tally of shared positional bytes, then differing bits."""
    differ = left[:, None] ^ right[None, :]
    shared = (differ.view(np.uint8).reshape(*differ.shape, 8) == 0).sum(axis=2, dtype=np.uint8) >= SHARED
    shared[shared] = np.bitwise_count(differ[shared]) <= MAX_BITS
    return shared


def _forest(n: int, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of linked positions below ``n``: each one that has a smaller one in reach, and the smallest."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, rows, label[cols])
        np.minimum.at(new, cols, label[rows])
        new = new[new]
        if (new == label).all():
            own = np.flatnonzero(label != np.arange(n))
            return own, label[own]
        label = new


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _link_batches(batches):
    """Links that hold each list, or pair of blocks of a list, together."""
    for rows, cuts in sorted_groups(batches, ["key", "pair"]):
        fp, rep, side = rows["fp"].view(np.uint64), rows["rep"], rows["side"]
        bounds = np.append(cuts, len(fp)) if cuts[-1] != len(fp) else cuts
        sizes = np.diff(bounds)
        two = bounds[:-1][sizes == 2]
        two = two[(np.bitwise_count(fp[two] ^ fp[two + 1]) <= MAX_BITS) & ((side[two] == 0) | (side[two] != side[two + 1]))]
        found = [(rep[two], rep[two + 1])]
        for at, n in zip(bounds[:-1][sizes > 2], sizes[sizes > 2], strict=True):
            f, r, s = fp[at:at + n], rep[at:at + n], side[at:at + n]
            left, right = (np.arange(n),) * 2 if s[0] == 0 else (np.flatnonzero(s == 1), np.flatnonzero(s == 2))
            x, y = np.nonzero(linked(f[left], f[right]))
            own, root = _forest(int(n), left[x], right[y])
            found.append((r[own], r[root]))
        a, b = (np.concatenate(c) for c in zip(*found, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=LINKS)


def links(distinct: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): links between representatives that have the same components as all links within ``MAX_BITS``.

    ``distinct`` has one row (fp, rep) per fingerprint.  Lists longer than
    ``block`` become pairs of blocks, so that no task holds one whole.
    """
    postings = distinct.mapInArrow(_posting_batches, "key long, fp long, rep long")
    long_lists = postings.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block).select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        postings.join(long_lists, "key", "left")
        .select("key", "fp", "rep", F.coalesce(own, F.lit(0)).alias("own"), F.explode(other).alias("other"))
        .select(
            "key", "fp", "rep",
            (F.shiftleft(F.least("own", "other").cast("long"), 31) + F.greatest("own", "other")).alias("pair"),
            F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"),
        )
    )
    return dealt.repartition("key", "pair").sortWithinPartitions("key", "pair").mapInArrow(_link_batches, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(doc_id, fp, component_id) for every document.

    ``component_id`` is the smallest id reachable over links of at most
    ``MAX_BITS`` differing bits.  Null and wordless texts share fingerprint
    zero; copies share theirs.  Rows with a repeated id stay and link by their own
    texts; rows without an id link like any other and give no component its id, so
    a component has a null one only if no row of it has an id.  Other columns are ignored.
    """
    fps = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    parts = components(links(distinct.select("fp", F.col("fp").alias("rep")), block), "a", "b")
    grouped = materialize(distinct.join(parts, distinct.fp == parts.id, "left").select("fp", "least", F.coalesce("component", "fp").alias("group")), "groups")
    least = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    classes = materialize(grouped.join(least, "group").select("fp", "component_id"), "components")
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near duplicates one row stays, that with the smallest id, if any has one.

    Groups are of rows, told apart by a written key: ids may be null or repeated.
    """
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("key"), F.struct(*docs.columns).alias("row")), "rows")
    texts = rows.select("key", F.col("row")["doc_id"].cast("long").alias("id"), F.col("row")["text"].cast("binary").alias("text"))
    fps = materialize(texts.mapInArrow(_fingerprint_batches, "key long, id long, fp long"), "fingerprints")
    distinct = materialize(fps.groupBy("fp").agg(F.min("key").alias("rep"), F.min(F.struct(F.col("id").isNull(), "id", "fp", "key")).alias("first")), "classes")
    parts = components(links(distinct.select("fp", "rep")), "a", "b")
    group = F.coalesce("component", "rep").alias("group")
    firsts = distinct.join(parts, distinct.rep == parts.id, "left").groupBy(group).agg(F.min("first").alias("first")).select(F.col("first")["key"].alias("key"))
    return rows.join(firsts, "key", "left_semi").select(*(F.col("row")[c].alias(c) for c in docs.columns))


QUERIES = {"op6_simhash_near_dedup": op6_simhash_near_dedup}
