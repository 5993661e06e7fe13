"""Exact top-k search by BM25 over an inverted index with block-max pruning.

Documents are indexed in shards, each written once as one row of postings. The
queries come in blocks of bounded size. The document frequencies of the terms of all
blocks are summed over all shards first; then, block by block, each shard is searched
with these global statistics and gives its best ``k`` per query, and the best of all
shards are merged: the result is that of one index over everything.

Within a shard, terms that many documents have are kept as a matrix, and many queries
at once are multiplied with it: these parts of the scores are known of all documents.
Blocks of consecutive documents then have an upper bound per query: the largest such
part in the block, and for each other term the largest score it reaches there. Only
blocks are searched whose bounds reach the k-th best score so far, of which those with
the highest bounds give a first one; a task goes from shard to shard with the k best of
all before. A query whose bounds leave out less than half of its postings, as those of a
long one do, sums the postings of whole shards instead, until it is asked again.
Documents within the rounding of the products are scored once more, in the order
of the terms, so results do not depend on it and equal documents have equal scores.
"""

from __future__ import annotations

from array import array
from collections import Counter
from contextlib import contextmanager
from functools import cached_property, lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..storage import materialize
from .batches import pieces, table, utf8

#: Term saturation, length normalization, results per query.
K1, B, TOP = 1.2, 0.75, 10
#: Bytes of text of a shard, documents of a block, bytes of text of a block of queries.
SHARD_BYTES, BLOCK, QUERY_BYTES = 24 << 20, 64, 6 << 20
#: Blocks searched before the first look at the bounds.
FIRST_BLOCKS = 8
#: Bits that keep terms out that no query has; terms of which a task merges the counts of its shards.
HASH_BITS, MERGED = 24, 1 << 19
#: Bounds are worth their cost if they leave out all postings but one of so many; after so many shards a task asks for them again.
WORTH, AGAIN = 2, 8
#: A term that more than one of so many documents has is a row of the matrix; queries multiplied at once.
COMMON, AT_ONCE = 16, 128
#: Stands for a null id inside a shard; sorts last.
NO_ID = (1 << 63) - 1


def terms(text: bytes | None) -> list[bytes]:
    """Words, A-Z in lower case."""
    return (text or b"").lower().split()


# --- index ------------------------------------------------------------------------------------

#: Arrays are kept as their bytes, terms joined by line feeds: a shard passes the JVM as a few byte strings. Numbers of postings are as wide as the largest asks for.
SHARD = "n long, words long, ids binary, lengths binary, terms binary, df binary, docs binary, counts binary"


def narrow(numbers: np.ndarray) -> np.ndarray:
    return numbers.astype(np.min_scalar_type(numbers.max(initial=0)))


def build_shard(ids: list[int | None], texts: list[bytes | None]) -> pa.RecordBatch:
    number: dict[bytes, int] = {}
    term, doc, count, lengths = array("i"), array("i"), array("i"), []
    for d, text in enumerate(texts):
        found = Counter(terms(text))
        lengths.append(found.total())
        term.extend([number.setdefault(w, len(number)) for w in found])
        doc.extend([d] * len(found))
        count.extend(found.values())
    names = sorted(number)
    place = np.empty(len(names), np.int32)
    place[[number[w] for w in names]] = np.arange(len(names))
    at = place[np.array(term)]
    order = np.argsort(at, kind="stable")
    arrays = [
        np.array([NO_ID if i is None else i for i in ids], np.int64), np.array(lengths, np.int32), None,
        np.bincount(at, minlength=len(names)).astype(np.int32), narrow(np.array(doc))[order], narrow(np.array(count))[order],
    ]
    blobs = [b"\n".join(names) if a is None else a.tobytes() for a in arrays]
    return pa.RecordBatch.from_arrays(
        [pa.array([len(ids)], pa.int64()), pa.array([sum(lengths)], pa.int64()), *(pa.array([b], pa.binary()) for b in blobs)], names=[c.split()[0] for c in SHARD.split(", ")]
    )


def _shards(shard_bytes: int):
    def run(batches):
        ids, texts, held = [], [], 0
        for part in pieces(batches, "text"):
            ids += part.column("doc_id").to_pylist()
            texts += part.column("text").to_pylist()
            held += sum(len(t or b"") for t in texts[-part.num_rows:])
            if held >= shard_bytes:
                yield build_shard(ids, texts)
                ids, texts, held = [], [], 0
        if ids:
            yield build_shard(ids, texts)

    return run


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard, written. Null texts are empty documents."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"))
    return materialize(rows.mapInArrow(_shards(shard_bytes), SHARD), "index")


class Shard:
    """A shard ready to be searched for ``wanted`` terms: the matrix of the common ones, postings of all, and the largest impact of the others in each block of documents."""

    def __init__(self, row: dict[str, bytes], average: float, wanted: dict[bytes, int]):
        self.ids = np.frombuffer(row["ids"], np.int64)
        lengths, df = (np.frombuffer(row[c], np.int32) for c in ("lengths", "df"))
        docs, counts = (np.frombuffer(row[c], f"u{len(row[c]) // max(1, df.sum()) or 1}") for c in ("docs", "counts"))
        numbers = np.fromiter((wanted.get(word, -1) for word in names_of(row)), np.int32, len(df))
        asked = np.flatnonzero(numbers >= 0)
        #: by term number the term's place here, or -1
        self.place = np.full(len(wanted) + 1, -1, np.int32)
        self.place[numbers[asked]] = np.arange(len(asked))
        postings = np.repeat(numbers >= 0, df)
        df = df[asked]
        #: postings of the place p are first[p] to first[p + 1]
        self.first = np.concatenate([[0], np.cumsum(df, dtype=np.int64)])
        self.docs, self.counts = docs[postings], counts[postings]
        self.norm = K1 * (1 - B + B * lengths / average)
        #: in single precision, for bounds and first scores
        self.impact = self.impacts(self.docs, self.counts, np.float32)
        #: by place the row of the matrix, or -1
        self.common = np.full(len(df), -1, np.int32)
        often = np.flatnonzero(df * COMMON > len(self.ids))
        self.common[often] = np.arange(len(often))
        self.matrix = np.zeros((len(often), len(self.ids)), np.float32)
        for row_of, place in enumerate(often.tolist()):
            mine = slice(self.first[place], self.first[place + 1])
            self.matrix[row_of, self.docs[mine]] = self.impact[mine]
        #: share of a score by which a product in single precision can be off
        self.slack = (len(often) + 8) * 2.0 ** -23
        self.df = df
        self.blocks = -(-len(self.ids) // BLOCK)
        self.edges = np.arange(0, len(self.ids), BLOCK)

    def impacts(self, docs: np.ndarray, counts: np.ndarray, kind: type) -> np.ndarray:
        out = self.norm.astype(kind)[docs]
        out += counts
        return np.divide(counts * kind(K1 + 1), out, out=out, casting="same_kind")

    @cached_property
    def owner(self) -> np.ndarray:
        """The place of each posting."""
        return np.repeat(np.arange(len(self.common), dtype=np.int32), np.diff(self.first))

    @cached_property
    def entries(self) -> tuple[np.ndarray, ...]:
        """Entries (term, block) of the terms that are not common: block, largest impact, range of postings; and by place the range of entries."""
        rare = np.flatnonzero(self.common[self.owner] < 0).astype(np.int32)
        owner, block = self.owner[rare], self.docs[rare] // BLOCK
        first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (block[1:] != block[:-1])])) if len(rare) else np.zeros(0, np.int64)
        stop = np.append(rare[first[1:] - 1], rare[-1:]) + 1
        most = np.maximum.reduceat(self.impact[rare], first) if len(first) else np.zeros(0)
        places = np.arange(len(self.common))
        return block[first], most, rare[first], stop.astype(np.int32), *(np.searchsorted(owner[first], places, side=side) for side in ("left", "right"))

    def best(self, bounds: np.ndarray, numbers: np.ndarray, weights: np.ndarray, k: int, least: np.ndarray, bounded: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (bounds of term numbers in order and weights) ids and scores of documents with a term of it: all that may be among the ``k`` best and reach ``least``.

        ``bounded`` tells which queries ask for the bounds of blocks; those whose bounds left out too little are unset.
        """
        asked = []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            places = self.place[numbers[a:b]]
            asked.append((places[places >= 0], weights[a:b][places >= 0]))
        # queries that share their most frequent term are multiplied together: they have most rows of the matrix in common
        lead = [int(places[np.argmax(self.df[places])]) if len(places) else -1 for places, _ in asked]
        order = np.argsort(lead, kind="stable")
        found = [np.zeros(0, np.int64)] * len(asked)
        for start in range(0, len(asked), AT_ONCE):
            now = order[start:start + AT_ONCE].tolist()
            common = np.zeros((len(now), len(self.matrix)), np.float32)
            for line, q in zip(common, now, strict=True):
                rows = self.common[asked[q][0]]
                line[rows[rows >= 0]] = asked[q][1][rows >= 0]
            some = np.flatnonzero(common.any(axis=0))
            for q, part in zip(now, common[:, some] @ self.matrix[some], strict=True):
                found[q], bounded[q] = self.search(*asked[q], part, k, float(least[q]), bool(bounded[q]))
        return self.exact(asked, found)

    def search(self, places: np.ndarray, weights: np.ndarray, part: np.ndarray, k: int, least: float, bounded: bool) -> tuple[np.ndarray, bool]:
        """Documents that may be among the ``k`` best with at least ``least``, from their scores by the common terms; and whether bounds are worth their cost."""
        if not len(places):
            return np.zeros(0, np.int64), bounded
        rare = self.common[places] < 0
        places, weights = places[rare], weights[rare]
        up = 1 + self.slack
        scores, worth = self.in_blocks(places, weights, part, k, least, up) if bounded else (None, False)
        if scores is None:
            start, stop = self.first[places], self.first[places + 1]
            scores = self.summed(start, stop, weights) + part
        found = np.flatnonzero(scores * up >= max(least, np.finfo(float).tiny))
        if len(found) > k:
            reached = scores[found]
            found = found[reached * up >= np.partition(reached, len(found) - k)[len(found) - k] / up / up]
        return found, worth

    def summed(self, start: np.ndarray, stop: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Parts of the scores of all documents by ranges of postings, each with its weight."""
        postings = spread(start, stop)
        return np.bincount(self.docs[postings], weights=self.impact[postings] * np.repeat(weights, stop - start), minlength=len(self.ids))

    def in_blocks(self, places: np.ndarray, weights: np.ndarray, part: np.ndarray, k: int, least: float, up: float) -> tuple[np.ndarray | None, bool]:
        """Scores of the documents in blocks whose bounds reach ``least`` or the k-th best, zero elsewhere; none if that leaves out too few postings."""
        blocks, most, starts, stops, from_entry, to_entry = self.entries
        entries = spread(from_entry[places], to_entry[places])
        weight = np.repeat(weights, to_entry[places] - from_entry[places])
        block = blocks[entries]
        bound = (np.bincount(block, weights=weight * most[entries], minlength=self.blocks) + np.maximum.reduceat(part, self.edges).astype(float)) * up
        if self.blocks > FIRST_BLOCKS and not least:
            # no bar yet: the blocks of the highest bounds give one
            chosen = np.zeros(self.blocks, bool)
            chosen[np.argpartition(-bound, FIRST_BLOCKS)[:FIRST_BLOCKS]] = True
            mine = entries[chosen[block]]
            ready = (self.summed(starts[mine], stops[mine], weight[chosen[block]]) + part)[np.repeat(chosen, BLOCK)[:len(part)]]
            if len(ready) >= k:
                least = np.partition(ready, len(ready) - k)[len(ready) - k] / up / up
        reach = (bound >= least) & (bound > 0)
        kept = reach[block]
        mine = entries[kept]
        start, stop = starts[mine], stops[mine]
        if (stop - start).sum() * WORTH > (self.first[places + 1] - self.first[places]).sum():
            return None, False
        return np.where(np.repeat(reach, BLOCK)[:len(part)], self.summed(start, stop, weight[kept]) + part, 0), True

    def exact(self, asked: list[tuple[np.ndarray, np.ndarray]], found: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and scores of the documents found for each query; sums run in the order of the terms, everywhere."""
        shown = np.zeros(len(self.ids), bool)
        for docs in found:
            shown[docs] = True
        some = shown[self.docs]
        of = self.docs[some]
        order = np.argsort(of, kind="stable").astype(np.int32)
        owner, impact = self.owner[some][order], self.impacts(of, self.counts[some], np.float64)[order]
        stop = np.cumsum(np.bincount(of, minlength=len(self.ids)))
        start = np.append(0, stop[:-1])
        weight = np.zeros(len(self.common))
        out = []
        for (places, weights), docs in zip(asked, found, strict=True):
            if not len(docs):
                out.append((np.zeros(0, np.int64), np.zeros(0)))
                continue
            weight[places] = weights
            at = spread(start[docs], stop[docs])
            sizes = stop[docs] - start[docs]
            # one after the other: terms that the query does not have change nothing
            scores = np.bincount(np.repeat(np.arange(len(docs)), sizes), weights=weight[owner[at]] * impact[at], minlength=len(docs))
            weight[places] = 0
            out.append((self.ids[docs], scores))
        return out


def spread(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    lengths = stop - start
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    return np.arange(total) + np.repeat(start - before, lengths)


def names_of(row: dict[str, bytes]) -> list[bytes]:
    text = bytes(row["terms"])
    return text.split(b"\n") if text else []


def _rows(batches):
    """The shards of the batches, one by one."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield {n: batch.column(n)[k].as_buffer() for n in batch.schema.names}


@lru_cache(maxsize=1)
def _numbers(blob: bytes) -> dict[bytes, int]:
    """Numbers of the terms of a block of queries; one per worker process."""
    return {w: i for i, w in enumerate(blob.split(b"\n") if blob else [])}


@contextmanager
def _one_by_one(spark: SparkSession):
    """Shards are read and go to Python one at a time: a batch of all shards of a file or a task would not be bounded."""
    settings = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = {name: spark.conf.get(name) for name in settings}
    for name in settings:
        spark.conf.set(name, 1)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _block_terms(batches):
    """The terms of each block of queries, once a batch."""
    for part in pieces(batches, "text"):
        found = {(block, w) for block, text in zip(part.column("block").to_pylist(), part.column("text").to_pylist(), strict=True) for w in terms(text)}
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int64()), pa.array([w for _, w in found], pa.binary())], names=["block", "term"])


def _frequencies(blob):
    """``blob``: broadcast bits by hash of the terms that are asked for; the terms of a task's shards that pass, with their documents there."""
    def rows(total):
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.binary()), pa.array(total.values(), pa.int64())], names=["term", "df"])

    def run(batches):
        bits, total = np.frombuffer(blob.value, np.uint8), {}
        for row in _rows(batches):
            names = names_of(row)
            at = np.fromiter(map(crc32, names), np.int64, len(names)) % (1 << HASH_BITS)
            some = np.flatnonzero(bits[at >> 3] >> (at & 7) & 1)
            for i, n in zip(some.tolist(), np.frombuffer(row["df"], np.int32)[some].tolist(), strict=True):
                total[names[i]] = total.get(names[i], 0) + n
            if len(total) > MERGED:
                yield rows(total)
                total = {}
        yield rows(total)

    return run


def frequencies(shards: DataFrame, queries: DataFrame) -> DataFrame:
    """(block, term, df): the terms of each block of (block, text) queries and the number of documents that have them, written.

    One pass over the shards serves all blocks. Bits of a fixed number of hashes keep most other terms out of the shuffle.
    """
    spark = shards.sparkSession
    asked = materialize(queries.select("block", "text").mapInArrow(_block_terms, "block long, term binary").distinct(), "query-terms")
    hashes = asked.select((F.crc32("term") % (1 << HASH_BITS)).alias("h")).distinct().toArrow()          # at most 2^HASH_BITS numbers
    bits = np.zeros(1 << HASH_BITS, bool)
    bits[hashes.column("h").to_numpy()] = True
    blob = spark.sparkContext.broadcast(np.packbits(bits, bitorder="little").tobytes())
    with _one_by_one(spark):
        found = shards.select("terms", "df").mapInArrow(_frequencies(blob), "term binary, df long")
        return materialize(asked.join(found.groupBy("term").agg(F.sum("df").alias("df")), "term").select("block", "term", "df"), "frequencies")


FOUND = "query long, doc_id long, score double"


def _search(blob, queries, average: float, k: int):
    """The ``k`` best of all shards of a task; ``queries``: broadcast ids, bounds, term numbers and weights of a block of queries."""
    def run(batches):
        ids, bounds, numbers, weights = queries.value
        best = [(np.zeros(0, np.int64), np.zeros(0))] * len(ids)
        least, bounded = np.zeros(len(ids)), np.ones(len(ids), bool)
        for shard, row in enumerate(_rows(batches)):
            if shard % AGAIN == 1:
                bounded[:] = True                   # what is best so far bars more than before
            found = Shard(row, average, _numbers(blob.value)).best(bounds, numbers, weights, k, least, bounded)
            for q, (docs, scores) in enumerate(found):
                if len(docs):
                    docs, scores = np.concatenate([best[q][0], docs]), np.concatenate([best[q][1], scores])
                    order = np.lexsort((docs, -scores))[:k]
                    best[q] = docs[order], scores[order]
                    if len(order) == k:
                        least[q] = best[q][1][-1]
        docs, scores = (np.concatenate(c) for c in zip(*best, strict=True))
        owners = np.repeat(ids, [len(d) for d, _ in best])
        yield pa.RecordBatch.from_arrays([pa.array(owners), pa.array(docs, mask=docs == NO_ID), pa.array(scores)], names=["query", "doc_id", "score"])

    return run


def top_k(docs: DataFrame, is_query: Column, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(query_id, rank, doc_id, score): for each row with ``is_query`` the best ``k`` of all rows.

    Whole texts are queries; a term counts as often as the query has it. Ties go to the
    smaller id, null ids last. A query without terms, or with a null id, has no rows; each
    row of a repeated query id is a query with results of its own. Scores are rounded to six digits.
    """
    spark = docs.sparkSession
    index = build_index(docs, id_col, text_col, shard_bytes)
    sums = index.agg(F.sum("n").alias("n"), F.sum("words").alias("words")).first()
    n, average = sums.n or 0, max(1e-9, (sums.words or 0) / max(1, sums.n or 0))
    chosen = docs.where(is_query & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("query_id"), utf8(text_col).alias("text"))
    chosen = chosen.withColumn("query", F.monotonically_increasing_id())
    size = chosen.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-size // query_bytes)
    stored = materialize(chosen.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(max(1, blocks)))), "queries")
    # tasks merge the results of their shards: rows grow with the queries, not with queries x shards
    shards = index.drop("n", "words").coalesce(2 * max(1, spark.sparkContext.defaultParallelism))
    best = spark.createDataFrame([], FOUND)
    known = frequencies(shards, stored) if blocks else None
    for block in range(blocks):
        rows = [(r.query, Counter(terms(r.text))) for r in stored.where(F.col("block") == block).orderBy("query").collect()]     # about query_bytes of text
        if not any(q for _, q in rows):
            continue
        counted = known.where(F.col("block") == block).select("term", "df").toArrow().sort_by("term")
        names, df = counted.column("term").to_pylist(), counted.column("df").to_numpy()
        number = {w: i for i, w in enumerate(names)}
        blob = spark.sparkContext.broadcast(b"\n".join(names))
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        terms_of = [np.array(sorted(number[w] for w in q), np.int32) for _, q in rows]
        times = [np.array([q[names[t]] for t in mine.tolist()], float) for mine, (_, q) in zip(terms_of, rows, strict=True)]
        packed = np.array([i for i, _ in rows]), np.cumsum([0, *map(len, terms_of)]), np.concatenate(terms_of), np.concatenate([c * idf[t] for c, t in zip(times, terms_of, strict=True)])
        queries = spark.sparkContext.broadcast(packed)
        with _one_by_one(spark):
            best = best.union(materialize(shards.mapInArrow(_search(blob, queries, average, k), FOUND), "shard-best"))
    order = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(stored.select("query", "query_id"), "query").select("query_id", "rank", "doc_id", F.round("score", 6).alias("score"))


def op4_bm25_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "documents"), F.col("doc_id") % 100 == 0)


QUERIES = {"op4_bm25_top_k": op4_bm25_top_k}
ORACLES = {
    "op4_bm25_top_k": """
        WITH words AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')) AS w
            FROM documents),
        tf AS (SELECT doc_id, w, count(*) AS c FROM words GROUP BY ALL),
        len AS (SELECT doc_id, sum(c) AS n FROM tf GROUP BY doc_id),
        stat AS (SELECT count(*) AS docs, (SELECT count(*) FROM words) / count(*) AS avg FROM documents),
        idf AS (SELECT w, ln(1 + (max(docs) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, stat GROUP BY w),
        hits AS (
            SELECT q.doc_id AS query_id, d.doc_id, round(sum(q.c * idf * d.c * 2.2 / (d.c + 1.2 * (0.25 + 0.75 * n / avg))), 6) AS score
            FROM tf q JOIN tf d ON q.w = d.w JOIN idf ON q.w = idf.w JOIN len ON d.doc_id = len.doc_id, stat
            WHERE q.doc_id % 100 = 0 GROUP BY ALL),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM hits)
        SELECT query_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10"""
}
