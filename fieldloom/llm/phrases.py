"""Phrases whose words keep together, by dynamic itemset counting.

The corpus is encoded once into blocks, dealt over ``SHARDS`` shards that are
scanned in turn, round and round; one step scans one shard. All lengths are
counted in the same scans: words from the first step on, and a longer phrase
from the step after both phrases that it has without its last and without its
first word have reached the threshold, until it has seen each shard once.
Scanning ends when no phrase's cycle is open.

Which phrases have reached the threshold, and since which step, is a state table
merged with each step's counts. Tasks know it from a map of fixed size: a slot
for each value of a hash, holding the last step at which a phrase with this hash
got there. Phrases that share a slot can only make a task count a phrase too
early or too long. A shard's count of a phrase is always whole, and the state
takes each shard's count once, so the results do not depend on the size of the
map. A phrase that has seen all shards and stays below the threshold leaves the
state.

A block's counts are combined in its task, before the shuffle; a phrase is
counted by its words, never by its hash alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..storage import discard, new_path
from .batches import pieces, table

#: Words of the longest phrase, occurrences of a phrase that counts, phrases of a language to report.
LONGEST, THRESHOLD, TOP = 5, 100, 2_000
#: Shards of the cyclic scan; bytes of text of a block.
SHARDS, BLOCK_BYTES = 3, 4 << 20
#: Slots of the map of reached phrases, as a power of two; slots of a page in which it is put together.
SLOT_BITS, PAGE_BITS = 24, 16
#: Parts in which a language's phrases are ranked before the best of all parts are.
RANK_PARTS = 64
# Where pieces end.
BREAKS = b".,;:!?\n\x0b\x0c\r"

TRANSLATED = bytes(ord("\n") if b in BREAKS else b + 32 if 65 <= b <= 90 else b for b in range(256))


# --- blocks -----------------------------------------------------------------------------------

def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words, codes): distinct words, and each text's words as their numbers, with -1 between pieces."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    start, stop = texts.offset, texts.offset + len(texts)
    data = pa.py_buffer((texts.buffers()[2] or pa.py_buffer(b"")).to_pybytes().translate(TRANSLATED))
    texts = pa.Array.from_buffers(pa.large_string(), stop, [None, texts.buffers()[1], data])[start:]
    lists = pc.ascii_split_whitespace(pc.split_pattern(texts, "\n").flatten())
    coded = lists.flatten().dictionary_encode()
    piece = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    codes, words = coded.indices.to_numpy().astype(np.int32), coded.dictionary.cast(pa.string())
    empty = pc.index(words, "").as_py()
    if empty >= 0:
        piece, codes = piece[codes != empty], codes[codes != empty]
    return words, np.insert(codes, np.flatnonzero(np.diff(piece)) + 1, -1)


def word_hashes(lang: str, words: pa.Array) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang)
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words.to_pylist()], np.uint64)


BLOCKS = pa.schema([("shard", pa.int32()), ("lang", pa.string()), ("n_words", pa.int64()), ("words", pa.large_binary()), ("hashes", pa.binary()), ("codes", pa.binary())])


def _block_batches(shards: int, size: int):
    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        for rows in pieces(batches, "text", size):
            langs = rows.column("lang")
            for lang in pc.unique(langs).to_pylist():
                words, codes = words_of(rows.column("text").filter(pc.equal(langs, lang)))
                joined = " ".join(words.to_pylist()).encode()
                values = (number % shards, lang, int((codes >= 0).sum()), joined, word_hashes(lang, words).tobytes(), codes.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, BLOCKS, strict=True)], schema=BLOCKS)
            number += 1

    return run


def write_blocks(docs: DataFrame, path: str, lang_col: str, text_col: str, shards: int, size: int) -> None:
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    blocks = rows.mapInArrow(_block_batches(shards, size), "shard int, lang string, n_words long, words binary, hashes binary, codes binary")
    blocks.write.partitionBy("shard").options(**{"parquet.block.size.row.check.min": 4, "compression": "zstd"}).parquet(path)


# --- counting ---------------------------------------------------------------------------------

def joined_hashes(first: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases out of those without the last word and those of the last words."""
    with np.errstate(over="ignore"):
        x = first * np.uint64(0x9E3779B97F4A7C15) + word
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def slots(hashes: np.ndarray, size: int) -> np.ndarray:
    return (hashes % np.uint64(size)).astype(np.int64)


def distinct(codes: np.ndarray, at: np.ndarray, k: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, n): of the phrases of ``k`` words at places ``at`` the place of one occurrence and their number; found by hash, compared by words."""
    kind = pa.array(hashes).dictionary_encode().indices.to_numpy()
    first = np.empty(kind.max() + 1, np.int64)
    first[kind[::-1]] = at[::-1]
    if all((codes[at + i] == codes[first[kind] + i]).all() for i in range(k)):
        return first, np.bincount(kind)
    _, which, n = np.unique(np.stack([codes[at + i] for i in range(k)], 1), axis=0, return_index=True, return_counts=True)
    return at[which], n


def counted(words: pa.Array, hashes: np.ndarray, codes: np.ndarray, since: np.ndarray, step: int, shards: int, longest: int) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray]]:
    """(k, phrases, n, last): counts of a block's phrases that are to be counted in this step, and the step in which their cycle ends."""
    if step < shards and len(words):
        n = np.bincount(codes[codes >= 0], minlength=len(words))
        some = np.flatnonzero(n)
        yield 1, words.take(pa.array(some)), n[some], np.full(len(some), shards - 1)
    word_hash, word_since = np.append(hashes, np.uint64(0)), np.append(since[slots(hashes, len(since))], np.uint8(0))      # the last one stands for -1
    reached = word_since[codes]
    at = np.flatnonzero(reached)
    own, begun = word_hash[codes[at]], reached[at].astype(np.int64)
    for k in range(2, longest + 1):
        j = np.flatnonzero(at[1:] == at[:-1] + 1)
        if not len(j):
            return
        at, begun = at[j], np.maximum(begun[j], begun[j + 1])
        own = joined_hashes(own[j], word_hash[codes[at + k - 1]])
        open_ = step < begun + shards
        if open_.any():
            # begun is the same for all occurrences of a phrase
            first, n = distinct(codes, at[open_], k, own[open_])
            texts = pc.binary_join_element_wise(*(words.take(pa.array(codes[first + i])) for i in range(k)), " ")
            yield k, texts, n, begun[np.searchsorted(at, first)] + shards - 1
        reached = since[slots(own, len(since))]
        keep = reached > 0
        at, own, begun = at[keep], own[keep], reached[keep].astype(np.int64)


COUNTS = "lang string, phrase string, k int, n long, last int"


def _count_batches(packed, step: int, shards: int, longest: int):
    def run(batches):
        since = np.frombuffer(zlib.decompress(packed.value), np.uint8)
        for part in batches:
            for at in range(part.num_rows):
                lang, hashes, codes = (part.column(c)[at] for c in ("lang", "hashes", "codes"))
                lang, hashes, codes = lang.as_py(), np.frombuffer(hashes.as_buffer(), np.uint64), np.frombuffer(codes.as_buffer(), np.int32)
                words = pc.split_pattern(part.column("words").slice(at, 1).cast(pa.string()), " ").flatten() if len(hashes) else pa.array([], pa.string())
                for k, texts, n, last in counted(words, hashes, codes, since, step, shards, longest):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang]).take(pa.array(np.zeros(len(n), np.int8))), texts, pa.array(np.full(len(n), k, np.int32)), pa.array(n, pa.int64()), pa.array(last, pa.int32()),
                    ], names=["lang", "phrase", "k", "n", "last"])

    return run


def _slot_batches(size: int):
    """(page, slot, since) of phrases."""
    def run(batches):
        for part in batches:
            out = []
            for lang, phrase in zip(part.column("lang").to_pylist(), part.column("phrase").to_pylist(), strict=True):
                own, *others = word_hashes(lang, pa.array(phrase.split(" ")))[:, None]
                for word in others:
                    own = joined_hashes(own, word)
                out.append(slots(own, size)[0])
            at = np.array(out, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> PAGE_BITS), pa.array(at & ((1 << PAGE_BITS) - 1)), part.column("since")], names=["page", "slot", "since"])

    return run


def _page(rows: pa.Table) -> pa.Table:
    page = np.zeros(1 << PAGE_BITS, np.uint8)
    page[rows["slot"].to_numpy()] = rows["since"].to_numpy()
    return pa.table({"page": rows["page"][:1], "bytes": pa.array([zlib.compress(page.tobytes(), 1)], pa.binary())})


def mark(since: np.ndarray, new: DataFrame) -> None:
    """Enters newly reached phrases (lang, phrase, since) into the map; a slot keeps the latest step.

    Slots are made distinct before they meet, so a page's group has one row for each of its slots at most, and the driver gets the pages.
    """
    entries = new.mapInArrow(_slot_batches(len(since)), "page long, slot long, since int").groupBy("page", "slot").agg(F.max("since").alias("since"))
    for row in entries.groupBy("page").applyInArrow(_page, "page long, bytes binary").collect():
        at = row["page"] << PAGE_BITS
        page = np.frombuffer(zlib.decompress(row["bytes"]), np.uint8)[:len(since) - at]
        np.maximum(since[at:at + len(page)], page, out=since[at:at + len(page)])


def merged(state: DataFrame | None, counts: DataFrame, step: int, shards: int, threshold: int) -> DataFrame:
    """The state (lang, phrase, k, total, seen, last, since) after a step's counts; ``seen`` has a bit for each shard that is in the total."""
    new = counts.select("lang", "phrase", "k", F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("seen"), "last", F.lit(None).cast("int").alias("since"), "n")
    rows = new if state is None else state.withColumn("n", F.lit(0).cast("long")).unionByName(new)
    bit = F.lit(1 << step % shards).cast("long")
    once = rows.groupBy("lang", "phrase").agg(F.max("k").alias("k"), F.sum("total").alias("total"), F.bit_or("seen").alias("seen"), F.max("last").alias("last"), F.max("since").alias("since"), F.sum("n").alias("n"))
    fresh = (F.col("n") > 0) & (F.col("seen").bitwiseAND(bit) == 0)
    total = F.col("total") + F.when(fresh, F.col("n")).otherwise(0)
    out = once.select("lang", "phrase", "k", total.alias("total"), F.when(fresh, F.col("seen").bitwiseOR(bit)).otherwise(F.col("seen")).alias("seen"), "last", "since")
    out = out.withColumn("since", F.when(F.col("total") >= threshold, F.coalesce("since", F.lit(step + 1))))
    return out.where((F.col("total") >= threshold) | (F.col("last") > step))


def frequent_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", threshold: int = THRESHOLD, longest: int = LONGEST,
                     shards: int = SHARDS, slot_bits: int = SLOT_BITS, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, total) of all phrases with ``threshold`` occurrences or more, words included, and (lang, n) with the number of all words."""
    spark = docs.sparkSession
    if not 1 <= shards <= 40:
        raise ValueError("from 1 to 40 shards")
    path = new_path(spark, "phrase-blocks")
    write_blocks(docs, path, lang_col, text_col, shards, block_bytes)
    blocks = spark.read.schema("lang string, n_words long, words binary, hashes binary, codes binary, shard int").parquet(path)
    since, state, held = np.zeros(1 << slot_bits, np.uint8), None, None
    step, end = 0, shards
    while step < end:
        packed = spark.sparkContext.broadcast(zlib.compress(since.tobytes(), 1))
        shard = blocks.where(F.col("shard") == step % shards).select("lang", "words", "hashes", "codes")
        counts = shard.mapInArrow(_count_batches(packed, step, shards, longest), COUNTS)
        held, before = new_path(spark, f"phrases-{step}"), held
        merged(state, counts, step, shards, threshold).write.parquet(held)
        state = spark.read.schema("lang string, phrase string, k int, total long, seen long, last int, since int").parquet(held)
        if before:
            discard(spark, before)
        new = state.where((F.col("since") == step + 1) & (F.col("k") < longest))
        if not new.isEmpty():
            mark(since, new.select("lang", "phrase", "since"))
            end = max(end, step + 1 + shards)
        step += 1
    sizes = blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return state.select("lang", "phrase", "k", "total"), sizes


# --- collocations -----------------------------------------------------------------------------

def _joined(words: Column, first, length) -> Column:
    return F.array_join(F.slice(words, first, length), " ")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", threshold: int = THRESHOLD, longest: int = LONGEST, top: int = TOP, **options) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of two or more words.

    A phrase is scored by the cut where its parts are least bound, and left out if a longer one occurs as often.
    A null language is ``und``, a null text empty; texts of any length are read whole; repeated rows count each time;
    ties go to the smallest cut, then to the larger ``a``, then to the phrase first in byte order; other columns are ignored; no rows: no rows.
    """
    spark = docs.sparkSession
    found, sizes = frequent_phrases(docs, lang_col, text_col, threshold, longest, **options)
    words = F.split("phrase", " ")
    # a longer phrase that occurs as often has a part one word longer than the phrase that does too
    inner = F.explode(F.array(_joined(words, 1, F.col("k") - 1), _joined(words, 2, F.col("k") - 1)))
    over = found.where("k > 2").select("lang", inner.alias("phrase"), "total").groupBy("lang", "phrase").agg(F.max("total").alias("over"))
    kept = found.where("k > 1").join(over, ["lang", "phrase"], "left").where("over is null or over < total").select("lang", "phrase", "k", F.col("total").alias("a"))
    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.withColumns({"head": _joined(words, 1, F.col("cut")), "rest": _joined(words, F.col("cut") + 1, F.col("k") - F.col("cut"))})
    parts = cuts.join(found.select("lang", F.col("phrase").alias("head"), F.col("total").alias("l")), ["lang", "head"])
    parts = parts.join(found.select("lang", F.col("phrase").alias("rest"), F.col("total").alias("r")), ["lang", "rest"]).join(sizes, "lang")
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "n", "l", "r")}
    parts = parts.withColumns({"above": F.lit(1000).cast("decimal(4,0)") * wide["a"] * wide["n"], "below": wide["l"] * wide["r"]})
    # 38 digits hold both products up to 10^17 words
    scored = parts.withColumn("score", F.expr("above div below"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("b")).select("lang", "phrase", "b.*")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    some = best.withColumn("part", part).withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", *(F.col(c).cast("long").alias(c) if c != "phrase" else F.col(c) for c in ("rank", "phrase", "a", "l", "r", "n", "score")))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {"op12_phrase_collocations": op12_phrase_collocations}
ORACLES = {
    "op12_phrase_collocations": r"""
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
        p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
        w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM p),
        g AS (SELECT lang, k, unnest([array_to_string(words[i:i + k - 1], ' ') for i in range(1, len(words) - k + 2)]) AS phrase
              FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(words) >= k),
        n AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
        f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
        c AS (SELECT * FROM f s WHERE k > 1 AND NOT EXISTS (
                  SELECT 1 FROM f t WHERE t.lang = s.lang AND t.k > s.k AND t.a >= s.a AND contains(' ' || t.phrase || ' ', ' ' || s.phrase || ' '))),
        x AS (SELECT lang, phrase, a, cut, string_split(phrase, ' ') AS words, k FROM c, (SELECT unnest([1, 2, 3, 4]) AS cut) WHERE cut < k),
        y AS (SELECT x.lang, x.phrase, x.a, cut, h.a AS l, r.a AS r, n.n, (1000::HUGEINT * x.a * n.n) // (h.a::HUGEINT * r.a) AS score
              FROM x JOIN n ON n.lang = x.lang JOIN f h ON h.lang = x.lang AND h.phrase = array_to_string(words[1:cut], ' ')
              JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(words[cut + 1:], ' ')),
        z AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS o FROM y),
        q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z WHERE o = 1)
        SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM q WHERE rank <= 2000"""
}
