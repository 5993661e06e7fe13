"""Token ids in binary files whose document boundaries are Elias-Fano encoded.

Documents are put in ascending order of their id by range partitions, encoded,
and cut into shards of whole documents. A shard is one file:

======================  ==============================================================
8 bytes                 magic
8 bytes, big-endian     ids of all documents in the files before it
8 x 8 bytes             documents, documents without an id (first), ids, bytes of an
                        id, smallest document id, three lengths of the sections below
section 1               document ids less the smallest, Elias-Fano
section 2               ends of documents in the shard's ids, Elias-Fano
section 3               all ids, concatenated, in 2 or 4 bytes each, little-endian
1 byte                  line feed
======================  ==============================================================

An Elias-Fano sequence of n values up to u keeps floor(log2(u/n)) low bits of
each value as they are and the rest in unary: value number i sets bit
(value >> low) + i of a bit array. That is about two bits a value more than the
least possible. ``select`` finds the i-th set bit from a hint kept for every
``HINT`` values, so no table of 64-bit offsets exists on disk or in memory.

A file's name has no meaning; the header says where it belongs. A vocabulary of
words is looked up by short runs: no match of its split pattern crosses white space,
and its normalizer composes nothing across it, so a text's ids are those of its
runs. Other vocabularies encode whole texts.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..literals import literal_table
from ..storage import new_path
from .batches import pieces, table
from .packing import byte_of_letter

MAGIC = b"EFTOKEN1"
#: Ids of a file, reached by whole documents; values between two select hints.
SHARD_IDS, HINT = 1 << 20, 512
#: Id that ends a document; words a worker remembers.
END, REMEMBERED = 1, 600_000
# The pipeline of a vocabulary of lower-case words, as its file states it.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
PIPELINE = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": CONTRACTIONS + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None, "truncation": None, "padding": None,
}
MODEL = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None}
#: Kinds of bytes: letters, punctuation that no contraction or special token holds, white space, others.
LETTER, SIGN, WHITE = 1, 2, 8
KINDS = np.array([LETTER if chr(b).isascii() and chr(b).isalpha() else SIGN if chr(b) in "!\"#$%&()*+,-./:;=?@[\\]^_`{}~" else WHITE if b in b"\t\n\v\f\r " else 0 for b in range(256)], np.uint8)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: Runs that need no normalization but lower case, such that are one part, and parts.
LETTERS = re.compile("[a-zß-öø-ÿ]+")
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PARTS = re.compile(CONTRACTIONS + "|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
HEAD = struct.Struct("<QQQQqQQQ")
SEQUENCE = struct.Struct("<QQQQ")


# --- monotone sequences -----------------------------------------------------------------------

def encode_monotone(values: np.ndarray) -> bytes:
    """Elias-Fano code of a non-decreasing sequence of unsigned 64-bit numbers."""
    n = len(values)
    top = int(values[-1]) if n else 0
    low = max(0, (top // n).bit_length() - 1) if n else 0
    values = values.astype(np.uint64)
    bits = ((values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    high = np.zeros(-(-(int(ones[-1]) + 1) // 8) if n else 0, np.uint8)
    np.bitwise_or.at(high, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
    lows, hints = np.packbits(bits, bitorder="little").tobytes(), ones[::HINT].astype("<u4" if n and ones[-1] < 1 << 32 else "<u8")
    return SEQUENCE.pack(n, low, hints.itemsize, len(high)) + hints.tobytes() + lows + high.tobytes()


class Monotone:
    """A sequence read from its code; values are computed when asked for."""

    def __init__(self, code: bytes | memoryview):
        self.n, self.low, width, size = SEQUENCE.unpack_from(code)
        at, count = SEQUENCE.size, -(-self.n // HINT)
        self.hints = np.frombuffer(code, f"<u{width}", count, at)
        at += width * count
        self.lows = np.frombuffer(code, np.uint8, -(-self.n * self.low // 8), at)
        self.high = np.frombuffer(code, np.uint8, size, at + len(self.lows))

    def select(self, first: int, stop: int) -> np.ndarray:
        """Places of the set bits number ``first`` to ``stop`` - 1; reads the bytes from the hint before to the hint after only."""
        begin = int(self.hints[first // HINT]) >> 3
        after = -(-stop // HINT)
        end = (int(self.hints[after]) >> 3) + 1 if after < len(self.hints) else len(self.high)
        places = np.flatnonzero(np.unpackbits(self.high[begin:end], bitorder="little")) + 8 * begin
        known = first // HINT * HINT
        places = places[places >= int(self.hints[first // HINT])]
        return places[first - known:stop - known]

    def values(self, first: int = 0, stop: int | None = None) -> np.ndarray:
        stop = self.n if stop is None else stop
        if first >= stop:
            return np.zeros(0, np.uint64)
        high = (self.select(first, stop) - np.arange(first, stop)).astype(np.uint64) << np.uint64(self.low)
        if not self.low:
            return high
        begin = first * self.low
        bits = np.unpackbits(self.lows[begin >> 3:-(-stop * self.low // 8)], bitorder="little")[begin & 7:][:(stop - first) * self.low]
        weights = np.uint64(1) << np.arange(self.low, dtype=np.uint64)
        return high | (bits.reshape(-1, self.low) * weights).sum(1, dtype=np.uint64)

    def __getitem__(self, k: int) -> int:
        return int(self.values(k, k + 1)[0])


# --- shards -----------------------------------------------------------------------------------

def shard_body(doc_ids: np.ndarray, nulls: int, ends: np.ndarray, ids: np.ndarray) -> bytes:
    """All of a file after the place of its first id; ``doc_ids`` are those that are there, ascending, after ``nulls`` documents without one."""
    least = int(doc_ids[0]) if len(doc_ids) else 0
    sections = [encode_monotone(doc_ids.astype(np.uint64) - np.uint64(least % (1 << 64))), encode_monotone(ends), ids.tobytes()]
    return HEAD.pack(len(ends), nulls, len(ids), ids.itemsize, least, *map(len, sections)) + b"".join(sections)


class Shard:
    """One file's documents."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        self.first = int.from_bytes(data[8:16], "big")
        self.documents, self.nulls, total, width, self.least, *sizes = HEAD.unpack_from(data, 16)
        view, at, parts = memoryview(data), 16 + HEAD.size, []
        for size in sizes:
            if at + size > len(data):
                raise ValueError("token file is cut off")
            parts.append(view[at:at + size])
            at += size
        self.known, self.ends, self.ids = Monotone(parts[0]), Monotone(parts[1]), np.frombuffer(parts[2], f"<u{width}", total)

    def bounds(self, first: int = 0, stop: int | None = None) -> np.ndarray:
        """Where documents ``first`` to ``stop`` - 1 start in the shard's ids, and where the last one ends."""
        stop = self.documents if stop is None else stop
        ends = self.ends.values(max(0, first - 1), stop).astype(np.int64)
        return ends if first else np.concatenate([[0], ends])

    def doc_ids(self) -> list[int | None]:
        known = (self.known.values() + np.uint64(self.least % (1 << 64))).astype(np.int64)
        return [None] * self.nulls + known.tolist()

    def tokens(self, k: int) -> np.ndarray:
        """Ids of document number ``k``, found by two selects."""
        first, stop = self.bounds(k, k + 1)
        return self.ids[first:stop]


def letter_of_byte() -> dict[int, str]:
    """The letter that stands for a byte in a byte-level vocabulary."""
    return {byte: letter for letter, byte in byte_of_letter().items()}


# --- encoding ---------------------------------------------------------------------------------

class WholeTexts:
    """Encoder for any vocabulary file: each text goes through the library as a whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): all ids of the texts, each with its end, and where each text ends."""
        found = [[*e.ids, END] for e in self.tokenizer.encode_batch_fast(pc.fill_null(texts, "").to_pylist(), add_special_tokens=False)]
        ends = np.cumsum([len(x) for x in found])
        return np.fromiter((i for ids in found for i in ids), self.width, int(ends[-1])), ends


def runs_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(runs, stops): parts of the texts, without white space, between which no pre-token can lie, and the number of runs up to each text's end.

    Runs end at white space and where a letter of ASCII or Latin-1 meets ASCII punctuation; letters
    are in lower case unless a special token may be there.
    """
    texts = pc.fill_null(texts, "")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    begins, ends = (offsets - offsets[0])[:-1], (offsets - offsets[0])[1:]
    if not len(data):
        return pa.array([], pa.string()), np.zeros(len(ends), np.int64)
    kind = KINDS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    second = data[lead + 1]
    letter = (second != 0x97) & (second != 0xB7)                    # not the signs of multiplication and division
    kind[lead[letter]] = kind[lead[letter] + 1] = LETTER
    if data.tobytes().find(b"<|") < 0:
        data = LOWER[data]
        data[lead[letter & (second <= 0x9E)] + 1] += 0x20
    new = np.ones(len(data), bool)
    new[1:] = (kind[:-1] == WHITE) | (kind[1:] + kind[:-1] == LETTER + SIGN)
    new[begins[begins < ends]] = True
    keep = kind != WHITE
    new &= keep
    kept = data[keep]
    at = np.append(np.flatnonzero(new[keep]), len(kept)).astype(np.int32)
    runs = pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(kept)])
    return runs, np.append(0, np.cumsum(new))[ends]


class Words(WholeTexts):
    """Encoder that remembers the ids of runs, up to a bound: run number k of ``known`` has ``flat[starts[k]:starts[k + 1]]``.

    Runs of ASCII and Latin-1 letters are split here, as the library's pipeline would, and
    only their parts go to its model; other runs go through the whole pipeline.
    """

    def __init__(self, path: str, bound: int = REMEMBERED):
        super().__init__(path)
        self.bound = bound
        self.bytes = str.maketrans({chr(c): "".join(map(letter_of_byte().__getitem__, chr(c).encode())) for c in range(256)})
        self.clear()

    def clear(self) -> None:
        # number 0 ends a document; no run is white space
        self.known, self.flat, self.starts = pa.array([" "]), np.array([END], self.width), np.array([0, 1])

    def split(self, run: str) -> list[int]:
        parts = [run] if LETTERS.fullmatch(run) else PARTS.findall(run.lower())
        found = [self.tokenizer.model.tokenize(p if p.isascii() else p.translate(self.bytes)) for p in parts]
        return [t.id for part in found for t in part]

    def numbers(self, runs: pa.Array) -> np.ndarray:
        if len(self.known) > self.bound:
            self.clear()
        where = pc.index_in(runs, self.known)
        if where.null_count:
            new = runs.filter(where.is_null())
            texts = new.to_pylist()
            odd = [w for w in texts if not PLAIN.fullmatch(w) or "<|" in w]
            whole = {w: e.ids for w, e in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False), strict=True)}
            found = [whole[w] if w in whole else self.split(w) for w in texts]
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), self.width, int(lengths.sum()))])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
            self.known = pa.concat_arrays([self.known, new])
            fresh = np.cumsum(where.is_null().to_numpy(zero_copy_only=False)) + len(self.known) - len(new) - 1
            return pc.if_else(where.is_null(), pa.array(fresh.astype(np.int32)), where).to_numpy(zero_copy_only=False)
        return where.to_numpy()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        runs, stops = runs_of(texts)
        coded = runs.dictionary_encode()
        numbers = self.numbers(coded.dictionary)[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int32)
        numbers = np.insert(numbers, stops, 0)
        stops = stops + np.arange(1, len(stops) + 1)
        begins, lengths = self.starts[numbers], np.diff(self.starts)[numbers]
        after = np.cumsum(lengths)
        ids = self.flat[np.repeat(begins - after + lengths, lengths) + np.arange(after[-1] if len(after) else 0)]
        return ids, after[stops - 1]


@cache
def encoder_of(path: str) -> WholeTexts:
    """One per worker process; words are looked up only if the file states the pipeline that this holds for."""
    with open(path, encoding="utf-8") as file:
        stated = json.load(file)
    special = all(not t["lstrip"] and not t["rstrip"] and not t["normalized"] and t["content"].startswith("<|") and not any(map(str.isspace, t["content"])) for t in stated["added_tokens"])
    same = special and all(stated[k] == v for k, v in PIPELINE.items()) and all(stated["model"].get(k) == v for k, v in MODEL.items())
    return (Words if same else WholeTexts)(path)


SHARDS = pa.schema([("part", pa.int64()), ("earlier", pa.int64()), ("n_ids", pa.int64()), ("body", pa.binary())])


def _shard_batches(path: str, size: int):
    def run(batches):
        from pyspark import TaskContext

        part, earlier, encoder = TaskContext.get().partitionId(), 0, encoder_of(path)
        held, docs, total = [], [], 0

        def flush():
            nonlocal held, docs, total, earlier
            known = pa.chunked_array(docs, pa.int64()).combine_chunks()
            ends = np.cumsum(np.concatenate([np.diff(e, prepend=0) for _, e in held]))
            body = shard_body(known.drop_null().to_numpy(zero_copy_only=False), known.null_count, ends, np.concatenate([i for i, _ in held]))
            out = pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((part, earlier, total, body), SHARDS, strict=True)], schema=SHARDS)
            held, docs, total, earlier = [], [], 0, earlier + total
            return out

        for rows in pieces(batches, "text"):
            ids, ends = encoder.encode(rows.column("text"))
            done = begin = 0
            while done < len(ends):
                stop = min(len(ends), int(np.searchsorted(ends, begin + size - total)) + 1)
                held.append((ids[begin:ends[stop - 1]], ends[done:stop] - begin))
                docs.append(rows.column("doc_id").slice(done, stop - done))
                total += int(ends[stop - 1]) - begin
                done, begin = stop, int(ends[stop - 1])
                if total >= size:
                    yield flush()
        if total:
            yield flush()

    return run


def write_tokens(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Writes the ids of all documents as files below ``path``, in ascending order of their document id.

    Null and empty texts, and such of white space alone, are a single end id. Documents without an id come
    first. Repeated ids and rows are all kept; equal ids are in an order of their own, by a digest of the text,
    so that one id with many rows is dealt over many tasks. A text of any length lies whole in one file. Other
    columns are ignored. No rows: no files.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("row"))
    keys = [F.asc_nulls_first("doc_id"), "tie", "row"]
    sorted_rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    held = new_path(spark, "token-shards")
    shards = sorted_rows.mapInArrow(_shard_batches(tokenizer, shard_ids), "part long, earlier long, n_ids long, body binary")
    shards.write.option("parquet.block.size.row.check.min", 4).parquet(held)
    shards = spark.read.parquet(held)
    before, offsets = 0, []
    for part, n in sorted(tuple(r) for r in shards.groupBy("part").agg(F.sum("n_ids")).collect()):      # one row for each task
        offsets.append((part, before))
        before += n
    if not offsets:
        offsets = [(-1, 0)]
    # one row for each task, so this side is sent to the tasks and no body is shuffled
    placed = shards.join(literal_table(spark, ["part", "shift"], offsets), "part").withColumn("first", F.col("earlier") + F.col("shift"))
    head = F.concat(F.lit(MAGIC), F.unhex(F.lpad(F.hex("first"), 16, "0")))
    placed.select(F.concat(head, "body").cast("string").alias("value")).write.options(maxRecordsPerFile=1, lineSep="\n").text(path)


READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def _each_document(make, schema: pa.Schema):
    """Per file one batch of rows (doc_id, start, n_tokens, ``make`` of the ids as little-endian 32-bit numbers)."""
    def run(batches):
        for part in batches:
            for data in part.column("content"):
                if not data.as_py():
                    continue                # a task without rows leaves an empty file
                shard = Shard(data.as_py())
                bounds = shard.bounds()
                out = [make(shard.ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(shard.doc_ids(), pa.int64()), pa.array(bounds[:-1] + shard.first, pa.int64()), pa.array(np.diff(bounds), pa.int64()), pa.array(out, schema.field(3).type),
                ], schema=schema)

    return run


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): one row per document of the files below ``path``; ids are little-endian 32-bit numbers."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_each_document(bytes, READ), "doc_id long, start long, n_tokens long, ids binary")


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the files below ``path``."""
    schema = pa.schema([*(READ.field(k) for k in range(3)), pa.field("ids_crc32", pa.int64())])
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_each_document(zlib.crc32, schema), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_path(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return checksums(spark, path)


QUERIES = {"op13_token_files": op13_token_files}
