"""Best-fit packing by linear grouping.

Documents become pieces of at most ``CAPACITY`` tokens.  How many pieces have
which length is a table of ``CAPACITY`` numbers, whatever the corpus size; the
whole plan is made from it on the driver.  Large lengths are sorted and cut into
groups of equal cardinality, each rounded up to its longest member.  For these
few sizes fillings ("configurations") are chosen, each the fullest one the
remaining pieces allow, and used as often as they allow.  Then actual lengths
take the places of rounded ones, longest first, which opens gaps; small pieces
go, longest first, into the fullest place they fit.

A place is written as a run: pieces of one length with consecutive ranks lie at
one offset of consecutive sequences.  Each task looks its pieces up by length
and rank; the ranks come from counts per written file part.
"""

from __future__ import annotations

import bisect
import json
import os
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..storage import materialize
from .batches import pieces, table
from .bpe import ChunkEncoder

#: Tokens of a sequence, number of equal groups of large pieces, shortest large piece.
CAPACITY, GROUPS, LARGE = 2048, 512, 2048 // 3 + 1
#: Chunks of text whose ids a worker remembers.
REMEMBERED = 500_000
#: Token id that ends a document.
END = 0
# Fixed value: the split pattern of byte-level vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# What a file states whose ids are those of plain byte-level pairs, special tokens apart.
PLAIN = {"normalizer": None, "post_processor": None, "truncation": None, "padding": None}
PRE_TOKENIZER = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "byte_fallback": False, "ignore_merges": False}


# --- plan over a histogram of lengths --------------------------------------------------------

def linear_groups(counts: dict[int, int], groups: int) -> list[tuple[int, int]]:
    """(size, count), largest first: equal shares of the sorted lengths, rounded up to the longest of each."""
    total = sum(counts.values())
    if not total:
        return []
    share = -(-total // groups)
    out: list[list[int]] = []
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not out or out[-1][1] == share:
                out.append([length, 0])
            take = min(left, share - out[-1][1])
            out[-1][1] += take
            left -= take
    merged: dict[int, int] = defaultdict(int)
    for size, n in out:
        merged[size] += n
    return sorted(merged.items(), reverse=True)


def fullest(sizes: list[int], left: list[int], first: int, capacity: int) -> list[int]:
    """How many of each size fill a sequence best that holds one piece of size ``first``."""
    room = capacity - sizes[first]
    reach: dict[int, tuple[int, ...]] = {0: ()}      # filled amount -> sizes used, by index
    for k in range(first, len(sizes)):
        most = left[k] - (k == first)
        if most <= 0 or sizes[k] > room:
            continue
        for filled, used in sorted(reach.items(), reverse=True):
            now, parts = filled, used
            for _ in range(min(most, (room - filled) // sizes[k])):
                now, parts = now + sizes[k], (*parts, k)
                if now in reach:
                    break
                reach[now] = parts
        if room in reach:
            break
    best = [0] * len(sizes)
    for k in (first, *reach[max(reach)]):
        best[k] += 1
    return best


def configurations(groups: list[tuple[int, int]], capacity: int) -> list[tuple[list[int], int]]:
    """(pieces of each size, times used), covering all groups exactly."""
    sizes, left = [s for s, _ in groups], [n for _, n in groups]
    out = []
    for first in range(len(sizes)):
        while left[first] > 0:
            config = fullest(sizes, left, first, capacity)
            times = min(left[k] // n for k, n in enumerate(config) if n)
            for k, n in enumerate(config):
                left[k] -= n * times
            out.append((config, times))
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: int = LARGE) -> tuple[dict[int, list[tuple[int, int, int, int]]], int]:
    """Runs (first rank, number, first sequence, offset) by length, and the number of sequences."""
    runs: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    sequences = 0

    def place(length: int, number: int, sequence: int, offset: int) -> None:
        runs[length].append((taken[length], number, sequence, offset))
        taken[length] += number

    full = histogram.get(capacity, 0)
    if full:
        place(capacity, full, 0, 0)
        sequences = full
    big = {n: c for n, c in histogram.items() if large <= n < capacity}
    rounded = linear_groups(big, groups)
    stock = [[n, big[n]] for n in sorted(big, reverse=True)]        # actual lengths, longest first
    by_group: list[list[list[int]]] = []
    at = 0
    for _, number in rounded:
        mine = []
        while number:
            take = min(number, stock[at][1])
            mine.append([stock[at][0], take])
            stock[at][1] -= take
            number -= take
            at += stock[at][1] == 0
        by_group.append(mine)
    open_runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # filled -> (first sequence, number)
    for config, times in configurations(rounded, capacity):
        parts = [(sequences, times, 0)]                               # (first sequence, number, filled)
        for k, repeat in enumerate(config):
            for _ in range(repeat):
                split = []
                for sequence, number, filled in parts:
                    while number:
                        length, there = by_group[k][0]
                        take = min(number, there)
                        place(length, take, sequence, filled)
                        split.append((sequence, take, filled + length))
                        by_group[k][0][1] -= take
                        if take == there:
                            by_group[k].pop(0)
                        sequence, number = sequence + take, number - take
                parts = split
        for sequence, number, filled in parts:
            open_runs[filled].append((sequence, number))
        sequences += times
    levels = sorted(open_runs)
    for length in sorted((n for n in histogram if n < large), reverse=True):
        number = histogram[length]
        while number:
            k = bisect.bisect_right(levels, capacity - length) - 1    # the fullest that still has room
            if k < 0:
                many = capacity // length
                new = -(-number // many)
                open_runs[0].append((sequences, new))
                levels.insert(0, 0)
                sequences += new
                k = 0
            filled = levels[k]
            sequence, there = open_runs[filled].pop()
            take = min(number, there)
            place(length, take, sequence, filled)
            number -= take
            if there > take:
                open_runs[filled].append((sequence + take, there - take))
            if not open_runs[filled]:
                del open_runs[filled]
                levels.pop(k)
            if filled + length not in open_runs:
                bisect.insort(levels, filled + length)
            open_runs[filled + length].append((sequence, take))
    return dict(runs), sequences


# --- documents to pieces ---------------------------------------------------------------------

def byte_of_letter() -> dict[str, int]:
    """Which byte a letter of a byte-level vocabulary stands for: printable Latin-1 for itself, the others in order from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def byte_level_ranks(stated: dict) -> dict[bytes, int] | None:
    """Ids by bytes, if a vocabulary file holds byte-level pairs and nothing else: each merge makes the next id. None for any other file."""
    model, letters = stated["model"], byte_of_letter()
    plain = all(stated.get(k) == v for k, v in PLAIN.items()) and all((stated["pre_tokenizer"] or {}).get(k) == v for k, v in PRE_TOKENIZER.items())
    if not plain or not all(model.get(k) == v for k, v in MODEL.items()):
        return None
    vocabulary, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    special = {t["content"] for t in stated["added_tokens"]}
    words = {token: n for token, n in vocabulary.items() if token not in special}
    in_order = len(words) == 256 + len(merges) and all(words.get(a + b) == 256 + n for n, (a, b) in enumerate(merges))
    if not in_order or not all(letter in letters for token in words for letter in token) or {words.get(letter) for letter in letters} != set(range(256)):
        return None
    return {bytes(letters[c] for c in token): n for token, n in words.items()}


class TextEncoder:
    """Ids of whole texts, little-endian 32-bit, as the tokenizers library gives them.

    With a file of plain byte-level pairs, chunks go through the tiktoken library, which
    builds no alignment and takes half the time; texts in which a special token of the
    file stands, and other files, go through the tokenizers library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        self.special = [t["content"] for t in stated["added_tokens"]]
        ranks = byte_level_ranks(stated)
        self.chunks = None
        if ranks is not None:
            import tiktoken

            self.chunks = ChunkEncoder(tiktoken.Encoding("pieces", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, REMEMBERED)

    def __call__(self, text: str) -> bytes:
        if self.chunks is None or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.chunks(text)


@cache
def _encoder(path: str) -> TextEncoder:
    """One per worker process."""
    return TextEncoder(path)


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int64()), ("local", pa.int64())])


def token_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece; ``local`` is its rank among the pieces of its length in the task, ``part`` names the task.

    Only a document of more than ``CAPACITY`` tokens is cut; its first piece takes what is left over.
    """
    def run(batches):
        from pyspark import TaskContext

        part_id = TaskContext.get().partitionId()
        encode = _encoder(path)
        seen = np.zeros(CAPACITY + 1, np.int64)
        end = END.to_bytes(4, "little")
        for part in pieces(batches, "text"):
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                ids = memoryview(encode(text or "") + end)
                total = len(ids) // 4
                start, piece = 0, 0
                while start < total:
                    length = (total - 1) % CAPACITY + 1 if piece == 0 else CAPACITY
                    crc = zlib.crc32(ids[4 * start:4 * (start + length)])
                    rows.append((doc_id, piece, start, length, crc, part_id, int(seen[length])))
                    seen[length] += 1
                    start, piece = start + length, piece + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PIECES, strict=True)], schema=PIECES)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, part long, local long"
    )


OUT = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents as pieces with their sequence and place in it.

    Null and empty texts are a single end token; a text of any length is encoded whole and cut into
    pieces. Ties of length go by the order of the written parts. Repeated rows and ids are
    packed like others; other columns are ignored; no rows: no pieces.
    """
    cut = materialize(token_pieces(docs, path, id_col, text_col), "pieces")
    counts = materialize(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}    # CAPACITY rows at most
    runs, _ = plan(histogram)
    lookup = {n: tuple(np.array(c, np.int64) for c in zip(*r, strict=True)) for n, r in runs.items()}
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    firsts = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def run(batches):
        for part in batches:
            length, rank = part.column("length").to_numpy(), part.column("rank").to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for n in np.unique(length):
                at = length == n
                first, _, start, place = lookup[int(n)]
                k = np.searchsorted(first, rank[at], side="right") - 1
                sequence[at], offset[at] = start[k] + rank[at] - first[k], place[k]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in PIECES.names[:5]), pa.array(sequence), pa.array(offset)], names=[*PIECES.names[:5], "sequence_id", "offset"])

    ranked = cut.join(firsts, ["part", "length"]).select(*PIECES.names[:5], (F.col("base") + F.col("local")).alias("rank"))
    return ranked.mapInArrow(run, OUT)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of the documents that are left."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {"op10_best_fit_packing": op10_best_fit_packing}
