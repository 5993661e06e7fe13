"""Byte-level BPE with a segment tree over byte positions, and decoding.

A leaf of the tree belongs to the byte at which a live part of the piece starts
and holds the rank of the pair of this part and its right neighbour; an inner
node holds the leftmost smallest rank of its ``FAN`` children.  A merge takes the
root, joins the two parts and updates at most three leaves, each in logarithmic
time, so a piece of n bytes costs n log n however long it is.
"""

from __future__ import annotations

import base64
import re
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import pieces, sha256_hex, table

#: Children of an inner node of the segment tree.
FAN = 16
#: Longest chunk of text whose ids are remembered, and how many are.
MEMO_CHARS, MEMO_SIZE = 40, 1_000_000
#: A space between two characters that are no white space; a match of the split pattern never crosses it.
ENDED = re.compile(r"(\w*[^\W\d_])([^\w\s]{1,8})")
SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: again and again the leftmost pair of lowest rank is merged."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    none = 1 << 62
    after = list(range(1, n + 1))                    # start of the next live part
    before = list(range(-1, n - 1))
    rank = ranks.get
    # equal ranks: the leftmost is smaller, as a leaf holds its place too
    pairs = [rank(piece[i:i + 2]) for i in range(n - 1)]
    leaves = [none if found is None else found * size + i for i, found in enumerate(pairs)]
    levels = [leaves]
    while len(levels[-1]) > FAN:
        below = levels[-1]
        levels.append([min(below[k:k + FAN]) for k in range(0, len(below), FAN)])
    root = levels[-1]
    while (top := min(root)) < none:
        i = top & (size - 1)
        j = after[i]
        after[i] = end = after[j]
        right = None
        if end < n:
            before[end] = i
            right = rank(piece[i:after[end]])
            leaves[j] = none
        leaves[i] = none if right is None else right * size + i
        h = before[i]
        if h >= 0:
            left = rank(piece[h:end])
            leaves[h] = none if left is None else left * size + h
        for k in (j, i, h) if root is not leaves else ():
            if not 0 <= k < n - 1:
                continue
            for below, level in zip(levels, levels[1:], strict=False):    # up as long as something changes
                k //= FAN
                low = min(below[k * FAN:k * FAN + FAN])
                if level[k] == low:
                    break
                level[k] = low
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


class Memo(dict):
    """Ids, as unsigned 32-bit bytes (little-endian on all machines Spark runs on), of chunks of text between safe spaces.

    When half of the bound is reached, what is held becomes the older half; what
    is asked for again returns from there, so frequent chunks stay.
    """

    def __init__(self, encode, lead: str):
        super().__init__()
        self.encode, self.lead, self.older = encode, lead, {}

    def __missing__(self, part: str) -> bytes | None:
        if part in self.older:
            out = self.older[part]
        elif not part or part[0].isspace() or part[-1].isspace():
            out = None                               # the split at single spaces does not hold here
        else:
            out = self.fresh(part)
        if len(part) <= MEMO_CHARS:
            self[part] = out
        return out

    def fresh(self, part: str) -> bytes:
        return array("I", self.encode(self.lead + part)).tobytes()

    def turn(self, bound: int) -> None:
        if len(self) > bound // 2:
            self.older = dict(self)
            self.clear()


class Chunks(Memo):
    """Chunks, put together from parts that no match of the pattern crosses.

    Such borders are those between a letter and punctuation, and both sides of a
    line feed between characters that are no white space.
    """

    def __init__(self, encode, lead: str, starts: Chunks | None = None):
        super().__init__(encode, lead)
        self.tails, self.starts = Memo(encode, ""), self if starts is None else starts
        self.feed = array("I", encode("\n")).tobytes()

    def fresh(self, part: str) -> bytes:
        if "\n" in part:
            head, *lines = part.split("\n")
            parts = [self[head], *map(self.starts.__getitem__, lines)]
            return super().fresh(part) if None in parts else self.feed.join(parts)
        ended = ENDED.fullmatch(part)
        return self[ended[1]] + self.tails[ended[2]] if ended else super().fresh(part)


class ChunkEncoder:
    """Ids of whole texts out of the ids of chunks.

    A chunk starts at the text's start or at a space between two characters
    that are no white space: a match of the split pattern always starts there.
    Chunks are remembered up to a bound, so most of a text is looked up.
    """

    def __init__(self, encode, bound: int | None = None):
        self.bound = bound or MEMO_SIZE
        self.first = Chunks(encode, "")
        self.later = Chunks(encode, " ", self.first)

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        self.first.turn(self.bound)
        self.later.turn(self.bound)
        head, *tail = text.split(" ")
        try:
            return self.first[head] + b"".join(map(self.later.__getitem__, tail))
        except TypeError:                            # None: white space beside a space
            head, *tail = SAFE_SPACE.split(text)
            return Memo.fresh(self.first, head) + b"".join([self.later[p] or Memo.fresh(self.later, p) for p in tail])


class BytePairCodec:
    """Encoder and decoder of one rank file and split pattern."""

    def __init__(self, path: str, pattern: str):
        self.ranks = load_ranks(path)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.decimal = {rank: str(rank) for rank in self.tokens}
        self.split = regex.compile(pattern)
        self.encode = ChunkEncoder(self._plain)

    def _plain(self, text: str) -> list[int]:
        out: list[int] = []
        for match in self.split.finditer(text):
            out += merge_piece(match.group().encode("utf-8", "surrogatepass"), self.ranks)
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@cache
def codec(path: str, pattern: str) -> BytePairCodec:
    """One per worker process."""
    return BytePairCodec(path, pattern)


DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode_texts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): token ids of every whole text; null and empty texts have none. Other columns are ignored."""
    def run(batches):
        bpe = codec(path, pattern)
        for part in pieces(batches, "text"):
            ids = [np.frombuffer(bpe.encode(t or ""), "<u4").astype(np.int32) for t in part.column("text").to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), flat], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document the number and digest of its ids and the digest of the bytes they decode to.

    Null texts count as empty: no tokens, digests of the empty string. Repeated rows stay.
    """
    def run(batches):
        bpe = codec(path, pattern)
        for part in pieces(batches, "text"):
            rows = []
            for text in part.column("text").to_pylist():
                ids = np.frombuffer(bpe.encode(text or ""), "<u4").tolist()
                written = " ".join(map(bpe.decimal.__getitem__, ids))
                rows.append((len(ids), sha256_hex(written.encode()), sha256_hex(bpe.decode(ids))))
            n, ids_hash, decoded = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_hash), pa.array(decoded)], schema=DIGESTS)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES = {"op8_byte_bpe": op8_byte_bpe}
