"""Language-model scores by a weighted backoff automaton.

States are histories of up to two words. A state has an arc for every word it has
been learned to go on with, weighted with the discounted probability, and one
failure arc to its shorter history, weighted so that the probabilities of all
words sum to one. The root knows every word with the add-one estimate. A text is
scored in a traversal from left to right that carries the state.

All n-grams of the training texts are states and arcs, so the automaton grows with
the corpus and is never gathered. Each task forms blocks of the texts it reads, and
each block builds the arcs that its texts pass. It asks for the counts of its
distinct words, then of its pairs and triples, bucket by bucket of a hash, and gets
back numbers in the same order. Failure arcs need sums over all arcs of a state: of
the blocks that have an n-gram, the bucket names one, which adds it to the sums.

What is exchanged is small: a block is written once, as places of its words, and
lists its n-grams anew whenever it needs them; n-grams travel as sorted steps, by
planes of bytes; answers are what other blocks add. An n-gram of which no other block
has the first or the last part is no other block's, so it is not asked for.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import materialize
from ..storage import shuffles_end as _shuffles_end
from .batches import crc_mod, pieces, table, utf8

#: Least share of the training tokens that an n-gram of the automaton has (0: all n-grams); taken off each count.
SHARE, DISCOUNT = 0.0, 0.5
#: Bytes of text of a block.
BLOCK_BYTES = 6 << 20
#: A bucket answers for as many n-grams as so many blocks have.
BUCKET_BLOCKS = 4
#: Most tokens of a text that are walked one after the other; its stretches are walked side by side.
STRETCH = 256
#: The end of a text, a token that no word equals.
END = b""


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts one after the other, A-Z in lower case, without the ends, and their number in each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, b"").view(pa.string())))
    words, bounds = lists.values, lists.offsets.to_numpy()
    some = pc.greater(pc.binary_length(words), 0)
    before = np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False)))
    return words.filter(some).view(pa.binary()), np.diff(before[bounds])


def bucket_of(word: bytes, buckets: int) -> int:
    return xxhash.xxh32_intdigest(word) % buckets


# --- numbers as bytes -------------------------------------------------------------------------

HEAD = struct.Struct("<IB")


def pack(numbers: np.ndarray) -> bytes:
    """Numbers, none of them negative, by planes of their bytes, compressed."""
    width = (int(numbers.max(initial=0)).bit_length() + 7) // 8
    planes = numbers.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return HEAD.pack(len(numbers), width) + (pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if width else b"")


def unpack(data: bytes) -> np.ndarray:
    size, width = HEAD.unpack_from(data)
    out = np.zeros((size, 8), np.uint8)
    if width:
        planes = pa.decompress(data[HEAD.size:], decompressed_size=size * width, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, size).T
    return out.view("<i8").ravel()


def steps(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Columns of sorted rows; a value counts from the row before while all columns to its left stay."""
    out, same = [], np.ones(max(0, len(columns[0]) - 1), bool)
    for x in columns:
        step = x.copy()
        step[1:] -= np.where(same, x[:-1], 0)
        out.append(step)
        same &= x[1:] == x[:-1]
    return out


def sorted_rows(stepped: list[np.ndarray]) -> list[np.ndarray]:
    """The columns that ``steps`` was given."""
    out, new = [], np.zeros(len(stepped[0]), bool)
    new[:1] = True
    for step in stepped:
        total, starts = np.cumsum(step), np.flatnonzero(new)
        out.append(total - np.repeat(total[starts] - step[starts], np.diff(np.append(starts, len(step)))))
        new[1:] |= out[-1][1:] != out[-1][:-1]
    return out


# --- blocks of texts --------------------------------------------------------------------------

BLOCKS = "block long, learned long, at binary, sizes binary, doc_ids array<long>, held array<boolean>, buckets array<int>, words array<binary>, counts array<binary>"
BLOCKS_ARROW = pa.schema([
    ("block", pa.int64()), ("learned", pa.int64()), ("at", pa.binary()), ("sizes", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
    ("buckets", pa.list_(pa.int32())), ("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.binary())),
])


def _blocks(buckets: int, block_bytes: int):
    """Blocks of the texts that a task reads one after the other: the texts as places of the block's words, and the words by bucket with their number in its training texts."""
    def encoded(block: int, lists: list[pa.Array], many: list[np.ndarray], doc_ids: list, held: list) -> pa.RecordBatch:
        found = pa.concat_arrays(lists).dictionary_encode()
        words = pa.concat_arrays([pa.array([END], pa.binary()), found.dictionary])
        order = pc.sort_indices(words).to_numpy()
        bucket = np.array([bucket_of(w, buckets) for w in words.to_pylist()])[order]
        inside = np.argsort(bucket, kind="stable")
        order, bucket = order[inside], bucket[inside]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        sizes = np.concatenate(many) + 1
        inner = np.ones(sizes.sum(), bool)
        inner[np.cumsum(sizes) - 1] = False
        at = np.full(len(inner), rank[0])
        at[inner] = rank[1:][found.indices.to_numpy()]
        learned = at[np.repeat(np.array([not h for h in held]), sizes)]
        counts = np.bincount(learned, minlength=len(words))
        names, starts = np.unique(bucket, return_index=True)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(starts, len(order)), pa.int32()), words.take(pa.array(order))), b"\n")
        row = [block, len(learned), pack(at), pack(sizes), doc_ids, held, names.tolist(), [_squeezed(x) for x in joined.to_pylist()], [pack(x) for x in np.split(counts, starts)[1:]]]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, BLOCKS_ARROW, strict=True)], schema=BLOCKS_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = TaskContext.get().partitionId() << 32, 0
        lists, many, doc_ids, held = [], [], [], []
        for part in pieces(batches, "text", max(1, block_bytes // 4)):
            texts = part.column("text")
            more = part.num_rows + (pc.sum(pc.binary_length(texts)).as_py() or 0)
            if lists and size + more > block_bytes:
                yield encoded(block, lists, many, doc_ids, held)
                block, size = block + 1, 0
                lists, many, doc_ids, held = [], [], [], []
            size += more
            words, sizes = words_of(texts)
            lists.append(words)
            many.append(sizes)
            doc_ids += part.column("doc_id").to_pylist()
            held += part.column("held_out").to_pylist()
        if lists:
            yield encoded(block, lists, many, doc_ids, held)

    return run


def _squeezed(words: bytes) -> bytes:
    """Words, joined by line feeds, which none of them holds, as compressed bytes."""
    return HEAD.pack(len(words), 0) + (pa.compress(words, codec="zstd", asbytes=True) if words else b"")


def _split(data: bytes) -> list[bytes]:
    size, _ = HEAD.unpack_from(data)
    return (pa.decompress(data[HEAD.size:], decompressed_size=size, codec="zstd", asbytes=True) if size else b"").split(b"\n")


# --- counts over all blocks -------------------------------------------------------------------

#: What is asked for and answered. Counts answer n-grams, sums answer states.
WORD, PAIR, TRIPLE, WORD_SUM, PAIR_SUM = range(5)
WIDTH = {PAIR: 2, TRIPLE: 3, WORD_SUM: 1, PAIR_SUM: 2}
ASKS = "kind int, block long, bucket int, u binary, v binary, w binary, n binary, m binary"
ASKS_ARROW = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("bucket", pa.int32()), *((c, pa.binary()) for c in "uvwnm")])
REPLIES = "kind int, block long, bucket int, n binary, m binary, learned long"
REPLIES_ARROW = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("bucket", pa.int32()), ("n", pa.binary()), ("m", pa.binary()), ("learned", pa.int64())])


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _answer(buckets: int):
    """For each block the numbers of the words it asked for, frequent ones first, and what other blocks add to their counts; and, without a block, the bucket's learned words."""
    def run(asked: pa.Table) -> pa.Table:
        bucket = asked.column("bucket")[0].as_py()
        lists = [_split(x) for x in asked.column("words").to_pylist()]
        own = np.concatenate([unpack(x) for x in asked.column("counts").to_pylist()])
        words = pa.chunked_array([pa.array(x, pa.binary()) for x in lists]).combine_chunks().dictionary_encode()
        at = words.indices.to_numpy(zero_copy_only=False)
        total = _sums(at, own)
        names = pc.sort_indices(words.dictionary).to_numpy()
        number = np.empty(len(names), np.int64)
        number[names[np.argsort(-total[names], kind="stable")]] = np.arange(len(names)) * buckets + bucket
        numbers, added = number[at], np.where(np.bincount(at)[at] == 1, 0, 1 + total[at] - own)
        rows, start = [(WORD, None, bucket, None, None, int((total > 0).sum()))], 0
        for block, x in zip(asked.column("block").to_pylist(), lists, strict=True):
            rows.append((WORD, block, bucket, pack(numbers[start:start + len(x)]), pack(added[start:start + len(x)]), None))
            start += len(x)
        return _table(REPLIES_ARROW, rows)

    return run


def buckets_of(buckets: int, *numbers: np.ndarray) -> np.ndarray:
    """Bucket of each n-gram by the numbers of its words."""
    h = np.zeros(len(numbers[0]), np.uint64)
    for x in numbers:
        h = (h ^ x.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(buckets)).astype(np.int32 if buckets >> 16 else np.uint16)


def _asks(kind: int, block: int, bucket: np.ndarray, names: list[np.ndarray], values: list[np.ndarray]) -> list[tuple]:
    """One row per bucket with its n-grams, in the order they come in, which is sorted, and their values."""
    order = np.argsort(bucket, kind="stable")
    found, starts = np.unique(bucket[order], return_index=True)
    rows = []
    for b, places in zip(found.tolist(), np.split(order, starts)[1:], strict=True):
        keys = [pack(x) for x in steps([x[places] for x in names])]
        rows.append((kind, block, b, *keys, *[None] * (3 - len(keys)), *(pack(x[places]) for x in values), *[None] * (2 - len(values))))
    return rows


def _asked(asked: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the n-grams of one kind and bucket: bounds of each row's, an order that puts equal ones side by side, and each one's group."""
    names = "uvw"[:WIDTH[asked.column("kind")[0].as_py()]]
    lists = [sorted_rows([unpack(x) for x in row]) for row in zip(*(asked.column(c).to_pylist() for c in names), strict=True)]
    bounds = np.append(0, np.cumsum([len(x[0]) for x in lists]))
    key = np.zeros(bounds[-1], np.int64)
    for column in zip(*lists, strict=True):
        x = np.concatenate(column)
        span = int(x.max(initial=0)) + 1
        if (int(key.max(initial=0)) + 1) * span >> 63:
            key = np.unique(key, return_inverse=True)[1]
        key = key * span + x
    order = np.argsort(key, kind="stable")
    new = np.zeros(len(order), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new)
    return bounds, order, group


def _values(asked: pa.Table, column: str) -> np.ndarray:
    return np.concatenate([unpack(x) for x in asked.column(column).to_pylist()])


def _sums(group: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of the values of each group."""
    out = np.zeros(int(group.max(initial=-1)) + 1, np.int64)
    np.add.at(out, group, values)
    return out


def _replies(asked: pa.Table, bounds: np.ndarray, n: np.ndarray, m: np.ndarray | None = None) -> pa.Table:
    rows = zip(*(asked.column(c).to_pylist() for c in ("kind", "block", "bucket")), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
    return _table(REPLIES_ARROW, [(kind, block, bucket, pack(n[i:j]), None if m is None else pack(m[i:j]), None) for kind, block, bucket, i, j in rows])


def _count(asked: pa.Table) -> pa.Table:
    """For n-grams that several blocks have, one more than twice what other blocks add to the count, and one more for the block that adds it to its state's sums; else zero."""
    bounds, order, group = _asked(asked)
    own = _values(asked, "n")
    added = _sums(group, own)[group] - own
    some = order[own[order] > 0]
    adds = np.zeros(len(own), np.int64)
    adds[some[np.unique(group[some], return_index=True)[1]]] = 1
    return _replies(asked, bounds, np.where(np.bincount(group)[group] == 1, 0, 1 + 2 * added + adds))


def _add(asked: pa.Table) -> pa.Table:
    """What other blocks add to the sums of the states of one kind and bucket."""
    bounds, _, group = _asked(asked)
    return _replies(asked, bounds, *(_sums(group, x)[group] - x for x in (_values(asked, "n"), _values(asked, "m"))))


# --- a block's part of the automaton ----------------------------------------------------------

def _replied(replies: pa.Table, kind: int, column: str = "n") -> np.ndarray:
    """What all buckets answered, one after the other."""
    rows = replies.filter(pc.equal(replies.column("kind"), kind)).sort_by("bucket")
    return np.concatenate([np.zeros(0, np.int64), *(unpack(x) for x in rows.column(column).to_pylist())])


def _in_order(bucket: np.ndarray, replied: np.ndarray) -> np.ndarray:
    """What was answered, in the order of the block."""
    out = np.zeros(len(bucket), np.int64)
    out[np.argsort(bucket, kind="stable")] = replied
    return out


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct number, in their order, and which of them stands at each place."""
    order = np.argsort(codes)
    values = codes[order]
    new = np.ones(len(order), bool)
    new[1:] = values[1:] != values[:-1]
    inverse = np.empty(len(order), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return order[new], inverse


class Grams:
    """The texts of one block and its n-grams: places of words, of pairs and of triples, each in the order of the numbers of their words."""

    def __init__(self, row: pa.Table, replies: pa.Table, buckets: int):
        self.buckets, self.block = buckets, row.column("block")[0].as_py()
        number = _replied(replies, WORD)
        order = np.argsort(number)
        self.number = number[order]
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        self.t = rank[unpack(row.column("at")[0].as_py())]
        self.sizes = unpack(row.column("sizes")[0].as_py())
        self.doc_ids, self.held = (row.column(c)[0].as_py() for c in ("doc_ids", "held"))
        self.learned = np.repeat(np.array([not h for h in self.held]), self.sizes)
        self.ends = np.cumsum(self.sizes)
        depth = np.arange(len(self.t)) - np.repeat(self.ends - self.sizes, self.sizes)
        added = _replied(replies, WORD, "m")[order]
        self.words_shared = added > 0
        self.words = np.bincount(self.t[self.learned], minlength=len(order)) + np.maximum(0, added - 1)
        second, self.third = np.flatnonzero(depth >= 1), np.flatnonzero(depth >= 2)
        found, inverse = _distinct(self.t[second - 1] * len(order) + self.t[second])
        self.first, self.last = self.t[second[found] - 1], self.t[second[found]]
        self.own_pairs = self._count(second, inverse, len(found))
        self.pair = np.zeros(len(self.t), np.int64)
        self.pair[second] = inverse
        self.pairs_asked = np.flatnonzero(self.words_shared[self.first] & self.words_shared[self.last])
        self.pair_bucket = buckets_of(buckets, *self.pair_numbers(self.pairs_asked))

    def _count(self, places: np.ndarray, inverse: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(inverse[self.learned[places]], minlength=size)

    def pair_numbers(self, pairs: np.ndarray) -> list[np.ndarray]:
        return [self.number[x[pairs]] for x in (self.first, self.last)]

    def triple_numbers(self, triples: np.ndarray) -> list[np.ndarray]:
        head, tail = self.head[triples], self.tail[triples]
        return [self.number[x] for x in (self.first[head], self.last[head], self.last[tail])]

    def count_pairs(self, replies: pa.Table) -> None:
        self.pairs, self.pairs_add, self.pairs_shared = self._counted(replies, PAIR, self.pairs_asked, self.pair_bucket, self.own_pairs)

    def _counted(self, replies: pa.Table, kind: int, asked: np.ndarray, bucket: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts over all blocks, whether this block adds them to sums, whether other blocks have the n-gram."""
        replied = np.zeros(len(own), np.int64)
        replied[asked] = _in_order(bucket, _replied(replies, kind))
        shared = replied > 0
        return own + np.where(shared, (replied - 1) >> 1, 0), np.where(shared, (replied - 1) & 1 == 1, own > 0), shared

    def name_triples(self) -> None:
        """Triples, once the pairs are counted."""
        found, inverse = _distinct(self.pair[self.third - 1] * len(self.first) + self.pair[self.third])
        self.head, self.tail = self.pair[self.third[found] - 1], self.pair[self.third[found]]
        self.own_triples = self._count(self.third, inverse, len(found))
        self.triples_asked = np.flatnonzero(self.pairs_shared[self.head] & self.pairs_shared[self.tail])
        self.triple_bucket = buckets_of(self.buckets, *self.triple_numbers(self.triples_asked))


def _ask(buckets: int, kind: int):
    """The questions of a block for the counts of its pairs or triples."""
    def run(row: pa.Table, replies: pa.Table) -> pa.Table:
        grams = Grams(row, replies, buckets)
        if kind == PAIR:
            asked, bucket, names, own = grams.pairs_asked, grams.pair_bucket, grams.pair_numbers(grams.pairs_asked), grams.own_pairs
        else:
            grams.count_pairs(replies)
            grams.name_triples()
            asked, bucket, names, own = grams.triples_asked, grams.triple_bucket, grams.triple_numbers(grams.triples_asked), grams.own_triples
        return _table(ASKS_ARROW, _asks(kind, grams.block, bucket, names, [own[asked]]))

    return run


class Part(Grams):
    """The states and arcs of one block: its words, pairs and triples with their counts over all blocks, and its share in the sums of its states."""

    def __init__(self, row: pa.Table, replies: pa.Table, buckets: int, least: float):
        super().__init__(row, replies, buckets)
        self.count_pairs(replies)
        self.name_triples()
        self.triples, triples_add, _ = self._counted(replies, TRIPLE, self.triples_asked, self.triple_bucket, self.own_triples)
        # states that other blocks have as well, and the buckets of their sums
        self.words_both, self.pairs_both = np.flatnonzero(self.words_shared), np.flatnonzero(self.pairs_shared)
        self.word_sum_bucket = buckets_of(buckets, self.number[self.words_both])
        self.pair_sum_bucket = buckets_of(buckets, *self.pair_numbers(self.pairs_both))
        # twice the discounted counts of the arcs that this block adds, and those of the shorter history
        arcs = np.flatnonzero(self.pairs_add & (self.pairs >= least))
        self.seen, self.below = np.zeros((2, len(self.words)), np.int64)
        np.add.at(self.seen, self.first[arcs], 2 * self.pairs[arcs] - 1)
        np.add.at(self.below, self.first[arcs], self.words[self.last[arcs]] + 1)
        arcs = np.flatnonzero(triples_add & (self.triples >= least))
        self.seen2, self.below2 = np.zeros((2, len(self.pairs)), np.int64)
        np.add.at(self.seen2, self.head[arcs], 2 * self.triples[arcs] - 1)
        np.add.at(self.below2, self.head[arcs], 2 * self.pairs[self.tail[arcs]] - 1)


def _share_sums(buckets: int, least: float):
    """What a block adds to the sums of those of its states that other blocks have as well."""
    def run(row: pa.Table, replies: pa.Table) -> pa.Table:
        part = Part(row, replies, buckets, least)
        some, both = part.words_both, part.pairs_both
        return _table(ASKS_ARROW, [
            *_asks(WORD_SUM, part.block, part.word_sum_bucket, [part.number[some]], [part.seen[some], part.below[some]]),
            *_asks(PAIR_SUM, part.block, part.pair_sum_bucket, part.pair_numbers(both), [part.seen2[both], part.below2[both]]),
        ])

    return run


def _failure(seen: np.ndarray, count: np.ndarray, below: np.ndarray, whole) -> np.ndarray:
    """Log10 weights of failure arcs; zero where a history is no state. The root's and shorter state's sums are out of ``whole``."""
    state = seen > 0
    rest = np.where(state, (2 * count - seen) / np.maximum(1, 2 * count), 1)
    return np.log10(rest) - np.log10(np.where(state, (whole - below) / np.maximum(1, whole), 1))


class Automaton:
    """States of a block: the root 0, then its words, then its pairs; every state but the root has a failure arc to the shorter history.

    An n-gram that the model has is an arc: out of the state of its history, by its
    last word, into the longest state that ends it. The root goes on with every word.
    """

    def __init__(self, part: Part, least: float, root: np.ndarray, down: np.ndarray, down2: np.ndarray):
        self.words = len(root)
        self.root = root
        self.falls = np.concatenate([[0.0], down, down2])
        self.shorter = np.concatenate([np.zeros(1 + self.words, np.int64), 1 + part.last])
        pairs, triples = np.flatnonzero(part.pairs >= least), np.flatnonzero(part.triples >= least)
        first, head, tail = part.first[pairs], part.head[triples], part.tail[triples]
        # arcs are found by state x words + word; pairs and triples are in the order of their words, so these are sorted
        states = np.concatenate([1 + first, 1 + self.words + head])
        self.arcs = states * self.words + np.concatenate([part.last[pairs], part.last[tail]])
        self.ahead = np.concatenate([1 + self.words + pairs, 1 + self.words + tail])
        self.weights = np.log10(np.concatenate([(part.pairs[pairs] - DISCOUNT) / part.words[first], (part.triples[triples] - DISCOUNT) / part.pairs[head]]))
        many = np.bincount(states, minlength=len(self.falls))
        self.starts = np.minimum(np.cumsum(many) - many, max(0, len(states) - 1))

    def _find(self, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The arc out of each state by a word, -1 if it has none; the root has none of its own."""
        if not len(self.arcs):
            return np.full(len(states), -1)
        keys, found = states * self.words + words, self.starts[states]
        later = np.flatnonzero(self.arcs[found] < keys)
        found[later] = np.minimum(np.searchsorted(self.arcs, keys[later]), len(self.arcs) - 1)
        return np.where(self.arcs[found] == keys, found, -1)

    def walk(self, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Weights of the arcs taken at each place of the texts: up to two failure arcs, then the word's.

        Failure arcs until the state has an arc for the word, then this arc. A
        state is at most two words, so a long text is walked in stretches side by
        side, each from the root through the two words before it.
        """
        out = np.zeros((len(places), 3))
        ends = np.cumsum(sizes)
        many = -(-sizes // STRETCH)
        kth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        text = np.repeat(ends - sizes, many)
        start = text + kth * STRETCH
        begin, stop = np.maximum(text, start - 2), np.minimum(start + STRETCH, np.repeat(ends, many))
        order = np.argsort(begin - stop, kind="stable")
        start, begin, length = start[order], begin[order], (stop - begin)[order]
        state = np.zeros(len(order), np.int64)
        for k in range(int(length.max(initial=0))):
            walking = int(np.searchsorted(-length, -k))
            at = begin[:walking] + k
            now, word, weight = state[:walking], places[at], np.zeros((walking, 3))
            arc = self._find(now, word)
            for fall in range(2):
                stuck = np.flatnonzero((arc < 0) & (now > 0))
                weight[stuck, fall] = self.falls[now[stuck]]
                now[stuck] = self.shorter[now[stuck]]
                arc[stuck] = self._find(now[stuck], word[stuck])
            found, lost = np.flatnonzero(arc >= 0), np.flatnonzero(arc < 0)
            weight[found, 2], weight[lost, 2] = self.weights[arc[found]], self.root[word[lost]]
            now[found], now[lost] = self.ahead[arc[found]], 1 + word[lost]
            if k < 2:
                kept = at >= start[:walking]
                at, weight = at[kept], weight[kept]
            out[at] = weight
        return out

    def score(self, places: list[int]) -> float:
        """One text."""
        return math.fsum(self.walk(np.array(places, np.int64), np.array([len(places)])).ravel().tolist())


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
SCORED_ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _score(buckets: int, least: float, n: int, distinct: int):
    """Scores of a block's texts, each in one traversal of the block's automaton."""
    def run(row: pa.Table, replies: pa.Table) -> pa.Table:
        part = Part(row, replies, buckets, least)
        for kind, both, bucket, sums in (
            (WORD_SUM, part.words_both, part.word_sum_bucket, (part.seen, part.below)), (PAIR_SUM, part.pairs_both, part.pair_sum_bucket, (part.seen2, part.below2)),
        ):
            for total, column in zip(sums, "nm", strict=True):
                total[both] += _in_order(bucket, _replied(replies, kind, column))
        floor = math.log10(n + distinct + 1)
        root = np.log10(part.words + 1) - floor
        down = _failure(part.seen, part.words, part.below, n + distinct + 1)
        down2 = _failure(part.seen2, part.pairs, part.below2, 2 * part.words[part.last])
        weights = Automaton(part, least, root, down, down2).walk(part.t, part.sizes)
        known = part.words[part.t] > 0
        rows = []
        for doc_id, held, start, stop in zip(part.doc_ids, part.held, (part.ends - part.sizes).tolist(), part.ends.tolist(), strict=True):
            base, taken = math.fsum(root[part.t[start:stop]].tolist()), weights[start:stop].ravel()
            rows.append((doc_id, held, stop - start, int(known[start:stop].sum()), n, base, math.fsum(taken[taken != 0].tolist())))
        return _table(SCORED_ARROW, rows)

    return run


def score(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Scores of all texts by a model of those that are not ``held_out`` (a boolean column).

    Null and empty texts are the end token alone. Repeated rows stay and count;
    other columns are ignored; without training texts every word has the floor of one unknown word.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), utf8(text_col).alias("text"))
    size = rows.agg(F.sum(F.coalesce(F.length("text"), F.lit(0)) + 1)).first()[0] or 1
    buckets = max(1, -(-size // (BUCKET_BLOCKS * block_bytes)))
    with _shuffles_end(docs.sparkSession):
        written = materialize(rows.mapInArrow(_blocks(buckets, block_bytes), BLOCKS), "blocks")
        n = written.agg(F.sum("learned")).first()[0] or 0
        least = max(1.0, share * n)
        texts = written.select("block", "at", "sizes", "doc_ids", "held").groupBy("block")
        asked = written.select("block", F.explode(F.arrays_zip("buckets", "words", "counts")).alias("x")).select("block", F.col("x.buckets").alias("bucket"), "x.words", "x.counts")
        answered = materialize(asked.groupBy("bucket").applyInArrow(_answer(buckets), REPLIES), "words")
        distinct = answered.agg(F.sum("learned")).first()[0] or 0
        replies = answered.where("block is not null")
        for kind, label in ((PAIR, "pairs"), (TRIPLE, "triples")):
            questions = texts.cogroup(replies.groupBy("block")).applyInArrow(_ask(buckets, kind), ASKS)
            replies = replies.union(materialize(questions.groupBy("kind", "bucket").applyInArrow(_count, REPLIES), label))
        shares = texts.cogroup(replies.groupBy("block")).applyInArrow(_share_sums(buckets, least), ASKS)
        sums = materialize(shares.groupBy("kind", "bucket").applyInArrow(_add, REPLIES), "sums")
    return texts.cogroup(replies.union(sums).groupBy("block")).applyInArrow(_score(buckets, least, n, distinct), SCORED)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2)


QUERIES = {"op3_lm_scoring": op3_lm_scoring}
