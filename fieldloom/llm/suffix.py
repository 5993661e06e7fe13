"""Repeated passages by a distributed merge sort of suffixes that knows common prefixes.

Every window of ``LENGTH`` bytes has one anchor: the leftmost of its ``SEED``-byte
strings with the smallest hash. Equal windows have their anchors at equal places,
so only suffixes that start at anchors need sorting, and of these only the ones
whose first ``SEED`` bytes occur again somewhere (counted over all documents).
An entry of the sort is such a suffix, together with the bytes before it that the
windows of its anchor reach.

Each task sorts its entries, sends equal ones once, and writes its run front
coded: of a suffix only the bytes beyond the prefix it shares with the one before.
Runs are exchanged by the hash of the first ``SEED`` bytes, in as many parts as the
number of entries asks for: no sample of the texts decides the balance, and equal
seeds meet. The receiver merges the runs of its part
with a loser tree whose nodes keep the prefix length shared with the last winner:
known prefixes are never compared again. Neighbours in the merged order that share
``SEED`` bytes form a group, within which the windows of all entries are compared.

Anchors whose seed occurs in more than ``HOT`` places are written as one entry per
window instead, dealt and sorted by all its bytes, so that a group is only what is
equal and each task sends it once.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import materialize
from .batches import pieces, table, utf8

#: Bytes of a repeated string, bytes of an anchor's seed, anchors' largest distance from the window's start.
LENGTH, SEED = 200, 80
REACH = LENGTH - SEED
#: Entries of a run, entries of a part of the exchange, occurrences that make a seed hot.
RUN, PART, HOT = 60_000, 20_000, 20_000
#: Texts are searched for anchors in slices of about two to this power bytes; a dozen arrays of eight bytes for each are held.
SLICE_BITS = 20
#: Base of the rolling hash, modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, BASE, np.uint64), np.full(n, INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def anchors(buffer: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(position, nearest, farthest, seed hash) of the anchors of documents that end at ``ends`` of ``buffer``.

    The windows of an anchor start between ``nearest`` and ``farthest`` bytes before it.
    """
    n = len(buffer)
    if n < LENGTH:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    up, down = _powers(1 << max(SLICE_BITS, int(n - 1).bit_length()))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    seeds = _mixed((sums[SEED:] - sums[:-SEED]) * down[:n - SEED + 1])
    ranked = (seeds & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(seeds), dtype=np.uint64)
    width = REACH + 1
    rows = -(-len(ranked) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(ranked)] = ranked
    blocks = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - LENGTH + 1
    least = np.minimum(behind[:windows], ahead[width - 1:width - 1 + windows])
    valid = np.ones(n, bool)
    start = 0
    for end in ends:
        valid[max(start, end - LENGTH + 1):end] = False
        start = end
    at = np.flatnonzero(valid[:windows])
    if not len(at):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    chosen = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(chosen[1:] != chosen[:-1]) + 1])
    last = np.append(first[1:], len(chosen)) - 1
    place = chosen[first]
    return place, place - at[last], place - at[first], seeds[place]


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])


def _anchor_batches(counted: bool):
    """Seeds with how often the task has them, or one row per anchor."""
    def run(batches):
        for part in pieces(batches, "text", 1 << SLICE_BITS):
            texts = [t or b"" for t in part.column("text").to_pylist()]
            buffer, ends = _joined(texts)
            place, near, far, seed = anchors(buffer, ends)
            if counted:
                seen, n = np.unique(seed.view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n)], names=["seed", "n"])
                continue
            doc = np.searchsorted(ends, place, side="right")
            inside = place - (ends[doc] - np.array([len(t) for t in texts])[doc]) if len(place) else place
            packed = inside << 17 | near << 9 | far << 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(seed.view(np.int64)), part.column("doc").take(pa.array(doc)), part.column("mark").take(pa.array(doc)), pa.array(packed)],
                names=["seed", "doc", "mark", "at"],
            )

    return run


# --- entries and runs ------------------------------------------------------------------------

class Run:
    """Sorted entries of one task. An entry: suffix, bytes before it (reversed), nearest, farthest, whether it is a hot seed's window, its places."""

    def __init__(self):
        self.entries: dict[tuple[bytes, bytes, int, int, bool], list[tuple[int, int, int]]] = defaultdict(list)

    def add(self, text: bytes, doc: int, mark: int, packed: int) -> None:
        at, near, far = packed >> 17, packed >> 9 & 255, packed >> 1 & 255
        if packed & 1:                               # hot: each window on its own
            for i in range(near, far + 1):
                self.entries[text[at - i:at - i + LENGTH], b"", 0, 0, True].append((doc, mark, at - i))
        else:
            self.entries[text[at:at + LENGTH - near], text[at - far:at][::-1], near, far, False].append((doc, mark, at))


def shared_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    most = min(len(a), len(b))
    while known < most:
        step = min(32, most - known)
        if a[known:known + step] == b[known:known + step]:
            known += step
            continue
        while a[known] == b[known]:
            known += 1
        break
    return known


def merge(runs: list[list[tuple[bytes, int]]]) -> Iterator[tuple[int, int, int]]:
    """(run, position, prefix shared with the one before) of all suffixes in order.

    A run is a sorted list of (suffix, prefix shared with the one before in the run).
    A node of the loser tree holds the run that lost there and the prefix its
    head shares with the winner that passed: the head that shares more with the
    last winner is smaller; only equal prefixes are compared, from there on.
    """
    count = len(runs)
    heads = [0] * count
    shares = [0] * count
    losers = [-1] * count
    over = [not r for r in runs]

    def beats(x: int, y: int) -> bool:
        """Whether the head of x comes before that of y; the loser's share becomes that with the winner."""
        if over[x] or over[y]:
            return over[y] and not over[x]
        if shares[x] != shares[y]:
            return shares[x] > shares[y]
        a, b = runs[x][heads[x]][0], runs[y][heads[y]][0]
        known = shared_prefix(a, b, shares[x])
        first = a[known:known + 1] <= b[known:known + 1]
        shares[y if first else x] = known
        return first

    def play(x: int) -> int:
        node = (x + count) // 2
        while node:
            y = losers[node]
            if y < 0:                                # first round: wait here for the other half
                losers[node] = x
                return -1
            if beats(y, x):
                losers[node], x = x, y
            node //= 2
        return x

    winner = -1
    for x in range(count):
        winner = max(winner, play(x)) if count > 1 else x
    while winner >= 0 and not over[winner]:
        at = heads[winner]
        yield winner, at, shares[winner]
        heads[winner] = at + 1
        if at + 1 == len(runs[winner]):
            over[winner] = True
        else:
            shares[winner] = runs[winner][at + 1][1]
        winner = play(winner) if count > 1 else winner


def joined_spans(spans) -> list[tuple[int, int, int, int]]:
    """(doc, mark, start, stop) with overlapping and touching spans of a text made one."""
    out: list[tuple[int, int, int, int]] = []
    for doc, mark, start, stop in sorted(spans):
        if out and out[-1][:2] == (doc, mark) and start <= out[-1][3]:
            out[-1] = (doc, mark, out[-1][2], max(stop, out[-1][3]))
        else:
            out.append((doc, mark, start, stop))
    return out


RUN_SCHEMA = pa.schema([
    ("bucket", pa.int64()), ("near", pa.list_(pa.int16())), ("far", pa.list_(pa.int16())), ("shared", pa.list_(pa.int16())), ("rest", pa.list_(pa.binary())),
    ("before", pa.list_(pa.binary())), ("doc", pa.list_(pa.int64())), ("mark", pa.list_(pa.int64())), ("at", pa.list_(pa.int64())),
    ("span_doc", pa.int64()), ("span_mark", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()),
])
RUN_DDL = (
    "bucket long, near array<short>, far array<short>, shared array<short>, rest array<binary>, before array<binary>, "
    "doc array<long>, mark array<long>, at array<long>, span_doc long, span_mark long, start long, stop long"
)


def _rows(columns: dict[str, list], n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns.get(f.name, [None] * n), f.type) for f in RUN_SCHEMA], schema=RUN_SCHEMA)


def _run_batches(run: Run, parts: int) -> Iterator[pa.RecordBatch]:
    """The run's spans that are certain, then its entries front coded, one row per part of the exchange."""
    spans = joined_spans((doc, mark, at - far, at - near + LENGTH) for (_, _, near, far, _), places in run.entries.items() if len(places) > 1 for doc, mark, at in places)
    if spans:
        yield _rows(dict(zip(("span_doc", "span_mark", "start", "stop"), zip(*spans, strict=True), strict=True)), len(spans))
    rows: dict[int, dict[str, list]] = {}
    last: dict[int, bytes] = {}
    for key in sorted(run.entries):
        suffix, before, near, far, window = key
        places = run.entries[key]
        # windows are dealt by all their bytes, entries of anchors by their seed only: equal seeds must meet
        bucket = 2 * (xxhash.xxh64_intdigest(suffix if window else suffix[:SEED]) % parts) + window
        row = rows.setdefault(bucket, {n: [] for n in RUN_SCHEMA.names[1:9]})
        shared = shared_prefix(last.get(bucket, b""), suffix, 0)
        last[bucket] = suffix
        doc, mark, at = places[0] if len(places) == 1 else (None, None, None)
        for name, value in zip(RUN_SCHEMA.names[1:9], (near, far, shared, suffix[shared:], before, doc, mark, at), strict=True):
            row[name].append(value)
    for bucket, row in rows.items():
        yield _rows({"bucket": [bucket]} | {n: [v] for n, v in row.items()}, 1)


def _entry_batches(parts: int):
    def run(batches):
        held = Run()
        for part in pieces(batches, "text"):
            for text, doc, mark, found in zip(*(part.column(c).to_pylist() for c in ("text", "doc", "mark", "found")), strict=True):
                for packed in found:
                    held.add(text, doc, mark, packed)
                if len(held.entries) >= RUN:
                    yield from _run_batches(held, parts)
                    held = Run()
        yield from _run_batches(held, parts)

    return run


# --- groups of the merged order --------------------------------------------------------------

def repeated_windows(entries: list[tuple[bytes, bytes, int, int]], group: np.ndarray) -> np.ndarray:
    """[entry, distance]: whether the window that starts so far before the anchor is also in another entry of the group."""
    n = len(entries)
    matrix = np.zeros((n, REACH + LENGTH), np.uint8)
    for row, (suffix, before, _, _) in zip(matrix, entries, strict=True):
        row[REACH:REACH + len(suffix)] = np.frombuffer(suffix, np.uint8)
        row[REACH - len(before):REACH] = np.frombuffer(before, np.uint8)[::-1]
    near, far = (np.array([e[k] for e in entries]) for k in (2, 3))
    sums = np.zeros((n, REACH + LENGTH + 1), np.uint64)
    np.cumsum((matrix.astype(np.uint64) + np.uint64(1)) * _powers(1 << SLICE_BITS)[0][:REACH + LENGTH], axis=1, out=sums[:, 1:])
    salt = _mixed(group.astype(np.uint64) + np.uint64(1))
    out = np.zeros((n, REACH + 1), bool)
    for i in range(REACH + 1):
        rows = np.flatnonzero((near <= i) & (i <= far))
        if len(rows) < 2:
            continue
        start = REACH - i
        hashed = _mixed(sums[rows, start + LENGTH] - sums[rows, start]) ^ salt[rows]
        order = np.argsort(hashed, kind="stable")
        same = np.flatnonzero(hashed[order][1:] == hashed[order][:-1])
        a, b = rows[order[same]], rows[order[same + 1]]
        sure = (group[a] == group[b]) & (matrix[a, start:start + LENGTH] == matrix[b, start:start + LENGTH]).all(axis=1)
        out[a[sure], i] = True
        out[b[sure], i] = True
    return out


SPANS = pa.schema([("doc", pa.int64()), ("mark", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])


def _resolve(entries: list[tuple], places: list[tuple], group: np.ndarray, spans: list[tuple]) -> None:
    found = repeated_windows(entries, group)
    edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    for (row, first), (_, beyond) in zip(np.argwhere(edge == 1).tolist(), np.argwhere(edge == -1).tolist(), strict=True):
        doc, mark, at = places[row]
        if at is not None:
            spans.append((doc, mark, at - beyond + 1, at - first + LENGTH))


def merge_part(rows: pa.Table) -> pa.Table:
    """Spans of the repeated windows of one part of the exchange, from its runs."""
    runs, details, places = [], [], []
    for row in rows.select(RUN_SCHEMA.names[1:9]).to_pylist():
        suffix, run = b"", []
        for shared, rest in zip(row["shared"], row["rest"], strict=True):
            suffix = suffix[:shared] + rest
            run.append((suffix, shared))
        runs.append(run)
        details.append(list(zip(row["before"], row["near"], row["far"], strict=True)))
        places.append(list(zip(row["doc"], row["mark"], row["at"], strict=True)))
    windows = rows.column("bucket")[0].as_py() % 2
    spans: list[tuple] = []
    waiting: tuple[list, list, list] = ([], [], [])
    group: list[tuple[int, int]] = []
    number = 0

    def close(last: bool = False) -> None:
        nonlocal number, waiting
        if len(group) > 1 and windows:
            spans.extend((*places[r][k][:2], places[r][k][2], places[r][k][2] + LENGTH) for r, k in group if places[r][k][2] is not None)
        elif len(group) > 1:
            for r, k in group:
                waiting[0].append((runs[r][k][0], *details[r][k]))
                waiting[1].append(places[r][k])
                waiting[2].append(number)
            number += 1
        group.clear()
        if waiting[0] and (last or len(waiting[0]) >= 4096):
            _resolve(waiting[0], waiting[1], np.array(waiting[2]), spans)
            waiting = ([], [], [])

    least = LENGTH if windows else SEED
    for r, k, shared in merge(runs):
        if shared < least:
            close()
        group.append((r, k))
    close(last=True)
    spans = joined_spans(spans)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*spans, strict=True) if spans else [[]] * 4, SPANS, strict=True)], schema=SPANS)


def repeated_spans(docs: DataFrame, hot: int = HOT, per_part: int = PART) -> DataFrame:
    """(doc, mark, start, stop): spans of bytes to remove, which may overlap, of rows (doc, mark, text).

    ``doc`` and ``mark`` together name a text; rows with equal ones must have equal texts.
    """
    spark = docs.sparkSession
    seeds = docs.select("text").mapInArrow(_anchor_batches(True), "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).where("n > 1")
    again = materialize(seeds.select("seed", (F.col("n") > hot).cast("int").alias("hot")), "seeds")
    places = docs.mapInArrow(_anchor_batches(False), "seed long, doc long, mark long, at long")
    found = places.join(again, "seed").groupBy("doc", "mark").agg(F.collect_set(F.col("at") + F.col("hot")).alias("found"))
    found = materialize(found, "anchors")
    total = found.agg(F.sum(F.size("found"))).first()[0] or 0
    parts = max(1, -(-total // per_part))
    runs = materialize(docs.join(found, ["doc", "mark"]).mapInArrow(_entry_batches(parts), RUN_DDL), "runs")
    certain = runs.where("bucket is null").select(F.col("span_doc").alias("doc"), F.col("span_mark").alias("mark"), "start", "stop")
    merged = runs.where("bucket is not null").select(*RUN_SCHEMA.names[:9]).groupBy("bucket").applyInArrow(merge_part, "doc long, mark long, start long, stop long")
    return certain.union(merged)


def keyed(docs: DataFrame, id_col: str, text_col: str, *others: str) -> DataFrame:
    """Rows (doc, mark, text): ``mark``, 64 bits of the text's hash, tells texts of a repeated id apart; for a null id ``doc`` is 64 further bits."""
    text = F.coalesce(utf8(text_col), F.lit(b""))
    return docs.select(
        *others,
        F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.lit("no id"), text)).alias("doc"),
        F.xxhash64(text).alias("mark"),
        text.alias("text"),
    )


def span_lists(keys: DataFrame) -> DataFrame:
    """(doc, mark, spans) of the texts that have spans, written."""
    return materialize(repeated_spans(keys).groupBy("doc", "mark").agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "spans")


def kept_parts(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left without the spans, and how many maximal runs they make."""
    out, end, runs = [], 0, 0
    for start, stop in sorted(spans):
        if start > end or not runs:
            out.append(text[end:start])
            runs += 1
        end = max(end, stop)
    out.append(text[end:])
    return b"".join(out), runs


REMOVED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _digest_batches(batches):
    for part in pieces(batches, "text"):
        rows = []
        for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist(), strict=True):
            kept, runs = kept_parts(text, [(s["start"], s["stop"]) for s in spans or []])
            rows.append((len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(REMOVED)[1:], strict=True))], schema=REMOVED)


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document what the removal of repeated strings takes and leaves.

    Null and empty texts: zero bytes, digest of the empty string. Repeated rows
    repeat each other, so all their bytes that a window covers go. Other columns are ignored.
    """
    rows = keyed(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("own")), "doc_id", "own", "doc_id")
    joined = rows.join(span_lists(rows.drop("doc_id")), ["doc", "mark"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_digest_batches, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removals(table(spark, sf_dir, "documents"))


def _cut_batches(batches):
    for part in pieces(batches, "text"):
        kept = [
            kept_parts(text, [(s["start"], s["stop"]) for s in spans])[0].decode("utf-8", "ignore") if spans else text.decode()
            for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(kept, pa.string())], names=["row", "text"])


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated passages leave the texts; ``n_chars`` follows. A character cut in half goes whole."""
    others = [c for c in docs.columns if c != "text"]
    rows = keyed(docs, "doc_id", "text", F.struct(*others).alias("row"))
    spans = span_lists(rows.drop("row"))
    cut = rows.join(spans, ["doc", "mark"], "left").select("row", "text", "spans")
    row_type = next(f.dataType for f in cut.schema if f.name == "row").simpleString()
    out = cut.mapInArrow(_cut_batches, f"row {row_type}, text string")
    return out.select(*(F.col("text") if c == "text" else F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col("row")[c].alias(c) for c in docs.columns))


QUERIES = {"op9_suffix_array_dedup": op9_suffix_array_dedup}
