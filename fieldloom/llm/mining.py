"""Hard negatives by zone maps over Hilbert-ordered blocks.

Rows of one label, ordered along a Hilbert curve through their vectors, are
written as Parquet rows of ``BLOCK`` vectors each, with the least and greatest
value of every dimension: the zone map. Anchors, in the same order, are packed
likewise. An anchor asks with windows of scores, each for its best few rows;
positives are one window without bounds over the own label, and each positive
makes one window for negatives.

Interval arithmetic on a zone map bounds the inner products of a block's rows
with an anchor from both sides. First each window's most promising blocks are
read, which gives a lower bound on its last wanted score; then all other blocks
whose bounds reach into what is left of a window. Only blocks on this list meet a
pack. Zone maps are sent to the tasks in parts of bounded size. Blocks stay
together in shelves that a task holds while packs stream by; a pack's answer from
a shelf is its best rows only.

Vectors hold integers; products are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..storage import materialize, new_path
from .batches import table

#: Factor of components before they are rounded down; positives of an anchor, negatives of a positive; per cent of the positive's score.
SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 3, 50, 95
#: Rows of a block, anchors of a pack, most blocks of a shelf, blocks each window reads first.
BLOCK, PACK, SHELF, SEEDS = 256, 128, 512, 2
#: Bits of a Hilbert key; bytes of zone maps sent at once; rows scored at once.
KEY_BITS, ZONE_BYTES, AT_ONCE = 128, 64 << 20, 4_096
NONE, ALL = -(1 << 63), (1 << 63) - 1
#: Products whose sums stay below this are exact in double precision.
EXACT = float(1 << 53)
SHIFT = 32


# --- Hilbert order ----------------------------------------------------------------------------

def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places of cells (rows of ``bits``-bit coordinates) along a Hilbert curve, as byte strings in that order.

    Coordinates are brought, from the highest bit down, into the frame of the subcube they lie in
    (inverted or swapped with the first axis), then Gray-decoded; the key is their bits, dimension by dimension.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    if not dims:
        return [b""] * cells.shape[0]
    for level in range(bits - 1, 0, -1):
        bit, lower = 1 << level, (1 << level) - 1
        for i in range(dims):
            inverted = (x[i] & bit) != 0
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & lower)
            x[0] ^= np.where(inverted, lower, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    planes = np.concatenate([(x >> level) & 1 for level in range(bits - 1, -1, -1)]).astype(np.uint8)
    return [k.tobytes() for k in np.packbits(planes, axis=0).T.copy()]


def key_bits(width: int) -> int:
    return max(1, min(8, KEY_BITS // max(1, width)))


def whole_numbers(column: pa.Array, width: int, scale: float) -> np.ndarray:
    return np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), width))


def _spread_batches(width: int, scale: float):
    def run(batches):
        n, total, squares = 0, np.zeros(width), np.zeros(width)
        for part in batches:
            x = whole_numbers(part.column("v"), width, scale)
            n, total, squares = n + len(x), total + x.sum(0), squares + (x * x).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(np.full(width, n)), pa.array(total), pa.array(squares)], names=["dim", "n", "s", "ss"])

    return run


KEYED = "row long, id long, label string, anchor boolean, key binary, vector binary"


def _key_batches(width: int, scale: float, least: np.ndarray, span: np.ndarray):
    def run(batches):
        bits = key_bits(width)
        for part in batches:
            x = whole_numbers(part.column("v"), width, scale)
            cells = np.clip((x - least) / span * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("row", "id", "label", "anchor")), pa.array(hilbert_keys(cells, bits), pa.binary()), pa.array([v.tobytes() for v in x], pa.binary())],
                                             names=["row", "id", "label", "anchor", "key", "vector"])

    return run


def in_hilbert_order(rows: DataFrame, width: int, scale: float) -> DataFrame:
    """Rows (row, id, label, anchor, v) with their key and vector of whole numbers; the curve's cube spans two deviations around each dimension's mean."""
    spread = rows.select("v").mapInArrow(_spread_batches(width, scale), "dim long, n long, s double, ss double")
    stats = {r["dim"]: r for r in spread.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")).collect()}    # one row for each dimension
    n = np.array([max(1, stats[d]["n"]) for d in range(width)], float)
    mean = np.array([stats[d]["s"] for d in range(width)]) / n
    deviation = np.sqrt(np.maximum(np.array([stats[d]["ss"] for d in range(width)]) / n - mean * mean, 1e-9))
    return materialize(rows.mapInArrow(_key_batches(width, scale, mean - 2 * deviation, 4 * deviation), KEYED), "keyed-vectors")


# --- blocks -----------------------------------------------------------------------------------

BLOCKS = "block long, label string, n int, rows binary, ids binary, known binary, small boolean, matrix binary, lo binary, hi binary"
BLOCK_NAMES = [f.split()[0] for f in BLOCKS.split(", ")]


def packed(block: int, label: str, rows: np.ndarray, ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
    small = bool(np.abs(x).max(initial=0) < 1 << 15)
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    values = [block, label, len(x), rows.tobytes(), ids.fill_null(ALL).to_numpy().astype(np.int64).tobytes(), known.tobytes(), small, x.astype(np.int16 if small else float).tobytes(), x.min(0).tobytes(), x.max(0).tobytes()]
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.bool_(), *[pa.binary()] * 3]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=BLOCK_NAMES)


def _cut_batches(size: int, width: int):
    def run(batches):
        from pyspark import TaskContext

        block, held, label = TaskContext.get().partitionId() << SHIFT, None, None
        for part in batches:
            for label_here in dict.fromkeys(part.column("label").to_pylist()):
                mine = pa.Table.from_batches([part]).filter(pa.compute.equal(part.column("label"), label_here))
                if held is not None and label != label_here:
                    yield _packed_table(block, label, held, width)
                    block, held = block + 1, None
                label, held = label_here, mine if held is None else pa.concat_tables([held, mine])
                while held.num_rows > size:
                    yield _packed_table(block, label, held.slice(0, size), width)
                    block, held = block + 1, held.slice(size)
        if held is not None and held.num_rows:
            yield _packed_table(block, label, held, width)

    return run


def _packed_table(block: int, label: str, rows: pa.Table, width: int) -> pa.RecordBatch:
    rows = rows.combine_chunks()
    x = np.frombuffer(b"".join(rows["vector"].to_pylist()), float).reshape(rows.num_rows, width)
    return packed(block, label, rows["row"].to_numpy(), rows["id"].combine_chunks(), x)


def write_blocks(keyed: DataFrame, size: int, width: int, label: str) -> DataFrame:
    """Blocks of up to ``size`` rows of one label that are neighbours on the curve; a task's blocks are numbered in that order."""
    keys = ["label", "key", F.asc_nulls_last("id"), "row"]
    cut = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("row", "id", "label", "vector").mapInArrow(_cut_batches(size, width), BLOCKS)
    path = new_path(keyed.sparkSession, label)
    cut.write.option("parquet.block.size.row.check.min", 16).parquet(path)
    return keyed.sparkSession.read.schema(BLOCKS).parquet(path)


def matrix_of(block: dict, width: int) -> np.ndarray:
    return np.frombuffer(block["matrix"], np.int16 if block["small"] else float).reshape(len(block["rows"]) // 8, width).astype(float)


def exact_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit integers; larger ones are an error."""
    width = x.shape[1]
    if width * np.abs(x).max(initial=0) * np.abs(y).max(initial=0) < EXACT:
        return (x @ y.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return (whole(x) @ whole(y).T).astype(np.int64)


# --- choosing blocks --------------------------------------------------------------------------

class Zones:
    """Zone maps of blocks of one width: which of them windows have to read."""

    def __init__(self, maps: pa.Table, width: int):
        self.blocks, self.width = maps["block"].to_numpy(), width
        self.labels = np.array(maps["label"].to_pylist(), object)
        self.lo, self.hi = (np.frombuffer(b"".join(maps[c].to_pylist()), float).reshape(len(self.blocks), width) for c in ("lo", "hi"))

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest product that each row of ``x`` can have with a row of each block: per dimension the worse end of the interval."""
        up, down = np.maximum(x, 0), np.minimum(x, 0)
        least, greatest = up @ self.lo.T + down @ self.hi.T, up @ self.hi.T + down @ self.lo.T
        large = self.width * np.abs(x).max(initial=0) * np.maximum(np.abs(self.lo), np.abs(self.hi)).max(axis=1, initial=0) >= EXACT
        least[:, large], greatest[:, large] = -np.inf, np.inf
        return least, greatest

    def promising(self, least: np.ndarray, greatest: np.ndarray, allowed: np.ndarray, lo: np.ndarray, hi: np.ndarray, seeds: int) -> np.ndarray:
        """(windows x blocks): the few blocks that each window reads first; with an upper bound, such whose middle comes near it."""
        with np.errstate(invalid="ignore"):
            worth = np.where((hi == ALL)[:, None], greatest, -np.abs(hi[:, None] - (greatest + least) / 2) / (greatest - least + 1))
        worth = np.where(allowed & reaches(least, greatest, lo, hi), np.nan_to_num(worth, nan=0.0, posinf=1e300, neginf=-1e300), -np.inf)
        take = min(seeds, worth.shape[1])
        out = np.zeros(worth.shape, bool)
        np.put_along_axis(out, np.argsort(-worth, axis=1, kind="stable")[:, :take], True, axis=1)
        return out & (worth > -np.inf)


def reaches(least: np.ndarray, greatest: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return (greatest >= lo[:, None].astype(float)) & (least <= hi[:, None].astype(float))


ASKED = "shelf long, kind int, pack long, label string, rows binary, small boolean, matrix binary, blocks binary, idx binary, w binary, lo binary, hi binary"
ASKED_NAMES = [f.split()[0] for f in ASKED.split(", ")]


def _choose_batches(sent, width: int, same_label: bool, seeds: int, shelf: int, first: bool):
    """Per pack and shelf the blocks to read: those that windows read first, or the others that reach into what is left of them."""
    def run(batches):
        zones = Zones(sent.value, width)
        for part in batches:
            for r in part.to_pylist():
                idx, w, lo, least_score, hi = (np.array(r[c]) for c in ("idx", "w", "lo", "reached", "hi"))
                x = matrix_of(r, width)
                least, greatest = (b[idx] for b in zones.bounds(x))
                allowed = (zones.labels == r["label"]) == same_label
                read = zones.promising(least, greatest, allowed[None, :], lo, hi, seeds).any(axis=0)
                if not first:
                    read = ~read & (allowed & reaches(least, greatest, least_score, hi)).any(axis=0)
                chosen = zones.blocks[read]
                shelves = shelf_of(chosen, shelf)
                for s in np.unique(shelves):
                    out = [s, 1, r["block"], r["label"], r["rows"], r["small"], r["matrix"], chosen[shelves == s].tobytes(), idx.astype(np.int32).tobytes(), w.astype(np.int32).tobytes(), least_score.tobytes(), hi.tobytes()]
                    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.bool_(), *[pa.binary()] * 6]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(out, kinds, strict=True)], names=ASKED_NAMES)

    return run


def shelf_of(block, shelf: int):
    """Shelf of block numbers: so many neighbours of one task."""
    return (block >> SHIFT << SHIFT) + (block & ((1 << SHIFT) - 1)) // shelf


def shelf_column(block: Column, shelf: int) -> Column:
    upper = F.shiftleft(F.shiftright(block, SHIFT), SHIFT)
    return upper + F.floor((block - upper) / shelf)


# --- reading blocks ---------------------------------------------------------------------------

FOUND = "pack long, idx int, w int, score long, id long, known boolean, row long"


class Best:
    """The best rows of each window so far, out of blocks that come one after the other."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray, k: int):
        self.lo, self.hi, self.k = lo.copy(), hi, k
        self.kept = [np.zeros(0, np.int64)] * 5             # window, score, id, known, row

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray, rows: np.ndarray) -> None:
        inside = (scores >= self.lo[:, None]) & (scores <= self.hi[:, None])
        many = np.flatnonzero(inside.sum(axis=1) > 4 * self.k)
        if len(many):
            some = np.where(inside[many], scores[many], NONE)
            inside[many] &= scores[many] >= np.partition(some, some.shape[1] - self.k, axis=1)[:, -self.k, None]
        window, column = np.nonzero(inside)
        new = [window, scores[window, column], ids[column], known[column], rows[column]]
        window, score, id_, known, row = (np.concatenate(p) for p in zip(self.kept, new, strict=True))
        order = np.lexsort((row, id_, ~known.astype(bool), -score, window))
        window = window[order]
        rank = np.arange(len(window)) - np.searchsorted(window, window)
        self.kept = [c[order][rank < self.k] for c in (np.concatenate([self.kept[0], new[0]]), score, id_, known, row)]
        last = self.kept[1][(rank == self.k - 1)[rank < self.k]]
        full = window[rank == self.k - 1]
        self.lo[full] = np.maximum(self.lo[full], last)


def _read_batches(width: int, k: int, same_label: bool):
    def run(batches):
        shelf, held = None, {}
        for part in batches:
            for at in range(part.num_rows):
                r = {n: part.column(n)[at].as_py() for n in part.schema.names}
                if r["shelf"] != shelf:
                    shelf, held = r["shelf"], {}
                if r["kind"] == 0:
                    held[r["pack"]] = (matrix_of(r, width), *(np.frombuffer(r[c], t) for c, t in (("ids", np.int64), ("known", bool), ("rows", np.int64))))
                    continue
                x, own = matrix_of(r, width), np.frombuffer(r["rows"], np.int64)
                idx, w, lo, hi = (np.frombuffer(r[c], t) for c, t in (("idx", np.int32), ("w", np.int32), ("lo", np.int64), ("hi", np.int64)))
                best = Best(lo, hi, k)
                chosen = [held[b] for b in np.frombuffer(r["blocks"], np.int64).tolist()]
                step = max(1, AT_ONCE // max(len(c[1]) for c in chosen))
                for j in range(0, len(chosen), step):
                    y, ids, known, rows = (np.concatenate(c) for c in zip(*chosen[j:j + step], strict=True))
                    scores = exact_products(x, y)
                    if same_label:
                        for a, b in zip(*np.nonzero(np.isin(rows, own)[None, :] & (own[:, None] == rows[None, :])), strict=True):
                            scores[a, b] = NONE             # a row is no answer to itself
                    best.add(scores[idx], ids, known, rows)
                window, score, id_, known, row = best.kept
                there = score > NONE
                window, score, id_, known, row = (c[there] for c in (window, score, id_, known.astype(bool), row))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(window), r["pack"])), pa.array(idx[window]), pa.array(w[window]), pa.array(score), pa.array(id_), pa.array(known), pa.array(row),
                ], names=["pack", "idx", "w", "score", "id", "known", "row"])

    return run


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = [F.desc("score"), F.desc("known"), F.asc("id"), F.asc("row")]
    return found.withColumn("rank", F.row_number().over(W.partitionBy("pack", "idx", "w").orderBy(*order))).where(F.col("rank") <= k)


class Index:
    """Blocks of all rows of one width and packs of the anchors among them."""

    def __init__(self, rows: DataFrame, width: int, scale: float, block: int = BLOCK, pack: int = PACK, seeds: int = SEEDS, zone_bytes: int = ZONE_BYTES):
        self.spark, self.width, self.seeds = rows.sparkSession, width, seeds
        keyed = in_hilbert_order(rows, width, scale)
        self.blocks = write_blocks(keyed, block, width, "vector-blocks")
        self.packs = write_blocks(keyed.where("anchor"), pack, width, "anchor-packs")
        self.total = self.blocks.count()
        self.shelf = int(np.clip(self.total // (4 * self.spark.sparkContext.defaultParallelism), 1, SHELF))
        self.parts = max(1, -(-self.total * (16 * width + 64) // zone_bytes))

    def _asked(self, windows: DataFrame, same_label: bool, first: bool) -> DataFrame:
        """Which packs read which blocks, for windows (pack, idx, w, lo, reached, hi)."""
        lists = windows.groupBy("pack").agg(F.sort_array(F.collect_list(F.struct("idx", "w", "lo", "reached", "hi"))).alias("x"))      # windows of one pack
        asking = self.packs.join(lists.withColumnRenamed("pack", "block"), "block").select("block", "label", "rows", "small", "matrix", *(F.col(f"x.{c}").alias(c) for c in ("idx", "w", "lo", "reached", "hi")))
        asking = asking.repartition(max(1, min(10_000, 4 * self.spark.sparkContext.defaultParallelism)), "block")
        out = None
        for part in range(self.parts):
            mine = self.blocks.where(F.pmod(F.xxhash64("block"), F.lit(self.parts)) == part)
            maps = mine.select("block", "label", "lo", "hi").orderBy("block").toArrow()
            sent = self.spark.sparkContext.broadcast(maps)
            asked = asking.mapInArrow(_choose_batches(sent, self.width, same_label, self.seeds, self.shelf, first), ASKED)
            out = asked if out is None else out.union(asked)
        return materialize(out, "visits")

    def _read(self, asked: DataFrame, k: int, same_label: bool) -> DataFrame:
        shelves = shelf_column(F.col("block"), self.shelf)
        wanted = asked.select("shelf").distinct()
        held = self.blocks.withColumn("shelf", shelves).join(wanted, "shelf", "left_semi")
        empty = F.lit(None).cast("binary")
        stock = held.select("shelf", F.lit(0).alias("kind"), F.col("block").alias("pack"), "label", "rows", "small", "matrix", *(empty.alias(c) for c in ("blocks", "idx", "w", "lo", "hi")), "ids", "known")
        stream = stock.unionByName(asked.withColumns({"ids": empty, "known": empty}))
        tasks = int(np.clip(2 * self.total // self.shelf, 1, 20_000))
        # the number is given, as little data can mean much work here
        return stream.repartition(tasks, "shelf").sortWithinPartitions("shelf", "kind", "pack").mapInArrow(_read_batches(self.width, k, same_label), FOUND)

    def search(self, windows: DataFrame, k: int, same_label: bool) -> DataFrame:
        """The ``k`` best rows, of the own label or of other ones, for each window (pack, idx, w, lo, hi): FOUND and their rank."""
        first = windows.withColumn("reached", F.col("lo"))
        early = materialize(best_of(self._read(self._asked(first, same_label, True), k, same_label), k), "found-first")
        last = early.where(F.col("rank") == k).select("pack", "idx", "w", F.col("score").alias("least"))
        # what is left of a window begins at the last wanted score so far: equal scores can still win by their id
        left = windows.join(last, ["pack", "idx", "w"], "left").withColumn("reached", F.coalesce(F.greatest("lo", "least"), F.col("lo"))).drop("least")
        late = self._read(self._asked(left, same_label, False), k, same_label)
        return materialize(best_of(early.drop("rank").unionByName(late), k), "found")


def _anchor_batches(batches):
    """(pack, idx, anchor_id) of packs."""
    for part in batches:
        for block, ids, known in zip(*(part.column(c).to_pylist() for c in ("block", "ids", "known")), strict=True):
            ids = pa.array(np.frombuffer(ids, np.int64), mask=~np.frombuffer(known, bool))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), block)), pa.array(np.arange(len(ids), dtype=np.int32)), ids], names=["pack", "idx", "anchor_id"])


def mine_width(rows: DataFrame, width: int, scale: float, positives: int, negatives: int, low: int, high: int, **options) -> DataFrame:
    index = Index(rows, width, scale, **options)
    anchors = index.packs.select("block", "ids", "known").mapInArrow(_anchor_batches, "pack long, idx int, anchor_id long")
    wide = anchors.select("pack", "idx", F.lit(0).alias("w"), F.lit(NONE + 1).cast("long").alias("lo"), F.lit(ALL).cast("long").alias("hi"))
    near = index.search(wide, positives, True)
    own = near.where("score >= 0")          # a negative score times these shares leaves no window
    windows = own.select("pack", "idx", F.col("rank").alias("w"), F.expr(f"({low} * score + 99) div 100").alias("lo"), F.expr(f"({high} * score) div 100").alias("hi")).where("lo <= hi")
    far = index.search(windows, negatives, False)
    pairs = own.select("pack", "idx", F.col("rank").alias("w"), F.when(F.col("known"), F.col("id")).alias("positive_id"), F.col("score").alias("positive_score"))
    hard = far.select("pack", "idx", "w", F.col("rank").cast("int").alias("rank"), F.when(F.col("known"), F.col("id")).alias("negative_id"), F.col("score").alias("negative_score"))
    return hard.join(pairs, ["pack", "idx", "w"]).join(anchors, ["pack", "idx"])


OUT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def hard_negatives(vectors: DataFrame, anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = SCALE,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, **options) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows where ``anchor`` holds.

    Components become ``floor(scale * x)``, a score is the inner product of these. An anchor's positives are its best other
    rows of the same label; each has as negatives the best rows of other labels with a score from ``low`` to ``high`` per cent of its own.

    Rows with a null label or vector, or with a component that is null or not finite, take no part. Vectors compare only with
    vectors of their length. Ties go to the smaller id, no id last; rows with equal ids are rows of their own. Anchors without
    positives or negatives have no rows. Other columns are ignored; no rows: no rows. Scores beyond 64 bits are an error.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(v.isNotNull() & F.coalesce(fine, F.lit(False)))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("string").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), v.alias("v")).where("label is not null")
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for width in sorted(r.w for r in rows.where("anchor").select(F.size("v").alias("w")).distinct().collect()):
        mined = mine_width(rows.where(F.size("v") == width), width, scale, positives, negatives, low, high, **options)
        out = out.union(mined.select(*OUT))
    return out


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, relabelled)


QUERIES = {"op11_hard_negatives": op11_hard_negatives}
ORACLES = {
    "op11_hard_negatives": """
        WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, a.label AS own, e.vec_id, e.label, list_sum(list_transform(list_zip(a.v, e.v), lambda p: p[1] * p[2]))::BIGINT AS score
              FROM e a JOIN e ON a.vec_id % 50 = 0 AND e.vec_id <> a.vec_id),
        p AS (SELECT anchor_id, vec_id, score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE label = own),
        n AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
                     row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
              FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.own AND p.r <= 5 AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
        SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""
}
