"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut into halves, each with its own codebook; a cell is a pair of
codewords. Every vector lies in the cell of its nearest codewords and is also
sent to further cells: a multi-sequence traversal visits them in the order of the
sum of both halves' distances, until the visited cells hold the wanted share of
the neighbours. Where a neighbour at the threshold may lie follows from the
distances: a cell counts until the extra distance to it, compared with the
distance that a link can have, makes it unlikely. Pairs that meet in a cell are
verified in double precision, and each is counted in one cell only.

Cells with many vectors are dealt out as pairs of blocks.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import materialize
from .batches import sorted_groups, table
from .components import components
from .simhash import _forest

#: Smallest cosine of a link.
THRESHOLD = 0.95
#: Vectors that codebooks are trained on: so many, and with more codewords so many of each. Rounds of training, codewords of a half at most.
SAMPLE, PER_WORD, ROUNDS, MOST_WORDS = 8_192, 32, 6, 1_024
#: Vectors of a cell, on average over the product grid, that the number of codewords aims at.
PER_CELL = 16
#: Share of pairs exactly at the threshold that the visited cells have to hold; vectors outside the training sample, and pairs of them, that it is measured on.
TARGET_RECALL, HELD_OUT, PAIRS = 0.995, 2_048, 4_096
#: Vectors of a block of a large cell.
BLOCK = 512


def usable(vector_col: str) -> Column:
    """The vector as doubles; null where it is null, zero or not finite."""
    v = F.col(vector_col).cast("array<double>")
    fine = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return F.when(F.coalesce(fine, F.lit(False)), v)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Unit rows in double precision; scaled by the largest component first, so that squares neither overflow nor vanish."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(float)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def squared_distances(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ words.T + (words * words).sum(1)[None, :], 0)


def codebook(x: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """k-means; empty words keep their place."""
    words = x[rng.choice(len(x), min(count, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        near = np.concatenate([squared_distances(x[at:at + 2048], words).argmin(1) for at in range(0, len(x), 2048)])
        sums = np.zeros_like(words)
        np.add.at(sums, near, x)
        sizes = np.bincount(near, minlength=len(words))
        words[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return words


def visited_cells(left: np.ndarray, right: np.ndarray, count: int) -> list[int]:
    """The ``count`` cells nearest by the sum of both halves' distances, in that order: a cell is left word x words + right word."""
    words = len(right)
    order_l, order_r = left.argsort(), right.argsort()
    heap, seen, out = [(left[order_l[0]] + right[order_r[0]], 0, 0)], {(0, 0)}, []
    while heap and len(out) < count:
        _, i, j = heapq.heappop(heap)
        out.append(int(order_l[i]) * words + int(order_r[j]))
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(left) and b < words and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (left[order_l[a]] + right[order_r[b]], a, b))
    return out


def words_of(total: int) -> int:
    """Codewords of a half for a table of ``total`` vectors."""
    return int(np.clip(round((total / PER_CELL) ** 0.5), 1, MOST_WORDS))


def sample_size(total: int) -> int:
    """Vectors to train the codebooks of such a table on and to measure the recall with."""
    return max(SAMPLE, PER_WORD * words_of(total)) + HELD_OUT


class Index:
    """Codebooks of both halves and the number of cells to visit.

    The number is measured on vectors that the codebooks have not seen, each turned
    to the threshold in random directions: the rank, in the order of one vector's
    traversal, of the cell of the other. It has no limit but the number of cells.
    """

    def __init__(self, sample: np.ndarray, total: int, threshold: float):
        rng = np.random.default_rng(7)
        self.half = sample.shape[1] // 2
        sample = sample[rng.permutation(len(sample))]
        held = min(HELD_OUT, len(sample) // 5)
        train = sample[held:]
        words = min(words_of(total), len(train))
        self.left, self.right = codebook(train[:, :self.half], words, rng), codebook(train[:, self.half:], words, rng)
        some = sample[np.arange(PAIRS) % max(1, held)]
        turn = rng.standard_normal(some.shape)
        turn -= (turn * some).sum(1, keepdims=True) * some
        turn /= np.maximum(np.linalg.norm(turn, axis=1, keepdims=True), 1e-12)
        others = threshold * some + (1 - threshold * threshold) ** 0.5 * turn
        ranks = np.sort(np.concatenate([self.ranks(some[at:at + 512], others[at:at + 512]) for at in range(0, PAIRS, 512)]))
        self.count = int(ranks[int(np.ceil(TARGET_RECALL * PAIRS)) - 1]) + 1

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return squared_distances(x[:, :self.half], self.left), squared_distances(x[:, self.half:], self.right)

    def ranks(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many cells each pair of rows visits before the one visits the other's own cell, whichever does first."""
        both = [self.distances(x), self.distances(y)]
        own = [(left.argmin(1), right.argmin(1)) for left, right in both]
        out = []
        for k in range(len(x)):
            found = []
            for (left, right), (a, b) in zip(both, own[::-1], strict=True):
                limit = left[k, a[k]] + right[k, b[k]]
                found.append(np.searchsorted(np.sort(right[k]), limit - left[k]).sum())
            out.append(min(found))
        return np.array(out)

    def cells(self, x: np.ndarray, count: int | None = None) -> list[list[int]]:
        left, right = self.distances(x)
        return [visited_cells(a, b, count or self.count) for a, b in zip(left, right, strict=True)]


def _visit_batches(index: Index, width: int):
    def run(batches):
        for part in batches:
            for at in range(0, part.num_rows, 2048):
                rows = part.slice(at, 2048)
                cells = index.cells(matrix(rows.column("v"), width))
                yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array(cells, pa.list_(pa.int32()))], names=["row", "cells"])

    return run


LINKED = "class long, n long, least long"


def _unit_batches(threshold: float):
    """Links of each unit: per class of it that has some the number of rows it links to, and the least class it is held together with."""
    def run(batches):
        for rows, cuts in sorted_groups(batches, ["cell", "unit"]):
            bounds = np.append(cuts, len(rows["row"])) if cuts[-1] != len(rows["row"]) else cuts
            out = [(np.zeros(0, np.int64),) * 3]
            for start, stop in zip(bounds[:-1], bounds[1:], strict=True):
                if stop - start < 2:
                    continue
                g = {k: x[start:stop] for k, x in rows.items()}
                v = g["v"] / np.abs(g["v"]).max(axis=1, keepdims=True)
                v /= np.linalg.norm(v, axis=1, keepdims=True)
                one = np.flatnonzero(g["side"] == 0)
                two = one if g["alone"][0] else np.flatnonzero(g["side"] == 1)
                x, y = np.nonzero(v[one] @ v[two].T >= threshold)
                x, y = one[x], two[y]
                if g["alone"][0]:
                    x, y = x[x < y], y[x < y]
                else:
                    # a pair of two cells that visit each other meets twice: it counts in the smaller cell
                    cell, other = g["cell"][0], g["home"][y]
                    twice = (other != cell) & (other < cell)
                    twice[twice] = (g["cells"][x[twice]] == other[twice, None]).any(axis=1)
                    x, y = x[~twice], y[~twice]
                if not len(x):
                    continue
                number = np.zeros(stop - start, np.int64)
                np.add.at(number, x, g["weight"][y])
                np.add.at(number, y, g["weight"][x])
                own, root = _forest(int(stop - start), x, y)
                least = np.arange(stop - start)
                least[own] = root
                some = np.flatnonzero(number)
                out.append((g["row"][some], number[some], g["row"][least[some]]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out, strict=True)], names=["class", "n", "least"])

    return run


def _units(visits: DataFrame, block: int) -> DataFrame:
    """(row, cell, unit, side, alone): each vector in every unit, a pair of blocks of a cell, that it takes part in.

    A cell's members are in blocks 0 to A-1, its visitors in blocks from A on. Unit
    (i, j) compares member block i with block j >= i; with i = j it compares the block with itself.
    """
    seen = visits.select("row", F.posexplode("cells").alias("rank", "cell"))
    sizes = seen.groupBy("cell").agg(F.sum((F.col("rank") == 0).cast("long")).alias("members"), F.sum((F.col("rank") > 0).cast("long")).alias("visitors"))
    sizes = sizes.where("members > 0").select("cell", F.ceil(F.col("members") / block).cast("int").alias("am"), F.ceil(F.col("visitors") / (4 * block)).cast("int").alias("av"))
    dealt = seen.join(sizes, "cell")
    own = F.when(F.col("rank") == 0, F.pmod(F.xxhash64("row"), F.col("am"))).otherwise(F.col("am") + F.pmod(F.xxhash64("row"), F.greatest("av", F.lit(1)))).cast("int")
    dealt = dealt.withColumn("own", own)
    others = F.when(F.col("rank") == 0, F.sequence(F.lit(0), F.col("am") + F.col("av") - 1)).otherwise(F.sequence(F.lit(0), F.col("am") - 1))
    dealt = dealt.select("row", "cell", "own", F.explode(others).alias("other"))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return dealt.select("row", "cell", (F.shiftleft(low.cast("long"), 31) + high).alias("unit"), (F.col("own") > F.col("other")).cast("int").alias("side"), (low == high).alias("alone"))


def links(rows: DataFrame, width: int, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(class, n, least) of different vectors (row, weight, v) of ``width`` components: parts of the numbers of rows that they link to, and classes held together."""
    total = rows.count()
    size = sample_size(total)
    share = min(1.0, 0.9 * size / max(1, total))
    chosen = rows.where(F.pmod(F.xxhash64("row"), 1 << 40) < share * (1 << 40)).select("v").limit(size).toArrow()["v"].combine_chunks()
    sample = matrix(chosen if len(chosen) else rows.select("v").limit(1).toArrow()["v"].combine_chunks(), width)
    visits = materialize(rows.select("row", "v").mapInArrow(_visit_batches(Index(sample, total, threshold), width), "row long, cells array<int>"), "visits")
    units = _units(visits, block).join(rows, "row").join(visits, "row")
    laid = units.select("cell", "unit", "side", F.col("alone").cast("int").alias("alone"), "row", "weight", F.col("cells")[0].alias("home"), "cells", "v")
    return laid.repartition("cell", "unit").sortWithinPartitions("cell", "unit", "side", "row").mapInArrow(_unit_batches(threshold), LINKED)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Null, zero and non-finite vectors link with nothing, and vectors link only
    with vectors of their length. Equal vectors become one class that counts for
    all its rows, so any number of copies costs one vector. Rows with a repeated id
    link by their own vectors; rows without an id link like any other and give no
    component its id. Other columns are ignored; no rows: no rows.
    """
    spark = vectors.sparkSession
    rows = materialize(vectors.select(F.col(id_col).cast("long").alias("vec_id"), usable(vector_col).alias("v")), "vectors")
    equal = rows.where("v is not null").groupBy("v").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    classes = materialize(equal.withColumn("row", F.monotonically_increasing_id()), "vector-classes")
    widths = [r.w for r in classes.select(F.size("v").alias("w")).distinct().collect()]
    found = spark.createDataFrame([], LINKED)
    for width in widths:
        found = found.union(links(classes.where(F.size("v") == width).select("row", "weight", "v"), width, threshold, block))
    found = materialize(found, "vector-links")
    numbers = found.groupBy("class").agg(F.sum("n").alias("n"))
    parts = components(found, "class", "least").withColumnRenamed("id", "row")
    grouped = materialize(classes.join(parts, "row", "left").select("row", "weight", "least", F.coalesce("component", "row").alias("group")), "vector-groups")
    ids = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    of_class = grouped.join(ids, "group").join(numbers.withColumnRenamed("class", "row"), "row", "left")
    of_class = of_class.select("row", "component_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    of_vector = classes.select("row", "v").join(of_class, "row").drop("row")
    component = F.coalesce("component_id", "vec_id")
    out = rows.join(of_vector, "v", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES = {"op7_embedding_near_dedup": op7_embedding_near_dedup}
