"""Approximate nearest neighbours: stable projections under a kd-tree, with a chi-square stopping test.

Vectors are scaled to length one, where the largest cosine is the smallest
distance, and projected to a few Gaussian coordinates. The squared projected
distance of two vectors over their squared distance is chi-square distributed
with as many degrees of freedom. So once the projected distance of everything
unseen exceeds the k-th best distance times the chi-square quantile, a nearer
vector would have been seen with at least that probability, and a search stops.

The kd-tree has two tiers. Its upper splits are fitted on a bounded sample and
cut the rows into cells; a cell of many rows is dealt to parts. A task holds one part,
builds the lower tier of leaves, and visits leaves in the order of their
projected distance from a query. A query searches its own cell first; with the
distance found there it goes on to those other cells only that the test does
not rule out. Every row is in exactly one cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from offerloom.llm.common import stored

#: Projected coordinates; even, for the closed form of the chi-square distribution.
COORDINATES = 8
#: Probability of the stopping test.
CONFIDENCE = 0.98
#: Bound of the rows that the upper splits are fitted on.
SAMPLE_ROWS = 20_000
#: Rows that a cell should have, and rows of a part and queries of a block at most (about).
CELL_ROWS = 2048
PART_ROWS = 8192
BLOCK_QUERIES = 4096
LEAF_ROWS = 64
#: Leaves visited before the stopping test is first made.
FIRST_LEAVES = 4
SEED = 29


def chi_square(x: float, degrees: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for i in range(1, degrees // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi_square_quantile(p: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, degrees) < p else (low, mid)
    return high


def _projection(width: int) -> np.ndarray:
    return np.random.default_rng([SEED, width]).normal(size=(width, COORDINATES))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector by the power of two that brings its largest number near one: exact, and squares stay finite."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=-1, keepdims=True))[1])


def _projected(vectors: np.ndarray) -> np.ndarray:
    scaled = _scaled(vectors)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True) @ _projection(vectors.shape[1])


class Splits:
    """Upper kd-tree: nodes (axis, value) in heap order, leaves are cells."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.axis, self.value = np.zeros(2**depth, dtype=np.int64), np.zeros(2**depth)
        groups = {1: points}
        for node in range(1, 2**depth):
            own = groups.pop(node)
            if len(own):
                self.axis[node] = int(np.argmax(own.var(axis=0)))
                self.value[node] = float(np.median(own[:, self.axis[node]]))
            right = own[:, self.axis[node]] > self.value[node]
            groups[2 * node], groups[2 * node + 1] = own[~right], own[right]

    def cells(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), dtype=np.int64)
        for _ in range(self.depth):
            node = 2 * node + (points[np.arange(len(points)), self.axis[node]] > self.value[node])
        return node - 2**self.depth


def _leaves(points: np.ndarray) -> list[np.ndarray]:
    """Lower kd-tree: row numbers of its leaves."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= LEAF_ROWS:
            out.append(rows)
            continue
        own = points[rows]
        axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
        order = np.argpartition(own[:, axis], len(rows) // 2)
        todo += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return out


def _box_distances(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    gap = np.maximum(np.maximum(low - point, point - high), 0)
    return np.einsum("ij,ij->i", gap, gap)


_FOUND = "query long, query_id long, vec_id long, uid long, score double"


def _search(k: int, quantile: float):
    """Queries and rows of one part -> the part's best rows of each query."""

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(rows):
            vectors = _scaled(np.array(rows["vector"].tolist(), dtype=np.float64))
            points = np.array(rows["point"].tolist(), dtype=np.float64)
            ids, uids = rows["vec_id"].to_numpy(), rows["uid"].to_numpy()
            norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
            leaves = _leaves(points)
            low = np.array([points[x].min(axis=0) for x in leaves])
            high = np.array([points[x].max(axis=0) for x in leaves])
            for uid, vec_id, vector, point, known in zip(
                queries["uid"], queries["vec_id"], queries["vector"], queries["point"], queries["known"]
            ):
                vector = _scaled(np.asarray(vector, dtype=np.float64))
                norm = math.sqrt(np.einsum("i,i->", vector, vector))
                near = _box_distances(np.asarray(point), low, high)
                order = np.argsort(near, kind="stable")
                # of the rows seen: (score, row), and the k-th best squared distance so far
                seen, scores, bound, at, step = [], [], known, 0, FIRST_LEAVES
                while at < len(order) and near[order[at]] <= quantile * bound:
                    stop = at + int(np.searchsorted(near[order[at : at + step]], quantile * bound, side="right"))
                    mine = np.concatenate([leaves[x] for x in order[at:stop]])
                    mine = mine[uids[mine] != uid]
                    at, step = stop, len(order)
                    seen.append(mine)
                    scores.append(np.einsum("ij,j->i", vectors[mine], vector) / (norms[mine] * norm))
                    every = np.concatenate(scores)
                    if len(every) >= k:
                        kth = -np.partition(-every, k - 1)[k - 1]
                        bound = min(bound, max(2 - 2 * kth, 0.0) + 1e-12)
                if seen:
                    mine, every = np.concatenate(seen), np.concatenate(scores)
                    best = np.lexsort((uids[mine], ids[mine], -every))[:k]
                    out += [(uid, vec_id, ids[mine[b]], uids[mine[b]], every[b]) for b in best]
        return pd.DataFrame(out, columns=["query", "query_id", "vec_id", "uid", "score"])

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query, from the k best of each part it searched."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _of_width(rows: DataFrame, width: int, k: int, every: int) -> DataFrame:
    """Neighbours among the vectors of one length."""
    own = rows.where(F.size("vector") == width)
    count = own.count()
    sample = own.orderBy(F.xxhash64("vec_id"), "uid").limit(SAMPLE_ROWS).select("vector").toPandas()
    depth = max(0, min(math.ceil(math.log2(max(count, 1) / CELL_ROWS)), int(math.log2(max(len(sample) // 16, 1)))))
    splits = Splits(_projected(np.array(sample["vector"].tolist(), dtype=np.float64)), depth)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                points = _projected(np.array(frame["vector"].tolist(), dtype=np.float64))
                yield frame.assign(point=list(points), cell=splits.cells(points))

    schema = "uid long, vec_id long, vector array<float>, point array<double>, cell long"
    index = stored(own.mapInPandas(place, schema.replace("float", rows.schema["vector"].dataType.elementType.simpleString())), "index")
    query = index.where(F.col("vec_id") % every == 0)
    point = [F.element_at("point", i + 1) for i in range(COORDINATES)]
    stats = index.groupBy("cell").agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("q"),
        F.array(*map(F.min, point)).alias("low"),
        F.array(*map(F.max, point)).alias("high"),
    ).orderBy("cell").collect()  # at most a row per sixteen sampled ones
    cells = np.array([r.cell for r in stats], dtype=np.int64)
    low, high = np.array([r.low for r in stats]), np.array([r.high for r in stats])
    quantile = chi_square_quantile(CONFIDENCE, COORDINATES)
    spark = rows.sparkSession

    def searched(asked: DataFrame, asks: dict[int, int]) -> DataFrame:
        """``asked(uid, vec_id, vector, point, known, cell)``: each query in its cell. asks: queries per cell."""
        layout = spark.createDataFrame(
            [(r.cell, -(-r.n // PART_ROWS), max(1, -(-asks.get(r.cell, 0) // BLOCK_QUERIES))) for r in stats if asks.get(r.cell)],
            "cell long, parts long, blocks long",
        )
        held = index.join(F.broadcast(layout), "cell").withColumn("part", F.pmod(F.xxhash64("uid"), "parts"))
        held = held.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        wants = asked.join(F.broadcast(layout), "cell").withColumn("block", F.pmod(F.xxhash64("uid", F.lit(1)), "blocks"))
        wants = wants.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        keys = ["cell", "part", "block"]
        left = wants.select(*keys, "uid", "vec_id", "vector", "point", "known").groupBy(*keys)
        names = [*keys, "uid", "vec_id", "vector", "point"]
        right = held.select(*[F.col(c).alias(c) for c in names]).groupBy(*keys)  # columns of its own: it joins itself
        return left.cogroup(right).applyInPandas(_search(k, quantile), _FOUND)

    far = F.lit(float("inf"))
    first = stored(_best(searched(query.withColumn("known", far), {r.cell: r.q for r in stats}), k).drop("rank"), "first")
    # the k-th best distance of the own cell; unknown while it has fewer rows
    kth = first.groupBy("query").agg(F.count("*").alias("held"), F.min("score").alias("score"))
    kth = kth.select(
        F.col("query").alias("uid"),
        F.when(F.col("held") >= k, F.greatest(2 - 2 * F.col("score"), F.lit(0.0)) + 1e-12).alias("kth"),
    )
    bounded = query.join(kth, "uid", "left").withColumn("known", F.coalesce("kth", far)).drop("kth")

    def others(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ask = []
            for p, known, cell in zip(frame["point"], frame["known"], frame["cell"]):
                near = _box_distances(np.asarray(p), low, high) <= quantile * known
                ask.append(cells[near & (cells != cell)])
            yield frame.assign(ask=ask)[["uid", "vec_id", "vector", "point", "known", "ask"]]

    vector = index.schema["vector"].dataType.simpleString()
    asked = bounded.mapInPandas(
        others, f"uid long, vec_id long, vector {vector}, point array<double>, known double, ask array<long>"
    )
    asked = stored(asked, "asked").withColumn("cell", F.explode("ask")).drop("ask")
    asks = {r.cell: r.n for r in asked.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    second = searched(asked, asks) if asks else first.limit(0)
    return _best(first.unionByName(second), k)


def nearest_neighbours(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """``vectors(vec_id, embedding)`` -> ``(query_id, rank, vec_id, score)``.

    Queries are the rows whose vec_id is divisible by ``every``; each gets its
    ``k`` rows of largest cosine among all rows but itself, or all of them if
    there are fewer, nearest first, ties by vec_id. Rows with a NULL id, and
    vectors that are NULL, empty, zero, or hold NULLs or non-finite numbers
    take no part. Vectors of different lengths are not compared. A repeated row
    is a row of its own: a neighbour of its twin, and a query of its own. An
    empty table gives an empty result. Further columns are not read.
    """
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vec_id").isNotNull() & finite & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector")
    )
    rows = stored(rows, "vectors")
    widths = [r[0] for r in rows.select(F.size("vector")).distinct().collect()]
    out = None
    for width in sorted(widths):
        part = _of_width(rows, width, k, every)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
