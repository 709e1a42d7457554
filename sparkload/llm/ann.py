"""Nearest neighbours by inner product: a hierarchical k-means tree searched best bin first."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import col, stored, with_ids, without_ids

SAMPLE_ROWS = 20_000  # expected number of vectors the tree is fitted on
BRANCHES = 8
LEAF_ROWS = 100  # sampled vectors below which a node is not split
CALIBRATION_QUERIES = 200  # expected number of queries searched exhaustively to choose the visits
TARGET_RECALL = 0.97
BLOCK_ROWS = 20_000  # vectors of a leaf that meet a block of its queries in one task
QUERY_ROWS = 20_000  # queries in such a block


@dataclass
class Node:
    """``centres`` of the children, which are nodes or, as numbers, leaves."""

    centres: np.ndarray
    children: list[Node | int]


@dataclass
class Tree:
    """k-means tree over vectors extended by one coordinate to the length of the longest.

    On the extended vectors the largest inner product is the smallest distance, since all have the
    same length and queries have 0 in the added place.
    """

    root: Node | int = 0
    leaves: int = 1
    radius2: float = 0.0  # squared length of the longest vector
    length: int = 0

    def extended(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.radius2 - np.einsum("ij,ij->i", x, x)))
        return np.hstack([x, rest[:, None]])

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest centre at every node."""
        x = self.extended(x)
        out = np.zeros(len(x), np.int32)
        stack = [(self.root, np.arange(len(x)))]
        while stack:
            node, rows = stack.pop()
            if isinstance(node, int):
                out[rows] = node
                continue
            nearest = _distances(x[rows], node.centres).argmin(axis=1)
            for k, child in enumerate(node.children):
                if (nearest == k).any():
                    stack.append((child, rows[nearest == k]))
        return out

    def visits(self, query: np.ndarray, limit: int, counts: dict[int, int] | None = None, least: int = 0) -> list[int]:
        """The first ``limit`` leaves of a best-bin-first search: the queue holds branches by the distance of their centre.

        With the rows of each leaf as ``counts`` it goes on until the leaves hold ``least`` rows, if there are so many.
        """
        q = np.append(query, 0.0)[None, :]
        queue: list[tuple[float, int, Node | int]] = [(0.0, 0, self.root)]
        found: list[int] = []
        pushed = rows = 0
        while queue and (len(found) < limit or rows < least):
            _, _, node = heapq.heappop(queue)
            while not isinstance(node, int):
                distances = _distances(q, node.centres)[0]
                best = int(distances.argmin())
                for k, child in enumerate(node.children):
                    if k != best:
                        pushed += 1
                        heapq.heappush(queue, (float(distances[k]), pushed, child))
                node = node.children[best]
            found.append(node)
            rows += counts.get(node, 0) if counts else 0
        return found


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances less each row's own square, which does not change their order."""
    return np.einsum("ij,ij->i", centres, centres) - 2 * x @ centres.T


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centres = x[rng.choice(len(x), k, replace=False)]
    nearest = np.zeros(len(x), np.int64)
    for _ in range(steps):
        nearest = _distances(x, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        counts = np.bincount(nearest, minlength=k)
        full = counts > 0
        moved = sums[full] / counts[full, None]
        if np.allclose(moved, centres[full]):
            break
        centres = centres.copy()
        centres[full] = moved
    keep = np.unique(nearest)
    return centres[keep], np.searchsorted(keep, nearest)


def fit_tree(sample: np.ndarray, radius2: float, branches: int = BRANCHES, leaf_rows: int = LEAF_ROWS, seed: int = 7) -> Tree:
    tree = Tree(radius2=radius2, length=sample.shape[1] if sample.ndim == 2 else 0)
    rng = np.random.default_rng(seed)
    x = tree.extended(sample) if len(sample) else sample
    leaves = 0

    def grow(rows: np.ndarray) -> Node | int:
        nonlocal leaves
        if len(rows) > max(leaf_rows, branches):
            centres, nearest = _kmeans(x[rows], branches, rng)
            if len(centres) > 1:  # else the vectors are all alike
                return Node(centres, [grow(rows[nearest == k]) for k in range(len(centres))])
        leaves += 1
        return leaves - 1

    tree.root = grow(np.arange(len(sample)))
    tree.leaves = max(1, leaves)
    return tree


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v``: one row an id; without null, zero or non-finite vectors, or of another length than most of them.

    Rows that repeat an id count once, with the smallest of their vectors.
    """
    v = col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = vectors.select(col(id_col).cast("long").alias("id"), v.alias("v")).filter("id is not null and v is not null")
    rows = rows.filter(finite & F.exists("v", lambda x: x != 0.0))
    repeated = rows.groupBy("id").count().filter("count > 1").select("id")
    single = with_ids(rows, repeated).groupBy("id").agg(F.min("v").alias("v"))
    return without_ids(rows, repeated).unionAll(single)


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _top(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For some queries at a time: query, row and score of the ``k`` best rows other than the query itself.

    Scores are sums in one fixed order, the same wherever a pair is scored; ties go to the smaller id.
    """
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    step = max(1, 2_000_000 // max(1, len(ids)))
    for low in range(0, len(query_ids), step):
        q, own = queries[low : low + step], query_ids[low : low + step]
        rough = q @ vectors.T
        rough[own[:, None] == ids[None, :]] = -np.inf
        n = min(k, len(ids))
        for i in range(len(own)):
            cut = np.partition(rough[i], len(ids) - n)[len(ids) - n] if n < len(ids) else -np.inf
            slack = 1e-9 * (1.0 + abs(cut)) if np.isfinite(cut) else 0.0
            near = np.flatnonzero((rough[i] >= cut - slack) & (rough[i] > -np.inf))
            exact = inner_products(q[i], vectors[near])
            best = np.argsort(-exact, kind="stable")[:k]
            yield np.full(len(best), own[i]), ids[near[best]], exact[best]


def inner_products(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products added up coordinate by coordinate, as a loop over the components would."""
    total = np.zeros(len(rows))
    for j in range(len(query)):
        total += query[j] * rows[:, j]
    return total


@dataclass
class Index:
    """Rows with their leaf and block, how many blocks each leaf has, and the calibrated number of visits."""

    tree: Tree
    rows: DataFrame  # id, v, leaf, block
    blocks: dict[int, int] = field(default_factory=dict)
    counts: dict[int, int] = field(default_factory=dict)  # rows of each leaf
    visits: int = 1
    recall: float | None = None


def build_index(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    sample_rows: int = SAMPLE_ROWS,
    branches: int = BRANCHES,
    leaf_rows: int = LEAF_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> Index:
    """Fit the tree on a bounded sample and put every row into its leaf.

    ``sample_rows`` is the expected size of the sample, drawn by a hash of the id. A leaf of more than
    ``block_rows`` rows is dealt over several blocks by the same hash, so that a leaf with a third of all rows (copies of
    one vector) is many tasks. The driver holds the sample, the tree and one number per leaf. A vector that is shorter
    than the longest counts as one with zeros behind, which leaves inner products with vectors of its length as they are.
    """
    rows = stored(usable_vectors(vectors, id_col, vector_col), "vectors")
    sizes = rows.agg(F.max(F.size("v")).alias("d"), F.min(F.size("v")).alias("low"), F.count(F.lit(1)).alias("count")).first()
    if not sizes["count"]:
        return Index(Tree(), rows.withColumn("leaf", F.lit(0)).withColumn("block", F.lit(0)))
    if sizes.low < sizes.d:
        rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(sizes.d) - F.size("v"))))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    radius2 = rows.agg(F.max(square)).first()[0]
    draw = F.pmod(F.xxhash64(F.lit("tree"), "id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = rows.filter(draw < sample_rows / sizes["count"]).orderBy("id").select("v").toArrow()
    x = np.vstack([_matrix(c) for c in sample.column("v").chunks if len(c)]) if sample.num_rows else np.zeros((0, sizes.d))
    tree = fit_tree(x, radius2, branches, leaf_rows)
    leaf = _leaf_column(tree)
    placed = stored(rows.withColumn("leaf", leaf("v")), "leaves")
    counts = {r.leaf: r["count"] for r in placed.groupBy("leaf").count().collect()}  # bounded by the sample
    blocks = {k: -(-n // block_rows) for k, n in counts.items()}
    block = F.pmod(F.xxhash64(F.lit("block"), "id"), F.col("many").cast("long")).cast("int")
    placed = _with_number(placed, blocks, "many").withColumn("block", block).drop("many")
    return Index(tree, placed, blocks, counts)


def _with_number(rows: DataFrame, of: dict[int, int], name: str) -> DataFrame:
    """Rows with the number of their leaf, 1 where it has none: a broadcast join, as an expression over all leaves
    would be as deep as there are leaves and from some hundreds on overflow the stack of Spark's planner."""
    more = [(leaf, n) for leaf, n in of.items() if n > 1]
    numbers = rows.sparkSession.createDataFrame(more, f"leaf int, {name} int")
    return rows.join(F.broadcast(numbers), "leaf", "left").withColumn(name, F.coalesce(name, F.lit(1)))


def _leaf_column(tree: Tree):
    @F.pandas_udf("int")
    def leaf(v: pd.Series) -> pd.Series:
        return pd.Series(tree.leaf_of(np.vstack(v.to_numpy())) if len(v) else [], dtype="int32")

    return leaf


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query from the best of its blocks: ``query_id, rank, id, score``.

    Spark keeps ``k`` rows a query in every task before it shuffles them.
    """
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    ranked = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")


_FOUND = "query_id long, id long, score double"


def search(index: Index, queries: DataFrame, k: int, visits: int | None = None, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, id, score`` of the nearest rows found for the queries ``id, v``.

    Queries go to the blocks of the leaves that their search visits. A leaf with more than ``query_rows`` queries has
    them dealt by a hash as well, so that a cogrouped task holds a bounded number of rows and of queries however
    large a leaf and its demand are. A query's visits go on until its leaves hold ``k`` rows besides its own, so only a
    table of fewer gives fewer than ``k``.
    """
    tree, blocks, counts, limit = index.tree, index.blocks, index.counts, visits or index.visits

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            found = [(i, leaf) for i, v in enumerate(_matrix(batch.column("v"))) for leaf in tree.visits(v, limit, counts, k + 1)]
            at, leaf = (np.array(x, np.int32) for x in zip(*found)) if found else (np.zeros(0, np.int32),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(leaf)], ["id", "leaf"])

    routed = stored(queries.mapInArrow(route, "id long, leaf int"), "visits")
    asked = {r.leaf: r["count"] for r in routed.groupBy("leaf").count().collect()}  # a number for each leaf
    parts = {leaf: -(-n // query_rows) for leaf, n in asked.items()}
    part = F.pmod(F.xxhash64(F.lit("part"), "id"), F.col("many_parts").cast("long")).cast("int")
    sent = _with_number(_with_number(routed, parts, "many_parts"), blocks, "many_blocks").withColumn("part", part)
    sent = sent.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("many_blocks") - 1)))
    sent = sent.join(queries.select(F.col("id").alias("asked"), F.col("v").alias("q")), F.col("id") == F.col("asked"))
    sent = sent.select("id", F.col("q").alias("v"), "leaf", "block", "part")
    rows = _with_number(index.rows, parts, "many").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("many") - 1)))

    def within(rows: pa.Table, asked: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])
        if not rows.num_rows or not asked.num_rows:
            return schema.empty_table()
        x, q = (np.vstack([_matrix(c) for c in t.column("v").chunks if len(c)]) for t in (rows, asked))
        ids, query_ids = rows.column("id").to_numpy(), asked.column("id").to_numpy()
        found = [np.concatenate(c) for c in zip(*_top(query_ids, q, ids, x, k))]
        return pa.table([pa.array(c) for c in found], schema=schema)

    by = ("leaf", "block", "part")
    found = rows.groupBy(*by).cogroup(sent.groupBy(*by)).applyInArrow(within, _FOUND)
    return _best(found, k)


def exhaustive(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, id, score`` over all rows: a bounded set of queries, sent to every task."""
    asked = queries.toArrow()
    if not asked.num_rows:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, id long, score double")
    q = np.vstack([_matrix(c) for c in asked.column("v").chunks if len(c)])
    query_ids = asked.column("id").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids = batch.column("id").to_numpy()
                parts = [np.concatenate(c) for c in zip(*_top(query_ids, q, ids, _matrix(batch.column("v")), k))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in parts], ["query_id", "id", "score"])

    return _best(rows.select("id", "v").mapInArrow(run, _FOUND), k)


def calibrate(index: Index, queries: DataFrame, k: int, target: float = TARGET_RECALL, sample: int = CALIBRATION_QUERIES) -> Index:
    """Widen the visits until the recall over a bounded sample of the queries reaches ``target``.

    The sampled queries' true neighbours are found exhaustively, and where the search would come to the leaf of each:
    recall after any number of visits follows. Visiting all leaves is exhaustive, so the target is always reached.
    """
    n = queries.count()
    if not n:
        return index
    draw = F.pmod(F.xxhash64(F.lit("calibrate"), "id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = stored(queries.filter(draw < max(1.0, sample) / n), "calibration")
    true = exhaustive(index.rows, chosen, k).join(index.rows.select("id", "leaf"), "id").select("query_id", "leaf").collect()
    if not true:
        index.visits, index.recall = index.tree.leaves, None
        return index
    vectors = {r.id: np.array(r.v) for r in chosen.collect()}
    place = {q: {leaf: at for at, leaf in enumerate(index.tree.visits(v, index.tree.leaves))} for q, v in vectors.items()}
    found = np.sort([place[r.query_id][r.leaf] for r in true])
    index.visits = int(found[math.ceil(target * len(found)) - 1]) + 1
    index.recall = float((found < index.visits).mean())
    return index
