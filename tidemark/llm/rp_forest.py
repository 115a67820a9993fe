"""Nearest neighbours through a forest of random-projection trees.

The trees are fitted on the driver, on a sample of bounded size; every vector is then sent down each tree to
a leaf by the executors. A query walks all trees at once: one priority queue holds the branches not yet taken
of every tree, and the branch with the least distance to its side of the planes comes first. How many leaves
a query reads is set on the sample, where true neighbours are known: few for clustered vectors, a large
share of all for vectors without structure. Leaf by leaf, the vectors are compared exactly in double precision.

Vectors that are null, all zero or of another length than most, or that hold a null or a value that is not
finite, take no part; nor do rows without an id. Equal vectors are searched as one: only the smallest ids of each
group, one more than an answer has, can appear in an answer, so a group of any size costs no more than that.
"""

import heapq
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.staging import stage

TREES = 12
#: Vectors wanted in a leaf, sampled vectors that a leaf needs at least, and the bound of the sample.
LEAF, LEAF_SAMPLE, SAMPLE = 200, 6, 50_000
#: Sampled vectors whose neighbours set the number of leaves to read, and the share of them to be found.
TRIALS, RECALL = 100, 0.96
#: Answers that a task combines before it hands them on.
COMBINED = 1_000_000


class Forest:
    """Trees of equal depth, stored level by level: node i has the children 2i+1 and 2i+2."""

    def __init__(self, sample: np.ndarray, rows: int, trees: int = TREES, leaf: int = LEAF, seed: int = 3):
        rng = np.random.default_rng(seed)
        fit = len(sample) // LEAF_SAMPLE
        self.depth = max(0, min(int(np.ceil(np.log2(max(1, rows / leaf)))), int(np.log2(max(1, fit)))))
        nodes, dims = 2**self.depth - 1, sample.shape[1] if len(sample) else 0
        self.planes = np.zeros((trees, nodes, dims), np.float32)
        self.cuts = np.zeros((trees, nodes), np.float32)
        for tree in range(trees):
            held = {0: np.arange(len(sample))}
            for node in range(nodes):
                here = held.pop(node)
                a, b = rng.choice(here, 2, replace=False)
                plane = sample[a] - sample[b]
                size = np.linalg.norm(plane)
                plane = plane / size if size else rng.normal(size=dims)
                along = sample[here] @ plane
                order = np.argsort(along, kind="stable")
                half = len(here) // 2
                self.planes[tree, node] = plane
                self.cuts[tree, node] = (along[order[half - 1]] + along[order[half]]) / 2
                held[2 * node + 1], held[2 * node + 2] = here[order[:half]], here[order[half:]]

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """(vectors, trees): the leaf of each vector in each tree."""
        out = np.zeros((len(vectors), len(self.cuts)), np.int32)
        for tree, (planes, cuts) in enumerate(zip(self.planes, self.cuts)):
            node = np.zeros(len(vectors), np.int64)
            for _ in range(self.depth):
                right = np.einsum("ij,ij->i", vectors, planes[node]) > cuts[node]
                node = 2 * node + 1 + right
            out[:, tree] = node
        return out

    def walk(self, query: np.ndarray) -> Iterator[tuple[int, int]]:
        """(tree, leaf) of all leaves, nearest first."""
        inner = 2**self.depth - 1
        margins = (self.planes @ query - self.cuts) if inner else None
        # How far off a branch is: the squared margins of the planes it is on the wrong side of.
        queue = [(0.0, tree, 0) for tree in range(len(self.cuts))]
        while queue:
            far, tree, node = heapq.heappop(queue)
            while node < inner:
                margin = float(margins[tree, node])
                right = margin > 0
                heapq.heappush(queue, (far + margin * margin, tree, 2 * node + 2 - right))
                node = 2 * node + 1 + right
            yield tree, node

    def calibrate(self, sample: np.ndarray, k: int) -> None:
        """Sets how many leaves find ``RECALL`` of the ``k`` nearest sampled vectors of ``TRIALS`` of them."""
        where, needed = self.leaves(sample), []
        for i in range(0, len(sample), max(1, len(sample) // TRIALS)):
            far = np.square(sample - sample[i]).sum(axis=1)
            far[i] = np.inf
            near = np.argpartition(far, min(k, len(far)) - 1)[:k]
            turn = {leaf: n for n, leaf in enumerate(self.walk(sample[i]), 1)}
            needed += [min(turn[tree, leaf] for tree, leaf in enumerate(where[j].tolist())) for j in near if j != i]
        self.reads = int(np.quantile(needed, RECALL, method="higher")) if needed else len(self.cuts)

    def search(self, query: np.ndarray) -> list[tuple[int, int]]:
        """(tree, leaf) of the leaves to read."""
        return list(itertools.islice(self.walk(query), self.reads))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _nearest(made: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """(query, point, score) rows with each pair once and the ``k`` nearest points of each query."""
    query, point, score = (np.concatenate(x) for x in zip(*made))
    order = np.lexsort((point, score, query))
    query, point, score = query[order], point[order], score[order]
    new = np.ones(len(query), bool)
    new[1:] = (query[1:] != query[:-1]) | (point[1:] != point[:-1])
    query, point, score = query[new], point[new], score[new]
    first = np.ones(len(query), bool)
    first[1:] = query[1:] != query[:-1]
    starts = np.flatnonzero(first)
    near = np.arange(len(query)) - np.repeat(starts, np.diff(np.append(starts, len(query)))) < k
    return query[near], point[near], score[near]


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part, stored."""
    v = F.col(embedding)
    if "float" not in vectors.schema[embedding].dataType.simpleString():
        v = v.cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null").where(
        F.col("v").isNotNull() & fine & F.exists("v", lambda x: x != 0)
    ).select("vec_id", F.transform("v", lambda x: F.when(x != 0, x).otherwise(F.abs(x))).alias("v"))
    rows = stage(rows, "vectors")
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (lengths["n"] if lengths else 0))


def search(vectors: DataFrame, is_query: F.Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row where ``is_query`` holds."""
    rows = usable(vectors, vec_id, embedding)
    # Pruned in every task before the shuffle, so a vector that very many rows share moves k + 1 rows a task.
    copies = Window.partitionBy("v").orderBy("vec_id")
    ids = rows.distinct().withColumn("n", F.row_number().over(copies)).where(F.col("n") <= k + 1)
    points = stage(
        ids.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("point"), "ids", "v"),
        "points",
    )
    sample = points.orderBy(F.xxhash64("point")).limit(SAMPLE).select("v").toPandas()["v"]
    sample = np.array(sample.tolist(), np.float32) if len(sample) else np.zeros((0, 0), np.float32)
    forest = Forest(sample, points.count())
    forest.calibrate(sample, k)

    def dealt(kind: int, leaves_of: Callable[[np.ndarray], list]) -> Callable:
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                # A few vectors at a time: each comes out once for every leaf it belongs to or reads.
                for part in (batch.slice(i, 64) for i in range(0, batch.num_rows, 64)):
                    found = leaves_of(_matrix(part.column(1)))
                    of = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
                    tree, leaf = np.array([x for f in found for x in f], np.int32).reshape(-1, 2).T
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.ascontiguousarray(tree)), pa.array(np.ascontiguousarray(leaf)),
                         pa.array(np.full(len(tree), kind, np.int32)), part.column(0).take(of), part.column(1).take(of)],
                        names=["tree", "leaf", "kind", "id", "v"],
                    )

        return rows

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k + 1 nearest vectors to each query among the leaves of a task; a leaf's vectors come before its readers.

        Leaves are combined here, before the shuffle: a query that reads many leaves of a task gets k + 1 rows.
        """
        at, ids, held = None, [], []
        made: list[tuple[np.ndarray, ...]] = []
        size = 0

        def answer(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in rows], names=["query_id", "point", "score"])

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            if not len(keys):
                continue
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for lo, hi in itertools.pairwise([0, *edges.tolist(), len(keys)]):
                tree, leaf, kind = keys[lo].tolist()
                part, vectors = batch.column(3).slice(lo, hi - lo).to_numpy(), _matrix(batch.column(4).slice(lo, hi - lo))
                if (tree, leaf) != at:
                    at, ids, held = (tree, leaf), [], []
                if kind == 0:
                    ids.append(part)
                    held.append(vectors)
                    continue
                if not held:
                    continue
                points, against = np.concatenate(ids), np.concatenate(held).astype(np.float64)
                ids, held = [points], [against]
                near = np.concatenate([np.sqrt(np.square(against - q).sum(axis=1))[None] for q in vectors.astype(np.float64)])
                # Ties go to the smaller id: points stand in that order.
                best = np.argsort(near, axis=1, kind="stable")[:, : k + 1]
                made.append((np.repeat(part, best.shape[1]), points[best].ravel(), np.take_along_axis(near, best, axis=1).ravel()))
                size += best.size
                if size > COMBINED:
                    made = [_nearest(made, k + 1)]
                    size = len(made[0][0])
                    if size > COMBINED // 2:  # too many queries to hold: hand on what there is
                        yield answer(made[0])
                        made, size = [], 0
        if made:
            yield answer(_nearest(made, k + 1))

    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "v").distinct()
    kind = rows.schema["v"].dataType.simpleString()
    columns = f"tree int, leaf int, kind int, id long, v {kind}"
    members = points.select("point", "v").mapInArrow(dealt(0, lambda m: [list(enumerate(x)) for x in forest.leaves(m).tolist()]), columns)
    readers = queries.mapInArrow(dealt(1, lambda m: [forest.search(q) for q in m]), columns)
    near = (
        members.unionAll(readers).repartition("tree", "leaf").sortWithinPartitions("tree", "leaf", "kind", "id")
        .mapInArrow(met, "query_id long, point long, score double")
        .groupBy("query_id", "point").agg(F.min("score").alias("score"))
    )
    nearest = Window.partitionBy("query_id").orderBy("score", "point")
    best = near.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= k + 1).drop("n")
    each = best.join(points.select("point", "ids"), "point").select("query_id", F.explode("ids").alias("vec_id"), "score")
    last = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        each.where("vec_id <> query_id").withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
