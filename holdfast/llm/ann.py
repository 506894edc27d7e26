"""Approximate nearest neighbours by a forest of random-projection trees.

Trees are fitted on a bounded sample; every vector is then put into its leaf of each
tree. A query walks all trees through one shared priority queue, nearest leaf first,
where the distance of a leaf is the energy of the query's margins to the splits that
part it from the leaf. Leaves are visited until that energy exceeds what a true
neighbour is expected to show, given the distance of the neighbours found in the
query's own leaves: tight clusters end the walk at once, scattered data go on longer.
Candidates are ranked by exact inner products on the original vectors.

Inner products become distances by one extra component, which gives all vectors the
length of the longest. Equal vectors are searched as one, with the k + 1 smallest ids
of the group: a result can hold no others. Rows and queries of one leaf meet in blocks
of bounded size.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.words import map_rows, runs
from holdfast.session import materialize

SAMPLE = 16_384  # vectors the trees are fitted on, about
TREES = 4
LEAF_SAMPLE = 48  # sampled vectors in a leaf
RADIUS = 1.9  # share of a neighbour's expected energy along the margins that ends the walk
BLOCK = 2048
SEED = 3


@dataclass
class Tree:
    """Splits in an array: node i parts at normals[i] . x <= at[i] into children[i]; leaves are negative."""

    normals: np.ndarray
    at: np.ndarray
    children: np.ndarray
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64) if len(self.at) else np.full(len(x), -1)
        todo = np.flatnonzero(node >= 0)
        while len(todo):
            n = node[todo]
            side = np.einsum("ij,ij->i", x[todo], self.normals[n]) > self.at[n]
            node[todo] = self.children[n, side.astype(int)]
            todo = todo[node[todo] >= 0]
        return -node - 1


def grow(sample: np.ndarray, rng: np.random.Generator, leaf: int = LEAF_SAMPLE) -> Tree:
    """A tree over the sample: directions between two random members, cuts at the median."""
    normals, at, children, leaves = [], [], [], 0
    waiting = [(np.arange(len(sample)), -1, 0)]
    while waiting:
        rows, parent, side = waiting.pop()
        split = None
        if len(rows) > leaf:
            for _ in range(4):
                a, b = sample[rng.choice(rows, 2, replace=False)]
                d = a - b
                if (size := float(np.linalg.norm(d))) < 1e-9:
                    continue
                p = sample[rows] @ (d / size)
                t = float(np.median(p))
                if 0 < np.count_nonzero(p > t) < len(rows):
                    split = d / size, t, p > t
                    break
        if split is None:
            leaves += 1
            here = -leaves
        else:
            here = len(at)
            normals.append(split[0])
            at.append(split[1])
            children.append([0, 0])
            waiting += [(rows[~split[2]], here, 0), (rows[split[2]], here, 1)]
        if parent >= 0:
            children[parent][side] = here
    width = sample.shape[1] if sample.ndim == 2 else 0
    return Tree(np.array(normals).reshape(-1, width), np.array(at), np.array(children, np.int64).reshape(-1, 2), leaves)


def walk(trees: list[Tree], q: np.ndarray, limit: float) -> list[tuple[int, int]]:
    """(tree, leaf) in order of energy, up to ``limit`` (the own leaf of each tree always is in)."""
    margins = [t.normals @ q - t.at for t in trees]
    heap = [(0.0, t, 0 if len(tree.at) else -1) for t, tree in enumerate(trees)]
    heapq.heapify(heap)
    out = []
    while heap:
        energy, t, node = heapq.heappop(heap)
        if energy > limit:
            break
        tree, m = trees[t], margins[t]
        while node >= 0:
            side = int(m[node] > 0)
            other = energy + float(m[node]) ** 2
            if other <= limit:
                heapq.heappush(heap, (other, t, int(tree.children[node, 1 - side])))
            node = int(tree.children[node, side])
        out.append((t, -node - 1))
    return out


def usable(df: DataFrame) -> DataFrame:
    """vec_id and the vector in doubles; null, zero and non-finite vectors are left out."""
    x = F.col("embedding")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    some = F.exists(x, lambda v: v != 0)
    return df.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding")).where(
        F.coalesce(fine & some, F.lit(False))
    ).withColumnRenamed("embedding", "vector")


def _norm2() -> Column:
    return F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v)


def _lift(vectors: list, width: int, longest: float, query: bool) -> np.ndarray:
    """Vectors with the extra component, on a sphere of radius 1."""
    x = np.zeros((len(vectors), width + 1))
    for i, v in enumerate(vectors):
        x[i, : len(v)] = v
    if query:
        return x / np.linalg.norm(x, axis=1, keepdims=True)
    x /= longest
    x[:, -1] = np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1)))
    return x


def _top(q: np.ndarray, m: np.ndarray, labels: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the k rows of m with the largest products, ties to smaller labels."""
    rough = m @ q
    if len(rough) > k:
        cut = np.partition(rough, len(rough) - k)[len(rough) - k]
        at = np.flatnonzero(rough >= cut - 1e-9 * (1 + abs(cut)))
    else:
        at = np.arange(len(rough))
    scores = (m[at] * q).sum(axis=1)  # one order of summation, whatever block a pair meets in
    order = np.lexsort((labels[at], -scores))[:k]
    return at[order], scores[order]


class _Best:
    """The k best (score, label, no) of many queries; emptied when it gets large."""

    def __init__(self, k: int, most: int = 1 << 18):
        self.k, self.most, self.held, self.n = k, most, {}, 0

    def add(self, query: int, nos: np.ndarray, labels: np.ndarray, scores: np.ndarray):
        mine = self.held.setdefault(query, {})
        before = len(mine)
        for no, label, score in zip(nos.tolist(), labels.tolist(), scores.tolist()):
            mine[no] = (-score, label)
        if len(mine) > 2 * self.k:
            keep = sorted(mine.items(), key=lambda x: x[1])[: self.k]
            mine.clear()
            mine.update(keep)
        self.n += len(mine) - before

    def full(self) -> bool:
        return self.n > self.most

    def empty(self):
        for query, mine in self.held.items():
            for no, (score, label) in sorted(mine.items(), key=lambda x: x[1])[: self.k]:
                yield query, no, label, -score
        self.held, self.n = {}, 0


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, trees: int = TREES, radius: float = RADIUS) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest other rows that the walk finds.

    ``vectors`` comes from ``usable``; queries are its rows that meet ``is_query``. Nearest
    is the largest inner product in double precision, ties to the smaller vec_id. The
    query's own row is left out once; a repeated query row gets its result once for each
    time. If a query's walk meets fewer than k others, all leaves are searched for it.
    Missing trailing components count as 0. A null vec_id is no candidate and no query.
    Empty tables give no rows.
    """
    spark = vectors.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    vectors = vectors.where("vec_id is not null")
    asks = F.coalesce(is_query, F.lit(False))
    groups = materialize(
        vectors.groupBy("vector")
        .agg(F.min("vec_id").alias("label"), F.max(asks).alias("asked"))
        .withColumn("no", F.monotonically_increasing_id())
    )
    facts = groups.agg(
        F.count("*").alias("n"), F.max(F.sqrt(_norm2())).alias("longest"), F.max(F.size("vector")).alias("width")
    ).first()
    if not facts["n"]:
        return spark.createDataFrame([], out)
    n, longest, width = facts["n"], facts["longest"], facts["width"]
    place = F.pmod(F.xxhash64("vector", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = groups.where(place < F.lit(min(1.0, SAMPLE / n))).select("vector").collect()  # SAMPLE vectors, about
    sample = _lift(sorted(r["vector"] for r in drawn) or [groups.first()["vector"]], width, longest, False)
    rng = np.random.default_rng(SEED)
    grown = [grow(sample, rng) for _ in range(trees)]
    forest = spark.sparkContext.broadcast(grown)  # bounded by the sample
    # neighbouring leaves form cells of about BLOCK vectors; a crowded cell is dealt into blocks
    step = [max(1, int(BLOCK * t.leaves / n)) for t in grown]

    def put(rows):
        for held in _batches(rows, 1024):
            x = _lift([v for _, _, v in held], width, longest, False)
            found = [t.leaf_of(x) for t in forest.value]
            for i, (no, label, v) in enumerate(held):
                data = np.zeros(width)
                data[: len(v)] = v
                for t, leaf in enumerate(found):
                    yield no, label, t, int(leaf[i]) // step[t], int(leaf[i]), data.tobytes()

    placed = map_rows(groups.select("no", "label", "vector"), put, "no long, label long, tree int, cell int, leaf int, data binary")
    cells = materialize(
        placed.groupBy("tree", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    )
    members = placed.join(cells, ["tree", "cell"]).select(
        "tree", "cell", F.pmod(F.xxhash64("no"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("kind"),
        "no", "label", "data", F.array("leaf").alias("leaves"),
    )
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def search(asking: DataFrame, aim: int) -> DataFrame:
        """The best candidates of each query over the leaves it walks to; asking: no, limit, vector."""

        def visit(rows):
            for no, limit, v in rows:
                q = _lift([v], width, longest, True)[0]
                data = np.zeros(width)
                data[: len(v)] = v
                by: dict[tuple[int, int], list[int]] = {}
                for t, leaf in walk(forest.value, q, limit):
                    by.setdefault((t, leaf // step[t]), []).append(leaf)
                for (t, cell), leaves in by.items():
                    yield t, cell, no, data.tobytes(), sorted(leaves)

        visits = map_rows(asking.select("no", "limit", "vector"), visit, "tree int, cell int, no long, data binary, leaves array<int>")
        visits = visits.join(cells, ["tree", "cell"]).select(
            "tree", "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("kind"),
            "no", F.lit(0).cast("long").alias("label"), "data", "leaves",
        )

        def rank(rows):
            best = _Best(aim)
            for _, held in runs_of_cells(rows):
                nos, labels, leaf, m, asked = held
                if not len(nos):
                    continue
                order = np.argsort(leaf, kind="stable")
                nos, labels, leaf, m = nos[order], labels[order], leaf[order], m[order]
                for no, data, leaves in asked:
                    low = np.searchsorted(leaf, leaves)
                    high = np.searchsorted(leaf, leaves, side="right")
                    at = np.concatenate([np.arange(a, b) for a, b in zip(low, high)])
                    if len(at):
                        whole = len(at) == len(nos)
                        found, scores = _top(np.frombuffer(data), m if whole else m[at], labels if whole else labels[at], aim)
                        at = at[found]
                        best.add(no, nos[at], labels[at], scores)
                if best.full():
                    yield from best.empty()
            yield from best.empty()

        met = members.unionByName(visits).repartition(parts, "tree", "cell", "block").sortWithinPartitions("tree", "cell", "block", "kind")
        found = map_rows(met, rank, "q long, no long, label long, score double").groupBy("q", "no").agg(
            F.max("label").alias("label"), F.max("score").alias("score")
        )
        turn = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "label"))
        return found.withColumn("turn", turn).where(F.col("turn") <= aim)

    aim = k + 1
    asked = groups.where("asked").select("no", "vector", F.sqrt(_norm2()).alias("norm"))
    near = search(asked.withColumn("limit", F.lit(0.0)), aim).groupBy("q").agg(
        F.min("score").alias("kth"), F.count("*").alias("found")
    )
    # distance of the k-th candidate on the sphere, its share per dimension, and how much of it to follow
    reach = F.greatest(2 - 2 * F.col("kth") / (F.col("norm") * F.lit(longest)), F.lit(1e-12))
    limit = F.when(F.col("found") < aim, F.lit(math.inf)).otherwise(reach * F.lit(radius / (width + 1)))
    asked = asked.join(materialize(near), asked["no"] == F.col("q"), "left").withColumn(
        "limit", F.coalesce(limit, F.lit(math.inf))
    )
    found = materialize(search(asked, aim))
    # back to rows: the first aim ids of a group of equal vectors are all that can count
    numbered = materialize(
        vectors.join(groups.select("no", "vector"), "vector").select("vec_id", "no", asks.alias("asks"))
    )
    turn = F.row_number().over(Window.partitionBy("no").orderBy("vec_id"))
    ids = numbered.select("vec_id", "no").withColumn("turn", turn).where(F.col("turn") <= aim).drop("turn")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    lists = materialize(
        found.select("q", "no", "score")
        .join(materialize(ids), "no")
        .withColumn("place", place)
        .where(F.col("place") <= aim)
        .select("q", "place", "vec_id", "score", (F.col("no") == F.col("q")).alias("own"))
    )
    ask = numbered.where("asks").select(F.col("vec_id").alias("query_id"), F.col("no").alias("q")).withColumn(
        "row", F.monotonically_increasing_id()
    )
    ask = materialize(ask)
    mine = lists.where("own").groupBy("q", F.col("vec_id").alias("query_id")).agg(F.min("place").alias("me"))
    ask = materialize(ask.join(materialize(mine), ["q", "query_id"], "left").withColumn("me", F.coalesce("me", F.lit(aim))))
    return (
        ask.join(lists, "q")
        .where(F.col("place") != F.col("me"))
        .select(
            "query_id",
            (F.col("place") - (F.col("place") > F.col("me")).cast("int")).cast("int").alias("rank"),
            "vec_id",
            "score",
        )
    )


def _batches(rows, size: int):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def runs_of_cells(rows):
    """Cells of sorted rows: the key and (nos, labels, leaves, vectors, queries)."""
    for key, held in runs(rows, 3):
        members = [r for r in held if r[0] == 0]
        asked = [(r[1], r[3], r[4]) for r in held if r[0] == 1]
        yield key, (
            np.array([r[1] for r in members], np.int64),
            np.array([r[2] for r in members], np.int64),
            np.array([r[4][0] for r in members], np.int64),
            np.frombuffer(b"".join(r[3] for r in members)).reshape(len(members), -1) if members else None,
            asked,
        )


def op10_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return nearest(vectors, F.col("vec_id") % 20 == 0, 20)
