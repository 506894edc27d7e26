"""Exact top-k search by inner product, column by column with pruning.

Vectors are packed into blocks stored dimension after dimension. Every block of
candidates meets every block of queries once, in a task of bounded size; there the
products grow by a few dimensions at a time, and after each step a candidate is
dropped for a query when even the largest product its remaining dimensions allow (by
Cauchy and Schwarz on the rest of both vectors) stays below the query's k-th best
score. Survivors are compacted, so later dimensions touch few columns. Ties are kept,
so pruning never changes a result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.words import map_rows
from holdfast.session import materialize

BLOCK_ROWS = 4096
QUERY_ROWS = 512
STEP = 8


def integer_vectors(df: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and the vector with every component x as floor(scale * x), x as double.

    Vectors that are null, or hold a null or non-finite component, are left out.
    """
    x = F.col("embedding")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    return df.select(
        F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding")
    ).where(F.coalesce(x.isNotNull() & fine, F.lit(False))).select(
        "vec_id", F.transform("embedding", lambda v: F.floor(v * F.lit(float(scale))).cast("long")).alias("vector")
    )


def _blocks(vectors: DataFrame, rows: int, name: str) -> tuple[DataFrame, int]:
    """Written blocks of about ``rows`` vectors, and how many there are.

    A block has a number, its ids, and its values dimension after dimension, as bytes.
    Missing trailing components count as 0.
    """
    count = max(1, -(-vectors.count() // rows))
    dealt = vectors.withColumn(
        f"{name}_no", F.pmod(F.xxhash64("vec_id", "vector", F.monotonically_increasing_id()), F.lit(count)).cast("int")
    )

    def fold(key, table):
        ids, vectors = table["vec_id"].to_numpy(), table["vector"].to_pylist()
        m = np.zeros((len(vectors), max(map(len, vectors))), np.int64)
        for i, v in enumerate(vectors):
            m[i, : len(v)] = v
        row = key[0].as_py(), ids.astype(np.int64).tobytes(), m.shape[1], np.ascontiguousarray(m.T).tobytes()
        names = [f"{name}_{x}" for x in ("no", "ids", "width", "data")]
        kinds = [pa.int32(), pa.binary(), pa.int32(), pa.binary()]
        return pa.table({n: pa.array([v], k) for n, v, k in zip(names, row, kinds)})

    out = dealt.groupBy(f"{name}_no").applyInArrow(
        fold, f"{name}_no int, {name}_ids binary, {name}_width int, {name}_data binary"
    )
    return materialize(out), count


def _unpack(ids: bytes, width: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(data, np.int64).reshape(width, len(i))


def _order(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score first, ties to the smaller id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= cut)
        return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def branch_and_bound(q: np.ndarray, c: np.ndarray, ids: np.ndarray, k: int, step: int = STEP) -> list[np.ndarray]:
    """For each query (a column of q) the places of its k best candidates (columns of c).

    ``q`` and ``c`` hold one row per dimension, of the same number of dimensions.
    """
    dims, n = c.shape
    if n <= k:
        return [_order(q[:, j] @ c, ids, k) for j in range(q.shape[1])]
    # length of what remains of each candidate before every step; one unit is added against rounding
    squares = (c.astype(np.float64) ** 2)[::-1].cumsum(axis=0)[::-1]
    starts = list(range(0, dims, step))
    out = []
    for j in range(q.shape[1]):
        v = q[:, j]
        rest_q = np.sqrt((v.astype(np.float64) ** 2)[::-1].cumsum()[::-1])
        alive, partial = None, np.zeros(n, np.int64)
        for s in starts:
            block = c[s : s + step] if alive is None else c[s : s + step][:, alive]
            partial = partial + v[s : s + step] @ block
            nxt = s + step
            if nxt >= dims:
                break
            rest = np.sqrt(squares[nxt] if alive is None else squares[nxt][alive]) * rest_q[nxt]
            rest += 1.0 + 1e-9 * rest
            low = partial - rest
            kth = np.partition(low, len(low) - k)[len(low) - k]  # k candidates reach this score at least
            keep = np.flatnonzero(partial + rest >= kth)
            if len(keep) < len(partial):
                partial = partial[keep]
                alive = keep if alive is None else alive[keep]
        places = np.arange(n) if alive is None else alive
        out.append(places[_order(partial, ids[places], k)])
    return out


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best other rows.

    Both tables hold vec_id and an integer ``vector``; queries are rows of ``vectors``.
    A query's own row is left out once; other rows with its id or its vector stay. A
    repeated query row gets its result once for each time it is there. Ties go to the
    smaller vec_id. Fewer than k candidates give fewer rows, an empty table none.
    Scores must fit in 64 bits; a null vec_id is a candidate that sorts last among ties
    and never a query.
    """
    c, n_c = _blocks(vectors.withColumn("vec_id", F.coalesce("vec_id", F.lit(2**63 - 1))), BLOCK_ROWS, "c")
    q, n_q = _blocks(queries.where(F.col("vec_id").isNotNull()), QUERY_ROWS, "q")
    # a grid of blocks, never of rows: each pair of blocks meets in a task of bounded size
    left = q.withColumn("c_no", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))))
    right = c.withColumn("q_no", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    met = left.hint("shuffle_hash").join(right, ["q_no", "c_no"]).select(
        "q_no", "q_ids", "q_width", "q_data", "c_ids", "c_width", "c_data"
    )

    def search(rows):
        for q_no, qi, qw, qd, ci, cw, cd in rows:
            q_ids, qm = _unpack(qi, qw, qd)
            c_ids, cm = _unpack(ci, cw, cd)
            width = min(qw, cw)
            qs = (qm[:width].astype(np.float64) ** 2).sum(axis=0).max(initial=0.0)
            cs = (cm[:width].astype(np.float64) ** 2).sum(axis=0).max(initial=0.0)
            if math.sqrt(qs * cs) >= 2.0**62:
                raise OverflowError("integer inner products do not fit in 64 bits")
            own = (qm * qm).sum(axis=0)
            for j, places in enumerate(branch_and_bound(qm[:width], cm[:width], c_ids, k + 1)):
                scores = qm[:width, j] @ cm[:width][:, places]
                for p, s in zip(places.tolist(), scores.tolist()):
                    yield q_no, j, int(q_ids[j]), int(own[j]), int(c_ids[p]), s

    found = map_rows(met, search, "q_no long, q_row int, query_id long, own long, vec_id long, score long")
    best = Window.partitionBy("q_no", "q_row").orderBy(F.desc("score"), F.asc("vec_id"))
    top = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    # among the k+1 best, the first row with the query's id and its own product is the query itself
    me = F.min(F.when((F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own")), F.col("place")))
    me = F.coalesce(me.over(Window.partitionBy("q_no", "q_row")), F.lit(k + 1))
    return (
        top.withColumn("me", me)
        .where(F.col("place") != F.col("me"))
        .select(
            "query_id",
            (F.col("place") - (F.col("place") > F.col("me")).cast("int")).cast("int").alias("rank"),
            F.when(F.col("vec_id") != 2**63 - 1, F.col("vec_id")).alias("vec_id"),
            "score",
        )
    )


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return exact_top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), 10)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, embedding AS e, row_number() OVER () AS r FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), i AS (
  SELECT vec_id, r, list_transform(e, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM v
), long AS (
  SELECT vec_id, r, unnest(e) AS x, generate_subscripts(e, 1) AS d FROM i
), scored AS (
  SELECT q.vec_id AS query_id, q.r AS qr, c.vec_id, c.r, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM long q JOIN long c ON q.d = c.d
  WHERE q.vec_id % 100 = 0 AND q.r <> c.r
  GROUP BY ALL
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 10
"""
