"""Near-duplicate documents by min-max hashing, confirmed on whole shingle sets.

Every hash function yields two signature values, the smallest and the largest hash of
a document's shingles; each agrees between two sets with the probability of their
similarity, so half as many evaluations give a signature of the same length, with less
variance. Bands of five values, 40 of them, put documents into buckets; two documents
at a similarity of 0.8 share none with a probability of about one in ten million.

1. Equal shingle sets become one class, whatever their number; only classes go on.
2. Each bucket links its members to one of them, a different one from bucket to bucket
   and chosen by hash. Links whose estimate is far below the threshold are dropped.
   Where that leaves members of a bucket apart, those that are not with its head are
   estimated among themselves and against the others, in blocks of bounded size. A family
   is a connected component of the links: pairs are never listed.
3. Members of a family are compared in full. A large family is dealt into blocks of
   bounded size; every pair of blocks is one small task, which counts common shingles
   by matrix products and returns at most one confirmed link per member.
4. Components of confirmed links are the answer, carried back to all copies.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.graph import components
from holdfast.llm.words import documents_of, lower_bytes, map_rows, mix, runs, shingles, words_of
from holdfast.session import materialize

BAND_VALUES = 5
BANDS = 40
FUNCTIONS = BANDS * BAND_VALUES // 2  # two values each
LOOSE = 0.5  # estimates below this link no family; true links lie six deviations above
BLOCK_SETS = 256
BLOCK_SHINGLES = 1 << 18
SEED = 0x5EED


def _parameters() -> tuple[np.ndarray, np.ndarray]:
    n = np.arange(2 * FUNCTIONS, dtype=np.uint64) + np.uint64(SEED)
    with np.errstate(over="ignore"):
        values = mix(n * np.uint64(0x9E3779B97F4A7C15))
    return values[:FUNCTIONS] | np.uint64(1), values[FUNCTIONS:]


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text; A-Z in lower case."""
    if not text:
        return np.zeros(0, np.uint64)
    return np.unique(shingles(words_of(lower_bytes(text))[2], k))


def min_max(found: np.ndarray) -> np.ndarray:
    """Signature of a non-empty set: smallest values, then largest, of all functions."""
    a, b = _parameters()
    low = np.full(FUNCTIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(FUNCTIONS, np.uint64)
    for at in range(0, len(found), 1024):
        h = mix(found[at : at + 1024])[None, :] * a[:, None] + b[:, None]
        np.minimum(low, h.min(axis=1), out=low)
        np.maximum(high, h.max(axis=1), out=high)
    return np.concatenate((low, high))


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band. A band takes smallest values of some functions and largest of others."""
    order = np.argsort(mix(np.arange(2 * FUNCTIONS, dtype=np.uint64) + np.uint64(77)))
    values = mix(signature[order]).reshape(BANDS, BAND_VALUES)
    key = np.arange(BANDS, dtype=np.uint64)
    for i in range(BAND_VALUES):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15 | 1) + values[:, i])
    return key.view(np.int64)


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, set_key (of the exact set), bands, and one byte of each signature value.

    For an empty set the last three are null.
    """

    def run(rows):
        for doc_id, text in rows:
            found = shingle_set(text, k)
            if len(found) == 0:
                yield doc_id, 0, None, None, None
                continue
            s = min_max(found)
            key = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
            brief = (mix(s) >> np.uint64(56)).astype(np.uint8).tobytes()
            yield doc_id, len(found), key, band_keys(s).tolist(), brief

    return map_rows(docs, run, "doc_id long, n_shingles long, set_key binary, bands array<long>, brief binary")


def _families(classes: DataFrame) -> DataFrame:
    """(node, root) of classes that may have a near duplicate; roots are listed as well."""
    placed = classes.select("node", "brief", F.posexplode("bands").alias("band", "bucket"))
    order = F.xxhash64("node", "band")
    heads = materialize(
        placed.groupBy("band", "bucket")
        .agg(F.min_by("node", order).alias("head"), F.count("*").alias("n"))
        .where("n > 1")
    )
    members = materialize(
        placed.select("node", "band", "bucket").join(heads, ["band", "bucket"]).where("node <> head")
    )
    links = materialize(members.select(F.greatest("node", "head").alias("u"), F.least("node", "head").alias("v")).distinct())
    a = classes.select(F.col("node").alias("u"), F.col("brief").alias("bu"))
    b = classes.select(F.col("node").alias("v"), F.col("brief").alias("bv"))

    def near(rows):
        for u, v, bu, bv in rows:
            same = np.count_nonzero(np.frombuffer(bu, np.uint8) == np.frombuffer(bv, np.uint8))
            if same >= LOOSE * len(bu):
                yield u, v

    kept = materialize(map_rows(links.join(a, "u").join(b, "v").select("u", "v", "bu", "bv"), near, "u long, v long"))
    found = materialize(components(kept))
    more = materialize(_crowded(classes, members.where("n > 2"), found))
    if not more.isEmpty():
        found = materialize(components(kept.unionByName(more)))
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())


def near_pairs(low: list[tuple[int, bytes]], high: list[tuple[int, bytes]] | None) -> list[tuple[int, int]]:
    """Links at LOOSE or more between two lists of (node, brief), or inside one: a spanning forest of them."""
    nodes = [x for x, _ in low] + [x for x, _ in high or ()]
    briefs = np.array([np.frombuffer(x, np.uint8) for _, x in [*low, *(high or ())]])
    forest, out = _Forest(len(nodes)), []
    for i in range(len(low)):
        start = i + 1 if high is None else len(low)
        same = np.count_nonzero(briefs[start:] == briefs[i], axis=1)
        for j in (np.flatnonzero(same >= LOOSE * briefs.shape[1]) + start).tolist():
            if forest.join(i, j):
                out.append((max(nodes[i], nodes[j]), min(nodes[i], nodes[j])))
    return out


def _crowded(classes: DataFrame, members: DataFrame, found: DataFrame) -> DataFrame:
    """Links (u, v) inside buckets whose members are not all with the head.

    Members apart from the head fill blocks 0 to ``apart`` - 1 of a bucket, the head and those
    with it the blocks after. Two blocks meet unless both are of the second kind.
    """
    of = found.select(F.col("node").alias("_n"), "root")
    placed = members.join(of, members["node"] == of["_n"], "left").select(
        "band", "bucket", "head", "node", F.coalesce("root", "node").alias("mine")
    )
    heads = found.select(F.col("node").alias("head"), F.col("root").alias("theirs"))
    placed = materialize(
        placed.join(heads, "head", "left").select(
            "band", "bucket", "head", "node", (F.col("mine") != F.coalesce("theirs", "head")).alias("far")
        )
    )
    sizes = (
        placed.groupBy("band", "bucket", "head")
        .agg(F.count_if("far").alias("apart"), F.count_if(~F.col("far")).alias("near"))
        .where("apart > 0")
        .select(
            "band", "bucket", "head",
            F.ceil(F.col("apart") / BLOCK_SETS).cast("int").alias("apart"),
            F.ceil((F.col("near") + 1) / BLOCK_SETS).cast("int").alias("near"),
        )
    )
    sizes = materialize(sizes)
    every = placed.select("band", "bucket", "node", "far").join(sizes.drop("head"), ["band", "bucket"]).unionByName(
        sizes.select("band", "bucket", F.col("head").alias("node"), F.lit(False).alias("far"), "apart", "near")
    )
    hashed = F.xxhash64("node", "bucket")
    block = F.when(F.col("far"), F.pmod(hashed, F.col("apart"))).otherwise(F.col("apart") + F.pmod(hashed, F.col("near")))
    others = F.when(F.col("far"), F.col("apart") + F.col("near") - 1).otherwise(F.col("apart") - 1)
    rows = (
        every.select("band", "bucket", "node", block.cast("int").alias("block"), others.alias("last"))
        .join(classes.select("node", "brief"), "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
        .select("band", "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "brief")
    )

    def compare(rows):
        for (_, _, low, high), held in runs(rows, 4):
            first = [x[1:] for x in held if x[0] == low]
            if low == high:
                yield from near_pairs(first, None)
            elif len(first) < len(held):
                yield from near_pairs(first, [x[1:] for x in held if x[0] == high])

    parts = max(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    met = rows.repartition(parts, "band", "bucket", "low", "high").sortWithinPartitions("band", "bucket", "low", "high", "node")
    return map_rows(met, compare, "u long, v long").distinct()


class _Forest:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
        return x != y


def common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections; memory is bounded by slabs of shingles."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    length = np.diff(np.append(first, len(values)))
    shared = np.repeat(length > 1, length)  # a shingle of one set alone is in no intersection
    column = np.repeat(np.cumsum(length > 1) - 1, length)[shared]
    row = owner[shared]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, (at, at + 4096))
        slab = np.zeros((len(sets), 4096), np.float32)
        slab[row[a:b], column[a:b] - at] = 1
        out += slab @ slab.T
    return np.rint(out).astype(np.int64)


def confirmed_links(nodes: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links whose similarity reaches ``percent``, checked in integers."""
    n = len(sets)
    both = common(sets)
    size = np.array([len(s) for s in sets])
    union = size[:, None] + size[None, :] - both
    forest, out = _Forest(n), []
    for i, j in zip(*np.nonzero(np.triu(100 * both >= percent * union, 1))):
        if forest.join(int(i), int(j)):
            out.append((nodes[i], nodes[j]))
    return out


def near_duplicates(docs: DataFrame, k: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text).

    Rows are linked when 100 * |A and B| >= percent * |A or B| for their sets of
    k-word shingles; a text of fewer words is one shingle, a missing text or one
    without words has none and is linked with nothing. component_id is the smallest
    doc_id that links reach, the row's own included; ``kept`` says that it is the row's
    own. Rows that repeat a doc_id are rows of their own; a null doc_id never is the
    smallest, and such a row is kept only if no row with an id is in its component, where
    component_id is null. Sets are compared by 64-bit shingle hashes.
    """
    docs = documents_of(docs)
    signed = materialize(signatures(docs, k))
    # the written table fixes the numbers of classes
    classes = materialize(
        signed.where("n_shingles > 0")
        .groupBy("set_key", "bands", "brief", "n_shingles")
        .agg(F.min("doc_id").alias("label"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    families = materialize(_families(classes))
    shingled = classes.select("node", "set_key", "label", "n_shingles")
    weights = (
        families.join(shingled.select("node", "n_shingles"), "node")
        .groupBy("root")
        .agg(F.sum("n_shingles").alias("weight"), F.count("*").alias("members"))
        .select(
            "root",
            F.greatest(
                F.ceil(F.col("members") / BLOCK_SETS), F.ceil(F.col("weight") / BLOCK_SHINGLES)
            ).cast("int").alias("blocks"),
        )
    )
    dealt = materialize(
        families.join(materialize(weights), "root")
        .join(shingled, "node")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    )
    texts = docs.withColumnRenamed("doc_id", "label")

    def sets_of(rows):
        for node, root, blocks, block, set_key, text in rows:
            found = shingle_set(text, k)
            if hashlib.blake2b(found.tobytes(), digest_size=16).digest() == set_key:
                yield node, root, blocks, block, found.tobytes()

    # a class has the text of its smallest doc_id; other texts under that id are told by their key
    met = dealt.hint("merge").join(texts, dealt["label"].eqNullSafe(texts["label"])).select(
        "node", "root", "blocks", "block", "set_key", "text"
    )
    members = map_rows(met, sets_of, "node long, root long, blocks int, block int, found binary")
    # block a meets blocks a.. of its family: rows carry the pair (low, high)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = members.withColumn("other", other).select(
        "root",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "node",
        "found",
    )

    def compare(rows):
        for _, held in runs(rows, 3):
            nodes, sets, last = [], [], None
            for node, found in held:
                if node != last:  # repeated rows give one class twice
                    nodes.append(node)
                    sets.append(np.frombuffer(found, np.uint64))
                    last = node
            yield from confirmed_links(nodes, sets, percent)

    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    grouped = paired.repartition(parts, "root", "low", "high").sortWithinPartitions("root", "low", "high", "node")
    links = materialize(map_rows(grouped, compare, "u long, v long"))
    roots = materialize(components(links))
    linked = classes.select("node", "set_key", "label").join(roots, "node", "left").select(
        "set_key", "label", F.coalesce("root", "node").alias("root")
    )
    smallest = materialize(linked.groupBy("root").agg(F.min("label").alias("component")))
    answer = materialize(linked.join(smallest, "root").select("set_key", "component"))
    with_set = signed.where("n_shingles > 0").select("doc_id", "n_shingles", "set_key").join(answer, "set_key")
    without = signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component"))
    every = with_set.select("doc_id", "n_shingles", "component").unionByName(without)
    return every.select(
        "doc_id",
        "n_shingles",
        F.col("component").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"),
    )


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), 4, 80)


OP3_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN []
           WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
           ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS sh
  FROM w
), flat AS (
  SELECT doc_id, unnest(sh) AS x FROM s
), common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n
  FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT u, v FROM common JOIN s su ON su.doc_id = u JOIN s sv ON sv.doc_id = v
  WHERE 100 * n >= 80 * (len(su.sh) + len(sv.sh) - n)
), reach AS (
  SELECT doc_id, doc_id AS r FROM s
  UNION
  SELECT reach.doc_id, links.v FROM reach JOIN links ON links.u = reach.r
)
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept
FROM s JOIN (SELECT doc_id, min(r) AS c FROM reach GROUP BY 1) USING (doc_id)
"""
