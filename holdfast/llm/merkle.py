"""Merkle manifest of a document table: one tree per language, one over the languages.

Leaves are numbered per language in order of doc_id. A level joins every node with its
siblings by their computed indices, the other slots of its run of eight (of two: the
index with its last bit flipped); the node in slot zero then emits the parent, the hash
of itself and its siblings. Nodes carry what the joins found, so each document's proof
follows on the way back down: a node's path is its own siblings and the path of its
parent. A proof is folded from the leaf to the root to verify a document.

No step looks at a language as a whole: numbering goes by ranges of (language, doc_id),
joins by (language, index). Digests travel as 32 bytes.

Odd rows: nulls are marked in the leaf; null languages form a tree of their own, the first;
documents without id come first and are not tampered with; rows of one id stand in order of
their leaves, equal ones in any order; an empty table has no rows; other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.words import documents_of
from holdfast.session import materialize

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_ROWS = 250_000  # leaves of a range when they are numbered, about
_PLACE = (1 << 33) - 1  # bits of a row's place within its partition
_NO_PATH = "array<struct<left:binary,right:binary>>"


def sha(text: Column) -> Column:
    """Digest of a text as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def as_text(digests: Column) -> Column:
    """Digests, one or several in a row, as lower-case hex."""
    return F.lower(F.hex(digests))


def field(value: Column) -> Column:
    """`-` for null, else UTF-8 byte count, `:` and value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text), F.lit(":"), text))


def leaf_of(**changed: Column) -> Column:
    """Digest of a document's fields; some may be given in place of the column."""
    return sha(F.concat(*[field(changed.get(c, F.col(c))) for c in FIELDS]))


def _key(value: Column) -> Column:
    """A text that sorts null first and else as the value's bytes."""
    return F.coalesce(F.concat(F.lit("="), value), F.lit(""))


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """Columns ``idx``, the place within the group from 0, and ``n``, the size of the group.

    Rows are dealt by ranges of the whole order, so a group may hold most of them, and
    numbered by the offsets of the ranges. ``rows`` is read twice.
    """
    parts = max(1, -(-rows.count() // _ROWS))
    # equal rows are told apart, so that they need not share a range
    keyed = rows.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
    keys = [F.col(group), *[F.col(c).asc_nulls_first() for c in order], F.col("_tie")]
    placed = materialize(
        keyed.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(F.lit(_PLACE))})
        .drop("_tie")
    )
    # windows see one row for each range and group
    pieces = placed.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spread = pieces.select(
        group,
        "_part",
        "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole).alias("n"),
    )
    return (
        placed.join(spread, [group, "_part"])
        .withColumn("idx", F.col("_before") + F.col("_at") - F.col("_first"))
        .drop("_part", "_at", "_first", "_before")
    )


def _siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """(g, idx, n, digest) with ``left`` and ``right``, the siblings' digests in order."""
    slot = F.pmod("idx", F.lit(fanout))
    if fanout == 2:
        others = F.array(F.col("idx").bitwiseXOR(F.lit(1)))
    else:
        run = F.col("idx") - slot
        others = F.transform(
            F.sequence(F.lit(1), F.lit(fanout - 1)), lambda s: run + F.pmod(slot + s, F.lit(fanout))
        )
    asked = nodes.select("g", F.col("idx").alias("_of"), F.explode(others).alias("idx"), "n").where("idx < n").drop("n")
    found = asked.join(nodes.select("g", "idx", F.col("digest").alias("_other")), ["g", "idx"])
    met = found.groupBy("g", F.col("_of").alias("idx")).agg(
        F.array_sort(F.collect_list(F.struct("idx", "_other"))).alias("_met")  # at most fanout - 1
    )
    none = F.coalesce("_met", F.lit(None).cast("array<struct<idx:bigint,_other:binary>>"), F.array())

    def joined(side) -> Column:
        return F.aggregate(F.filter(none, side), F.lit(b""), lambda a, m: F.concat(a, m["_other"]))

    return nodes.join(met, ["g", "idx"], "left").select(
        "g",
        "idx",
        "n",
        "digest",
        joined(lambda m: m["idx"] < F.col("idx")).alias("left"),
        joined(lambda m: m["idx"] > F.col("idx")).alias("right"),
    )


def tree_levels(leaves: DataFrame, fanout: int = FANOUT) -> tuple[list[DataFrame], DataFrame]:
    """Written levels of the trees of all groups, lowest first, and (g, digest, height) of each tree's top.

    ``leaves`` are (g, idx, n, digest). Of a level only nodes that have a parent are kept,
    with their siblings. As many rounds as the largest tree has levels.
    """
    levels, tops, nodes = [], [], leaves.select("g", "idx", "n", "digest")
    while True:
        tops.append(nodes.where("n = 1").select("g", "digest", F.lit(len(levels)).alias("height")))
        open_ = nodes.where("n > 1")
        if open_.isEmpty():
            break
        level = materialize(_siblings(open_, fanout))
        levels.append(level)
        nodes = materialize(
            level.where(F.pmod("idx", F.lit(fanout)) == 0).select(
                "g",
                F.expr(f"idx div {fanout}").alias("idx"),
                F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
                sha(as_text(F.concat("digest", "right"))).alias("digest"),
            )
        )
    top = tops[0]
    for part in tops[1:]:
        top = top.unionByName(part)
    return levels, materialize(top)


def _paths(levels: list[DataFrame], above: DataFrame, fanout: int) -> DataFrame:
    """(g, idx, subroot, path) of the leaves; ``above`` holds (g, height, subroot, path) of each tree's top.

    Joins go by (g, index), so no tree, however large, is one key.
    """
    reached = above.select("g", F.lit(0).cast("long").alias("idx"), "height", "subroot", "path")
    for at in reversed(range(len(levels))):
        parents = reached.where(F.col("height") > at).select(
            "g", F.col("idx").alias("_parent"), "height", "subroot", F.col("path").alias("_path")
        )
        below = levels[at].withColumn("_parent", F.expr(f"idx div {fanout}")).join(parents, ["g", "_parent"])
        here = below.select(
            "g", "idx", "height", "subroot", F.concat(F.array(F.struct("left", "right")), "_path").alias("path")
        )
        # trees of fewer levels start further down
        reached = materialize(here.unionByName(reached.where(F.col("height") <= at)))
    return reached


def manifest(docs: DataFrame, fanout: int = FANOUT) -> tuple[DataFrame, str | None]:
    """Every document's doc_id, leaf ``digest``, ``tampered`` leaf, ``subroot`` and ``path``; and the root.

    ``path`` lists, from the leaf up, the siblings left and right of it, as digests in a row.
    ``tampered`` is null where tampering changes nothing or the id is not picked for it.
    """
    typed = documents_of(docs, "source", "lang", "n_chars")
    due = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaf = leaf_of()
    rows = materialize(
        typed.select(
            "doc_id",
            _key(F.col("lang")).alias("g"),
            leaf.alias("digest"),
            # where nothing is tampered with, the leaf is the same and need not travel twice
            F.when(due & (lowered != F.col("text")), leaf_of(text=lowered)).alias("tampered"),
        )
    )
    # two levels of trees: of languages, and of the languages' roots
    leaves = materialize(numbered(rows, "g", "doc_id", "digest"))
    levels, subroots = tree_levels(leaves, fanout)
    one = subroots.select(F.lit("").alias("g"), F.col("g").alias("lang"), "digest")
    heads = materialize(numbered(one, "g", "lang"))
    head_levels, top = tree_levels(heads, fanout)
    first = top.first()
    if first is None:
        return leaves.select("doc_id", "g", "digest", "tampered").limit(0), None
    start = top.select("g", "height", F.col("digest").alias("subroot"), F.array().cast(_NO_PATH).alias("path"))
    over = _paths(head_levels, start, fanout)
    tall = subroots.select(F.col("g").alias("lang"), "height")
    above = heads.join(over.select("g", "idx", "path"), ["g", "idx"]).join(tall, "lang")
    above = above.select(F.col("lang").alias("g"), "height", F.col("digest").alias("subroot"), "path")
    below = _paths(levels, above, fanout)
    return leaves.join(below.select("g", "idx", "subroot", "path"), ["g", "idx"]), first["digest"].hex()


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to, as hex."""
    return F.aggregate(
        path,
        as_text(leaf),
        lambda a, p: F.sha2(F.concat(as_text(p["left"]), a, as_text(p["right"])), 256),
    )


def proofs(docs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Per document its leaf, roots, the digest of its proof, and the root folded from a
    document with text in lower case, where a hash of the id picks it for tampering."""
    found, root = manifest(docs, fanout)
    if root is None:
        names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
        return found.select("doc_id", *[F.lit(None).cast("string").alias(c) for c in names], F.lit(None).cast("boolean").alias("verified"))
    listed = F.transform("path", lambda p: as_text(F.concat(p["left"], p["right"])))
    return found.select(
        "doc_id",
        as_text(F.col("digest")).alias("leaf"),
        as_text(F.col("subroot")).alias("subroot"),
        F.lit(root).alias("root"),
        F.sha2(F.concat_ws("", listed), 256).alias("proof_sha256"),
        folded(F.coalesce("tampered", "digest"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proofs(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _field_sql(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || {value} END"


_LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12_SQL = f"""WITH RECURSIVE
crc_table AS (
SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS crcs
FROM (SELECT unnest(range(256)) AS b)),
docs AS (
SELECT row_number() OVER () AS row, doc_id, COALESCE('=' || lang, '') AS g,
  sha256({" || ".join(_field_sql(c) for c in FIELDS)}) AS leaf,
  sha256({" || ".join(_field_sql(_LOWER_SQL if c == "text" else c) for c in FIELDS)}) AS lowered,
  xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
    lambda c, x: xor(c >> 8, crcs[(xor(c, x) & 255) + 1])), 4294967295) % 3 = 0 AS due
FROM documents, crc_table),
leaves AS (
SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM docs),
nodes AS (
SELECT 0 AS level, g, idx, n, leaf AS digest FROM leaves
UNION ALL
SELECT level + 1, g, idx // {FANOUT}, (any_value(n) + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(digest, '' ORDER BY idx))
FROM nodes WHERE n > 1 GROUP BY level, g, idx // {FANOUT}),
heads AS (
SELECT g, digest AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
SELECT 0 AS level, idx, n, subroot AS digest FROM heads
UNION ALL
SELECT level + 1, idx // {FANOUT}, (any_value(n) + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(digest, '' ORDER BY idx))
FROM tops WHERE n > 1 GROUP BY level, idx // {FANOUT}),
low_runs AS (
SELECT a.level, a.g, a.idx, COALESCE(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
  COALESCE(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
FROM nodes a JOIN nodes b ON a.level = b.level AND a.g = b.g AND a.idx // {FANOUT} = b.idx // {FANOUT}
WHERE a.n > 1 GROUP BY ALL),
top_runs AS (
SELECT a.level, a.idx, COALESCE(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
  COALESCE(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
FROM tops a JOIN tops b ON a.level = b.level AND a.idx // {FANOUT} = b.idx // {FANOUT} WHERE a.n > 1 GROUP BY ALL),
low_fold AS (
SELECT row, g, 0 AS level, idx, CASE WHEN due THEN lowered ELSE leaf END AS cur, '' AS proof FROM leaves
UNION ALL
SELECT f.row, f.g, f.level + 1, f.idx // {FANOUT}, sha256(s.l || f.cur || s.r), f.proof || s.l || s.r
FROM low_fold f JOIN low_runs s ON s.level = f.level AND s.g = f.g AND s.idx = f.idx),
low_end AS (SELECT row, g, arg_max(cur, level) AS cur, arg_max(proof, level) AS proof FROM low_fold GROUP BY row, g),
top_fold AS (
SELECT e.row, 0 AS level, h.idx, e.cur, e.proof FROM low_end e JOIN heads h USING (g)
UNION ALL
SELECT f.row, f.level + 1, f.idx // {FANOUT}, sha256(s.l || f.cur || s.r), f.proof || s.l || s.r
FROM top_fold f JOIN top_runs s ON s.level = f.level AND s.idx = f.idx),
top_end AS (SELECT row, arg_max(cur, level) AS cur, arg_max(proof, level) AS proof FROM top_fold GROUP BY row)
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = digest AS verified
FROM docs JOIN heads USING (g) JOIN top_end USING (row), (SELECT digest FROM tops WHERE n = 1)"""
