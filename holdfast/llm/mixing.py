"""Mixing sources to target weights.

Each source is one long stream of words, its documents in a hashed order, cut into
blocks of a fixed number of words: 64, or in sources below 4,096 words a 64th of the
source, so that small ones meet their targets as well. Output shards hold a fixed number of block slots.
For every shard, counts of slots per source are drawn from a multinomial distribution
over the target shares; running totals number the slots of a source from 0. Slot j
takes block P(j mod n) of the source's n blocks, where P is a pseudorandom permutation
that changes with each pass j div n: a keyed Feistel network, evaluated per slot, so
no permutation is ever stored. Slots and blocks then meet in an equi-join.

Independent draws miss the targets by chance. The few slots by which one source drew
more than its quota are handed, in order, to the sources that drew too few, so totals
are exact to a block and no block is taken more often than passes allow.

Only numbers are shuffled: one narrow row per document, block and slot. Stream places
come from running sums inside cells of about 2,000 documents and over cell totals.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.words import _spans, documents_of, map_rows, word_count
from holdfast.session import materialize

BLOCK_WORDS = 64
LEAST_BLOCKS = 64  # of a source; fewer only where blocks are single words
SHARD_SLOTS = 1 << 16
TASK_SLOTS = 1 << 20
MOST_PASSES = 3
SEED = 7
CELL_ROWS = 2000
MAX_SOURCES = 100_000


class TooManySources(ValueError):
    """The source list, which every task needs, is over its bound."""


def water_fill(sizes: list[int], weights: list[float], total: float, most: float = MOST_PASSES) -> np.ndarray:
    """Shares of ``total`` by weight, none above ``most`` times its size, the excess reshared."""
    size, weight = np.array(sizes, np.float64), np.array(weights, np.float64)
    cap, target = most * size, np.zeros(len(size))
    open_, rest = size > 0, float(total)
    while open_.any():
        share = rest * weight / weight[open_].sum()
        over = open_ & (share > cap)
        if not over.any():
            target[open_] = share[open_]
            break
        target[over] = cap[over]
        rest -= cap[over].sum()
        open_ &= ~over
    return target


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Image of each index under a keyed permutation of 0..n-1 (Feistel rounds, cycle walking)."""
    from holdfast.llm.words import mix

    bits = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    half = (np.uint64(1) << bits) - np.uint64(1)
    x, out = index.astype(np.uint64), np.full(len(index), -1, np.int64)
    todo = np.arange(len(index))
    while len(todo):
        b, h, k = bits[todo], half[todo], key[todo]
        left, right = x >> b, x & h
        for turn in range(4):
            left, right = right, left ^ (mix(right + k + np.uint64(turn << 56)) & h)
        x = (left << b) | right
        done = x < n[todo].astype(np.uint64)
        out[todo[done]] = x[done].astype(np.int64)
        todo, x = todo[~done], x[~done]
    return out


def measured(docs: DataFrame, *keep: str) -> DataFrame:
    """Documents with doc_id, source, size and the columns of ``keep``, written once, so that words are counted once."""
    return materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            word_count(F.col("text").cast("string")).alias("size"),
            *(F.col(c).alias(c) for c in keep),
        )
    )


def place(sized: DataFrame, *keep: str) -> tuple[DataFrame, dict]:
    """Rows of ``measured`` with source number and place in their source's stream; and the source list.

    Sources are ordered by code point, a missing one last; they weigh 1, 2, 3, repeating.
    The list (name, rows, size) comes to the driver and is checked against MAX_SOURCES.
    Rows are sorted and joined: ``keep`` is for narrow columns.
    """
    counted = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    rows = counted.limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise TooManySources(f"more than {MAX_SOURCES} sources")
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [r["size"] for r in rows]
    targets = water_fill(sizes, [1 + i % 3 for i in range(len(rows))], sum(sizes)).tolist()
    spark = sized.sparkSession
    listed = [
        (r["source"], i, r["size"], targets[i], max(1, -(-r["n"] // CELL_ROWS))) for i, r in enumerate(rows)
    ]
    names = spark.createDataFrame(
        listed, "source string, source_no int, source_size long, target double, cells int"
    )
    sized = sized.select("doc_id", "size", F.col("source").alias("_source"), *keep).join(
        F.broadcast(names), F.col("_source").eqNullSafe(F.col("source"))
    ).drop("_source")
    dealt = sized.withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.col("cells")).cast("int"))
    totals = materialize(dealt.groupBy("source_no", "cell").agg(F.sum("size").alias("cell_size")))
    before = Window.partitionBy("source_no").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("before", F.coalesce(F.sum("cell_size").over(before), F.lit(0))).drop("cell_size")
    inside = (
        Window.partitionBy("source_no", "cell").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        dealt.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, ["source_no", "cell"])
        .withColumn("start", F.col("start") + F.col("before"))
        .select("doc_id", "source", "source_no", "size", "source_size", "target", "start", *keep)
    )
    return placed, {"sizes": sizes, "targets": targets}


def block_words(source_size: Column, most: int = BLOCK_WORDS) -> Column:
    """Words of a block of a source."""
    return F.least(F.lit(most), F.greatest(F.lit(1), F.floor(source_size / F.lit(LEAST_BLOCKS)))).cast("long")


def slots(spark: SparkSession, sizes: list[int], targets: list[float], block: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """All output slots: shard, slot (place in the shard), source_no, pass, block (of ``block_words``)."""
    out = "shard long, slot long, source_no int, pass int, block long"
    size, target = np.array(sizes, np.int64), np.array(targets)
    blocks = -(-size // np.clip(size // LEAST_BLOCKS, 1, block))
    # blocks of a source are full but for its last one, so quotas count in average blocks
    quota = np.floor(target * blocks / np.maximum(size, 1) + 0.5).astype(np.int64)
    quota = np.minimum(quota, MOST_PASSES * blocks)
    total = int(quota.sum())
    if total == 0:
        return spark.createDataFrame([], out)
    shares = quota / total
    shards = -(-total // SHARD_SLOTS)

    def draw(rows):
        for (shard,) in rows:
            n = min(SHARD_SLOTS, total - shard * SHARD_SLOTS)
            counts = np.random.default_rng([seed, shard]).multinomial(n, shares)
            for s in np.flatnonzero(counts).tolist():
                yield shard, s, int(counts[s]), int(counts[:s].sum())

    drawn = materialize(
        map_rows(spark.range(shards), draw, "shard long, source_no int, count long, base long")
    )
    got = np.zeros(len(size), np.int64)
    for row in drawn.groupBy("source_no").agg(F.sum("count").alias("n")).collect():  # one row per listed source
        got[row["source_no"]] = row["n"]
    over, short = np.maximum(got - quota, 0), np.maximum(quota - got, 0)
    over_from, short_to = np.cumsum(over) - over, np.cumsum(short)
    before = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    numbered = drawn.withColumn("first", F.coalesce(F.sum("count").over(before), F.lit(0))).select(
        "shard", "source_no", "count", "base", "first"
    )

    def fill(rows):
        for shard, s, count, base, first in rows:
            for at in range(0, count, 1 << 15):
                i = np.arange(at, min(count, at + (1 << 15)))
                j, source = first + i, np.full(len(i), s)
                handed = j >= quota[s]
                if handed.any():
                    number = over_from[s] + j[handed] - quota[s]
                    taker = np.searchsorted(short_to, number, side="right")
                    j[handed] = got[taker] + number - (short_to[taker] - short[taker])
                    source[handed] = taker
                n = blocks[source]
                turn = j // n
                key = (source.astype(np.uint64) << np.uint64(32)) + (turn.astype(np.uint64) << np.uint64(8)) + np.uint64(seed)
                picked = permute(j % n, n, key)
                size_here = min(SHARD_SLOTS, total - shard * SHARD_SLOTS)
                spot = permute(base + i, np.full(len(i), size_here), np.full(len(i), np.uint64(shard * 2654435761 + seed)))
                yield from zip([shard] * len(i), spot.tolist(), source.tolist(), turn.tolist(), picked.tolist())

    # few narrow rows make many slots: they are dealt by the slots they make, not by their own size
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_SLOTS))
    return map_rows(numbered.repartition(parts, "shard", "source_no"), fill, out)


def spans(placed: DataFrame, *keep: str, block: int = BLOCK_WORDS) -> DataFrame:
    """Parts of documents by block: source_no, block, start (the document's), from, words, and the columns of ``keep``."""
    b = F.col("_words")
    parts = placed.where(F.col("size") > 0).withColumn("_words", block_words(F.col("source_size"), block)).select(
        "source_no",
        "start",
        "size",
        "_words",
        *keep,
        F.explode(F.sequence(F.floor(F.col("start") / b), F.floor((F.col("start") + F.col("size") - 1) / b))).alias("block"),
    )
    low = F.greatest(F.col("block") * b, F.col("start"))
    high = F.least((F.col("block") + 1) * b, F.col("start") + F.col("size"))
    return parts.select("source_no", "block", "start", (low - F.col("start")).alias("from"), (high - low).alias("words"), *keep)


def mix_documents(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, size, source_size, target (its source's) and taken (words the mix takes).

    Missing or empty texts have size 0 and are not taken; rows that repeat a doc_id have
    places of their own; a missing source is a source. An empty table gives no rows.
    """
    found, listed = place(measured(docs))
    placed = materialize(found)
    used = slots(docs.sparkSession, listed["sizes"], listed["targets"]).groupBy("source_no", "block").agg(
        F.count("*").alias("uses")
    )
    taken = (
        spans(placed)
        .join(used.hint("merge"), ["source_no", "block"])  # both sides grow with the input
        .groupBy("source_no", "start")
        .agg(F.sum(F.col("words") * F.col("uses")).alias("taken"))
        .withColumn("full", F.lit(True))
    )
    return placed.withColumn("full", F.col("size") > 0).join(taken.hint("merge"), ["source_no", "start", "full"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def _cut(text: str, parts: list[tuple[int, int]]) -> str:
    """The words from..from+n of each part; neighbouring parts joined, others on new lines."""
    data = text.encode("utf-8", "surrogatepass")
    s, e = _spans(np.frombuffer(data, np.uint8))
    merged: list[list[int]] = []
    for at, n in sorted(parts):
        if merged and merged[-1][1] == at:
            merged[-1][1] = at + n
        else:
            merged.append([at, at + n])
    return "\n".join(data[s[a] : e[b - 1]].decode("utf-8", "surrogatepass") for a, b in merged)


def mixed_texts(docs: DataFrame) -> DataFrame:
    """The mix as documents: one row for each pass over a row that takes words of it.

    A pass that takes all words keeps the text as it is, another one the words taken.
    Columns are doc_id, text, lang, source, n_chars; rows with no words fall out, as
    the mix takes nothing of them.
    """
    typed = documents_of(docs, "lang", "source").withColumn("row", F.monotonically_increasing_id())
    # the written table fixes the numbers of rows; texts are written once and wait there for what is taken of them
    texts = measured(typed, "row", "text", "lang")
    found, listed = place(texts, "row")
    placed = materialize(found)
    taken = (
        spans(placed, "row")
        .join(slots(docs.sparkSession, listed["sizes"], listed["targets"]).hint("merge"), ["source_no", "block"])
        .groupBy("row", "pass")
        .agg(F.sum("words").alias("taken"), F.collect_list(F.struct("from", "words")).alias("parts"))
    )
    met = texts.where(F.col("size") > 0).join(taken.hint("merge"), "row").select(
        "doc_id",
        "text",
        "lang",
        "source",
        F.when(F.col("taken") < F.col("size"), F.col("parts")).alias("parts"),
    )

    def cut(rows):
        for doc_id, text, lang, source, parts in rows:
            if parts is not None:
                text = _cut(text, [(p["from"], p["words"]) for p in parts])
            yield doc_id, text, lang, source, len(text)

    return map_rows(met, cut, "doc_id long, text string, lang string, source string, n_chars long")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
