"""Best-fit decreasing packing of token sequences.

Documents become token ids followed by one end id. Documents longer than a sequence
are cut into pieces of exactly one sequence; what is left over, and every shorter
document, is packed whole. Pieces are dealt by hash into groups of a bounded number
of rows, and each group is packed by itself: only (id, piece, length, checksum) is
shuffled, never text or ids, and a group costs at most a partly filled last sequence.

Inside a group, pieces come in decreasing length. Open sequences are kept by their
remaining capacity; a segment tree over the capacities finds the tightest one that
still fits in as many steps as the capacity has binary digits.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.words import documents_of, map_rows
from holdfast.session import materialize

CAPACITY = 2048
GROUP_ROWS = 4096
CACHE_WORDS = 250_000  # about 50 MB; workers live on through later stages


class TightestFit:
    """Open bins by remaining capacity; finds the smallest capacity that is enough."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.width = 1 << capacity.bit_length()  # leaves 0..capacity
        self.used = bytearray(2 * self.width)  # node: does any leaf below hold a bin?
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _mark(self, leaf: int, on: bool) -> None:
        node = self.width + leaf
        self.used[node] = on
        node >>= 1
        while node:
            value = self.used[2 * node] | self.used[2 * node + 1]
            if self.used[node] == value:
                break
            self.used[node] = value
            node >>= 1

    def add(self, remaining: int, bin_no: int) -> None:
        held = self.bins[remaining]
        held.append(bin_no)
        if len(held) == 1:
            self._mark(remaining, True)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (remaining, bin) of the tightest bin with room, if any."""
        node = self.width + need
        if not self.used[node]:
            # climb to the first right neighbour that holds a bin, then go down leftmost
            while node > 1 and (node & 1 or not self.used[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.width:
                node = 2 * node if self.used[2 * node] else 2 * node + 1
        remaining = node - self.width
        held = self.bins[remaining]
        bin_no = held.pop()
        if not held:
            self._mark(remaining, False)
        return remaining, bin_no


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) for each length, given in decreasing order."""
    fit, out, opened = TightestFit(capacity), [], 0
    for n in lengths:
        found = fit.take(n) if n < capacity else None
        if found is None:
            remaining, bin_no = capacity, opened
            opened += 1
        else:
            remaining, bin_no = found
        out.append((bin_no, capacity - remaining))
        if remaining > n:
            fit.add(remaining - n, bin_no)
    return out


class WordIds(dict):
    """Token ids, as packed 32-bit values, of text between spaces and line ends.

    The tokenizer drops white space and never joins across it, so ids of a text are
    those of its parts in order. Plain words go straight to the merge model.
    """

    # letters that lower-casing and composing leave alone but for case, and signs behind them:
    # the tokenizer splits between the two
    _PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:%&$*#]*)")

    def __init__(self, tokenizer):
        super().__init__()
        tokenizer.no_truncation()
        self.tokenizer, self.model = tokenizer, tokenizer.model
        # byte-level vocabularies write printable bytes as themselves and number the others from 256
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = iter(range(256, 512))
        self.letters = [chr(b) if b in plain else chr(next(other)) for b in range(256)]

    def __missing__(self, part: str) -> bytes:
        m = self._PLAIN.fullmatch(part)
        if m and len(part) < 1000:
            word, signs = m[1].lower(), m[2]
            if signs or word != part:
                packed = self[word] + self[signs]
            else:
                known = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
                packed = array("I", [t.id for t in self.model.tokenize(known)]).tobytes()
        else:
            packed = array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()
        if len(self) < CACHE_WORDS and len(part) < 64:
            self[part] = packed
        return packed

    def ids(self, text: str) -> bytes:
        parts = text.replace("\n", " ").split(" ")
        return b"".join(map(self.__getitem__, parts))


_LOADED: dict[int, WordIds] = {}


def _word_ids(definition: str) -> WordIds:
    """One cache for each worker process, kept from task to task."""
    key = zlib.crc32(definition.encode())
    if key not in _LOADED:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(definition)
        found = WordIds(tokenizer)
        found[""] = b""
        _LOADED[key] = found
    return _LOADED[key]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pieces of every row: doc_id, piece, start, length, ids_crc32 (of little-endian 32-bit ids).

    A missing text counts as empty and has the end id only.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())  # a vocabulary file: a few MB, whatever the input
    end = array("I", [end_id]).tobytes()

    def cut(rows):
        words = _word_ids(definition.value)
        for doc_id, text in rows:
            ids = words.ids(text or "") + end
            if sys.byteorder == "big":
                ids = np.frombuffer(ids, np.uint32).astype("<u4").tobytes()
            step = 4 * capacity
            for piece, at in enumerate(range(0, len(ids), step)):
                part = ids[at : at + step]
                yield doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)

    return map_rows(documents_of(docs), cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Add sequence_id and offset to pieces of at most ``capacity`` tokens.

    Groups hold about ``group_rows`` pieces, dealt by a hash of all columns and of the
    row's place in the written table, so that repeated rows spread as well. Equal
    lengths go by doc_id, piece and checksum. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    groups = max(1, -(-pieces.count() // group_rows))
    # the written table fixes the order of rows, so the place of a row is stable
    dealt = pieces.withColumn(
        "grp", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)).cast("int")
    )
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def fill(key, table):
        import pyarrow as pa

        t = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        placed = best_fit_decreasing(t["length"].to_pylist(), capacity)
        base = key[0].as_py() << 32
        bins = pa.array([base + b for b, _ in placed], pa.int64())
        offsets = pa.array([o for _, o in placed], pa.int64())
        return t.select(names).append_column("sequence_id", bins).append_column("offset", offsets)

    return dealt.groupBy("grp").applyInArrow(
        fill, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenize, cut and pack all documents; one row for each piece."""
    return pack(materialize(token_pieces(docs, tokenizer_path, capacity)), capacity)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
