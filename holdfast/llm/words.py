"""Words, hashes and Arrow loops shared by the text operators.

A word is a maximal run of bytes other than space and tab to carriage return, the
pattern ``[^\\x20\\x09-\\x0D]+``. Hashes depend on the text alone: they are the same
in every process and on every machine.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000
_PIECE = 1 << 17  # bytes hashed at a time; tables of powers and sums stay a few MB per worker
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BASE = 0x9E3779B97F4A7C15 | 1


def word_count(text: Column) -> Column:
    """Number of words; 0 for a missing text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lower_bytes(text: str) -> bytes:
    """UTF-8 with A-Z in lower case; other letters stay as they are."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit value over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    solid = (buf != 32) & ((buf < 9) | (buf > 13))
    edge = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    return edge[::2], edge[1::2]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each slice ``values[start:end]``, any slices, in one pass."""
    up, down = _powers(1 << max(_PIECE.bit_length(), len(values).bit_length()))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end (in bytes) and hash of every word; long texts go piece by piece."""
    out, at = [], 0
    while at < len(data):
        stop = min(len(data), at + _PIECE)
        while stop < len(data) and data[stop] not in b" \t\n\x0b\x0c\r":
            step = data[stop : stop + 4096]
            cut = min((i for i in map(step.find, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")) if i >= 0), default=len(step))
            stop += cut
        buf = np.frombuffer(data, np.uint8, stop - at, at)
        s, e = _spans(buf)
        out.append((s + at, e + at, span_hashes(buf, s, e)))
        at = stop
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def shingles(word_hashes: np.ndarray, k: int, at_least_one: bool = True) -> np.ndarray:
    """Hashes of all runs of k words; with fewer words the whole run is the only one."""
    n = len(word_hashes)
    if n < k:
        k = n if at_least_one else k
    if n == 0 or n < k:
        return np.zeros(0, np.uint64)
    out = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        out = out * np.uint64(_BASE) + word_hashes[i : n - k + 1 + i]
    return mix(out)


def each_row(batches: Iterator[pa.RecordBatch], size: int = 512) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples; a slice at a time, so long texts stay few in memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            yield from zip(*(c.to_pylist() for c in part.columns))


def give_back() -> None:
    """Unused memory of a worker process back to the system; workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def emit(rows: Iterator[tuple], schema: pa.Schema, size: int = 2048, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches of rows, cut by count and by the bytes of their binary and text values."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, (bytes, str)))
        if len(held) >= size or weight >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def map_rows(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """Run ``fn`` over the rows of each partition; ``schema`` in Spark's notation."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))
    # texts are long: thousands of rows a batch would fill the memory of a small executor
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(BATCH_CONF)) <= BATCH_ROWS:
        conf.set(BATCH_CONF, str(BATCH_ROWS))

    def run(batches):
        yield from emit(fn(each_row(batches)), arrow)
        give_back()

    return df.mapInArrow(run, schema)


def runs(rows: Iterator[tuple], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows with equal first ``keys`` values, as (key, rows)."""
    key, held = None, []
    for row in rows:
        if row[:keys] != key:
            if held:
                yield key, held
            key, held = row[:keys], []
        held.append(row[keys:])
    if held:
        yield key, held


def documents_of(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator works on, with their types; other columns never clash."""
    kinds = {"doc_id": "long", "n_chars": "long"}
    return docs.select(*(F.col(c).cast(kinds.get(c, "string")).alias(c) for c in ("doc_id", "text", *more)))
