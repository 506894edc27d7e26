"""Fill-in-middle transformation by block rotation inside one buffer, and its exact inverse.

A text is units: runs of ASCII letters, and single characters that are none. Two cuts,
drawn from a hash of the document's id, part it into prefix, middle and suffix. The
buffer holds ``<P>prefix<M>middle<S>suffix``; one rotation, made of three reversals,
brings the suffix ahead of the middle (form ``psm``) or ahead of everything (``spm``).
The inverse finds the sentinels, turns the rotation back and takes them out. A sentinel
can't appear across the seam of text and sentinel, as none starts or ends within another.

Odd rows: a null text counts as empty; an empty text, and one that holds a sentinel, stays
``plain``; a null doc_id draws from the hash of ``<seed>:`` alone; repeated rows give repeated
results; other columns of the table are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.words import documents_of, map_rows

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3  # bytes of a sentinel
SEED = 1
PERCENT = 90  # of the texts that can be transformed
SPM_PERCENT = 20  # of the transformed ones
SCHEMA = "doc_id long, text string, n long, form string, prefix_chars long, middle_chars long, output string"


def reverse(buf: np.ndarray, i: int, j: int) -> None:
    """Turn ``buf[i:j]`` round in place."""
    half = (j - i) // 2
    front = buf[i : i + half].copy()
    buf[i : i + half] = buf[j - half : j][::-1]
    buf[j - half : j] = front[::-1]


def rotate(buf: np.ndarray, i: int, m: int, j: int) -> None:
    """Exchange the neighbouring segments ``buf[i:m]`` and ``buf[m:j]`` by three reversals."""
    reverse(buf, i, m)
    reverse(buf, m, j)
    reverse(buf, i, j)


def unit_starts(data: bytes) -> np.ndarray:
    """Byte places where units of UTF-8 ``data`` start."""
    buf = np.frombuffer(data, np.uint8)
    lower = buf | 32
    letter = (lower >= 97) & (lower <= 122)
    inside = np.zeros(len(buf), bool)
    inside[1:] = letter[1:] & letter[:-1]
    return np.flatnonzero(~inside & ((buf & 0xC0) != 0x80))


def characters(buf: np.ndarray) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.count_nonzero((buf & 0xC0) != 0x80))


def draws(doc_id: int | None, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[at : at + 8], 16) for at in (0, 8, 16, 24)]


def transform(data: bytes, h: list[int], percent: int = PERCENT, spm_percent: int = SPM_PERCENT):
    """(number of units, form, code points of prefix and middle, transformed bytes)."""
    starts = unit_starts(data)
    n = len(starts)
    marked = any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE))
    if not data or marked or h[2] % 100 >= percent:
        return n, "plain", None, None, data
    places = [len(data) if k == n else int(starts[k]) for k in sorted((h[0] % (n + 1), h[1] % (n + 1)))]
    a, b = places
    out = bytearray(data)
    out[b:b] = SUFFIX
    out[a:a] = MIDDLE
    out[0:0] = PREFIX
    buf = np.frombuffer(out, np.uint8)  # a view: rotations change the bytearray itself
    middle, suffix = a + MARK, b + 2 * MARK  # where their sentinels stand
    form = "spm" if h[3] % 100 < spm_percent else "psm"
    counts = characters(buf[MARK:middle]), characters(buf[middle + MARK : suffix])
    rotate(buf, 0 if form == "spm" else middle, suffix, len(out))
    del buf
    return n, form, *counts, bytes(out)


def restore(data: bytes, form: str) -> bytes:
    """The exact text of a transformed one."""
    if form == "plain":
        return data
    out = bytearray(data)
    middle, suffix, prefix = out.find(MIDDLE), out.find(SUFFIX), out.find(PREFIX)
    buf = np.frombuffer(out, np.uint8)
    if form == "psm":  # <P>prefix<S>suffix<M>middle
        rotate(buf, suffix, middle, len(out))
        middle, suffix = suffix, suffix + len(out) - middle
    else:  # <S>suffix<P>prefix<M>middle
        rotate(buf, 0, prefix, len(out))
        middle, suffix = middle - prefix, len(out) - prefix
    del buf
    for at in (suffix, middle, 0):
        del out[at : at + MARK]
    return bytes(out)


def fill_in_middle(
    docs: DataFrame, seed: int = SEED, percent: int = PERCENT, spm_percent: int = SPM_PERCENT
) -> DataFrame:
    """doc_id, text, n (units), form, prefix_chars, middle_chars and output of every document."""

    def run(rows):
        for doc_id, text in rows:
            data = (text or "").encode("utf-8", "surrogatepass")
            n, form, before, inside, out = transform(data, draws(doc_id, seed), percent, spm_percent)
            yield doc_id, text, n, form, before, inside, out.decode("utf-8", "surrogatepass")

    return map_rows(documents_of(docs), run, SCHEMA)


def restored(transformed: DataFrame) -> DataFrame:
    """Column ``restored`` with the text rebuilt from ``output`` and ``form`` alone, other columns kept but the text."""
    kept = [f for f in transformed.schema if f.name not in ("output", "form", "text")]
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def run(rows):
        for output, form, *rest in rows:
            text = restore(output.encode("utf-8", "surrogatepass"), form)
            yield output, form, text.decode("utf-8", "surrogatepass"), *rest

    columns = transformed.select("output", "form", *(F.col(f"`{f.name}`") for f in kept))
    return map_rows(columns, run, f"output string, form string, restored string, {names}")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return restored(fill_in_middle(docs)).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


OP13_SQL = """WITH units AS (
SELECT doc_id, COALESCE(text, '') AS t, regexp_extract_all(COALESCE(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
  sha256('1:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
SELECT doc_id, t, u, len(u) AS n,
  CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS c2,
  CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS c3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS c4 FROM units),
formed AS (
SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c3 >= 90 THEN 'plain'
  WHEN c4 < 20 THEN 'spm' ELSE 'psm' END AS form,
  array_to_string(u[1:least(c1, c2)], '') AS p, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
  array_to_string(u[greatest(c1, c2) + 1:n], '') AS s FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM formed"""
