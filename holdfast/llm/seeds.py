"""Matches of word runs between documents and the first document that holds them.

Every document has about two seeds (hashes of word runs) a word, and most of them occur
nowhere else. So chunks of documents first tell, in about two bytes a seed, which they hold;
tasks that each compare one range of hashes answer which occur in several documents.
Of these the chunks send the place in their smallest document, and learn the smallest
document of all and its place. Both times a chunk speaks of a seed once, however often
it occurs, so a frequent one is no larger for its range than the number of chunks. Matches then
arise inside the chunk, which holds all places of its documents, and never travel.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.words import _powers, map_rows, mix, runs
from holdfast.session import materialize

#: seeds of some texts: hashes, numbers of the texts, places; ascending by kind, text and place
SeedsOf = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]]

SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
CHUNK_BYTES = 2 << 20  # texts whose seeds are made different together
_BLOCK_BITS = 10  # rows of a block, of which chunks are parts
_TOLD = 1_000_000  # seeds told to a range, about
_SENT = 400_000  # seeds sent to a range, about
_TASK_BYTES = 16 << 20  # texts of a task
_SEED_BYTES = 4  # of text for each seed, at least about
_SPARE_TOLD = 4  # bits beyond the number of seeds: one in 16 is asked about in vain, at most
_SPARE_SENT = 18  # one in 260,000 meets another by chance


def packed(*lists: np.ndarray) -> bytes:
    """Lists of one length of whole numbers, as planes of equal bytes, which pack well; few where numbers are small."""
    widths = [max(1, -(-int(v.max()).bit_length() // 8)) if len(v) else 1 for v in lists]
    planes = [v.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :k].T.tobytes() for v, k in zip(lists, widths)]
    return bytes(widths) + b"".join(planes)


def unpacked(data: bytes, n: int, lists: int) -> tuple[list[np.ndarray], bytes]:
    """The lists of ``n`` numbers, and the bytes behind them."""
    out, at = [], lists
    for k in data[:lists]:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :k] = np.frombuffer(data, np.uint8, k * n, at).reshape(k, n).T
        out.append(wide.view("<u8")[:, 0].astype(np.uint64))
        at += k * n
    return out, data[at:]


def rising(values: np.ndarray) -> np.ndarray:
    """Steps of an ascending list, the first one from 0."""
    return np.diff(values, prepend=np.uint64(0))


def run_hashes(values: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """For each size the hashes of all runs of so many values."""
    up, down = _powers(1 << max(16, len(values).bit_length()))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values | np.uint64(1)) * up[: len(values)], out=total[1:])
    out = []
    for k in sizes:
        n = max(len(values) - k + 1, 0)
        out.append(mix((total[k : k + n] - total[:n]) * down[:n] + np.uint64(k)))
    return out


def smallest_places(hashes: np.ndarray, window: int, known: np.ndarray | None = None) -> np.ndarray:
    """Places of the smallest hash of every window, by the upper halves; the last of equal ones.

    ``known`` marks places that count: stretches of them, at least ``window - 1`` apart. A window
    lies within a stretch; one of fewer places is a window itself.
    """
    n = len(hashes)
    known = np.ones(n, bool) if known is None else known
    if not known.any():
        return np.zeros(0, np.int64)
    half = np.uint64(0xFFFFFFFF)
    low = (hashes & ~half) | (half - np.arange(n, dtype=np.uint64))
    low[~known] = ~np.uint64(0)
    low = np.concatenate((low, np.full(window, ~np.uint64(0))))
    width, starts = 1, known.copy()
    starts[1:] &= ~known[:-1]
    whole = np.concatenate((known[window - 1 :], np.zeros(min(window - 1, n), bool)))[:n]
    while 2 * width <= window:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:n], low[window - width : window - width + n])
    low = low[known & (starts | whole)]
    places = (half - (low & half)).astype(np.int64)
    return places[np.r_[True, np.diff(places) != 0]]  # ascending, as windows move on


def _ranges(key: np.ndarray, bits: int, count: int) -> np.ndarray:
    """Number of the range, of ``count`` equal ones, of hashes of ``bits`` bits."""
    high = key >> np.uint64(bits - 32) if bits > 32 else key << np.uint64(32 - bits)
    return (high * np.uint64(count) >> np.uint64(32)).astype(np.int64)


def _parts(places: np.ndarray) -> Iterator[tuple[int, slice]]:
    edge = np.flatnonzero(np.diff(places, prepend=-1, append=-1))
    for a, b in zip(edge[:-1], edge[1:]):
        yield int(places[a]), slice(int(a), int(b))


def in_order(short: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stable order of hashes of ``bits`` bits, these in order, which are the first of their kind)."""
    low = len(short).bit_length()
    if bits + low <= 64:
        both = np.sort(short << np.uint64(low) | np.arange(len(short), dtype=np.uint64))
        order, sorted_ = (both & np.uint64((1 << low) - 1)).astype(np.int64), both >> np.uint64(low)
    else:
        order = np.argsort(short, kind="stable")
        sorted_ = short[order]
    new = np.r_[True, sorted_[1:] != sorted_[:-1]] if len(order) else np.zeros(0, bool)
    return order, sorted_, new


class Chunk:
    """Seeds of some documents: hash, document and place of each, documents ascending by id."""

    def __init__(self, rows: list[tuple], seeds_of: SeedsOf):
        self.first, self.last = rows[0][0], rows[-1][0]
        rows = sorted(rows, key=lambda r: r[1])
        self.ids = np.array([r[1] for r in rows], np.int64)
        self.value, self.doc, self.at = seeds_of([r[2] for r in rows])

    def _sorted(self, bits: int, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``in_order`` of the seeds by hashes of ``bits`` bits."""
        # seeds of a kind lie in order of documents; equal ones stay so
        return in_order(value >> np.uint64(64 - bits), bits)

    def marked(self, bits: int, marks: np.ndarray) -> np.ndarray:
        """The seeds whose hashes, ascending, are marked."""
        order, _, new = self._sorted(bits, self.value)
        if int(new.sum()) != len(marks):
            raise RuntimeError("answers do not fit the chunk")
        return np.sort(order[marks[np.cumsum(new) - 1]])

    def different(self, bits: int, which: np.ndarray | None = None):
        """(hashes of ``bits`` bits, ascending; place of the first of each; whether several documents
        hold it) of the seeds ``which``."""
        value = self.value if which is None else self.value[which]
        doc = self.doc if which is None else self.doc[which]
        order, sorted_, new = self._sorted(bits, value)
        starts = np.flatnonzero(new)
        ends = np.r_[starts[1:], len(order)] - 1 if len(starts) else starts
        first = order[starts]
        several = np.zeros(len(starts), bool)
        more = np.flatnonzero(ends != starts)  # most seeds occur once
        several[more] = doc[first[more]] != doc[order[ends[more]]]
        return sorted_[starts], first, several

    def numbers(self, bits: int, which: np.ndarray) -> tuple[int, np.ndarray]:
        """How many different hashes of ``bits`` bits the seeds ``which`` have, and the number of each seed's."""
        order, _, new = self._sorted(bits, self.value[which])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        return int(new.sum()), number


def _chunks(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Consecutive rows (uid, doc_id, bytes) of one block, up to a number of bytes."""
    held, weight = [], 0
    for row in rows:
        if held and (row[0] >> _BLOCK_BITS != held[0][0] >> _BLOCK_BITS or weight >= CHUNK_BYTES):
            yield held
            held, weight = [], 0
        held.append(row)
        weight += len(row[2])
    if held:
        yield held


def _tell(rows, seeds_of: SeedsOf, bits: int, ranges: int):
    pack = zstandard.ZstdCompressor(level=1)
    for held in _chunks(rows):
        chunk = Chunk(held, seeds_of)
        short, _, several = chunk.different(bits)
        for place, part in _parts(_ranges(short, bits, ranges)):
            data = packed(rising(short[part])) + np.packbits(several[part]).tobytes()
            yield place, chunk.first, chunk.last, pack.compress(data), len(short[part])


def _answer(rows):
    """A bit for each seed told: whether several documents hold it."""
    unpack = zstandard.ZstdDecompressor()
    for (place,), told in runs(rows, 1):
        values, notes = [], []
        for _, _, data, n in told:
            raw = unpack.decompress(data)
            (steps,), rest = unpacked(raw, n, 1)
            values.append(np.cumsum(steps))
            notes.append(np.unpackbits(np.frombuffer(rest, np.uint8), count=n))
        value = np.concatenate(values)
        value -= value.min()
        order, _, new = in_order(value, int(value.max()).bit_length())
        # a chunk tells of a seed once: it is of several, or of one that holds it in several documents
        several = np.concatenate(notes) > 0
        several[order[~(new & np.r_[new[1:], True])]] = True
        at = 0
        for first, last, _, n in told:
            yes = several[at : at + n]
            yield first, place, last, np.packbits(yes).tobytes(), n, int(yes.sum())
            at += n


def _asked(chunk: Chunk, told: list[tuple[bytes, int]], bits: int) -> np.ndarray:
    """Which seeds of a chunk several documents hold, a few more among them."""
    marks = np.concatenate([np.unpackbits(np.frombuffer(d, np.uint8), count=n) for d, n in told]).astype(bool)
    return chunk.marked(bits, marks)


def _with_answers(rows) -> Iterator[tuple[list, list, list]]:
    """(documents of a chunk, first and second answers to it), from rows in order of (uid, kind, place)."""
    held, answers, last = [], ([], []), -1
    for uid, kind, _, upto, doc_id, data, n in rows:
        if kind < 2:
            if held:
                yield held, *answers
                held, answers = [], ([], [])
            answers[kind].append((data, n))
            last = upto
        elif uid <= last:
            held.append((uid, doc_id, data))
    if held:
        yield held, *answers


def _send(rows, seeds_of: SeedsOf, bits: int, wide: int, ranges: int):
    """Of seeds that several documents hold: hash, smallest document of the chunk, first place there."""
    pack = zstandard.ZstdCompressor(level=1)
    for held, told, _ in _with_answers(rows):
        chunk = Chunk(held, seeds_of)
        which = _asked(chunk, told, bits)
        short, first, several = chunk.different(wide, which)
        ids, at = chunk.ids[chunk.doc[which][first]], chunk.at[which][first]
        for place, part in _parts(_ranges(short, wide, ranges)):
            base = int(ids[part].min())
            data = packed(rising(short[part]), ids[part] - base, at[part])
            data += np.packbits(several[part]).tobytes()
            yield place, chunk.first, chunk.last, pack.compress(data), len(short[part]), base


def _elect(rows):
    """For each seed sent whether several documents hold it, and of those the smallest one and its place."""
    pack, unpack = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
    for (place,), sent in runs(rows, 1):
        values, owners, places, notes = [], [], [], []
        for _, _, data, n, base in sent:
            raw = unpack.decompress(data)
            (steps, ids, at), rest = unpacked(raw, n, 3)
            values.append(np.cumsum(steps))
            owners.append(ids.astype(np.int64) + base)
            places.append(at.astype(np.int64))
            notes.append(np.unpackbits(np.frombuffer(rest, np.uint8), count=n))
        value, owner, at = np.concatenate(values), np.concatenate(owners), np.concatenate(places)
        order = np.lexsort((owner, value))
        new = np.r_[True, np.diff(value[order]) != 0]
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        chosen = order[new]
        several = np.diff(np.r_[np.flatnonzero(new), len(order)]) > 1
        several[number[np.concatenate(notes) > 0]] = True
        start = 0
        for first, last, _, n, _ in sent:
            mine = number[start : start + n]
            start += n
            yes = several[mine]
            found = chosen[mine[yes]]
            base = int(owner[found].min()) if len(found) else 0
            data = np.packbits(yes).tobytes() + base.to_bytes(8, "little", signed=True)
            data += packed(owner[found] - base, at[found])
            yield first, place, last, pack.compress(data), n


def _matches(rows, seeds_of: SeedsOf, bits: int, wide: int):
    """(doc_ids, owners, places, places in the owner), arrays of a chunk in order of all four."""
    unpack = zstandard.ZstdDecompressor()
    for held, told, elected in _with_answers(rows):
        if not elected:
            continue
        chunk = Chunk(held, seeds_of)
        which = _asked(chunk, told, bits)
        count, number = chunk.numbers(wide, which)
        shared, owner, to = np.zeros(count, bool), np.zeros(count, np.int64), np.zeros(count, np.int64)
        at = 0
        for data, n in elected:
            raw = unpack.decompress(data)
            size = -(-n // 8)
            yes = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, size), count=n)) + at
            base = int.from_bytes(raw[size : size + 8], "little", signed=True)
            (ids, places), _ = unpacked(raw[size + 8 :], len(yes), 2)
            shared[yes] = True
            owner[yes] = ids.astype(np.int64) + base
            to[yes] = places.astype(np.int64)
            at += n
        if at != count:
            raise RuntimeError("answers do not fit the chunk")
        doc, place = chunk.doc[which], chunk.at[which]
        mine = np.flatnonzero(shared[number] & (owner[number] != chunk.ids[doc]))
        doc, place, owners, places = doc[mine], place[mine], owner[number[mine]], to[number[mine]]
        order = np.lexsort((places, place, owners, doc))
        yield chunk.ids[doc[order]], owners[order], place[order], places[order]


@contextlib.contextmanager
def shuffles_go(spark) -> Iterator[None]:
    """Shuffle files go once the result they served is written: for steps that are each run once."""
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_CONF)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


def seed_matches(docs: DataFrame, seeds_of: SeedsOf, use: Callable, schema: str) -> DataFrame:
    """``use`` over the matches of documents (doc_id, text) with the smallest document of each seed.

    ``use`` takes arrays (doc_ids, owners, places, first places in the owner), in order, all of a document
    together, and gives rows of ``schema``. doc_ids are unique and not null. The result is written.
    """
    spark = docs.sparkSession
    texts = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    stored = materialize(docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", texts.alias("data")))
    total = stored.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    seeds = int(total / _SEED_BYTES) + 1
    bits, wide = (min(64, seeds.bit_length() + spare) for spare in (_SPARE_TOLD, _SPARE_SENT))
    ranges, tasks = seeds // _TOLD + 1, int(total / _TASK_BYTES) + 1
    number, nothing = F.lit(0).cast("long"), F.lit(None).cast("long")

    def in_ranges(told: DataFrame, count: int) -> DataFrame:
        return told.repartition(count, "place").sortWithinPartitions("place", "uid")

    def beside(*answers: DataFrame) -> DataFrame:
        """Texts behind the answers to their chunks, in order."""
        out = stored.select(
            "uid", F.lit(2).alias("kind"), number.alias("place"), number.alias("last"), "doc_id", "data", number.alias("n")
        )
        for kind, part in enumerate(answers):
            part = part.select("uid", F.lit(kind).alias("kind"), "place", "last", nothing.alias("doc_id"), "data", "n")
            out = out.unionByName(part)
        block = F.shiftright("uid", _BLOCK_BITS)
        return out.repartition(tasks, block).sortWithinPartitions("uid", "kind", "place")

    with shuffles_go(spark):
        told = map_rows(
            stored, lambda rows: _tell(rows, seeds_of, bits, ranges), "place long, uid long, last long, data binary, n long"
        )
        answers = materialize(
            map_rows(in_ranges(told, ranges), _answer, "uid long, place long, last long, data binary, n long, several long")
        )
        several = answers.agg(F.sum("several")).first()[0] or 0
        count = several // _SENT + 1
        sent = map_rows(
            beside(answers),
            lambda rows: _send(rows, seeds_of, bits, wide, count),
            "place long, uid long, last long, data binary, n long, base long",
        )
        elected = materialize(
            map_rows(in_ranges(sent, count), _elect, "uid long, place long, last long, data binary, n long")
        )
        return materialize(map_rows(beside(answers, elected), lambda rows: use(_matches(rows, seeds_of, bits, wide)), schema))
