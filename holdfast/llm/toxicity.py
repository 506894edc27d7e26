"""Toxicity of obfuscated text: a noisy channel, then a linear score of what it restores.

Writers hide words by digits and signs for letters, by blanks or dots between letters,
and by repeating letters. Such places in a text (and only such places) become a lattice:
every sign may stand for itself or for the letters it looks like, a separator between
single letters for nothing, a run of a letter for one or two of it. The Viterbi path
under a character trigram model, with a price for each change, is the restored text.
The model is counted over all documents.

A logistic model scores restored texts from the words and word beginnings they hold.
Its features are those that labelled rows show to go with label 1, its weights are
learned by gradient descent in numpy; both from a bounded sample of labelled rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.words import documents_of, map_rows, mix, span_hashes
from holdfast.session import materialize

FIT_ROWS = 20_000  # labelled rows the classifier is fitted on, at most about
MOST_FEATURES = 20_000  # features with the strongest evidence that are weighed
LEAST_DOCS = 3  # positive rows a feature must be in
PREFIXES = (4, 5, 6)
CHANGE = 2.5  # price of one change, in natural logarithms

# Signs and the letters they stand for.
LOOKS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a",
         "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
_SIGNS = re.escape("".join(x for x in LOOKS if not x.isdigit()))
_LETTER = r"[^\W\d_]"
# punctuation that is no look-alike may stand around a place
_PUNCT = re.escape("\"'[]{}<>),.;:?\u2026\u201c\u201d\u2018\u2019\u00ab\u00bb\u201e\u00bf\u00a1")
_START, _END = rf"(?<![^\s{_PUNCT}])", rf"(?![^\s{_PUNCT}])"
_UNIT = rf"(?:{_LETTER}|[\d{_SIGNS}])"
_GAP = r"[ .\-_*]"
# single letters, digits or signs set apart; a letter must be among them or among those that follow
_SPACED = re.compile(rf"{_START}{_UNIT}(?:{_GAP}{_UNIT}){{2,}}{_END}")
_FOLLOWING = re.compile(rf"(?:{_GAP}{_UNIT})*")
_ANY_LETTER = re.compile(_LETTER)
# a letter next to a sign or digit inside a token, a letter three times
_MIXED = re.compile(
    rf"{_START}(?=[\w{_SIGNS}]*{_LETTER}[\d{_SIGNS}]+{_LETTER}|[\d{_SIGNS}]+{_LETTER}|[\w{_SIGNS}]*{_LETTER}[\d@$]+{_END})[\w{_SIGNS}]{{3,}}{_END}"
    rf"|(?<!\S)\S*({_LETTER})\1\1\S*"
)
_MAYBE = re.compile(rf"[\d{_SIGNS}]|(?<!\w)\w[ .\-_*]\w[ .\-_*]|(\w)\1\1")
SIZE = 28  # 0: anything but a letter, 1..26: a..z, 27: another letter


def _classes() -> np.ndarray:
    """Class of every code point of the basic plane; letters above it count as other letters."""
    out = np.zeros(0x10000, np.uint8)
    for i in range(0x10000):
        if chr(i).isalpha():
            out[i] = 27
    for i in range(26):
        out[97 + i] = out[65 + i] = 1 + i
    return out


_TABLE: list[np.ndarray] = []


def classes_of(text: str) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_classes())
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(cp < 0x10000, _TABLE[0][np.minimum(cp, 0xFFFF)], 27).astype(np.int64)


def _spaced_from(text: str, at: int) -> re.Match | None:
    """The next row of single characters with a letter from its start on.

    Rows of digits are passed over whole, so a table of numbers is read once.
    """
    while (found := _SPACED.search(text, at)) is not None:
        if _ANY_LETTER.search(found[0]):
            return found
        at = _FOLLOWING.match(text, found.end()).end()
        if _ANY_LETTER.search(text, found.end(), at):
            return found
    return None


def odd_places(text: str) -> Iterator[tuple[int, int]]:
    """Places to decode, from left to right; of two that start together the spaced one. Linear in the text."""
    at, spaced, mixed = 0, _spaced_from(text, 0), _MIXED.search(text)
    while spaced or mixed:
        first = spaced if spaced and (not mixed or spaced.start() <= mixed.start()) else mixed
        yield first.span()
        at = first.end()
        if spaced and spaced.start() < at:
            spaced = _spaced_from(text, at)
        if mixed and mixed.start() < at:
            mixed = _MIXED.search(text, at)


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of letter-class trigrams over the whole texts of all documents, blanks at both ends."""

    def run(rows):
        total = np.zeros(SIZE**3, np.int64)
        for (text,) in rows:
            for at in range(0, len(text or ""), 1 << 20):
                part = text[max(0, at - 2) : at + (1 << 20)]
                c = classes_of(f" {part}" if at == 0 else part)
                if at + (1 << 20) >= len(text):
                    c = np.append(c, 0)
                total += np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE**3)
        for i in np.flatnonzero(total).tolist():
            yield i, int(total[i])

    counted = map_rows(docs.select("text"), run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    out = np.zeros(SIZE**3)
    for row in counted.collect():  # at most SIZE ** 3 rows
        out[row["gram"]] = row["n"]
    return out.reshape(SIZE, SIZE, SIZE)


@dataclass
class Channel:
    """Log probabilities of a letter class after two others, and restored places so far."""

    log: np.ndarray
    cache: dict = field(default_factory=dict)

    @staticmethod
    def of(counts: np.ndarray) -> Channel:
        two, one = counts.sum(axis=0), counts.sum(axis=(0, 1))
        p1 = (one + 1) / (one.sum() + SIZE)
        p2 = (two + 20 * p1) / (two.sum(axis=1, keepdims=True) + 20)
        p3 = (counts + 20 * p2) / (counts.sum(axis=2, keepdims=True) + 20)
        return Channel(np.log(p3))

    def restore(self, text: str) -> str:
        """The text in lower case with every odd place decoded."""
        low = text.lower()
        if not _MAYBE.search(low):
            return low
        out, done = [], 0
        for start, end in odd_places(low):
            out += [low[done:start], self._decoded(low[start:end])]
            done = end
        return "".join([*out, low[done:]])

    def _decoded(self, place: str) -> str:
        found = self.cache.get(place)
        if found is None:
            found = self.decode(place)
            if len(self.cache) < 200_000 and len(place) <= 64:
                self.cache[place] = found
        return found

    def lattice(self, place: str) -> list[list[tuple[str, float]]]:
        """For each step the strings it may be read as, with their price."""
        spaced = re.fullmatch(rf"{_UNIT}(?:[ .\-_*]{_UNIT})+", place) is not None
        out, i = [], 0
        while i < len(place):
            c = place[i]
            n = 1
            while i + n < len(place) and place[i + n] == c:
                n += 1
            if spaced and i % 2:  # a separator
                out.append([("", 0.0)])
                n = 1
            elif c.isalpha():
                if n >= 3:
                    out.append([(c, CHANGE), (c + c, CHANGE), (c * n, CHANGE * n)])
                elif n == 2 and spaced:
                    out.append([(c + c, 0.0)])
                else:
                    out.append([(c * n, 0.0)])
            else:
                reads = [(c * n, CHANGE)] + [(x * m, CHANGE / 2) for x in LOOKS.get(c, "") for m in ({1, min(n, 2)})]
                out.append(reads)
            i += n
        return out

    def decode(self, place: str) -> str:
        """Viterbi path: the most probable reading between blanks. Readings are chains of parts, so steps cost the same anywhere."""
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for step in self.lattice(place):
            new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, before) in states.items():
                for reading, price in step:
                    x, y, total = a, b, cost + price
                    for k in classes_of(reading).tolist() if reading else ():
                        total -= self.log[x, y, k]
                        x, y = y, k
                    old = new.get((x, y))
                    if old is None or total < old[0]:
                        new[(x, y)] = (total, (before, reading))
            states = new
        _, chain = min(((cost - self.log[a, b, 0], chain) for (a, b), (cost, chain) in states.items()), key=lambda x: x[0])
        out = []
        while chain is not None:
            chain, reading = chain
            out.append(reading)
        return "".join(reversed(out))


def features(text: str) -> np.ndarray:
    """Distinct hashes of the words of a restored text and of their beginnings."""
    out = []
    for at in range(0, len(text), 1 << 20):
        stop = at + (1 << 20)
        part = text[max(0, at - 64) : stop]
        cp = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        solid = classes_of(part) != 0
        edge = np.flatnonzero(np.diff(solid, prepend=False, append=False))
        s, e = edge[::2], edge[1::2]
        if not len(s):
            continue
        out.append(span_hashes(cp, s, e))
        for n in PREFIXES:
            long = e - s > n
            out.append(mix(span_hashes(cp, s[long], s[long] + n) + np.uint64(n)))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


@dataclass
class ToxicityModel:
    channel: Channel
    keys: np.ndarray  # sorted feature hashes
    weights: np.ndarray
    bias: float

    def places(self, restored: str) -> np.ndarray:
        f = features(restored)
        at = np.searchsorted(self.keys, f)
        at[at == len(self.keys)] = 0
        return at[self.keys[at] == f] if len(self.keys) else np.zeros(0, np.int64)

    def score(self, text: str | None) -> float:
        z = self.bias + float(self.weights[self.places(self.channel.restore(text or ""))].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def held_out(doc_id: Column) -> Column:
    """Rows never learned from; those without an id are among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _descend(rows: list[tuple[np.ndarray, int]], n: int, rounds: int = 500) -> tuple[np.ndarray, float]:
    """Full-batch gradient descent (with momentum) of a logistic model over present features."""
    y = np.array([t for _, t in rows], np.float64)
    at = np.concatenate([p for p, _ in rows]) if rows else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(rows)), [len(p) for p, _ in rows])
    w, b, vw, vb = np.zeros(n), 0.0, np.zeros(n), 0.0
    if not len(rows) or y.min() == y.max():
        return w, -4.0 if not y.any() else 4.0
    scale = 1 / np.sqrt(np.bincount(at, minlength=n) + 1.0)
    for _ in range(rounds):
        z = b + np.bincount(doc, w[at], len(rows))
        g = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
        gw = np.bincount(at, g[doc], n) * scale + 0.002 * w
        vw, vb = 0.9 * vw - 0.05 * gw, 0.9 * vb - 0.05 * g.sum() / np.sqrt(len(rows))
        w, b = w + vw * scale, b + vb / np.sqrt(len(rows))
    return w, float(b)


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = FIT_ROWS) -> ToxicityModel:
    """Count the language model over all ``docs`` and learn from labelled rows.

    ``docs`` holds doc_id and text. Labelled rows are those whose id is not held out;
    about ``most_rows`` of them, chosen by hashed id, are learned from. A document that
    several label rows disagree about counts as label 1; null labels teach nothing.
    """
    channel = Channel.of(trigram_counts(docs))
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    n = known.count()
    place = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = known.where(place < F.lit(min(1.0, most_rows / max(n, 1))))
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(channel.log)

    def restored(rows):
        c = Channel(shared.value)
        for doc_id, text, toxic in rows:
            yield doc_id, c.restore(text or ""), toxic

    sample = materialize(
        map_rows(docs.join(F.broadcast(materialize(chosen)), "doc_id").select("doc_id", "text", "toxic"), restored,
                 "doc_id long, text string, toxic int")
    )

    def count(rows):
        # features of rows with label 1 and of the others, summed over as many rows as fit
        held, weight = {1: [], 0: []}, 0

        def flush():
            for toxic, found in held.items():
                if found:
                    k, c = np.unique(np.concatenate(found), return_counts=True)
                    yield from zip(k.view(np.int64).tolist(), (c * toxic).tolist(), (c * (1 - toxic)).tolist())
                    found.clear()

        for text, toxic in rows:
            held[toxic].append(features(text))
            weight += len(held[toxic][-1])
            if weight > 2_000_000:
                yield from flush()
                weight = 0
        yield from flush()

    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    counted = (
        map_rows(sample.select("text", F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic")), count, "key long, pos long, neg long")
        .groupBy("key")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where(F.col("pos") >= LEAST_DOCS)
    )
    # how far the share of label 1 among rows with the feature lies above that of all rows, in deviations
    share = pos / max(1, pos + neg)
    rows_with = F.col("pos") + F.col("neg")
    gain = (F.col("pos") - rows_with * share) / F.sqrt(rows_with * max(share * (1 - share), 1e-9))
    best = (
        counted.withColumn("gain", gain)
        .where(F.col("gain") > 3.0)
        .orderBy(F.desc("gain"), "key")
        .limit(MOST_FEATURES)
        .select("key")
        .collect()
    )
    model = ToxicityModel(channel, np.sort(np.array([r["key"] for r in best], np.int64).view(np.uint64)), np.zeros(len(best)), 0.0)
    keys = spark.sparkContext.broadcast(model.keys)

    def present(rows):
        m = ToxicityModel(None, keys.value, None, 0.0)
        for text, toxic in rows:
            yield m.places(text).astype(np.int32).tobytes(), int(toxic > 0)

    seen = map_rows(sample.select("text", "toxic"), present, "places binary, toxic int").collect()  # bounded by most_rows
    rows = sorted((r["places"], r["toxic"]) for r in seen)
    model.weights, model.bias = _descend([(np.frombuffer(bytes(p), np.int32), t) for p, t in rows], len(best))
    return model


def score(docs: DataFrame, model: ToxicityModel, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted (and ``keep``) for every row, from its whole text.

    Missing and empty texts get the score of a text without features; repeated rows get
    equal rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.channel.log, model.keys, model.weights, model.bias)  # bounded by SIZE and MOST_FEATURES
    )

    def run(rows):
        log, keys, weights, bias = shared.value
        m = ToxicityModel(Channel(log), keys, weights, bias)
        for doc_id, out, text, *more in rows:
            s = m.score(text)
            yield doc_id, out, s, int(s >= 0.5), *more

    cols = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text", *keep)
    kinds = dict(docs.dtypes)
    more = "".join(f", {c} {kinds[c]}" for c in keep)
    return map_rows(cols, run, f"doc_id long, held_out boolean, score double, predicted int{more}")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents_of(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
