"""Language identification by averaged hashed subword embeddings.

A text becomes the average of the embeddings of its subwords: the runs of one to four
code points of its lower-case words, with their ends marked, hashed into buckets. A
linear softmax over the average gives the language. Embeddings and weights are learned
together by stochastic gradient descent in numpy, on a bounded sample of labelled rows
per language, each represented by a bounded random draw from the subwords of its whole
text. Two temperatures of calibration follow on rows kept out of the descent: one that
makes probabilities honest, and the confidence below which a prediction is rejected.

Prediction needs one pass over whole texts. As all is linear up to the softmax, each
bucket's embedding times the weights is worked out once, and a text is a sum of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.words import map_rows, mix

BUCKETS = 1 << 16
DIM = 16
GRAMS = (1, 2, 3, 4)
FIT_ROWS = 1500  # labelled rows per language, about
FIT_SUBWORDS = 400  # subwords drawn per row and epoch material
CALIBRATION = 5  # one row in so many of the sample calibrates
ACCEPT = 0.99  # share of right predictions that rejection must let pass
UNDECIDED = "und"
_CHUNK = 1 << 18


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.bool_, 0x110000)


def subwords(text: str, buckets: int = BUCKETS):
    """Bucket numbers of a text's subwords, a chunk of the text at a time."""
    letters = _letters()
    for at in range(0, len(text), _CHUNK):
        low = text[max(0, at - max(GRAMS)) if at else 0 : at + _CHUNK].lower()
        cp = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
        cp = np.where(letters[cp], cp, 32)
        # one blank between words and at both ends
        cp = np.concatenate(([32], cp, [32])).astype(np.uint64)
        cp = cp[(cp != 32) | np.concatenate(([True], cp[:-1] != 32))]
        if len(cp) < 3:
            continue
        out = []
        for n in GRAMS:
            m = len(cp) - n + 1
            if m <= 0:
                continue
            h, inner = np.full(m, n, np.uint64), np.zeros(m, bool)
            for i in range(n):
                h = h * np.uint64(0x100000001B3) + cp[i : m + i]
                if 0 < i < n - 1:
                    inner |= cp[i : m + i] == 32
            solid = ~inner if n > 1 else cp[:m] != 32
            out.append((mix(h[solid]) >> np.uint64(24)) % np.uint64(buckets))
        yield np.concatenate(out).astype(np.int64)


@dataclass
class LanguageModel:
    """Fitted state: one row per bucket of embedding times weights, bias, calibration."""

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, text: str) -> np.ndarray | None:
        """Mean over all subwords of the whole text; None without a letter."""
        total, n = np.zeros(len(self.langs)), 0
        for ids in subwords(text, len(self.table)):
            total += self.table[ids].sum(axis=0, dtype=np.float64)
            n += len(ids)
        return total / n + self.bias if n else None

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Best language, its calibrated probability, and whether it is rejected."""
        z = self.logits(text) if text and self.langs else None
        if z is None:
            return UNDECIDED, 0.0, True
        p = _softmax(z[None] / self.temperature)[0]
        best = int(p.argmax())
        return self.langs[best], float(p[best]), bool(p[best] < self.threshold)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_rows(rows: list[tuple[str, np.ndarray]], epochs: int = 4, rate: float = 0.5, seed: int = 1) -> LanguageModel:
    """Descent on (language, drawn subwords) rows; one row in CALIBRATION is kept for calibration."""
    langs = sorted({lang for lang, _ in rows})
    if not langs:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    number = {lang: i for i, lang in enumerate(langs)}
    rng = np.random.default_rng(seed)
    rows = sorted(rows, key=lambda r: (r[0], r[1].tobytes()))  # the order rows arrive in doesn't matter
    rng.shuffle(rows)
    kept = rows[::CALIBRATION] if len(rows) >= 10 * CALIBRATION else rows
    learn = [r for i, r in enumerate(rows) if i % CALIBRATION] if len(rows) >= 10 * CALIBRATION else rows
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    weights, bias = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    share = np.bincount([number[lang] for lang, _ in learn], minlength=len(langs)) / max(1, len(learn))
    steps, done = epochs * len(learn), 0
    for _ in range(epochs):
        for i in rng.permutation(len(learn)):
            lang, ids = learn[i]
            # a shorter draw now and then, so that short texts are known as well
            ids = ids[rng.integers(0, len(ids), int(rng.choice((16, 64, 256))))]
            x = emb[ids].mean(axis=0)
            p = _softmax((x @ weights + bias)[None])[0]
            p[number[lang]] -= 1
            step = rate * (1 - done / steps) * min(3.0, 1 / (len(langs) * max(1e-6, share[number[lang]])))
            back = weights @ p
            weights -= step * np.outer(x, p)
            bias -= 0.1 * step * p
            np.add.at(emb, ids, -(step / len(ids)) * back.astype(np.float32) * DIM)
            done += 1
    model = LanguageModel(langs, emb @ weights, bias.astype(np.float64))
    z = np.array([model.table[ids].mean(axis=0) + model.bias for _, ids in kept])
    y = np.array([number[lang] for lang, _ in kept])
    grid = np.geomspace(0.02, 20, 61)
    loss = [-np.log(np.maximum(_softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    p = _softmax(z / model.temperature)
    right = p.argmax(axis=1) == y
    if right.any():
        model.threshold = float(np.quantile(p.max(axis=1)[right], 1 - ACCEPT))
    return model


def fit(docs: DataFrame, rows_per_lang: int = FIT_ROWS, draws: int = FIT_SUBWORDS) -> LanguageModel:
    """Fit on about ``rows_per_lang`` rows of each language, chosen by hashed doc_id.

    ``docs`` holds doc_id, text, lang; rows without lang or without a letter teach
    nothing. Only ``draws`` bucket numbers per chosen row reach the driver.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return fit_rows([])
    spark = docs.sparkSession
    rates = spark.createDataFrame([(k, min(1.0, rows_per_lang / n)) for k, n in counts.items()], "lang string, rate double")
    place = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = known.join(F.broadcast(rates), "lang").where(place < F.col("rate")).select("doc_id", "lang", "text")

    def draw(rows):
        for doc_id, lang, text in rows:
            found = list(subwords(text))
            if found:
                ids = np.concatenate(found)
                rng = np.random.default_rng(abs(doc_id or 0))
                yield lang, ids[rng.integers(0, len(ids), draws)].astype(np.int32).tobytes()

    drawn = map_rows(chosen, draw, "lang string, ids binary").collect()  # bounded by rows_per_lang and draws
    return fit_rows([(r["lang"], np.frombuffer(r["ids"], np.int32)) for r in drawn])


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row, from its whole text alone.

    A missing text, or one without a letter, gives ``und`` with score 0. ``rejected``
    marks predictions below the calibrated confidence. Repeated rows give equal rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages numbers

    def run(rows):
        m = shared.value
        for doc_id, text, held_out in rows:
            lang, score, rejected = m.predict(text)
            yield doc_id, held_out, lang, min(1.0, score), rejected

    cols = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return map_rows(cols, run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def held_out(doc_id: Column) -> Column:
    """Rows never learned from; those without an id are among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from holdfast.llm.words import documents_of

    docs = documents_of(spark.read.parquet(f"{sf_dir}/documents.parquet"), "lang")
    return predict(docs, fit(docs.where(~held_out(F.col("doc_id")))))
