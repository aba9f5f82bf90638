"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of 1 to 3 code points of the lower-cased text, digits and ASCII
punctuation read as blanks, weighted by count times inverse document frequency and scaled to unit
length. Document frequencies are counted over all rows that may be learned from. Weights are
trained on a bounded sample by follow-the-regularised-leader with an L1 and an L2 penalty; a part of the
sample held back from that sets the temperature of the probabilities.

A null text, or one without a letter, is ``und`` with score 0. Rows with a null language teach
nothing. If nothing can be learned, all rows are ``und``. Repeated rows get a row each, a null
id is passed on (and can't be learned from). Only the columns named are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.sampling import bounded_sample, texts_of
from millrace.llm.textkit import map_texts

UNKNOWN = "und"
BUCKETS = 1 << 13
ORDERS = (1, 2, 3)
#: Rows that may be learned from, over all languages.
SAMPLE_ROWS = 6000
_RUN = 1 << 20
_LATIN = re.compile("[A-Za-z]")
_FOLD = np.arange(128, dtype=np.uint32)
_FOLD[[c for c in range(128) if not chr(c).isalpha()]] = 32
_BLANK = np.uint32(32)


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint32(16))
    x = x * np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def folded_points(text: str) -> np.ndarray:
    """Code points of a text in lower case between blanks; ASCII that is no letter counts as a blank."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _FOLD[np.minimum(points, 127)], points)


def gram_buckets(points: np.ndarray, n: int) -> np.ndarray:
    """The hashed n-grams of some code points, one entry per occurrence; n-grams of blanks only are left out."""
    size = max(0, len(points) - n + 1)
    grams = points[:size].copy()
    full = grams != _BLANK
    for k in range(1, n):
        following = points[k : size + k]
        grams *= np.uint32(0x01000193)
        grams += following
        full |= following != _BLANK
    grams = _scrambled(grams + np.uint32(n * 0x9E3779B9 & 0xFFFFFFFF))
    return (grams & np.uint32(BUCKETS - 1))[full]


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and how often each occurs, counted in runs that overlap so that no n-gram is cut."""
    counts, points = np.zeros(BUCKETS, np.int64), folded_points(text)
    for a in range(0, len(points), _RUN):
        for n in ORDERS:
            counts += np.bincount(gram_buckets(points[a : a + _RUN + n - 1], n), minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def has_letter(text: str) -> bool:
    """Whether a character of the general category of letters is in the text."""
    return _LATIN.search(text) is not None or any(map(str.isalpha, text))


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets + 1 rows, the last is the constant; a column per language
    temperature: float = 1.0

    def features(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = counts * self.idf[found]
        return x / max(np.sqrt(np.dot(x, x)), 1e-12)

    def scores(self, found: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[found] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        found, counts = gram_counts(text)
        p = softmax(self.scores(found, self.features(found, counts)) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(
    examples: list[tuple[np.ndarray, np.ndarray, int]], classes: int, alpha: float = 0.5, beta: float = 1.0,
    l1: float = 0.02, l2: float = 0.05, passes: int = 3,
) -> np.ndarray:
    """Weights of a multinomial regression by FTRL-proximal; ``examples`` are (buckets, values, class)."""
    z = np.zeros((BUCKETS + 1, classes))
    n = np.zeros((BUCKETS + 1, classes))

    def weights(rows):
        grown = np.sign(z[rows]) * l1 - z[rows]
        return np.where(np.abs(z[rows]) <= l1, 0.0, grown / ((beta + np.sqrt(n[rows])) / alpha + l2))

    for _ in range(passes):
        for found, x, target in examples:
            rows, values = np.append(found, BUCKETS), np.append(x, 1.0)
            w = weights(rows)
            error = softmax(values @ w)
            error[target] -= 1.0
            g = np.outer(values, error)
            before = n[rows]
            after = before + g * g
            z[rows] += g - (np.sqrt(after) - np.sqrt(before)) / alpha * w
            n[rows] = after
    return weights(slice(None))


def fit_temperature(scores: np.ndarray, targets: np.ndarray) -> float:
    """The temperature with the smallest log loss, by golden-section search over its logarithm."""
    if not len(targets):
        return 1.0

    def loss(t: float) -> float:
        p = softmax(scores / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(targets)), targets], 1e-12)).mean()

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _frequencies(batches):
    """Documents per bucket in the rows of this task; bucket -1 counts the documents."""
    seen, rows = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                seen[gram_counts(text)[0]] += 1
            rows += 1
    found = np.flatnonzero(seen)
    buckets, counts = np.append(found, -1), np.append(seen[found], rows)
    yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(counts)], ["bucket", "n"])


def _sparse(batches):
    for batch in batches:
        found = [gram_counts(t or "") for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(2),
                pa.array([f.tolist() for f, _ in found], pa.list_(pa.int32())),
                pa.array([c.tolist() for _, c in found], pa.list_(pa.int32())),
            ],
            ["doc_id", "lang", "found", "counts"],
        )


def fit_language_model(
    docs: DataFrame, may_learn: Column, sample_rows: int = SAMPLE_ROWS, lang: str = "lang"
) -> LanguageModel:
    """Learn from ``text`` and ``lang`` of the rows of ``docs`` where ``may_learn`` holds."""
    labelled = docs.where(may_learn & F.col(lang).isNotNull() & F.col("text").isNotNull())
    languages = sorted(r[0] for r in labelled.select(lang).distinct().collect())
    if not languages:
        return LanguageModel([], np.zeros(BUCKETS), np.zeros((BUCKETS + 1, 0)))
    summed = (
        map_texts(labelled.select("text"), _frequencies, "bucket long, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    )
    by_bucket = dict(zip(summed["bucket"].to_pylist(), summed["n"].to_pylist()))
    rows = by_bucket.pop(-1)
    idf = np.full(BUCKETS, np.log1p(rows))
    for bucket, n in by_bucket.items():
        idf[bucket] = np.log((1 + rows) / (1 + n)) + 1.0

    each = max(20, sample_rows // len(languages))
    named = bounded_sample(labelled.select("doc_id", F.col(lang).alias("__lang")), "doc_id", "__lang", each)
    texts = texts_of(labelled.select("doc_id", "text"), named, each * len(languages))
    sample = map_texts(texts, _sparse, "doc_id long, lang string, found array<int>, counts array<int>")
    sample = sample.toArrow().to_pandas()
    sample = sample.sort_values(["doc_id", "lang"], kind="stable").reset_index(drop=True)
    sample = sample.sample(frac=1.0, random_state=3).reset_index(drop=True)

    model = LanguageModel(languages, idf, np.zeros((BUCKETS + 1, len(languages))))
    number = {name: k for k, name in enumerate(languages)}
    examples = []
    for found, counts, name in zip(sample["found"], sample["counts"], sample["lang"]):
        found, counts = np.asarray(found, np.int64), np.asarray(counts, np.float64)
        examples.append((found, model.features(found, counts), number[name]))
    held_back = examples[::5] if len(examples) >= 50 else []
    train = [e for k, e in enumerate(examples) if k % 5] if held_back else examples
    model.weights = fit_ftrl(train, len(languages))
    if held_back:
        scores = np.array([model.scores(found, x) for found, x, _ in held_back])
        model.temperature = fit_temperature(scores, np.array([e[2] for e in held_back]))
    return model


def _predict(model: LanguageModel):
    def task(batches):
        for batch in batches:
            found = [model.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2),
                    pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return task


def identify_language(docs: DataFrame, model: LanguageModel, held_out: Column) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row; one pass, no shuffle."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", held_out.alias("held_out"))
    return map_texts(rows, _predict(model), "doc_id long, held_out boolean, lang_pred string, score double")
