"""A quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on each document. How often each is
right is not known: expectation-maximisation estimates it, and the share of good documents, from
how the votes agree, over the counts of all vote patterns of the whole table (a few thousand patterns at
most). The posterior of a pattern then is the soft label for a linear scorer on hashed words, fitted
on a bounded sample and applied to every text.

A null text, or one without a word, has score 0 and is not kept. Repeated rows get a row each, a null
id is passed on. With an empty table, or without votes, all scores come from the prior. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.quality_rules import MEASURES, measured
from millrace.llm.sampling import bounded_sample, sample_table
from millrace.llm.textkit import map_texts, mixed, runs, span_hashes, text_buffers, word_spans
from millrace.session import written

BUCKETS = 1 << 16
#: Most documents of each weak label to fit on, and most characters of them all.
SAMPLE_EACH, SAMPLE_CHARS = 2000, 7_000_000
LEAST_DOCS = 5
THRESHOLD = 0.5
BAD, GOOD, NONE = 0, 1, 2

_AT = {name: k for k, name in enumerate(MEASURES)}
LABELLERS = ("symbols", "upper_case", "same_word", "repeated_words", "letters", "word_length", "repeated_lines")


def votes(measures: np.ndarray, same_as_previous: np.ndarray) -> np.ndarray:
    """The vote of each labeller (a column) on each document (a row)."""
    m = {name: measures[:, k] for name, k in _AT.items()}
    n, letters = m["n_words"], m["n_letters"]
    some = n >= 20
    cases = {
        "symbols": (100 * m["n_symbols"] > 30 * n, 100 * m["n_symbols"] <= 3 * n),
        "upper_case": ((letters >= 30) & (2 * m["n_upper"] > letters), 4 * m["n_upper"] <= letters + 3),
        "same_word": (some & (100 * same_as_previous > 30 * n), 100 * same_as_previous <= 5 * n),
        "repeated_words": (some & (100 * m["n_repeat_words"] > 30 * n), 100 * m["n_repeat_words"] <= 20 * n),
        "letters": (
            (n >= 10) & (100 * letters < 80 * m["word_chars"]),
            (100 * letters >= 88 * m["word_chars"]) | ((n < 80) & (100 * letters >= 60 * m["word_chars"])),
        ),
        "word_length": (
            (m["word_chars"] < 3 * n) | (m["word_chars"] > 10 * n),
            (m["word_chars"] >= 3 * n) & (m["word_chars"] <= 8 * n),
        ),
        "repeated_lines": (2 * m["n_dup_lines"] > m["n_lines"], 2 * m["n_dup_lines"] <= m["n_lines"]),
    }
    out = np.full((len(n), len(LABELLERS)), NONE, np.int64)
    for k, name in enumerate(LABELLERS):
        bad, good = cases[name]
        out[good, k] = GOOD
        out[bad, k] = BAD
    out[n == 0] = NONE
    return out


def pattern_codes(v: np.ndarray) -> np.ndarray:
    return (v * 3 ** np.arange(v.shape[1])).sum(axis=1)


def pattern_votes(code: int) -> list[int]:
    return [code // 3**k % 3 for k in range(len(LABELLERS))]


@dataclass
class LabelModel:
    """The share of good documents, and how likely each vote of each labeller is in either class."""

    prior: float = 0.8
    #: [class, labeller, vote]; an abstention is a vote of its own kind.
    rates: np.ndarray = field(default_factory=lambda: np.full((2, len(LABELLERS), 3), 1 / 3))

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """The probability of good for rows of votes."""
        ratio = np.log(self.rates[GOOD] / self.rates[BAD])
        odds = np.log(self.prior / (1 - self.prior)) + ratio[np.arange(len(LABELLERS)), patterns].sum(axis=1)
        return 1 / (1 + np.exp(-odds))

    def accuracy(self) -> np.ndarray:
        """How often each labeller is right where it votes."""
        share = np.array([1 - self.prior, self.prior])[:, None]
        cast = (share * (self.rates[:, :, BAD] + self.rates[:, :, GOOD])).sum(axis=0)
        right = share[BAD, 0] * self.rates[BAD, :, BAD] + share[GOOD, 0] * self.rates[GOOD, :, GOOD]
        return right / cast


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 300) -> LabelModel:
    """EM over distinct vote patterns and their counts.

    It starts from the plain reading of the votes (one bad vote makes a document doubtful), which
    also fixes which class is called good.
    """
    model = LabelModel()
    if not len(patterns) or not counts.sum():
        return model
    q = np.where((patterns == BAD).any(axis=1), 0.1, 0.95)
    for _ in range(rounds):
        for c, weight in ((BAD, counts * (1 - q)), (GOOD, counts * q)):
            for v in (BAD, GOOD, NONE):
                model.rates[c, :, v] = (weight[:, None] * (patterns == v)).sum(axis=0) + 0.5
            model.rates[c] /= model.rates[c].sum(axis=1, keepdims=True)
        model.prior = float(np.clip((counts * q).sum() / counts.sum(), 0.01, 0.99))
        before, q = q, model.posterior(patterns)
        if np.abs(q - before).max() < 1e-9:
            break
    return model


def word_features(data: np.ndarray, offsets: np.ndarray):
    """Feature buckets of each word (a row) and the n + 1 word numbers at which the texts begin."""
    starts, ends, bounds = word_spans(data, offsets)
    hashes = span_hashes(data, starts, ends, lower=True)
    if not len(starts):
        return np.zeros((0, 4), np.int64), bounds
    first, last, n = data[starts], data[ends - 1], ends - starts
    upper = (first >= 65) & (first <= 90) & (last >= 65) & (last <= 90)
    same = np.zeros(len(starts), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[bounds[:-1][bounds[:-1] < len(starts)]] = False
    parts = (
        hashes,
        last.astype(np.uint64) + np.uint64(1 << 20),
        data[np.maximum(ends - 2, starts)].astype(np.uint64) * np.uint64(256) + last + np.uint64(1 << 21),
        np.minimum(n, 30).astype(np.uint64) * np.uint64(4) + upper * np.uint64(2) + same + np.uint64(1 << 22),
    )
    return np.stack([(mixed(p) >> np.uint64(48)).astype(np.int64) for p in parts], axis=1), bounds


@dataclass
class QualityModel:
    labels: LabelModel
    weights: np.ndarray
    constant: float

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        buckets, bounds = word_features(data, offsets)
        n = len(offsets) - 1
        sizes = np.diff(bounds)
        sums = np.bincount(np.repeat(np.arange(n), sizes), self.weights[buckets].sum(axis=1), minlength=n)
        score = 1 / (1 + np.exp(-(self.constant + sums / np.maximum(sizes, 1))))
        return np.where(sizes > 0, score, 0.0)


def fit_scorer(texts: list[str], soft: np.ndarray, l2: float = 1e-4, steps: int = 300):
    """Logistic regression of soft labels on the mean of hashed word features."""
    data, offsets = text_buffers(pa.array(texts, pa.large_string()))
    rows, features, values = [], [], []
    for a, b in runs(offsets):
        buckets, bounds = word_features(data, offsets[a : b + 1])
        sizes = np.diff(bounds)
        row = np.repeat(np.arange(a, b), sizes)
        key, count = np.unique((np.repeat(row, buckets.shape[1]) << 16) | buckets.ravel(), return_counts=True)
        rows.append(key >> 16)
        features.append(key & (BUCKETS - 1))
        values.append(count / np.maximum(sizes, 1)[(key >> 16) - a])
    row, feature, value = map(np.concatenate, (rows, features, values))
    keep = (np.bincount(feature, minlength=BUCKETS) >= LEAST_DOCS)[feature]
    row, feature, value = row[keep], feature[keep], value[keep]
    used, feature = np.unique(feature, return_inverse=True)
    w, constant, square, square0 = np.zeros(len(used)), 0.0, np.zeros(len(used)), 0.0
    for step in range(steps):
        z = np.bincount(row, w[feature] * value, minlength=len(soft)) + constant
        error = (1 / (1 + np.exp(-z)) - soft) / len(soft)
        gradient = np.bincount(feature, error[row] * value, minlength=len(used)) + l2 * w / len(soft)
        square += gradient**2
        square0 += error.sum() ** 2
        w -= 0.5 * gradient / (np.sqrt(square) + 1e-9)
        constant -= 0.1 * error.sum() / (np.sqrt(square0) + 1e-9)
    weights = np.zeros(BUCKETS)
    weights[used] = w
    return weights, float(constant)


def _patterns(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vote pattern and number of words of each text."""
    starts, ends, bounds = word_spans(data, offsets)
    hashes = span_hashes(data, starts, ends, lower=True)
    same = np.zeros(len(hashes) + 1, np.int64)
    same[1:-1] = hashes[1:] == hashes[:-1] if len(hashes) else 0
    inner = bounds[1:-1]
    same[inner[inner < len(hashes)]] = 0  # the first word of a text has none before it
    total = np.concatenate([[0], np.cumsum(same[: len(hashes)])])
    measures = measured(data, offsets)
    return pattern_codes(votes(measures, total[bounds[1:]] - total[bounds[:-1]])), measures[:, 0]


def _vote(batches):
    for batch in batches:
        data, offsets = text_buffers(batch.column(1))
        parts = [_patterns(data, offsets[a : b + 1])[0] for a, b in runs(offsets)]
        if parts:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts))], ["doc_id", "pattern"])


def fit_quality_model(docs: DataFrame) -> QualityModel:
    """Votes on every row of ``docs``, the label model over all of them, and the scorer on a sample."""
    voted = written(map_texts(docs.select(F.col("doc_id").cast("long"), "text"), _vote, "doc_id long, pattern long"), "votes")
    found = voted.groupBy("pattern").count().toArrow()
    codes = found["pattern"].to_pylist()
    patterns = np.array([pattern_votes(c) for c in codes], np.int64).reshape(-1, len(LABELLERS))
    labels = fit_label_model(patterns, np.array(found["count"].to_pylist(), float))
    soft = labels.posterior(patterns)
    model = QualityModel(labels, np.zeros(BUCKETS), float(np.log(labels.prior / (1 - labels.prior))))
    if not codes:
        return model
    good = [c for c, q in zip(codes, soft.tolist()) if q >= 0.5]
    weak = voted.where(F.col("doc_id").isNotNull()).withColumn("good", F.col("pattern").isin(good))
    named = bounded_sample(weak, "doc_id", "good", SAMPLE_EACH)
    table = sample_table(docs, named, 2 * SAMPLE_EACH, SAMPLE_CHARS)
    if table.num_rows:
        by_code = dict(zip(codes, soft.tolist()))
        targets = np.array([by_code[c] for c in table["pattern"].to_pylist()])
        model.weights, model.constant = fit_scorer(table["text"].to_pylist(), targets)
    return model


def _judge(model: QualityModel, threshold: float):
    def task(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            parts = []
            for a, b in runs(offsets):
                codes, words = _patterns(data, offsets[a : b + 1])
                distinct, back = np.unique(codes, return_inverse=True)
                weak = model.labels.posterior(np.array([pattern_votes(c) for c in distinct.tolist()]))[back]
                parts.append((words, codes, weak, model.score(data, offsets[a : b + 1])))
            if parts:
                words, codes, weak, score = map(np.concatenate, zip(*parts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *map(pa.array, (words, codes, weak, score, score >= threshold))],
                    ["doc_id", "n_words", "pattern", "weak_good", "score", "kept"],
                )

    return task


def judge_quality(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, n_words, pattern, weak_good, score, kept`` of every row; one pass, no shuffle."""
    schema = "doc_id long, n_words long, pattern long, weak_good double, score double, kept boolean"
    return map_texts(docs.select(F.col("doc_id").cast("long"), "text"), _judge(model, threshold), schema)


def _keep(model: QualityModel, threshold: float, at: int):
    def task(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(at))
            parts = [model.score(data, offsets[a : b + 1]) for a, b in runs(offsets)]
            if parts:
                yield batch.filter(pa.array(np.concatenate(parts) >= threshold))

    return task


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``judge_quality`` keeps; one pass, no join."""
    return map_texts(docs, _keep(model, threshold, docs.columns.index("text")), docs.schema)
