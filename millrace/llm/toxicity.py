"""Toxicity by multiple-instance learning: documents carry the labels, sentences the scores.

A sentence's probability is a logistic function of its hashed words and word beginnings; a document
is toxic if any sentence is: 1 - prod(1 - p). The weights are fitted on document labels through that
product (noisy-or), with an L1 penalty, on a bounded sample; samples of both labels are weighted
back to their shares among all rows that may be learned from. The same sentence scores then point
at the offending sentences.

A null or empty text has no sentence and score 0. A sentence ends at ``.``, ``!``, ``?`` or a line end.
Rows without a label teach nothing; without any label of one kind every score is 0. Repeated rows get
a row each; a null id is passed on. Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.sampling import bounded_sample, sample_table
from millrace.llm.textkit import map_texts, mixed, runs, span_hashes, text_buffers, word_spans

BUCKETS = 1 << 18
#: Word beginnings, in bytes, that are features besides the whole word.
PREFIXES = (4, 5, 7)
#: Most documents of each label to learn from, and most characters of them all.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 1500, 3000, 7_000_000
#: A feature has to stand in so many documents of the sample.
LEAST_DOCS = 5
THRESHOLD = 0.7

# Words here are runs of letters; every byte beyond ASCII counts as one.
_NOT_WORD = np.ones(256, bool)
_NOT_WORD[0x80:] = False
_NOT_WORD[65:91] = _NOT_WORD[97:123] = False
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n")] = True


def sentence_features(data: np.ndarray, offsets: np.ndarray):
    """Features of each word (a row of buckets), its sentence's number, the row of each sentence,
    and the byte at which each sentence's first word begins."""
    starts, ends, bounds = word_spans(data, offsets, _NOT_WORD)
    low, n = int(offsets[0]), len(starts)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros((0, len(PREFIXES) + 1), np.int64), none, none, none
    out = np.empty((n, len(PREFIXES) + 1), np.int64)
    out[:, 0] = (span_hashes(data, starts, ends, lower=True) >> np.uint64(46)).astype(np.int64)
    body = np.concatenate([data[low : offsets[-1]], np.zeros(8, np.uint8)])
    first = np.zeros(n, np.uint64)
    for k in range(8):
        # Folds ASCII case; beyond ASCII it also joins a few letters.
        byte = body[starts - low + k] | np.uint8(0x20)
        byte[starts + k >= ends] = 0
        first |= byte.astype(np.uint64) << np.uint64(8 * k)
    for column, k in enumerate(PREFIXES, 1):
        part = first & np.uint64((1 << (8 * k)) - 1)
        out[:, column] = (mixed(part + np.uint64(k << 58)) >> np.uint64(46)).astype(np.int64)
    stops = np.flatnonzero(_ENDS[body[:-8]])
    row = np.searchsorted(bounds, np.arange(n), "right") - 1
    segment = np.searchsorted(stops, starts - low)
    new = np.ones(n, bool)
    new[1:] = (segment[1:] != segment[:-1]) | (row[1:] != row[:-1])
    return out, np.cumsum(new) - 1, row[new], starts[new]


def noisy_or(sentence_scores: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """1 - prod(1 - p) over the sentences of each of ``n`` rows."""
    return -np.expm1(-np.bincount(rows, np.logaddexp(0, sentence_scores), minlength=n)[:n])


@dataclass
class ToxicityModel:
    weights: np.ndarray
    constant: float

    def sentences(self, data: np.ndarray, offsets: np.ndarray):
        """The log odds of each sentence, its row, and its first byte."""
        buckets, sentence, rows, at = sentence_features(data, offsets)
        total = np.bincount(sentence, self.weights[buckets].sum(axis=1), minlength=len(rows))
        return total + self.constant, rows, at

    def documents(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        scores, rows, _ = self.sentences(data, offsets)
        return noisy_or(scores, rows, len(offsets) - 1)


def fit_noisy_or(
    texts: list[str], labels: np.ndarray, document_weights: np.ndarray, l1: float = 0.4, steps: int = 300
) -> ToxicityModel:
    """Fit on document labels by proximal gradient steps scaled per feature (RMS of past gradients)."""
    data, offsets = text_buffers(pa.array(texts, pa.large_string()))
    features, sentences, documents, n_sentences = [], [], [], 0
    in_docs = np.zeros(BUCKETS, np.int32)
    for a, b in runs(offsets, 1 << 19):
        buckets, of, rows, _ = sentence_features(data, offsets[a : b + 1])
        # A feature counts once per sentence; rare features are left out below.
        pairs = np.unique((np.repeat(of, buckets.shape[1]) << 18) | buckets.ravel())
        sentence, feature = pairs >> 18, pairs & (BUCKETS - 1)
        once = np.unique((rows[sentence] << 18) | feature) & (BUCKETS - 1)
        in_docs += np.bincount(once, minlength=BUCKETS).astype(np.int32)
        features.append(feature.astype(np.int32))
        sentences.append((sentence + n_sentences).astype(np.int32))
        documents.append((rows + a).astype(np.int32))
        n_sentences += len(rows)
    feature, sentence, document = map(np.concatenate, (features, sentences, documents))
    keep = (in_docs >= LEAST_DOCS)[feature]
    sentence, feature = sentence[keep], feature[keep]
    del features, sentences, documents, keep
    used, feature = np.unique(feature, return_inverse=True)

    y, c = labels.astype(bool), document_weights
    w, constant = np.zeros(len(used)), -6.0
    square, square0 = np.zeros(len(used)), 0.0
    toxic, share = y[document], c[document]
    for step in range(steps):
        z = np.bincount(sentence, w[feature], minlength=n_sentences) + constant
        p = 1 / (1 + np.exp(-z))
        whole = np.maximum(noisy_or(z, document, len(y)), 1e-9)[document]
        g = share * np.where(toxic, -p * (1 - whole) / whole, p)
        gradient, g0 = np.bincount(feature, g[sentence], minlength=len(used)), g.sum()
        square = 0.9 * square + 0.1 * gradient**2
        square0 = 0.9 * square0 + 0.1 * g0**2
        rate = 0.3 / (1 + step / 40)
        scale = rate / (np.sqrt(square) + 1.0)
        w -= scale * gradient
        w = np.sign(w) * np.maximum(np.abs(w) - scale * l1, 0)
        constant -= 0.3 * rate * g0 / (np.sqrt(square0) + 1e-3)
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = w
    return ToxicityModel(weights, float(constant))


def fit_toxicity_model(docs: DataFrame, labels: DataFrame, may_learn: Column, label: str = "toxic") -> ToxicityModel:
    """Learn from the rows of ``labels`` (``doc_id`` and a 0/1 label) where ``may_learn`` holds.

    Takes at most ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` documents, in hash order, and of those as
    many whole ones as stay within ``SAMPLE_CHARS`` characters.
    """
    known = labels.where(may_learn & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    known = known.select("doc_id", F.col(label).cast("int").alias("__y"))
    totals = dict(known.groupBy("__y").count().collect())
    none = ToxicityModel(np.zeros(BUCKETS, np.float32), -50.0)
    if not totals.get(0) or not totals.get(1):
        return none
    named = bounded_sample(known.where("__y = 1"), "doc_id", "__y", SAMPLE_TOXIC).unionByName(
        bounded_sample(known.where("__y = 0"), "doc_id", "__y", SAMPLE_CLEAN)
    )
    table = sample_table(docs, named, SAMPLE_TOXIC + SAMPLE_CLEAN, SAMPLE_CHARS)
    if not table.num_rows:
        return none
    y = np.asarray(table["__y"].to_pylist())
    if y.min() == y.max():
        return none
    # Each label's documents stand for all documents of that label.
    weight = np.where(y == 1, totals[1] / max(1, (y == 1).sum()), totals[0] / max(1, (y == 0).sum()))
    weight = weight / weight[y == 1].mean()
    return fit_noisy_or(table["text"].to_pylist(), y, weight)


def _score(model: ToxicityModel, threshold: float):
    def task(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            parts = [model.documents(data, offsets[a : b + 1]) for a, b in runs(offsets, 1 << 20)]
            scores = np.clip(np.concatenate(parts), 0.0, 1.0) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), pa.array(scores),
                    pa.array((scores >= threshold).astype(np.int32)),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return task


def score_toxicity(docs: DataFrame, model: ToxicityModel, held_out: Column, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; one pass, no shuffle."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", held_out.alias("held_out"))
    return map_texts(rows, _score(model, threshold), "doc_id long, held_out boolean, score double, predicted int")


def _locate(model: ToxicityModel, threshold: float):
    def task(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            ids = batch.column(0).to_pylist()
            out: list[tuple] = []
            for a, b in runs(offsets, 1 << 20):
                scores, rows, at = model.sentences(data, offsets[a : b + 1])
                for k in np.flatnonzero(scores >= np.log(threshold / (1 - threshold))).tolist():
                    first, last = int(at[k]), int(offsets[a + rows[k] + 1])
                    same = k + 1 < len(rows) and rows[k + 1] == rows[k]
                    text = data[first : int(at[k + 1]) if same else last].tobytes().decode("utf-8", "replace")
                    out.append((ids[a + rows[k]], float(1 / (1 + np.exp(-scores[k]))), text.rstrip()))
            columns = list(zip(*out)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.string())],
                ["doc_id", "score", "sentence"],
            )

    return task


def toxic_sentences(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """``doc_id, score, sentence`` of each sentence that scores ``threshold`` or more."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return map_texts(rows, _locate(model, threshold), "doc_id long, score double, sentence string")
