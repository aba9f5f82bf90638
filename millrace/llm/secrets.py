"""Secret scans: candidate strings judged by a random forest.

Candidates are runs of 16 or more token characters with a digit, runs of 20 or more without one, and
values assigned to a credential word. An assigned value is one candidate from its first to its last
character, whatever marks and runs are in it; so is a web token of up to three parts. In quotes it ends at the
same quote; else at a blank or quote, before closing marks, at the next name=value after ; or , and in the query of an
address at the next &. A forest (Spark ML) trained on labelled findings removes
the false positives. Its features are length, character classes and transitions between them, how likely the
character sequence is in the corpus, how much of it dictionary words cover, the path, and the words
around it. The dictionary (its most frequent words) and the sequence counts come from the whole
corpus.

Labelled findings can be given. Without them, findings are labelled where the evidence is plain: a known key
format or a random value assigned to a credential word is a secret; plain words, numbers, digests
named as such and placeholders are not; all else is left to the forest. Training takes a bounded
sample. With findings of one kind only there is no forest, and the evidence decides.

Null and empty texts have no candidates. Repeated rows are scanned each; a null id is passed on. A
missing or null path is no path. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.sampling import bounded_sample
from millrace.llm.textkit import map_texts, runs, text_buffers, unused, word_spans
from millrace.session import scratch_path, written

#: Words of 3 to 8 letters the dictionary holds.
DICTIONARY_WORDS = 20_000
#: Findings of each kind to train on.
SAMPLE_EACH = 3000
TREES, DEPTH, SEED = 40, 8, 17
THRESHOLD = 0.5
_FLUSH = 1 << 19

_KEYWORDS = r"api[_-]?key|access[_-]?key|auth[_-]?token|client[_-]?secret|passphrase|password|passwd|pwd|secret|token|credential"
_ASSIGNED = re.compile(
    rf"(?i)(?:{_KEYWORDS})[\"']?\s*(?::=|=>|[:=])\s*"
    r"(?:\"((?:\\\S|[^\s\"\\]){6,})(?=\")|'((?:\\\S|[^\s'\\]){6,})(?=')|`((?:\\\S|[^\s`\\]){6,})(?=`)|[\"'`]?([^\s\"'`]{6,}))"
)
#: What follows a value that is not in quotes: the next pair, in general and in the query of an address.
_NEXT_PAIR = re.compile(r"[;,][A-Za-z][\w.-]*=")
_IN_QUERY = re.compile(r"[?&][\w.-]*$")
_CLOSING = ".,;:!?)]}>*|"
_WEB_TOKEN = re.compile(r"eyJ[A-Za-z0-9_-]{10,}(?:\.[A-Za-z0-9_-]+){1,2}")
_BEFORE = re.compile(rf"(?i)(?:{_KEYWORDS})[\"']?\s*(?::=|=>|[:=])\s*[\"'`]?$")
_NEAR = re.compile(rf"(?i){_KEYWORDS}|bearer|private|login")
_FORMATS = re.compile(
    r"(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{30,}"
    r"|sk[-_](?:live|test|proj)?[-_]?[A-Za-z0-9]{20,}|glpat-[A-Za-z0-9_-]{16,}|eyJ[A-Za-z0-9_-]{10,}(?:\.[A-Za-z0-9_-]+){0,2}"
)
_DIGEST = re.compile(r"(?i)\b(?:hash|commit|sha-?\d*|md5|checksum|digest|revision|rev|etag|uuid|guid|id)\W*$")
_PLACEHOLDER = re.compile(r"(?i)example|sample|dummy|change.?me|placeholder|your|x{4,}|\*{3,}|0{8,}|1234567|redacted|<|\$\{")
_UUID = re.compile(r"(?i)[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}")
_TEST_PATH = re.compile(r"(?i)test|example|sample|mock|fixture|doc|demo")

_NOT_TOKEN = np.ones(256, bool)
_NOT_TOKEN[list(b"+/_-")] = False
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_NOT_LETTER = np.ones(256, bool)
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _NOT_TOKEN[_a:_b] = False
_NOT_LETTER[65:91] = _NOT_LETTER[97:123] = False
# Character classes for transitions: letters by themselves, digits together, a few marks, all else.
CLASSES = 58
_CLASS = np.full(256, 57, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = np.arange(26), np.arange(26, 52), 52
for _k, _c in enumerate(b"_-/+", 53):
    _CLASS[_c] = _k

CANDIDATES = (
    "doc_id long, start long, length long, evidence int, features array<double>, mark string"
)


@dataclass
class CorpusStatistics:
    words: frozenset[str] = frozenset()
    #: log probability of a class after a class.
    transitions: np.ndarray = field(default_factory=lambda: np.full((CLASSES, CLASSES), -math.log(CLASSES)))


def _count(batches):
    words, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.zeros(CLASSES * CLASSES, np.int64)

    def rows(keys, n, kind):
        kinds = pa.array(np.full(len(keys), kind, np.int32))
        return pa.RecordBatch.from_arrays([kinds, pa.array(keys), pa.array(n)], ["kind", "key", "n"])

    for batch in batches:
        data, offsets = text_buffers(batch.column(0))
        for a, b in runs(offsets, 1 << 20):
            body = data[offsets[a] : offsets[b]]
            classes = _CLASS[body]
            both = classes[:-1] * CLASSES + classes[1:]
            pairs += np.bincount(both, minlength=CLASSES * CLASSES)
            # Not those from one text to the next.
            over = np.unique(offsets[a + 1 : b]) - offsets[a] - 1
            over = over[(over >= 0) & (over < len(both))]
            pairs -= np.bincount(both[over], minlength=CLASSES * CLASSES)
            starts, ends, _ = word_spans(data, offsets[a : b + 1], _NOT_LETTER)
            keep = (ends - starts >= 3) & (ends - starts <= 8)
            starts, ends = starts[keep], ends[keep]
            padded = np.concatenate([body, np.zeros(8, np.uint8)])
            packed = np.zeros(len(starts), np.int64)
            for k in range(8):
                byte = padded[starts - offsets[a] + k] | np.uint8(0x20)
                byte[starts + k >= ends] = 0
                packed |= byte.astype(np.int64) << (8 * k)
            found, n = np.unique(packed, return_counts=True)
            words, back = np.unique(np.concatenate([words, found]), return_inverse=True)
            counts = np.bincount(back, np.concatenate([counts, n]), minlength=len(words)).astype(np.int64)
            if len(words) > _FLUSH:
                yield rows(words, counts, 0)
                words, counts = words[:0], counts[:0]
    if len(words):
        yield rows(words, counts, 0)
    yield rows(np.arange(len(pairs)), pairs, 1)


def corpus_statistics(docs: DataFrame) -> CorpusStatistics:
    """The most frequent words and the character transitions of all texts of ``docs``."""
    counted = written(
        map_texts(docs.select("text"), _count, "kind int, key long, n long")
        .groupBy("kind", "key").agg(F.sum("n").alias("n")), "statistics",
    )
    top = counted.where("kind = 0").orderBy(F.desc("n"), "key").limit(DICTIONARY_WORDS).select("key").collect()
    words = frozenset(int(r[0]).to_bytes(8, "little").rstrip(b"\0").decode("ascii", "ignore") for r in top)
    table = np.ones((CLASSES, CLASSES))
    for r in counted.where("kind = 1").select("key", "n").collect():  # CLASSES squared rows
        table[r[0] // CLASSES, r[0] % CLASSES] += r[1]
    return CorpusStatistics(words, np.log(table / table.sum(axis=1, keepdims=True)))


def dictionary_cover(value: str, words: frozenset[str]) -> float:
    """The share of characters in dictionary words, the longest first from left to right."""
    low, at, covered = value.lower(), 0, 0
    while at < len(low):
        size = next((n for n in range(min(8, len(low) - at), 2, -1) if low[at : at + n] in words), 0)
        covered += size
        at += size or 1
    return covered / max(1, len(low))


def _assigned_values(text: str) -> list[tuple[int, int]]:
    """Spans of the values assigned to a credential word."""
    spans = []
    for m in _ASSIGNED.finditer(text):
        a, b = m.span(m.lastindex)
        if m.lastindex == 4:
            value = m[4]
            ends = [n.start() for n in [_NEXT_PAIR.search(value)] if n]
            if "&" in value and _IN_QUERY.search(text, max(0, m.start() - 60), m.start()):
                ends.append(value.index("&"))
            value = value[: min(ends, default=len(value))]
            b = a + len(value.rstrip(_CLOSING) or value)
        if b > a:
            spans.append((a, b))
    return spans


def find_candidates(text: str, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray, digits: np.ndarray, base: int):
    """Spans (in characters) of the candidates of one text.

    ``starts`` and ``ends`` give its token runs in bytes, ``chars`` and ``digits`` how many characters and digits begin
    before each byte of it; its first byte is ``base``.
    """
    long = ends - starts
    some = digits[ends - base] > digits[starts - base]
    picked = (long >= 20) | ((long >= 16) & some)
    first = chars[starts[picked] - base] - chars[0]
    spans = set(zip(first.tolist(), (first + long[picked]).tolist()))
    whole = []
    if "eyJ" in text:
        whole += [m.span() for m in _WEB_TOKEN.finditer(text)]
    if "=" in text or ":" in text:
        whole += _assigned_values(text)
    # What overlaps becomes one span, so that no part of a value stays.
    merged: list[tuple[int, int]] = []
    for a, b in sorted([*spans, *whole]):
        if merged and a < merged[-1][1]:
            merged[-1] = merged[-1][0], max(b, merged[-1][1])
        else:
            merged.append((a, b))
    return merged


def describe(text: str, a: int, b: int, path: str, known: CorpusStatistics) -> tuple[int, list[float]]:
    """What plain evidence says (1, 0, or -1 for nothing), and the features of a candidate."""
    value, left, right = text[a:b], text[max(0, a - 60) : a], text[b : b + 40]
    n = len(value)
    kinds = [0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 for c in value]
    share = [kinds.count(k) / n for k in range(4)]
    turns = sum(x != y for x, y in zip(kinds, kinds[1:])) / max(1, n - 1)
    counts = Counter(value)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    classes = _CLASS[np.frombuffer(value.encode("utf-8", "replace"), np.uint8)]
    likely = float(known.transitions[classes[:-1], classes[1:]].mean()) if len(classes) > 1 else 0.0
    cover = dictionary_cover(value, known.words)
    hexadecimal = all(c in "0123456789abcdefABCDEF" for c in value)
    before, near = bool(_BEFORE.search(left)), bool(_NEAR.search(left[-40:]))
    form = bool(_FORMATS.fullmatch(value))
    digest, holder = bool(_DIGEST.search(left)), bool(_PLACEHOLDER.search(value))
    quoted = left[-1:] in ("'", '"', "`") and right[:1] in ("'", '"', "`")
    features = [
        float(min(n, 200)), *share, turns, entropy, likely, cover, float(hexadecimal), float(before), float(near),
        float(form), float(digest), float(holder), float(quoted), float(left[-1:] in "=:"), float(bool(_UUID.fullmatch(value))),
        float(path.count("/")), float(bool(_TEST_PATH.search(path))), float("." in path.rsplit("/", 1)[-1]),
        float(bool(_PLACEHOLDER.search(left[-30:] + " " + right[:30]))),
    ]
    random = share[2] > 0 and entropy >= 2.5 and cover < 0.5
    if holder or digest or _UUID.fullmatch(value) or share[2] == 1.0:
        return 0, features
    if form or (before and random):
        return 1, features
    if share[2] == 0 and not before:
        return 0, features
    return -1, features


def digest_of(value: str) -> str:
    """Tells findings apart without giving anything of them away."""
    return hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest()[:12]


def _scan(known: CorpusStatistics):
    def task(batches):
        for batch in batches:
            ids, texts, paths = (batch.column(k).to_pylist() for k in range(3))
            data, offsets = text_buffers(batch.column(1))
            out: list[tuple] = []
            for a, b in runs(offsets, 1 << 20):
                low = int(offsets[a])
                starts, ends, bounds = word_spans(data, offsets[a : b + 1], _NOT_TOKEN)
                body = data[low : offsets[b]]
                digits = np.concatenate([[0], np.cumsum(_DIGIT[body])])
                chars = np.concatenate([[0], np.cumsum((body & 0xC0) != 0x80)])
                for k in range(a, b):
                    text = texts[k]
                    if not text:
                        continue
                    base, first, last = int(offsets[k]), bounds[k - a], bounds[k - a + 1]
                    own = slice(base - low, int(offsets[k + 1]) - low + 1)
                    for x, y in find_candidates(text, chars[own], starts[first:last], ends[first:last], digits[own], base):
                        evidence, features = describe(text, x, y, paths[k] or "", known)
                        out.append((ids[k], x, y - x, evidence, features, digest_of(text[x:y])))
            columns = list(zip(*out)) if out else [()] * 6
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.float64()), pa.string())
            names = [c.split()[0] for c in CANDIDATES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return task


def secret_candidates(docs: DataFrame, known: CorpusStatistics, path: Column | None = None) -> DataFrame:
    """One row per candidate: where it stands, what the evidence says, its features, the start of its digest."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", (F.lit(None) if path is None else path).cast("string").alias("path"))
    return map_texts(rows, _scan(known), CANDIDATES)


def fit_forest(findings: DataFrame):
    """A forest from labelled findings (``doc_id, start, features, label``), or None if they are of one kind only."""
    findings = findings.where("label in (0, 1)")
    marked = findings.withColumn("__key", F.concat_ws("|", "doc_id", "start", "mark"))
    sample = bounded_sample(marked, "__key", "label", SAMPLE_EACH)
    rows = sample.select("doc_id", "start", F.col("label").cast("double").alias("label"), "features")
    # Bounded, and put into one order, so that the same findings give the same forest.
    rows = written(rows.repartition(1).sortWithinPartitions("doc_id", "start", "label"), "findings")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="vector", labelCol="label", probabilityCol="probability"
    )
    model = forest.fit(rows.withColumn("vector", array_to_vector("features")))
    # The fitted object holds its session through its summary and can't go into a task; the saved one can.
    path = scratch_path(findings.sparkSession, "forest")
    model.write().save(path)
    return RandomForestClassificationModel.load(path)


def scan_secrets(
    docs: DataFrame, findings: DataFrame | None = None, path: Column | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id, start, length, mark, evidence, score, is_secret`` of every candidate in ``docs``.

    ``findings`` are labelled candidates (rows of ``secret_candidates`` with a 0/1 ``label``).
    """
    candidates = written(secret_candidates(docs, corpus_statistics(docs), path), "candidates")
    if findings is None:
        findings = candidates.where("evidence >= 0").withColumn("label", F.col("evidence"))
    forest = fit_forest(findings)
    if forest is None:
        scored = candidates.withColumn("score", F.when(F.col("evidence") == 1, 1.0).otherwise(0.0))
    else:
        scored = forest.transform(candidates.withColumn("vector", array_to_vector("features"))).withColumn(
            "score", vector_to_array("probability")[1]
        )
    return scored.select(
        "doc_id", "start", "length", "mark", "evidence", "score", (F.col("score") >= threshold).alias("is_secret")
    )


REDACTED = "[secret]"


def redacted_text(text: Column, spans: Column) -> Column:
    """``text`` with each of ``spans`` (an array of structs of start and length, none overlapping) replaced."""
    def cut(state: Column, span: Column) -> Column:
        before = F.substring(text, state["at"] + 1, (span["start"] - state["at"]).cast("int"))
        return F.struct(
            F.concat(state["done"], before, F.lit(REDACTED)).alias("done"),
            (span["start"] + span["length"]).cast("int").alias("at"),
        )

    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    rest = lambda s: F.concat(s["done"], F.substring(text, s["at"] + 1, F.char_length(text)))
    return F.aggregate(F.array_sort(spans), start, cut, rest)


def redact_secrets(docs: DataFrame, path: Column | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with every secret replaced by ``REDACTED``; ``n_chars``, where there is one, follows the text.

    Rows are found again by id and text hash, so rows that share an id keep their own findings.
    """
    mark = F.xxhash64("text")
    # A text's own hash goes with its findings in place of the id: equal texts have equal findings.
    found = scan_secrets(docs.withColumn("doc_id", mark), path=path, threshold=threshold)
    of, held, new = unused(docs, "found_in", "found_spans", "new_text")
    spans = (
        found.where("is_secret").select("doc_id", "start", "length").distinct()
        .groupBy(F.col("doc_id").alias(of)).agg(F.collect_list(F.struct("start", "length")).alias(held))
    )
    joined = docs.join(spans, mark == F.col(of), "left")
    text = F.when(F.col(held).isNotNull(), redacted_text(F.col("text"), F.col(held))).otherwise(F.col("text"))
    joined = joined.withColumn(new, text)
    columns = {"text": F.col(new)}
    if "n_chars" in docs.columns:
        n = F.when(F.col(held).isNotNull(), F.char_length(new)).otherwise(F.col("n_chars"))
        columns["n_chars"] = n.cast(docs.schema["n_chars"].dataType)
    return joined.withColumns(columns).select(docs.columns)
