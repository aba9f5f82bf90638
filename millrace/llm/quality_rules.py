"""A ledger of quality rules: one failure bit per rule and the measurements behind it.

Every rule is evaluated once per document. Policies are named sets of rules; applying another one,
or working out what each rule removes, needs the stored bits only, never the texts.

Words are runs of characters other than space, tab, line feed, vertical tab, form feed and
carriage return. A null text has no words and fails ``too_few_words``. Repeated rows get a row
each; a null id is passed on. An empty table gives an empty ledger. Only ``doc_id`` and ``text``
are read. Thresholds compare whole numbers, so the bits do not hang on rounding.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.textkit import WHITE, map_texts, runs, span_hashes, text_buffers, windows, word_spans

REPEAT_WORDS = 8
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters"
)

#: Rules in the order of their bits. Each is a condition over the measurements under which it fails.
RULES: dict[str, str] = {
    "too_few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "many_symbols": "100 * n_symbols > 30 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "upper_case": "n_letters >= 100 and 100 * n_upper > 50 * n_letters",
    "word_length": "n_words > 0 and (word_chars < 2 * n_words or word_chars > 25 * n_words)",
    "no_letters": "2 * n_letters < word_chars",
}

#: Versioned policies: a document is kept if it fails none of the rules named.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_few_words", "repeated_words"),
    "v1": ("too_few_words", "repeated_words", "many_symbols", "repeated_lines"),
    "v2": tuple(RULES),
}

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_STARTS = np.ones(256, bool)  # bytes that begin a code point
_STARTS[0x80:0xC0] = False
_IN_WORD = _STARTS & ~WHITE
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[0xC0:] = True  # each code point beyond ASCII counts as a letter
_BLANK = b" \t\n\v\f\r"


def _duplicate_lines(body: bytes) -> tuple[int, int]:
    seen, repeats, lines = set(), 0, 0
    for line in body.split(b"\n"):
        if line.strip(_BLANK):
            lines += 1
            if line in seen:
                repeats += 1
            else:
                seen.add(line)
    return lines, repeats


def repeated_words(window_hashes: np.ndarray, size: int) -> int:
    """Words that lie in a window standing at two places or more."""
    ordered = np.sort(window_hashes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.searchsorted(twice, window_hashes)
    at[at == len(twice)] = 0
    hit = np.flatnonzero(twice[at] == window_hashes)
    edge = np.zeros(len(window_hashes) + size, np.int32)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + size, -1)
    return int(np.count_nonzero(np.cumsum(edge)))


def measured(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The measurements of each text, a column for each of ``MEASURES``."""
    starts, ends, bounds = word_spans(data, offsets)
    again = windows(span_hashes(data, starts, ends), REPEAT_WORDS)
    low = offsets[0]
    body = data[low : offsets[-1]]
    tables = [t[body] for t in (_IN_WORD, _SYMBOLS, _UPPER, _LETTER)]
    out = np.zeros((len(offsets) - 1, len(MEASURES)), np.int64)
    for k in range(len(offsets) - 1):
        a, b = int(offsets[k] - low), int(offsets[k + 1] - low)
        first, last = int(bounds[k]), int(bounds[k + 1])
        if first == last:
            continue
        chars, symbols, upper, letters = (int(np.count_nonzero(t[a:b])) for t in tables)
        lines, repeats = _duplicate_lines(body[a:b].tobytes())
        words = max(0, last - first - REPEAT_WORDS + 1)
        covered = repeated_words(again[first : first + words], REPEAT_WORDS) if words > 1 else 0
        out[k] = (last - first, chars, symbols, repeats, covered, lines, upper, letters)
    return out


def _measure(batches):
    names = ["doc_id", *MEASURES]
    for batch in batches:
        data, offsets = text_buffers(batch.column(1))
        parts = [measured(data, offsets[a : b + 1]) for a, b in runs(offsets)]
        if parts:
            table = np.concatenate(parts)
            columns = [pa.array(np.ascontiguousarray(table[:, k])) for k in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)


def rule_bits(rules: Mapping[str, str] = RULES) -> Column:
    """The failure bits of a row of measurements; bit k stands for the k-th rule."""
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(rules.values()):
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return bits


def rule_ledger(docs: DataFrame, rules: Mapping[str, str] = RULES) -> DataFrame:
    """``doc_id``, the measurements and ``fail_bits`` of every document. No shuffle."""
    schema = ", ".join(f"{c} long" for c in ("doc_id", *MEASURES))
    measures = map_texts(docs.select(F.col("doc_id").cast("long"), "text"), _measure, schema)
    return measures.withColumn("fail_bits", rule_bits(rules))


def policy_mask(names: Sequence[str], rules: Mapping[str, str] = RULES) -> int:
    order = list(rules)
    return sum(1 << order.index(name) for name in names)


def policy_keeps(mask: int) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")) == 0


def ablations(ledger: DataFrame, policies: Mapping[str, Sequence[str]] = POLICIES) -> DataFrame:
    """Per policy and rule: documents that fail it, that fail it alone, and that the policy keeps.

    Rows are counted by their bits first, so a group is one pattern of failures.
    """
    patterns = ledger.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    rows = [
        (policy, rule, policy_mask(chosen), policy_mask([rule]))
        for policy, chosen in policies.items() for rule in chosen
    ]
    names = ("policy", "rule", "mask", "bit")
    asked = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(names, r)]) for r in rows])
    spread = patterns.select("fail_bits", "n", F.explode(asked).alias("a")).select("fail_bits", "n", "a.*")
    failed = F.col("fail_bits").bitwiseAND(F.col("mask"))
    count = lambda when, name: F.sum(F.when(when, F.col("n")).otherwise(0)).alias(name)
    return spread.groupBy("policy", "rule").agg(
        count(failed.bitwiseAND(F.col("bit")) != 0, "fails"),
        count(failed == F.col("bit"), "fails_alone"),
        count(failed == 0, "policy_keeps"),
    )
