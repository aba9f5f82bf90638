"""Column expressions (X1-X27). All are built-ins, so they stay in generated code."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import vocab

RATINGS_TYPE = "array<struct<id:int,name:string,count:bigint>>"
TAGS_TYPE = "array<string>"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- dates -------------------------------------------------------------------------------


def weekday_name(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "EEEE")


def week_of_month(ts: Column | str) -> Column:
    """Week of the month, 1-based, weeks starting on Sunday."""
    first = F.dayofweek(F.trunc(_c(ts), "MM"))
    return F.ceil((F.dayofmonth(_c(ts)) + first - 1) / 7.0).cast("int")


def epoch_year(seconds: Column | str) -> Column:
    return F.year(F.timestamp_seconds(_c(seconds)))


def epoch_day(seconds: Column | str) -> Column:
    return F.date_format(F.timestamp_seconds(_c(seconds)), "MM/dd/yyyy")


# --- text --------------------------------------------------------------------------------


def word_count(text: Column | str, word: str) -> Column:
    """Occurrences of a whole word, case kept."""
    return F.regexp_count(_c(text), F.lit(rf"\b{re.escape(word)}\b"))


def contains_flag(text: Column | str, part: str, any_case: bool = False) -> Column:
    """1 when ``part`` occurs in the text, else 0."""
    hay, needle = (_c(text), part) if not any_case else (F.lower(_c(text)), part.lower())
    return F.contains(hay, F.lit(needle)).cast("int")


def any_keyword(text: Column | str, words: Sequence[str]) -> Column:
    """Whether any of the words occurs, ignoring case; one projection, no join."""
    low = F.lower(_c(text))
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(w.lower())) for w in words])


def any_part(text: Column | str, parts: Sequence[str]) -> Column:
    """Whether any of the parts occurs as it stands; one pattern in place of a test for each part."""
    return _c(text).rlike("|".join(map(re.escape, parts)))


def split_terms(text: Column | str, separators: str = vocab.OCCUPATION_SEPARATORS) -> Column:
    return F.split(F.lower(_c(text)), separators)


def unique_item(value: Column | str, name: str) -> Column:
    """The value as text with its column name behind it, so items of two columns differ."""
    return F.concat(_c(value).cast("string"), F.lit(f"{name}_new"))


def any_item_matches(items: Column | str, pattern: str) -> Column:
    return F.exists(_c(items), lambda x: x.rlike(pattern))


def fixed_decimals(value: Column | str, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", _c(value))


# --- arrays of ratings -------------------------------------------------------------------


def parse_ratings(text: Column | str) -> Column:
    return F.from_json(_c(text), RATINGS_TYPE)


def parse_tags(text: Column | str) -> Column:
    return F.from_json(_c(text), TAGS_TYPE)


def field_sum(items: Column | str, field: str = "count") -> Column:
    """Sum of a field over an array of any length; an empty array gives 0."""
    return F.aggregate(_c(items), F.lit(0).cast("bigint"), lambda a, x: a + x[field].cast("bigint"))


def field_sum_where(items: Column | str, test, field: str = "count") -> Column:
    return field_sum(F.filter(_c(items), test), field)


def rating_tone(name: Column) -> Column:
    tone = F.lit("neutral")
    for group in ("negative", "positive"):
        tone = F.when(name.isin(vocab.RATING_TONES[group]), F.lit(group)).otherwise(tone)
    return tone


def tone_mean(ratings: Column | str, tone: str) -> Column:
    """Mean count of the ratings of one tone; null when there is none."""
    picked = F.filter(_c(ratings), lambda r: rating_tone(r["name"]) == F.lit(tone))
    return F.try_divide(field_sum(picked).cast("double"), F.size(picked))


def array_mean(items: Column | str) -> Column:
    total = F.aggregate(_c(items), F.lit(0.0), lambda a, x: a + x.cast("double"))
    return F.try_divide(total, F.size(_c(items)))


# --- numbers -----------------------------------------------------------------------------


def scaled(value: Column | str, low: Column, high: Column) -> Column:
    """Min-max scaling; null when all values are the same."""
    return F.try_divide((_c(value) - low).cast("double"), (high - low).cast("double"))


def mean_of(cols: Sequence[Column | str]) -> Column:
    return reduce(lambda a, b: a + b, [_c(c) for c in cols]) / F.lit(float(len(cols)))


def clip_negative(value: Column | str) -> Column:
    return F.greatest(_c(value), F.lit(0.0))


def squared_log_error(actual: Column | str, predicted: Column | str) -> Column:
    return F.pow(F.log1p(_c(actual)) - F.log1p(_c(predicted)), F.lit(2.0))


def residual(predicted: Column | str, actual: Column | str) -> Column:
    return _c(predicted) - _c(actual)


def hashed_class(key: Column | str, classes: int, seed: int) -> Column:
    """A class in 0..classes-1 drawn uniformly by row key; the same on every run."""
    return F.pmod(F.xxhash64(_c(key), F.lit(seed)), F.lit(classes)).cast("int")


# --- credit ------------------------------------------------------------------------------


def running_debts(bill: str = "ba_", paid: str = "pa_") -> dict[str, Column]:
    """``debt_apr`` .. ``debt_aug``: bill minus next month's payment, carried forward."""
    debts, carried = {}, None
    for month, later in zip(vocab.MONTHS, vocab.MONTHS[1:]):
        open_part = F.col(bill + month) - F.col(paid + later)
        carried = open_part if carried is None else open_part + carried
        debts[f"debt_{month}"] = carried
    return debts


def monthly_expenses(bill: str = "ba_", paid: str = "pa_") -> dict[str, Column]:
    return {
        f"expense_{m}": F.col(bill + m) - (F.col(bill + prev) - F.col(paid + m))
        for prev, m in zip(vocab.MONTHS, vocab.MONTHS[1:])
    }


def worst_status(prefix: str = "ps_") -> Column:
    return F.greatest(*[F.col(prefix + m) for m in vocab.MONTHS])


def delay_band(missed: Column | str) -> Column:
    late = _c(missed)
    return (
        F.when(late >= 2, F.lit(vocab.PAY_LATE_MORE))
        .when(late == 1, F.lit(vocab.PAY_LATE_ONE))
        .when(late.between(-2, 0), F.lit(vocab.PAY_DULY))
    )
