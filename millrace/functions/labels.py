"""Recodes and labels built from value maps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import vocab
from millrace.functions.scalar import any_part


def recode(col: Column | str, mapping: Mapping) -> Column:
    """Values through a map; a value outside the map gives null."""
    c = F.col(col) if isinstance(col, str) else col
    out = None
    for key, value in mapping.items():
        test = c == F.lit(key)
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    return out


def inverted(mapping: Mapping) -> dict:
    return {v: k for k, v in mapping.items()}


def pair_code(first: str, second: str, mapping: Mapping, default: int = 0) -> Column:
    out = None
    for (a, b), code in mapping.items():
        test = (F.col(first) == a) & (F.col(second) == b)
        out = F.when(test, F.lit(code)) if out is None else out.when(test, F.lit(code))
    return out.otherwise(F.lit(default))


def sex_status(sex: str = "sex", status: str = "status") -> Column:
    return pair_code(sex, status, vocab.SEX_STATUS_CODES)


def list_flags(col: str, groups: Mapping[str, Sequence]) -> dict[str, Column]:
    """One 0/1 column per group: is the value in the group's list."""
    return {
        name: F.coalesce(F.col(col).isin(list(values)), F.lit(False)).cast("int")
        for name, values in groups.items()
    }


def none_set(flags: Sequence[str]) -> Column:
    """Rows where no flag is set."""
    test = None
    for f in flags:
        test = (F.col(f) != 1) if test is None else test & (F.col(f) != 1)
    return test


def keyword_flags(col: str, groups: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    return flags_of_lower(F.lower(F.col(col)), groups)


def flags_of_lower(low: Column, groups: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """One 0/1 column per group: does the lower-cased text hold one of its words, whatever their case."""
    return {
        name: F.coalesce(any_part(low, [w.lower() for w in words]), F.lit(False)).cast("int")
        for name, words in groups.items()
    }


def with_group_flags(
    df: DataFrame,
    col: str,
    exact: Mapping[str, Sequence[str]],
    loose: Mapping[str, Sequence[str]],
    rest: str,
) -> DataFrame:
    """Adds 0/1 columns: groups listing the value; else groups with a keyword in it; else ``rest``.

    All tests of a row end in one bit mask, worked out once; the flags read its bits. The text is lower-cased once as well, in a
    column of its own: inside the tests it would be for every keyword anew.
    """
    names = list(dict.fromkeys([*exact, *loose]))
    bits = {n: 1 << i for i, n in enumerate(names)}

    def mask(flags: Mapping[str, Column]) -> Column:
        return reduce(lambda a, b: a + b, [flag * bits[n] for n, flag in flags.items()])

    staged = df.withColumns({"__listed": mask(list_flags(col, exact)), "__low": F.lower(F.col(col))})
    staged = staged.withColumn(
        "__mask", F.when(F.col("__listed") > 0, F.col("__listed")).otherwise(mask(flags_of_lower(F.col("__low"), loose)))
    )
    flags = {n: (F.col("__mask").bitwiseAND(F.lit(bit)) > 0).cast("int") for n, bit in bits.items()}
    flags[rest] = (F.col("__mask") == 0).cast("int")
    return staged.withColumns(flags).drop("__listed", "__low", "__mask")


def with_occupation_flags(df: DataFrame, col: str = "speaker_occupation") -> DataFrame:
    return with_group_flags(
        df, col, vocab.OCCUPATION_GROUPS, vocab.OCCUPATION_KEYWORDS, vocab.OTHER_OCCUPATIONS
    )


def with_event_flags(df: DataFrame, col: str = "event") -> DataFrame:
    main = {"TED": [f"TED{y}" for y in vocab.MAIN_EVENT_YEARS]}
    flagged = with_group_flags(df, col, main, vocab.EVENT_KEYWORDS, vocab.OTHER_EVENTS)
    return flagged.withColumn("TED_Other", cleared_where(F.col("TED_Other"), F.col("TED_Global")))


def cleared_where(flag: Column, other: Column) -> Column:
    """The flag, set to 0 where the other flag is set."""
    return F.when(other == 1, F.lit(0)).otherwise(flag)


def last_label(flags: Sequence[str], names: Mapping[str, str] | None = None, empty: str = "") -> Column:
    """One label from several flags; the last flag that is set wins."""
    names = names or {}
    out = F.lit(empty)
    for f in flags:
        out = F.when(F.col(f) == 1, F.lit(names.get(f, f))).otherwise(out)
    return out


def dummies(col: str, values: Sequence, prefix: str | None = None) -> dict[str, Column]:
    """A 0/1 column per known value, named ``<col>_<value>``."""
    prefix = prefix or col
    return {
        f"{prefix}_{v}": F.coalesce(F.col(col) == F.lit(v), F.lit(False)).cast("int") for v in values
    }


def class_of(value: Column | str, bounds: Sequence) -> Column:
    """Number of bounds at or below the value; a tie with a bound goes to the higher class."""
    c = F.col(value) if isinstance(value, str) else value
    total = F.lit(0)
    for b in bounds:
        total = total + (c >= F.lit(b)).cast("int")
    return total
