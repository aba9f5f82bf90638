"""Talks study: talks, transcripts and interest tables to scores, classes and features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import vocab
from millrace.functions.labels import dummies, with_event_flags, with_occupation_flags
from millrace.functions.scalar import (
    contains_flag,
    epoch_day,
    epoch_year,
    field_sum,
    mean_of,
    parse_ratings,
    scaled,
    weekday_name,
    word_count,
)
from millrace.operators.cleaning import drop_every_copy, fill_mode
from millrace.operators.lookups import list_trend, lookup_trend, outer_filled, trend_table
from millrace.operators.ranking import equal_count_classes
from millrace.session import written

FLAGS = [
    *vocab.OCCUPATION_GROUPS, vocab.OTHER_OCCUPATIONS, *vocab.WEEKDAYS, "TEDx", "TED", "TED_Global",
    "TED_Other", "Non_TED_University", "Non_TED_Other", "how", "question",
]
#: What the class of a talk is learned from.
ATTRIBUTES = ["duration", "num_speaker", "speaker_trend", "tags_trend", "funny_factor", *FLAGS]


def _within_range(df: DataFrame, col: str):
    bounds = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    return scaled(col, bounds.select("lo").scalar(), bounds.select("hi").scalar())


def scored(talks: DataFrame) -> DataFrame:
    """Adds ``ratings_count`` and ``popularity``, the mean of three scaled counts."""
    # Stored: the bounds of three columns and the rows themselves are read from it.
    counted = written(talks.withColumn("ratings_count", field_sum(parse_ratings("ratings"))), "counted")
    parts = [_within_range(counted, c) for c in ("views", "comments", "ratings_count")]
    return counted.withColumn("popularity", mean_of(parts))


def laughs(transcripts: DataFrame, key: str, text: str, word: str = vocab.LAUGH_WORD) -> DataFrame:
    """``key, laughter, scaled_laugh`` of transcripts that occur once; a row that occurs twice is
    dropped with all its copies."""
    once = drop_every_copy(transcripts, [text], keep=[key])
    counted = written(once.select(key, word_count(text, word).alias("laughter")), "laughs")
    return counted.withColumn("scaled_laugh", _within_range(counted, "laughter"))


def with_humour(talks: DataFrame, laughter: DataFrame, key: str) -> DataFrame:
    """Adds ``funny_factor``; talks and transcripts without a partner stay, with 0."""
    joined = outer_filled(talks, laughter, key, {"laughter": 0, "scaled_laugh": 0.0})
    return joined.withColumnRenamed("scaled_laugh", "funny_factor").drop("laughter")


def with_class(df: DataFrame, col: str = "popularity", num: int = 3) -> DataFrame:
    return equal_count_classes(df, col, num, f"{col}_class")


def with_flags(df: DataFrame) -> DataFrame:
    """Occupation, event, weekday and title flags, all as 0/1 columns of one projection chain.

    Where the text of a flag is missing, its group's rest flag is set and all else is 0.
    """
    out = with_event_flags(with_occupation_flags(df))
    rests = (vocab.OTHER_OCCUPATIONS, vocab.OTHER_EVENTS)
    groups = [c for c in out.columns if c not in df.columns]
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(int(c in rests))) for c in groups})
    out = out.withColumns(
        {
            "year": epoch_year("published_date"),
            "published_day": epoch_day("published_date"),
            "__weekday": weekday_name(F.timestamp_seconds("published_date")),
            "question": F.coalesce(contains_flag("title", "?"), F.lit(0)),
            "how": F.coalesce(contains_flag("title", "How"), F.lit(0)),
        }
    )
    days = {name.split("_day_")[1]: c for name, c in dummies("__weekday", vocab.WEEKDAYS, "_day").items()}
    return out.withColumns(days).drop("__weekday")


def with_trends(
    df: DataFrame, row_key: str, speakers: DataFrame, tags: DataFrame, years: Sequence[str] = vocab.TREND_YEARS
) -> DataFrame:
    """Adds ``speaker_trend`` and ``tags_trend``, mean interest over the years."""
    out = lookup_trend(df, trend_table(speakers, "main_speaker", years), "main_speaker", "speaker_trend")
    means = list_trend(out, trend_table(tags, "tag", years), row_key, "tags", "tag", "tags_trend")
    return out.join(means, [row_key], "left")


def features(talks: DataFrame, transcripts: DataFrame, key: str, text: str, word: str = vocab.LAUGH_WORD) -> DataFrame:
    """Scores, classes and flags of all talks, and of transcripts without a talk.

    Those have their ``funny_factor``, no popularity and no class, and the flags of rows without texts. The missing
    occupations of talks are filled before transcripts come in.
    """
    rated = fill_mode(scored(talks), "speaker_occupation")
    rows = written(with_humour(rated, laughs(transcripts, key, text, word), key), "humour")
    return with_flags(with_class(rows))
