"""Equal-count classes, ranks, top rows, samples and splits (W, T)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.labels import class_of
from millrace.operators.ordered import (
    HOT_ROWS,
    order_bounds,
    running_before,
    with_group_stats,
)


def equal_count_classes(
    df: DataFrame, col: str, num: int, name: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Classes 0..num-1 cut at the values standing at sorted positions ``int(i * n / num)``.

    Only the ``num - 1`` cut values are gathered. Equal values share a class, and a value equal
    to a cut goes to the higher class.
    """
    bounds = order_bounds(df, col, num, hot_rows)
    return df.withColumn(name, F.when(F.col(col).isNotNull(), class_of(col, bounds)))


def fixed_classes(df: DataFrame, col: str, bounds: Sequence[float], name: str) -> DataFrame:
    return df.withColumn(name, F.when(F.col(col).isNotNull(), class_of(col, bounds)))


def running_total(
    df: DataFrame, by: Sequence[str], order: str, col: str, name: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Total of ``col`` up to and including the row; ``order`` is unique in the group."""
    rows = running_before(df, by, order, [col], hot_rows=hot_rows)
    return rows.withColumn(name, F.col(f"{col}_before") + F.col(col)).drop(f"{col}_before")


def top_ranked(df: DataFrame, score: str, n: int, name: str = "rank") -> DataFrame:
    """Rows whose rank by descending score is at most ``n``; ties share a rank and all stay.

    Ranks are worked out on at most ``n`` distinct scores, then joined to the rows.
    """
    counts = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("__s")).agg(
        F.count(F.lit(1)).alias("__n")
    )
    best = counts.orderBy(F.desc("__s")).limit(n)
    ranks = running_before(best, [], "__s", ["__n"], descending=True)
    ranks = ranks.withColumn(name, (F.col("__n_before") + 1).cast("int")).where(F.col(name) <= n)
    return df.join(ranks, df[score] == ranks["__s"]).select(*[df[c] for c in df.columns], name)


def top_rows(df: DataFrame, by: Sequence[str], n: int, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in by], *[F.asc(c) for c in ties]).limit(n)


def sorted_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def sample_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows drawn at random by a seeded hash of the key: the same rows on every run."""
    draw = F.xxhash64(F.col(key), F.lit(seed))
    return df.withColumn("__draw", draw).orderBy("__draw", key).limit(n).drop("__draw")


def hash_split(df: DataFrame, key: str, weights: Sequence[float], seed: int, name: str = "part") -> DataFrame:
    """Random split by weights as a column ``name`` = 0, 1, ...; no shuffle, stable on re-run."""
    slots = 1_000_000
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(slots))
    total, bounds, run = float(sum(weights)), [], 0.0
    for w in weights[:-1]:
        run += w
        bounds.append(int(round(run / total * slots)))
    return df.withColumn(name, class_of(draw, bounds))


def _draw_places(df: DataFrame, cls: str, key: str, seed: int, hot_rows: int) -> DataFrame:
    drawn = df.withColumns(
        {
            "__draw": F.struct(F.xxhash64(F.col(key), F.lit(seed)).alias("h"), F.col(key).alias("k")),
            "__one": F.lit(1).cast("bigint"),
        }
    )
    placed = running_before(drawn, [cls], "__draw", ["__one"], hot_rows=hot_rows)
    return with_group_stats(placed, [cls], F.count(F.lit(1)).alias("__total"))


def stratified_split(
    df: DataFrame, cls: str, key: str, fraction: float, seed: int,
    name: str = "is_test", hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Marks ``round(fraction * n)`` rows of every class, drawn by a seeded hash of the key."""
    placed = _draw_places(df, cls, key, seed, hot_rows)
    quota = F.round(F.col("__total") * F.lit(float(fraction)))
    marked = placed.withColumn(name, (F.col("__one_before") < quota).cast("int"))
    return marked.select(*df.columns, name)


def stratified_folds(
    df: DataFrame, cls: str, key: str, folds: int, seed: int,
    name: str = "fold", hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Fold numbers 0..folds-1, each class spread evenly over the folds."""
    placed = _draw_places(df, cls, key, seed, hot_rows)
    fold = (F.col("__one_before") % F.lit(folds)).cast("int")
    return placed.withColumn(name, fold).select(*df.columns, name)
