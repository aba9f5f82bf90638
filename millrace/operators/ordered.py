"""Order statistics, running totals and lags that do not need a whole group in one task.

Every operator first measures its largest group. A group that fits one task uses the plain
built-in. A larger one is cut into ranges of the sort key (``repartitionByRange``): each range
is worked on alone, and a table with a few rows per range carries totals or border rows from
one range to the next. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.session import written

HOT_ROWS = 2_000_000
_RANGE = "__range"


def largest_group(df: DataFrame, by: Sequence[str] = ()) -> int:
    """Rows in the largest group; counted with map-side combine."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"))
    return sizes.first()[0] or 0


def same_keys(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """Null-safe equality of several keys; stays a hashable equi-join."""
    cond = None
    for left, right in pairs:
        part = left.eqNullSafe(right)
        cond = part if cond is None else cond & part
    return cond


def with_group_stats(df: DataFrame, by: Sequence[str], *aggs: Column) -> DataFrame:
    """``df`` with aggregates of its own group added.

    Aggregate then join back, not a window: partial aggregation shrinks a hot group before the
    shuffle, and AQE broadcasts the small side or splits the hot key.
    """
    if not by:
        stats = df.agg(*aggs)
        return df.withColumns({c: stats.select(F.col(c)).scalar() for c in stats.columns})
    keys = {k: f"__key_{i}" for i, k in enumerate(by)}
    stats = df.groupBy(*[F.col(k).alias(a) for k, a in keys.items()]).agg(*aggs)
    cond = same_keys([(df[k], stats[a]) for k, a in keys.items()])
    return df.join(stats, cond, "left").drop(*keys.values())


def ranged(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """``df`` stored in key order with the number of its range; ranges follow the key order."""
    return written(
        df.repartitionByRange(*keys).withColumn(_RANGE, F.spark_partition_id()), "ranges"
    )


def running_before(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    sums: Sequence[str],
    descending: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``<c>_before``: the total of ``c`` over rows of the group that sort ahead.

    ``order`` must be unique within the group (aggregate first if it is not).
    """
    direction = F.desc(order) if descending else F.asc(order)
    ahead = lambda part: part.orderBy(direction).rowsBetween(W.unboundedPreceding, -1)
    if largest_group(df, by) <= hot_rows:
        win = ahead(W.partitionBy(*by))
        return df.withColumns({f"{c}_before": F.coalesce(F.sum(c).over(win), F.lit(0)) for c in sums})

    parts = ranged(df, [*by, direction])
    inner = ahead(W.partitionBy(*by, _RANGE))
    rows = parts.withColumns({f"__in_{c}": F.coalesce(F.sum(c).over(inner), F.lit(0)) for c in sums})
    keys = {k: f"__key_{i}" for i, k in enumerate([*by, _RANGE])}
    totals = parts.groupBy(*[F.col(k).alias(a) for k, a in keys.items()]).agg(
        *[F.sum(c).alias(f"__sum_{c}") for c in sums]
    )
    outer = (
        W.partitionBy(*[a for k, a in keys.items() if k != _RANGE])
        .orderBy(keys[_RANGE])
        .rowsBetween(W.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *keys.values(),
        *[F.coalesce(F.sum(f"__sum_{c}").over(outer), F.lit(0)).alias(f"__off_{c}") for c in sums],
    )
    cond = same_keys([(rows[k], offsets[a]) for k, a in keys.items()])
    return rows.join(offsets, cond).select(
        *[rows[c] for c in df.columns],
        *[(F.col(f"__in_{c}") + F.col(f"__off_{c}")).alias(f"{c}_before") for c in sums],
    )


def value_ranks(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    descending: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per distinct value of a group: ``by..., value, n, n_before``.

    Copies of a value are counted before anything is ordered, so a value held by many rows is
    one row here.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    return running_before(counts, by, value, ["n"], descending, hot_rows)


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Exact quantiles with linear interpolation: ``by...``, then one array per column."""
    if largest_group(df, by) <= hot_rows:
        points = F.array(*[F.lit(float(p)) for p in probs])
        return df.groupBy(*by).agg(*[F.percentile(F.col(c), points).alias(c) for c in cols])

    result = None
    for col in cols:
        ranks = value_ranks(df, col, by, hot_rows=hot_rows)
        total = F.sum("n").alias("__total")
        # Joined, not a scalar subquery: the result may itself be read as one, and such can't be nested.
        ranks = with_group_stats(ranks, by, total) if by else ranks.crossJoin(F.broadcast(ranks.agg(total)))
        picks = []
        for i, p in enumerate(probs):
            pos = (F.col("__total") - 1) * F.lit(float(p))
            for tag, at in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
                here = (F.col("n_before") <= at) & (at < F.col("n_before") + F.col("n"))
                picks.append(F.max(F.when(here, F.col(col).cast("double"))).alias(f"__{tag}{i}"))
            picks.append(F.max(pos - F.floor(pos)).alias(f"__frac{i}"))
        found = ranks.groupBy(*by).agg(*picks)
        values = [
            F.col(f"__lo{i}") * (1 - F.col(f"__frac{i}")) + F.col(f"__hi{i}") * F.col(f"__frac{i}")
            for i in range(len(probs))
        ]
        one = found.select(*by, F.when(F.col("__frac0").isNotNull(), F.array(*values)).alias(col))
        if by:
            # A group without a value stays, with null, as it does in the built-in.
            groups = df.select(*[F.col(k).alias(f"__g{i}") for i, k in enumerate(by)]).distinct()
            held = same_keys([(groups[f"__g{i}"], one[k]) for i, k in enumerate(by)])
            one = groups.join(one, held, "left").select(
                *[F.col(f"__g{i}").alias(k) for i, k in enumerate(by)], col
            )
        if result is None:
            result = one
        elif by:
            keys = {k: f"__key_{i}" for i, k in enumerate(by)}
            one = one.withColumnsRenamed(keys)
            cond = same_keys([(result[k], one[a]) for k, a in keys.items()])
            result = result.join(one, cond, "full").drop(*keys.values())
        else:
            result = result.crossJoin(F.broadcast(one))
    return result


def order_bounds(
    df: DataFrame, value: str, num: int, hot_rows: int = HOT_ROWS
) -> list:
    """The values standing at sorted positions ``int(i * n / num)``, i = 1 .. num-1."""
    n = largest_group(df.where(F.col(value).isNotNull()))
    if n == 0:
        return []
    step = n / float(num)
    positions, last = [], 0.0
    for _ in range(num - 1):
        last += step
        positions.append(min(int(last), n - 1))
    if n <= hot_rows:
        picks = [
            F.expr(f"percentile_disc({(p + 0.5) / n!r}D) within group (order by `{value}`)")
            for p in positions
        ]
        return list(df.agg(*[c.alias(f"p{i}") for i, c in enumerate(picks)]).first())
    ranks = value_ranks(df, value, hot_rows=hot_rows)
    picks = [
        F.max(F.when((F.col("n_before") <= p) & (p < F.col("n_before") + F.col("n")), F.col(value)))
        for p in positions
    ]
    return list(ranks.agg(*[c.alias(f"p{i}") for i, c in enumerate(picks)]).first())


def lags(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    offsets: dict[int, str],
    hot_rows: int = HOT_ROWS,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Add earlier values of ``value`` in the group: ``offsets`` maps distance to column name.

    ``sized_by`` is a cheaper table whose groups are at least as large as those of ``df``; group
    sizes are then taken from it and ``df`` is not computed twice.

    In a group too large for one task, only the first and last few rows of each range look
    beyond it, so only those are ordered across ranges.
    """
    if largest_group(df if sized_by is None else sized_by, by) <= hot_rows:
        win = W.partitionBy(*by).orderBy(*order)
        return df.withColumns({name: F.lag(value, k).over(win) for k, name in offsets.items()})

    reach = max(offsets)
    parts = ranged(df, [*by, *order])
    inside = W.partitionBy(*by, _RANGE).orderBy(*order)
    backward = W.partitionBy(*by, _RANGE).orderBy(*[F.desc(c) for c in order])
    rows = parts.withColumns(
        {
            **{name: F.lag(value, k).over(inside) for k, name in offsets.items()},
            "__head": F.row_number().over(inside),
            "__tail": F.row_number().over(backward),
        }
    )
    edges = rows.where((F.col("__head") <= reach) | (F.col("__tail") <= reach))
    across = W.partitionBy(*by).orderBy(*order)
    heads = edges.withColumns({name: F.lag(value, k).over(across) for k, name in offsets.items()})
    whole = rows.where(F.col("__head") > reach).unionByName(heads.where(F.col("__head") <= reach))
    return whole.select(*df.columns, *offsets.values())
