"""Grouped statistics (A1-A36). Each is one partial-then-final aggregation unless noted."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import HOT_ROWS, quantiles, same_keys, value_ranks, with_group_stats

AGGREGATES = {"mean": F.avg, "min": F.min, "max": F.max, "sum": F.sum}


def category_counts(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def top_groups(df: DataFrame, by: str, measures: Sequence[str], how: str, n: int) -> DataFrame:
    """Grouped aggregate of one or more measures, largest first, top ``n``; ties by group."""
    fn = AGGREGATES[how]
    out = df.groupBy(by).agg(*[fn(m).alias(f"{how}_{m}") for m in measures])
    return out.orderBy(F.desc(f"{how}_{measures[0]}"), F.asc(by)).limit(n)


def group_sums(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.sum(c).alias(f"sum_{c}") for c in cols])


def describe(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per column (and group): count, mean, std, min, quartiles, max."""
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        aggs += [
            F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"),
            F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"),
        ]
    base = df.groupBy(*by).agg(*aggs)
    quarts = quantiles(df, cols, [0.25, 0.5, 0.75], by, hot_rows)
    quart = {c: F.col(f"__q_{c}") for c in cols}
    keys = {k: f"__key_{i}" for i, k in enumerate(by)}
    right = quarts.withColumnsRenamed({**keys, **{c: f"__q_{c}" for c in cols}})
    if by:
        both = base.join(right, same_keys([(base[k], right[a]) for k, a in keys.items()]), "left")
    else:
        both = base.crossJoin(F.broadcast(right))
    cells = [
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("mean"),
            F.col(f"s{i}").alias("std"), F.col(f"lo{i}").alias("min"),
            quart[c][0].alias("q1"), quart[c][1].alias("median"), quart[c][2].alias("q3"),
            F.col(f"hi{i}").alias("max"),
        )
        for i, c in enumerate(cols)
    ]
    return both.select(*by, F.inline(F.array(*cells)))


def pearson_matrix(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``a, b, corr`` for every pair of columns, all pairs in one pass; nulls are skipped."""
    pairs = list(combinations(cols, 2))
    sums = df.groupBy(*by).agg(*[F.corr(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ]
    return sums.select(*by, F.inline(F.array(*cells)))


def spearman(df: DataFrame, a: str, b: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rank correlation with average ranks on ties: one row ``a, b, corr``.

    Works on counted value pairs, so frequent values are one row each.
    """
    both = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    pairs = both.groupBy(F.col(a).alias("__a"), F.col(b).alias("__b")).agg(
        F.count(F.lit(1)).alias("__w")
    )

    def ranks(col: str, name: str) -> DataFrame:
        r = value_ranks(both.select(F.col(col).alias(name)), name, hot_rows=hot_rows)
        return r.select(name, (F.col("n_before") + (F.col("n") + 1) / 2.0).alias(f"{name}_rank"))

    ranked = pairs.join(ranks(a, "__a"), "__a").join(ranks(b, "__b"), "__b")
    w, x, y = F.col("__w").cast("double"), F.col("__a_rank"), F.col("__b_rank")
    centre = (both.agg(((F.count(F.lit(1)) + 1) / 2.0).alias("m"))).scalar()
    dx, dy = x - centre, y - centre
    sums = ranked.agg(
        F.sum(w * dx * dy).alias("xy"), F.sum(w * dx * dx).alias("xx"), F.sum(w * dy * dy).alias("yy")
    )
    return sums.select(
        F.lit(a).alias("a"), F.lit(b).alias("b"),
        F.try_divide(F.col("xy"), F.sqrt(F.col("xx") * F.col("yy"))).alias("corr"),
    )


def crosstab(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """Counts pivoted to one column per known value; missing pairs count 0."""
    counts = [
        F.count_if(F.col(col) == F.lit(v)).alias(f"{col}_{v}") for v in values
    ]
    return df.groupBy(row).agg(*counts)


def row_percent(df: DataFrame, row: str, col: str) -> DataFrame:
    """``row, col, n, pct``: share of each class within its group."""
    counts = category_counts(df, row, col)
    totals = counts.groupBy(F.col(row).alias("__row")).agg(F.sum("n").alias("__total"))
    joined = counts.join(totals, counts[row].eqNullSafe(totals["__row"]))
    return joined.select(row, col, "n", (F.col("n") * 100.0 / F.col("__total")).alias("pct"))


def frequency_of_frequencies(df: DataFrame, col: str) -> DataFrame:
    """How many values occur once, twice, ...: ``freq, n_values``."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("freq"))
    return counts.groupBy("freq").agg(F.count(F.lit(1)).alias("n_values"))


def element_counts(df: DataFrame, items: str, name: str = "item") -> DataFrame:
    return category_counts(df.select(F.explode(items).alias(name)), name)


def element_class_counts(df: DataFrame, items: str, cls: str, values: Sequence, name: str = "item") -> DataFrame:
    return crosstab(df.select(F.explode(items).alias(name), cls), name, cls, values)


def histogram(
    df: DataFrame,
    col: str,
    bins: int,
    above: float | None = None,
    below: float | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """``by..., bin, bin_low, bin_high, n`` with empty bins kept.

    Only values inside the open interval count. Bins of equal width run from the lowest to the
    highest such value of the whole table, and the highest value belongs to the last bin.
    """
    v = F.col(col).cast("double")
    kept = df.where(v.isNotNull())
    if above is not None:
        kept = kept.where(v > above)
    if below is not None:
        kept = kept.where(v < below)
    span = kept.agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    low, high = span.select("lo").scalar(), span.select("hi").scalar()
    place = F.floor(F.try_divide(v - low, high - low) * bins)
    counts = (
        kept.select(*by, F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy(*by, "bin")
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    groups = counts.select(*by).distinct() if by else df.sparkSession.range(1).select()
    grid = groups.select(*by, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    keys = {k: f"__key_{i}" for i, k in enumerate([*by, "bin"])}
    right = counts.withColumnsRenamed(keys)
    width = (high - low) / F.lit(float(bins))
    return grid.join(right, same_keys([(grid[k], right[a]) for k, a in keys.items()]), "left").select(
        *by,
        "bin",
        (low + F.col("bin") * width).alias("bin_low"),
        (low + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce(F.col("__n"), F.lit(0).cast("bigint")).alias("n"),
    )


def grid_counts(df: DataFrame, x: str, y: str, x_width: float, y_width: float) -> DataFrame:
    """Counts on a grid of rectangles, with their base-10 logarithm."""
    cell = lambda c, w: F.floor(F.col(c) / F.lit(float(w))).cast("bigint")
    counts = df.groupBy(cell(x, x_width).alias("x_cell"), cell(y, y_width).alias("y_cell")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.withColumn("log_n", F.log10("n"))


def density(df: DataFrame, col: str, points: int = 100) -> DataFrame:
    """Gaussian kernel density on a grid half a range wider than the data at both ends.

    Equal values are counted first. Each counted value meets the fixed grid inside its own
    task and partial sums leave only one row per grid point.
    """
    v = F.col(col).cast("double")
    kept = df.where(v.isNotNull())
    counted = kept.groupBy(v.alias("x")).agg(F.count(F.lit(1)).alias("w"))
    stats = kept.agg(
        F.count(F.lit(1)).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"),
        F.stddev_samp(v).alias("sd"),
    )
    n, lo, hi, sd = (stats.select(c).scalar() for c in ("n", "lo", "hi", "sd"))
    band = F.pow(n.cast("double"), F.lit(-0.2)) * sd
    start = lo - (hi - lo) * 0.5
    step = (hi - lo) * 2.0 / F.lit(float(points - 1))
    spread = counted.select("x", "w", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    at = start + F.col("point") * step
    kernel = F.exp(-0.5 * F.pow((F.col("x") - at) / band, F.lit(2.0)))
    sums = spread.groupBy("point").agg(F.sum(F.col("w") * kernel).alias("k"))
    norm = n * band * F.sqrt(F.lit(2.0) * F.pi())
    return sums.select("point", at.alias("x"), (F.col("k") / norm).alias("density"))


def hexagon_counts(df: DataFrame, x: str, y: str, columns: int) -> DataFrame:
    """``x_half, y_half, x, y, n, log_n``: rows per hexagon, ``columns`` of them across the values of ``x``.

    Centres lie on two square lattices, shifted by half a step against each other, and a row belongs to the nearer one of
    the two centres next to it. ``x_half`` and ``y_half`` number the centres in half steps, ``x`` and ``y`` are their values.
    Rows with a null are left out; a column with one value is one step wide.
    """
    rows_up = max(1, int(columns / math.sqrt(3)))
    kept = df.select(F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y")).dropna()
    span = kept.agg(*[f(c).alias(f"{t}{c}") for c in ("__x", "__y") for t, f in (("lo", F.min), ("hi", F.max))])
    bound = lambda name: span.select(name).scalar()
    at, step = {}, {}
    for c, n in (("__x", columns), ("__y", rows_up)):
        low, high = bound(f"lo{c}"), bound(f"hi{c}")
        step[c] = F.when(high > low, (high - low) / F.lit(float(n))).otherwise(F.lit(1.0))
        at[c] = (F.col(c) - low) / step[c]
    # As columns, so that each row works them out once.
    placed = kept.select(at["__x"].alias("u"), at["__y"].alias("v"))
    u, v = F.col("u"), F.col("v")
    square = lambda a: a * a
    near, beside = (F.floor(u + 0.5), F.floor(v + 0.5)), (F.floor(u), F.floor(v))
    first = square(u - near[0]) + 3 * square(v - near[1])
    second = square(u - beside[0] - 0.5) + 3 * square(v - beside[1] - 0.5)
    halves = [
        F.when(first < second, 2 * a).otherwise(2 * b + 1).cast("bigint").alias(name)
        for a, b, name in zip(near, beside, ("x_half", "y_half"))
    ]
    counts = placed.select(*halves).groupBy("x_half", "y_half").agg(F.count(F.lit(1)).alias("n"))
    centre = lambda name, c: bound(f"lo{c}") + F.col(name) / 2 * step[c]
    return counts.select(
        "x_half", "y_half", centre("x_half", "__x").alias("x"), centre("y_half", "__y").alias("y"), "n",
        F.log10(F.col("n").cast("double")).alias("log_n"),
    )


def density_2d(df: DataFrame, x: str, y: str, points: int = 50) -> DataFrame:
    """``x_point, y_point, x, y, density``: Gaussian kernel density of two columns on a grid of ``points`` by ``points``.

    Rows are counted on the grid first. The kernel of two columns is the product of two, so the counts are spread
    along one axis and then along the other; after the count, work depends on the grid alone. Bandwidths are
    ``n^(-1/6)`` standard deviations. Rows with a null are left out; with a column of one value the density is null.
    """
    names = {"x": x, "y": y}
    kept = df.select(*[F.col(c).cast("double").alias(a) for a, c in names.items()]).dropna()
    stats = kept.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(a).alias(f"{t}_{a}") for a in names for t, f in (("lo", F.min), ("hi", F.max), ("sd", F.stddev_samp))],
    )
    of = lambda name: stats.select(name).scalar()
    width = {a: (of(f"hi_{a}") - of(f"lo_{a}")) / F.lit(float(points)) for a in names}
    band = {a: F.pow(of("n").cast("double"), F.lit(-1.0 / 6)) * of(f"sd_{a}") for a in names}
    bins = {
        a: F.least(F.coalesce(F.floor(F.try_divide(F.col(a) - of(f"lo_{a}"), width[a])), F.lit(0)), F.lit(points - 1)).cast("int")
        for a in names
    }
    spread = kept.select(*[bins[a].alias(f"{a}_bin") for a in names]).groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).alias("w"))
    for a in names:
        gap = (F.col(f"{a}_point") - F.col(f"{a}_bin")) * width[a]
        kernel = F.exp(-0.5 * F.pow(F.try_divide(gap, band[a]), F.lit(2.0)))
        others = [c for c in spread.columns if c not in (f"{a}_bin", "w")]
        spread = (
            spread.withColumn(f"{a}_point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
            .groupBy(*others, f"{a}_point").agg(F.sum(F.col("w") * kernel).alias("w"))
        )
    norm = of("n") * band["x"] * band["y"] * F.lit(2.0) * F.pi()
    middle = {a: of(f"lo_{a}") + (F.col(f"{a}_point") + 0.5) * width[a] for a in names}
    return spread.select(
        "x_point", "y_point", *[m.alias(a) for a, m in middle.items()], F.try_divide(F.col("w"), norm).alias("density")
    )


def box_stats(df: DataFrame, col: str, by: Sequence[str] = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 quartile distances) and outlier count."""
    v = F.col(col)
    quarts = quantiles(df, [col], [0.25, 0.5, 0.75], by, hot_rows)
    if by:
        keys = {k: f"__key_{i}" for i, k in enumerate(by)}
        right = quarts.withColumnsRenamed({**keys, col: "__q"})
        rows = df.join(right, same_keys([(df[k], right[a]) for k, a in keys.items()]), "left")
        q = F.col("__q")
    else:
        rows, q = df, quarts.scalar()
    rows = rows.withColumns({"__q1": q[0], "__q2": q[1], "__q3": q[2]})
    reach = (F.col("__q3") - F.col("__q1")) * 1.5
    inside = (v >= F.col("__q1") - reach) & (v <= F.col("__q3") + reach)
    return rows.groupBy(*by).agg(
        F.max("__q1").alias("q1"), F.max("__q2").alias("median"), F.max("__q3").alias("q3"),
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def trend_slopes(df: DataFrame, by: Sequence[str], ts: str, cols: Sequence[str]) -> DataFrame:
    """Straight-line trend per group and column; x is hours since the group's first row.

    Fewer than two values, or two at one time only, have no slope, intercept and fit: null. Values that are
    all alike are fitted by a level line, whose fit is 1.
    """
    timed = with_group_stats(df, by, F.min(F.unix_seconds(ts)).alias("__start"))
    x = (F.unix_seconds(F.col(ts)) - F.col("__start")) / 3600.0
    timed = timed.withColumn("__x", x)
    sums = timed.groupBy(*by).agg(
        *[
            F.when(F.count(c) > 1, fit(F.col(c), F.col("__x"))).alias(f"{tag}{i}")
            for tag, fit in (("s", F.regr_slope), ("i", F.regr_intercept), ("r", F.regr_r2))
            for i, c in enumerate(cols)
        ],
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)],
    )
    cells = [
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n"), F.col(f"s{i}").alias("slope"),
            F.col(f"i{i}").alias("intercept"), F.col(f"r{i}").alias("r2"),
        )
        for i, c in enumerate(cols)
    ]
    return sums.select(*by, F.inline(F.array(*cells)))


def cluster_share(df: DataFrame, label: str) -> DataFrame:
    counts = category_counts(df, label)
    total = df.agg(F.count(F.lit(1)).alias("t")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def cluster_quality(df: DataFrame, label: str, cls: str) -> DataFrame:
    """Size-weighted entropy (base 2) and purity of a clustering: one row."""
    counts = category_counts(df, label, cls)
    sizes = counts.groupBy(F.col(label).alias("__label")).agg(F.sum("n").alias("size"))
    parts = counts.join(sizes, counts[label].eqNullSafe(sizes["__label"]))
    p = F.col("n") / F.col("size")
    per = parts.groupBy(label).agg(
        F.max("size").alias("size"), F.max("n").alias("top"), (-F.sum(p * F.log2(p))).alias("entropy")
    )
    return per.agg(
        (F.sum(F.col("size") * F.col("entropy")) / F.sum("size")).alias("entropy"),
        (F.sum("top") / F.sum("size")).alias("purity"),
    )


def mean_normalised(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``(x - mean) / (max - min)`` with the statistics of the row's own class."""
    aggs: list[Column] = []
    for c in cols:
        aggs += [F.avg(c).alias(f"__m_{c}"), (F.max(c) - F.min(c)).alias(f"__r_{c}")]
    rows = with_group_stats(df, by, *aggs)
    return rows.withColumns(
        {c: F.try_divide(F.col(c) - F.col(f"__m_{c}"), F.col(f"__r_{c}")) for c in cols}
    ).drop(*[f"__{t}_{c}" for c in cols for t in "mr"])


def distinct_labels(df: DataFrame, label: str, noise: int = -1) -> DataFrame:
    return df.agg(F.countDistinct(F.when(F.col(label) != noise, F.col(label))).alias("n_labels"))

