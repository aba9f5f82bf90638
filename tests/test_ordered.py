"""The way for groups too large for one task must give what the plain way gives."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import ordered, ranking, stats
from millrace.operators.features import quantile_codes


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for i in range(600):
        group = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])
        value = rng.choice([1.5, 1.5, 2.0, rng.uniform(0, 10), None])
        data.append((i, group, value))
    data += [(600, "single", 3.0), (601, "void", None), (602, "void", None)]
    return spark.createDataFrame(data, "id int, g string, x double").repartition(5).cache()


def same(a, b):
    key = lambda row: repr(row)
    left, right = (sorted((tuple(r) for r in d.collect()), key=key) for d in (a, b))
    assert len(left) == len(right)
    for one, two in zip(left, right):
        assert one == pytest.approx(two) if None not in one + two else one == two


@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles(rows, by):
    flat = lambda d: d.select(*by, *[F.round(F.col("x")[i], 9).alias(f"q{i}") for i in range(3)])
    probs = [0.1, 0.5, 0.77]
    same(flat(ordered.quantiles(rows, ["x"], probs, by)), flat(ordered.quantiles(rows, ["x"], probs, by, hot_rows=0)))


def test_groups_of_nulls_stay(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None), ("b", None), (None, None)], "g string, v double")
    for hot in (0, 10):
        got = {r.g: r.v for r in ordered.quantiles(rows, ["v"], [0.5], ["g"], hot_rows=hot).collect()}
        assert got == {"a": [1.5], "b": None, None: None}
        none = ordered.quantiles(rows.where("g = 'b'"), ["v"], [0.5], hot_rows=hot).collect()
        assert [r.v for r in none] == [None]


def test_quantiles_of_two_columns(rows):
    both = rows.withColumn("y", F.col("x") * F.col("id"))
    for by in ([], ["g"]):
        plain = ordered.quantiles(both, ["x", "y"], [0.5], by)
        split = ordered.quantiles(both, ["x", "y"], [0.5], by, hot_rows=0)
        show = lambda d: d.select(*by, F.round(F.col("x")[0], 9), F.round(F.col("y")[0], 9))
        same(show(plain), show(split))


@pytest.mark.parametrize("by", [[], ["g"]])
def test_describe_and_box_of_a_large_table(rows, by):
    """Totals of the way by ranges were scalar subqueries inside another one, which Spark can't run."""
    both = rows.withColumn("y", F.col("x") * F.col("id"))
    shown = lambda d: d.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in d.dtypes])
    same(shown(stats.describe(both, ["x", "y"], by)), shown(stats.describe(both, ["x", "y"], by, hot_rows=0)))
    same(shown(stats.box_stats(both, "x", by)), shown(stats.box_stats(both, "x", by, hot_rows=0)))


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(rows, descending):
    counts = rows.groupBy("g", "x").agg(F.count("id").alias("n")).where("x is not null")
    plain = ordered.running_before(counts, ["g"], "x", ["n"], descending)
    split = ordered.running_before(counts, ["g"], "x", ["n"], descending, hot_rows=0)
    same(plain.select("g", "x", "n", "n_before"), split.select("g", "x", "n", "n_before"))


@pytest.mark.parametrize("reach", [1, 2, 3])
def test_lags(rows, reach):
    offsets = {k: f"p{k}" for k in range(1, reach + 1)}
    plain = ordered.lags(rows, ["g"], ["id"], "x", offsets)
    split = ordered.lags(rows, ["g"], ["id"], "x", offsets, hot_rows=0)
    same(plain, split)


def test_bounds_and_classes(rows):
    assert ordered.order_bounds(rows, "x", 3) == ordered.order_bounds(rows, "x", 3, hot_rows=0)
    same(
        ranking.equal_count_classes(rows, "x", 3, "c"),
        ranking.equal_count_classes(rows, "x", 3, "c", hot_rows=0),
    )


def test_ties_at_a_third_share_the_higher_class(spark):
    seven = spark.createDataFrame([(v,) for v in [1.0, 2.0, 2.0, 3.0, 4.0, 5.0, 6.0]], "x double")
    got = {r.x: r.c for r in ranking.equal_count_classes(seven, "x", 3, "c").collect()}
    # positions int(7/3) = 2 and int(14/3) = 4 hold 2.0 and 4.0
    assert got == {1.0: 0, 2.0: 1, 3.0: 1, 4.0: 2, 5.0: 2, 6.0: 2}


def test_stratified_split_is_exact_and_stable(rows):
    kept = rows.where("g is not null").select("id", "g")
    first = ranking.stratified_split(kept, "g", "id", 0.3, 42)
    split = ranking.stratified_split(kept.repartition(3), "g", "id", 0.3, 42, hot_rows=0)
    same(first, split)
    for row in first.groupBy("g").agg(F.sum("is_test").alias("t"), F.count("id").alias("n")).collect():
        assert row.t == int(row.n * 0.3 + 0.5)


def test_folds_are_even(rows):
    kept = rows.where("g is not null").select("id", "g")
    folds = ranking.stratified_folds(kept, "g", "id", 4, 1)
    for row in folds.groupBy("g").pivot("fold", [0, 1, 2, 3]).count().na.fill(0).collect():
        sizes = list(row)[1:]
        assert max(sizes) - min(sizes) <= 1


def test_hash_split_is_stable_and_near_weights(spark):
    df = spark.range(5000)
    parts = ranking.hash_split(df, "id", [0.8, 0.2], 4)
    again = ranking.hash_split(df.repartition(7), "id", [0.8, 0.2], 4)
    same(parts, again)
    assert 0.77 < parts.where("part = 0").count() / 5000 < 0.83


def test_samples_repeat(spark):
    df = spark.range(1000)
    one = {r.id for r in ranking.sample_rows(df, "id", 10, 3).collect()}
    two = {r.id for r in ranking.sample_rows(df.repartition(9), "id", 10, 3).collect()}
    assert one == two and len(one) == 10


def test_ranks_keep_all_ties(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 4.0), (4, 3.0), (5, 3.0)], "id int, s double")
    got = {r.id: r["rank"] for r in ranking.top_ranked(df, "s", 3).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
    assert {r.id for r in ranking.top_ranked(df, "s", 4).collect()} == {1, 2, 3, 4, 5}


def test_statistics_over_ranges(rows):
    same(stats.describe(rows, ["x"], ["g"]), stats.describe(rows, ["x"], ["g"], hot_rows=0))
    same(stats.box_stats(rows, "x"), stats.box_stats(rows, "x", hot_rows=0))
    same(stats.box_stats(rows, "x", ["g"]), stats.box_stats(rows, "x", ["g"], hot_rows=0))
    same(stats.spearman(rows, "x", "id"), stats.spearman(rows, "x", "id", hot_rows=0))
    same(quantile_codes(rows, ["x"], 8), quantile_codes(rows, ["x"], 8, hot_rows=0))
