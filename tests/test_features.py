"""Numbered vocabularies, one-valued categories, hexagons and two-dimensional densities against plain versions."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import features as op
from millrace.operators import stats
from millrace.plans import talks


def test_codes_are_alphabetical_over_many_ranges(spark):
    labels = [f"{k % 97:02d}-{k}" for k in range(3000)]
    df = spark.createDataFrame([(x, f"b{i % 5}", None if i % 7 else "only") for i, x in enumerate(labels)], "a string, b string, c string")
    df = df.unionByName(df).repartition(6)
    got = {(r["attr"], r["label"]): r["code"] for r in op.category_codes(df, ["a", "b", "c"]).collect()}
    want = {("a", x): i for i, x in enumerate(sorted(labels))} | {("b", f"b{i}"): i for i in range(5)} | {("c", "only"): 0}
    assert got == want
    assert op.category_codes(df.where("a = 'none'"), ["a"]).collect() == []


def test_new_labels_come_behind_and_unseen_ones_have_a_slot(spark):
    old = spark.createDataFrame([("m",), ("c",), (None,)], "a string")
    codes = op.category_codes(old, ["a"])
    more = spark.createDataFrame([("b",), ("m",), ("z",), (None,), ("a",)], "a string")
    extended = {r["label"]: r["code"] for r in op.extended_codes(codes, more).collect()}
    assert extended == {"c": 0, "m": 1, "a": 2, "b": 3, "z": 4}
    seen = {r["a"]: r["code"] for r in op.with_codes(more, "a", "code", codes, unseen=True).collect()}
    assert seen == {"m": 1, "a": 2, "b": 2, "z": 2, None: None}
    missing = {r["a"]: r["code"] for r in op.with_codes(more, "a", "code", codes).collect()}
    assert missing == {"m": 1, "a": None, "b": None, "z": None, None: None}


def test_a_category_with_one_value_has_no_slot(spark):
    df = spark.createDataFrame([("x", "u", 1.0), ("x", "v", 2.0), ("x", "w", 5.0)], "one string, three string, n double")
    assert op.constant_columns(df, ["one", "three"]) == ["one"]
    rows = op.preparation(["one", "three"], ["n"], ["one"]).fit(df).transform(df).orderBy("n").collect()
    assert [list(r["features"]) for r in rows] == [[1.0, 0.0, 0.0], [0.0, 1.0, 0.25], [0.0, 0.0, 1.0]]
    assert [list(r["features_trees"]) for r in rows] == [[0.0, 0.0, 1.0], [0.0, 1.0, 2.0], [0.0, 2.0, 5.0]]
    alone = op.preparation(["one"], ["n"], ["one"]).fit(df).transform(df).orderBy("n").collect()
    assert [list(r["features"]) for r in alone] == [[0.0], [0.25], [1.0]]


def test_energy_models_go_without_a_measure_missing_everywhere(spark, tmp_path):
    """Where no hour of a site has only values over 5, one measure of the weather is null throughout, and the assembler failed."""
    from millrace.catalog import QUERIES

    events = [
        (f"2024-01-{day:02d} 12:00:00", user, ("view", "click")[user % 2], 1.0 + 10 * user + day % 3) for day in range(1, 31) for user in range(6)
    ]
    tables = {
        "events": spark.createDataFrame(events, "ts string, user_id long, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz")),
        "customer": spark.createDataFrame(
            [(k, 0, 100.0 * k, ("A", "B")[k % 2]) for k in range(6)], "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"
        ),
        "nation": spark.createDataFrame([(0, 0)], "n_nationkey int, n_regionkey int"),
    }
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    rows = QUERIES["energy_model_errors"](spark, str(tmp_path)).collect()
    assert len(rows) == 6 and all(r.msle >= 0 for r in rows)
    some = spark.createDataFrame([(1.0, None, None), (None, None, 2.0)], "a double, b double, c double")
    assert op.empty_columns(some, ["a", "b", "c"]) == ["b"]


def test_each_row_is_in_the_nearest_hexagon(spark):
    rng = random.Random(4)
    rows = [(rng.gauss(0, 3), rng.random() * 50) for _ in range(400)]
    df = spark.createDataFrame([*rows, (None, 1.0), (1.0, None)], "x double, y double")
    got = {(r["x_half"], r["y_half"]): r for r in stats.hexagon_counts(df, "x", "y", 12).collect()}
    lows, highs = np.array(rows).min(0), np.array(rows).max(0)
    step = (highs - lows) / np.array([12, int(12 / math.sqrt(3))])
    want = Counter()
    for row in rows:
        at = (np.array(row) - lows) / step
        centres = [(a, b) for a in range(0, 27) for b in range(0, 17) if a % 2 == b % 2]
        want[min(centres, key=lambda c: (at[0] - c[0] / 2) ** 2 + 3 * (at[1] - c[1] / 2) ** 2)] += 1
    assert {k: r["n"] for k, r in got.items()} == dict(want)
    for (a, b), r in got.items():
        assert (r["x"], r["y"]) == pytest.approx(tuple(lows + np.array([a, b]) / 2 * step))
        assert r["log_n"] == pytest.approx(math.log10(r["n"]))


def test_density_of_two_columns(spark):
    rng = np.random.default_rng(5)
    values = rng.normal(0, 1, (300, 2)) @ np.array([[2.0, 1.0], [0.0, 3.0]])
    df = spark.createDataFrame([tuple(map(float, v)) for v in values] + [(None, 1.0)], "x double, y double")
    got = {(r["x_point"], r["y_point"]): r for r in stats.density_2d(df, "x", "y", 20).collect()}
    assert len(got) == 400
    low, high, sd = values.min(0), values.max(0), values.std(0, ddof=1)
    width, band = (high - low) / 20, 300 ** (-1 / 6) * sd
    bins = np.minimum(((values - low) / width).astype(int), 19)
    for (i, j), r in got.items():
        gaps = (np.array([i, j]) - bins) * width / band
        assert r["density"] == pytest.approx(np.exp(-0.5 * gaps**2).prod(1).sum() / (300 * band.prod() * 2 * math.pi), rel=1e-9)
    same = stats.density_2d(df.select(F.lit(1.0).alias("x"), "y"), "x", "y", 3).collect()
    assert same and all(r["density"] is None for r in same)
    assert stats.density_2d(df.where("x > 99"), "x", "y", 3).collect() == []


def test_transcripts_without_a_talk_stay(spark):
    rated = spark.createDataFrame(
        [(i, 10 * i, i, f"[{{'id': 1, 'name': 'Funny', 'count': {i}}}]", "TED2006", "Writer" if i else None, 86_400 * i, f"How {i}?") for i in range(4)],
        "url long, views long, comments long, ratings string, event string, speaker_occupation string, published_date long, title string",
    )
    spoken = spark.createDataFrame([(1, "(Laughter) a"), (2, "b"), (9, "(Laughter) (Laughter)")], "url long, transcript string")
    rows = {r["url"]: r for r in talks.features(rated, spoken, "url", "transcript").collect()}
    assert set(rows) == {0, 1, 2, 3, 9}
    lone = rows[9]
    assert lone["funny_factor"] == 1.0 and lone["popularity"] is None and lone["popularity_class"] is None
    assert lone["Other_Occupations"] == 1 and lone["Non_TED_Other"] == 1
    assert all(lone[c] == 0 for c in talks.FLAGS if c not in ("Other_Occupations", "Non_TED_Other"))
    assert rows[0]["speaker_occupation"] == "Writer" and rows[0]["funny_factor"] == 0.0
    assert len(talks.ATTRIBUTES) == 27


def test_occupation_flags_lower_a_text_once_and_find_parts_of_any_case(spark):
    from millrace.functions import vocab
    from millrace.functions.labels import with_occupation_flags

    rows = [("Writer",), ("MARINE BIOlogist",), ("a.c\nLAW (x)",), ("",), (None,)]
    rows = spark.createDataFrame(rows, "speaker_occupation string").repartition(1)
    flagged = with_occupation_flags(rows)
    names = [*vocab.OCCUPATION_GROUPS, vocab.OTHER_OCCUPATIONS]
    found = {r["speaker_occupation"]: [n for n in names if r[n] == 1] for r in flagged.collect()}
    assert found == {
        "Writer": ["Literature"], "MARINE BIOlogist": ["Engineering_Science"], "a.c\nLAW (x)": ["Economy_Politics"],
        "": [vocab.OTHER_OCCUPATIONS], None: [vocab.OTHER_OCCUPATIONS],
    }
    steps = flagged._jdf.queryExecution().optimizedPlan().toString()
    assert steps.count("lower(") == 1
