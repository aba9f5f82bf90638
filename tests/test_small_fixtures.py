"""Hand-made tables for rules that the shared tables do not show."""

import math

import pytest
from pyspark.sql import functions as F

from millrace.functions import scalar as x
from millrace.functions import vocab
from millrace.functions.labels import last_label, recode, with_event_flags, with_occupation_flags
from millrace.operators import cleaning, lookups, metrics, ordered, rules, stats
from millrace.operators.features import min_max, quantile_codes, z_score
from millrace.plans import credit, energy, talks


def values(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_log_error_has_no_root_and_clips(spark):
    rows = spark.createDataFrame(
        [(1.0, 2.0), (0.0, -3.0), (5.0, 5.0), (2.0, 0.5), (7.0, 9.0)], "label double, raw double"
    ).withColumn("prediction", x.clip_negative("raw"))
    got = metrics.log_errors(rows).first()
    want = sum((math.log1p(a) - math.log1p(max(p, 0))) ** 2 for a, p in [(1, 2), (0, -3), (5, 5), (2, 0.5), (7, 9)]) / 5
    assert got.msle == pytest.approx(want) and got.rmsle == pytest.approx(math.sqrt(want))


READINGS = [
    (1, "2024-01-01 05:00:00", 10.0), (1, "2024-01-08 05:00:00", 11.0), (1, "2024-01-15 05:00:00", 12.0),
    (2, "2024-01-01 05:00:00", 20.0), (2, "2024-01-15 05:00:00", 22.0), (2, "2024-01-22 05:00:00", 23.0),
]


@pytest.fixture
def readings(spark):
    df = spark.createDataFrame(READINGS, "building_id int, ts string, meter_reading double")
    return df.select("building_id", F.lit(0).alias("meter"), F.to_timestamp("ts").alias("timestamp"), "meter_reading")


def test_lag_stays_in_the_building_and_may_cross_on_request(readings):
    rows = energy.dated(readings)
    own = ordered.lags(rows, energy.LAG_KEY, ["timestamp"], "meter_reading", {1: "p"}).orderBy("building_id", "timestamp")
    assert [r.p for r in own.collect()] == [None, 10.0, 11.0, None, 20.0, 22.0]
    across = ordered.lags(
        rows, ["day_of_week", "hour"], ["building_id", "meter", "timestamp"], "meter_reading", {1: "p"}
    ).orderBy("building_id", "timestamp")
    assert [r.p for r in across.collect()] == [None, 10.0, 11.0, 12.0, 20.0, 22.0]


def test_calendar_lag_sees_the_missing_week(readings):
    got = energy.prepare_calendar(readings).orderBy("building_id", "timestamp")
    assert values(got, "prev1week_meter_reading", "prev2week_meter_reading") == [
        (None, None), (10.0, None), (11.0, 10.0), (None, None), (None, 20.0), (22.0, None)
    ]


def test_how_flag_minds_case(spark):
    rows = spark.createDataFrame([("How to",), ("this is how",), ("Why?",)], "title string")
    got = rows.select(x.contains_flag("title", "How").alias("a"), x.contains_flag("title", "how", True).alias("b"))
    assert values(got, "a", "b") == [(1, 1), (0, 1), (0, 0)]


def test_every_copy_is_dropped_and_the_outer_join_keeps_both_sides(spark):
    texts = spark.createDataFrame([(1, "a Laughter b"), (2, "x"), (3, "x"), (4, "Laughter Laughter Laughters")], "url int, t string")
    laughs = talks.laughs(texts, "url", "t")
    assert sorted(values(laughs, "url", "laughter")) == [(1, 1), (4, 2)]
    rated = spark.createDataFrame([(1, 0.5), (2, 0.1)], "url int, popularity double")
    joined = talks.with_humour(rated, laughs, "url")
    assert sorted(values(joined, "url", "funny_factor")) == [(1, 0.0), (2, 0.0), (4, 1.0)]
    again = cleaning.later_copies(texts, ["t"], "url")
    assert values(again, "url") == [(3,)]


def test_ratings_of_any_shape(spark):
    texts = [
        ("[]",), ("[{'id': 7, 'name': 'Funny', 'count': 4}]",),
        ("[{'id': 1, 'name': 'Unknown', 'count': 6}, {'id': 2, 'name': 'OK', 'count': 2}]",),
    ]
    df = spark.createDataFrame(texts, "t string").select(x.parse_ratings("t").alias("r"))
    got = df.select(
        x.field_sum("r").alias("total"), x.field_sum_where("r", lambda e: e["id"] == 7).alias("funny"),
        *[x.tone_mean("r", k).alias(k) for k in vocab.RATING_TONES],
    )
    assert values(got, "total", "funny", "positive", "negative", "neutral") == [
        (0, 0, None, None, None), (4, 4, 4.0, None, None), (8, 0, None, None, 4.0)
    ]


def test_lookup_keeps_unknown_speakers_and_skips_unknown_tags(spark):
    wide = spark.createDataFrame([("ann", 1.0, 3.0), ("bob", 2.0, 2.0)], "main_speaker string, a double, b double")
    trends = lookups.trend_table(wide, "main_speaker", ["a", "b"])
    people = spark.createDataFrame([("ann",), ("eve",)], "main_speaker string")
    assert sorted(values(lookups.lookup_trend(people, trends, "main_speaker", "t"), "main_speaker", "t")) == [
        ("ann", 2.0), ("eve", None)
    ]
    tagged = spark.createDataFrame([(1, ["ann", "zzz"]), (2, ["zzz"]), (3, [])], "id int, tags array<string>")
    means = lookups.list_trend(tagged, trends, "id", "tags", "main_speaker", "t")
    assert sorted(values(means, "id", "t")) == [(1, 2.0), (2, None), (3, None)]


def test_occupations_and_events(spark):
    rows = spark.createDataFrame(
        [("Writer", "TED2006"), ("Musician, activist", "TEDGlobal 2010"), ("Street artist", "TEDxOslo"),
         ("Beekeeper", "Harvard University"), (None, "TED@NYC"), ("Novelist", "Web Summit")],
        "speaker_occupation string, event string",
    )
    got = with_event_flags(with_occupation_flags(rows))
    assert values(got, "Literature", "Art", "Economy_Politics", "Other_Occupations") == [
        (1, 0, 0, 0), (0, 1, 1, 0), (0, 1, 0, 0), (0, 0, 0, 1), (0, 0, 0, 1), (1, 0, 0, 0)
    ]
    assert values(got, "TED", "TED_Global", "TEDx", "TED_Other", "Non_TED_University", "Non_TED_Other") == [
        (1, 0, 0, 0, 0, 0), (0, 1, 0, 0, 0, 0), (0, 0, 1, 0, 0, 0), (0, 0, 0, 0, 1, 0), (1, 0, 0, 0, 0, 0),
        (0, 0, 0, 0, 0, 1),
    ]
    flags = [*vocab.OCCUPATION_GROUPS, vocab.OTHER_OCCUPATIONS]
    names = [r.o for r in got.select(last_label(flags).alias("o")).collect()]
    assert names == ["Literature", "Economy_Politics", "Art", "Other_Occupations", "Other_Occupations", "Literature"]


def test_terms_split_on_two_blanks_but_not_on_plus(spark):
    df = spark.createDataFrame([("Poet, Singer/Actor AND x  y + z",)], "o string")
    assert df.select(x.split_terms("o")).first()[0] == ["poet", "singer", "actor", "x", "y + z"]


def test_constant_and_missing_columns(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, 2.0, None)], "id int, c double, n double")
    assert values(min_max(df, ["c"]), "c_sc") == [(0.0,), (0.0,)]
    assert values(z_score(df, ["c"]), "c_z") == [(0.0,), (0.0,)]
    assert values(cleaning.fill_mean(df, ["n"]), "n") == [(None,), (None,)]
    assert sorted(values(cleaning.null_profile(df), "column_name", "n_missing")) == [("c", 0), ("id", 0), ("n", 2)]
    assert values(quantile_codes(df, ["c"], 8), "c_discr") == [(0,), (0,)]
    bounds = df.agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    assert df.select(x.scaled("c", bounds.select("lo").scalar(), bounds.select("hi").scalar())).first()[0] is None


def test_empty_tables(spark):
    df = spark.createDataFrame([], "id int, c double, g string")
    assert cleaning.null_profile(df).where("n_missing <> 0").count() == 0
    assert cleaning.fill_group_mean(df, ["c"], ["g"]).count() == 0
    assert cleaning.drop_every_copy(df, ["c"], ["id"]).count() == 0
    assert ordered.order_bounds(df, "c", 3) == []
    assert stats.pearson_matrix(df, ["id", "c"]).first()["corr"] is None
    assert stats.category_counts(df, "g").count() == 0
    assert metrics.class_report(df.select(F.col("id").alias("label"), F.col("id").alias("prediction"))).count() == 0


def test_modes_take_the_smallest_on_ties_and_skip_null_groups(spark):
    df = spark.createDataFrame(
        [(1, "a", "y"), (2, "a", "x"), (3, "a", None), (4, "b", None)], "id int, g string, v string"
    )
    assert sorted(values(cleaning.fill_group_mode(df, "v", ["g"]), "id", "v")) == [(1, "y"), (2, "x"), (3, "x"), (4, None)]
    assert sorted(values(cleaning.fill_mode(df, "v"), "id", "v"))[3] == (4, "x")


def test_correlation_skips_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None)], "a double, b double")
    assert stats.pearson_matrix(df, ["a", "b"]).first()["corr"] == pytest.approx(1.0)


def test_sex_codes_decode_with_their_own_map(spark):
    df = spark.createDataFrame([("male",), ("female",)], "sex string")
    from millrace.functions.labels import inverted

    coded = df.withColumn("code", recode("sex", vocab.SEX_CODES))
    back = coded.withColumn("back", recode("code", inverted(vocab.SEX_CODES)))
    assert values(back, "sex", "back") == [("male", "male"), ("female", "female")]


BASKETS = [(1, ["a", "b", "c"]), (2, ["a", "b"]), (3, ["a", "c"]), (4, ["b"]), (5, ["a", "b", "d"])]


def test_rules_of_five_baskets(spark):
    baskets = spark.createDataFrame(BASKETS, "id int, items array<string>")
    model = rules.mine(baskets, 0.4, 0.5)
    sets = {tuple(r["items"]): r.freq for r in rules.itemsets(model, 5).collect()}
    assert sets == {("a", "b"): 3, ("a", "c"): 2}
    found = {(tuple(r.antecedent), r.consequent): r for r in rules.association_rules(model).collect()}
    assert found[(("c",), "a")].confidence == 1.0 and found[(("c",), "a")].lift == pytest.approx(1.25)
    assert found[(("b",), "a")].support == pytest.approx(0.6)
    counts = spark.createDataFrame([("a", 4), ("b", 4), ("c", 2)], "item string, n int")
    one = rules.apply_rules(baskets, rules.association_rules(model).where("consequent = 'a'"), counts, "id")
    assert {r.id: r.predicted for r in one.collect()} == {1: "a", 2: "a", 3: "a", 4: "a", 5: "a"}
    none = rules.apply_rules(baskets, rules.association_rules(model).where("consequent = 'c'"), counts, "id")
    assert {r.id: r.predicted for r in none.collect()} == {1: "c", 2: "c", 3: "c", 4: None, 5: "c"}


def test_thresholds_count_downwards(spark):
    df = spark.createDataFrame([(5,), (7,), (7,), (99,), (2,)], "p int")
    got = {r.threshold: r.n for r in rules.count_at_thresholds(df, F.col("p"), 4, 8).collect()}
    assert got == {4: 4, 5: 4, 6: 3, 7: 3, 8: 1}


def test_ages_without_a_valid_neighbour_take_the_table_mean(spark):
    df = spark.createDataFrame([(1, "a", 30), (2, "a", -1), (3, "b", 5)], "id int, g string, age int")
    got = cleaning.replace_invalid(df, "age", F.col("age") >= 21, ["g"])
    assert sorted(values(got, "id", "age")) == [(1, 30), (2, 30), (3, 30)]


def test_debts_run_on(spark):
    row = {f"ba_{m}": 100.0 + i for i, m in enumerate(vocab.MONTHS)}
    row |= {f"pa_{m}": 10.0 * i for i, m in enumerate(vocab.MONTHS)} | {f"ps_{m}": i for i, m in enumerate(vocab.MONTHS)}
    got = credit.derived(spark.createDataFrame([{**row, "credit_limit": 0.0}])).first()
    debts, carried = [], 0.0
    for i in range(5):
        carried += (100.0 + i) - 10.0 * (i + 1)
        debts.append(carried)
    assert got.avg_debt == pytest.approx(sum(debts) / 5) and got.missed_payments == 5
    assert got.avg_debt_to_limit_ratio is None


def test_histogram_keeps_empty_bins_and_the_top_edge(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (None,), (50.0,)], "v double")
    got = stats.histogram(df, "v", 5, above=-1, below=20).orderBy("bin").collect()
    assert [r.n for r in got] == [2, 0, 0, 0, 1]


def test_roc_of_hard_predictions(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (0, 0), (0, 1)], "label int, p int")
    assert metrics.roc_auc(df, "label", "p").first().auc == pytest.approx(0.5 * (2 / 3 - 0.5) + 0.5)
    assert metrics.roc_auc(df, "label", "p", hot_rows=0).first().auc == pytest.approx(0.5 * (2 / 3 - 0.5) + 0.5)


def test_later_copies_tell_microseconds_apart(spark):
    times = [".123456", ".123999", ".123456", ".123"]
    rows = spark.createDataFrame([(i, f"2024-01-01 05:00:00{t}") for i, t in enumerate(times)], "id int, s string")
    rows = rows.select("id", *[F.col("s").cast(k).alias(k) for k in ("timestamp", "timestamp_ntz")])
    rows = rows.withColumn("nested", F.array(F.struct("timestamp")))
    for c in ("timestamp", "timestamp_ntz", "nested"):
        assert values(cleaning.later_copies(rows, [c], "id"), "id") == [(2,)]
