"""Plans: what reaches the scan, what is shuffled, and that no Python runs per row."""

import pytest

from millrace.catalog import CHECKS, QUERIES
from millrace.operators import cleaning
from millrace.session import open_tables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_no_python_and_no_cross_join_in_the_relational_queries(spark):
    for key, fn in QUERIES.items():
        if key[0] in "PMJAWTXFEU" and key in CHECKS and not key.startswith("E8"):
            text = plan(fn(spark, FOLDER))
            for word in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
                assert word not in text, (key, word)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["P6_filter_sql_text"](spark, FOLDER))
    assert "GreaterThan(l_quantity,10.0)" in text
    schema = [line for line in text.splitlines() if line.startswith("ReadSchema")][0]
    assert "l_tax" not in schema and "l_shipdate" not in schema


def test_group_fill_combines_before_the_shuffle(spark):
    df = cleaning.fill_group_mean(open_tables(spark, FOLDER).events, ["value"], ["event_type"])
    text = plan(df)
    assert "partial_avg" in text and "Window" not in text


def test_top_rows_do_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["T1_top_rows"](spark, FOLDER))


def test_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
    for id_ in ("S1 S2 S3 S4 S5 S6 S7 S8 S9 S10 S11 " + " ".join(
        [f"P{i}" for i in range(1, 21)] + [f"M{i}" for i in range(1, 13)] + [f"J{i}" for i in range(1, 12)]
        + [f"A{i}" for i in range(1, 37)] + [f"W{i}" for i in range(1, 7)] + [f"T{i}" for i in range(1, 7)]
        + ["U1"] + [f"X{i}" for i in range(1, 28)] + [f"F{i}" for i in range(1, 11)]
        + [f"L{i}" for i in range(1, 29)] + [f"E{i}" for i in range(1, 10)]
    )).split():
        assert any(k.startswith(f"{id_}_") for k in QUERIES), id_


def test_size_guards(spark):
    from millrace.sources import bounded_rows

    with pytest.raises(ValueError):
        bounded_rows(spark.range(11), limit=10)
