"""Scans and sinks beyond what the queries cover."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators.features import assembled
from millrace.session import scratch_path, shared_dir
from millrace.sources import load_labelled, save_labelled, save_table, scan_csv, scan_csv_inferred, typed


def test_bad_cells_become_null(spark):
    path = scratch_path(spark, "cells")
    save_table(spark.createDataFrame([("1", "2.5"), ("", "x")], "a string, b string"), path)
    text = scan_csv(spark, path, "a string, b string")
    got = sorted(typed(text, {"a": "int", "b": "double"}).collect(), key=repr)
    assert [tuple(r) for r in got] == [(1, 2.5), (None, None)]


def test_cells_with_line_breaks_and_quotes(spark):
    path = scratch_path(spark, "lines")
    rows = [(1, 'she said "hi",\nthen left'), (2, "plain")]
    save_table(spark.createDataFrame(rows, "id int, t string"), path, single_file=True)
    assert sorted(tuple(r) for r in scan_csv_inferred(spark, path).collect()) == rows


def test_files_of_few_rows_give_the_same_rows(spark):
    path = scratch_path(spark, "few")
    rows = [(k, f'line {k},\n"quoted"') for k in range(10)]
    save_table(spark.createDataFrame(rows, "id int, t string").coalesce(1), path, rows_per_file=3)
    found = scan_csv_inferred(spark, path)
    assert found.select(F.input_file_name()).distinct().count() == 4
    assert sorted(tuple(r) for r in found.collect()) == rows


def test_vector_of_another_size_is_an_error(spark):
    df = assembled(spark.range(3).withColumn("label", F.lit(1.0)), ["id", "label"])
    path = save_labelled(df, scratch_path(spark, "vectors"))
    assert load_labelled(spark, path, 2).count() == 3
    with pytest.raises(PySparkException):
        load_labelled(spark, path, 3).collect()


def test_unknown_format_is_refused(spark):
    with pytest.raises(ValueError):
        save_table(spark.range(1), scratch_path(spark, "x"), save_as="xml")


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_path(spark, "a").startswith(shared_dir(spark))
