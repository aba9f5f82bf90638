"""Bounded samples of labelled rows: the only rows a classifier here is fitted on."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def bounded_sample(rows: DataFrame, key: str, label: str, per_label: int, seed: int = 11) -> DataFrame:
    """At most ``per_label`` rows of each label, those with the smallest hash of ``key``.

    Give narrow rows (key and label, no texts). Rows of a large label are thinned by their hash to
    some three times the bound before they are ranked, so no label is gathered in one task.
    """
    sizes = rows.groupBy(F.col(label).alias("__label")).agg(F.count(F.lit(1)).alias("__n"))
    mark = F.xxhash64(F.lit(seed), F.col(key))
    # The hash as a number from 0 to 1.
    even = F.shiftrightunsigned(mark, 11) / F.lit(float(1 << 53))
    thin = rows.join(sizes, F.col(label) == F.col("__label")).where(even * F.col("__n") <= 3 * per_label + 100)
    place = W.partitionBy(label).orderBy(mark, key)
    ranked = thin.withColumn("__rank", F.row_number().over(place))
    return ranked.where(F.col("__rank") <= per_label).drop("__rank", "__label", "__n")


def texts_of(docs: DataFrame, sample: DataFrame, most: int, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that the sample names, with the sample's other columns.

    The sample is broadcast: ``most`` is the proven bound of its rows.
    """
    named = sample.limit(most).withColumnRenamed(key, "__key")
    return docs.join(F.broadcast(named), F.col(key) == F.col("__key")).drop("__key")


def sample_table(docs: DataFrame, named: DataFrame, most_rows: int, most_chars: int) -> pa.Table:
    """The named rows with their whole texts, in id order, as far as they stay within ``most_chars``.

    ``docs`` has ``doc_id, text``; ``named`` has ``doc_id`` and other narrow columns, at most
    ``most_rows`` rows. Both bounds hold whatever the size of the corpus.
    """
    sample = texts_of(docs.where(F.col("text").isNotNull()).select("doc_id", "text"), named, most_rows)
    sizes = sorted(map(tuple, sample.select(F.xxhash64(F.lit(5), "doc_id"), "doc_id", F.char_length("text")).collect()))
    chosen, chars = set(), 0
    for _, doc, n in sizes:
        if chars + n <= most_chars:
            chars += n
            chosen.add(doc)
    picked = docs.sparkSession.createDataFrame([(c,) for c in sorted(chosen)], "__chosen long")
    table = sample.join(F.broadcast(picked), F.col("doc_id") == F.col("__chosen")).drop("__chosen").toArrow()
    return table.sort_by([(c, "ascending") for c in table.column_names])
