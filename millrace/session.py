"""Session settings, table access and durable intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T


def build_session(name: str = "millrace", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators rely on.

    Sizes of shuffles are left to AQE: it merges small partitions, splits skewed ones in
    joins and turns a join into a broadcast once the measured side is small enough.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


class Tables:
    """Parquet tables of one folder by attribute: ``Tables(spark, d).lineitem``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return _utc_instants(self.spark.read.parquet(f"{self.folder}/{name}.parquet"))


def _utc_instants(df: DataFrame) -> DataFrame:
    """Zone-less timestamps become instants; the session zone is UTC, so no clock moves."""
    casts = {
        f.name: df[f.name].cast(T.TimestampType())
        for f in df.schema.fields
        if isinstance(f.dataType, T.TimestampNTZType)
    }
    return df.withColumns(casts) if casts else df


def open_tables(spark: SparkSession, folder: str) -> Tables:
    return Tables(spark, folder)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the checkpoint folder, else one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/millrace_scratch"
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage: store ``df`` once as Parquet in the shared folder and scan it from there.

    A lost executor then re-reads files in place of redoing the work, and rows tagged with a
    partition number keep that number however often they are read.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_counting(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """``written``, with aggregates of the rows taken while they are stored: no extra pass."""
    seen = Observation()
    stored = written(df.observe(seen, *[c.alias(k) for k, c in measures.items()]), name)
    return stored, seen.get
