"""Table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header and a declared schema; a bad cell becomes null, not an error."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .csv(path)
    )


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Late casts of text columns in one projection; unreadable text gives null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def scan_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with types found by a pass over the data; cells may hold line breaks and quotes."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def scan_csv_trimmed(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ","
) -> DataFrame:
    """CSV with a chosen separator, blanks after the separator skipped."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("ignoreLeadingWhiteSpace", True)
        .option("escape", '"')
        .csv(path)
    )


def load_labelled(
    spark: SparkSession, path: str, n_features: int, features: str = "features"
) -> DataFrame:
    """Stored ``label, features`` rows; a vector of another size is an error, never a lost row."""
    from pyspark.ml.functions import vector_to_array

    df = spark.read.parquet(path)
    size = F.size(vector_to_array(F.col(features)))
    message = F.concat(F.lit(f"expected {n_features} features, found "), size.cast("string"))
    checked = F.when(size == n_features, F.col(features)).otherwise(
        F.raise_error(message).cast(df.schema[features].dataType)
    )
    return df.withColumn(features, checked)
