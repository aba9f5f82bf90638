"""A training corpus from raw documents: the stages in order, each over all that the one before kept.

1. ``quality``: documents that the quality classifier rejects go.
2. ``near_dedup``: of each group of near duplicates (five-word shingles, similarity 0.8 or more) the document
   with the smallest id stays; of rows with the same text, repeated ids and missing ones included, one row.
3. ``secrets``: secrets are replaced by a mark; no document goes.
4. ``mixing``: sources are mixed to their target weights; a document stands as often as it is taken.
5. ``packing``: token windows; one row per piece.

All but the last return the columns of ``documents``. Each result is written as Parquet in the shared
folder and read again. Nulls, empty texts, repeated rows and empty tables have the results the operators
state: a text without words is rejected by the first stage; rows with a null id are compared with others by their whole text only. ``n_chars``
follows the text where a secret was replaced. Extra columns are carried along.

SQL can't express the trained stages, so there is no ``ORACLE_SQL``; the tests follow each stage by brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.mixing import mixed_documents
from millrace.llm.neardup import near_duplicates, one_row_per_text, repeated_texts
from millrace.llm.packing import pack
from millrace.llm.quality_model import fit_quality_model, keep_good
from millrace.llm.secrets import redact_secrets
from millrace.llm.textkit import unused
from millrace.session import written

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, fit_quality_model(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    (name,) = unused(docs, "gone_id")
    gone = near_duplicates(docs, size=5, part=80, whole=100).where(~F.col("kept")).select(F.col("doc_id").alias(name))
    left = docs.join(gone.distinct(), docs["doc_id"].cast("long") == F.col(name), "left_anti")
    return one_row_per_text(left, repeated_texts(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs, path=F.col("source"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality), ("near_dedup", near_dedup), ("secrets", secrets), ("mixing", mixing), ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
