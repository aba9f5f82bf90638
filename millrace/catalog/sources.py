"""S1-S11."""

from pyspark.sql import functions as F

from millrace.catalog import standins as st
from millrace.catalog.registry import query, r
from millrace.functions.scalar import any_keyword
from millrace.operators.features import assembled, min_max
from millrace.operators.stats import category_counts, pearson_matrix
from millrace.session import scratch_path
from millrace.sources import (
    bounded_rows,
    load_labelled,
    prediction_labels,
    profile,
    save_labelled,
    save_mapping,
    save_table,
    scan_csv,
    scan_csv_inferred,
    scan_csv_trimmed,
    typed,
)

LINE_COLUMNS = "l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag"


@query("S1_csv_declared_schema", f"select {LINE_COLUMNS} from lineitem")
def _(t):
    cols = LINE_COLUMNS.split(", ")
    rows = t.lineitem.select(*cols)
    path = save_table(rows, scratch_path(t.spark, "lines"))
    text = scan_csv(t.spark, path, ", ".join(f"{c} string" for c in cols))
    return typed(text, dict(rows.dtypes))


@query("S2_csv_inferred", "select doc_id, text, source from documents")
def _(t):
    rows = t.documents.select("doc_id", "text", "source")
    path = save_table(rows, scratch_path(t.spark, "texts"), rows_per_file=5000)
    return scan_csv_inferred(t.spark, path).withColumn("doc_id", F.col("doc_id").cast("bigint"))


@query("S3_csv_trimmed", "select p_partkey, p_name, p_retailprice from part")
def _(t):
    path = scratch_path(t.spark, "parts")
    padded = t.part.select(
        "p_partkey", F.concat(F.lit("  "), "p_name").alias("p_name"),
        F.concat(F.lit(" "), F.col("p_retailprice").cast("string")).alias("p_retailprice"),
    )
    padded.write.option("header", True).option("sep", ";").option("ignoreLeadingWhiteSpace", False).csv(path)
    return scan_csv_trimmed(t.spark, path, "p_partkey bigint, p_name string, p_retailprice double", ";")


@query(
    "S4_labelled_vectors_reloaded",
    "select l_quantity as label, round(l_extendedprice, 6) as f0, round(l_discount, 6) as f1 from lineitem",
)
def _(t):
    from pyspark.ml.functions import vector_to_array

    rows = assembled(t.lineitem, ["l_extendedprice", "l_discount"]).withColumnRenamed("l_quantity", "label")
    path = save_labelled(rows, scratch_path(t.spark, "labelled"))
    parts = vector_to_array(F.col("features"))
    return load_labelled(t.spark, path, 2).select("label", r(parts[0]).alias("f0"), r(parts[1]).alias("f1"))


@query(
    "S5_json_sink",
    "select o_orderkey, o_orderstatus, o_totalprice from orders",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = save_table(rows, scratch_path(t.spark, "orders"), save_as="json", partition_by=["o_orderstatus"])
    return t.spark.read.schema(rows.schema).json(path)


@query(
    "S6_enriched_sink",
    """select doc_id, lang, case when contains(lower(text), 'the') or contains(lower(text), 'und')
       then 1 else 0 end as has_article from documents""",
)
def _(t):
    flagged = t.documents.select(
        "doc_id", "lang", any_keyword("text", ["the", "und"]).cast("int").alias("has_article")
    )
    path = save_table(flagged, scratch_path(t.spark, "enriched"), save_as="parquet")
    return t.spark.read.schema(flagged.schema).parquet(path)


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "S7_correlation_sink",
    " union all ".join(
        f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as corr from lineitem"
        for i, a in enumerate(_MEASURES)
        for b in _MEASURES[i + 1 :]
    ),
)
def _(t):
    matrix = pearson_matrix(t.lineitem, _MEASURES).withColumn("corr", r("corr"))
    path = save_table(matrix, scratch_path(t.spark, "corr"), single_file=True)
    return scan_csv(t.spark, path, matrix.schema)


@query(
    "S8_prediction_sink",
    """select credit_default, count(*) as n from (
         select case when c_acctbal < 0 then 'yes' else 'no' end as credit_default from customer)
       group by 1""",
)
def _(t):
    scored = t.customer.withColumn("prediction", (F.col("c_acctbal") < 0).cast("double"))
    labels = prediction_labels(scored, "c_custkey", "prediction", "credit_default")
    path = save_table(labels, scratch_path(t.spark, "predictions"))
    return category_counts(scan_csv(t.spark, path, labels.schema), "credit_default")


@query(
    "S9_saved_mapping",
    """select attr, cast(row_number() over (partition by attr order by label) - 1 as int) as code, label
       from (select distinct 'o_orderpriority' as attr, o_orderpriority as label from orders
             union all select distinct 'o_orderstatus', o_orderstatus from orders)""",
)
def _(t):
    path = save_mapping(t.orders, ["o_orderpriority", "o_orderstatus"], scratch_path(t.spark, "mapping"))
    return t.spark.read.parquet(path)


@query(
    "S10_bounded_result",
    "select c_mktsegment, count(*) as n from customer group by 1",
)
def _(t):
    rows = bounded_rows(category_counts(t.customer, "c_mktsegment"), limit=1000)
    return t.spark.createDataFrame(rows, "c_mktsegment string, n bigint")


@query(
    "S11_table_profile",
    f"""with {st.CLIENTS}
    select * from (
      select unnest(['client_id', 'credit_limit', 'sex', 'education', 'status', 'age', 'credit_default']) as column_name,
             unnest(['bigint', 'double', 'string', 'string', 'string', 'int', 'string']) as column_type,
             count(*) as n_rows,
             unnest([count(client_id), count(credit_limit), count(sex), count(education), count(status), count(age),
                     count(credit_default)]) as n_values
      from clients)""",
)
def _(t):
    return profile(
        st.clients(t).select("client_id", "credit_limit", "sex", "education", "status", "age", "credit_default")
    )
