"""F1-F10."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.catalog import standins as st
from millrace.catalog.registry import query, r, rounded
from millrace.functions.labels import dummies
from millrace.operators import features as op
from millrace.sources import bounded_rows

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "F1_string_index",
    """select o_orderkey, o_orderpriority, cast(dense_rank() over (order by o_orderpriority) - 1 as int) as code
       from orders""",
)
def _(t):
    return op.with_codes(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", "code")


@query(
    "F2_one_hot_vector",
    "select c_custkey, "
    + ", ".join(f"case when c_mktsegment = '{s}' then 1.0::double else 0.0::double end as slot_{i}" for i, s in enumerate(_SEGMENTS[:-1]))
    + " from customer",
)
def _(t):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    stages = [
        StringIndexer(inputCol="c_mktsegment", outputCol="seg", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCol="seg", outputCol="seg_vec"),
    ]
    coded = Pipeline(stages=stages).fit(t.customer).transform(t.customer)
    slots = coded.select("c_custkey", vector_to_array("seg_vec").alias("v"))
    return slots.select("c_custkey", *[F.col("v")[i].alias(f"slot_{i}") for i in range(len(_SEGMENTS) - 1)])


@query(
    "F3_dummy_columns",
    "select p_partkey, "
    + ", ".join(f"cast(p_type = '{v}' as int) as \"p_type_{v}\"" for v in ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"])
    + " from part",
)
def _(t):
    # The list of categories is fitted once; it is what train and test tables then share.
    values = [row[0] for row in bounded_rows(op.label_list(t.part, "p_type"), 1000)]
    return t.part.select("p_partkey", *[c.alias(n) for n, c in dummies("p_type", values).items()])


@query(
    "F4_assembled_vector",
    "select l_orderkey, l_linenumber, l_quantity as f0, l_discount as f1, l_tax as f2 from lineitem",
)
def _(t):
    rows = op.assembled(t.lineitem, ["l_quantity", "l_discount", "l_tax"])
    v = vector_to_array("features")
    return rows.select("l_orderkey", "l_linenumber", *[v[i].alias(f"f{i}") for i in range(3)])


@query(
    "F5_min_max_scaled",
    """select l_orderkey, l_linenumber,
       round((l_quantity - min(l_quantity) over ()) / (max(l_quantity) over () - min(l_quantity) over ()), 6) as l_quantity_sc,
       round((l_extendedprice - min(l_extendedprice) over ())
             / (max(l_extendedprice) over () - min(l_extendedprice) over ()), 6) as l_extendedprice_sc
       from lineitem""",
)
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    scaled = op.min_max(rows, ["l_quantity", "l_extendedprice"])
    return rounded(scaled, "l_quantity_sc", "l_extendedprice_sc").drop("l_quantity", "l_extendedprice")


@query(
    "F6_z_score",
    """select l_orderkey, l_linenumber,
       round((l_extendedprice - avg(l_extendedprice) over ()) / stddev_pop(l_extendedprice) over (), 6) as l_extendedprice_z
       from lineitem""",
)
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return rounded(op.z_score(rows, ["l_extendedprice"]), "l_extendedprice_z").drop("l_extendedprice")


_EDGES = ", ".join(f"quantile_cont(c_acctbal, {i / 8}) as e{i}" for i in range(1, 8))


@query(
    "F7_quantile_codes",
    f"""with e as (select {_EDGES} from customer)
    select c_custkey, {" + ".join(f"cast(c_acctbal >= e{i} as int)" for i in range(1, 8))} as c_acctbal_discr
    from customer, e""",
)
def _(t):
    return op.quantile_codes(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal"], 8).drop("c_acctbal")


@query(
    "F8_preparation_fitted",
    f"""with {st.BUILDINGS}
    select building_id, """
    + ", ".join(f"case when primary_use = '{s}' then 1.0::double else 0.0::double end as hot_{i}" for i, s in enumerate(_SEGMENTS[:-1]))
    + """, round((square_feet - min(square_feet) over ()) / (max(square_feet) over () - min(square_feet) over ()), 6) as scaled,
       cast(dense_rank() over (order by primary_use) - 1 as double) as tree_0, square_feet as tree_1
    from buildings""",
)
def _(t):
    rows = st.buildings(t)
    ready = op.preparation(["primary_use"], ["square_feet"]).fit(rows).transform(rows)
    wide = ready.select(
        "building_id", vector_to_array("features").alias("v"), vector_to_array("features_trees").alias("w")
    )
    return wide.select(
        "building_id", *[F.col("v")[i].alias(f"hot_{i}") for i in range(4)], r(F.col("v")[4]).alias("scaled"),
        F.col("w")[0].alias("tree_0"), F.col("w")[1].alias("tree_1"),
    )


@query("F9_label_list", "select distinct o_orderstatus from orders order by 1")
def _(t):
    return op.label_list(t.orders, "o_orderstatus")


@query(
    "F10_cardinalities",
    """select 'o_orderpriority' as attr, count(distinct o_orderpriority) as n_categories from orders
       union all select 'o_orderstatus', count(distinct o_orderstatus) from orders""",
)
def _(t):
    return op.cardinalities(t.orders, ["o_orderpriority", "o_orderstatus"])
