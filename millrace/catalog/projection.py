"""P1-P20."""

from pyspark.sql import functions as F

from millrace.catalog import standins as st
from millrace.catalog.registry import query
from millrace.functions import vocab
from millrace.functions.labels import (
    inverted,
    last_label,
    list_flags,
    none_set,
    recode,
    sex_status,
    with_event_flags,
    with_occupation_flags,
)
from millrace.functions.scalar import delay_band, worst_status


@query("P1_column_subset", "select c_custkey, c_mktsegment, c_acctbal from customer")
def _(t):
    return t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")


@query("P2_drop_columns", "select l_orderkey, l_quantity, l_discount, l_returnflag from lineitem")
def _(t):
    return t.lineitem.drop(
        "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_tax", "l_linestatus", "l_shipdate"
    )


@query("P3_rename_columns", "select n_nationkey as nation_id, n_name as nation from nation")
def _(t):
    return t.nation.drop("n_regionkey").withColumnsRenamed({"n_nationkey": "nation_id", "n_name": "nation"})


@query(
    "P4_cast_columns",
    """select event_id, cast(user_id as int) as user_id, cast(trunc(value) as int) as whole,
              try_cast(event_type as int) as as_int, cast(value as varchar) as as_text from events""",
)
def _(t):
    return t.events.select(
        "event_id", F.col("user_id").cast("int").alias("user_id"), F.col("value").cast("int").alias("whole"),
        F.col("event_type").try_cast("int").alias("as_int"), F.col("value").cast("string").alias("as_text"),
    )


@query(
    "P5_constant_columns",
    "select p_partkey, 0 as flag, '' as label, -1 as cluster from part",
)
def _(t):
    return t.part.select(
        "p_partkey", F.lit(0).alias("flag"), F.lit("").alias("label"), F.lit(-1).alias("cluster")
    )


@query(
    "P6_filter_sql_text",
    "select l_orderkey, l_linenumber, l_quantity, l_discount from lineitem where l_quantity > 10 and l_discount > 0",
)
def _(t):
    return t.lineitem.where("l_quantity > 10 and l_discount > 0").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount"
    )


@query(
    "P7_filter_mask",
    """select o_orderkey, o_totalprice, o_orderstatus from orders
       where (o_totalprice < 50000 or o_totalprice > 450000) and o_orderstatus <> 'P'""",
)
def _(t):
    price = F.col("o_totalprice")
    return t.orders.where(((price < 50000) | (price > 450000)) & (F.col("o_orderstatus") != "P")).select(
        "o_orderkey", "o_totalprice", "o_orderstatus"
    )


@query(
    "P8_null_predicate",
    f"with {st.CLIENTS} select client_id, sex, status from clients where status is null or sex is null",
)
def _(t):
    return st.clients(t).where(F.col("status").isNull() | F.col("sex").isNull()).select("client_id", "sex", "status")


@query(
    "P9_recode_category",
    f"""with {st.CLIENTS}
    select client_id,
           case sex when 'male' then 1 when 'female' then 0 end as sex_code,
           case education when 'others' then 0 when 'high school' then 1 when 'university' then 2
                when 'graduate school' then 3 end as education_code,
           case credit_default when 'no' then 0 when 'yes' then 1 end as default_code,
           sex as sex_back
    from clients""",
)
def _(t):
    coded = st.clients(t).select(
        "client_id", recode("sex", vocab.SEX_CODES).alias("sex_code"),
        recode("education", vocab.EDUCATION_CODES).alias("education_code"),
        recode("credit_default", vocab.DEFAULT_CODES).alias("default_code"),
    )
    return coded.withColumn("sex_back", recode("sex_code", inverted(vocab.SEX_CODES)))


_WORST = "greatest(" + ", ".join(f"ps_{m}" for m in vocab.MONTHS) + ")"


@query(
    "P10_range_recode",
    f"""with {st.CLIENTS}
    select client_id, case when {_WORST} >= 2 then 'pay_delay_more_than_2_month'
           when {_WORST} = 1 then 'pay_delay_1_month' when {_WORST} between -2 and 0 then 'pay_duly' end as delay
    from clients""",
)
def _(t):
    return st.clients(t).select("client_id", delay_band(worst_status()).alias("delay"))


_CODED = """coded as (
  select client_id, case sex when 'male' then 1 when 'female' then 0 end as sex,
         case status when 'single' then 0 when 'married' then 1 when 'others' then 2 end as status
  from clients)"""


@query(
    "P11_composite_code",
    f"""with {st.CLIENTS}, {_CODED}
    select client_id, case when sex = 1 and status = 1 then 1 when sex = 1 and status = 0 then 2
           when sex = 1 and status = 2 then 3 when sex = 0 and status = 1 then 4
           when sex = 0 and status = 0 then 5 when sex = 0 and status = 2 then 6 else 0 end as sex_status
    from coded""",
)
def _(t):
    coded = st.clients(t).select(
        "client_id", recode("sex", vocab.SEX_CODES).alias("sex"),
        recode("status", vocab.STATUS_CODES).alias("status"),
    )
    return coded.select("client_id", sex_status().alias("sex_status"))


@query(
    "P12_row_lookup",
    "select c_custkey, c_name, c_acctbal from customer where c_custkey in (0, 7, 42, 149)",
)
def _(t):
    return t.customer.where(F.col("c_custkey").isin(0, 7, 42, 149)).select("c_custkey", "c_name", "c_acctbal")


@query(
    "P13_residual_filter",
    """select p_partkey, p_type from part
       where p_type not in ('ECONOMY', 'STANDARD') and p_type not in ('SMALL', 'LARGE')""",
)
def _(t):
    groups = {"plain": ["ECONOMY", "STANDARD"], "sized": ["SMALL", "LARGE"]}
    flagged = t.part.withColumns(list_flags("p_type", groups))
    return flagged.where(none_set(list(groups))).select("p_partkey", "p_type")


@query(
    "P14_derived_columns_beside",
    """select p_partkey, p_size, p_size * 2 as p_size_double,
              case when p_size > 25 then 1 else 0 end as p_size_large from part""",
)
def _(t):
    return t.part.select(
        "p_partkey", "p_size", (F.col("p_size") * 2).alias("p_size_double"),
        (F.col("p_size") > 25).cast("int").alias("p_size_large"),
    )


@query(
    "P15_row_id",
    "select count(*) as n_rows, count(*) as n_ids from events",
)
def _(t):
    ids = t.events.select(F.monotonically_increasing_id().alias("row_id"))
    per = ids.groupBy("row_id").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_ids"))


def _like(col, words):
    return " or ".join(f"contains(lower({col}), '{w.lower()}')" for w in words)


def _in(col, words):
    return f"coalesce({col} in (" + ", ".join(f"'{w}'" for w in words) + "), false)"


def _flag_sql(col, exact, loose, rest):
    """0/1 columns: exact list, else keywords, else the rest."""
    any_exact = " or ".join(_in(col, v) for v in exact.values())
    flags = {}
    for g in {**exact, **loose}:
        e = _in(col, exact[g]) if g in exact else "false"
        k = f"coalesce({_like(col, loose[g])}, false)" if g in loose else "false"
        flags[g] = f"case when {any_exact} then cast({e} as int) else cast({k} as int) end"
    return flags, f"case when greatest({', '.join(flags.values())}) = 0 then 1 else 0 end", rest


_OCC, _OCC_REST, _OCC_NAME = _flag_sql(
    "speaker_occupation", vocab.OCCUPATION_GROUPS, vocab.OCCUPATION_KEYWORDS, vocab.OTHER_OCCUPATIONS
)
OCCUPATION_SQL = ", ".join(f"{s} as {g}" for g, s in _OCC.items()) + f", {_OCC_REST} as {_OCC_NAME}"
_EVT, _EVT_REST, _EVT_NAME = _flag_sql(
    "event", {"TED": [f"TED{y}" for y in vocab.MAIN_EVENT_YEARS]}, vocab.EVENT_KEYWORDS, vocab.OTHER_EVENTS
)
_EVT_FIXED = {**_EVT, "TED_Other": f"case when {_EVT['TED_Global']} = 1 then 0 else {_EVT['TED_Other']} end"}
#: Every flag of both groups and its SQL.
FLAG_SQL = {**_OCC, _OCC_NAME: _OCC_REST, **_EVT_FIXED, _EVT_NAME: _EVT_REST}
EVENT_SQL = ", ".join(f"{s} as {g}" for g, s in _EVT_FIXED.items()) + f", {_EVT_REST} as {_EVT_NAME}"


@query(
    "P16_list_flags",
    f"with {st.TALKS} select talk_id, "
    + ", ".join(f"cast({_in('speaker_occupation', v)} as int) as {g}" for g, v in vocab.OCCUPATION_GROUPS.items())
    + " from talks",
)
def _(t):
    return st.talks(t).select(
        "talk_id", *[c.alias(n) for n, c in list_flags("speaker_occupation", vocab.OCCUPATION_GROUPS).items()]
    )


OCCUPATION_ORDER = [*vocab.OCCUPATION_GROUPS, vocab.OTHER_OCCUPATIONS]
EVENT_ORDER = ["TED", "TEDx", "TED_Global", "TED_Other", "Non_TED_University", "Non_TED_Other"]


@query(
    "P17_label_from_flags",
    f"""with {st.TALKS}, flags as (select talk_id, {OCCUPATION_SQL} from talks)
    select talk_id, case {" ".join(f"when {g} = 1 then '{g}'" for g in reversed(OCCUPATION_ORDER))} else '' end
           as occupation from flags""",
)
def _(t):
    flagged = with_occupation_flags(st.talks(t))
    return flagged.select("talk_id", last_label(OCCUPATION_ORDER).alias("occupation"))


@query(
    "P18_flag_correction",
    f"with {st.TALKS} select talk_id, {EVENT_SQL} from talks",
)
def _(t):
    return with_event_flags(st.talks(t)).select("talk_id", *EVENT_ORDER)


@query(
    "P19_cluster_subset",
    "select vec_id, label from embeddings where label <> 3 and label <> -1",
)
def _(t):
    return t.embeddings.where((F.col("label") != 3) & (F.col("label") != -1)).select("vec_id", "label")


@query(
    "P20_misclassified_rows",
    """select doc_id, quality as label, case when n_chars > 400 then 1 else 0 end as prediction
       from documents join labels using (doc_id)
       where quality <> case when n_chars > 400 then 1 else 0 end""",
)
def _(t):
    scored = t.documents.join(t.labels, "doc_id").select(
        "doc_id", F.col("quality").alias("label"), (F.col("n_chars") > 400).cast("int").alias("prediction")
    )
    return scored.where(F.col("label") != F.col("prediction"))
