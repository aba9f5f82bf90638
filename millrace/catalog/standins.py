"""Study tables derived from the shared tables, in Spark and in SQL.

``readings``, ``buildings`` and ``weather`` stand for the energy study, ``clients`` for the
credit study, ``talks`` for the talks study. Nulls and invalid values come from plain value
conditions, the same in both forms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.vocab import MONTHS
from millrace.session import Tables

MONTH_NUMBERS = dict(zip(MONTHS, range(4, 10)))


def readings(t: Tables) -> DataFrame:
    return readings_of(t.events)


def readings_of(events: DataFrame) -> DataFrame:
    hour = F.date_trunc("hour", "ts")
    return events.groupBy(
        F.col("user_id").alias("building_id"), F.col("event_type").alias("meter"), hour.alias("timestamp")
    ).agg(F.round(F.sum("value"), 2).alias("meter_reading"))


READINGS = """
readings as (
  select user_id as building_id, event_type as meter, date_trunc('hour', ts) as ts,
         round(sum(value), 2) as meter_reading
  from events group by all)"""


def dense_readings(t: Tables) -> DataFrame:
    """Readings of two buildings, with something in most hours."""
    rows = t.events.withColumn("user_id", F.col("user_id") % 2 + 1)
    return readings_of(rows)


DENSE_READINGS = READINGS.replace("user_id as", "user_id % 2 + 1 as")


def buildings(t: Tables) -> DataFrame:
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("building_id"), F.col("n_regionkey").alias("site_id"),
        F.col("c_mktsegment").alias("primary_use"), F.col("c_acctbal").alias("square_feet"),
    )


BUILDINGS = """
buildings as (
  select c_custkey as building_id, n_regionkey as site_id, c_mktsegment as primary_use,
         c_acctbal as square_feet
  from customer join nation on c_nationkey = n_nationkey)"""


def weather(t: Tables) -> DataFrame:
    sited = t.events.join(buildings(t), F.col("user_id") == F.col("building_id"))
    n, low, high = F.count(F.lit(1)), F.min("value"), F.max("value")
    return sited.groupBy("site_id", F.date_trunc("hour", "ts").alias("timestamp")).agg(
        F.when(n >= 3, F.round(F.sum("value"), 2)).alias("air_temperature"),
        F.when(n != 2, low).alias("dew_temperature"),
        F.when(low > 5, high).alias("sea_level_pressure"),
        F.when(n > 1, F.max("user_id").cast("double")).alias("wind_direction"),
        F.when(high < 150, high).alias("wind_speed"),
    )


WEATHER = (
    BUILDINGS
    + """,
weather as (
  select site_id, date_trunc('hour', ts) as ts,
         case when count(*) >= 3 then round(sum(value), 2) end as air_temperature,
         case when count(*) <> 2 then min(value) end as dew_temperature,
         case when min(value) > 5 then max(value) end as sea_level_pressure,
         case when count(*) > 1 then cast(max(user_id) as double) end as wind_direction,
         case when max(value) < 150 then max(value) end as wind_speed
  from events join buildings on user_id = building_id group by all)"""
)


def clients(t: Tables) -> DataFrame:
    month = F.month("o_orderdate")
    price = F.col("o_totalprice")
    paid = F.col("o_orderstatus") == "F"
    aggs = []
    for m, k in MONTH_NUMBERS.items():
        aggs += [
            F.round(F.sum(F.when(month == k, price)), 2).alias(f"ba_{m}"),
            F.round(F.sum(F.when((month == k) & paid, price)), 2).alias(f"pa_{m}"),
            F.count_if(month == k).alias(f"ps_{m}"),
        ]
    per = t.orders.groupBy(F.col("o_custkey").alias("client_id")).agg(
        *aggs, F.count_if(paid).alias("n_paid"), F.count_if(F.col("o_orderstatus") == "O").alias("n_open")
    )
    seg, nat, bal = F.col("c_mktsegment"), F.col("c_nationkey"), F.col("c_acctbal")
    base = t.customer.select(
        F.col("c_custkey").alias("client_id"),
        bal.alias("credit_limit"),
        F.when((seg == "BUILDING") & (bal < 0), F.lit(None).cast("string"))
        .when(nat < 12, F.lit("male")).otherwise(F.lit("female")).alias("sex"),
        F.when(seg == "AUTOMOBILE", F.lit("others")).when(seg == "BUILDING", F.lit("high school"))
        .when(seg == "FURNITURE", F.lit("university")).when(seg == "HOUSEHOLD", F.lit("graduate school"))
        .alias("education"),
        F.when(nat < 8, F.lit("single")).when(nat < 16, F.lit("married"))
        .when(nat < 22, F.lit("others")).alias("status"),
        F.floor(bal / 200).cast("int").alias("age"),
    )
    joined = base.join(per, "client_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    return joined.select(
        *base.columns,
        *[zero(f"ba_{m}") for m in MONTHS],
        *[zero(f"pa_{m}") for m in MONTHS],
        *[(F.coalesce(F.col(f"ps_{m}"), F.lit(0)) - 2).cast("int").alias(f"ps_{m}") for m in MONTHS],
        F.when(F.coalesce(F.col("n_paid") > F.col("n_open"), F.lit(False)), F.lit("yes"))
        .otherwise(F.lit("no")).alias("credit_default"),
    )


_per_month = ",\n".join(
    f"""         round(sum(case when month(o_orderdate) = {k} then o_totalprice end), 2) as ba_{m},
         round(sum(case when month(o_orderdate) = {k} and o_orderstatus = 'F' then o_totalprice end), 2) as pa_{m},
         count(*) filter (month(o_orderdate) = {k}) as ps_{m}"""
    for m, k in MONTH_NUMBERS.items()
)
CLIENTS = f"""
client_orders as (
  select o_custkey as client_id,
{_per_month},
         count(*) filter (o_orderstatus = 'F') as n_paid,
         count(*) filter (o_orderstatus = 'O') as n_open
  from orders group by 1),
clients as (
  select c_custkey as client_id, c_acctbal as credit_limit,
         case when c_mktsegment = 'BUILDING' and c_acctbal < 0 then null
              when c_nationkey < 12 then 'male' else 'female' end as sex,
         case c_mktsegment when 'AUTOMOBILE' then 'others' when 'BUILDING' then 'high school'
              when 'FURNITURE' then 'university' when 'HOUSEHOLD' then 'graduate school' end as education,
         case when c_nationkey < 8 then 'single' when c_nationkey < 16 then 'married'
              when c_nationkey < 22 then 'others' end as status,
         cast(floor(c_acctbal / 200) as int) as age,
         {", ".join(f"coalesce(ba_{m}, 0.0) as ba_{m}" for m in MONTHS)},
         {", ".join(f"coalesce(pa_{m}, 0.0) as pa_{m}" for m in MONTHS)},
         {", ".join(f"cast(coalesce(ps_{m}, 0) - 2 as int) as ps_{m}" for m in MONTHS)},
         case when coalesce(n_paid > n_open, false) then 'yes' else 'no' end as credit_default
  from customer left join client_orders on c_custkey = client_orders.client_id)"""

# Fixed stand-in values for texts the shared tables do not have.
OCCUPATIONS = {
    "1-URGENT": "Writer", "2-HIGH": "Marine biologist, explorer", "3-MEDIUM": "Music educator",
    "5-LOW": "Beekeeper",
}
EVENTS = {"F": "TED2006", "O": "TEDGlobal 2011", "P": "TEDx Oslo"}
RATING_NAMES = {1: "Funny", 2: "Inspiring", 3: "Longwinded", 4: "OK", 5: "Confusing", 6: "Brave", 7: "Funny"}


def _named(col: str, names: dict):
    out = None
    for k, v in names.items():
        test = F.col(col) == k
        out = F.when(test, F.lit(v)) if out is None else out.when(test, F.lit(v))
    return out


def rating_texts(t: Tables) -> DataFrame:
    """``talk_id, ratings``: the text of a list of ``{'id', 'name', 'count'}`` per order."""
    per = t.lineitem.groupBy(F.col("l_orderkey").alias("talk_id"), F.col("l_linenumber").alias("id")).agg(
        F.sum("l_quantity").cast("bigint").alias("count")
    )
    entry = F.concat(
        F.lit("{'id': "), F.col("id").cast("string"), F.lit(", 'name': '"), _named("id", RATING_NAMES),
        F.lit("', 'count': "), F.col("count").cast("string"), F.lit("}"),
    )
    # At most one entry per line number, so the list of an order is short.
    return per.groupBy("talk_id").agg(
        F.concat(
            F.lit("["), F.array_join(F.array_sort(F.collect_list(entry)), ", "), F.lit("]")
        ).alias("ratings")
    )


_name_case = " ".join(f"when {k} then '{v}'" for k, v in RATING_NAMES.items())
RATINGS = f"""
rating_rows as (
  select l_orderkey as talk_id, l_linenumber as id,
         case l_linenumber {_name_case} end as name, cast(sum(l_quantity) as bigint) as cnt
  from lineitem group by all)"""


def talks(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("talk_id"),
        F.floor("o_totalprice").cast("bigint").alias("views"),
        F.datediff("o_orderdate", F.lit("1990-01-01")).cast("bigint").alias("comments"),
        F.unix_seconds("o_orderdate").alias("published_date"),
        _named("o_orderpriority", OCCUPATIONS).alias("speaker_occupation"),
        _named("o_orderstatus", EVENTS).alias("event"),
        F.col("o_custkey").alias("speaker_id"),
    )


_occ = " ".join(f"when '{k}' then '{v}'" for k, v in OCCUPATIONS.items())
_evt = " ".join(f"when '{k}' then '{v}'" for k, v in EVENTS.items())
TALKS = f"""
talks as (
  select o_orderkey as talk_id, cast(floor(o_totalprice) as bigint) as views,
         date_diff('day', date '1990-01-01', cast(o_orderdate as date)) as comments,
         cast(epoch(o_orderdate) as bigint) as published_date,
         case o_orderpriority {_occ} end as speaker_occupation,
         case o_orderstatus {_evt} end as event,
         o_custkey as speaker_id
  from orders)"""
