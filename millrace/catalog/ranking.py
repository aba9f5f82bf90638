"""W1-W6 and T1-T6."""

from pyspark.sql import functions as F

from millrace.catalog import standins as st
from millrace.catalog.registry import query, r, rounded
from millrace.operators import ranking as op
from millrace.operators.ordered import lags, with_group_stats


@query(
    "W1_full_partition_average",
    """select event_id, round(value - avg(value) over (partition by event_type, hour(ts)), 6) as above_mean
       from events""",
)
def _(t):
    rows = t.events.select("event_id", "event_type", F.hour("ts").alias("hour"), "value")
    meaned = with_group_stats(rows, ["event_type", "hour"], F.avg("value").alias("m"))
    return meaned.select("event_id", r(F.col("value") - F.col("m")).alias("above_mean"))


@query(
    "W2_lagged_readings",
    f"""with {st.READINGS}
    select building_id, meter, strftime(ts, '%Y-%m-%d %H') as hour_text, meter_reading,
           lag(meter_reading, 1) over w as previous, lag(meter_reading, 2) over w as before_previous
    from readings window w as (partition by building_id, meter, dayname(ts) order by ts)""",
)
def _(t):
    rows = st.readings(t).withColumn("day_of_week", F.dayofweek("timestamp"))
    lagged = lags(
        rows, ["building_id", "meter", "day_of_week"], ["timestamp"], "meter_reading",
        {1: "previous", 2: "before_previous"},
    )
    return lagged.select(
        "building_id", "meter", F.date_format("timestamp", "yyyy-MM-dd HH").alias("hour_text"),
        "meter_reading", "previous", "before_previous",
    )


@query(
    "W2_lagged_by_ranges",
    f"""with {st.READINGS}
    select building_id, meter, strftime(ts, '%Y-%m-%d %H') as hour_text, meter_reading,
           lag(meter_reading, 1) over w as previous, lag(meter_reading, 2) over w as before_previous
    from readings window w as (partition by building_id, meter, dayname(ts) order by ts)""",
)
def _(t):
    rows = st.readings(t).withColumn("day_of_week", F.dayofweek("timestamp"))
    lagged = lags(
        rows, ["building_id", "meter", "day_of_week"], ["timestamp"], "meter_reading",
        {1: "previous", 2: "before_previous"}, hot_rows=0,
    )
    return lagged.select(
        "building_id", "meter", F.date_format("timestamp", "yyyy-MM-dd HH").alias("hour_text"),
        "meter_reading", "previous", "before_previous",
    )


@query(
    "W2_lag_across_buildings",
    f"""with {st.READINGS}
    select building_id, meter, strftime(ts, '%Y-%m-%d %H') as hour_text,
           lag(meter_reading, 1) over w as previous, lag(meter_reading, 2) over w as before_previous
    from readings window w as (partition by dayname(ts), hour(ts) order by building_id, meter, ts)""",
)
def _(t):
    rows = st.readings(t).withColumns({"day_of_week": F.dayofweek("timestamp"), "hour": F.hour("timestamp")})
    lagged = lags(
        rows, ["day_of_week", "hour"], ["building_id", "meter", "timestamp"], "meter_reading",
        {1: "previous", 2: "before_previous"},
    )
    return lagged.select(
        "building_id", "meter", F.date_format("timestamp", "yyyy-MM-dd HH").alias("hour_text"),
        "previous", "before_previous",
    )


@query(
    "W2_lag_by_calendar",
    f"""with {st.READINGS}
    select r.building_id, r.meter, strftime(r.ts, '%Y-%m-%d %H') as hour_text, a.meter_reading as prev1week_meter_reading,
           b.meter_reading as prev2week_meter_reading
    from readings r
    left join readings a on r.building_id = a.building_id and r.meter = a.meter and r.ts = a.ts + interval 7 days
    left join readings b on r.building_id = b.building_id and r.meter = b.meter and r.ts = b.ts + interval 14 days""",
)
def _(t):
    from millrace.plans.energy import prepare_calendar

    return prepare_calendar(st.readings(t)).select(
        "building_id", "meter", F.date_format("timestamp", "yyyy-MM-dd HH").alias("hour_text"),
        "prev1week_meter_reading", "prev2week_meter_reading",
    )


@query(
    "W3_running_balance",
    """with monthly as (select o_custkey, strftime(o_orderdate, '%Y-%m') as month,
                               round(sum(case when o_orderstatus = 'F' then -o_totalprice else o_totalprice end), 2) as net
                        from orders group by 1, 2)
    select o_custkey, month, round(sum(net) over (partition by o_custkey order by month), 2) as balance from monthly""",
)
def _(t):
    signed = F.when(F.col("o_orderstatus") == "F", -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    monthly = t.orders.groupBy("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.round(F.sum(signed), 2).alias("net")
    )
    run = op.running_total(monthly, ["o_custkey"], "month", "net", "balance")
    return run.select("o_custkey", "month", r("balance", 2).alias("balance"))


_THIRDS = """with sorted as (select o_totalprice as v, row_number() over (order by o_totalprice) - 1 as pos,
                 count(*) over () as n from orders),
cuts as (select max(v) filter (pos = cast(floor(n / 3.0) as bigint)) as c1,
                max(v) filter (pos = cast(floor(n / 3.0 + n / 3.0) as bigint)) as c2 from sorted)"""


@query(
    "W4_equal_count_thirds",
    _THIRDS + """ select o_orderkey, case when o_totalprice >= c2 then 2 when o_totalprice >= c1 then 1 else 0 end
                  as price_class from orders, cuts""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return op.equal_count_classes(rows, "o_totalprice", 3, "price_class").drop("o_totalprice")


@query(
    "W4_thirds_by_ranges",
    _THIRDS + """ select o_orderkey, case when o_totalprice >= c2 then 2 when o_totalprice >= c1 then 1 else 0 end
                  as price_class from orders, cuts""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return op.equal_count_classes(rows, "o_totalprice", 3, "price_class", hot_rows=0).drop("o_totalprice")


@query(
    "W5_fixed_threshold_class",
    """select c_custkey, case when c_acctbal >= 6000 then 2 when c_acctbal >= 1500 then 1 else 0 end as balance_class
       from customer""",
)
def _(t):
    return op.fixed_classes(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", [1500, 6000], "balance_class").drop(
        "c_acctbal"
    )


@query(
    "W6_rank_candidates",
    """select * from (select p_type, p_brand, max_size, cast(rank() over (order by max_size desc) as int) as rank
       from (select p_type, p_brand, max(p_size) as max_size from part group by 1, 2)) where rank <= 30""",
)
def _(t):
    scores = t.part.groupBy("p_type", "p_brand").agg(F.max("p_size").alias("max_size"))
    return op.top_ranked(scores, "max_size", 30)


@query(
    "T1_top_rows",
    "select l_partkey, count(*) as n from lineitem group by 1 order by 2 desc, 1 limit 10",
)
def _(t):
    counts = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return op.top_rows(counts, ["n"], 10, ties=["l_partkey"])


@query(
    "T2_sorted_groups",
    """select p_brand, round(avg(p_retailprice), 6) as mean_price, count(*) as n from part group by 1""",
)
def _(t):
    sums = t.part.groupBy("p_brand").agg(F.avg("p_retailprice").alias("mean_price"), F.count(F.lit(1)).alias("n"))
    return rounded(sums.orderBy(F.desc("mean_price"), "p_brand"), "mean_price")


@query("T3_sorted_values", "select distinct p_size from part order by 1")
def _(t):
    return op.sorted_values(t.part, "p_size")


@query("T4_random_sample")
def _(t):
    return op.sample_rows(t.customer.select("c_custkey", "c_acctbal"), "c_custkey", 10, seed=4)


@query("T5_random_split")
def _(t):
    parts = op.hash_split(t.orders.select("o_orderkey"), "o_orderkey", [0.8, 0.2], seed=4)
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query(
    "T6_stratified_split",
    """select o_orderstatus, cast(round(count(*) * 0.3) as bigint) as n_test, count(*) as n from orders group by 1""",
)
def _(t):
    marked = op.stratified_split(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", "o_orderkey", 0.3, 42)
    return marked.groupBy("o_orderstatus").agg(
        F.sum("is_test").alias("n_test"), F.count(F.lit(1)).alias("n")
    )
