"""A1-A36 and U1."""

from itertools import combinations

from pyspark.sql import functions as F

from millrace.catalog import standins as st
from millrace.catalog.registry import query, r, rounded
from millrace.functions.labels import last_label, with_event_flags, with_occupation_flags
from millrace.catalog.projection import EVENT_ORDER, EVENT_SQL, OCCUPATION_ORDER, OCCUPATION_SQL
from millrace.operators import stats as op
from millrace.operators.cleaning import group_modes


@query("A1_row_count", "select count(*) as n from lineitem")
def _(t):
    return t.lineitem.agg(F.count(F.lit(1)).alias("n"))


@query("A2_category_counts", "select l_returnflag, l_linestatus, count(*) as n from lineitem group by 1, 2")
def _(t):
    return op.category_counts(t.lineitem, "l_returnflag", "l_linestatus")


@query(
    "A3_top_groups_one_measure",
    """select o_custkey, max(o_totalprice) as max_o_totalprice from orders group by 1
       order by 2 desc, 1 limit 20""",
)
def _(t):
    return op.top_groups(t.orders, "o_custkey", ["o_totalprice"], "max", 20)


@query(
    "A4_top_groups_two_measures",
    """select l_partkey, round(avg(l_extendedprice), 7) as mean_l_extendedprice,
              round(avg(l_quantity), 7) as mean_l_quantity
       from lineitem group by 1 order by avg(l_extendedprice) desc, 1 limit 25""",
)
def _(t):
    top = op.top_groups(t.lineitem, "l_partkey", ["l_extendedprice", "l_quantity"], "mean", 25)
    return rounded(top, "mean_l_extendedprice", "mean_l_quantity", digits=7)


@query(
    "A5_group_sums",
    """select dayname(o_orderdate) as weekday, round(sum(o_totalprice), 2) as sum_o_totalprice,
              count(*) as n from orders group by 1""",
)
def _(t):
    from millrace.functions.scalar import weekday_name

    dated = t.orders.select(weekday_name("o_orderdate").alias("weekday"), "o_totalprice", F.lit(1).alias("one"))
    sums = op.group_sums(dated, ["weekday"], ["o_totalprice", "one"])
    return sums.select("weekday", r("sum_o_totalprice", 2).alias("sum_o_totalprice"), F.col("sum_one").alias("n"))


@query(
    "A6_flag_sums_by_class",
    f"""with {st.TALKS}, flags as (select views, {EVENT_SQL} from talks)
    select case when views > 300000 then 2 when views > 100000 then 1 else 0 end as popularity_class, """
    + ", ".join(f"cast(sum({f}) as bigint) as sum_{f}" for f in EVENT_ORDER)
    + " from flags group by 1",
)
def _(t):
    cls = F.when(F.col("views") > 300000, 2).when(F.col("views") > 100000, 1).otherwise(0)
    flagged = with_event_flags(st.talks(t)).withColumn("popularity_class", cls)
    return op.group_sums(flagged, ["popularity_class"], EVENT_ORDER)


@query("A7_global_average", "select round(avg(o_totalprice), 4) as mean_price from orders")
def _(t):
    return t.orders.agg(r(F.avg("o_totalprice"), 4).alias("mean_price"))


@query(
    "A8_group_mean",
    "select c_mktsegment, round(avg(c_acctbal), 6) as mean_balance from customer group by 1",
)
def _(t):
    return t.customer.groupBy("c_mktsegment").agg(r(F.avg("c_acctbal")).alias("mean_balance"))


@query(
    "A9_group_mode",
    """select l_suppkey, l_linenumber as mode_line from (
         select l_suppkey, l_linenumber,
                row_number() over (partition by l_suppkey order by count(*) desc, l_linenumber) as k
         from lineitem group by 1, 2) where k = 1""",
)
def _(t):
    return group_modes(t.lineitem, "l_linenumber", ["l_suppkey"], "mode_line")


def _describe_sql(table, cols, by=""):
    head = f"{by}, " if by else ""
    tail = f" group by {by}" if by else ""
    return " union all ".join(
        f"""select {head}'{c}' as column_name, count({c}) as n, round(avg({c}), 6) as mean,
        round(stddev_samp({c}), 6) as std, cast(min({c}) as double) as min,
        round(quantile_cont({c}, 0.25), 6) as q1, round(quantile_cont({c}, 0.5), 6) as median,
        round(quantile_cont({c}, 0.75), 6) as q3, cast(max({c}) as double) as max from {table}{tail}"""
        for c in cols
    )


_DESCRIBED = ["mean", "std", "q1", "median", "q3"]


@query("A10_describe", _describe_sql("orders", ["o_totalprice"]) + " union all "
       + _describe_sql("orders", ["o_custkey"]))
def _(t):
    return rounded(op.describe(t.orders, ["o_totalprice", "o_custkey"]), *_DESCRIBED)


@query(
    "A11_min_max",
    """select min(l_extendedprice) as low_price, max(l_extendedprice) as high_price,
              min(l_quantity) as low_quantity, max(l_quantity) as high_quantity from lineitem""",
)
def _(t):
    return t.lineitem.agg(
        F.min("l_extendedprice").alias("low_price"), F.max("l_extendedprice").alias("high_price"),
        F.min("l_quantity").alias("low_quantity"), F.max("l_quantity").alias("high_quantity"),
    )


@query(
    "A12_median",
    "select event_type, round(quantile_cont(value, 0.5), 6) as median_value from events group by 1",
)
def _(t):
    from millrace.operators.ordered import quantiles

    found = quantiles(t.events, ["value"], [0.5], ["event_type"])
    return found.select("event_type", r(F.col("value")[0]).alias("median_value"))


@query(
    "A12_median_by_ranges",
    """select event_type, round(quantile_cont(case when event_type <> 'error' then value end, 0.5), 6) as median_value
       from events group by 1""",
)
def _(t):
    """The way for groups of any size, with a group that has nulls only."""
    from millrace.operators.ordered import quantiles

    rows = t.events.select("event_type", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    found = quantiles(rows, ["value"], [0.5], ["event_type"], hot_rows=0)
    return found.select("event_type", r(F.col("value")[0]).alias("median_value"))


@query(
    "A13_quantiles",
    """select round(quantile_cont(o_totalprice, 0.05), 6) as p05, round(quantile_cont(o_totalprice, 0.25), 6) as p25,
              round(quantile_cont(o_totalprice, 0.75), 6) as p75, round(quantile_cont(o_totalprice, 0.95), 6) as p95
       from orders""",
)
def _(t):
    from millrace.operators.ordered import quantiles

    probs = [0.05, 0.25, 0.75, 0.95]
    found = quantiles(t.orders, ["o_totalprice"], probs)
    return found.select(*[r(F.col("o_totalprice")[i]).alias(f"p{int(p * 100):02d}") for i, p in enumerate(probs)])


@query(
    "A14_pearson",
    f"with {st.WEATHER} select round(corr(air_temperature, sea_level_pressure), 6) as corr from weather",
)
def _(t):
    return st.weather(t).agg(r(F.corr("air_temperature", "sea_level_pressure")).alias("corr"))


_NUMBERS = ["air_temperature", "dew_temperature", "sea_level_pressure", "wind_direction", "wind_speed"]


@query(
    "A15_pearson_matrix",
    f"with {st.WEATHER} select * from ("
    + " union all ".join(
        f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as corr from weather"
        for a, b in combinations(_NUMBERS, 2)
    )
    + ")",
)
def _(t):
    return rounded(op.pearson_matrix(st.weather(t), _NUMBERS), "corr")


@query(
    "A16_spearman",
    """with ranked as (
      select rank() over (order by l_quantity) + (count(*) over (partition by l_quantity) - 1) / 2.0 as ra,
             rank() over (order by l_extendedprice) + (count(*) over (partition by l_extendedprice) - 1) / 2.0 as rb
      from lineitem)
    select 'l_quantity' as a, 'l_extendedprice' as b, round(corr(ra, rb), 6) as corr from ranked""",
)
def _(t):
    return rounded(op.spearman(t.lineitem, "l_quantity", "l_extendedprice"), "corr")


_STATUSES = ["F", "O", "P"]


@query(
    "A17_pivot_counts",
    "select o_orderpriority, "
    + ", ".join(f"count(*) filter (o_orderstatus = '{s}') as o_orderstatus_{s}" for s in _STATUSES)
    + " from orders group by 1",
)
def _(t):
    return op.crosstab(t.orders, "o_orderpriority", "o_orderstatus", _STATUSES)


@query(
    "A18_row_percent",
    """select o_orderpriority, o_orderstatus, count(*) as n,
              round(count(*) * 100.0 / sum(count(*)) over (partition by o_orderpriority), 6) as pct
       from orders group by 1, 2""",
)
def _(t):
    return rounded(op.row_percent(t.orders, "o_orderpriority", "o_orderstatus"), "pct")


@query(
    "A19_frequency_of_frequencies",
    "select freq, count(*) as n_values from (select l_partkey, count(*) as freq from lineitem group by 1) group by 1",
)
def _(t):
    return op.frequency_of_frequencies(t.lineitem, "l_partkey")


@query(
    "A20_element_counts",
    "select word, count(*) as n from (select unnest(string_split(p_name, ' ')) as word from part) group by 1",
)
def _(t):
    return op.element_counts(t.part.select(F.split("p_name", " ").alias("tags")), "tags", "word")


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "A21_element_class_counts",
    "select word, "
    + ", ".join(f"count(*) filter (p_type = '{v}') as p_type_{v}" for v in _TYPES)
    + " from (select unnest(string_split(p_name, ' ')) as word, p_type from part) group by 1",
)
def _(t):
    rows = t.part.select(F.split("p_name", " ").alias("tags"), "p_type")
    return op.element_class_counts(rows, "tags", "p_type", _TYPES, "word")


@query(
    "A22_conditional_counts",
    """select count(*) filter (o_orderstatus = 'F' and o_orderpriority = '1-URGENT') as urgent_done,
              count(*) filter (o_orderstatus = 'O' and o_totalprice > 200000) as large_open from orders""",
)
def _(t):
    status = F.col("o_orderstatus")
    return t.orders.agg(
        F.count_if((status == "F") & (F.col("o_orderpriority") == "1-URGENT")).alias("urgent_done"),
        F.count_if((status == "O") & (F.col("o_totalprice") > 200000)).alias("large_open"),
    )


@query(
    "A23_unique_values",
    "select event_type, count(*) as n from events group by 1 order by 1",
)
def _(t):
    return op.category_counts(t.events, "event_type").orderBy("event_type")


def _histogram_sql(table, col, bins, where="true", by=""):
    keys = f"{by}, " if by else ""
    on = f"g.{by} is not distinct from c.{by} and " if by else ""
    groups = f"(select distinct {by} from kept)" if by else "(select 1)"
    return f"""with kept as (select {keys}cast({col} as double) as v from {table} where {where}),
    span as (select min(v) as lo, max(v) as hi from kept),
    counts as (select {keys}least(cast(floor((v - lo) / (hi - lo) * {bins}) as int), {bins - 1}) as bin, count(*) as n
               from kept, span group by all),
    grid as (select {('x.' + by + ', ') if by else ''}cast(b as int) as bin from {groups} x, range({bins}) s(b))
    select {('g.' + by + ', ') if by else ''}g.bin, round(lo + g.bin * ((hi - lo) / {bins}), 4) as bin_low,
           round(lo + (g.bin + 1) * ((hi - lo) / {bins}), 4) as bin_high, coalesce(c.n, 0) as n
    from grid g left join counts c on {on}g.bin = c.bin, span"""


@query("A24_histogram", _histogram_sql("orders", "o_totalprice", 100, "o_totalprice > 20000 and o_totalprice < 300000"))
def _(t):
    return rounded(op.histogram(t.orders, "o_totalprice", 100, 20000, 300000), "bin_low", "bin_high", digits=4)


@query("A25_histogram_by_group", _histogram_sql("customer", "c_acctbal", 20, by="c_mktsegment"))
def _(t):
    return rounded(
        op.histogram(t.customer, "c_acctbal", 20, by=["c_mktsegment"]), "bin_low", "bin_high", digits=4
    )


@query(
    "A26_grid_counts",
    """select cast(floor(l_quantity / 5.0) as bigint) as x_cell, cast(floor(l_extendedprice / 10000.0) as bigint) as y_cell,
              count(*) as n, round(log10(count(*)), 6) as log_n from lineitem group by 1, 2""",
)
def _(t):
    return rounded(op.grid_counts(t.lineitem, "l_quantity", "l_extendedprice", 5.0, 10000.0), "log_n")


@query(
    "A26_hexagon_counts",
    """with s as (select min(l_quantity) as lx, max(l_quantity) as hx, min(l_extendedprice) as ly, max(l_extendedprice) as hy
               from lineitem),
    p as (select (l_quantity - lx) / ((hx - lx) / 30.0::double) as u, (l_extendedprice - ly) / ((hy - ly) / 17.0::double) as v
          from lineitem, s),
    d as (select *, (u - floor(u + 0.5)) * (u - floor(u + 0.5)) + 3 * ((v - floor(v + 0.5)) * (v - floor(v + 0.5))) <
                    (u - floor(u) - 0.5) * (u - floor(u) - 0.5) + 3 * ((v - floor(v) - 0.5) * (v - floor(v) - 0.5)) as on_first
          from p),
    c as (select cast(case when on_first then 2 * floor(u + 0.5) else 2 * floor(u) + 1 end as bigint) as x_half,
                 cast(case when on_first then 2 * floor(v + 0.5) else 2 * floor(v) + 1 end as bigint) as y_half, count(*) as n
          from d group by 1, 2)
    select x_half, y_half, round(lx + x_half / 2.0::double * ((hx - lx) / 30.0::double), 4) as x,
           round(ly + y_half / 2.0::double * ((hy - ly) / 17.0::double), 4) as y, n, round(log10(n), 6) as log_n
    from c, s""",
)
def _(t):
    found = op.hexagon_counts(t.lineitem, "l_quantity", "l_extendedprice", 30)
    return rounded(rounded(found, "x", "y", digits=4), "log_n")


@query(
    "A26_density_2d",
    """with s as (select count(*) as n, min(p_size) as lx, max(p_size) as hx, stddev_samp(p_size) as sx,
                      min(p_retailprice) as ly, max(p_retailprice) as hy, stddev_samp(p_retailprice) as sy from part),
    w as (select *, (hx - lx) / 40.0::double as wx, (hy - ly) / 40.0::double as wy, pow(n, -1.0 / 6) * sx as bx,
                 pow(n, -1.0 / 6) * sy as by_ from s),
    c as (select least(cast(floor((p_size - lx) / wx) as int), 39) as i, least(cast(floor((p_retailprice - ly) / wy) as int), 39) as j,
                 count(*) as k from part, w group by 1, 2),
    g as (select cast(r as int) as point from range(40) t(r)),
    h as (select a.point as x_point, b.point as y_point, sum(k * exp(-0.5 * pow((a.point - i) * wx / bx, 2))
                 * exp(-0.5 * pow((b.point - j) * wy / by_, 2))) as total from c, w, g a, g b group by 1, 2)
    select x_point, y_point, round(lx + (x_point + 0.5) * wx, 6) as x, round(ly + (y_point + 0.5) * wy, 6) as y,
           round(total / (n * bx * by_ * 2 * pi()) * 1000000, 5) as density from h, w""",
)
def _(t):
    found = op.density_2d(t.part, "p_size", "p_retailprice", 40)
    return rounded(found, "x", "y").withColumn("density", r(F.col("density") * 1000000, 5))


@query(
    "A27_density",
    """with s as (select count(c_acctbal) as n, min(c_acctbal) as lo, max(c_acctbal) as hi,
                         stddev_samp(c_acctbal) as sd from customer),
    p as (select pow(n, -0.2) * sd as band, lo - (hi - lo) * 0.5 as start, (hi - lo) * 2.0 / 99 as step, n from s),
    g as (select cast(i as int) as point, start + i * step as x, band, n from p, range(100) r(i))
    select point, round(any_value(x), 4) as x,
           round(sum(exp(-0.5 * pow((c_acctbal - x) / band, 2))) / any_value(n * band * sqrt(2 * pi())) * 1000, 6) as density
    from g, customer group by point""",
)
def _(t):
    found = op.density(t.customer, "c_acctbal", 100)
    return found.select("point", r("x", 4).alias("x"), r(F.col("density") * 1000).alias("density"))


_BOX = """with q as (select c_mktsegment, quantile_cont(c_acctbal, 0.25) as q1, quantile_cont(c_acctbal, 0.5) as q2,
                 quantile_cont(c_acctbal, 0.75) as q3 from customer group by 1),
rows as (select c.c_mktsegment, c_acctbal as v, q1, q2, q3,
                c_acctbal >= q1 - 1.5 * (q3 - q1) and c_acctbal <= q3 + 1.5 * (q3 - q1) as inside
         from customer c join q using (c_mktsegment))
select c_mktsegment, round(max(q1), 6) as q1, round(max(q2), 6) as median, round(max(q3), 6) as q3,
       min(v) filter (inside) as whisker_low, max(v) filter (inside) as whisker_high,
       count(*) filter (not inside) as n_outliers from rows group by 1"""


@query("A28_box_statistics", _BOX)
def _(t):
    return rounded(op.box_stats(t.customer, "c_acctbal", ["c_mktsegment"]), "q1", "median", "q3")


@query(
    "A28_box_statistics_overall",
    """with q as (select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as q2,
                      quantile_cont(value, 0.75) as q3 from events),
    rows as (select value as v, q1, q2, q3,
                    value >= q1 - 1.5 * (q3 - q1) and value <= q3 + 1.5 * (q3 - q1) as inside from events, q)
    select round(max(q1), 6) as q1, round(max(q2), 6) as median, round(max(q3), 6) as q3,
           min(v) filter (inside) as whisker_low, max(v) filter (inside) as whisker_high,
           count(*) filter (not inside) as n_outliers from rows""",
)
def _(t):
    return rounded(op.box_stats(t.events, "value"), "q1", "median", "q3")


@query(
    "A29_trend_slopes",
    f"""with {st.WEATHER},
    timed as (select *, (epoch(ts) - min(epoch(ts)) over (partition by site_id)) / 3600.0 as x from weather)
    select * from ("""
    + " union all ".join(
        f"""select site_id, '{c}' as column_name, count({c}) as n, case when count({c}) > 1 then round(regr_slope({c}, x), 6) end as slope,
            case when count({c}) > 1 then round(regr_intercept({c}, x), 6) end as intercept,
            case when count({c}) > 1 then round(regr_r2({c}, x), 6) end as r2 from timed group by 1"""
        for c in _NUMBERS
    )
    + ")",
)
def _(t):
    return rounded(op.trend_slopes(st.weather(t), ["site_id"], "timestamp", _NUMBERS), "slope", "intercept", "r2")


@query(
    "A30_cluster_share",
    """select label, count(*) as n, round(count(*) * 1.0 / sum(count(*)) over (), 6) as share
       from embeddings group by 1""",
)
def _(t):
    return rounded(op.cluster_share(t.embeddings, "label"), "share")


@query("A31_cluster_profile", _describe_sql("customer", ["c_acctbal", "c_nationkey"], "c_mktsegment"))
def _(t):
    return rounded(op.describe(t.customer, ["c_acctbal", "c_nationkey"], ["c_mktsegment"]), *_DESCRIBED)


@query(
    "A32_label_class_counts",
    "select c_mktsegment, c_nationkey < 12 as male, count(*) as n from customer group by 1, 2",
)
def _(t):
    return op.category_counts(t.customer.withColumn("male", F.col("c_nationkey") < 12), "c_mktsegment", "male")


_QUALITY = """with counts as (select c_nationkey, c_mktsegment, count(*) as n from customer group by 1, 2),
per as (select c_nationkey, sum(n) as size, max(n) as top,
               -sum(n / s * log2(n / s)) as entropy
        from (select *, sum(n) over (partition by c_nationkey) as s from counts) group by 1)"""


@query(
    "A33_clustering_entropy",
    _QUALITY + " select round(sum(size * entropy) / sum(size), 6) as entropy from per",
)
def _(t):
    return rounded(op.cluster_quality(t.customer, "c_nationkey", "c_mktsegment"), "entropy").select("entropy")


@query("A34_clustering_purity", _QUALITY + " select round(sum(top) / sum(size), 6) as purity from per")
def _(t):
    return rounded(op.cluster_quality(t.customer, "c_nationkey", "c_mktsegment"), "purity").select("purity")


@query(
    "A35_mean_normalised",
    """select o_orderkey, o_orderstatus, round((o_totalprice - avg(o_totalprice) over w)
              / (max(o_totalprice) over w - min(o_totalprice) over w), 6) as o_totalprice
       from orders window w as (partition by o_orderstatus)""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return rounded(op.mean_normalised(rows, ["o_totalprice"], ["o_orderstatus"]), "o_totalprice")


@query(
    "A36_count_of_column",
    f"with {st.CLIENTS} select education, count(status) as n_status from clients group by 1",
)
def _(t):
    return st.clients(t).groupBy("education").agg(F.count("status").alias("n_status"))


@query(
    "A18_label_percent_by_class",
    f"""with {st.TALKS}, flags as (select views, {OCCUPATION_SQL} from talks),
    named as (select case {" ".join(f"when {g} = 1 then '{g}'" for g in reversed(OCCUPATION_ORDER))} end as occupation,
              case when views > 300000 then 2 when views > 100000 then 1 else 0 end as popularity_class from flags)
    select occupation, popularity_class, count(*) as n,
           round(count(*) * 100.0 / sum(count(*)) over (partition by occupation), 6) as pct
    from named group by 1, 2""",
)
def _(t):
    cls = F.when(F.col("views") > 300000, 2).when(F.col("views") > 100000, 1).otherwise(0)
    flagged = with_occupation_flags(st.talks(t)).select(
        last_label(OCCUPATION_ORDER).alias("occupation"), cls.alias("popularity_class")
    )
    return rounded(op.row_percent(flagged, "occupation", "popularity_class"), "pct")


@query(
    "U1_distinct_labels",
    "select count(distinct case when label <> 0 then label end) as n_labels from embeddings",
)
def _(t):
    return op.distinct_labels(t.embeddings, "label", noise=0)
