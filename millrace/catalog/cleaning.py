"""M1-M12."""

from pyspark.sql import functions as F

from millrace.catalog import standins as st
from millrace.catalog.registry import exact_mean_sql, query, r, rounded
from millrace.operators import cleaning as op

_WEATHER = ["air_temperature", "dew_temperature", "sea_level_pressure", "wind_direction", "wind_speed"]
_HOURLY = ["air_temperature", "dew_temperature"]
_WEEKLY = ["sea_level_pressure", "wind_direction", "wind_speed"]
_WEEK = "cast(ceil((day(ts) + dayofweek(date_trunc('month', ts))) / 7.0) as int)"


@query(
    "M1_null_profile",
    f"with {st.WEATHER} select * from ("
    + " union all ".join(
        f"""select '{c}' as column_name, count(*) - count({c}) as n_missing,
            round((count(*) - count({c})) * 100.0 / count(*), 6) as pct_missing from weather"""
        for c in _WEATHER
    )
    + ")",
)
def _(t):
    return rounded(op.null_profile(st.weather(t), _WEATHER), "pct_missing")


@query(
    "M2_columns_with_missing",
    f"""with {st.CLIENTS}
    select column_name, n_missing from (
      select 'client_id' as column_name, count(*) - count(client_id) as n_missing from clients
      union all select 'sex', count(*) - count(sex) from clients
      union all select 'education', count(*) - count(education) from clients
      union all select 'status', count(*) - count(status) from clients
      union all select 'age', count(*) - count(age) from clients)
    where n_missing > 0""",
)
def _(t):
    rows = st.clients(t).select("client_id", "sex", "education", "status", "age")
    return op.missing_columns(rows).select("column_name", "n_missing")


@query(
    "M3_fill_constant",
    f"""with {st.CLIENTS} select client_id, coalesce(sex, 'unknown') as sex,
        coalesce(education, 'none') as education from clients""",
)
def _(t):
    return op.fill_constant(
        st.clients(t).select("client_id", "sex", "education"), {"sex": "unknown", "education": "none"}
    )


@query(
    "M4_fill_table_mean",
    f"""with {st.WEATHER}
    select site_id, strftime(ts, '%Y-%m-%d %H') as hour_text,
           round(coalesce(sea_level_pressure, (select avg(sea_level_pressure) from weather)), 6) as sea_level_pressure,
           round(coalesce(wind_speed, (select avg(wind_speed) from weather)), 6) as wind_speed
    from weather""",
)
def _(t):
    filled = op.fill_mean(st.weather(t), ["sea_level_pressure", "wind_speed"])
    return filled.select(
        "site_id", F.date_format("timestamp", "yyyy-MM-dd HH").alias("hour_text"),
        r("sea_level_pressure").alias("sea_level_pressure"), r("wind_speed").alias("wind_speed"),
    )


@query(
    "M5_fill_group_mean",
    f"""with {st.WEATHER}, dated as (select *, {_WEEK} as week, hour(ts) as hr from weather)
    select site_id, strftime(ts, '%Y-%m-%d %H') as hour_text, """
    + ", ".join(
        f"round(coalesce({c}, {exact_mean_sql(c, 'partition by site_id, week, hr')}), 6) as {c}" for c in _HOURLY
    )
    + ", "
    + ", ".join(f"round(coalesce({c}, {exact_mean_sql(c, 'partition by site_id, week')}), 6) as {c}" for c in _WEEKLY)
    + " from dated",
)
def _(t):
    from millrace.plans.energy import dated, fill_weather

    filled = fill_weather(dated(st.weather(t)))
    return filled.select(
        "site_id", F.date_format("timestamp", "yyyy-MM-dd HH").alias("hour_text"),
        *[r(c).alias(c) for c in _WEATHER],
    )


def _mode_sql(col, table, by=""):
    group = f"{by}, {col}" if by else col
    part = f"partition by {by} " if by else ""
    keep = f"{by}, {col}" if by else col
    return f"""select {keep} from (
      select {group}, row_number() over ({part}order by count(*) desc, {col}) as k
      from {table} where {col} is not null group by {group}) where k = 1"""


@query(
    "M6_fill_table_mode",
    f"""with {st.CLIENTS}
    select client_id, coalesce(sex, ({_mode_sql('sex', 'clients')})) as sex,
           coalesce(education, ({_mode_sql('education', 'clients')})) as education from clients""",
)
def _(t):
    rows = st.clients(t).select("client_id", "sex", "education")
    return op.fill_mode(op.fill_mode(rows, "sex"), "education")


@query(
    "M7_fill_group_mode",
    f"""with {st.CLIENTS}, modes as ({_mode_sql('status', 'clients', 'education, sex')})
    select client_id, c.education, c.sex, coalesce(c.status, m.status) as status
    from clients c left join modes m
      on c.education is not distinct from m.education and c.sex is not distinct from m.sex""",
)
def _(t):
    rows = st.clients(t).select("client_id", "education", "sex", "status")
    return op.fill_group_mode(rows, "status", ["education", "sex"])


@query(
    "M8_replace_invalid",
    f"""with {st.CLIENTS}
    select client_id, status, case when age >= 21 then age else cast(round(
           coalesce(avg(case when age >= 21 then age end) over (partition by status),
                    (select avg(age) from clients where age >= 21)), 0) as int) end as age from clients""",
)
def _(t):
    rows = st.clients(t).select("client_id", "status", "age")
    return op.replace_invalid(rows, "age", F.col("age") >= 21, ["status"])


@query(
    "M9_drop_missing",
    f"with {st.CLIENTS} select client_id, status from clients where status is not null",
)
def _(t):
    return op.drop_missing(st.clients(t).select("client_id", "status"), ["status"])


@query(
    "M10_drop_every_copy",
    "select text, min(doc_id) as doc_id from documents group by text having count(*) = 1",
)
def _(t):
    return op.drop_every_copy(t.documents, ["text"], keep=["doc_id"])


@query(
    "M11_later_copies",
    """select doc_id, text from (
         select doc_id, text, row_number() over (partition by text order by doc_id) as k from documents)
       where k > 1""",
)
def _(t):
    return op.later_copies(t.documents.select("doc_id", "text"), ["text"], "doc_id")



@query(
    "M12_outlier_counts",
    " union all ".join(
        f"""select '{c}' as column_name, count(*) filter (
            {c} < q1 - 1.5 * (q3 - q1) or {c} > q3 + 1.5 * (q3 - q1)) as n_outliers
            from {tab}, (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3 from {tab})"""
        for c, tab in (("value", "events"), ("user_id", "events"))
    ),
)
def _(t):
    return op.outlier_counts(t.events, ["value", "user_id"])
