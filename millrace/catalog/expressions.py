"""X1-X27."""

from pyspark.sql import functions as F

from millrace.catalog import standins as st
from millrace.catalog.registry import query, r
from millrace.functions import scalar as x
from millrace.functions import vocab


@query("X1_quarter", "select o_orderkey, cast(quarter(o_orderdate) as int) as quarter from orders")
def _(t):
    return t.orders.select("o_orderkey", F.quarter("o_orderdate").alias("quarter"))


@query("X2_weekday_name", "select o_orderkey, dayname(o_orderdate) as weekday from orders")
def _(t):
    return t.orders.select("o_orderkey", x.weekday_name("o_orderdate").alias("weekday"))


@query("X3_hour", "select event_id, cast(hour(ts) as int) as hour from events")
def _(t):
    return t.events.select("event_id", F.hour("ts").alias("hour"))


@query(
    "X4_week_of_month",
    """select o_orderkey, cast(ceil((day(o_orderdate) + dayofweek(date_trunc('month', o_orderdate))) / 7.0) as int)
       as week from orders""",
)
def _(t):
    return t.orders.select("o_orderkey", x.week_of_month("o_orderdate").alias("week"))


@query(
    "X5_epoch_year",
    f"with {st.TALKS} select talk_id, cast(year(make_timestamp(published_date * 1000000)) as int) as year from talks",
)
def _(t):
    return st.talks(t).select("talk_id", x.epoch_year("published_date").alias("year"))


@query(
    "X6_epoch_day_text",
    f"with {st.TALKS} select talk_id, strftime(make_timestamp(published_date * 1000000), '%m/%d/%Y') as day from talks",
)
def _(t):
    return st.talks(t).select("talk_id", x.epoch_day("published_date").alias("day"))


@query(
    "X7_whole_word_count",
    r"select doc_id, cast(len(regexp_extract_all(text, '\bthe\b')) as int) as hits from documents",
)
def _(t):
    return t.documents.select("doc_id", x.word_count("text", "the").alias("hits"))


@query(
    "X8_substring_flags",
    """select doc_id, cast(contains(text, '?') as int) as question, cast(contains(text, 'The') as int) as article,
              cast(contains(lower(text), 'the') as int) as article_any from documents""",
)
def _(t):
    return t.documents.select(
        "doc_id", x.contains_flag("text", "?").alias("question"), x.contains_flag("text", "The").alias("article"),
        x.contains_flag("text", "The", any_case=True).alias("article_any"),
    )


@query(
    "X9_split_terms",
    r"""select doc_id, cast(pos - 1 as int) as pos, terms[pos] as term from (
         select doc_id, terms, unnest(range(1, len(terms) + 1)) as pos from (
           select doc_id, regexp_split_to_array(lower(text), '; |, |/| and | + ') as terms from documents))""",
)
def _(t):
    terms = t.documents.select("doc_id", F.posexplode(x.split_terms("text")).alias("pos", "term"))
    return terms


@query(
    "X10_parse_list_text",
    f"with {st.RATINGS} select talk_id, id, name, cnt as count from rating_rows",
)
def _(t):
    parsed = st.rating_texts(t).select("talk_id", x.parse_ratings("ratings").alias("ratings"))
    return parsed.select("talk_id", F.inline("ratings"))


@query("X10_parse_object_text", """select event_id, cast(json_extract(props, '$.k') as bigint) as k from events""")
def _(t):
    return t.events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


def _ratings(t):
    return st.rating_texts(t).select("talk_id", x.parse_ratings("ratings").alias("ratings"))


@query(
    "X11_array_field_sum",
    f"with {st.RATINGS} select talk_id, cast(sum(cnt) as bigint) as ratings_count from rating_rows group by 1",
)
def _(t):
    return _ratings(t).select("talk_id", x.field_sum("ratings").alias("ratings_count"))


@query(
    "X12_array_conditional_sum",
    f"""with {st.RATINGS}
    select talk_id, cast(coalesce(sum(cnt) filter (id = 7), 0) as bigint) as funny_count from rating_rows group by 1""",
)
def _(t):
    funny = x.field_sum_where("ratings", lambda e: e["id"] == vocab.FUNNY_RATING_ID)
    return _ratings(t).select("talk_id", funny.alias("funny_count"))


_TONE = """case when name in ('Fascinating', 'Informative', 'Persuasive', 'Inspiring', 'Courageous', 'Funny', 'Ingenious',
  'Jaw-dropping', 'Beautiful') then 'positive'
  when name in ('Longwinded', 'Unconvincing', 'Obnoxious', 'Confusing') then 'negative' else 'neutral' end"""


@query(
    "X13_tone_means",
    f"with {st.RATINGS} select talk_id, "
    + ", ".join(f"round(avg(cnt) filter ({_TONE} = '{k}'), 6) as {k}" for k in vocab.RATING_TONES)
    + " from rating_rows group by 1",
)
def _(t):
    return _ratings(t).select("talk_id", *[r(x.tone_mean("ratings", k)).alias(k) for k in vocab.RATING_TONES])


@query(
    "X14_array_length_mean",
    """select vec_id, cast(len(embedding) as int) as n, round(list_avg(list_transform(embedding, lambda e: e::double)), 6)
       as mean from embeddings""",
)
def _(t):
    return t.embeddings.select("vec_id", F.size("embedding").alias("n"), r(x.array_mean("embedding")).alias("mean"))


def _scaled_sql(c):
    return f"({c} - (select min({c}) from talks)) * 1.0 / ((select max({c}) from talks) - (select min({c}) from talks))"


def _scaled(df, c):
    bounds = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi"))
    return x.scaled(c, bounds.select("lo").scalar(), bounds.select("hi").scalar())


@query(
    "X15_min_max_scaled",
    f"with {st.TALKS} select talk_id, round({_scaled_sql('views')}, 6) as views_sc from talks",
)
def _(t):
    talks = st.talks(t)
    return talks.select("talk_id", r(_scaled(talks, "views")).alias("views_sc"))


@query(
    "X16_popularity",
    f"""with {st.TALKS} select talk_id, round(({_scaled_sql('views')} + {_scaled_sql('comments')}
        + {_scaled_sql('speaker_id')}) / 3, 6) as popularity from talks""",
)
def _(t):
    talks = st.talks(t)
    parts = [_scaled(talks, c) for c in ("views", "comments", "speaker_id")]
    return talks.select("talk_id", r(x.mean_of(parts)).alias("popularity"))


@query(
    "X17_funny_factor",
    f"""with {st.TALKS} select talk_id, round(({_scaled_sql('views')} + {_scaled_sql('comments')}) / 2, 6) as funny_factor,
        round({_scaled_sql('comments')}, 6) as funny_factor_single from talks""",
)
def _(t):
    talks = st.talks(t)
    parts = [_scaled(talks, c) for c in ("views", "comments")]
    return talks.select(
        "talk_id", r(x.mean_of(parts)).alias("funny_factor"), r(parts[1]).alias("funny_factor_single")
    )


@query(
    "X18_row_maximum",
    f"with {st.CLIENTS} select client_id, greatest({', '.join('ps_' + m for m in vocab.MONTHS)}) as missed_payments from clients",
)
def _(t):
    return st.clients(t).select("client_id", x.worst_status().alias("missed_payments"))


def _debts_sql():
    out, carried = [], ""
    for m, later in zip(vocab.MONTHS, vocab.MONTHS[1:]):
        carried = f"ba_{m} - pa_{later}" + (f" + {carried}" if carried else "")
        out.append((f"debt_{m}", carried))
    return out


_DEBTS = _debts_sql()
_EXPENSES = [(f"expense_{m}", f"ba_{m} - (ba_{p} - pa_{m})") for p, m in zip(vocab.MONTHS, vocab.MONTHS[1:])]


def _mean_sql(parts):
    return "(" + " + ".join(f"({p})" for p in parts) + f") / {len(parts)}.0"


@query(
    "X19_row_means_and_ratios",
    f"""with {st.CLIENTS} select client_id, """
    + ", ".join(f"round({e}, 2) as {n}" for n, e in _DEBTS + _EXPENSES)
    + f""", round({_mean_sql([e for _, e in _DEBTS])}, 4) as avg_debt,
        round({_mean_sql(['ba_' + m for m in vocab.MONTHS])}, 4) as avg_ba,
        round({_mean_sql([e for _, e in _DEBTS])} / nullif(credit_limit, 0), 4) as avg_debt_to_limit_ratio from clients""",
)
def _(t):
    rows = st.clients(t).withColumns({**x.running_debts(), **x.monthly_expenses()})
    debts, names = list(x.running_debts()), [*x.running_debts(), *x.monthly_expenses()]
    return rows.select(
        "client_id", *[r(n, 2).alias(n) for n in names], r(x.mean_of(debts), 4).alias("avg_debt"),
        r(x.mean_of([f"ba_{m}" for m in vocab.MONTHS]), 4).alias("avg_ba"),
        r(F.try_divide(x.mean_of(debts), "credit_limit"), 4).alias("avg_debt_to_limit_ratio"),
    )


@query("X20_clip_negative", "select c_custkey, greatest(c_acctbal, 0) as clipped from customer")
def _(t):
    return t.customer.select("c_custkey", x.clip_negative("c_acctbal").alias("clipped"))


@query(
    "X21_squared_log_error",
    "select event_id, round(pow(ln(value + 1) - ln(user_id + 1), 2), 6) as term from events",
)
def _(t):
    return t.events.select("event_id", r(x.squared_log_error("value", "user_id")).alias("term"))


@query("X22_residual", "select event_id, round(user_id - value, 4) as residual from events")
def _(t):
    return t.events.select("event_id", r(x.residual("user_id", "value"), 4).alias("residual"))


_ITEMS = ["p_brand", "p_type", "p_size"]


@query(
    "X23_unique_items",
    "select p_partkey, " + ", ".join(f"concat(cast({c} as varchar), '{c}_new') as {c}_new" for c in _ITEMS) + " from part",
)
def _(t):
    return t.part.select("p_partkey", *[x.unique_item(c, c).alias(f"{c}_new") for c in _ITEMS])


@query(
    "X24_basket_array",
    "select p_partkey, concat_ws('|', " + ", ".join(f"concat(cast({c} as varchar), '{c}_new')" for c in _ITEMS)
    + ") as basket from part",
)
def _(t):
    basket = F.array(*[x.unique_item(c, c) for c in _ITEMS])
    return t.part.select("p_partkey", basket.alias("items")).select(
        "p_partkey", F.array_join("items", "|").alias("basket")
    )


@query(
    "X25_item_pattern",
    "select p_partkey from part where regexp_matches(concat(p_brand, 'p_brand_new'), 'Brand#1.*p_brand_new') or "
    "regexp_matches(concat(p_type, 'p_type_new'), 'Brand#1.*p_brand_new')",
)
def _(t):
    rows = t.part.select("p_partkey", F.array(*[x.unique_item(c, c) for c in _ITEMS]).alias("items"))
    return rows.where(x.any_item_matches("items", "Brand#1.*p_brand_new")).select("p_partkey")


@query("X26_random_class")
def _(t):
    return t.orders.select("o_orderkey", x.hashed_class("o_orderkey", 3, seed=7).alias("random_class"))


@query("X27_fixed_decimals", "select p_partkey, printf('%.1f', p_retailprice) as price from part")
def _(t):
    return t.part.select("p_partkey", x.fixed_decimals("p_retailprice", 1).alias("price"))
