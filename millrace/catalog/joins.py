"""J1-J9, J11 is with the rules, J10 with the neighbours."""

from pyspark.sql import functions as F

from millrace.catalog import standins as st
from millrace.catalog.registry import query, r

from millrace.functions.labels import keyword_flags, with_occupation_flags
from millrace.operators import lookups as op
from millrace.operators.cleaning import drop_every_copy
from millrace.catalog.projection import OCCUPATION_ORDER, OCCUPATION_SQL
from millrace.functions.scalar import word_count


@query(
    "J1_inner_join_one_key",
    f"""with {st.READINGS}, {st.BUILDINGS}
    select meter, primary_use, count(*) as n, round(sum(meter_reading), 4) as total
    from readings join buildings using (building_id) group by 1, 2""",
)
def _(t):
    joined = op.with_dimension(st.readings(t), st.buildings(t), "building_id")
    return joined.groupBy("meter", "primary_use").agg(
        F.count(F.lit(1)).alias("n"), r(F.sum("meter_reading"), 4).alias("total")
    )


@query(
    "J2_inner_join_two_keys",
    f"""with {st.READINGS}, {st.WEATHER}
    select building_id, meter, strftime(ts, '%Y-%m-%d %H') as hour_text, meter_reading, air_temperature
    from readings join buildings using (building_id) join weather using (ts, site_id)""",
)
def _(t):
    facts = op.with_dimension(st.readings(t), st.buildings(t), "building_id")
    return op.with_dimension(facts, st.weather(t), ["timestamp", "site_id"]).select(
        "building_id", "meter", F.date_format("timestamp", "yyyy-MM-dd HH").alias("hour_text"),
        "meter_reading", "air_temperature",
    )


@query(
    "J3_inner_join_texts",
    "select doc_id, lang, quality, toxic from documents join labels using (doc_id)",
)
def _(t):
    return op.with_dimension(t.documents.select("doc_id", "lang"), t.labels, "doc_id")



@query(
    "J4_outer_join_filled",
    r"""with once as (
      select min(doc_id) as doc_id, len(regexp_extract_all(text, '\bthe\b')) as word_hits
      from documents group by text having count(*) = 1)
    select doc_id, coalesce(word_hits, 0) as word_hits, coalesce(quality, 0) as quality
    from once full join labels using (doc_id)""",
)
def _(t):
    once = drop_every_copy(t.documents, ["text"], keep=["doc_id"])
    hits = once.select("doc_id", word_count("text", "the").cast("bigint").alias("word_hits"))
    return op.outer_filled(
        hits, t.labels.select("doc_id", "quality"), "doc_id", {"word_hits": 0, "quality": 0}
    ).select("doc_id", "word_hits", "quality")


@query(
    "J5_label_prediction_rows",
    """select o_orderkey, o_totalprice as label, cast(o_custkey as double) * 100 as prediction from orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey", F.col("o_totalprice").alias("label"),
        (F.col("o_custkey").cast("double") * 100).alias("prediction"),
    )


# Interest per customer and year of order, wide, as the interest tables are.
_YEARS = list(range(1995, 2002))
_WIDE = (
    "wide as (select o_custkey + 50 as speaker_id, "
    + ", ".join(f"coalesce(sum(o_totalprice) filter (year(o_orderdate) = {y}), 0) as y{y}" for y in _YEARS)
    + " from orders group by 1)"
)
_MEAN = "(" + " + ".join(f"y{y}" for y in _YEARS) + f") / {len(_YEARS)}.0"


def _wide(t):
    year = F.year("o_orderdate")
    return t.orders.groupBy((F.col("o_custkey") + 50).alias("speaker_id")).agg(
        *[F.coalesce(F.sum(F.when(year == y, F.col("o_totalprice"))), F.lit(0.0)).alias(f"y{y}") for y in _YEARS]
    )


@query(
    "J6_lookup_trend",
    f"""with {_WIDE}
    select c_custkey as speaker_id, round({_MEAN}, 4) as speaker_trend
    from customer left join wide on c_custkey = speaker_id""",
)
def _(t):
    trends = op.trend_table(_wide(t), "speaker_id", [f"y{y}" for y in _YEARS])
    speakers = t.customer.select(F.col("c_custkey").alias("speaker_id"))
    found = op.lookup_trend(speakers, trends, "speaker_id", "speaker_trend")
    return found.select("speaker_id", r("speaker_trend", 4).alias("speaker_trend"))


@query(
    "J7_list_trend",
    """with words as (select p_partkey, unnest(string_split(p_name, ' ')) as word, p_size from part),
    trends as (select case word when 'ring' then 'no such tag' else word end as word, avg(p_size) as trend
      from words group by 1)
    select p_partkey, round(avg(trend), 6) as tags_trend
    from (select p_partkey, unnest(string_split(p_name, ' ')) as word from part) left join trends using (word)
    group by 1""",
)
def _(t):
    parts = t.part.select("p_partkey", F.split("p_name", " ").alias("tags"), "p_size")
    words = parts.select(F.explode("tags").alias("word"), "p_size")
    words = words.withColumn("word", F.when(F.col("word") == "ring", "no such tag").otherwise(F.col("word")))
    trends = words.groupBy("word").agg(F.avg("p_size").alias("trend"))
    found = op.list_trend(parts, trends, "p_partkey", "tags", "word", "tags_trend")
    return found.select("p_partkey", r("tags_trend").alias("tags_trend"))


_TOPICS = {
    "articles": ["the", "der", "una"], "licence": ["license", "copyright"], "contact": ["@", "tel"],
    "junk": ["click", "lorem", "http"],
}


@query(
    "J8_keyword_categories",
    "select doc_id, "
    + ", ".join(
        "cast(" + " or ".join(f"contains(lower(text), '{w}')" for w in ws) + f" as int) as {g}"
        for g, ws in _TOPICS.items()
    )
    + " from documents",
)
def _(t):
    return t.documents.select("doc_id", *[c.alias(n) for n, c in keyword_flags("text", _TOPICS).items()])


@query(
    "J8_occupation_categories",
    f"with {st.TALKS} select talk_id, {OCCUPATION_SQL} from talks",
)
def _(t):
    return with_occupation_flags(st.talks(t)).select("talk_id", *OCCUPATION_ORDER)


@query(
    "J9_write_back_predictions",
    """select doc_id, lang, coalesce(case when n_chars > 400 then 1 else 0 end * quality, -1) as predicted
       from documents left join labels using (doc_id)""",
)
def _(t):
    scored = t.labels.join(t.documents, "doc_id").select(
        "doc_id", ((F.col("n_chars") > 400).cast("int") * F.col("quality")).alias("predicted")
    )
    return op.write_back(t.documents.select("doc_id", "lang"), scored, "doc_id", missing=-1)
