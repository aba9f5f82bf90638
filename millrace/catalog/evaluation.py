"""E1-E7 and E9; E8 is with the learners."""

from pyspark.sql import functions as F

from millrace.catalog.registry import query, rounded
from millrace.operators import metrics as op
from millrace.operators.ranking import equal_count_classes

# Label: class of the price. Prediction: class of the customer number.
_SCORED = """scored as (
  select case when o_totalprice >= 330000 then 2 when o_totalprice >= 160000 then 1 else 0 end as label,
         case when o_orderpriority in ('1-URGENT', '2-HIGH') then 2 when o_orderpriority = '5-LOW' then 0 else 1 end
           as prediction from orders)"""


def _scored(t):
    price, level = F.col("o_totalprice"), F.col("o_orderpriority")
    return t.orders.select(
        F.when(price >= 330000, 2).when(price >= 160000, 1).otherwise(0).alias("label"),
        F.when(level.isin("1-URGENT", "2-HIGH"), 2).when(level == "5-LOW", 0).otherwise(1).alias("prediction"),
    )


_REPORT = """per as (
  select k as class, count(*) filter (label = k and prediction = k) as hits,
         count(*) filter (prediction = k) as called, count(*) filter (label = k) as support
  from scored, (values (0), (1), (2)) c(k) group by 1),
report as (
  select class, coalesce(hits / nullif(called, 0), 0.0) as precision, coalesce(hits / nullif(support, 0), 0.0) as recall,
         coalesce(2.0 * hits / nullif(called + support, 0), 0.0) as f1, support from per)"""


@query("E1_accuracy", f"with {_SCORED} select round(avg(cast(label = prediction as int)), 6) as accuracy from scored")
def _(t):
    return rounded(op.accuracy(_scored(t)), "accuracy")


@query(
    "E2_averaged_precision",
    f"""with {_SCORED}, {_REPORT}
    select 'macro' as average, round(avg(precision), 6) as precision from report
    union all select 'micro', round((select avg(cast(label = prediction as int)) from scored), 6)
    union all select 'weighted', round(sum(precision * support) / sum(support), 6) from report""",
)
def _(t):
    return rounded(op.averaged_scores(_scored(t)), "precision").select("average", "precision")


@query(
    "E3_averaged_f1",
    f"""with {_SCORED}, {_REPORT}
    select 'macro' as average, round(avg(f1), 6) as f1 from report
    union all select 'micro', round((select avg(cast(label = prediction as int)) from scored), 6)
    union all select 'weighted', round(sum(f1 * support) / sum(support), 6) from report""",
)
def _(t):
    return rounded(op.averaged_scores(_scored(t)), "f1").select("average", "f1")


@query(
    "E4_class_report",
    f"""with {_SCORED}, {_REPORT} select class, round(precision, 6) as precision, round(recall, 6) as recall,
        round(f1, 6) as f1, support from report""",
)
def _(t):
    return rounded(op.class_report(_scored(t)), "precision", "recall", "f1")


@query(
    "E5_confusion_matrix",
    f"with {_SCORED} select label, "
    + ", ".join(f"count(*) filter (prediction = {k}) as predicted_{k}" for k in range(3))
    + " from scored group by 1",
)
def _(t):
    return op.confusion_matrix(_scored(t), [0, 1, 2])


_ROC = """steps as (
  select n_chars as threshold, count(*) filter (quality = 1) as pos, count(*) filter (quality <> 1) as neg
  from documents join labels using (doc_id) group by 1),
roc as (
  select threshold, sum(neg) over w / sum(neg) over () as fpr, sum(pos) over w / sum(pos) over () as tpr
  from steps window w as (order by threshold desc))"""


@query("E6_roc_points", f"with {_ROC} select threshold, round(fpr, 6) as fpr, round(tpr, 6) as tpr from roc")
def _(t):
    rows = t.documents.join(t.labels, "doc_id").select("quality", "n_chars")
    return rounded(op.roc_points(rows, "quality", "n_chars"), "fpr", "tpr").select("threshold", "fpr", "tpr")


@query(
    "E6_roc_area",
    f"""with {_ROC}, lagged as (select fpr, tpr, coalesce(lag(fpr) over (order by threshold desc), 0) as f0,
        coalesce(lag(tpr) over (order by threshold desc), 0) as t0 from roc)
    select round(sum((fpr - f0) * (tpr + t0) / 2), 6) as auc from lagged""",
)
def _(t):
    rows = t.documents.join(t.labels, "doc_id").select("quality", "n_chars")
    return rounded(op.roc_auc(rows, "quality", "n_chars"), "auc")


@query(
    "E6_roc_area_hard_predictions",
    """with s as (select quality, case when n_chars > 400 then 1 else 0 end as p from documents join labels using (doc_id)),
    c as (select count(*) filter (quality = 1 and p = 1) / count(*) filter (quality = 1) as tpr,
                 count(*) filter (quality = 0 and p = 1) / count(*) filter (quality = 0) as fpr from s)
    select round(fpr * tpr / 2 + (1 - fpr) * (1 + tpr) / 2, 6) as auc from c""",
)
def _(t):
    rows = t.documents.join(t.labels, "doc_id").select("quality", (F.col("n_chars") > 400).cast("int").alias("p"))
    return rounded(op.roc_auc(rows, "quality", "p"), "auc")


@query(
    "E7_log_errors",
    """select round(avg(pow(ln(value + 1) - ln(user_id + 1), 2)), 6) as msle,
              round(sqrt(avg(pow(ln(value + 1) - ln(user_id + 1), 2))), 6) as rmsle from events""",
)
def _(t):
    return rounded(op.log_errors(t.events, "value", "user_id"), "msle", "rmsle")


_NINE = """sorted as (
  select o_orderkey, o_totalprice as v, o_custkey as w, row_number() over (order by o_totalprice) - 1 as pv,
         row_number() over (order by o_custkey) - 1 as pw, count(*) over () as n from orders),
cuts as (
  select max(v) filter (pv = cast(floor(n / 3.0) as bigint)) as v1,
         max(v) filter (pv = cast(floor(n / 3.0 + n / 3.0) as bigint)) as v2,
         max(w) filter (pw = cast(floor(n / 3.0) as bigint)) as w1,
         max(w) filter (pw = cast(floor(n / 3.0 + n / 3.0) as bigint)) as w2 from sorted),
scored as (
  select case when v >= v2 then 2 when v >= v1 then 1 else 0 end as label,
         case when w >= w2 then 2 when w >= w1 then 1 else 0 end as prediction from sorted, cuts)"""


@query(
    "E9_single_attribute_classifier",
    f"""with {_NINE}, {_REPORT} select class, round(precision, 6) as precision, round(recall, 6) as recall,
        round(f1, 6) as f1, support from report""",
)
def _(t):
    rows = equal_count_classes(t.orders.select("o_totalprice", "o_custkey"), "o_totalprice", 3, "label")
    scored = equal_count_classes(rows, "o_custkey", 3, "prediction")
    return rounded(op.class_report(scored), "precision", "recall", "f1")
