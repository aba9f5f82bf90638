"""L15-L19 and J11, on baskets of part types and return flags per order."""

from pyspark.sql import functions as F

from millrace.catalog import standins as st
from millrace.catalog.registry import query, r, rounded
from millrace.functions.scalar import unique_item
from millrace.operators import rules as op
from millrace.session import written

_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_FLAGS = ["A", "N", "R"]
# Alphabetical, so a bit mask read upwards names its items in order.
ITEMS = sorted([f"{v}p_type_new" for v in _TYPES] + [f"{v}l_returnflag_new" for v in _FLAGS])
_BITS = " ".join(f"when '{item}' then {1 << i}" for i, item in enumerate(ITEMS))
_N = len(ITEMS)
SUPPORT, CONFIDENCE = 0.1, 0.3


def _names(mask):
    return "concat_ws('|', " + ", ".join(
        f"case when {mask} & {1 << i} > 0 then '{item}' end" for i, item in enumerate(ITEMS)
    ) + ")"


_MINED = f"""items as (
  select distinct l_orderkey, item from (
    select l_orderkey, concat(p_type, 'p_type_new') as item from lineitem join part on l_partkey = p_partkey
    union all select l_orderkey, concat(l_returnflag, 'l_returnflag_new') from lineitem)),
baskets as materialized (select l_orderkey, cast(sum(case item {_BITS} end) as int) as bits from items group by 1),
total as (select count(*) as n from baskets),
sets as materialized (
  select m as mask, count(*) as freq from baskets, range(1, {1 << _N}) s(m)
  where bits & m = m group by 1 having count(*) >= ceil({SUPPORT} * (select n from total))),
rules as materialized (
  select s.mask, s.mask - (1 << b) as ante, {_names('(s.mask - (1 << b))')} as antecedent,
         {_names('(1 << b)')} as consequent, s.freq / n as support, s.freq / a.freq as confidence,
         (s.freq / a.freq) / (c.freq / n) as lift
  from sets s, range({_N}) x(b), total
  join sets a on a.mask = s.mask - (1 << b) join sets c on c.mask = (1 << b)
  where s.mask & (1 << b) > 0 and s.mask <> (1 << b) and s.freq / a.freq >= {CONFIDENCE})"""
_MINED = _MINED.replace(f"from sets s, range({_N}) x(b), total\n  join", f"from sets s cross join range({_N}) x(b) cross join total\n  join")


def baskets(t):
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return op.grouped_baskets(
        lines, "l_orderkey", [unique_item("p_type", "p_type"), unique_item("l_returnflag", "l_returnflag")]
    )


def _mined(t):
    rows = written(baskets(t), "baskets")
    return rows, op.mine(rows, SUPPORT, CONFIDENCE)


def _texts(rules):
    return rules.select(
        F.array_join("antecedent", "|").alias("antecedent"), "consequent", r("support").alias("support"),
        r("confidence").alias("confidence"), r("lift").alias("lift"),
    )


@query(
    "L15_frequent_itemsets",
    f"""with {_MINED} select {_names('mask')} as items, freq, round(freq / n, 6) as support from sets, total
        where bit_count(mask) >= 2""",
)
def _(t):
    rows, model = _mined(t)
    found = op.itemsets(model, rows.count())
    return found.select(F.array_join("items", "|").alias("items"), "freq", r("support").alias("support"))


_RULE_COLUMNS = """antecedent, consequent, round(support, 6) as support, round(confidence, 6) as confidence,
  round(lift, 6) as lift"""


@query("L16_association_rules", f"with {_MINED} select {_RULE_COLUMNS} from rules")
def _(t):
    return _texts(op.association_rules(_mined(t)[1]))


@query(
    "L17_filtered_rules",
    f"""with {_MINED} select {_RULE_COLUMNS} from rules
        where contains(consequent, 'l_returnflag_new') and contains(antecedent, 'PROMOp_type_new') and lift > 1.0""",
)
def _(t):
    rules = op.association_rules(_mined(t)[1])
    return _texts(op.select_rules(rules, "l_returnflag_new", ["PROMOp_type_new"], 1.0))


@query(
    "L17_filtered_itemsets",
    f"""with {_MINED} select {_names('mask')} as items, freq from sets where bit_count(mask) >= 2
        and contains({_names('mask')}, 'SMALLp_type_new') and contains({_names('mask')}, 'l_returnflag_new')""",
)
def _(t):
    rows, model = _mined(t)
    found = op.having_items(op.itemsets(model, rows.count()), ["SMALLp_type_new", "l_returnflag_new"])
    return found.select(F.array_join("items", "|").alias("items"), "freq")


@query(
    "L18_itemsets_by_support",
    f"""with {_MINED}, pct as (select (freq * 100) // n as p from sets, total where bit_count(mask) >= 2)
    select cast(th as int) as threshold, count(p) as n from range(10, 50) g(th) left join pct on p >= th group by 1""",
)
def _(t):
    rows, model = _mined(t)
    n = rows.count()
    pct = F.floor(F.col("freq") * 100 / F.lit(n))
    return op.count_at_thresholds(op.itemsets(model, n), pct, 10, 49)


@query(
    "L18_rules_by_confidence",
    f"""with {_MINED}, pct as (select cast(floor(round(confidence * 100, 6)) as int) as p from rules)
    select cast(th as int) as threshold, count(p) as n from range(40, 90) g(th) left join pct on p >= th group by 1""",
)
def _(t):
    pct = F.floor(F.round(F.col("confidence") * 100, 6))
    return op.count_at_thresholds(op.association_rules(_mined(t)[1]), pct, 40, 89)


def _measure_sql(m):
    return f"""select '{m}' as measure, bin, n from (
      select cast(b as int) as bin, count(v) as n from range(10) g(b) left join (
        select {m} as v, least(cast(floor(({m} - lo) / (hi - lo) * 10) as int), 9) as k
        from rules, (select min({m}) as lo, max({m}) as hi from rules)) on k = b group by 1)"""


@query(
    "L19_rule_histograms",
    f"with {_MINED} {_measure_sql('confidence')} union all {_measure_sql('lift')}",
)
def _(t):
    rules = op.association_rules(_mined(t)[1])
    return op.rule_histograms(rules).select("measure", "bin", "n")


@query(
    "J11_rules_applied",
    f"""with {_MINED}, chosen as (select ante, antecedent, consequent, round(lift, 9) as lift from rules
      where contains(consequent, 'l_returnflag_new') and lift > 1.0),
    fits as (select l_orderkey, consequent, lift,
                    row_number() over (partition by l_orderkey order by lift desc, antecedent, consequent) as k
             from baskets join chosen on bits & ante = ante)
    select b.l_orderkey, consequent as predicted, round(lift, 6) as lift
    from baskets b left join fits f on b.l_orderkey = f.l_orderkey and k = 1""",
)
def _(t):
    rows, model = _mined(t)
    rules = op.select_rules(op.association_rules(model), "l_returnflag_new", (), 1.0).withColumn("lift", r("lift", 9))
    counts = model.freqItemsets.where(F.size("items") == 1).select(
        F.col("items")[0].alias("item"), F.col("freq").alias("n")
    )
    return rounded(op.apply_rules(rows, rules, counts, "l_orderkey"), "lift")


@query("L16_rules_of_client_rows")
def _(t):
    """Rules over the credit table's nine items per client."""
    from millrace.plans.credit import client_items

    rules = op.association_rules(op.mine(written(client_items(st.clients(t)), "baskets"), 0.05, 0.5))
    return _texts(op.select_rules(rules, "credit_default_new"))
