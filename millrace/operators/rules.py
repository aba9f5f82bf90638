"""Frequent itemsets and association rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.scalar import unique_item
from millrace.operators.stats import histogram
from millrace.session import written


def row_baskets(df: DataFrame, row_key: str, cols: Sequence[str]) -> DataFrame:
    """``row_key, items``: one item per column, made distinct by the column name."""
    return df.select(row_key, F.array(*[unique_item(c, c) for c in cols]).alias("items"))


def grouped_baskets(df: DataFrame, key: str, items: Sequence[Column]) -> DataFrame:
    """``key, items``: the distinct items of all rows of a key, nulls left out.

    Repeats are removed while grouping, before and after the shuffle, so a basket is never longer than the list of items.
    """
    names = [f"item_{i}" for i in range(len(items))]
    sets = df.select(key, *[c.alias(n) for c, n in zip(items, names)]).groupBy(key).agg(
        *[F.collect_set(n).alias(n) for n in names]
    )
    return sets.select(key, F.array_sort(F.array_distinct(F.concat(*names))).alias("items"))


def mine(baskets: DataFrame, min_support: float, min_confidence: float = 0.0) -> FPGrowthModel:
    return FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)


def itemsets(model: FPGrowthModel, n_baskets: int, min_size: int = 2) -> DataFrame:
    """``items, freq, support``, items in alphabetical order."""
    found = model.freqItemsets.where(F.size("items") >= min_size)
    return found.select(
        F.array_sort("items").alias("items"), "freq", (F.col("freq") / F.lit(float(n_baskets))).alias("support")
    )


def association_rules(model: FPGrowthModel) -> DataFrame:
    """``antecedent, consequent, support, confidence, lift``; one item as consequent.

    Support is that of antecedent and consequent together.
    """
    return model.associationRules.select(
        F.array_sort("antecedent").alias("antecedent"), F.col("consequent")[0].alias("consequent"),
        "support", "confidence", "lift",
    )


def having_items(df: DataFrame, patterns: Sequence[str], col: str = "items") -> DataFrame:
    """Rows in which every pattern matches some item."""
    for p in patterns:
        df = df.where(F.exists(col, lambda x: x.rlike(p)))
    return df


def select_rules(
    rules: DataFrame, consequent: str, antecedents: Sequence[str] = (), min_lift: float | None = None
) -> DataFrame:
    out = having_items(rules.where(F.col("consequent").rlike(consequent)), antecedents, "antecedent")
    return out if min_lift is None else out.where(F.col("lift") > min_lift)


def count_at_thresholds(df: DataFrame, share: Column, low: int, high: int) -> DataFrame:
    """``threshold, n``: rows whose percentage reaches each whole threshold.

    ``share`` is the percentage rounded down. The rows are counted once per percentage, then
    those few counts are spread over the thresholds they reach.
    """
    counts = df.groupBy(F.least(share, F.lit(high)).cast("int").alias("pct")).agg(F.count(F.lit(1)).alias("k"))
    spread = counts.where(F.col("pct") >= low).select(
        F.explode(F.sequence(F.lit(low), F.col("pct"))).alias("t"), "k"
    )
    sums = spread.groupBy("t").agg(F.sum("k").alias("k"))
    grid = df.sparkSession.range(low, high + 1).select(F.col("id").cast("int").alias("threshold"))
    return grid.join(sums, grid["threshold"] == sums["t"], "left").select(
        "threshold", F.coalesce("k", F.lit(0)).cast("bigint").alias("n")
    )


def rule_histograms(rules: DataFrame, bins: int = 10) -> DataFrame:
    """``measure, bin, bin_low, bin_high, n`` of confidence and lift."""
    parts = [
        histogram(rules, m, bins).select(F.lit(m).alias("measure"), "bin", "bin_low", "bin_high", "n")
        for m in ("confidence", "lift")
    ]
    return parts[0].unionByName(parts[1])


# --- applying rules ----------------------------------------------------------------------

#: Up to so many rules, their prefix tree stands whole in every task; beyond, rules and item sets are joined.
TREE_RULES = 20_000
#: One rule as it is compared: highest lift, then the order of antecedents and of the consequent.
_RANKED = "struct<rank: double, rule: string, consequent: string>"


def item_sets(baskets: DataFrame) -> DataFrame:
    """The distinct sets of items among ``baskets``: ``items``, in order and without repeats."""
    return baskets.where(F.col("items").isNotNull()).select(_canonical("items").alias("items")).distinct()


def _canonical(items: str) -> Column:
    return F.array_sort(F.array_distinct(items))


def _ranked_rules(rules: DataFrame, item_counts: DataFrame) -> DataFrame:
    """``path, ranked``: the antecedent with its rarest item first, and what the rule is chosen by."""
    rule = F.struct(
        (-F.col("lift")).alias("rank"), F.array_join("antecedent", "|").alias("rule"), "consequent"
    ).cast(_RANKED)
    numbered = rules.select("antecedent", rule.alias("ranked")).distinct()
    parts = numbered.select("antecedent", "ranked", F.explode_outer(F.array_distinct("antecedent")).alias("part"))
    counts = item_counts.select(F.col("item").alias("part"), F.col("n").alias("held"))
    return (
        parts.join(counts, "part", "left").groupBy("antecedent", "ranked")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("held", F.lit(0)).alias("held"), "part"))).alias("path"))
        .select(F.filter(F.col("path.part"), lambda part: part.isNotNull()).alias("path"), "ranked")
    )


def rule_tree(paths: DataFrame) -> DataFrame:
    """One row, ``tree``: the prefix tree of ``paths`` (``path, ranked``) as an array of nodes, the root first.

    A node holds its ``best`` rule, if one ends there, and its ``children``: item and number of the node. As all
    of it is one value, ``paths`` must be few (``TREE_RULES``); so are the rows of the window that numbers them.
    """
    steps = paths.select("path", F.explode(F.sequence(F.lit(0), F.size("path"))).alias("k"))
    prefixes = steps.select(F.slice("path", F.lit(1), F.col("k")).alias("path")).distinct()
    numbered = prefixes.withColumn("node", F.row_number().over(W.orderBy(F.size("path"), "path")) - 1)
    best = paths.groupBy("path").agg(F.min("ranked").alias("best"))
    under = numbered.where(F.size("path") > 0).select(
        F.slice("path", F.lit(1), F.size("path") - 1).alias("path"), F.struct(F.element_at("path", -1).alias("item"), "node").alias("child")
    )
    children = under.groupBy("path").agg(F.array_sort(F.collect_list("child")).alias("children"))
    nodes = numbered.join(best, "path", "left").join(children, "path", "left").select(
        F.struct("node", "best", F.coalesce("children", F.array().cast("array<struct<item: string, node: int>>")).alias("children")).alias("node")
    )
    return nodes.agg(F.array_sort(F.collect_list("node")).alias("tree"))


def _walk(items: Column, tree: Column, depth: int) -> Column:
    """The best rule met on all paths from the root whose items are held: one level of the tree per step."""
    node = lambda number: F.get(tree, number)

    def step(state, _):
        here = state["at"]
        met = F.array_min(F.transform(here, lambda n: node(n)["best"]))
        onward = F.flatten(
            F.transform(here, lambda n: F.filter(node(n)["children"], lambda c: F.array_contains(items, c["item"]))["node"])
        )
        return F.struct(onward.alias("at"), F.least(state["best"], met).alias("best")).cast(kind)

    kind = f"struct<at: array<int>, best: {_RANKED}>"
    start = F.struct(F.array(F.lit(0)).alias("at"), F.lit(None).alias("best")).cast(kind)
    return F.aggregate(F.sequence(F.lit(0), F.lit(depth)), start, step, lambda state: state["best"])


def _by_tree(sets: DataFrame, paths: DataFrame) -> DataFrame:
    paths = written(paths, "rule_paths")
    depth = paths.agg(F.coalesce(F.max(F.size("path")), F.lit(0))).first()[0]
    tree = written(rule_tree(paths), "rule_tree")
    # One row, as large as the rules, which the caller has counted.
    return sets.join(F.broadcast(tree), how="cross").select("items", _walk(F.col("items"), F.col("tree"), depth).alias("best"))


def _by_pairs(sets: DataFrame, paths: DataFrame) -> DataFrame:
    """The same by a join on the two rarest items of a rule; of rules with one item, one per item takes part."""
    lone = paths.where(F.size("path") <= 1).groupBy("path").agg(F.min("ranked").alias("ranked"))
    keyed = lone.unionByName(paths.where(F.size("path") > 1)).select(
        F.least(F.get("path", F.lit(0)), F.coalesce(F.get("path", F.lit(1)), F.get("path", F.lit(0)))).alias("a"),
        F.greatest(F.get("path", F.lit(0)), F.get("path", F.lit(1))).alias("b"), "path", "ranked",
    )
    # ``items`` is in order, so each pair comes once; an item with itself stands for rules with one item.
    pairs = sets.select("items", F.posexplode("items").alias("at", "a")).select(
        "items", "a", F.explode(F.slice("items", F.col("at") + 1, F.size("items"))).alias("b")
    )
    met = pairs.join(keyed.where("a is not null"), ["a", "b"]).where(F.size(F.array_except("path", "items")) == 0)
    always = paths.where(F.size("path") == 0).select(F.min("ranked").alias("ranked")).scalar()
    found = met.groupBy("items").agg(F.min("ranked").alias("ranked"))
    return sets.join(found, "items", "left").select("items", F.least("ranked", always).alias("best"))


def best_rules(sets: DataFrame, rules: DataFrame, item_counts: DataFrame, tree_rules: int = TREE_RULES) -> DataFrame:
    """``items, best``: for each set of items the best rule whose antecedents all hold, null without one.

    Few rules stand in a prefix tree that every set walks down once. More than ``tree_rules`` are joined by their
    two rarest items. Both ways give the same.
    """
    paths = _ranked_rules(rules, item_counts)
    if rules.limit(tree_rules + 1).count() <= tree_rules:
        return _by_tree(sets, paths)
    return _by_pairs(sets, written(paths, "rule_paths"))


def apply_rules(
    baskets: DataFrame, rules: DataFrame, item_counts: DataFrame, row_key: str, tree_rules: int = TREE_RULES
) -> DataFrame:
    """``row_key, predicted, lift``: the consequent of the best rule whose antecedents all hold.

    Best means highest lift, then the antecedents' and the consequent's order. Rules are sought once for each
    distinct set of items, not for each basket; ``item_counts`` (``item, n``) tells which items are rare. Baskets without a
    fitting rule, or without items, keep null.
    """
    best = written(best_rules(item_sets(baskets), rules, item_counts, tree_rules), "best_rules")
    held = baskets.select(row_key, _canonical("items").alias("items"))
    return held.join(best, "items", "left").select(
        row_key, F.col("best.consequent").alias("predicted"), (-F.col("best.rank")).alias("lift")
    )
