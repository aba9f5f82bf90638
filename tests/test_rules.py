"""Applying rules: the prefix tree and the join by pairs against a loop over all rules."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import rules as op

ITEMS = [f"i{k}" for k in range(12)]


def made(seed):
    rng = random.Random(seed)
    baskets = [(i, rng.sample(ITEMS, rng.randint(0, 7))) for i in range(300)]
    baskets += [(300, None), (301, []), (302, ["i1", "i1", "i0"]), (303, ["never seen"]), (304, list(ITEMS))]
    rules = set()
    while len(rules) < 60:
        size = rng.choice([1, 1, 2, 2, 3, 4])
        rules.add((tuple(sorted(rng.sample(ITEMS, size))), rng.choice(["a", "b"]), rng.choice([1.25, 1.5, 2.0, 3.5])))
    rules |= {(("i0",), "a", 1.5), (("i0",), "b", 1.5), (("i0", "zz"), "a", 9.0)}
    return baskets, sorted(rules)


def best_of(items, rules):
    if items is None:
        return None, None
    fits = [(-lift, "|".join(ante), cons) for ante, cons, lift in rules if set(ante) <= set(items)]
    return (min(fits)[2], -min(fits)[0]) if fits else (None, None)


@pytest.mark.parametrize("tree_rules", [op.TREE_RULES, 0])
@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("always", [False, True])
def test_best_rule_of_each_basket(spark, seed, tree_rules, always):
    baskets, rules = made(seed)
    if always:
        rules = [*rules, ((), "c", 1.3)]
    df = spark.createDataFrame(baskets, "id long, items array<string>")
    table = spark.createDataFrame([(list(a), c, x) for a, c, x in rules], "antecedent array<string>, consequent string, lift double")
    counts = df.select(F.explode("items").alias("item")).where("item <> 'i3'").groupBy("item").agg(F.count("item").alias("n"))
    got = {r["id"]: (r["predicted"], r["lift"]) for r in op.apply_rules(df, table, counts, "id", tree_rules).collect()}
    assert got == {i: best_of(items, rules) for i, items in baskets}


@pytest.mark.parametrize("tree_rules", [op.TREE_RULES, 0])
def test_no_rules_and_no_baskets(spark, tree_rules):
    df = spark.createDataFrame([(1, ["x"])], "id long, items array<string>")
    none = spark.createDataFrame([], "antecedent array<string>, consequent string, lift double")
    counts = spark.createDataFrame([], "item string, n long")
    assert [tuple(r) for r in op.apply_rules(df, none, counts, "id", tree_rules).collect()] == [(1, None, None)]
    assert op.apply_rules(df.where("id > 1"), none, counts, "id", tree_rules).collect() == []


def test_tree_shares_prefixes(spark):
    paths = spark.createDataFrame([(["a", "b"], 1.0), (["a", "c"], 2.0), (["a"], 3.0)], "path array<string>, r double")
    ranked = paths.select("path", F.struct(F.col("r").alias("rank"), F.lit("x").alias("rule"), F.lit("y").alias("consequent")).alias("ranked"))
    (row,) = op.rule_tree(ranked).collect()
    assert len(row["tree"]) == 4  # root, a, a-b, a-c
    assert [(c["item"], c["node"]) for c in row["tree"][0]["children"]] == [("a", 1)]
    assert row["tree"][0]["best"] is None and row["tree"][1]["best"]["rank"] == 3.0


def test_grouped_baskets_hold_each_item_once(spark):
    df = spark.createDataFrame([(1, "x", "y"), (1, "x", None), (1, "y", "x"), (2, None, None)], "id long, a string, b string")
    got = {r["id"]: r["items"] for r in op.grouped_baskets(df, "id", [F.col("a"), F.col("b")]).collect()}
    assert got == {1: ["x", "y"], 2: []}
