"""The Merkle manifest against a plain tree in one process."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import manifest as op

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes, at):
    """The last node, and the siblings of ``nodes[at]`` on the way to it as (before, after)."""
    path = []
    while len(nodes) > 1:
        first = at - at % 8
        run = nodes[first : first + 8]
        path.append(("".join(run[: at - first]), "".join(run[at - first + 1 :])))
        nodes, at = [digest(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)], at // 8
    return nodes[0], path


def lowered(text):
    return text if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_manifest(rows):
    trees = defaultdict(list)
    for row in rows:
        hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
        trees[row[2]].append((row[0] is not None, row[0] or 0, plain_leaf(row, row[1]), plain_leaf(row, lowered(row[1]) if hit else row[1])))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    subroots = [climb([x[2] for x in sorted(trees[lang])], 0)[0] for lang in langs]
    out = []
    for k, lang in enumerate(langs):
        leaves = sorted(trees[lang])
        root, over = climb(subroots, k)
        for at, (has_id, doc_id, leaf, found) in enumerate(leaves):
            path = climb([x[2] for x in leaves], at)[1] + over if len(leaves) < 200 or at % 97 == 0 else None
            if path is None:
                continue
            folded = found
            for before, after in path:
                folded = digest(before, folded, after)
            proof = digest(*[a + b for a, b in path])
            out.append((doc_id if has_id else None, leaf, subroots[k], root, proof, folded, folded == root))
    return out


def odd_rows():
    rows = [
        (i, f"Text {i} ÄÖ é" * (i % 4), ("en", None, "de", "zu", "é", "=x", "*", "a", "ab", "")[i % 10], ("s", None)[i % 2], i)
        for i in range(150)
    ]
    big = [((1 << 60) + i, "Aa" * (20_000 if i == 5 else 1), "en", "s", None) for i in range(40)]
    return [
        *rows, *big, rows[3], rows[3], (7, None, "en", "", 0), (None, "no id", "en", None, None), (None, "", "solo", None, 1),
        (None, "", "en", None, 1), (-5, "Minus", "de", "s", 5),
    ]


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_every_row_against_a_plain_tree(spark):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("tree", "digest", "pos", "idx", "seq", "part", "found", "block")})
    got = as_rows(op.prove(op.build_manifest(docs, op.tampered_leaf())))
    assert got == sorted(plain_manifest(rows), key=repr)


def test_trees_of_several_passes(spark):
    rows = [(i, f"T{i}", "en" if i % 9 else "fr", "s", 2) for i in range(op.BLOCK * 2 + 300)]
    got = {r[0]: tuple(r) for r in op.prove(op.build_manifest(spark.createDataFrame(rows, DOCS), op.tampered_leaf())).collect()}
    assert len(got) == len(rows)
    for row in plain_manifest(rows):
        assert got[row[0]] == row


def test_proofs_of_some_rows_hold_alone(spark):
    docs = spark.createDataFrame(odd_rows(), DOCS)
    manifest = op.build_manifest(docs)
    some = manifest.leaves.placed.where("pos % 5 = 1")
    proofs = op.prove(manifest, some, paths=True).withColumn("alone", op.fold_path(F.col("leaf"), F.col("path"))).collect()
    assert len(proofs) == some.count() > 20
    assert {r["alone"] for r in proofs} == {r["root"] for r in proofs} == {manifest.root()}
    assert all(r["verified"] for r in proofs)


@pytest.mark.parametrize("width", [1, 2, 8, 9, 64, 65, 700])
def test_fetched_nodes_are_enough_and_none_is_derivable(width):
    rng = np.random.default_rng(width)
    positions = np.unique(rng.integers(0, width, 1 + width // 3))
    fetched = {(level, idx): "x" for level, idx in op.missing_nodes(positions, width)}
    levels = op._levels({int(p): "x" for p in positions}, fetched, width)
    assert list(levels[-1][0]) == [0]
    own = set(positions.tolist())
    for level, (known, w) in enumerate(levels):
        assert not own & {idx for lv, idx in fetched if lv == level}
        own = {c // 8 for c in own}


def test_a_changed_row_changes_its_root_only_by_its_fields(spark):
    rows = odd_rows()[:30]
    same = op.build_manifest(spark.createDataFrame(rows[::-1], DOCS)).root()
    assert same == op.build_manifest(spark.createDataFrame(rows, DOCS)).root()
    rows[4] = (*rows[4][:4], 10**6)
    assert same != op.build_manifest(spark.createDataFrame(rows, DOCS)).root()


def test_empty_table_and_single_row(spark):
    empty = op.build_manifest(spark.createDataFrame([], DOCS))
    assert empty.root() is None and op.prove(empty).collect() == []
    row = (4, "One", "en", "s", 3)
    (got,) = op.prove(op.build_manifest(spark.createDataFrame([row], DOCS))).collect()
    assert got["leaf"] == got["subroot"] == got["root"] == plain_leaf(row, "One")
    assert got["proof_sha256"] == digest("") and got["verified"]
