"""SimHash fingerprints and anchor points against brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import simhash as op

DOCS = "doc_id long, text string"


def plain_fingerprint(text, size=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    size = min(size, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i : i + size]).encode(), seed=42).intdigest() for i in range(len(words) - size + 1)]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(values, most):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    values = sorted(set(values))
    table = np.array(values, np.uint64)
    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(table[i + 1 :] ^ np.uint64(v)) <= most).tolist():
            parent[find(values[i + 1 + j])] = find(v)
    return {v: find(v) for v in values}


def clustered(seed, centres, each, flips):
    rng = random.Random(seed)
    values = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(each):
            v = centre
            for _ in range(rng.randint(0, flips)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    return sorted(values)


@pytest.mark.parametrize("bits", [8, 16, 21, 32])
def test_two_values_two_bits_apart_share_an_anchor(bits):
    rng = np.random.default_rng(bits)
    values = rng.integers(0, 1 << bits, 300, dtype=np.uint64)
    others = values ^ (np.uint64(1) << rng.integers(0, bits, 300, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, bits, 300, dtype=np.uint64))
    sets = []
    for side in (values, others):
        rows, anchors = op.near_anchors(side, bits)
        held = [set() for _ in side]
        for r, a in zip(rows.tolist(), anchors.tolist()):
            held[r].add(a)
        assert sum(map(len, held)) == len(rows)  # no anchor twice
        assert all(a < 1 << bits and bin(a ^ int(v)).count("1") <= 2 for v, s in zip(side, held) for a in s)
        sets.append(held)
    assert all(a & b for a, b in zip(*sets))


@pytest.mark.parametrize(("most", "limit"), [(4, 4096), (4, 30), (4, 3), (2, 5), (5, 50), (0, 4096)])
def test_links_join_what_brute_force_joins(spark, most, limit):
    values = clustered(most * 100 + limit, 12, 60, 7) + clustered(1, 400, 1, 0) + [0, 1, (1 << 64) - 1]
    values = sorted(set(values))
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    found = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in op.near_links(df, most, limit).collect()]
    assert all(bin(a ^ b).count("1") <= most for a, b in found)
    want, parent = components(values, most), {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in found:
        parent[find(a)] = find(b)
    groups = lambda name: {frozenset(v for v in values if name(v) == r) for r in {name(v) for v in values}}
    assert groups(find) == groups(want.get)


def texts():
    rng = random.Random(3)
    words = [a + b for a in ("ka", "lo", "Mi", "tér", "un") for b in ("rin", "sel", "da", "pon", "ive")]
    made = [" ".join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(60)]
    for k in range(25):
        held = made[k % 3].split(" ")
        held[rng.randrange(len(held))] = "changed"
        made.append(" ".join(held))
    return [
        *made, None, "", " \n\t\x0b", "one", "One", "two words", "a b c d", "a b c d e", made[4].upper(), made[0].replace(" ", "\n"),
        " ".join(rng.choices(words, k=150_000)),
    ]


def test_documents_against_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    rows += [(3, rows[3][1]), (500, rows[3][1]), (3, rows[9][1]), (None, rows[9][1]), (None, "nobody else says this"), (501, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("fp", "bucket", "low", "node", "root", "first", "a", "b")})
    prints = [plain_fingerprint(t) for _, t in rows]
    name = components(prints, 4)
    firsts = {}
    for (doc_id, _), p in zip(rows, prints):
        if doc_id is not None:
            firsts[name[p]] = min(doc_id, firsts.get(name[p], doc_id))
    want = sorted(((d, p, firsts.get(name[p])) for (d, _), p in zip(rows, prints)), key=repr)
    got = [(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in op.simhash_duplicates(docs).collect()]
    assert sorted(got, key=repr) == want


def test_hash_is_that_of_the_engine(spark):
    text = "Straße ünd mehr"
    (row,) = op.fingerprints(spark.createDataFrame([(1, text)], DOCS)).select("fp", F.xxhash64(F.lit(text.lower())).alias("h")).collect()
    assert row["fp"] == row["h"]


def test_empty_table_and_too_many_bits(spark):
    empty = spark.createDataFrame([], DOCS)
    assert op.simhash_duplicates(empty).collect() == []
    with pytest.raises(ValueError):
        op.near_links(empty, 6)


def test_query_against_brute_force(spark):
    from millrace.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in rows}
    name, firsts = components(prints.values(), 4), {}
    for doc_id, p in prints.items():
        firsts[name[p]] = min(doc_id, firsts.get(name[p], doc_id))
    got = {tuple(r) for r in QUERIES["op12_simhash_duplicates"](spark, folder).collect()}
    assert got == {(d, f"{p:016x}", firsts[name[p]]) for d, p in prints.items()}
