"""Phrase mining against plain counting in one process."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import phrases as op
from millrace.llm.textkit import signed

DOCS = "doc_id long, text string, lang string"


def plain_phrases(rows, least, top):
    counts, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) >= 2 and a >= least}
        inside = Counter()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(inside[p[i : i + size]], a)
        kept = []
        for p, a in candidates.items():
            if inside[p] >= a:
                continue
            score, _, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k, k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def made_rows(seed=0, docs=220):
    rng = random.Random(seed)
    words = ["the", "of", "a", "Über", "été", "x-1", "kilo", "night", "gate", "Moon", "ÉTÉ", "io"]
    rare = [f"w{k}" for k in range(40)]
    fixed = ["terms of the use apply here", "once upon a time there was a gate", "w3 w4 w5", "all  rights\treserved by x-1"]
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(rng.randint(0, 12)):
            weights = [24, 18, 12, 3, 3, 2, 2, 2, 2, 2, 1, 1]
            part = rng.choices(words, weights, k=rng.randint(0, 8)) + rng.choices(rare, k=rng.randint(0, 2))
            if rng.random() < 0.5:
                part.insert(rng.randrange(len(part) + 1), rng.choice(fixed))
            parts.append(" ".join(part) + rng.choice([".", ",", "\n", "!?", "; ", "\r", "\x0b", ""]))
        rows.append((i, "".join(parts), ("en", "en", "en", "de", None, "und")[i % 6]))
    return [
        *rows, (0, None, "en"), (1, "", None), (2, " \t ", "de"), (3, "...", "xx"), (None, rows[5][1], "en"), rows[7], rows[7],
        (900, " ".join(rng.choices(words, k=20_000)) + " aa aa aa aa aa aa aa", "fr"), (901, "one", "yy"), (902, "w3 w4 w5 " * 3, ""),
        (903, "en de fr en, de en " * 4, "en"), (904, "de en de fr " * 5, "de"), (905, "fr en de " * 3, "fr"),
    ]


@pytest.mark.parametrize(("least", "top", "shares"), [(3, 10, (0.25,)), (2, 100_000, (0.1, 0.3)), (5, 3, (0.05, 0.2, 0.5)), (40, 20, ()), (10**6, 5, (0.25,))])
def test_against_plain_counting(spark, least, top, shares):
    rows = made_rows(least)
    clashing = ("n", "f", "h", "phrase", "size", "rank", "score", "k", "part", "done", "settled", "upto", "octave", "begin", "left", "right")
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in clashing}).repartition(5)
    got = sorted(map(tuple, op.mine_phrases(docs, least, top, shares).collect()))
    assert got == plain_phrases(rows, least, top)


def test_first_words_below_the_settled_score_are_not_expanded(spark, monkeypatch):
    seen = []
    expand = op._expand
    monkeypatch.setattr(op, "_expand", lambda texts, opened, *rest: (seen.append({tuple(r) for r in opened.select("lang", "phrase").collect()}), expand(texts, opened, *rest))[1])
    rows = [r for r in made_rows(1, 600) if r[2] == "en"]
    got = op.mine_phrases(spark.createDataFrame(rows, DOCS), 3, 5, (0.25,)).collect()
    assert sorted(map(tuple, got)) == plain_phrases(rows, 3, 5)
    assert not seen[0] & set().union(*seen[1:])
    assert ("en", "the") not in set().union(*seen)  # the commonest word has the lowest bound


def test_scores_past_64_bits(spark):
    big = 1 << 40
    (row,) = spark.range(1).select(op._score(*[F.lit(v).cast("long") for v in (big, 3 * big, big + 1, big - 1)]).alias("s")).collect()
    assert row["s"] == 1000 * big * 3 * big // ((big + 1) * (big - 1))


def test_bit_table_holds_what_was_put_in(spark):
    hashes = np.random.default_rng(2).integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2)
    hashes[:2] = [1, (1 << 64) - 1]
    table = op.bit_table(spark.createDataFrame([(h, 0) for h in signed(hashes).tolist()], "h long, r long"), "h", "r")
    assert op.in_table(hashes, table).all() and np.bitwise_count(table).sum() <= 500
    others = np.random.default_rng(3).integers(0, 1 << 63, 5000, dtype=np.uint64)
    assert op.in_table(others, table).sum() < 5


def test_empty_table(spark):
    assert op.mine_phrases(spark.createDataFrame([], DOCS)).collect() == []
    assert op.mine_phrases(spark.createDataFrame([(1, None, None)], DOCS)).collect() == []
