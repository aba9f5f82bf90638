"""Each corpus operator against a plain version of itself, on rows with nulls, empty and long texts, ties,
repeated rows, empty tables, and extra columns with clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators use inside, or might.
CLASHING = ("id", "key", "n", "size", "text_", "part", "bucket", "block", "pos", "col", "count", "target", "copy", "cut")


def plain_texts():
    rng = random.Random(5)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ter", "un") for b in ("rin", "sel", "da", "pon", "ive", "ost")]
    texts = []
    for _ in range(60):
        lines = [" ".join(rng.choices(words, k=rng.randint(3, 40))) + "." for _ in range(rng.randint(1, 5))]
        texts.append("\n".join(lines))
    texts += [texts[0], texts[0].upper(), texts[1] + " more words", None, "", "  \n\t", "one", "two words"]
    texts.append(" ".join(rng.choices(words, k=30_000)))
    texts.append("\n".join(reversed(texts[2].split("\n"))))
    return texts


def rows_of(texts):
    rows = [
        (i, t, ("en", "xx", None)[i % 3], ("s1", "s0", None, "s2")[i % 4] if i > 20 else "s1", len(t) if t is not None else None)
        for i, t in enumerate(texts)
    ]
    return [*rows, rows[3], rows[3], (None, "no id here", None, None, 10)]


@pytest.fixture(scope="module")
def texts():
    return plain_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    made = spark.createDataFrame(rows_of(texts), DOCS)
    return made.withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words_of(text):
    return WORD.findall(text or "")


# --- words ---------------------------------------------------------------------------------


def test_words_and_hashes(texts):
    from millrace.llm import textkit as kit

    data, offsets = kit.text_buffers(pa.array(texts))
    starts, ends, bounds = kit.word_spans(data, offsets)
    hashes = kit.span_hashes(data, starts, ends)
    seen = {}
    for k, text in enumerate(texts):
        words = words_of(text)
        assert bounds[k + 1] - bounds[k] == len(words)
        for w, h in zip(words, hashes[bounds[k] : bounds[k + 1]].tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_a_word_longer_than_a_block_hashes_as_itself():
    from millrace.llm import textkit as kit

    long = "é" * (kit._BLOCK + 7)
    data, offsets = kit.text_buffers(pa.array([f"a {long} b", f"{long}", f"{long}x"]))
    starts, ends, _ = kit.word_spans(data, offsets)
    h = kit.span_hashes(data, starts, ends)
    assert h[1] == h[3] and h[1] != h[4]


# --- 1 fingerprints ------------------------------------------------------------------------


def test_fingerprints_of_edits(docs, texts):
    from millrace.llm.fingerprints import fingerprint_edits

    got = fingerprint_edits(docs, blocks=5).collect()
    assert len(got) == len(rows_of(texts))
    by_text = defaultdict(set)
    order = sorted(((i, t or "") for i, t, *_ in rows_of(texts) if i is not None), key=lambda r: -r[0])
    order.append((None, "no id here"))
    expected = Counter()
    for k, (i, t) in enumerate(order):
        after, half = order[(k + 1) % len(order)][1], len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        expected[(i, len(t), hashlib.sha256(edited.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == expected
    known = {i: t or "" for i, t, *_ in rows_of(texts)}
    for r in got:
        by_text[known[r.doc_id]].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_edited == 1) or r.fingerprint != r.edited_fingerprint
    assert all(len(f) == 1 for f in by_text.values())
    lines = defaultdict(set)
    for text, f in by_text.items():
        lines[tuple(sorted(text.split("\n")))] |= f
    # Paragraphs in another order are the same multiset; all other texts differ.
    assert all(len(f) == 1 for f in lines.values())
    assert len(set.union(*lines.values())) == len(lines)


def test_fingerprints_add_and_remove(spark):
    from millrace.llm.fingerprints import added, as_text, paragraph_sums, removed

    def of(text):
        return paragraph_sums(spark.createDataFrame([(1, text)], "k int, text string"), ["k"]).select(
            "k", F.struct("wide", "signs").alias("f")
        )

    parts = of("first line\nsecond one").withColumnRenamed("f", "a").join(of("third").withColumnRenamed("f", "b"), "k")
    whole = of("third\nsecond one\nfirst line").join(parts, "k")
    show = lambda f: as_text(f["wide"], f["signs"])
    row = whole.select(
        show(F.col("f")).alias("f"), show(added(F.col("a"), F.col("b"))).alias("sum"), show(F.col("a")).alias("a"),
        show(removed(F.col("f"), F.col("b"))).alias("less"),
    ).first()
    assert row.f == row.sum and row.a == row.less and row.a != row.f


def test_likeness_holds_in_any_script(spark):
    from millrace.llm.fingerprints import likeness, paragraph_sums

    rng = random.Random(4)

    def words(low, high, n, sep=" "):
        return sep.join("".join(chr(rng.randint(low, high)) for _ in range(rng.randint(3, 8))) for _ in range(n))

    makers = {
        "upper": lambda: words(65, 90, 400), "russian": lambda: words(0x430, 0x44F, 400), "arabic": lambda: words(0x621, 0x64A, 400),
        "chinese": lambda: words(0x4E00, 0x5200, 300, ""), "thai": lambda: words(0xE01, 0xE2E, 300, ""),
        "astral": lambda: words(0x20000, 0x20400, 300, ""), "unbroken": lambda: words(97, 122, 300, ""), "english": lambda: words(97, 122, 400),
    }
    rows = []
    for name, make in makers.items():
        a, b = make(), make()
        half = len(a) // 2
        # Latter half replaced; one word put in, which must not move the other pieces; nothing shared.
        rows += [(name, "edited", a, a[: len(a) - half] + b[:half]), (name, "added", a, a[:half] + " qq " + a[half:]), (name, "other", a, b)]
    pairs = spark.createDataFrame(rows, "name string, kind string, a string, b string")
    own = lambda c: paragraph_sums(pairs.select("name", "kind", c), ["name", "kind"], c).select(
        "name", "kind", F.struct("wide", "signs", F.aggregate("signs", F.lit(0).cast("long"), lambda s, x: s + x * x).cast("double").alias("norm")).alias("f" + c)
    )
    got = own("a").join(own("b"), ["name", "kind"]).select("name", "kind", likeness(F.col("fa"), F.col("fb")).alias("like")).collect()
    assert len(got) == 3 * len(makers)
    for r in got:
        low, high = {"edited": (0.2, 0.8), "added": (0.9, 1), "other": (0, 0.35)}[r.kind]
        assert low <= r.like <= high, sorted(got)


def test_fingerprints_of_no_rows(empty):
    from millrace.llm.fingerprints import fingerprint_edits

    assert fingerprint_edits(empty).count() == 0


# --- 2 near duplicates ---------------------------------------------------------------------


def brute_components(rows, size, part, whole):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, text in rows:
        w = words_of((text or "").translate(low))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                shared = len(sets[x] & sets[y])
                if whole * shared >= part * (len(sets[x]) + len(sets[y]) - shared):
                    a, b = top(x), top(y)
                    root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), top(i)) for i in ids}


@pytest.mark.parametrize("size,part", [(3, 85), (5, 80)])
def test_near_duplicates(docs, texts, size, part):
    from millrace.llm.neardup import near_duplicates

    got = near_duplicates(docs, size, part, 100).collect()
    want = brute_components([(i, t) for i, t, *_ in rows_of(texts) if i is not None], size, part, 100)
    assert len(got) == len(rows_of(texts))
    for r in got:
        if r.doc_id is None:
            assert r.kept and r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.component_id == r.doc_id)


def test_near_copies_of_near_copies(spark):
    """A hot bucket whose members are linked along a chain and not all with its first."""
    from millrace.llm.neardup import near_duplicates

    rng = random.Random(2)
    base = [f"w{k}" for k in range(120)]
    rows, at = [], list(base)
    for i in range(80):
        rows.append((i, " ".join(at)))
        at = list(at)
        at[rng.randrange(len(at))] = f"x{i}"
    rng.shuffle(rows)
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85, 100).collect()
    want = brute_components(rows, 3, 85, 100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_sketches_fill_and_estimate():
    from millrace.llm.neardup import sketch

    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (800, 100, 100))
    rows = sketch([np.concatenate([common, a]), np.concatenate([common, b]), common[:2], common[:1]], 180)
    assert (rows != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert abs((rows[0] == rows[1]).mean() - 0.8) < 0.12


def test_near_duplicates_of_no_rows(empty):
    from millrace.llm.neardup import near_duplicates

    assert near_duplicates(empty).count() == 0


# --- 3, 4, 7 trained operators -------------------------------------------------------------


@pytest.fixture(scope="module")
def small(spark):
    return "/root/testdata/sf0.01"


def read(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def test_language_is_right_on_held_out_rows(spark, small):
    from millrace.llm.queries import QUERIES

    got = QUERIES["op3_language_id"](spark, small).join(read(spark, small, "documents").select("doc_id", "lang"), "doc_id")
    rows = got.collect()
    assert len(rows) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(docs, empty, spark):
    from millrace.llm.langid import fit_language_model, identify_language

    model = fit_language_model(docs, F.lit(True))
    got = identify_language(docs, model, F.lit(False)).collect()
    assert {r.lang_pred for r in got if r.doc_id in (63, 64, 65)} == {"und"}
    assert {r.lang_pred for r in got} <= {"en", "xx", "und"}
    nothing = fit_language_model(empty, F.lit(True))
    assert {(r.lang_pred, r.score) for r in identify_language(docs, nothing, F.lit(False)).collect()} == {("und", 0.0)}
    assert identify_language(empty, model, F.lit(False)).count() == 0


def test_toxicity_on_held_out_rows(spark, small):
    from millrace.llm.queries import QUERIES

    got = QUERIES["op4_toxicity"](spark, small).join(read(spark, small, "labels"), "doc_id", "left").collect()
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.toxic is not None]
    bad, good = ([r.score for r in held if r.toxic == y] for y in (1, 0))
    above = sum(b > g for b in bad for g in good) / (len(bad) * len(good))
    assert above > 0.75 and sum(g >= 0.7 for g in good) <= 0.05 * len(good)


def test_toxic_sentences_are_located(spark):
    from millrace.llm.toxicity import fit_toxicity_model, score_toxicity, toxic_sentences

    rng, rows = random.Random(3), []
    plain = [f"word{k}" for k in range(50)]
    for i in range(300):
        said = [" ".join(rng.choices(plain, k=6)) for _ in range(4)]
        if i % 4 == 0:
            said[rng.randrange(4)] += " grubbly nastix"
        rows.append((i, ". ".join(said), int(i % 4 == 0)))
    rows += [(300, None, None), (301, "", None), (None, "grubbly nastix", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = fit_toxicity_model(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"), F.col("doc_id") % 3 != 1)
    got = {r.doc_id: r for r in score_toxicity(docs, model, F.col("doc_id") % 3 == 1).collect()}
    assert all(got[i].predicted == y for i, _, y in rows if y is not None) and got[300].score == got[301].score == 0
    found = toxic_sentences(docs, model).collect()
    assert {r.doc_id for r in found} == {i for i, t, y in rows if t and "nastix" in t}
    assert all("nastix" in r.sentence for r in found)
    none = fit_toxicity_model(docs, docs.select("doc_id", "toxic").where("toxic = 0"), F.lit(True))
    assert all(r.score < 1e-6 for r in score_toxicity(docs, none, F.lit(True)).collect())


def test_quality_finds_junk_and_keeps_the_rest(spark, small):
    from millrace.llm.queries import QUERIES

    got = QUERIES["op7_quality_classifier"](spark, small).join(read(spark, small, "labels"), "doc_id").collect()
    junk, good = ([r.kept for r in got if r.quality == q] for q in (0, 1))
    assert sum(junk) <= 0.1 * len(junk) and sum(good) >= 0.97 * len(good)


def test_quality_of_odd_rows(docs, empty, texts):
    from millrace.llm.quality_model import fit_quality_model, judge_quality, keep_good

    model = fit_quality_model(docs)
    got = judge_quality(docs, model).collect()
    assert len(got) == len(rows_of(texts))
    known = {i: t for i, t, *_ in rows_of(texts)}
    assert all(r.n_words == len(words_of(known[r.doc_id])) for r in got)
    assert all(not r.kept and r.score == 0 for r in got if not r.n_words)
    kept = keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)
    assert judge_quality(empty, fit_quality_model(empty)).count() == 0


def test_label_model_finds_the_weak_labeller():
    from millrace.llm.quality_model import BAD, GOOD, LABELLERS, fit_label_model

    rng = np.random.default_rng(4)
    truth = rng.random(4000) < 0.7
    right = np.array([0.95, 0.9, 0.9, 0.9, 0.85, 0.55, 0.9])
    hit = rng.random((4000, len(LABELLERS))) < right
    votes = np.where(hit == truth[:, None], GOOD, BAD)
    model = fit_label_model(votes, np.ones(len(votes)))
    assert int(np.argmin(model.accuracy())) == 5
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.97


# --- 5 quality rules -----------------------------------------------------------------------


def test_rule_measurements(docs, texts, empty):
    from millrace.llm.quality_rules import RULES, rule_ledger

    rows = {r.doc_id: r for r in rule_ledger(docs).collect()}
    for i, text, *_ in rows_of(texts):
        words, r = words_of(text), rows[i]
        places = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        covered = {k + j for k in range(len(words) - 7) if places[tuple(words[k : k + 8])] > 1 for j in range(8)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in text or "")
        assert r.n_dup_lines == len(lines) - len(set(lines)) and r.n_repeat_words == len(covered)
        names = dict.fromkeys(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters"))
        values = {n: r[n] for n in names}
        for k, rule in enumerate(RULES.values()):
            assert bool(r.fail_bits >> k & 1) == eval(rule, {}, values)  # noqa: S307  the rules are plain arithmetic
    assert rule_ledger(empty).count() == 0


def test_ablations(spark):
    from millrace.llm.quality_rules import ablations

    ledger = spark.createDataFrame([(0,), (1,), (1,), (3,), (2,), (4,)], "fail_bits long")
    got = {
        (r.policy, r.rule): (r.fails, r.fails_alone, r.policy_keeps)
        for r in ablations(ledger, {"p": ("too_few_words", "repeated_words")}).collect()
    }
    assert got == {("p", "too_few_words"): (3, 2, 2), ("p", "repeated_words"): (2, 1, 2)}


# --- 6 mixing ------------------------------------------------------------------------------


def test_targets_share_out_what_is_left(spark):
    from millrace.llm.mixing import source_targets

    rows = [("a", 10), ("b", 1000), ("c", 20), (None, 400), ("d", 0)]
    got = {r.source: r.target for r in source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    weight = {"a": 3, "b": 1, "c": 2, "d": 3, None: 1}
    target, size = dict.fromkeys(weight, 0.0), dict(rows)
    left, free = 1.5 * sum(size.values()), set(weight)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * size[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = 2.0 * size[s]
            left -= target[s]
        free -= over
    assert {s: pytest.approx(t) for s, t in target.items()} == got


def test_mix_comes_near_its_targets(docs, texts, empty):
    from millrace.llm.mixing import mix, mixed_documents

    got = mix(docs).collect()
    assert len(got) == len(rows_of(texts)) and got and sorted(map(str, got)) == sorted(map(str, mix(docs).collect()))
    assert all(r.taken in (0, r.size, 2 * r.size) for r in got)
    largest = max(r.size for r in got)
    for size, target in {(r.source_size, r.target) for r in got}:
        taken = sum(r.taken for r in got if (r.source_size, r.target) == (size, target))
        assert abs(taken - target) <= largest and target <= 2 * size
    copies = mixed_documents(docs)
    assert copies.columns == docs.columns
    want = Counter({r.doc_id: 0 for r in got})
    for r in got:
        want[r.doc_id] += r.taken // r.size if r.size else 0
    assert Counter(r.doc_id for r in copies.collect()) == +want
    assert mix(empty).count() == 0


# --- 8 packing -----------------------------------------------------------------------------


def test_packing_keeps_every_token(docs, texts, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    from millrace.llm.packing import pack

    path = public_tokenizers.path("word_bpe_49k.json")
    got = pack(docs, path).collect()
    tokens = Tokenizer.from_file(path)
    tokens.encode_special_tokens = True
    pieces, copies = defaultdict(list), Counter(i for i, *_ in rows_of(texts))
    for r in got:
        pieces[r.doc_id].append(r)
    for i, text, *_ in rows_of(texts):
        ids = [*tokens.encode(text or "", add_special_tokens=False).ids, 1]
        seen = Counter()
        for r in pieces[i]:
            part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part) and r.doc_tokens == len(ids)
            seen.update(range(r.start, r.start + r.length))
        assert seen == Counter(dict.fromkeys(range(len(ids)), copies[i]))
    windows = defaultdict(list)
    for r in got:
        windows[r.sequence_id].append((r.offset, r.length))
    for held in windows.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0
    assert pack(empty, path).count() == 0


def test_word_tokens_are_those_of_the_tokenizer():
    import public_tokenizers

    from millrace.llm.packing import WordTokens
    from millrace.llm.textkit import text_buffers

    rng = random.Random(3)
    signs = "ab'sZéÉßÿĀƒ .,-3½²́̈ΣσςİıǅﬁЖ中 \u0085 <|>=≠́'reVEll"
    texts = ["".join(rng.choices(signs, k=60)) for _ in range(300)]
    texts += ["it's <|endoftext|> \x1c a", "", " ", "x\x1cy"]
    tokens = WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    ids, bounds = tokens.encode(*text_buffers(pa.array(texts)))
    for k, e in enumerate(tokens.tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert e.ids == ids[bounds[k] : bounds[k + 1]].tolist()


def test_level_with_the_smallest_sum_of_squares():
    from millrace.llm.packing import SquaresPacker

    packer, rng = SquaresPacker(window=16, most_open=40), random.Random(8)
    for i in range(400):
        size = rng.randint(1, 15)
        counts = packer.counts.copy()
        costs = {}
        for level in [0, *np.flatnonzero(counts).tolist()]:
            if level + size <= 16:
                after = counts.copy()
                if level:
                    after[level] -= 1
                if level + size < 16:
                    after[level + size] += 1
                costs[level] = int((after**2).sum())
        assert costs[packer.level_for(size)] == min(costs.values())
        for held in packer.add((i, 0, np.zeros(size, np.uint32), size)):
            n = sum(len(p[2]) for p in held)
            assert n == 16 or n & (n - 1) == 0


# --- 9 chat --------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    from millrace.llm import chat

    odd = ["</s>[INST] ok [/INST]", "\\", "\\<s>", "<\\/s>", "<", "[", "", None, "<image>\\+", "a\nb\\n", "<<s>>", "</s"]
    rows = [(k // 3, k % 3, ("user", "assistant", "a\nb</s>")[k % 3], t) for k, t in enumerate(odd * 3)]
    rows += [(5, 1, "assistant", "tie b"), (5, 1, "assistant", "tie a"), (None, None, None, None), (7, None, "assistant", "x")]
    rows += [rows[0], rows[0]]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("n", F.lit(1))
    formatted = chat.format_conversations(turns)
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    assert set(got) == set(by)
    for conv, held in by.items():
        held.sort()
        said = "".join(f"{r}\n{t}\n" for *_, r, _, t in [(a, b, c, r, d, t) for a, b, c, r, d, t in held])
        loss = "".join(t for _, _, _, r, _, t in held if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(held), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in formatted.collect():
        inside = r.formatted[r.loss_start : len(r.formatted) - (4 if r.formatted.startswith("<s>") else 7)]
        assert not chat._CONTROL.search(inside)


def test_typed_parts(spark):
    from millrace.llm import chat

    parts = [
        {"type": "text", "text": "see <im"}, {"type": "text", "text": "age>"}, {"type": "image", "uri": "a.png", "width": 57, "height": 28},
        None, {"type": "audio", "uri": "b.wav", "seconds": 1.5}, {"type": "document", "uri": "c.pdf", "pages": 2}, {"type": "odd", "uri": "d"},
    ]
    rows = spark.createDataFrame(
        [(1, 0, "user", None, parts), (1, 1, "assistant", "fine", None)],
        f"conv_id long, turn long, role string, text string, parts {chat.PARTS}",
    )
    user, answer = chat.format_conversations(rows).orderBy("turn").collect()
    assert user.formatted == "[INST]user\nsee <\\image><image><audio><document><other>[/INST]"
    assert [(a.kind, a.uri, a.tokens) for a in user.attachments] == [
        ("image", "a.png", 3), ("audio", "b.wav", 38), ("document", "c.pdf", 512), ("other", "d", 0)
    ]
    assert user.expanded_tokens == 553 and user.loss_chars == 0 and answer.loss_chars == 4
    assert all(user.formatted[user.loss_start + a.position :].startswith(f"<{a.kind}>") for a in user.attachments)


# --- 10 secrets ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def leaky(spark):
    rng, rows = random.Random(6), []
    plain = [f"{a}{b}" for a in ("river", "stone", "cloud", "green") for b in ("side", "ton", "er", "ing")]
    for i in range(240):
        words = rng.choices(plain, k=30)
        key = "".join(rng.choices("0123456789abcdef", k=40))
        if i % 3 == 0:
            words[10] = f'token = "{key}"'
        elif i % 3 == 1:
            words[10] = f"commit {key}"
        if i % 5 == 0:
            words[20] = "".join(rng.choices("0123456789", k=16))
        rows.append((i, " ".join(words), "en", "src/é/main.py", 0))
    rows += [(500, None, None, None, None), (501, "", None, None, 0), (502, "x1" * 20_000, None, None, 3), rows[0]]
    rows.append((None, f'ünder password: "{"7f3a9c" * 4}" end', None, None, 1))
    return spark.createDataFrame(rows, DOCS)


def test_secrets_are_told_from_digests(leaky):
    from millrace.llm.secrets import redact_secrets, scan_secrets

    found = scan_secrets(leaky, path=F.col("source")).collect()
    secret = {r.doc_id for r in found if r.is_secret}
    assert {i for i in secret if i is not None and i < 240} == set(range(0, 240, 3)) and None in secret
    assert {r.doc_id for r in found} >= set(range(1, 240, 3))
    clean = redact_secrets(leaky, path=F.col("source"))
    assert clean.columns == leaky.columns
    before, after = leaky.collect(), clean.collect()
    assert len(before) == len(after)
    texts = {r.doc_id: r for r in after}
    for r in before:
        if r.doc_id in secret:
            assert "[secret]" in texts[r.doc_id].text and texts[r.doc_id].n_chars == len(texts[r.doc_id].text)
        else:
            assert texts[r.doc_id] == r
    assert texts[None].text == 'ünder password: "[secret]" end'


def test_given_findings_are_learned_from(leaky, empty):
    from millrace.llm.secrets import corpus_statistics, scan_secrets, secret_candidates

    known = corpus_statistics(leaky)
    findings = secret_candidates(leaky, known).withColumn("label", (F.col("length") == 16).cast("int"))
    got = scan_secrets(leaky, findings).collect()
    assert all(r.is_secret == (r.length == 16) for r in got)
    assert scan_secrets(empty).count() == 0


def test_assigned_values_are_removed_whole(spark, leaky):
    from millrace.llm.secrets import REDACTED, redact_secrets

    rng = random.Random(11)
    run = lambda n: "3x" + "".join(rng.choices("abcdefghkmnpqrstuvwxyzABCDEFGHKLMNPQRSTUVWXYZ23456789", k=n))
    forms = [
        ('password = "{}"', lambda: f"Tr0ub4dor&{run(16)}"), ("secret: {} end", lambda: f"aB3.{run(20)}"),
        ("pwd: '{}'", lambda: f'{run(18)}@p=7&"k.{run(18)}$'), ("say token = {}, or", lambda: f"{run(20)}.{run(24)}.{run(30)}"),
        ('"token": "{}"', lambda: f"eyJ{run(20)}.eyJ{run(24)}.{run(30)}"), ("é Password={};Database=shop", lambda: f"{run(18)}@{run(9)}"),
        ("http://h/?api_key={}&page=2", lambda: f"{run(18)}.{run(18)}"),
    ]
    cases = [(1000 + k, form, value()) for k, (form, value) in enumerate(forms * 15)]
    rows = [(i, form.format(v), None, None, None) for i, form, v in cases]
    got = redact_secrets(leaky.unionByName(spark.createDataFrame(rows, DOCS))).where("doc_id >= 1000").collect()
    assert {r.doc_id: r.text for r in got} == {i: form.format(REDACTED) for i, form, _ in cases}
