"""Phrases of two to five words that stand together more often than chance, per language, by branch and bound.

A candidate stands at least ``least`` times; a cut after its first k words gives ``floor(1000 * a * n / (l * r))`` from its own
count, all words of the language and the counts of both parts, and its score is that of its lowest cut. Candidates whose
occurrences all lie in one longer candidate are dropped: just those that the same word always follows or precedes.

Phrases grow from their first word. The count of a prefix bounds what grows from it: no phrase stands more often than its prefix,
and as no phrase stands more often than its rest, the cut after the first word gives ``1000 * n / f(first word)`` at most. So first
words are expanded from the highest bound down, in batches: each round takes a share of the words of a language, counts the
phrases that grow from these and scores them. The score of the ``top``-th survivor then settles the rest: first words whose bound is below it
are never expanded, those that reach it (ties included) make up the last round. With fewer survivors nothing is cut off.

Counting is exact and goes through the whole table. A pass first sums up hashes of grown phrases, which can only count too much, and a
last pass counts what was found, and all the parts of it that scores need, as text. Sets of words and phrases go to the
tasks as bit tables of a fixed size (``TABLE_BITS``); where a table is full, more is counted and the result stays the same.

Texts are lower-cased (A-Z) and fall into pieces at ``.,;:!?`` and line ends, and into words at blanks and tabs. A null text is empty, a
null language ``und``. Repeated rows count as often as they stand. An empty table gives no rows. Only ``text`` and
``lang`` are read. Words beside a phrase are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.textkit import map_texts, mixed, runs, signed, span_hashes, text_buffers, windows, word_spans
from millrace.session import written

LONGEST = 5
#: Shares of a language's words, rare first words first, that the rounds before the last take; the last takes all that is open.
SHARES = (0.25,)
#: A bit table has two to the power of so many bits (8 MB).
TABLE_BITS = 26
#: Texts that are looked at together, in bytes.
RUN = 4 << 20
#: Distinct words that a task holds before it passes them on.
HELD = 200_000
#: Parts of a language that are ranked apart before the best of all parts are.
RANKED_APART = 32

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_APART = _BREAK.copy()
_APART[[0x20, 0x09]] = True
_CHUNK = 32768
#: Keeps the hash of a language apart from that of the same word.
_SALT = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Words:
    """The words of some texts: bytes, spans, hashes (with the language in them), and whether the next one goes on."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    goes_on: np.ndarray
    lang: np.ndarray

    def phrase(self, at: int, size: int) -> str:
        text = self.data[self.starts[at] : self.ends[at + size - 1]].tobytes()
        return b" ".join(text.lower().split()).decode()

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``size`` words from each place on, and whether these stand in one piece."""
        hashes = windows(self.hashes, size)
        whole = np.ones(len(hashes), bool)
        for k in range(size - 1):
            whole &= self.goes_on[k : k + len(hashes)]
        return hashes, whole


def read_words(batch: pa.RecordBatch) -> Iterator[tuple[Words, list[str]]]:
    """Words of a batch ``lang, text``, some megabytes at a time, with the names of its languages."""
    coded = batch.column(0).dictionary_encode()
    names, codes = coded.dictionary.to_pylist(), np.asarray(coded.indices)
    held, marks = text_buffers(pa.array(names, pa.string()))
    salts = [span_hashes(held, marks[k : k + 1], marks[k + 1 : k + 2]) for k in range(len(names))]
    salts = mixed(np.concatenate([np.zeros(0, np.uint64), *salts]) + _SALT)
    data, offsets = text_buffers(batch.column(1))
    for a, b in runs(offsets, RUN):
        low = int(offsets[a])
        starts, ends, bounds = word_spans(data, offsets[a : b + 1], _APART)
        if not len(starts):
            continue
        rows = np.repeat(np.arange(a, b), np.diff(bounds))
        hashes = mixed(span_hashes(data, starts, ends, lower=True) ^ salts[codes[rows]])
        seen = np.concatenate([[0], np.cumsum(_BREAK[data[low : int(offsets[b])]], dtype=np.int64)])
        goes_on = np.zeros(len(starts), bool)
        goes_on[:-1] = (rows[1:] == rows[:-1]) & (seen[starts[1:] - low] == seen[ends[:-1] - low])
        yield Words(data, starts, ends, hashes, goes_on, codes[rows]), names


# --- bit tables --------------------------------------------------------------------------


def bit_table(df: DataFrame, *hashes: str) -> np.ndarray:
    """The fixed-size set of the hashes in some columns (0 stands for none) as bytes."""
    column = F.explode(F.array(*hashes)).alias("h")
    place = F.shiftrightunsigned("h", 64 - TABLE_BITS)
    bits = df.select(column).where("h <> 0").select((place / _CHUNK).cast("int").alias("chunk"), (place % _CHUNK).alias("bit"))
    found = bits.groupBy("chunk").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()  # 2^TABLE_BITS bits at most
    table = np.zeros((1 << TABLE_BITS) // _CHUNK, f"V{_CHUNK // 8}")
    for row in found:
        table[row["chunk"]] = np.void(bytes(row["bits"]))
    return table.view(np.uint8)


def in_table(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - TABLE_BITS)
    return (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


# --- passes over the texts ---------------------------------------------------------------


def _word_counts(batches):
    """``lang, phrase, h, n`` of the words of a task; inside it, words are told apart by their 64-bit hashes."""

    def out():
        columns = list(zip(*((lang, word, h, n) for h, (lang, word, n) in held.items()))) or [()] * 4
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "phrase", "h", "n"])

    held: dict[int, list] = {}
    for batch in batches:
        for words, names in read_words(batch):
            hashes, first, counts = np.unique(words.hashes, return_index=True, return_counts=True)
            for h, at, n in zip(signed(hashes).tolist(), first.tolist(), counts.tolist()):
                known = held.get(h)
                if known is None:
                    held[h] = [names[words.lang[at]], words.phrase(at, 1), n]
                else:
                    known[2] += n
            if len(held) > HELD:
                yield out()
                held.clear()
    yield out()


def _grown(sizes: Sequence[int], tables):
    """Hashes and counts of the phrases of these sizes that may be candidates, with the hashes of their rests of 2 to 4 words.

    ``tables`` (broadcast) holds the sets of first words, of frequent words, and of phrases found so far by size.
    """

    def task(batches):
        first, frequent, found = tables.value
        for batch in batches:
            for words, _ in read_words(batch):
                known = in_table(words.hashes, frequent)
                grams = {size: words.grams(size) for size in range(2, max(sizes) + 1) if size <= len(known)}
                begins = in_table(words.hashes, first)
                for size in sizes:
                    if size not in grams:
                        continue
                    hashes, whole = grams[size]
                    at = begins[: len(hashes)] & whole
                    for k in range(1, size):
                        at &= known[k : k + len(hashes)]
                    at = np.flatnonzero(at)
                    for shorter in range(2, size):
                        if shorter in found:
                            at = at[in_table(grams[shorter][0][at], found[shorter])]
                    values, place, n = np.unique(hashes[at], return_index=True, return_counts=True)
                    place = at[place]
                    rests = [
                        signed(grams[size - k][0][place + k]) if size - k >= 2 else np.zeros(len(place), np.int64) for k in (1, 2, 3)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in (np.full(len(place), size, np.int32), signed(values), n.astype(np.int64), *rests)],
                        ["size", "h", "n", "r1", "r2", "r3"],
                    )

    return task


def _exact(tables):
    """``lang, phrase, size, n`` of the wanted phrases, and the range of the hashes of the words before and behind them."""

    def task(batches):
        frequent, wanted = tables.value
        names = ["lang", "phrase", "size", "n", "before_low", "before_high", "behind_low", "behind_high"]
        for batch in batches:
            for words, langs in read_words(batch):
                known, none = in_table(words.hashes, frequent), np.zeros(1, np.uint64)
                linked = np.concatenate([[False], words.goes_on])  # is word i linked with the one before it
                beside = np.concatenate([none, words.hashes, none])
                for size in range(2, min(LONGEST, len(known)) + 1):
                    hashes, whole = words.grams(size)
                    at = whole & in_table(hashes, wanted)
                    for k in range(size):
                        at &= known[k : k + len(hashes)]
                    at = np.flatnonzero(at)
                    if not len(at):
                        continue
                    at = at[np.argsort(hashes[at], kind="stable")]
                    runs_at = np.flatnonzero(np.concatenate([[True], hashes[at][1:] != hashes[at][:-1]]))
                    before = signed(np.where(linked[at], beside[at], none))
                    behind = signed(np.where(linked[at + size], beside[at + size + 1], none))
                    firsts = at[runs_at]
                    columns = [
                        pa.array([langs[c] for c in words.lang[firsts].tolist()], pa.string()),
                        pa.array([words.phrase(i, size) for i in firsts.tolist()], pa.string()),
                        pa.array(np.full(len(firsts), size, np.int32)), pa.array(np.diff(np.append(runs_at, len(at)))),
                    ]
                    for side in (before, behind):
                        columns += [pa.array(f.reduceat(side, runs_at)) for f in (np.minimum, np.maximum)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return task


# --- search ------------------------------------------------------------------------------


def _first_share(words: DataFrame, langs: DataFrame, share: float) -> DataFrame:
    """``lang, upto``: first words up to this count make up about ``share`` of the words, one octave of counts at least."""
    octaves = words.groupBy("lang", F.floor(F.log2("f") + 1e-9).cast("int").alias("octave")).agg(F.sum("f").alias("mass"))
    order = W.partitionBy("lang").orderBy("octave")  # some forty rows a language
    summed = octaves.withColumn("so_far", F.sum("mass").over(order)).withColumn("k", F.row_number().over(order))
    fits = summed.join(langs, "lang").where((F.col("k") == 1) | (F.col("so_far") <= F.col("n") * share))
    return fits.groupBy("lang").agg((F.pow(F.lit(2.0), F.max("octave") + 1) - 1).cast("long").alias("upto"))


def _top(rows: DataFrame, top: int) -> DataFrame:
    """The best ``top`` rows of each language with their ``rank``; no task sorts a whole language."""
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANKED_APART)))
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long"))
    return rows.where(F.col("rank") <= top).drop("part")


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """``floor(1000 * a * n / (l * r))``, exact beyond 64 bits."""
    wide = [c.cast("decimal(19,0)") for c in (a, n, left, right)]
    return F.call_function("div", wide[0] * wide[1] * F.lit(1000), wide[2] * wide[3])


def scored_phrases(found: DataFrame, words: DataFrame, langs: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score, dropped`` of ``found`` phrases whose parts are all in ``found`` or ``words``."""
    counts = words.select("lang", "phrase", F.col("f").alias("count")).unionByName(found.select("lang", "phrase", F.col("a").alias("count")))
    in_longer = (F.col("size") < LONGEST) & (
        ((F.col("before_low") == F.col("before_high")) & (F.col("before_low") != 0))
        | ((F.col("behind_low") == F.col("behind_high")) & (F.col("behind_low") != 0))
    )
    part = lambda start, size: F.array_join(F.slice(F.split("phrase", " "), start, size), " ")
    cuts = (
        found.where("fresh").withColumn("dropped", in_longer).join(langs, "lang")
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
        .select("lang", "phrase", "a", "n", "dropped", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.lit(LONGEST)).alias("right"))
    )
    side = lambda name, out: counts.select("lang", F.col("phrase").alias(name), F.col("count").alias(out))
    cuts = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
    cuts = cuts.withColumn("score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "a", "n", "dropped").agg(best).select(
        "lang", "phrase", "a", "best.l", "best.r", "n", "best.score", "dropped"
    )


def mine_phrases(docs: DataFrame, least: int = 100, top: int = 2000, shares: Sequence[float] = SHARES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best ``top`` phrases of at least ``least`` occurrences."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text is not null")
    vocabulary = map_texts(texts, _word_counts, "lang string, phrase string, h long, n long")
    vocabulary = written(vocabulary.groupBy("lang", "phrase").agg(F.sum("n").alias("f"), F.max("h").alias("h")), "vocabulary")
    langs = written(vocabulary.groupBy("lang").agg(F.sum("f").alias("n")), "langs")
    words = written(vocabulary.where(F.col("f") >= least), "words")
    frequent = bit_table(words, "h")

    # Expanded so far: first words with counts up to ``done``; the score that the next ones must reach: ``settled``.
    state = langs.select("lang", "n", F.lit(0).cast("long").alias("done"), F.lit(None).cast("long").alias("settled"))
    found, best = None, None
    for share in (*shares, None):
        reach = F.coalesce(F.expr("1000 * n div settled"), F.col("n"))
        if share is not None:
            state = state.join(_first_share(words, langs, share), "lang", "left")
            reach = F.least(reach, F.coalesce("upto", F.lit(0)))
        plan = state.select("lang", "n", "done", "settled", F.greatest(F.col("done"), reach).alias("next"))
        plan = written(plan, "plan")
        opened = words.join(plan.drop("n"), "lang").where("f > done and f <= next").select("lang", "phrase", "h")
        opened = written(opened, "opened")
        if not opened.isEmpty():
            more = _expand(texts, opened, words, frequent, least)
            found = more if found is None else written(
                found.withColumn("fresh", F.lit(False)).unionByName(more).groupBy("lang", "phrase").agg(
                    F.max("fresh").alias("fresh"), *[F.max(c).alias(c) for c in more.columns if c not in ("lang", "phrase", "fresh")]
                ),
                "found",
            )
            kept = scored_phrases(found, words, langs).where("not dropped").drop("dropped")
            best = written(_top((kept if best is None else kept.unionByName(best.drop("rank"))), top), "best")
        state = plan.select("lang", "n", F.col("next").alias("done"))
        if best is None:
            state = state.withColumn("settled", F.lit(None).cast("long"))
        else:
            last = best.where(F.col("rank") == top).select("lang", F.greatest("score", F.lit(1)).cast("long").alias("settled"))
            state = state.join(last, "lang", "left")
    schema = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
    if best is None:
        return spark.createDataFrame([], schema)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _expand(texts: DataFrame, opened: DataFrame, words: DataFrame, frequent: np.ndarray, least: int) -> DataFrame:
    """Exact counts of all candidates that grow from the ``opened`` first words (``fresh``), and of their parts."""
    sc = texts.sparkSession.sparkContext
    first, found, grown = bit_table(opened, "h"), {}, None
    for sizes in ((2,), (3,), (4, LONGEST)):
        tables = sc.broadcast((first, frequent, found))
        counts = map_texts(texts, _grown(sizes, tables), "size int, h long, n long, r1 long, r2 long, r3 long")
        sums = counts.groupBy("size", "h").agg(F.sum("n").alias("n"), *[F.max(c).alias(c) for c in ("r1", "r2", "r3")])
        level = written(sums.where(F.col("n") >= least), "grown")
        tables.unpersist()
        grown = level if grown is None else grown.unionByName(level)
        if sizes[-1] < LONGEST:
            found[sizes[0]] = bit_table(level, "h")
    tables = sc.broadcast((frequent, bit_table(grown, "h", "r1", "r2", "r3")))
    schema = "lang string, phrase string, size int, n long, before_low long, before_high long, behind_low long, behind_high long"
    counts = map_texts(texts, _exact(tables), schema)
    sides = [f(f"{side}_{end}").alias(f"{side}_{end}") for side in ("before", "behind") for end, f in (("low", F.min), ("high", F.max))]
    exact = counts.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("a"), *sides).where(F.col("a") >= least)
    begun = opened.select("lang", F.col("phrase").alias("begin"), F.lit(True).alias("is_open"))
    exact = exact.withColumn("begin", F.substring_index("phrase", " ", 1)).join(begun, ["lang", "begin"], "left")
    return written(exact.withColumn("fresh", F.coalesce("is_open", F.lit(False))).drop("begin", "is_open"), "exact")
