"""Near-duplicate documents: fast similarity sketches, banding, exact verification, components.

A document's set holds its distinct word shingles. Its sketch has ``t`` coordinates: in round i
each shingle falls into one of ``t`` bins and writes the round and a hash there; a bin keeps its
earliest, then smallest entry. After ``t`` rounds of random bins, ``t`` rounds address each bin in turn, so
every coordinate is filled; most documents need a few rounds. Coordinates agree with the chance of
the Jaccard similarity. Bands of coordinates are bucketed, and pairs are confirmed on full sets.

Equal sets are one node, known by its smallest id, so groups of copies are one row in all that
follows. In a bucket, all nodes are first confirmed against the smallest one. Where a bucket still holds several
components, its nodes are bucketed anew by the rarest shingles of their sets: two sets of the wanted
similarity share one of those (prefix filtering, exact under any common order of shingles). Where the first one shared
stands tells how much two sets can have in common at most, which leaves few pairs (positional filtering,
exact too). Nodes that differ too much have no partner, so hot groups fall apart. These buckets are worked off leader by
leader, smallest components first, until none holds an unconfirmed pair of different components. So no
link between nodes that met in a bucket is lost, and no group is spread into all its pairs.

Null, empty and blank texts have an empty set and are linked with nothing. With fewer words than a
shingle takes, the whole sequence is one shingle. Rows with the same id count as one document
(linked if any of its rows is); a row without an id is linked with nothing and kept. An empty table gives an
empty result. Only ``doc_id`` and ``text`` are read. A shingle is known by a 64-bit hash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.textkit import (
    map_texts, mixed, runs, shingle_sets, signed, span_hashes, text_buffers, unused, word_spans,
)
from millrace.operators.components import component_roots
from millrace.session import written, written_counting

#: Coordinates per band.
BAND = 6
#: A pair at the threshold is missed by all bands with at most this chance.
MISS = 1e-6
#: Leaders per bucket and round once the smallest node of each bucket is dealt with.
LEADERS = 512
#: Counters that tell rare shingles from frequent ones; they only order shingles, so collisions lose nothing.
COUNTERS = 1 << 18
#: Shingles that are compared with one copy of a leader's set, before another task takes over.
SHARE = 4_000_000
#: Up to so many rows of 24 bytes, the list of documents to fetch is broadcast; beyond, it is joined by shuffle.
FEW = 300_000

_INF = np.uint64(0xFFFFFFFFFFFFFFFF)
_ROUND = 0x9E3779B97F4A7C15


def bands_for(similarity: float) -> int:
    return max(1, math.ceil(math.log(MISS) / math.log1p(-(similarity**BAND))))


def sketch(sets: list[np.ndarray], t: int) -> np.ndarray:
    """A row of ``t`` filled coordinates for each set; none of the sets may be empty."""
    n = len(sets)
    out = np.full((n, t), _INF)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    values = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    rows = np.repeat(np.arange(n), sizes)
    flat = out.reshape(-1)
    low = np.uint64(0xFFFFFFFF)
    for i in range(2 * t):
        h = mixed(values + np.uint64((i + 1) * _ROUND & 0xFFFFFFFFFFFFFFFF))
        if i < t:
            bins = (((h >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)).astype(np.int64)
        else:
            bins = i - t
        np.minimum.at(flat, rows * t + bins, (h & low) | np.uint64(i << 32))
        unfilled = (out == _INF).any(axis=1)
        if not unfilled.any():
            break
        keep = unfilled[rows]
        if not keep.all():
            rows, values = rows[keep], values[keep]
    return out


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    """A bucket for each band of each row; bands never share buckets but by chance."""
    n, t = coordinates.shape
    parts = mixed(coordinates).reshape(n, t // BAND, BAND)
    keys = np.zeros((n, t // BAND), np.uint64)
    for k in range(BAND):
        keys = keys * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, k]
    return mixed(keys + np.arange(t // BAND, dtype=np.uint64))


def _sets_of(column, size: int):
    """Runs of rows with their shingle sets: (first row, sets)."""
    data, offsets = text_buffers(column)
    for a, b in runs(offsets):
        starts, ends, bounds = word_spans(data, offsets[a : b + 1])
        yield a, shingle_sets(span_hashes(data, starts, ends, lower=True), bounds, size)


def _profile(size: int, t: int):
    def task(batches):
        names = ["doc_id", "n", "set_a", "set_b", "bands"]
        for batch in batches:
            ids = batch.column(0)
            for a, sets in _sets_of(batch.column(1), size):
                n = np.fromiter(map(len, sets), np.int64, len(sets))
                full = [s for s in sets if len(s)]
                bands = np.zeros((len(sets), t // BAND), np.uint64)
                if full:
                    bands[n > 0] = band_keys(sketch(full, t))
                set_a = np.array([np.bitwise_xor.reduce(mixed(s)) for s in sets], np.uint64)
                set_b = np.array([mixed(s + np.uint64(_ROUND)).sum(dtype=np.uint64) for s in sets], np.uint64)
                flat = pa.array(signed(bands).ravel())
                marks = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * (t // BAND))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, len(sets)), pa.array(n), pa.array(signed(set_a)), pa.array(signed(set_b)),
                        pa.ListArray.from_arrays(marks, flat),
                    ],
                    names,
                )

    return task


def _compare(size: int):
    """Rows sorted by (leader, part, role): the leader's text, then those of its partners."""

    def task(batches):
        leader, held = None, []
        for batch in batches:
            leads, parts, roles, ids = (batch.column(k).to_pylist() for k in range(4))
            found: list[tuple] = []
            for a, sets in _sets_of(batch.column(4), size):
                for k, s in enumerate(sets, a):
                    if roles[k] == 0:
                        # Rows of one id are one document, linked if any of them is: each is compared by itself.
                        if leader != (leads[k], parts[k]):
                            leader, held = (leads[k], parts[k]), []
                        if len(s) and not any(np.array_equal(s, h) for h in held):
                            held.append(s)
                    elif leader == (leads[k], parts[k]) and len(s):
                        for other in held:
                            small, large = (s, other) if len(s) <= len(other) else (other, s)
                            at = np.searchsorted(large, small)
                            at[at == len(large)] = 0
                            shared = int(np.count_nonzero(large[at] == small))
                            found.append((leads[k], ids[k], shared, len(s) + len(other) - shared))
            columns = list(zip(*found)) if found else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["a", "b", "shared", "either"]
            )

    return task


def _texts_of(docs: DataFrame, wanted: DataFrame, rows: int) -> DataFrame:
    """``docs`` joined with ``wanted`` on ``id``; that is broadcast only if it has few rows."""
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    return texts.join(F.broadcast(wanted) if rows <= FEW else wanted, "id")


def compared(docs: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """``a, b, shared, either``: sizes of intersection and union of the full sets of each pair.

    ``pairs`` has ``a, b`` (``a`` the leader) and ``nb``, the set size of ``b``. Each partner's text goes to its
    leader once; a leader with many partners has several parts, each with a copy of its text.
    """
    loads = pairs.groupBy("a").agg(F.ceil(F.sum("nb") / SHARE).alias("parts"))
    spread = pairs.join(loads, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.greatest("parts", F.lit(1))).alias("part")
    )
    wanted = spread.select("a", "part", F.lit(1).alias("role"), F.col("b").alias("id")).unionByName(
        spread.select("a", "part").distinct().select("a", "part", F.lit(0).alias("role"), F.col("a").alias("id"))
    )
    wanted, seen = written_counting(wanted, "wanted", n=F.count(F.lit(1)))
    rows = _texts_of(docs, wanted, seen["n"]).select("a", "part", "role", "id", "text")
    rows = rows.repartition("a", "part").sortWithinPartitions("a", "part", "role")
    return written(map_texts(rows, _compare(size), "a long, b long, shared long, either long"), "compared")


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(46)).astype(np.int64)


def _frequencies(size: int):
    def task(batches):
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for _, sets in _sets_of(batch.column(1), size):
                counts += np.bincount(_counter(np.concatenate(sets)), minlength=COUNTERS)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], ["counter", "n"])

    return task


def _prefixes(size: int, counts: np.ndarray, part: int, whole: int):
    def task(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            keys, rows, sizes, most = [], [], [], []
            for a, sets in _sets_of(batch.column(1), size):
                for k, s in enumerate(sets, a):
                    order = np.lexsort((s, counts[_counter(s)]))
                    first = s[order[: len(s) - (-(-part * len(s) // whole)) + 1]]
                    keys.append(first)
                    rows += [ids[k]] * len(first)
                    sizes += [len(s)] * len(first)
                    # If nothing before it is shared, the other set has at most so many shingles.
                    most.append((len(s) - np.arange(len(first))) * (whole + part) // part - len(s))
            flat = signed(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(flat), pa.array(rows, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array(np.concatenate(most) if most else np.zeros(0, np.int64)),
                ],
                ["bucket", "id", "n", "most"],
            )

    return task


def rare_shingles(docs: DataFrame, ids: DataFrame, size: int, part: int, whole: int) -> DataFrame:
    """``bucket, id, n, most``: the shingles of each named document that come first when rare ones do, so many
    that two sets linked have one in common; ``most`` bounds the size of a set linked whose first shared shingle it is."""
    ids, seen = written_counting(ids, "ids", n=F.count(F.lit(1)))
    texts = _texts_of(docs, ids, seen["n"]).select("id", "text")
    found = (
        map_texts(texts, _frequencies(size), "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    )
    counts = np.zeros(COUNTERS, np.int64)  # at most COUNTERS rows came
    counts[np.asarray(found["counter"])] = np.asarray(found["n"])
    return map_texts(texts, _prefixes(size, counts, part, whole), "bucket long, id long, n long, most long")


def _component_roots(links: DataFrame) -> DataFrame:
    """``node, root`` of all nodes of ``links`` (``a, b``).

    First each node hangs on its smallest partner only; the other links then run between few components.
    """
    hooks = links.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    first = written(component_roots(hooks), "hooks")
    of = lambda side: first.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
    over = (
        links.join(of("a"), "a", "left").join(of("b"), "b", "left")
        .select(F.coalesce("root_a", "a").alias("x"), F.coalesce("root_b", "b").alias("y")).where("x <> y")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    )
    second = component_roots(written(over, "over")).select(F.col("node").alias("root"), F.col("root").alias("top"))
    moved = first.join(second, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return written(moved, "roots")


def _named(slots: DataFrame, roots: DataFrame) -> DataFrame:
    """``slots`` with their component, of the buckets that hold several components."""
    named = slots.drop("comp").join(roots, F.col("id") == F.col("node"), "left")
    named = named.withColumn("comp", F.coalesce("root", "id")).drop("node", "root")
    several = (
        named.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("bucket")
    )
    return named.join(several, "bucket")


def _open(slots: DataFrame, roots: DataFrame) -> DataFrame:
    """The slots that may still have a partner of another component in their bucket."""
    named = _named(slots, roots)
    bounds = named.groupBy("bucket").agg(F.min("n").alias("smallest"), F.max("most").alias("largest"))
    fitting = named.join(bounds, "bucket").where("most >= smallest and n <= largest").drop("smallest", "largest")
    several = (
        fitting.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("bucket")
    )
    return fitting.join(several, "bucket")


def _cross_pairs(left: DataFrame, part: int, whole: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of a leader and a node of another component, and the slots that are left without the leaders."""
    held = left.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("held"))
    order = W.partitionBy("bucket").orderBy("held", "comp", "id")
    leaders = written(
        left.join(held, ["bucket", "comp"]).withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= LEADERS)
        .select("bucket", *[F.col(c).alias(f"l_{c}") for c in ("id", "n", "most", "comp", "place")]),
        "leaders",
    )
    places = leaders.select("bucket", F.col("l_id").alias("id"), "l_place").groupBy("bucket", "id").agg(
        F.min("l_place").alias("place")
    )
    # A pair of two leaders is taken once; other slots stand behind every leader.
    met = left.join(places, ["bucket", "id"], "left").join(leaders, "bucket").where(
        (F.col("comp") != F.col("l_comp")) & (F.coalesce("place", F.lit(LEADERS + 1)) > F.col("l_place"))
        & (whole * F.least("n", "l_n") >= part * F.greatest("n", "l_n"))
        & (F.col("n") <= F.col("l_most")) & (F.col("l_n") <= F.col("most"))
    )
    pairs = met.groupBy(F.least("id", "l_id").alias("a"), F.greatest("id", "l_id").alias("b")).agg(F.max("n").alias("nb"))
    return pairs, left.join(places.drop("place"), ["bucket", "id"], "left_anti")


def _text_mark() -> Column:
    """Tells texts with a word apart; null for others."""
    return F.when(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.sha2("text", 256))


def repeated_texts(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``seen``: marks of the texts that one ``key`` has more than once, or rows without a ``key`` have as well."""
    pairs = docs.select(_text_mark().alias("seen"), F.col(key).alias("key")).where("seen is not null").groupBy("seen", "key")
    totals = pairs.agg(F.count(F.lit(1)).alias("n")).groupBy("seen").agg(F.sum("n").alias("n"), F.count("key").alias("keys"))
    return written(totals.where("n > 1 and n > keys").select("seen"), "repeated")


def one_row_per_text(docs: DataFrame, repeated: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose text an earlier row has, for the texts in ``repeated``: the row with the smallest ``key``
    stays, one without a key only where no other has one. Other rows stay as they are, texts without a word among them.
    """
    if repeated.isEmpty():
        return docs
    mark, seen, place = unused(docs, "text_mark", "mark_again", "mark_place")
    marked, again = docs.withColumn(mark, _text_mark()), repeated.select(F.col("seen").alias(seen))
    alone = marked.join(again, F.col(mark) == F.col(seen), "left_anti")
    # Equal rows of a task become one before they meet the others.
    found = marked.join(again, F.col(mark) == F.col(seen), "left_semi").dropDuplicates([mark, key])
    order = W.partitionBy(mark).orderBy(F.col(key).asc_nulls_last())
    firsts = found.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place)
    return alone.unionByName(firsts).drop(mark)


def near_duplicates(docs: DataFrame, size: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    Two documents are linked if ``whole * shared >= part * either`` for their sets of ``size``-word
    shingles. A component is named by its smallest id, and that document is kept.
    """
    t = bands_for(part / whole) * BAND
    profile = written(
        map_texts(
            docs.select(F.col("doc_id").cast("long"), "text"), _profile(size, t),
            "doc_id long, n long, set_a long, set_b long, bands array<long>",
        ),
        "profile",
    )
    filled = profile.where("n > 0 and doc_id is not null")
    classes = filled.groupBy("set_a", "set_b", "n").agg(F.min("doc_id").alias("rep"))
    reps = classes.select(F.col("rep").alias("id")).distinct()
    members = written(
        filled.drop("bands").join(classes, ["set_a", "set_b", "n"]).select("doc_id", "rep").distinct(), "members"
    )

    spread = filled.join(reps, filled["doc_id"] == reps["id"]).select(F.explode("bands").alias("bucket"), "id", "n")
    shared = (
        spread.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low < high").select("bucket", "low")
    )
    slots = written(spread.join(shared, "bucket"), "slots")
    pairs = slots.where("id > low").groupBy(F.col("low").alias("a"), F.col("id").alias("b")).agg(F.max("n").alias("nb"))
    tested = compared(docs, pairs, size)
    linked = F.expr(f"{whole} * shared >= {part} * either")
    # Rows with one id are one node, whatever their texts.
    same = members.where("doc_id <> rep and rep is not null").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    links = tested.where(linked).select("a", "b").unionByName(same)
    roots = _component_roots(links)

    ids = _named(slots, roots).select("id").distinct()
    left, seen = written_counting(_open(rare_shingles(docs, ids, size, part, whole), roots), "left", n=F.count(F.lit(1)))
    while seen["n"]:
        pairs, rest = _cross_pairs(left, part, whole)
        pairs = pairs.join(tested.select("a", "b").distinct(), ["a", "b"], "left_anti")
        more = compared(docs, pairs, size)
        tested = tested.unionByName(more)
        links = links.unionByName(more.where(linked).select("a", "b"))
        roots = _component_roots(links)
        left, seen = written_counting(_open(rest, roots), "left", n=F.count(F.lit(1)))

    parts = (
        members.join(roots, members["doc_id"] == roots["node"], "left")
        .groupBy("doc_id").agg(F.min(F.coalesce("root", "rep")).alias("component_id"))
        .withColumnRenamed("doc_id", "__member")
    )
    return (
        profile.select("doc_id", F.col("n").alias("n_shingles"))
        .join(parts, F.col("doc_id") == F.col("__member"), "left")
        .select(
            "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
            F.coalesce(F.coalesce("component_id", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )
