"""Near duplicates by SimHash: fingerprints of 64 bits, linked where few bits differ, found by anchor points.

A text's fingerprint has a bit where more than half of its shingles' hashes have it. Texts are lower-cased (A-Z), words
are what stands between blanks, repeated shingles count as often as they stand, and a text with fewer words than a
shingle takes is one shingle as a whole.

Anchors are the words of a covering code: a perfect Hamming code on the first ``2^m - 1`` bits of a half, with any values of
its other bits, so every value of the half is within the covering radius 1 of an anchor. Of two fingerprints that differ in at
most ``MOST`` bits, one half differs in at most two, and a value halfway is within one of both. So each fingerprint goes to
every anchor within the covering radius plus one, half of the threshold of a half: what one member would have to do alone with
the whole threshold (5,000 anchors and more) both do together with 17 anchors a half. Members are compared per anchor, exactly.

An anchor with more than ``limit`` members is not worked off by one task: its members go on to anchors of the halves
of those bits that no anchor has fixed so far, and where these come to an end, blocks of members are compared pair by pair. Per
anchor only the links of a spanning forest come out; they join the same documents as all links. Nothing is left out at any size.

Equal fingerprints are one node from the start, so a group of copies is one row in all that follows. A null, empty or blank
text has the fingerprint zero and is linked like any other. Rows with one id, or without an id, are linked by their
texts like other rows; a component in which no row has an id is named null. An empty table gives an empty
result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.textkit import map_texts, mixed, signed
from millrace.operators.components import component_roots
from millrace.session import written, written_counting

SEED = 42
#: More differing bits than this would leave over two of them to each half.
MOST = 5
#: Members that one task compares for one anchor.
LIMIT = 4096
#: Bits of the last halves that still get anchors of their own.
NARROWEST = 8
#: Groups up to this size are compared side by side, larger ones one by one.
_FEW = 16
_PART = 1 << 16


def text_fingerprint(text: str | None, size: int) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(size, len(words))
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    counts, n, part = np.zeros(64, np.int64), len(words) - size + 1, []
    for a, b in spans:
        part.append(digest(joined[a:b], SEED))
        if len(part) == _PART:
            counts += _bit_counts(part)
            part = []
    if part:
        counts += _bit_counts(part)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _bit_counts(hashes: list[int]) -> np.ndarray:
    rows = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _fingerprints(size: int):
    def task(batches):
        for batch in batches:
            values = np.array([text_fingerprint(t, size) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed(values))], ["doc_id", "fp"])

    return task


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """``doc_id, fp`` of every row; ``fp`` holds the 64 bits as a signed number."""
    return map_texts(docs.select(F.col("doc_id").cast("long"), "text"), _fingerprints(size), "doc_id long, fp long")


# --- anchors -----------------------------------------------------------------------------


def hamming_bits(bits: int) -> int:
    """How many of ``bits`` the Hamming code takes."""
    return (1 << (bits + 1).bit_length() - 1) - 1


def near_anchors(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and anchors: all anchors that some value at most one bit from ``values[row]`` belongs to."""
    coded, one = hamming_bits(bits), np.uint64(1)
    places = np.arange(1, coded + 1, dtype=np.uint64)
    syndrome = np.zeros(len(values), np.uint64)
    for k in range(coded.bit_length()):
        mask = np.uint64(sum(1 << int(p) - 1 for p in places if int(p) >> k & 1))
        syndrome |= (np.bitwise_count(values & mask) & one).astype(np.uint64) << np.uint64(k)
    flip = lambda place: np.where(place > 0, one << np.maximum(place, one) - one, np.uint64(0))
    nearest = values ^ flip(syndrome)
    rows, anchors = [np.arange(len(values))], [nearest]
    for place in places:
        other = place ^ syndrome
        at = np.flatnonzero((syndrome > 0) & (other > place))
        rows.append(at)
        anchors.append(values[at] ^ flip(place) ^ flip(other[at]))
    for bit in range(coded, bits):
        rows.append(rows[0])
        anchors.append(nearest ^ (one << np.uint64(bit)))
    return np.concatenate(rows), np.concatenate(anchors)


def _to_anchors(bits: int):
    """``bucket, fp, low`` with the free bits ``low .. low + 2 * bits`` to rows at the anchors of either half."""

    def task(batches):
        for batch in batches:
            bucket, fp, low = (np.asarray(batch.column(k)) for k in range(3))
            if not len(fp):
                continue
            fp, out = fp.view(np.uint64), []
            for half in (0, 1):
                start = (low + half * bits).astype(np.uint64)
                rows, anchors = near_anchors((fp >> start) & np.uint64((1 << bits) - 1), bits)
                # Which half is meant stands above its bits; two buckets with one name would only cost time.
                name = mixed(mixed(bucket[rows].view(np.uint64)) ^ (anchors | np.uint64(half << bits)))
                out.append((signed(name), signed(fp[rows]), low[rows] + (1 - half) * bits))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["bucket", "fp", "low"])

    return task


# --- comparing ---------------------------------------------------------------------------


def forest(fps: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same members as all pairs within ``most`` bits do, one less than members in each component."""
    left, a, b = np.arange(len(fps)), [], []
    while len(left):
        reached, left = [int(left[0])], left[1:]
        while reached and len(left):
            at = reached.pop()
            near = np.bitwise_count(fps[left] ^ fps[at]) <= most
            if near.any():
                hit = left[near]
                a.append(np.full(len(hit), at))
                b.append(hit)
                reached += hit.tolist()
                left = left[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (left[:0], left[:0])


def _links_of_runs(bucket: np.ndarray, fp: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within each run of equal buckets."""
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    sizes = np.diff(np.append(starts, len(bucket)))
    a, b = [], []
    ends = np.repeat(starts + np.where(sizes <= _FEW, sizes, 0), sizes)
    at = np.arange(len(fp))
    for k in range(1, _FEW):
        at = at[at + k < ends[at]]
        if not len(at):
            break
        near = at[np.bitwise_count(fp[at] ^ fp[at + k]) <= most]
        a.append(fp[near])
        b.append(fp[near + k])
    for s, n in zip(starts[sizes > _FEW].tolist(), sizes[sizes > _FEW].tolist()):
        x, y = forest(fp[s : s + n], most)
        a.append(fp[s + x])
        b.append(fp[s + y])
    none = fp[:0]
    return (np.concatenate([none, *a]), np.concatenate([none, *b]))


def _compare(most: int, limit: int | None):
    """Sorted ``bucket, fp, low`` to links ``a, b`` and, of buckets over ``limit``, their rows (``b`` null)."""

    none, whole = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    names = ["a", "b", "bucket", "low"]

    def opened(bucket, fp, low):
        columns = [pa.array(signed(fp)), pa.nulls(len(fp), pa.int64()), pa.array(bucket), pa.array(low)]
        return pa.RecordBatch.from_arrays(columns, names)

    def linked(a, b):
        empty = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(signed(a)), pa.array(signed(b)), empty, empty], names)

    def task(batches):
        bucket, fp, low, over = whole, none, whole, None
        for batch in batches:
            more = [np.asarray(batch.column(k)) for k in range(3)]
            if over is not None:  # the bucket that is already known to be too large goes on
                n = int(np.searchsorted(more[0], over, "right")) if len(more[0]) else 0
                if n:
                    yield opened(more[0][:n], more[1][:n].view(np.uint64), more[2][:n])
                    more = [m[n:] for m in more]
            if not len(more[0]):
                continue
            over = None
            bucket, fp, low = (
                np.concatenate(c) for c in ((bucket, more[0]), (fp, more[1].view(np.uint64)), (low, more[2]))
            )
            last = int(np.searchsorted(bucket, bucket[-1]))
            yield from settled(bucket[:last], fp[:last], low[:last])
            bucket, fp, low = bucket[last:], fp[last:], low[last:]
            if limit is not None and len(bucket) > limit:
                yield opened(bucket, fp, low)
                over, bucket, fp, low = bucket[-1], whole, none, whole
        yield from settled(bucket, fp, low)

    def settled(bucket, fp, low):
        if not len(bucket):
            return
        if limit is not None:
            _, number, sizes = np.unique(bucket, return_inverse=True, return_counts=True)
            large = sizes[number] > limit
            if large.any():
                yield opened(bucket[large], fp[large], low[large])
                bucket, fp = bucket[~large], fp[~large]
        if len(bucket):
            a, b = _links_of_runs(bucket, fp, most)
            if len(a):
                yield linked(a, b)

    return task


def _in_blocks(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of large buckets, in buckets that hold two blocks of members each; every two blocks meet in one."""
    parts = rows.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / limit).alias("parts"))
    dealt = rows.join(parts, "bucket").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("parts")))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    pair = F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other"))
    return met.select(pair.alias("bucket"), "fp", "low").distinct()


def near_links(fps: DataFrame, most: int = 4, limit: int = LIMIT) -> DataFrame:
    """``a, b``: links among the distinct fingerprints ``fp``; they join the same as all pairs within ``most`` bits do."""
    if not 0 <= most <= MOST:
        raise ValueError(f"at most {MOST} differing bits, not {most}")
    schema, bits, links = "a long, b long, bucket long, low long", 32, []
    rows = fps.select(F.lit(0).cast("long").alias("bucket"), "fp", F.lit(0).cast("long").alias("low"))
    while True:
        narrow = bits < NARROWEST
        met = _in_blocks(rows, limit) if narrow else rows.mapInArrow(_to_anchors(bits), "bucket long, fp long, low long")
        met = met.repartition("bucket").sortWithinPartitions("bucket", "fp")
        found, seen = written_counting(
            met.mapInArrow(_compare(most, None if narrow else limit), schema), "met", open=F.count("bucket")
        )
        links.append(found.where("b is not null").select("a", "b"))
        if not seen["open"]:
            break
        rows, bits = found.where("b is null").select("bucket", F.col("a").alias("fp"), "low"), bits // 2
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def simhash_duplicates(docs: DataFrame, size: int = 4, most: int = 4, limit: int = LIMIT) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest id among the documents that links lead to."""
    prints = written(fingerprints(docs, size), "prints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = component_roots(near_links(nodes, most, limit))
    named = written(
        nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root")),
        "named",
    )
    # Most fingerprints are alone; only the others need the smallest id of their component.
    firsts = named.groupBy("root").agg(F.min("first").alias("component_id"))
    parts = written(named.join(firsts, "root").select("fp", "component_id"), "parts")
    return prints.join(parts, "fp").select("doc_id", "fp", "component_id")
