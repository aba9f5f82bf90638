"""Document fingerprints: a homomorphic multiset hash of paragraphs. DataFrame functions only.

Each paragraph (a line) is hashed to a wide vector, and a text's fingerprint is the sum of the
vectors of its paragraphs, coordinate by coordinate, modulo a power of two. So the order of
paragraphs does not matter, and one can be added or taken away without the rest of the text.

A vector has two kinds of coordinates:

* 16 of 32 bits, uniform hashes of the whole paragraph. They tell texts apart.
* 128 of 24 bits, signs (+1 or -1) summed over the paragraph's pieces of a few words. They are small where
  they differ little: their cosine estimates how much two texts have in common (a standard error of 0.09).

Pieces are cut by content, in any script: one ends after a token where a hash of it and the token before, if in the
same line, is 0 modulo 3, so an edit moves only the pieces next to it. A token is a word; from U+0E00 on (the scripts without
blanks are there), and beyond the 24th character of a word, it is a character, and the hash is taken modulo 9.

A null text counts as empty; empty texts have one empty paragraph. Repeated rows and ties in the id are
ordered by the text's hash; rows without an id come last. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Uniform coordinates are 2 halves for each of these seeds.
SEEDS = tuple(range(101, 109))
SIGN_SEEDS = (7, 8)
WIDE, WIDE_BITS = 2 * len(SEEDS), 32
SIGNS, SIGN_BITS = 64 * len(SIGN_SEEDS), 24
_BLANK = r" \t\x0B\f\r"
_LONG = 24
#: What a token can begin with: no blank, and not the second half of a character of two.
_FIRST = rf"(?=[^{_BLANK}\n\uDC00-\uDFFF])"
#: Before a token: after blanks, a line end, each character from U+0E00 on (Thai, Han, kana and others), each after the 24th of a word.
TOKEN_START = rf"(?<=\n)|(?<=[{_BLANK}])(?=[^{_BLANK}\n])"
TOKEN_START_ANY = rf"{TOKEN_START}|(?<=[\u0E00-\uFFFF]){_FIRST}|(?<=[^{_BLANK}\n]{{{_LONG}}}){_FIRST}"
_ANY = rf"[\u0E00-\x{{10FFFF}}]|(?<![^{_BLANK}\n])[^{_BLANK}\n]{{{_LONG + 1}}}"
#: One token in so many ends a piece: of words, and of characters that are tokens.
PIECE_WORDS, PIECE_CHARS = 3, 9
PIECE_SEED = 29
_CUT = "\u0001"

#: Most blocks of consecutive ids: each keeps one row in a broadcast table.
MOST_BLOCKS = 16_384

_PAIR = (1 << 32) | 1
_LOW = (1 << 32) - 1


def paragraph_sums(texts: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """``keys``, ``wide`` and ``signs`` (arrays of long): the fingerprint of each group of texts.

    If the keys already are where the partitioning puts them, nothing is shuffled.
    """
    tokens = F.when(F.rlike(text, F.lit(_ANY)), F.split(text, TOKEN_START_ANY)).otherwise(F.split(text, TOKEN_START))
    paragraphs = F.transform(F.split(text, "\n"), lambda p: F.concat(F.lit("\n"), p))
    texts = texts.select(*keys, paragraphs.alias("__paragraphs"), tokens.alias("__tokens"))
    pieces = F.split(F.array_join(F.transform("__tokens", _marked), ""), f"[\n{_CUT}]+")
    units = texts.select(*keys, F.explode(F.concat("__paragraphs", pieces)).alias("u"))
    whole = F.startswith("u", F.lit("\n"))
    units = units.where(F.col("u") != "").select(
        *keys,
        F.when(whole, 0).otherwise(1).alias("pieces"),
        *[F.when(whole, F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(s), "u")).alias(f"s{s}") for s in SIGN_SEEDS],
        *[F.when(whole, F.xxhash64(F.lit(s), "u")).otherwise(F.lit(0).cast("long")).alias(f"w{s}") for s in SEEDS],
    )
    sums = [F.sum("pieces").alias("pieces")]
    for s in SEEDS:
        sums.append(F.sum(F.col(f"w{s}").bitwiseAND(F.lit(_LOW))).alias(f"w{s}_0"))
        sums.append(F.sum(F.shiftrightunsigned(f"w{s}", 32)).alias(f"w{s}_1"))
    for s in SIGN_SEEDS:
        # Two counters to a long, 32 bits apart; no text has the 2^31 pieces to make one run over.
        sums += [
            F.sum(F.shiftrightunsigned(f"s{s}", k).bitwiseAND(F.lit(_PAIR))).alias(f"s{s}_{k}") for k in range(32)
        ]
    wide = F.array(*[F.col(f"w{s}_{h}").bitwiseAND(F.lit(_LOW)) for s in SEEDS for h in (0, 1)])
    ones = [
        half
        for s in SIGN_SEEDS for k in range(32)
        for half in (F.col(f"s{s}_{k}").bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(f"s{s}_{k}", 32))
    ]
    signs = F.transform(F.array(*ones), lambda c: _wrapped(2 * c - F.col("pieces")))
    return units.groupBy(*keys).agg(*sums).select(*keys, wide.alias("wide"), signs.alias("signs"))


def _marked(token: Column, at: Column) -> Column:
    """``token``, with a mark behind it if a piece ends there."""
    before = F.get(F.col("__tokens"), at - 1)
    before = F.when(~F.endswith(before, F.lit("\n")), before)
    most = F.when(F.char_length(token) == 1, PIECE_CHARS).otherwise(PIECE_WORDS)
    ends = F.pmod(F.xxhash64(F.lit(PIECE_SEED), before, token), most) == 0
    return F.when(ends, F.concat(token, F.lit(_CUT))).otherwise(token)


def _wrapped(x: Column) -> Column:
    """``x`` modulo 2^24, as a number between -2^23 and 2^23."""
    half = 1 << (SIGN_BITS - 1)
    return F.pmod(x + half, F.lit(1 << SIGN_BITS).cast("long")) - half


def added(a: Column, b: Column) -> Column:
    """The fingerprint (a struct of ``wide`` and ``signs``) of two texts' paragraphs together."""
    return F.struct(
        F.zip_with(a["wide"], b["wide"], lambda x, y: (x + y).bitwiseAND(F.lit(_LOW))).alias("wide"),
        F.zip_with(a["signs"], b["signs"], lambda x, y: _wrapped(x + y)).alias("signs"),
    )


def removed(a: Column, b: Column) -> Column:
    """The fingerprint of ``a`` without the paragraphs of ``b``."""
    return F.struct(
        F.zip_with(a["wide"], b["wide"], lambda x, y: (x - y).bitwiseAND(F.lit(_LOW))).alias("wide"),
        F.zip_with(a["signs"], b["signs"], lambda x, y: _wrapped(x - y)).alias("signs"),
    )


def as_text(wide: Column, signs: Column) -> Column:
    """A fingerprint in hexadecimal digits: 8 for each uniform coordinate, 6 for each sum of signs."""
    return F.concat(
        F.array_join(F.transform(wide, lambda x: F.lpad(F.hex(x), 8, "0")), ""),
        F.array_join(F.transform(signs, lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit((1 << SIGN_BITS) - 1))), 6, "0")), ""),
    )


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x).cast("double")


def likeness(a: Column, b: Column) -> Column:
    """How much two fingerprints (structs of ``wide, signs, norm``) have in common: 1 for equal ones, else the
    cosine of their sign sums, not below 0."""
    both = F.sqrt(a["norm"] * b["norm"])
    cosine = F.when(both > 0, _dot(a["signs"], b["signs"]) / both).otherwise(0.0)
    return F.when(a["wide"] == b["wide"], F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def in_blocks(docs: DataFrame, blocks: int) -> DataFrame:
    """``block, ghost, doc_id, text``: rows by descending id, dealt into blocks of consecutive ids.

    Block borders are quantiles of the ids. The rows that begin a block stand a second time, as
    ghosts, at the end of the block before (for the first block: of the last one), so that each row
    finds the row that follows it in its own block.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = max(1, min(blocks, MOST_BLOCKS))
    parts = [k / blocks for k in range(1, blocks)] or [0.5]
    borders = rows.agg(F.percentile_approx("doc_id", parts, F.lit(max(10_000, 8 * blocks)))).scalar()
    # Borders at or below the id, by binary search.
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(parts).bit_length()))])
    below = F.aggregate(
        steps, F.lit(0),
        lambda at, step: F.when(F.get(F.col("__borders"), at + step - 1) <= F.col("doc_id"), at + step).otherwise(at),
    )
    placed = rows.withColumn("__borders", borders).withColumn(
        "block", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(below)
    ).drop("__borders")
    # Higher ids are in higher blocks. One row per block, MOST_BLOCKS + 1 at most.
    up = W.orderBy("block")
    heads = (
        placed.groupBy("block").agg(F.max("doc_id").alias("head"))
        .select(
            F.col("block").alias("h_block"), "head",
            F.coalesce(F.lead("block").over(up), F.first("block").over(up)).alias("before"),
        )
    )
    dealt = placed.join(F.broadcast(heads), F.col("block") == F.col("h_block"))
    own = F.struct(F.col("block").alias("block"), F.lit(False).alias("ghost"))
    again = F.struct(F.col("before").alias("block"), F.lit(True).alias("ghost"))
    places = F.when(F.col("doc_id").eqNullSafe(F.col("head")), F.array(own, again)).otherwise(F.array(own))
    return dealt.select(F.explode(places).alias("p"), "doc_id", "text").select("p.block", "p.ghost", "doc_id", "text")


def fingerprint_edits(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """Fingerprints of each text, and of the text with its latter half replaced from the next document.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    The next document is the one with the next smaller id; after the last comes the first. Texts are
    shuffled once, by block; all that follows stays in place.
    """
    if blocks is None:
        blocks = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = in_blocks(docs, blocks).withColumn("tie", F.xxhash64("text"))
    order = W.partitionBy("block").orderBy("ghost", F.col("doc_id").desc_nulls_last(), "tie")
    n = F.char_length("text").cast("long")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    paired = (
        rows.withColumn("next", F.lead("text").over(order)).withColumn("pos", F.row_number().over(order))
        .withColumn("n_chars", n)
        .withColumn("edited", F.concat(
            F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
            F.substring(F.coalesce("next", F.lit("")), F.lit(1), half),
        ))
        .withColumn("digest", F.unhex(F.sha2("edited", 256)))
    )
    both = F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")),
    )
    kept = F.when(F.col("ghost"), F.slice(both, 1, 1)).otherwise(both)
    keys = ["block", "pos", "ghost", "doc_id", "n_chars", "digest"]
    texts = paired.select(*keys, F.explode(kept).alias("t")).select(*keys, "t.which", "t.text")
    sums = paragraph_sums(texts, [*keys, "which"])
    prints = sums.select(
        *keys, "which", F.struct("wide", "signs", _dot(F.col("signs"), F.col("signs")).alias("norm")).alias("own")
    )
    along = W.partitionBy("block").orderBy("pos", "which")
    found = prints.withColumn("edited", F.lead("own", 1).over(along)).withColumn("following", F.lead("own", 2).over(along))
    return found.where((F.col("which") == 0) & ~F.col("ghost")).select(
        "doc_id", "n_chars", F.lower(F.hex("digest")).alias("edited_sha256"),
        as_text(F.col("own.wide"), F.col("own.signs")).alias("fingerprint"),
        as_text(F.col("edited.wide"), F.col("edited.signs")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
