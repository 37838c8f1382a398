"""Join of texts to search patterns on a token both must contain."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the anchor filter for each anchor, and the fewest and the most bits it may have, as
#: powers of two (8 and 512 kB): a fuller filter lets more tokens through, no result depends on it.
BITS_PER_ANCHOR = 16
MIN_FILTER_BITS = 16
MAX_FILTER_BITS = 22
#: Bits, as a power of two, of the filter that tells common tokens.
COMMON_BITS = 16
#: Token rows of one anchor that one task joins; more are spread over salts.
SLICE_ROWS = 200_000


def _place(token: Column, bits: int) -> tuple[Column, Column]:
    slot = F.shiftrightunsigned(F.xxhash64(token), 64 - bits)
    return F.shiftright(slot, 6).cast("int"), slot.bitwiseAND(63).cast("int")


def _marked(anchors: DataFrame, bits: int, *more: Column) -> list:
    """``word, bits`` of the filter words that have a bit set; at most 2^(bits - 6) rows."""
    word, bit = _place(F.col("anchor"), bits)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    return anchors.groupBy(word.alias("word")).agg(F.bit_or(one).alias("bits"), *more).collect()


def _test(words: list, bits: int) -> Callable[[Column], Column]:
    found = {r["word"]: r["bits"] for r in words}
    text = ",".join(str(found.get(i, 0)) for i in range(1 << (bits - 6)))
    table = F.split(F.lit(text), ",").cast("array<bigint>")

    def passes(token: Column) -> Column:
        at, shift = _place(token, bits)
        return F.call_function("shiftright", F.get(table, at), shift).bitwiseAND(1) == 1

    return passes


def anchor_filter(anchors: DataFrame) -> Callable[[Column], Column]:
    """A test that every ``anchor`` passes and few other tokens do: a Bloom filter with one
    hash, sized from the number of anchors, as one literal of the plan."""
    n = anchors.select("anchor").distinct().count()
    bits = min(MAX_FILTER_BITS, max(MIN_FILTER_BITS, math.ceil(math.log2(BITS_PER_ANCHOR * max(n, 1)))))
    return _test(_marked(anchors, bits), bits)


def salts_of(counts: DataFrame, slice_rows: int) -> Callable[[Column], Column]:
    """From ``anchor, n``, over how many salts each token's rows go: 1, or for tokens with
    more than ``slice_rows`` rows as many as the commonest one needs. Common tokens are told
    by a filter of fixed size, which both sides of the join ask; a token it takes for a
    common one by chance is spread likewise and meets its patterns all the same."""
    words = _marked(counts.where(F.col("n") > slice_rows), COMMON_BITS, F.max("n").alias("n"))
    if not words:
        return lambda token: F.lit(1)
    salts, common = math.ceil(max(r["n"] for r in words) / slice_rows), _test(words, COMMON_BITS)
    return lambda token: F.when(common(token), F.lit(salts)).otherwise(F.lit(1))


def anchor_join(
    rows: DataFrame,
    keys: Sequence[str],
    tokens: Column,
    patterns: DataFrame,
    small: bool,
    slice_rows: int = SLICE_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Pairs of a row and a pattern whose ``anchor`` is among the row's ``tokens``.

    Small pattern tables are broadcast, and rows stay where they are. Otherwise a filter of
    the anchors first drops, inside the row, nearly all tokens that are none. Row keys are
    shuffled on the tokens that are left; those with more than ``slice_rows`` rows are spread
    over as many salts as the counts ask for (``counts`` has ``anchor, n``; without it they
    are counted first), and their patterns are repeated for each. Surviving pairs fetch
    their row by key, from the rows that had any token left.

    Here and elsewhere computed arrays are exploded in the outer form: the plain form
    lets the optimizer add a test for empty arrays, below the explode, that computes the
    array again. The join drops the null row of an empty one.
    """
    if small:
        exploded = rows.select("*", F.explode_outer(tokens).alias("anchor"))
        return exploded.join(F.broadcast(patterns), "anchor")
    left, salts = token_spread(rows, tokens, patterns, slice_rows, counts)
    pairs = salted_pairs(rows, keys, left, patterns, salts).drop("salt")
    return pairs.join(rows.where(F.size(left) > 0), list(keys))


def token_spread(
    rows: DataFrame, tokens: Column, patterns: DataFrame, slice_rows: int = SLICE_ROWS, counts: DataFrame | None = None
) -> tuple[Column, Callable[[Column], Column]]:
    """The tokens of a row that may be an ``anchor`` of the patterns, and over how many salts
    the rows of a token go."""
    passes = anchor_filter(patterns)
    left = F.filter(tokens, passes)
    if counts is None:
        counts = rows.select(F.explode_outer(left).alias("anchor")).where("anchor is not null").groupBy("anchor").agg(F.count("*").alias("n"))
    else:
        counts = counts.where(passes(F.col("anchor")))
    return left, salts_of(counts, slice_rows)


def each_salt(patterns: DataFrame, salts: Callable[[Column], Column]) -> DataFrame:
    """The patterns once for each ``salt`` of their ``anchor``."""
    every = F.sequence(F.lit(0), salts(F.col("anchor")) - 1).cast("array<bigint>")
    return patterns.withColumn("salt", F.explode(every))


def salted_pairs(
    rows: DataFrame, keys: Sequence[str], left: Column, patterns: DataFrame, salts: Callable[[Column], Column]
) -> DataFrame:
    """Row keys with every pattern whose anchor is among their tokens ``left``, and the ``salt``."""
    exploded = rows.select(*keys, F.explode_outer(left).alias("anchor")).where("anchor is not null")
    exploded = exploded.withColumn("salt", F.pmod(F.xxhash64(*keys), salts(F.col("anchor"))))
    return exploded.join(each_salt(patterns, salts), ["anchor", "salt"])
