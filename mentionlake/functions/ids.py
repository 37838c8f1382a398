"""Column expressions for article ids, hash shards and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name formats of shard files, chunk files and article bundles.
SHARD_NAME = "metadata_shard_%s.jsonl.gz"
CHUNK_NAME = r"pmc_idlist\.chunk_(\d+)\.txt"
BUNDLE_NAME = r"^PMC(\d+)_PMC(\d+)\.xml(?:\.gz)?$"


def bare_id(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), "^PMC", "")


def full_id(c: Column) -> Column:
    return F.concat(F.lit("PMC"), bare_id(c))


def id_number(c: Column) -> Column:
    return bare_id(c).try_cast("bigint")


def leading_number(c: Column) -> Column:
    """The number right after the prefix, never null: 0 without digits, at most 2^63 - 1."""
    digits = F.regexp_extract(bare_id(c), r"^\s*([+-]?[0-9]+)", 1)
    last = F.lit(2**63 - 1)
    number = F.coalesce(digits.try_cast("bigint"), F.when(digits.rlike("^-"), F.lit(-(2**63) + 1)).otherwise(last))
    return F.when(F.coalesce(digits, F.lit("")) == "", F.lit(0).cast("bigint")).otherwise(number)


def md5_shard(c: Column, shards: int) -> Column:
    """md5 of the id, read as one 128-bit number, modulo ``shards``.

    The digest is folded in four 32-bit steps; every intermediate value stays
    under 2^63 while ``shards`` is at most 2^31.
    """
    if not 1 <= shards <= 2**31 - 1:
        raise ValueError("shards must be between 1 and 2^31-1")
    digest = F.md5(c.cast("binary"))
    step = 2**32 % shards
    acc = F.lit(0).cast("bigint")
    for start in (1, 9, 17, 25):
        part = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
        acc = F.pmod(acc * F.lit(step) + part, F.lit(shards))
    return acc.cast("bigint")


def shard_file(shard: Column, shards: int) -> Column:
    """File name of a shard: all numbers as wide as the last one's, two digits at least."""
    digits = 2
    while 10**digits < shards:
        digits += 1
    return F.format_string(SHARD_NAME, F.lpad(shard.cast("string"), digits, "0"))


def hash32(*parts: Column) -> Column:
    """A stable 32-bit number from md5, equal on every run, cluster and engine."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
