"""Rows and tables of address blocks: the longest block that holds an address.

An address lies in a block of n bits if its first n bits are the block's.  So
for every length that occurs in the table there is one equality to ask for,
and no range has to be searched.  Addresses are looked up once each, however
many rows have them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.network import address_parts, block_parts, prefix_masks


def parsed_blocks(blocks: DataFrame, block: str) -> DataFrame:
    """Column ``__block``, the bits of every block; texts that are none are left out, of equal blocks the first by its columns stays."""
    # Values as texts, so that every type has an order.
    order = F.to_json(F.struct(*[F.col(f"`{c}`") for c in blocks.columns]))
    read = blocks.select(block_parts(F.col(block)).alias("__block"), F.struct(*[F.col(f"`{c}`") for c in blocks.columns]).alias("__row"), order.alias("__order"))
    known = read.where("__block IS NOT NULL")
    return known.groupBy("__block").agg(F.min_by("__row", "__order").alias("__row"))


def longest_blocks(df: DataFrame, address: str, blocks: DataFrame, block: str, how: str = "left") -> DataFrame:
    """The rows with the columns of the longest of ``blocks`` that holds their address.

    ``how``: ``left`` keeps rows without a block, with nulls; ``inner`` drops
    them; ``semi`` and ``anti`` keep the rows with and without a block as they
    are.  Texts that are no address, and null, are in no block.  IPv4 and IPv6
    may be mixed on both sides; an address of one never lies in a block of the
    other.

    The lengths that occur, 33 and 129 at most, are read while planning.
    """
    if how not in ("left", "inner", "semi", "anti"):
        raise ValueError(f"unknown way to join blocks: {how}")
    known = parsed_blocks(blocks, block)
    lengths = sorted((r[0], r[1]) for r in known.select("__block.family", "__block.length").distinct().collect())
    masks = [(family, length, *prefix_masks(family, length)) for family, length in lengths]
    fields = "array<struct<family:int,length:int,high:bigint,low:bigint>>"
    asked = F.array(*[F.struct(*[F.lit(v) for v in m]) for m in masks]).cast(fields) if masks else F.expr("array()").cast(fields)
    given = df.select(F.col(f"`{address}`").alias("__text")).where("__text IS NOT NULL").distinct()
    bits = given.select("__text", address_parts(F.col("__text")).alias("__a")).where("__a IS NOT NULL")
    masked = lambda m: F.struct(m["family"].alias("family"), m["length"].alias("length"), F.col("__a.high").bitwiseAND(m["high"]).alias("high"), F.col("__a.low").bitwiseAND(m["low"]).alias("low"))
    keys = F.transform(F.filter(asked, lambda m: m["family"] == F.col("__a.family")), masked)
    found = bits.select("__text", F.explode(keys).alias("__block")).join(known, "__block")
    longest = found.groupBy("__text").agg(F.max_by("__row", "__block.length").alias("__row"))
    same = df[address] == longest["__text"]
    if how in ("semi", "anti"):
        return df.join(longest, same, f"left_{how}")
    columns = [df[f"`{c}`"] for c in df.columns] + [F.col(f"__row.`{c}`").alias(c) for c in blocks.columns]
    if how == "inner":
        return df.join(longest, same).select(*columns)
    # Rows without an address are not dealt out by it: they would all meet in one task.
    some = df.where(F.col(f"`{address}`").isNotNull())
    none = df.where(F.col(f"`{address}`").isNull()).select("*", *[F.lit(None).cast(blocks.schema[c].dataType).alias(c) for c in blocks.columns])
    joined = some.join(longest, some[address] == longest["__text"], "left")
    return joined.select(*[some[f"`{c}`"] for c in df.columns], *[F.col(f"__row.`{c}`").alias(c) for c in blocks.columns]).union(none)
