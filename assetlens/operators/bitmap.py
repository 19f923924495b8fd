"""Profiles of assets with very many IPs as bitmaps.

An IPv4 address is a number; 32,768 neighbouring ones are a block, and the addresses of a (model, asset, segment) within a
block are a bitmap of 4 KB. Where a block holds at least ``dense`` of them the bitmap is smaller than the edges, and union
and count become OR and a count of bits. Blocks with fewer, and texts that are no IPv4 address in plain form, stay edges.
A profile is one table of both kinds of rows: ``bits`` is null in an edge, ``host_ip`` in a bitmap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .profile import dedupe_edges

DENSE = 512  # edges of some 20 bytes against a bitmap that compresses to the size of its set bits at best
_OWNER = ["model_id", "entity_id", "segment_key"]
_BLOCK = [*_OWNER, "block"]
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"


def ip_number(ip: Column) -> Column:
    """The number of an IPv4 address written without leading zeros; null for any other text."""
    parts = F.split(ip, r"\.")
    number = sum((F.get(parts, F.lit(i)).cast("long") * (1 << 8 * (3 - i)) for i in range(4)), F.lit(0).cast("long"))
    return F.when(F.rlike(ip, F.lit(rf"\A{_OCTET}(\.{_OCTET}){{3}}\z")), number)


def ip_text(number: Column) -> Column:
    """The address of a number."""
    return F.concat_ws(".", *[F.shiftright(number, 8 * (3 - i)).bitwiseAND(F.lit(255)).cast("string") for i in range(4)])


def _placed(edges: DataFrame) -> DataFrame:
    """Edges with the block of their address and its place there (from 0); null for other texts."""
    # the built-in functions count from 1
    one = ip_number(F.col("host_ip")) + 1
    return edges.select(*_OWNER, "host_ip", "updated_at", F.call_function("bitmap_bucket_number", one).alias("block"),
                        F.call_function("bitmap_bit_position", one).alias("place"))


def _bitmaps(placed: DataFrame) -> DataFrame:
    return placed.groupBy(*_BLOCK).agg(F.call_function("bitmap_construct_agg", F.col("place")).alias("bits"),
                                       F.max("updated_at").alias("updated_at"))


def _rows(loose: DataFrame, bitmaps: DataFrame) -> DataFrame:
    return (loose.select(*_OWNER, "block", "host_ip", F.lit(None).cast("binary").alias("bits"), "updated_at")
            .unionByName(bitmaps.select(*_OWNER, "block", F.lit(None).cast("string").alias("host_ip"), "bits", "updated_at")))


def _split(placed: DataFrame, dense: int) -> tuple[DataFrame, DataFrame]:
    """Edges that stay, and the bitmaps of full blocks. A block's edges meet in one task, at most 32,768 of them."""
    counted = placed.withColumn("held", F.when(F.col("block").isNotNull(), F.count(F.lit(1)).over(Window.partitionBy(*_BLOCK))))
    full = F.coalesce(F.col("held") >= dense, F.lit(False))
    return counted.where(~full).drop("held"), _bitmaps(counted.where(full))


def bitmap_profile(edges: DataFrame, dense: int = DENSE) -> DataFrame:
    """A profile table (``model_id, entity_id, segment_key, block, host_ip, bits, updated_at``) from edges."""
    return _rows(*_split(_placed(dedupe_edges(edges)), dense))


def union_profiles(a: DataFrame, b: DataFrame, dense: int = DENSE) -> DataFrame:
    """The union of two profile tables: bitmaps by OR, edges into the bitmap of their block where there is one."""
    both = a.unionByName(b)
    bitmaps = both.where("bits is not null").select(*_BLOCK, "bits", "updated_at")
    placed = _placed(dedupe_edges(both.where("bits is null")))
    blocks = bitmaps.select(*_BLOCK).distinct()
    into = placed.join(blocks, _BLOCK, "left_semi")
    loose, full = _split(placed.join(blocks, _BLOCK, "left_anti"), dense)
    merged = bitmaps.unionByName(_bitmaps(into)).groupBy(*_BLOCK).agg(
        F.call_function("bitmap_or_agg", F.col("bits")).alias("bits"), F.max("updated_at").alias("updated_at"))
    return _rows(loose, merged.unionByName(full))


def profile_counts(profile: DataFrame) -> DataFrame:
    """``model_id, entity_id, segment_key, n_ips`` without looking into the bitmaps."""
    n = F.when(F.col("bits").isNull(), 1).otherwise(F.call_function("bitmap_count", F.col("bits")))
    return profile.groupBy(*_OWNER).agg(F.sum(n).cast("long").alias("n_ips"))


def profile_to_edges(profile: DataFrame) -> DataFrame:
    """The edges of a profile table; those of a bitmap share its ``updated_at``."""
    octets = F.transform(F.regexp_extract_all(F.hex("bits"), F.lit(".."), F.lit(0)), lambda v, i: F.struct(i.alias("at"), v.alias("v")))
    values = F.transform(F.filter(octets, lambda o: o["v"] != "00"), lambda o: F.struct(o["at"], F.conv(o["v"], 16, 10).cast("int").alias("v")))
    places = F.flatten(F.transform(values, lambda o: F.transform(
        F.filter(F.array(*map(F.lit, range(8))), lambda j: F.getbit(o["v"], j) == 1), lambda j: o["at"] * 8 + j)))
    spread = profile.where("bits is not null").select(*_OWNER, "updated_at", "block", F.explode(places).alias("place"))
    address = ip_text((F.col("block") - 1) * 32768 + F.col("place"))
    return (profile.where("bits is null").select(*_OWNER, "host_ip", "updated_at")
            .unionByName(spread.select(*_OWNER, address.alias("host_ip"), "updated_at")))
