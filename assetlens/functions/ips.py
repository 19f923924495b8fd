"""IP addresses of an asset.

``asset_ip`` is JSON ``{"<mac>": ["<ip>", ...], ...}``.
"""

from pyspark.sql import Column, functions as F

from ._col import col

ASSET_IP_SCHEMA = "map<string,array<string>>"


def asset_ips(c) -> Column:
    """All IPs of the asset, distinct and sorted (F4); empty array for bad JSON."""
    m = F.from_json(col(c), ASSET_IP_SCHEMA)
    ips = F.flatten(F.map_values(m))
    return F.coalesce(F.array_sort(F.array_distinct(F.filter(ips, lambda x: x.isNotNull()))),
                      F.array().cast("array<string>"))


def display_ip(c) -> Column:
    """Text between the first '[' and the first ']' with the quotes kept."""
    return F.regexp_extract(col(c), r"\[([^\]]*)\]", 1)


def ip_of_key(key) -> Column:
    """Fixture IP for a numeric key: 10.0.(key div 256).(key mod 256)."""
    key = col(key)
    return F.concat_ws(".", F.lit("10"), F.lit("0"), (key / 256).cast("long").cast("string"),
                       (key % 256).cast("string"))
