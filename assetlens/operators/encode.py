"""Render edges as stored profiles and parse stored profiles back.

Encodings of ``dst_ip_segment`` (IPs sorted, segments in numeric key order):
  keyed       [{"16":["192.168.9.231"]}]
  named_list  [{"name":16,"value":["192.168.9.231"]}]
  named_csv   [{"name":"1","value":"IP1,IP2"}]
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import display_ip, profile_row_id
from .common import ASSET_BROADCAST_ROWS, join_small_side

ENCODINGS = ("keyed", "named_list", "named_csv")


def segment_ips(edges: DataFrame) -> DataFrame:
    """Per (model, asset, segment): sorted distinct IPs. The group holds distinct IPs only."""
    return edges.groupBy("model_id", "entity_id", "segment_key").agg(
        F.array_sort(F.collect_set("host_ip")).alias("ips"),
        F.max("updated_at").alias("updated_at"))


def named_csv_rows(edges: DataFrame) -> DataFrame:
    """Long rendered form: (model_id, entity_id, segment_key, host_ips 'ip1,ip2', n_ips)."""
    s = segment_ips(edges)
    return s.select("model_id", "entity_id", "segment_key",
                    F.array_join("ips", ",").alias("host_ips"),
                    F.size("ips").cast("long").alias("n_ips"))


def _segments_json(segs: F.Column, encoding: str) -> F.Column:
    if encoding == "keyed":
        m = F.map_from_entries(F.transform(segs, lambda s: F.struct(
            s["segment_key"].cast("string").alias("key"), s["ips"].alias("value"))))
        return F.to_json(F.array(m))
    if encoding == "named_list":
        return F.to_json(F.transform(segs, lambda s: F.struct(
            s["segment_key"].alias("name"), s["ips"].alias("value"))))
    if encoding == "named_csv":
        return F.to_json(F.transform(segs, lambda s: F.struct(
            s["segment_key"].cast("string").alias("name"), F.array_join(s["ips"], ",").alias("value"))))
    raise ValueError(f"unknown encoding {encoding}")


def render_profiles(edges: DataFrame, scoped: DataFrame, encoding: str = "keyed",
                    max_rows: int = ASSET_BROADCAST_ROWS) -> DataFrame:
    """Stored-profile rows: id, modeling_params_id, src_id, src_ip, dst_ip_segment, time.

    IPs are gathered per (model, asset, segment) first, combined map-side, so a hot asset is spread over its
    segments; only its finished segments meet for its row, as the format demands.
    """
    s = segment_ips(edges)
    per_asset = s.groupBy("model_id", "entity_id").agg(
        F.array_sort(F.collect_list(F.struct("segment_key", "ips"))).alias("segs"),
        F.max("updated_at").alias("time"))
    # an asset with several rows shows the smallest of its IP texts
    a = scoped.groupBy(F.col("model_id").alias("_m"), F.col("entity_id").alias("_e")).agg(F.min("asset_ip").alias("asset_ip"))
    j = join_small_side(per_asset, a, ["model_id", "entity_id"], ["_m", "_e"], "left", max_rows)
    return j.select(
        profile_row_id("model_id", "entity_id").alias("id"),
        F.col("model_id").alias("modeling_params_id"),
        F.col("entity_id").alias("src_id"),
        display_ip("asset_ip").alias("src_ip"),
        _segments_json(F.col("segs"), encoding).alias("dst_ip_segment"),
        "time")


def decode_profiles(stored: DataFrame, encoding: str = "keyed", col: str = "dst_ip_segment") -> DataFrame:
    """Stored rows -> edges (model_id, entity_id, segment_key, host_ip, updated_at).

    Bad JSON and '[]' yield no edges (an empty profile).
    """
    base = stored.select(F.col("modeling_params_id").alias("model_id"), F.col("src_id").alias("entity_id"),
                         F.col("time").alias("updated_at"), F.col(col).alias("_j"))
    if encoding == "keyed":
        arr = F.from_json("_j", "array<map<string,array<string>>>")
        maps = base.select("model_id", "entity_id", "updated_at", F.explode(arr).alias("_m"))
        kv = maps.select("model_id", "entity_id", "updated_at", F.explode("_m").alias("_k", "_ips"))
        rows = kv.select("model_id", "entity_id", "updated_at", F.col("_k").alias("_name"),
                         F.explode("_ips").alias("host_ip"))
    elif encoding in ("named_list", "named_csv"):
        arr = F.from_json("_j", "array<struct<name:string,value:string>>")
        items = base.select("model_id", "entity_id", "updated_at", F.explode(arr).alias("_it"))
        v = F.col("_it.value")
        ips = F.when(F.ltrim(v).startswith("["), F.from_json(v, "array<string>")).otherwise(F.split(v, ","))
        rows = items.select("model_id", "entity_id", "updated_at", F.col("_it.name").alias("_name"),
                            F.explode(ips).alias("host_ip"))
    else:
        raise ValueError(f"unknown encoding {encoding}")
    return rows.where(F.col("host_ip").isNotNull() & (F.col("host_ip") != "")).select(
        "model_id", "entity_id", F.col("_name").try_cast("int").alias("segment_key"), "host_ip", "updated_at")
