"""Flows matched with assets.

* ``join_assets`` (D1/D2): equi join on the flow's source (or destination) asset id.
* ``touch_pairs`` (D5): for every asset of the flow's area owning the flow's source IP emit
  (asset, source IP); otherwise, when it owns the destination IP, emit (asset, destination IP).
* ``touch_semi`` (D4): the flows with at least one such pair.

The IP rule ``area = a AND (src_ip = ip OR dst_ip = ip)`` is rewritten into two equi joins on
(area, ip) plus an anti join for the "source wins" rule, so no join has a disjunctive
condition (which would put a whole area into one hash bucket).

The asset side is broadcast when it is provably small (``join_small_side``); the flows are then
never shuffled. Otherwise the joins shuffle, optionally salted for hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .assets import asset_ip_rows
from .common import ASSET_BROADCAST_ROWS, fits_broadcast, join_small_side

_MODEL_COLS = ["model_id", "span", "accumulate"]


def _model_cols(df: DataFrame) -> list[str]:
    return [c for c in _MODEL_COLS if c in df.columns]


def join_assets(flows: DataFrame, scoped: DataFrame, side: str = "src", max_rows: int = ASSET_BROADCAST_ROWS,
                salt_buckets: int = 1) -> DataFrame:
    """D1 (side='src') / D2 (side='dst') plus C5: host_id/host_ip are the matched side."""
    if side not in ("src", "dst"):
        raise ValueError("side must be 'src' or 'dst'")
    peer = "dst" if side == "src" else "src"
    a = scoped.select(*_model_cols(scoped), F.col("entity_id").alias("_eid"), F.col("asset_ip").alias("_aip"))
    f = flows.select("src_id", "src_ip", "dst_id", "dst_ip", "area_id", "flow_id", "event_time")
    j = join_small_side(f, a, [f"{side}_id"], ["_eid"], "inner", max_rows, salt_buckets, ["flow_id"])
    return j.select(
        *_model_cols(scoped), F.col("_eid").alias("entity_id"), F.col("_aip").alias("asset_ip"),
        F.col(f"{side}_id").alias("host_id"),
        F.col(f"{side}_ip").alias("host_ip"),
        F.col(f"{peer}_ip").alias("peer_ip"),
        "area_id", "flow_id", "event_time")


def ip_index(scoped: DataFrame) -> DataFrame:
    """(model columns, area_id, entity_id, ip), distinct."""
    cols = _model_cols(scoped) + ["entity_id", "area_id", "asset_ip"]
    return asset_ip_rows(scoped.select(*cols)).dropDuplicates(
        [c for c in ("model_id", "area_id", "entity_id", "ip")])


def index_fits(index: DataFrame, max_rows: int = ASSET_BROADCAST_ROWS) -> bool:
    """Whether the columns of an index that ``touch_pairs`` joins with fit a broadcast."""
    return fits_broadcast(index.select(*_model_cols(index), "entity_id", "area_id", "ip"), max_rows)


def _sides(flows: DataFrame, keep: list[str]) -> DataFrame:
    """Each flow as two rows (ip, side): its source and its destination IP."""
    return flows.select(*keep, F.inline(F.array(
        F.struct(F.col("src_ip").alias("_fip"), F.lit("src").alias("side")),
        F.struct(F.col("dst_ip").alias("_fip"), F.lit("dst").alias("side")))))


def scope_delta(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """H2, E5: the rows of ``new`` whose ``keys`` (null-safe) are not in ``old``: what a refresh of the static side brought.

    Compared by a hash of the keys, seeded apart for its two halves; only these 16 bytes of ``old`` are shuffled.
    """
    def digest(name: str) -> list:
        cols = [F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys]
        return [F.xxhash64(F.lit(seed), *cols).alias(f"{name}{seed}") for seed in (1, 2)]

    known = old.select(*digest("_old")).distinct()
    rows = new.select("*", *digest("_new"))
    return rows.join(known, [F.col("_new1") == F.col("_old1"), F.col("_new2") == F.col("_old2")], "left_anti").select(*new.columns)


def touch_pairs(flows: DataFrame, index: DataFrame, max_rows: int = ASSET_BROADCAST_ROWS,
                salt_buckets: int = 1, owners: DataFrame | None = None, fits: bool | None = None,
                owners_fit: bool | None = None) -> DataFrame:
    """(model, asset, matched ip, side) for every flow touching an asset of its area.

    ``owners`` is the whole index where ``index`` is a part of it: it decides whether the asset owns the source IP.
    ``fits`` and ``owners_fit`` tell whether they fit a broadcast, where the caller has found out already (``index_fits``).

    One pass over the flows: both IPs are joined with the (area, ip) index at once; a
    destination match is then dropped when the same asset owns the source IP (the anti join
    carries ``side`` in its key, so source matches can never hit it).
    """
    mc = _model_cols(index)
    mcol = ["model_id"] if "model_id" in index.columns else []
    idx = index.select(*mc, "entity_id", F.col("area_id").alias("_area"), F.col("ip").alias("_ip"))
    f = _sides(flows, ["flow_id", "area_id", "src_ip", "dst_ip", "event_time"])
    fits = index_fits(index, max_rows) if fits is None else fits  # both joins read the same rows
    hits = join_small_side(f, idx, ["area_id", "_fip"], ["_area", "_ip"], "inner", max_rows, salt_buckets,
                           ["flow_id"], fits)
    keys = mcol + ["entity_id", "area_id", "src_ip", "side"]
    if owners is not None:
        fits = index_fits(owners, max_rows) if owners_fit is None else owners_fit
    owned = (index if owners is None else owners).select(*[F.col(k).alias("_o_" + k) for k in mcol + ["entity_id", "area_id"]],
                         F.col("ip").alias("_o_src_ip"), F.lit("dst").alias("_o_side"))
    kept = join_small_side(hits, owned, keys, ["_o_" + k for k in keys], "left_anti", max_rows,
                           salt_buckets, ["flow_id"], fits)
    return kept.select(*mc, "entity_id", "flow_id", "area_id", "src_ip", "dst_ip", "event_time",
                       F.col("_fip").alias("ip"), "side")


def touch_semi(flows: DataFrame, index: DataFrame, max_rows: int = ASSET_BROADCAST_ROWS,
               salt_buckets: int = 1) -> DataFrame:
    """D4 (+C8 via the index's models): flows touching at least one asset, once per model.

    Same single pass as ``touch_pairs`` on distinct (model, area, ip) keys: a destination hit is
    dropped when the model also owns the source IP in that area, so each (flow, model) appears once.
    """
    mcol = ["model_id"] if "model_id" in index.columns else []
    keys = index.select(*mcol, F.col("area_id").alias("_area"), F.col("ip").alias("_ip")).distinct()
    salt_from = ["flow_id"] if "flow_id" in flows.columns else ["src_ip", "dst_ip"]
    f = _sides(flows, flows.columns)
    fits = fits_broadcast(keys, max_rows)
    hits = join_small_side(f, keys, ["area_id", "_fip"], ["_area", "_ip"], "inner", max_rows, salt_buckets,
                           salt_from, fits)
    k = mcol + ["area_id", "src_ip", "side"]
    owned = keys.select(*[F.col(m).alias("_o_" + m) for m in mcol], F.col("_area").alias("_o_area_id"),
                        F.col("_ip").alias("_o_src_ip"), F.lit("dst").alias("_o_side"))
    kept = join_small_side(hits, owned, k, ["_o_" + c for c in k], "left_anti", max_rows, salt_buckets, salt_from,
                           fits)
    return kept.select(*mcol, *flows.columns)
