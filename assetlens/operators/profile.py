"""Behaviour profiles as edges (model_id, entity_id, segment_key, host_ip).

Edges are the canonical form: a profile is a set, so set union = append + dedupe, which is
associative and idempotent. Every builder combines flows map-side, on the edge key or on
(asset, ip, hour, weekday, month), so a hot asset's millions of flows collapse into a few thousand rows before
they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import segment_candidates, segment_key
from ..functions.segments import SPAN_KEYS, key_for_span
from ..schemas import EDGE_KEY
from .common import ASSET_BROADCAST_ROWS, bounded_broadcast, fits_broadcast, join_small_side

_SEGS = ["seg_hour", "seg_isodow", "seg_month"]


def dedupe_edges(edges: DataFrame) -> DataFrame:
    """Distinct edges, keeping the latest ``updated_at``."""
    return edges.groupBy(*EDGE_KEY).agg(F.max("updated_at").alias("updated_at"))


def host_columns(side: str, host: str) -> tuple[str, str]:
    """The flow's id and IP columns that a profile of this side and host is built from."""
    if side not in ("src", "dst") or host not in ("own", "peer"):
        raise ValueError("side must be src|dst and host own|peer")
    peer = "dst" if side == "src" else "src"
    return f"{side}_id", f"{side if host == 'own' else peer}_ip"


def model_spans(params: DataFrame) -> list[int]:
    """The result spans of the given (small) model table."""
    return sorted({r[0] for r in params.select("span").distinct().collect() if r[0] is not None})


def preaggregate(flows: DataFrame, id_col: str, ip_col: str, tz: str | None = None,
                 count: bool = False, time_col: str = "event_time", spans=None) -> DataFrame:
    """(entity_id, host_ip, seg_hour, seg_isodow, seg_month, updated_at[, n]).

    Segment keys come from ``time_col``: the flow's event time by default; a column holding
    ``current_timestamp()`` gives the wall-clock keys of the original job. With ``spans`` (the
    spans of the models in play) only the keys those spans need are computed; the others are
    constant nulls, so e.g. hourly models pre-aggregate on (asset, ip, hour) alone and far fewer
    rows reach the shuffle.
    """
    cands = segment_candidates(time_col, tz)
    if spans is not None:
        needed = {SPAN_KEYS[s] for s in spans if s in SPAN_KEYS}
        names = ["seg_hour", "seg_isodow", "seg_month"]
        cands = [c if n in needed else F.lit(None).cast("int").alias(n) for c, n in zip(cands, names)]
    f = flows.where(F.col(ip_col).isNotNull()).select(
        F.col(id_col).alias("entity_id"), F.col(ip_col).alias("host_ip"),
        *cands, F.col(time_col).alias("event_time"))
    aggs = [F.max("event_time").alias("updated_at")]
    if count:
        aggs.append(F.count(F.lit(1)).alias("n"))
    return f.groupBy("entity_id", "host_ip", *_SEGS).agg(*aggs)


def scope_fits(scoped: DataFrame, max_rows: int = ASSET_BROADCAST_ROWS) -> bool:
    """Whether the columns of ``scoped`` that ``profile_edges`` joins with fit a broadcast."""
    return fits_broadcast(scoped.select("model_id", "span", "entity_id"), max_rows)


def profile_edges(flows: DataFrame, scoped: DataFrame, side: str = "src", host: str = "own",
                  tz: str | None = None, max_rows: int = ASSET_BROADCAST_ROWS,
                  salt_buckets: int = 1, time_col: str = "event_time", spans=None, fits: bool | None = None) -> DataFrame:
    """Edges of the assets in scope, matched on the flow's ``side`` asset id.

    host='own' (parity): the IP the asset itself used in the flow; host='peer': the other end.
    Where the (model, asset) table is small it is broadcast and met first: flows of assets in no model never
    reach a shuffle, and the only one left is that of the edges, after a map-side combine. Otherwise the flows are
    first reduced to distinct (asset, ip, hour, weekday, month) with a map-side partial aggregate, and only that
    reduced set meets the table. ``fits`` tells which, where the caller has found out already (``scope_fits``).
    """
    id_col, ip_col = host_columns(side, host)
    models = scoped.select("model_id", "span", F.col("entity_id").alias("_eid"))
    if fits if fits is not None else fits_broadcast(models, max_rows):
        met = (flows.where(F.col(ip_col).isNotNull()).select(id_col, ip_col, time_col)
               .join(F.broadcast(models), F.col(id_col) == F.col("_eid"), "inner"))
        return dedupe_edges(met.select(
            "model_id", F.col("_eid").alias("entity_id"),
            segment_key(time_col, F.col("span"), tz).alias("segment_key"),
            F.col(ip_col).alias("host_ip"), F.col(time_col).alias("updated_at")))
    if spans is None:
        spans = model_spans(models)
    pre = preaggregate(flows, id_col, ip_col, tz, time_col=time_col, spans=spans)
    j = join_small_side(pre, models, ["entity_id"], ["_eid"], "inner", max_rows, salt_buckets,
                        ["entity_id", "host_ip"], fits=False)
    edges = j.select("model_id", "entity_id", key_for_span("span").cast("int").alias("segment_key"),
                     "host_ip", "updated_at")
    return dedupe_edges(edges)


def match_edges(pairs: DataFrame, tz: str | None = None) -> DataFrame:
    """Edges from matcher pairs (``touch_pairs`` output with the model's span).

    Each pair already knows its model's span, so its one segment key is computed directly and the
    aggregation runs on (model, asset, segment, ip) with map-side partial aggregation.
    """
    e = pairs.select("model_id", "entity_id",
                     segment_key("event_time", F.col("span"), tz).alias("segment_key"),
                     F.col("ip").alias("host_ip"), F.col("event_time").alias("updated_at"))
    return dedupe_edges(e.where(F.col("segment_key").isNotNull()))


def _span_keys() -> F.Column:
    """(span, key) for every span, so models join on span instead of a cross product."""
    return F.explode(F.array(
        F.struct(F.lit(1).alias("span"), F.col("seg_hour").alias("segment_key")),
        F.struct(F.lit(2).alias("span"), F.col("seg_isodow").alias("segment_key")),
        F.struct(F.lit(3).alias("span"), F.col("seg_month").alias("segment_key")),
        F.struct(F.lit(4).alias("span"), F.col("seg_month").alias("segment_key")),
    ))


def multiset_counts(flows: DataFrame, params: DataFrame, side: str = "src",
                    tz: str | None = None) -> DataFrame:
    """E3 long form: (model_id, entity_id, segment_key, host_ip, n) with n = number of flows.

    Counted per IP first (map-side partial aggregation); models join on ``span`` instead of a
    cross product. This is the scalable form of the non-distinct profile: its size is bounded by
    distinct IPs, not by flows.
    """
    id_col, ip_col = host_columns(side, "own")
    pre = preaggregate(flows, id_col, ip_col, tz, count=True, spans=model_spans(params))
    keyed = pre.select("entity_id", "host_ip", "n", _span_keys().alias("k")) \
        .select("entity_id", "host_ip", "n", "k.span", "k.segment_key")
    models = bounded_broadcast(params.select("model_id", "span"))
    return keyed.join(models, "span", "inner") \
        .groupBy("model_id", "entity_id", "segment_key", "host_ip").agg(F.sum("n").alias("n"))


def multiset_profile(flows: DataFrame, params: DataFrame, side: str = "src",
                     tz: str | None = None) -> DataFrame:
    """Per model, asset and segment the comma-joined IPs of *every* flow (not distinct).

    Rendered from ``multiset_counts``: only (ip, count) pairs are gathered per group and the
    string is expanded from them. The string itself grows with the number of flows, as the
    format demands; use ``multiset_counts`` where that is too large.
    """
    j = multiset_counts(flows, params, side, tz)
    g = j.groupBy("model_id", "entity_id", "segment_key").agg(
        F.array_sort(F.collect_list(F.struct("host_ip", "n"))).alias("_ips"),
        F.sum("n").alias("n_flows"))
    csv = F.array_join(F.flatten(F.transform("_ips", lambda s: F.array_repeat(s["host_ip"], s["n"].cast("int")))),
                       ",")
    return g.select("model_id", "entity_id", F.col("segment_key").cast("int").alias("segment_key"),
                    csv.alias("host_ips"), F.col("n_flows").cast("long").alias("n_flows"))


def merge_edges(history: DataFrame, new: DataFrame, replace_models: DataFrame | None = None) -> DataFrame:
    """Merge stored edges with new ones.

    Models listed in ``replace_models`` (column model_id) lose their stored edges first
    (replace mode); all others accumulate (set union).
    """
    kept = history
    if replace_models is not None:
        kept = history.join(bounded_broadcast(replace_models.select("model_id").distinct()),
                            "model_id", "left_anti")
    return dedupe_edges(kept.select(*EDGE_KEY, "updated_at").unionByName(new.select(*EDGE_KEY, "updated_at")))


def replace_set(params: DataFrame, mode: str = "by_model") -> DataFrame | None:
    """Models whose history is cleared: all ('replace'), none ('accumulate'), or those with
    update mode 0 ('by_model')."""
    if mode == "accumulate":
        return None
    if mode == "replace":
        return params.select("model_id")
    if mode == "by_model":
        return params.where(~F.col("accumulate")).select("model_id")
    raise ValueError(f"unknown merge mode {mode}")
