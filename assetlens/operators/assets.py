"""Which assets a model covers and their IPs.

Group matching (D3) has two modes:

* ``contains`` (parity default): an asset is in scope when its group text occurs literally in
  the model's group list (so group "1" matches list "10,12", and an empty group matches
  every list). Instead of a nested-loop join, the (small) params side is expanded into all
  substrings of its list up to the longest asset group, and assets are joined on equality -
  an exact rewrite that becomes a hash join. Lists with too many substrings for that are cut into q-grams instead, one row
  each: a group can only stand in a list that holds its first q-gram, and the few pairs that meet so are verified.
* ``exact``: the list is split at commas and groups must equal one entry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import asset_ips
from .common import bounded_broadcast

PARAM_COLUMNS = ["model_id", "span", "accumulate"]
GRAM = 4  # characters of a q-gram
ASSET_COLUMNS = ["entity_id", "entity_name", "asset_ip", "area_id", "entity_groups"]


def _substrings(text, max_len) -> F.Column:
    n = F.length(text)
    starts = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    per_start = F.transform(
        starts,
        lambda i: F.transform(
            F.sequence(F.lit(1), F.greatest(F.least(max_len, n - i + 1), F.lit(1))),
            lambda k: F.substring(text, i, k)))
    return F.array_distinct(F.concat(F.array(F.lit("")), F.flatten(per_start)))


def group_candidates(params: DataFrame, assets: DataFrame, mode: str = "contains") -> DataFrame:
    """(model columns..., grp): the group texts each model accepts."""
    lst = F.col("entity_group_list")
    keep = [c for c in PARAM_COLUMNS if c in params.columns]
    if mode == "exact":
        out = params.select(*keep, F.explode(F.split(lst, ",")).alias("grp"))
    elif mode == "contains":
        max_len = assets.select(F.max(F.length("entity_groups"))).scalar()
        # the subquery is projected first: it may not appear inside the lambda itself
        with_len = params.where(lst.isNotNull()).select(*keep, lst.alias("_lst"), max_len.alias("_max_len"))
        out = with_len.select(*keep, F.explode(_substrings(F.col("_lst"), F.col("_max_len"))).alias("grp"))
    else:
        raise ValueError(f"unknown group match mode: {mode}")
    # a model that comes twice counts once, with its largest span and mode
    rest = [c for c in keep if c != "model_id"]
    one = out.groupBy("model_id", "grp").agg(F.max(F.struct(*rest)).alias("_rest")) if rest else out.distinct()
    return one.select("model_id", *[F.col("_rest")[c].alias(c) for c in rest], "grp")


def gram_candidates(params: DataFrame, assets: DataFrame, q: int = GRAM) -> DataFrame:
    """The groups of ``assets`` that stand in each model's list, as ``group_candidates`` has them, for lists of any length.

    A list of n characters gives n rows of a q-gram and n of each shorter length, made from slices of its characters;
    only distinct groups are met with them, by their first ``q`` characters, and compared with the list itself.
    """
    lst = F.col("entity_group_list")
    keep = [c for c in PARAM_COLUMNS if c in params.columns]
    lists = params.where(lst.isNotNull()).select(*keep, lst.alias("_lst"))
    lists = lists.withColumn("_list", F.xxhash64("_lst"))
    texts = lists.select("_list", "_lst").distinct()
    cut = texts.select("_list", F.split("_lst", "").alias("_c"), F.explode(F.sequence(F.lit(1), F.lit(q))).alias("_k"))
    grams = cut.select("_list", "_k", "_c", F.explode(F.sequence(F.lit(1), F.greatest(F.size("_c") - F.col("_k") + 1, F.lit(1)))).alias("_i"))
    grams = grams.select("_list", F.array_join(F.slice("_c", F.col("_i"), F.col("_k")), "").alias("_gram")).distinct()
    groups = assets.select(F.col("entity_groups").alias("grp")).where("grp is not null").distinct()
    met = groups.where("grp <> ''").withColumn("_gram", F.substring("grp", 1, q)).join(grams, "_gram").select("_list", "grp")
    inside = met.join(texts, "_list").where(F.contains("_lst", "grp")).select("_list", "grp")
    pairs = lists.join(inside, "_list").select(*keep, "grp").unionByName(  # the empty group stands in every list
        lists.select(*keep, F.lit("").alias("grp")))
    rest = [c for c in keep if c != "model_id"]
    one = pairs.groupBy("model_id", "grp").agg(F.max(F.struct(*rest)).alias("_rest")) if rest else pairs.distinct()
    return one.select("model_id", *[F.col("_rest")[c].alias(c) for c in rest], "grp")


def candidate_bound(params: DataFrame, mode: str = "contains") -> tuple[int, int]:
    """Upper bounds of ``group_candidates``' rows and of the bytes of their texts, from the params alone: every substring of each
    list (plus the empty one) for 'contains', every comma-separated entry for 'exact'."""
    n = F.octet_length("entity_group_list").cast("double")
    rows, size = (n * (n + 1) / 2 + 1, n * (n + 1) * (n + 2) / 6) if mode == "contains" else (F.size(F.split("entity_group_list", ",")), n)
    v = params.select(F.sum(F.coalesce(rows, F.lit(0))).cast("double"), F.sum(F.coalesce(size, F.lit(0))).cast("double")).first()
    return int(v[0] or 0), int(v[1] or 0)


def scope_assets(assets: DataFrame, params: DataFrame, mode: str = "contains",
                 max_broadcast_rows: int = 200_000) -> DataFrame:
    """D3 + C4: one row per (model, asset in scope)."""
    bound, size = candidate_bound(params, mode)
    if mode == "contains" and bound > max_broadcast_rows:
        cand = bounded_broadcast(gram_candidates(params, assets), max_broadcast_rows)
    else:
        cand = bounded_broadcast(group_candidates(params, assets, mode), max_broadcast_rows, bound=bound, bound_bytes=size)
    a = assets.select(*ASSET_COLUMNS)
    j = a.join(cand, a.entity_groups == cand.grp, "inner")
    keep = [c for c in PARAM_COLUMNS if c in cand.columns]
    return j.select(*keep, *[a[c] for c in ASSET_COLUMNS])


def asset_ip_rows(assets: DataFrame) -> DataFrame:
    """one row per (asset, IP); extra columns (model_id, area_id, ...) are kept."""
    keep = [c for c in assets.columns if c not in ("asset_ip", "entity_name", "entity_groups")]
    return assets.select(*keep, F.explode(asset_ips("asset_ip")).alias("ip"))


def area_index(assets: DataFrame) -> DataFrame:
    """E5: per (area, asset) the union of IPs over all rows of the asset (sorted, distinct)."""
    rows = asset_ip_rows(assets.select("entity_id", "area_id", "asset_ip"))
    return rows.groupBy("area_id", "entity_id").agg(F.array_sort(F.collect_set("ip")).alias("ips"))
