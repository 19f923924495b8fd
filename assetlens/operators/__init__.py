"""DataFrame -> DataFrame steps. All work on batch and streaming DataFrames."""

from .common import bounded_broadcast, latest_by
from .params import (normalise_params, active_params, runnable_params, rejected_params, model_gate,
                     latest_params, diff_params, failed_params)
from .assets import scope_assets, group_candidates, asset_ip_rows, area_index
from .flows import parse_flows, complete_flows, quarantine, flow_projection, to_upper_json
from .match import join_assets, index_fits, ip_index, scope_delta, touch_pairs, touch_semi
from .profile import (profile_edges, match_edges, multiset_profile, multiset_counts, merge_edges, replace_set,
                      dedupe_edges, preaggregate, model_spans, host_columns, scope_fits)
from .bitmap import bitmap_profile, ip_number, ip_text, profile_counts, profile_to_edges, union_profiles
from .encode import named_csv_rows, render_profiles, decode_profiles, segment_ips, ENCODINGS
from .status import latest_status, status_event, status_rank

__all__ = [
    "bounded_broadcast", "latest_by",
    "normalise_params", "active_params", "runnable_params", "rejected_params", "model_gate",
    "latest_params", "diff_params", "failed_params",
    "scope_assets", "group_candidates", "asset_ip_rows", "area_index",
    "parse_flows", "complete_flows", "quarantine", "flow_projection", "to_upper_json",
    "join_assets", "index_fits", "ip_index", "scope_delta", "touch_pairs", "touch_semi",
    "profile_edges", "match_edges", "multiset_profile", "multiset_counts", "merge_edges", "replace_set", "dedupe_edges",
    "preaggregate", "model_spans", "host_columns", "scope_fits",
    "bitmap_profile", "ip_number", "ip_text", "profile_counts", "profile_to_edges", "union_profiles",
    "named_csv_rows", "render_profiles", "decode_profiles", "segment_ips", "ENCODINGS",
    "latest_status", "status_event", "status_rank",
]
