"""Column -> Column expressions. All are native Spark expressions (no Python UDF)."""

from .strings import is_blank, not_blank, blank_equals, java_trim
from .convert import to_str, to_int, to_bool
from .segments import segment_key, iso_weekday, local_day, to_local, segment_candidates, SPAN_KEYS
from .ips import asset_ips, display_ip, ip_of_key
from .ids import profile_row_id
from .rates import model_rate, rate_seconds, valid_rate, model_cycle

__all__ = [
    "is_blank", "not_blank", "blank_equals", "java_trim",
    "to_str", "to_int", "to_bool",
    "segment_key", "iso_weekday", "local_day", "to_local", "segment_candidates", "SPAN_KEYS",
    "asset_ips", "display_ip", "ip_of_key",
    "profile_row_id",
    "model_rate", "rate_seconds", "valid_rate", "model_cycle",
]
