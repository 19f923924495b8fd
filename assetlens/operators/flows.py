"""Parse flow records, keep complete ones, quarantine the rest.

Parsing accepts both key spellings of the wire format and never fails a job: every value is
read as text (numbers too) and cast afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import is_blank, java_trim, not_blank, to_int
from ..schemas import FLOW_COLUMNS, FLOW_JSON_KEYS

CORRUPT = "_corrupt_record"
_JSON_KEYS = [k for keys in FLOW_JSON_KEYS.values() for k in keys]
_JSON_SCHEMA = T.StructType([T.StructField(k, T.StringType()) for k in _JSON_KEYS]
                            + [T.StructField(CORRUPT, T.StringType())])
# JSON keys match case-sensitively, but field *access* by name does not (srcId = SrcID), so the
# parsed struct is cast by position to unambiguous names k0, k1, ...
_POSITIONAL = T.StructType([T.StructField(f"k{i}", T.StringType()) for i in range(len(_JSON_KEYS))]
                           + [T.StructField(CORRUPT, T.StringType())])


def parse_flows(records: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """JSON text -> typed flow columns plus ``parse_status`` (ok | empty_value | malformed_json).

    ``event_time`` comes from ``rTime`` (epoch ms) or, when absent, from a ``timestamp`` column.
    """
    v = F.col(value_col).cast("string")
    j = F.from_json(v, _JSON_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).cast(_POSITIONAL)
    keep = [c for c in (keep if keep is not None else records.columns) if c != value_col]
    # Parse inside a one-element explode: a Generate is a barrier for predicate pushdown, so a
    # later filter on the parsed fields cannot inline from_json into each reference (which
    # would parse every record once per field reference).
    parsed = records.select(*keep, F.inline(F.array(F.struct(v.alias("_v"), j.alias("_j")))))

    def field(name: str) -> F.Column:
        return F.coalesce(*[F.col("_j")[f"k{_JSON_KEYS.index(k)}"] for k in FLOW_JSON_KEYS[name]])

    r_time = java_trim(field("r_time")).try_cast("long")
    event_time = F.timestamp_millis(r_time)
    if "timestamp" in records.columns:
        event_time = F.coalesce(event_time, F.col("timestamp").cast("timestamp"))
    empty = F.col("_v").isNull() | F.col("_v").rlike(r"^[\x00-\x20]*$")
    status = (F.when(empty, F.lit("empty_value"))
              .when(F.col("_j").isNull() | F.col("_j")[CORRUPT].isNotNull(), F.lit("malformed_json"))
              .otherwise(F.lit("ok")))
    return parsed.select(
        *keep,
        field("src_id").alias("src_id"),
        field("src_ip").alias("src_ip"),
        field("dst_id").alias("dst_id"),
        field("dst_ip").alias("dst_ip"),
        to_int(field("area_id")).alias("area_id"),
        field("flow_id").alias("flow_id"),
        r_time.alias("r_time"),
        event_time.alias("event_time"),
        status.alias("parse_status"),
        F.col("_v").alias("raw_value"),
    )


def _ok(df: DataFrame) -> F.Column:
    return F.col("parse_status") == "ok" if "parse_status" in df.columns else F.lit(True)


def complete_flows(df: DataFrame) -> DataFrame:
    """Parsed and both asset ids present (not blank)."""
    return df.where(_ok(df) & not_blank("src_id") & not_blank("dst_id"))


def quarantine(df: DataFrame, host_ip: str | None = None) -> DataFrame:
    """H8: the rows ``complete_flows`` drops, with the first reason that applies.

    With ``host_ip`` (the IP column a profile is built from) also complete flows that lack it, as no profile can
    hold them.
    """
    parse = F.col("parse_status") if "parse_status" in df.columns else F.lit(None).cast("string")
    reason = (F.when(~_ok(df), parse)
              .when(is_blank("src_id"), F.lit("blank_src_id"))
              .when(is_blank("dst_id"), F.lit("blank_dst_id")))
    if host_ip:
        reason = reason.when(F.col(host_ip).isNull(), F.lit("null_host_ip"))
    return df.withColumn("reason", reason).where(F.col("reason").isNotNull())


def flow_projection(df: DataFrame) -> DataFrame:
    """The seven flow columns."""
    return df.select(*FLOW_COLUMNS)


def to_upper_json(df: DataFrame, alias: str = "flow_json") -> DataFrame:
    """The flow as JSON with the writer's upper-case keys (null fields omitted)."""
    s = F.struct(*[F.col(c).alias(FLOW_JSON_KEYS[c][-1]) for c in FLOW_COLUMNS])
    return df.withColumn(alias, F.to_json(s))
