"""Model parameters.

``normalise_params`` turns the stringly typed parameter table into typed columns that
never fail (F7 casts); ``active_params`` is the scan filter of the live job (C3);
``runnable_params`` keeps models whose result span has a segment key and ``rejected_params``
reports the rest (instead of failing inside the sink); ``diff_params`` compares two
snapshots (D7).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import (blank_equals, model_cycle, model_rate, rate_seconds, to_bool, to_int,
                         to_str, valid_rate)
from .common import latest_by

MODEL_TYPE_ASSET_BEHAVIOUR = 1
CHILD_TYPE_CONNECTION = 1


def normalise_params(raw: DataFrame) -> DataFrame:
    unit = F.col("model_rate_timeunit").cast("string")
    num = to_int("model_rate_timeunit_num")
    span = to_int("model_result_span")
    return raw.select(
        to_str("id").alias("model_id"),
        to_int("model_type").alias("model_type"),
        to_int("model_child_type").alias("model_child_type"),
        unit.alias("rate_unit"),
        num.alias("rate_num"),
        span.alias("span"),
        to_int("model_update").alias("update_mode"),
        to_bool("model_update").alias("accumulate"),
        to_bool("model_switch").alias("switch_on"),
        to_bool("model_switch_2").alias("switch2_on"),
        F.get_json_object(F.col("model_alt_params"), "$.model_entity_group").alias("entity_group_list"),
        to_str("model_task_status").alias("task_status"),
        F.col("modify_time").cast("timestamp").alias("modify_time"),
        model_rate(num, unit).alias("model_rate"),
        rate_seconds(num, unit).alias("rate_seconds"),
        valid_rate(span, unit).alias("valid_rate"),
        model_cycle(span).alias("model_cycle"),
        F.coalesce(span.isin(1, 2, 3, 4), F.lit(False)).alias("valid_span"),
    )


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, (dt.datetime, str)):
        return F.lit(as_of).cast("timestamp")
    return as_of


def active_params(norm: DataFrame, child_type: int = CHILD_TYPE_CONNECTION, as_of=None,
                  min_age_minutes: int = 10) -> DataFrame:
    """Type, child type, both switches on, and last modified at least ``min_age_minutes``
    before ``as_of`` (default: now)."""
    cutoff = _as_of(as_of) - F.expr(f"INTERVAL {int(min_age_minutes)} MINUTES")
    return norm.where(
        (F.col("model_type") == MODEL_TYPE_ASSET_BEHAVIOUR)
        & (F.col("model_child_type") == child_type)
        & F.col("switch_on") & F.col("switch2_on")
        & (F.col("modify_time") < cutoff))


def runnable_params(active: DataFrame) -> DataFrame:
    """Active models whose span has a segment key."""
    return active.where(F.col("valid_span"))


def rejected_params(active: DataFrame) -> DataFrame:
    return active.where(~F.col("valid_span")).select(
        "model_id", F.lit("unsupported_result_span").alias("reason"), "span")


def failed_params(norm: DataFrame, child_type: int = CHILD_TYPE_CONNECTION, as_of=None) -> DataFrame:
    """(model_id, reason) of this job's models that cannot run: switched off (C8), or active with a result span that
    has no segment key."""
    mine = norm.where((F.col("model_type") == MODEL_TYPE_ASSET_BEHAVIOUR) & (F.col("model_child_type") == child_type))
    off = mine.join(model_gate(mine).select("model_id"), "model_id", "left_anti")
    return (rejected_params(active_params(norm, child_type, as_of)).select("model_id", "reason")
            .unionByName(off.select("model_id", F.lit("switched_off").alias("reason"))).distinct())


def model_gate(norm: DataFrame) -> DataFrame:
    """Only models whose main switch is on pass."""
    return norm.where(F.col("switch_on"))


def latest_params(norm: DataFrame) -> DataFrame:
    """One row per model, the last modified one (model id breaks ties)."""
    return latest_by(norm, ["model_id"], ["modify_time", "model_id"])


def diff_params(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per-model change flags between two normalised snapshots.

    update_changed: new update mode set and different; dimension_changed: any of span,
    rate unit or rate number changed (each flag is reported too). A model that is only in one snapshot was added or
    removed, not changed: its change flags are false.
    """
    cols = ["update_mode", "span", "rate_unit", "rate_num", "accumulate"]
    o = old.select("model_id", F.lit(True).alias("_in_old"), *[F.col(c).alias(f"old_{c}") for c in cols])
    n = new.select("model_id", F.lit(True).alias("_in_new"), *[F.col(c).alias(f"new_{c}") for c in cols])
    j = o.join(n, "model_id", "full_outer")

    both = F.col("_in_old").isNotNull() & F.col("_in_new").isNotNull()

    def changed(c: str) -> Column:
        return both & F.col(f"new_{c}").isNotNull() & ~F.col(f"new_{c}").eqNullSafe(F.col(f"old_{c}"))

    unit_changed = both & ~blank_equals(F.col("new_rate_unit"), F.col("old_rate_unit"))
    return j.select(
        "model_id",
        F.col("_in_old").isNull().alias("added"),
        F.col("_in_new").isNull().alias("removed"),
        changed("update_mode").alias("update_changed"),
        changed("span").alias("span_changed"),
        unit_changed.alias("unit_changed"),
        changed("rate_num").alias("num_changed"),
        (changed("span") | unit_changed | changed("rate_num")).alias("dimension_changed"),
        F.col("new_accumulate").alias("accumulate"),
    )
