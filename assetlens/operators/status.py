"""B7 + E6: model status as an append-only event log; the current status is the latest event.

Ties at the same instant are ordered by the life cycle (prepare < running < success < failed < stop).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schemas import MODEL_STATUSES
from .common import latest_by


def status_rank(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    expr = F
    for i, s in enumerate(MODEL_STATUSES):
        expr = expr.when(F.lower(c) == s, F.lit(i))
    return expr.otherwise(F.lit(-1))


def latest_status(events: DataFrame) -> DataFrame:
    """(model_id, status, at): the last status event per model."""
    e = events.select("model_id", F.lower("status").alias("status"), "at") \
        .withColumn("_rank", status_rank("status"))
    return latest_by(e, ["model_id"], ["at", "_rank"]).drop("_rank")


def status_event(models: DataFrame, status: str, at) -> DataFrame:
    """One event per model row: ``status`` at ``at`` (a Column or literal)."""
    if status not in MODEL_STATUSES:
        raise ValueError(f"unknown status {status}")
    at_col = at if isinstance(at, F.Column) else F.lit(at).cast("timestamp")
    return models.select("model_id", F.lit(status).alias("status"), at_col.alias("at"))
