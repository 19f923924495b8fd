"""time segment keys and local time.

Result span (model_result_span) -> key of a timestamp:
  1 (day)            hour of day 0-23
  2 (week)           ISO weekday 1-7, Monday = 1
  3 (quarter), 4 (year)  month 1-12
Other spans have no key (null); such models are rejected before they reach a job.

Keys are taken from the event time in the zone given (default: the session zone).
"""

from pyspark.sql import Column, functions as F

from ._col import col

# Span code -> name of the candidate key column.
SPAN_KEYS = {1: "seg_hour", 2: "seg_isodow", 3: "seg_month", 4: "seg_month"}


def to_local(ts, tz: str | None) -> Column:
    """Wall-clock time of ``ts`` in zone ``tz`` (F11), without a zone; unchanged when tz is None.

    The instant is first written as UTC wall-clock time from its epoch microseconds, so the result does not
    depend on the session's zone, nor on hours that zone skips or repeats.
    """
    ts = col(ts)
    if tz is None:
        return ts
    since_epoch = F.make_dt_interval(secs=(F.unix_micros(ts.cast("timestamp")).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)"))
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since_epoch
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def local_day(ts, tz: str | None = None) -> Column:
    """The local day of ``ts`` as text ``yyyy-MM-dd``."""
    return F.to_date(to_local(ts, tz)).cast("string")


def iso_weekday(ts) -> Column:
    return (F.weekday(col(ts)) + 1).cast("int")


def segment_key(ts, span, tz: str | None = None) -> Column:
    local = to_local(ts, tz)
    span = col(span) if not isinstance(span, int) else F.lit(span)
    return (
        F.when(span == 1, F.hour(local))
        .when(span == 2, iso_weekday(local))
        .when(span.isin(3, 4), F.month(local))
        .cast("int")
    )


def segment_candidates(ts, tz: str | None = None) -> list[Column]:
    """The three keys any span may need, as columns seg_hour, seg_isodow, seg_month.

    Pre-aggregating flows on these (instead of on the raw timestamp) lets a job
    collapse a hot asset's flows before the join with the models.
    """
    local = to_local(ts, tz)
    return [
        F.hour(local).cast("int").alias("seg_hour"),
        iso_weekday(local).alias("seg_isodow"),
        F.month(local).cast("int").alias("seg_month"),
    ]


def key_for_span(span) -> Column:
    """Pick the candidate column that belongs to the model's span."""
    span = col(span)
    return (
        F.when(span == 1, F.col("seg_hour"))
        .when(span == 2, F.col("seg_isodow"))
        .when(span.isin(3, 4), F.col("seg_month"))
    )
