"""Model rate, its length in seconds, rate/span validity and model cycle."""

from pyspark.sql import Column, functions as F

from ._col import col

# Rate units and their length in seconds (month 30 d, quarter 90 d, year 365 d).
RATE_UNIT_SECONDS = {
    "ss": 1,
    "mm": 60,
    "hh": 3600,
    "dd": 86400,
    "ww": 604800,
    "MM": 2592000,
    "qq": 7776000,
    "yy": 31536000,
}

# Rate units allowed for each result span.
SPAN_UNITS = {1: ("ss", "mm", "hh"), 2: ("dd",), 3: ("MM",), 4: ("MM",)}

# Cycle name of each result span.
SPAN_CYCLE = {1: "DAYS", 2: "WEEK", 3: "QUARTER", 4: "YEAR"}


def model_rate(num, unit) -> Column:
    return F.concat(col(num).cast("string"), col(unit))


def rate_seconds(num, unit) -> Column:
    units = F.create_map(*[x for k, v in RATE_UNIT_SECONDS.items() for x in (F.lit(k), F.lit(v))])
    return (col(num).cast("long") * units[col(unit)]).cast("long")


def valid_rate(span, unit) -> Column:
    span, unit = col(span), col(unit)
    expr = None
    for s, units in SPAN_UNITS.items():
        cond = (span == s) & unit.isin(*units)
        expr = cond if expr is None else (expr | cond)
    return F.coalesce(expr, F.lit(False))


def model_cycle(span) -> Column:
    span = col(span)
    expr = F
    for s, name in SPAN_CYCLE.items():
        expr = expr.when(span == s, F.lit(name))
    return expr
