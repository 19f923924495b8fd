"""blank test and blank-tolerant equality.

A value is *blank* when it is null, holds only characters up to U+0020 (what a
Java ``trim`` removes; Spark's ``trim`` removes spaces only), or is the text ``null``.
"""

from pyspark.sql import Column, functions as F

from ._col import col

# Every character a Java String.trim() removes: U+0000 .. U+0020.
_TRIMMED = "".join(chr(i) for i in range(0x21))


def java_trim(c) -> Column:
    """Remove characters up to U+0020 from both ends (no regex: a plain character-set trim)."""
    return F.btrim(col(c), F.lit(_TRIMMED))


def is_blank(c) -> Column:
    c = col(c)
    return c.isNull() | (java_trim(c) == F.lit("")) | (c == F.lit("null"))


def not_blank(c) -> Column:
    return ~is_blank(c)


def blank_equals(a, b, ignore_case: bool = False) -> Column:
    """True when both are blank, or both are not blank and equal."""
    a, b = col(a), col(b)
    ab, bb = is_blank(a), is_blank(b)
    left, right = (F.lower(a), F.lower(b)) if ignore_case else (a, b)
    return (ab & bb) | F.coalesce(~ab & ~bb & (left == right), F.lit(False))
