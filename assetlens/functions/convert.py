"""config casts that never fail the job.

* to_str: null -> ''
* to_int: blank -> null; text with a '.' is truncated toward zero; bad text -> null
  (callers report such rows instead of failing)
* to_bool: true/yes/1 -> True, false/no/0 -> False (case-insensitive, trimmed), else default
"""

from pyspark.sql import Column, functions as F

from ._col import col
from .strings import java_trim

# The accepted boolean spellings.
TRUE_WORDS = ("true", "yes", "1")
FALSE_WORDS = ("false", "no", "0")


def to_str(c) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def to_int(c) -> Column:
    # blank text and the word 'null' fail both try_casts, so they become null as well
    s = java_trim(col(c).cast("string"))
    return F.when(s.contains("."), s.try_cast("double").try_cast("int")).otherwise(s.try_cast("int"))


def to_bool(c, default: bool = False) -> Column:
    s = F.lower(java_trim(col(c).cast("string")))
    return (
        F.when(s.isin(*TRUE_WORDS), F.lit(True))
        .when(s.isin(*FALSE_WORDS), F.lit(False))
        .otherwise(F.lit(default))
    )
