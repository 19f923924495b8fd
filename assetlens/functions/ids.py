"""deterministic row id of a stored profile, so a replay keeps the same id."""

from pyspark.sql import Column, functions as F

from ._col import col


def profile_row_id(model_id, entity_id) -> Column:
    return F.concat(F.lit("mdl_"), F.sha2(F.concat_ws("|", col(model_id), col(entity_id)), 256))
