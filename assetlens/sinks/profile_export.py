"""B1/B4 export: rendered profiles to a relational table.

Spark writes the rendered rows into a staging table (batched, one connection per partition); an
upsert into the live table is then one set-based statement of the database itself (for example
``INSERT ... SELECT ... ON DUPLICATE KEY UPDATE`` or ``MERGE``) keyed on the deterministic ``id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.encode import render_profiles
from ..sources.jdbc import write_jdbc


def export_profiles_jdbc(edges: DataFrame, scoped: DataFrame, url: str, staging_table: str,
                         encoding: str = "named_csv", mode: str = "overwrite", batchsize: int = 4096,
                         **props) -> None:
    write_jdbc(render_profiles(edges, scoped, encoding), url, staging_table, mode=mode, batchsize=batchsize,
               **props)
