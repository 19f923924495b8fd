"""JDBC reads and appends.

Reads are parallel when a numeric ``partition_column`` with bounds is given; filters and
column selections applied afterwards are pushed to the database by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import ASSET, PARAMS


def _ddl(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in schema.fields)


def read_jdbc(spark: SparkSession, url: str, table: str, *, fetchsize: int = 5000,
              custom_schema=None, partition_column: str | None = None, lower_bound=None,
              upper_bound=None, num_partitions: int | None = None, **props) -> DataFrame:
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("fetchsize", str(fetchsize)))
    if custom_schema is not None:
        r = r.option("customSchema", custom_schema if isinstance(custom_schema, str) else _ddl(custom_schema))
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
             .option("upperBound", str(upper_bound)).option("numPartitions", str(num_partitions or 8)))
    for k, v in props.items():
        r = r.option(k, str(v))
    return r.load()


def read_assets_jdbc(spark: SparkSession, url: str, table: str = "asset", groups: list[str] | None = None,
                     **kw) -> DataFrame:
    """A4 (whole typed table) and A5 (only the given groups, pushed down as IN)."""
    df = read_jdbc(spark, url, table, **kw)
    if groups:
        # filter on the relation itself so the IN list reaches the database
        df = df.where(F.col("entity_groups").isin(*groups))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ASSET.fields])


def read_params_jdbc(spark: SparkSession, url: str, table: str = "modeling_params", **kw) -> DataFrame:
    """The 15 fields of the parameter table. Databases hold some of them as text, so types are given by
    ``operators.normalise_params``, whose casts never fail; filters are applied by operators.params."""
    return read_jdbc(spark, url, table, **kw).select(*[F.col(f.name).alias(f.name) for f in PARAMS.fields])


def write_jdbc(df: DataFrame, url: str, table: str, *, mode: str = "append", batchsize: int = 4096,
               num_partitions: int | None = None, **props) -> None:
    """Batched append (``batchsize`` rows per round trip, one connection per partition)."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", str(batchsize))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    for k, v in props.items():
        w = w.option(k, str(v))
    w.mode(mode).save()
