"""Model status events, appended per batch (idempotent by batch folder)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.status import latest_status
from ..schemas import STATUS

_STORED = T.StructType(STATUS.fields + [T.StructField("batch_id", T.LongType())])


class StatusLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def init(self) -> "StatusLog":
        self.spark.createDataFrame([], _STORED).write.mode("ignore").partitionBy("batch_id").parquet(self.path)
        return self

    def append(self, events: DataFrame, batch_id: int) -> None:
        (events.select("model_id", "status", "at").withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(self.path))

    def events(self) -> DataFrame:
        return self.spark.read.schema(_STORED).parquet(self.path).drop("batch_id")

    def current(self) -> DataFrame:
        return latest_status(self.events())
