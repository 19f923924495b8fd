"""A1, A2: Kafka records.

``read_kafka`` needs the Spark Kafka connector on the class path; the column shape
(key, value, topic, partition, offset, timestamp) is what every other function takes, so
files or tables with the same columns work the same way (see ``files.read_kafka_files``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .options import kafka_reader_options


def read_kafka(spark: SparkSession, opts: dict[str, str], streaming: bool = True,
               max_records_per_trigger: int | None = None) -> DataFrame:
    """Kafka records (streaming, or a bounded batch read with startingOffsets/endingOffsets)."""
    reader = spark.readStream if streaming else spark.read
    try:
        return reader.format("kafka").options(**kafka_reader_options(opts, max_records_per_trigger)).load()
    except Exception as e:  # noqa: BLE001 - only to explain a missing connector
        if "kafka" in str(e).lower() and ("find data source" in str(e).lower() or "DATA_SOURCE_NOT_FOUND" in str(e)):
            raise RuntimeError(
                "The Spark Kafka connector (spark-sql-kafka-0-10) is not on the class path; add it with "
                "--packages/--jars, or read Kafka-shaped files with sources.read_kafka_files") from e
        raise


def kafka_envelope(records: DataFrame) -> DataFrame:
    """A2: key and value as text plus the record metadata."""
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp",
    )
