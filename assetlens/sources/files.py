"""File sources: parquet tables, JSON flow files and Kafka-shaped files (batch or stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import KAFKA


def read_table(spark: SparkSession, sf_dir: str, name: str, streaming: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if not streaming:
        return spark.read.parquet(path)
    schema = spark.read.parquet(path).schema
    # A file stream source lists a folder or a glob; "{name}" is a glob matching just this file,
    # and the folder is the base path for partition discovery.
    path = f"{sf_dir.rstrip('/')}/{{{name}}}.parquet"
    r = spark.readStream.schema(schema).option("basePath", sf_dir.rstrip("/"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


def read_flow_files(spark: SparkSession, path: str, streaming: bool = False, fmt: str = "text",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """One JSON flow per line, as column ``value`` (the record value of ``kafka_envelope``)."""
    r = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.format(fmt).load(path)


def read_kafka_files(spark: SparkSession, path: str, streaming: bool = False,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files with the Kafka record columns."""
    r = spark.readStream.schema(KAFKA) if streaming else spark.read
    if streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)
