"""Readers: Kafka (A1, A2), JDBC (A3-A5, A8), files, options (A10) and the
adapters that derive flows, assets, params and Kafka-shaped rows from the driver tables."""

from .options import load_options, kafka_reader_options
from .kafka import read_kafka, kafka_envelope
from .jdbc import read_jdbc, read_assets_jdbc, read_params_jdbc, write_jdbc
from .files import read_table, read_flow_files, read_kafka_files
from . import fixtures

__all__ = [
    "load_options", "kafka_reader_options",
    "read_kafka", "kafka_envelope",
    "read_jdbc", "read_assets_jdbc", "read_params_jdbc", "write_jdbc",
    "read_table", "read_flow_files", "read_kafka_files",
    "fixtures",
]
