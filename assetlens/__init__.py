"""assetlens: asset behaviour profiles (which host IPs each network asset uses, per
time segment) built from flow records with Spark DataFrames and Structured Streaming.

Sub-packages
------------
functions   Column -> Column expressions (blank test, casts, segment keys, IPs, ids)
sources     readers: Kafka, JDBC, files, option loading, driver-table adapters
operators   DataFrame -> DataFrame steps (params, assets, flows, matching, profiles)
sinks       edge store with idempotent batch writes, status log, day files, JDBC
streaming   the Structured Streaming profile job (foreachBatch into the edge store)
plans       named end-to-end queries built from the operators
"""

__version__ = "0.1.0"
