"""Versions of the static side, and which one each micro-batch was run with.

Layout under ``root``::

    tables/v=V/<table>/part-*.parquet   one snapshot of the static side; V is a digest of its rows
    pins/N                              the version of batch N and of the batch before it

A batch is pinned to its version before it writes anything. When the same batch is run again, by the restarted query, it
takes the pinned version and so matches the same flows with the same assets, however the inventory has changed in between.
A snapshot whose rows did not change is not written again.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .folder import Folder


class ScopeLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.tables = Folder(spark, f"{self.root}/tables")
        self.pins = Folder(spark, f"{self.root}/pins")

    @staticmethod
    def version(tables: dict[str, DataFrame]) -> str:
        """A digest of the rows of all tables, in any order: their number and the sums of two hashes. One job."""
        def digest(name: str, df: DataFrame) -> DataFrame:
            cols = [F.col(f"`{c}`") for c in df.columns]
            total = [F.coalesce(F.sum(F.xxhash64(F.lit(seed), *cols).cast("decimal(38,0)")), F.lit(0)).cast("string") for seed in (1, 2)]
            return df.agg(F.concat_ws("_", F.lit(name), F.count(F.lit(1)).cast("string"), *total).alias("d"))

        parts = reduce(DataFrame.unionAll, [digest(n, df) for n, df in sorted(tables.items())]).collect()  # a row per table
        return hashlib.sha256("|".join(sorted(r["d"] for r in parts)).encode()).hexdigest()[:24]

    def save(self, tables: dict[str, DataFrame]) -> str:
        """Keep a snapshot; returns its version."""
        version = self.version(tables)
        for name, df in tables.items():
            if not self.tables.exists(f"v={version}/{name}/_SUCCESS"):
                df.write.mode("overwrite").parquet(f"{self.root}/tables/v={version}/{name}")
        return version

    def load(self, version: str, schemas: dict | None = None) -> dict[str, DataFrame]:
        """The tables of a snapshot. Known schemas save a look into the files."""
        names = Folder(self.spark, f"{self.root}/tables/v={version}").names()
        read = lambda n: self.spark.read.schema(schemas[n]) if schemas else self.spark.read
        return {n: read(n).parquet(f"{self.root}/tables/v={version}/{n}") for n in names}

    def pinned(self, batch_id: int) -> tuple[str, str | None] | None:
        """(version, version of the batch before) of a batch that was begun, else None."""
        text = self.pins.read(str(batch_id))
        if text is None:
            return None
        version, _, before = text.partition("\n")
        return version, before or None

    def pin(self, batch_id: int, version: str) -> tuple[str, str | None]:
        """Pin a batch that begins; returns what ``pinned`` will. Only the last batch of a query can be run again, so pins
        before it, and versions that no pin names, are removed."""
        begun = sorted(int(n) for n in self.pins.names() if n.isdigit())
        earlier = [n for n in begun if n < batch_id]
        before = self.pinned(earlier[-1])[0] if earlier else None
        self.pins.write(str(batch_id), f"{version}\n{before or ''}")
        for n in earlier[:-1]:
            self.pins.delete(str(n))
        if earlier[:-1]:
            used = {v for n in (*earlier[-1:], *[n for n in begun if n >= batch_id], batch_id) for v in self.pinned(n) if v}
            for name in self.tables.names():
                if name.removeprefix("v=") not in used:
                    self.tables.delete(name)
        return version, before
