"""Shared pieces of the text operators: fixed character classes, column helpers, scratch tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path

# The ASCII white space of the text contracts and the letters that are lower-cased.
SPACE = " \t\n\x0b\f\r"
SPACES_RE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_ROWS = (1 << 33) - 1  # the low bits of monotonically_increasing_id are the place in the partition


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def strip_spaces(text: Column) -> Column:
    """Remove ASCII white space at both ends."""
    return F.btrim(text, F.lit(SPACE))


def split_words(text: Column, separators: str = SPACES_RE) -> Column:
    """Words between runs of ``separators``; an empty array for a text that has none."""
    return F.filter(F.split(text, separators), lambda w: w != "")


def hash128(value: Column) -> Column:
    """Two independently seeded 64-bit hashes, safe as a key for any corpus size."""
    return F.struct(F.xxhash64(value).alias("a"), F.xxhash64(F.lit("b"), value).alias("b"))


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text modulo ``folds``; 0 is the held-out fold. A null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared scratch folder and read it back: cuts lineage, and lost
    executors cost at most the tasks that had not been committed."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``i``, the row's number from 0 in its group by ``order`` (nulls first), and ``n``, the group's rows.
    Groups may not be null; rows that agree in ``order`` get any order among themselves.

    One range shuffle, however large a group is: a row's number is its place in its partition, less where its group
    begins there, plus the group's rows in the partitions before. Only a row per group and partition is summed up."""
    spread = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = stored(spread.withColumn("at", F.monotonically_increasing_id()).select(
        "*", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit(_ROWS)).alias("place")).drop("at"), "placed")
    shares = placed.groupBy(group, "part").agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("begin"))
    whole = Window.partitionBy(group)
    before = F.coalesce(F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shares = stored(shares.select(group, "part", (before - F.col("begin")).alias("shift"), F.sum("rows").over(whole).alias("n")),
                    "shares")
    return placed.join(shares, [group, "part"]).withColumn("i", F.col("place") + F.col("shift")).drop("part", "place", "shift")


def slices(batch, column: str, most: int = 8 << 20) -> Iterator:
    """Cut an Arrow batch so that a slice's texts have about ``most`` bytes; a longer text is a slice of its own.
    What Arrow held for a slice is given back before the next one."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(sizes, most + (sizes[at - 1] if at else 0), "right")))
        yield batch.slice(at, end - at)
        at = end
        pa.default_memory_pool().release_unused()
