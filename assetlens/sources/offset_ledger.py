"""A1, A2: which offsets of a topic have been read, as ranges, so that a backfill reads each record once.

A range is (topic, partition, start, until), ``until`` not included. Overlapping and adjacent ranges are one island. Ranges
are cut at the ends of blocks (65,536 offsets of a partition) and put together block by block, so no task sees more
than a block of one partition, also where a topic has a gap after every record and so as many ranges as records. Only those
that reach the end of a block, two of a block at most, meet per partition.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..operators.common import bounded_broadcast
from ..session import scratch_path

BLOCK_BITS = 16
CELL_BITS = 8  # where a block holds more than CROWDED ranges, a record is compared with those of its cell
CROWDED = 256
_RANGE = T.StructType([T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
                       T.StructField("start", T.LongType()), T.StructField("until", T.LongType())])
_KEY = ["topic", "partition"]


def _block(offset: Column, bits: int) -> Column:
    return F.shiftright(offset, bits)


def _cut(ranges: DataFrame, bits: int) -> DataFrame:
    """Ranges cut at the ends of blocks of so many bits, with the ``block`` each piece is in."""
    blocks = F.explode(F.sequence(_block(F.col("start"), bits), _block(F.col("until") - 1, bits)))
    rows = ranges.where("start < until").select(*_RANGE.names, blocks.alias("block"))
    return rows.withColumn("start", F.greatest("start", F.shiftleft("block", bits))) \
        .withColumn("until", F.least("until", F.shiftleft(F.col("block") + 1, bits)))


def _together(ranges: DataFrame, *within: str) -> DataFrame:
    """Ranges with all that overlap or touch put together, in one task for each partition and value of ``within``."""
    order = Window.partitionBy(*_KEY, *within).orderBy("start", "until")
    reached = F.max("until").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = ranges.where("start < until").withColumn("apart", (reached.isNull() | (F.col("start") > reached)).cast("int"))
    rows = rows.withColumn("island", F.sum("apart").over(order))
    return rows.groupBy(*_KEY, *within, "island").agg(F.min("start").alias("start"), F.max("until").alias("until")).drop("island")


def _over_blocks(rows: DataFrame) -> DataFrame:
    """The islands of ranges that are put together within each ``block``: those at its ends go on in the blocks beside it."""
    inner = (F.col("start") > F.shiftleft("block", BLOCK_BITS)) & (F.col("until") < F.shiftleft(F.col("block") + 1, BLOCK_BITS))
    return _together(rows.withColumn("block", F.when(inner, F.col("block"))), "block").drop("block")


def islands(ranges: DataFrame) -> DataFrame:
    """Ranges with all that overlap or touch put together."""
    return _over_blocks(_together(_cut(ranges, BLOCK_BITS), "block"))


def ranges_of(records: DataFrame) -> DataFrame:
    """The islands of the offsets of Kafka-shaped records (``topic, partition, offset``)."""
    offsets = records.select(*_KEY, F.col("offset").cast("long").alias("offset")).distinct()
    offsets = offsets.withColumn("block", _block(F.col("offset"), BLOCK_BITS))
    place = F.row_number().over(Window.partitionBy(*_KEY, "block").orderBy("offset"))
    runs = offsets.withColumn("run", F.col("offset") - place).groupBy(*_KEY, "block", "run")
    return _over_blocks(runs.agg(F.min("offset").alias("start"), (F.max("offset") + 1).alias("until")).drop("run"))


def gaps(wanted: DataFrame, covered: DataFrame) -> DataFrame:
    """The parts of the wanted ranges that no covered one holds. Wanted ranges are few, and may reach far beyond the covered."""
    return _between(wanted, islands(covered))


def _between(wanted: DataFrame, have: DataFrame) -> DataFrame:
    """``gaps`` where what is covered are islands already."""
    bounds = have.groupBy(*_KEY).agg(F.min("start").alias("low"), F.max("until").alias("high"))  # a row per partition
    want = _together(wanted).join(bounds, _KEY, "left")

    def part(start: Column, until: Column, inside: bool) -> Column:
        return F.struct(start.alias("start"), until.alias("until"), F.lit(inside).alias("inside"))

    start, until, low, high = map(F.col, ("start", "until", "low", "high"))
    parts = want.select(*_KEY, F.inline(F.array(
        part(start, F.when(low.isNull(), until).otherwise(F.least(until, low)), False), part(F.greatest(start, high), F.when(high.isNotNull(), until), False),
        part(F.greatest(start, low), F.when(low.isNotNull(), F.least(until, high)), True)))).where("start < until")
    pieces = _cut(parts.where("inside"), BLOCK_BITS).select(*_KEY, "block", F.col("start").alias("w0"), F.col("until").alias("w1"))
    # a covered range within a wanted one ends a gap and begins the next; the wanted range's end closes the last
    cuts = pieces.join(_cut(have, BLOCK_BITS), [*_KEY, "block"]).where("start < w1 and until > w0")
    ends = pieces.select("*", F.col("w1").alias("start"), F.col("w1").alias("until"))
    order = Window.partitionBy(*_KEY, "block", "w0", "w1").orderBy("start", "until")
    before = F.coalesce(F.lag("until").over(order), F.col("w0"))
    rows = cuts.select(*ends.columns).unionByName(ends).select(*_KEY, "block", before.alias("from"), F.col("start").alias("to"))
    rows = rows.where("from < to").select(*_KEY, "block", F.col("from").alias("start"), F.col("to").alias("until"))
    return _over_blocks(rows).unionByName(parts.where("not inside").select(*_RANGE.names))


def _held(records: DataFrame, ranges: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of records with ranges, by block of a partition, or by the cells of crowded ones."""
    most = _cut(ranges, BLOCK_BITS).groupBy(*_KEY, "block").count().agg(F.max("count")).first()[0]
    bits = CELL_BITS if (most or 0) > CROWDED else BLOCK_BITS
    blocks = _cut(ranges, bits).select(*[F.col(c).alias(f"_{c}") for c in ("topic", "partition", "start", "until", "block")])
    offset = F.col("offset")
    return records.join(bounded_broadcast(blocks), (F.col("topic") == F.col("_topic")) & (F.col("partition") == F.col("_partition"))
                        & (_block(offset, bits) == F.col("_block")) & (offset >= F.col("_start")) & (offset < F.col("_until")), how)


def uncovered(records: DataFrame, covered: DataFrame) -> DataFrame:
    """Records whose offset is in no covered range."""
    return _held(records, covered, "left_anti")


def in_ranges(ranges: DataFrame, at_most: int = 200) -> Column | None:
    """A filter that a file scan can push down, or None where there are more ranges than ``at_most``."""
    rows = ranges.limit(at_most + 1).collect()
    if len(rows) > at_most:
        return None
    return reduce(lambda a, b: a | b, [(F.col("topic") == r["topic"]) & (F.col("partition") == r["partition"])
                                       & (F.col("offset") >= r["start"]) & (F.col("offset") < r["until"]) for r in rows], F.lit(False))


def _few(ranges: DataFrame, at_most: int = 10_000) -> DataFrame:
    """The same ranges, computed once: from the driver where there are at most so many, else from a scratch table."""
    ranges = ranges.select(*[F.col(f.name).cast(f.dataType) for f in _RANGE.fields])
    rows = ranges.limit(at_most + 1).collect()
    if len(rows) <= at_most:
        return ranges.sparkSession.createDataFrame(rows, _RANGE).coalesce(1)
    path = scratch_path(ranges.sparkSession, f"offset-ranges-{uuid.uuid4().hex}")
    ranges.write.parquet(path)
    return ranges.sparkSession.read.schema(_RANGE).parquet(path)


class OffsetLedger:
    """The ranges read so far, one folder per read under ``root``. A read that is run again replaces its folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def init(self) -> OffsetLedger:
        self.spark.createDataFrame([], T.StructType([*_RANGE.fields, T.StructField("read_id", T.LongType())])) \
            .write.mode("ignore").partitionBy("read_id").parquet(self.root)
        return self

    def covered(self, but: int | None = None) -> DataFrame:
        """The islands read so far, without those of read ``but``."""
        rows = self.spark.read.schema(T.StructType([*_RANGE.fields, T.StructField("read_id", T.LongType())])).parquet(self.root)
        return islands(rows.where(F.col("read_id") != but) if but is not None else rows)

    def new_records(self, records: DataFrame, read_id: int, wanted: DataFrame | None = None) -> DataFrame:
        """The records no other read has, each once. With the ranges ``wanted``, only their gaps are looked for, by a filter
        that reaches the scan where there are few."""
        covered = _few(self.covered(but=read_id))
        if wanted is not None:
            missing = _few(_between(wanted, covered))
            pushed = in_ranges(missing)
            records = records.where(pushed) if pushed is not None else _held(records, missing, "left_semi")
        # dealt out before repeated offsets are looked for: no task holds the rows of a whole file
        return uncovered(records, covered).repartition(*_KEY, "offset").dropDuplicates([*_KEY, "offset"])

    def record(self, records: DataFrame, read_id: int) -> None:
        """Remember the offsets of a read, after its records were written."""
        ranges_of(records).select(*[F.col(f.name).cast(f.dataType) for f in _RANGE.fields]) \
            .write.mode("overwrite").parquet(f"{self.root}/read_id={read_id}")
