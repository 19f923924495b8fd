"""A1, A2: the offset ledger against sets of offsets."""

import os

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from assetlens.sources import offset_ledger as ol

RANGE = "topic string, partition int, start long, until long"
ranges = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 40), st.integers(0, 12)), max_size=12)


def table(spark, rows):
    return spark.createDataFrame([("t", p, a, a + n) for p, a, n in rows], RANGE)


def offsets(rows):
    return {(r.partition, o) for r in rows for o in range(r.start, r.until)}


def spread(rows):
    return {(p, o) for p, a, n in rows for o in range(a, a + n)}


@settings(max_examples=12, deadline=None)
@given(ranges, ranges)
def test_islands_and_gaps(spark, wanted, covered):
    whole = ol.islands(table(spark, wanted)).collect()
    assert offsets(whole) == spread(wanted)
    by = sorted((r.partition, r.start, r.until) for r in whole)
    assert all(a[0] != b[0] or a[2] < b[1] for a, b in zip(by, by[1:]))  # apart, and not adjacent
    missing = ol.gaps(table(spark, wanted), table(spark, covered)).collect()
    assert offsets(missing) == spread(wanted) - spread(covered)
    assert sum(r.until - r.start for r in missing) == len(offsets(missing))


def test_ranges_of_records_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(ol, "BLOCK_BITS", 4)
    held = [o for o in range(0, 200) if o % 50 not in (7, 8, 9) and not 96 <= o < 99] + [1000, 1001]
    df = spark.createDataFrame([("t", p, o) for p in (0, 1) for o in held for _ in range(2)], "topic string, partition int, offset long")
    got = ol.ranges_of(df).collect()
    assert offsets(got) == {(p, o) for p in (0, 1) for o in held}
    assert len(got) == 2 * 7


@pytest.mark.parametrize("many", [False, True])
def test_backfill_reads_each_record_once(spark, tmp_dir, monkeypatch, many):
    if many:  # too many ranges for a pushed filter
        monkeypatch.setattr(ol, "in_ranges", lambda ranges: None)
    records = spark.range(300).select(F.lit("t").alias("topic"), (F.col("id") % 3).cast("int").alias("partition"), F.col("id").alias("offset"))
    records = records.unionAll(records.where("offset % 7 = 0"))
    ledger = ol.OffsetLedger(spark, f"{tmp_dir}/ledger").init()
    wanted = lambda a, b: table(spark, [(p, a, b - a) for p in range(3)])
    seen = []
    for read, (a, b) in enumerate(((100, 200), (50, 150), (0, 300), (0, 300))):
        for attempt in range(2):  # the first attempt dies before it is recorded, or is run again after it
            new = [(r.partition, r.offset) for r in ledger.new_records(records, read, wanted(a, b)).collect()]
            if attempt or read % 2:
                ledger.record(records.where(F.col("offset").isin([o for _, o in new])), read)
        seen += new
    assert sorted(seen) == sorted((o % 3, o) for o in range(300))
    assert ledger.new_records(records, 9).count() == 0


def test_pushed_filter_reaches_the_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "records")
    spark.range(100).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset")).write.parquet(path)
    ledger = ol.OffsetLedger(spark, f"{tmp_dir}/ledger").init()
    new = ledger.new_records(spark.read.parquet(path), 0, table(spark, [(0, 10, 5)]))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = new._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(offset,10)" in plan and new.count() == 5


def test_a_gap_after_every_record(spark, tmp_dir, monkeypatch):
    """As many ranges as records, all of one partition: they are dealt to tasks by block, and come from a scratch table."""
    for name, value in (("BLOCK_BITS", 4), ("CELL_BITS", 2), ("CROWDED", 2)):
        monkeypatch.setattr(ol, name, value)
    monkeypatch.setattr(ol._few, "__defaults__", (10,))
    records = spark.range(400).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), (F.col("id") * 3).alias("offset"))
    ledger = ol.OffsetLedger(spark, f"{tmp_dir}/ledger").init()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ledger.record(records.where("offset < 900"), 0)
        tasks = ledger.covered().groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["count"] for r in tasks) == 300 and max(r["count"] for r in tasks) < 300
    whole = spark.createDataFrame([("t", 0, 0, 2**63 - 1)], RANGE)
    left = sorted((r.start, r.until) for r in ol.gaps(whole, ledger.covered()).collect())
    assert left == [(o + 1, o + 3) for o in range(0, 897, 3)] + [(898, 2**63 - 1)]
    assert sorted(r.offset for r in ledger.new_records(records, 1, table(spark, [(0, 300, 800)])).collect()) == list(range(900, 1100, 3))
    assert sorted(r.offset for r in ledger.new_records(records, 1).collect()) == list(range(900, 1200, 3))
