"""The next row of a table in descending id order, without a global sort in one task.

Rows are ordered by (id, hash of the text). That narrow key is numbered over the whole table, and every so many rows its
value becomes the edge of a bucket, so buckets have equal numbers of rows however the ids are spread, repeated or
missing. There are at most ``BUCKETS`` edges; they are laid out as a tree of three levels, and a row finds its bucket by
counting the edges below it in one node of each. One shuffle by bucket brings almost every row together with its next one;
only the last row of a bucket takes its neighbour from the first row of the bucket below, by a join of one row per bucket.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import numbered, stored

BUCKET_ROWS, BUCKETS = 64, 1 << 18  # rows of a bucket as long as there are no more than BUCKETS of them
NODE = 64  # edges in a node; three levels hold BUCKETS


def _bucketing(rows: DataFrame) -> tuple[int, DataFrame | None, Callable[[DataFrame], DataFrame]]:
    """The number of buckets, the edges of those that hold nothing but copies of one row (None: there are none), and a
    function that adds ``bucket`` to rows with ``id`` and ``text``. Buckets rise with the key from 0."""
    order = numbered(rows.select(F.lit("").alias("all"), "id", F.xxhash64("text").alias("hash")), "all", ["id", "hash"])
    n = order.agg(F.max("n")).first()[0] or 0
    step = max(BUCKET_ROWS, -(-n // BUCKETS))
    edges = stored(order.where(F.col("i") % step == 0).select(
        F.expr(f"i div {step}").alias("j"), F.struct("id", "hash").alias("key")), "bucket-edges")

    def nodes(every: int, name: str) -> DataFrame:
        return edges.where(F.col("j") % every == 0).groupBy(F.expr(f"j div {every * NODE}").alias(name)).agg(
            F.collect_list("key").alias(f"{name}_keys"))

    copies = edges.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("j").alias("from"))
    repeated = stored(copies.where("m > 1"), "repeated-edges")
    some = not repeated.isEmpty()

    def bucketed(df: DataFrame) -> DataFrame:
        below = lambda keys: (F.size(F.filter(keys, lambda e: e <= F.col("key"))) - 1).cast("long")
        out = df.withColumn("key", F.struct("id", F.xxhash64("text").alias("hash")))
        out = out.withColumn("top_keys", nodes(NODE * NODE, "top").select("top_keys").scalar())
        out = out.withColumn("at", below("top_keys")).drop("top_keys")
        for every, name in ((NODE, "middle"), (1, "low")):
            # at most BUCKETS keys of 16 bytes in all, in nodes of 64
            out = out.join(F.broadcast(nodes(every, name)), F.col("at") == F.col(name))
            out = out.withColumn("at", F.col("at") * NODE + below(f"{name}_keys")).drop(name, f"{name}_keys")
        if some:  # copies of one row that fill buckets are dealt to these; their order does not matter
            hot = repeated.select(F.col("key").alias("hot"), "m", "from")
            out = out.withColumn("deal", F.monotonically_increasing_id()).join(F.broadcast(hot), F.col("key") == F.col("hot"), "left")
            out = out.withColumn("at", F.when(F.col("m").isNull(), F.col("at")).otherwise(F.col("from") + F.col("deal") % F.col("m")))
        # never null, and plainly so: a check for null in one use of the result would keep its shuffle from being shared
        return out.select(*df.columns, F.coalesce("at", F.lit(0)).alias("bucket"))

    return -(-n // step), repeated if some else None, bucketed


def with_next(docs: DataFrame, make: Callable[[Column], Column], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, made, next_text, next_made`` per row: the row's text and ``make`` of it, and those of the next row in
    descending id order; after the last comes the first. Rows with equal ids follow each other by a hash of their
    text, null ids come last, a single row is its own next. Null texts count as empty. Ids may be of any type with an
    order. No task gets more than a bucket's rows at once, whatever the ids are."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    buckets, repeated, bucketed = _bucketing(rows)
    if not buckets:
        made = make(F.col("text"))
        return rows.limit(0).select("id", "text", made.alias("made"), F.col("text").alias("next_text"), made.alias("next_made"))
    placed = bucketed(rows)
    ordered = Window.partitionBy("bucket").orderBy(F.desc_nulls_last("id"), F.desc(F.xxhash64("text")))
    # made after the shuffle, so that only texts are shuffled
    dealt = placed.select("bucket", "id", "text").repartition("bucket")
    made = dealt.withColumn("made", make(F.col("text")))
    inner = (made.withColumn("next", F.lead(F.struct("text", "made")).over(ordered)).where("next is not null")
             .select("id", "text", "made", F.col("next.text").alias("next_text"), F.col("next.made").alias("next_made")))
    last = dealt.withColumn("more", F.lead(F.lit(1)).over(ordered)).where("more is null").select("bucket", "id", "text")
    first = (dealt.withColumn("n", F.row_number().over(ordered)).where("n = 1")
             .select(F.col("bucket").alias("lower"), F.col("text").alias("next_text")))
    if repeated is None:  # every bucket holds its edge
        last = last.withColumn("lower", F.coalesce((F.col("bucket") + (buckets - 1)) % buckets, F.lit(0)))
    else:  # a bucket of copies may have got none: one number per bucket, BUCKETS at most, is put in order
        in_use = placed.select("bucket").distinct()
        down = Window.orderBy(F.desc("bucket"))
        lower = F.coalesce(F.lead("bucket").over(down), F.first("bucket").over(down))
        last = last.join(stored(in_use.select("bucket", lower.alias("lower")), "bucket-chain"), "bucket")
    outer = (last.join(first, "lower")
             .select("id", "text", make(F.col("text")).alias("made"), "next_text", make(F.col("next_text")).alias("next_made")))
    return inner.unionAll(outer)
