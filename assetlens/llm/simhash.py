"""SimHash near-duplicates: tiled exact comparison of 64-bit fingerprints.

Fingerprints are compared as whole tiles: numpy takes the exclusive-or of two tiles and counts bits, and every
pair within the radius is found. Tiles are sorted by population count, and a pair of tiles whose population counts
differ by more than the radius is skipped, as no pair in it can be near.

Which tiles can meet is decided before the comparison, also without loss: two fingerprints that differ in at most
``radius`` bits agree in at least one of ``radius + 1`` blocks of bits, so each distinct fingerprint is placed once
per block and only fingerprints with an equal block share a bucket. A bucket with more rows than a tile is
cut by a salt into tiles, and each pair of its tiles is a piece of work of its own; so no bucket, however full,
lands in one task. Within a piece of work the links are reduced to one per row (its local component), so a large
group never emits its pairs. Components over all links are found by ``components``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored
from .components import components

SHINGLE, RADIUS, SEED = 4, 4, 42
TILE = 2048  # most rows of a bucket that one side of a piece of work holds
BLOCK = 512  # rows compared at a time
SALTS = 16  # places that the fingerprints of a component are dealt to when they get its smallest id


def simhash(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint of one text (signed); null and empty texts, or those without words, have 0.

    Words are runs without ASCII white space, A-Z lower-cased; shingles count as often as they occur.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[-n:].tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def simhash_column(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    @F.pandas_udf("bigint")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle, seed) for t in texts], dtype="int64")
    return fingerprints(text)


def hex16(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def near_pairs(a: np.ndarray, b: np.ndarray, radius: int, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of ``a`` and ``b`` (unsigned, each sorted by population count) within ``radius`` bits, by tile pair."""
    pop_a, pop_b = np.bitwise_count(a).astype(np.int16), np.bitwise_count(b).astype(np.int16)
    for i in range(0, len(a), block):
        x, low, high = a[i:i + block, None], pop_a[i], pop_a[min(i + block, len(a)) - 1]
        for j in range(0, len(b), block):
            end = min(j + block, len(b))
            if pop_b[j] - high > radius:
                break
            if low - pop_b[end - 1] > radius:
                continue
            near = np.bitwise_count(x ^ b[None, j:end]) <= radius
            p, q = np.nonzero(near)
            yield p + i, q + j


def local_roots(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) that keep the components of one piece of work: ``left`` with itself, or with ``right``."""
    order = lambda x: x[np.argsort(np.bitwise_count(x), kind="stable")]
    left = order(left)
    right = left if right is None else order(right)
    shift = 0 if right is left else len(left)
    nodes = left if right is left else np.concatenate([left, right])
    label = np.arange(len(nodes))

    def find(x: np.ndarray) -> np.ndarray:
        while True:
            up = label[x]
            if np.array_equal(up, x):
                return x
            x = up

    for p, q in near_pairs(left, right, radius):
        q = q + shift
        while len(p):
            a, b = find(p), find(q)
            apart = a != b
            p, q, a, b = p[apart], q[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
    root = find(np.arange(len(nodes)))
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def block_keys(fingerprint: Column, radius: int) -> Column:
    """Array of (block, bits): the fingerprint's ``radius + 1`` blocks of bits."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[F.struct(F.lit(i).alias("block"),
                              F.shiftrightunsigned(fingerprint, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("bits"))
                     for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]))])


def near_links(fingerprints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) whose closure is that of all pairs within ``radius``."""
    placed = fingerprints.select("fp", F.inline(block_keys(F.col("fp"), radius)))
    full = (placed.groupBy("block", "bits").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > tile)
            .select("block", "bits", F.ceil(F.col("rows") / tile).cast("int").alias("tiles")))
    tiles = F.coalesce(F.col("tiles"), F.lit(1))
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    partners = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(
        F.least(t, F.col("own")).alias("t1"), F.greatest(t, F.col("own")).alias("t2"), (F.col("own") > t).alias("second")))
    work = (placed.join(full, ["block", "bits"], "left").withColumn("tiles", tiles).withColumn("own", own)
            .select("fp", "block", "bits", F.inline(partners))
            .repartition("block", "bits", "t1", "t2").sortWithinPartitions("block", "bits", "t1", "t2", "second"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            ends = _run_ends(batch)
            last = ends[-2] if len(ends) > 1 else 0  # the last run may go on in the next batch
            yield _compared(batch.iloc[:last], ends[:-1])
            rest = batch.iloc[last:]
        if rest is not None and len(rest):
            yield _compared(rest.reset_index(drop=True), [len(rest)])

    def _run_ends(batch: pd.DataFrame) -> list[int]:
        key = batch[["block", "bits", "t1", "t2"]].to_numpy(np.int64)
        return [*(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(batch)]

    def _compared(batch: pd.DataFrame, ends: list[int]) -> pd.DataFrame:
        fp = batch["fp"].to_numpy(np.int64).view(np.uint64)
        second, t1, t2 = batch["second"].to_numpy(bool), batch["t1"].to_numpy(), batch["t2"].to_numpy()
        out, at = [], 0
        for end in ends:
            if end - at > 1:
                run, side = fp[at:end], second[at:end]
                out.append(local_roots(run, None, radius) if t1[at] == t2[at] else local_roots(run[~side], run[side], radius))
            at = end
        a = np.concatenate([x for x, _ in out]) if out else np.empty(0, np.uint64)
        b = np.concatenate([x for _, x in out]) if out else np.empty(0, np.uint64)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return work.mapInPandas(compare, "a bigint, b bigint").distinct()


def simhash_groups(fingerprints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``fp, root`` for every distinct fingerprint (column ``fp``) that has a neighbour; the others stand alone."""
    distinct = fingerprints.select("fp").where("fp is not null").distinct()
    return components(near_links(distinct, radius, tile), "simhash-links").select(F.col("node").alias("fp"), "root")


def simhash_dedup(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fp, component_id`` per input row: the fingerprint and the smallest id of the row's component.

    Texts without words (null, empty) have fingerprint 0 and are linked like any other. Repeated rows share a
    fingerprint and get a row each. Null ids keep their row and are never a component's id unless it has no other.
    Other columns are not read; an empty table gives an empty table.
    """
    rows = stored(docs.select(F.col(id_col).alias("id"), simhash_column(F.col(text_col), shingle, seed).alias("fp")), "simhash")
    smallest = rows.groupBy("fp").agg(F.min("id").alias("id"))
    labelled = stored(smallest.join(simhash_groups(smallest.select("fp"), radius), "fp", "left"), "simhash-labelled")
    grouped = labelled.where("root is not null")
    # a component of very many fingerprints is dealt to SALTS places, each of which gets its smallest id
    by_root = grouped.groupBy("root").agg(F.min("id").alias("component_id")).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = (grouped.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int")).join(by_root, ["root", "salt"])
             .select("fp", "component_id"))
    alone = labelled.where("root is null").select("fp", F.col("id").alias("component_id"))
    return rows.join(named.unionByName(alone), "fp")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without all but one of each component.

    The one kept has the smallest id (null ids last), then the smallest hash of its columns; of rows equal in all
    columns one stays. Returns the columns of ``docs``.
    """
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]) if docs.columns else F.lit(0)
    rows = stored(docs.select(F.col(id_col).alias("id"), row_hash.alias("h"),
                              simhash_column(F.col(text_col), shingle, seed).alias("fp")), "simhash-rows")
    roots = simhash_groups(rows, radius)
    # nulls last: an id that is there sorts first
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "h")
    by_print = rows.groupBy("fp").agg(F.min(place).alias("place"))
    kept = (by_print.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"))
            .agg(F.min("place").alias("place")).select("place.h", F.col("place.id").alias("id")))
    kept = stored(rows.join(kept, (rows["id"].eqNullSafe(kept["id"])) & (rows["h"] == kept["h"]), "left_semi")
                  .groupBy("id", "h").agg(F.count(F.lit(1)).alias("n")), "simhash-kept")
    name = "row_hash"
    while name in docs.columns:
        name += "_"
    marked = docs.withColumn(name, row_hash)

    def those(keys: DataFrame) -> DataFrame:
        return marked.join(keys, marked[id_col].eqNullSafe(keys["id"]) & (marked[name] == keys["h"]), "left_semi")

    single = those(kept.where("n = 1")).drop(name)
    if kept.where("n > 1").isEmpty():
        return single
    return single.unionByName(those(kept.where("n > 1")).dropDuplicates([id_col, name]).drop(name))
