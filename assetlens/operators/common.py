"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Largest number of rows and of bytes a side may have to be broadcast by these helpers.
DEFAULT_BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 256 << 20


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, bound: int | None = None,
                   max_bytes: int = BROADCAST_BYTES, bound_bytes: int = 0) -> bool:
    """Whether ``df`` provably has at most ``max_rows`` rows and ``max_bytes`` bytes.

    ``bound`` is an upper bound of the rows that the caller already proved (e.g. from a small config table), and
    ``bound_bytes`` one of their texts' bytes (0: no texts but ids of the config table's size);
    otherwise rows and bytes are counted up to ``max_rows + 1`` rows (one pass over ``df`` at most; callers
    only pass asset- or config-side tables, never flows).
    """
    if bound is not None and bound <= max_rows and bound_bytes + 8 * len(df.columns) * bound <= max_bytes:
        return True
    # fixed-width columns count 8 bytes, others their text's length as well
    text = [F.octet_length(F.col(f"`{c}`").cast("string")) for c, t in df.dtypes if t == "string"]
    size = sum((F.coalesce(t, F.lit(0)) for t in text), F.lit(8 * len(df.columns))).cast("long")
    rows, total = df.select(size.alias("size")).limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum("size")).first()
    return rows <= max_rows and (total or 0) <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, bound: int | None = None,
                      bound_bytes: int = 0) -> DataFrame:
    """Mark ``df`` for broadcast only when it ``fits_broadcast``. Larger inputs are returned unchanged,
    so the optimizer (and AQE at run time) picks a shuffle join for them."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, bound, bound_bytes=bound_bytes) else df


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key, by the given ordering columns (ties: later columns decide).

    Uses ``max_by`` so the work is a partial aggregation (map-side combine) instead of a sort
    of every key's rows.
    """
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order])).alias("_last"))
    return agg.select(*keys, *[F.col("_last")[c].alias(c) for c in rest])


# Largest asset-side table (rows) the flow joins broadcast; above it they shuffle.
ASSET_BROADCAST_ROWS = 1_000_000


def join_small_side(big: DataFrame, small: DataFrame, left_on: list[str], right_on: list[str],
                    how: str = "inner", max_rows: int = ASSET_BROADCAST_ROWS, salt_buckets: int = 1,
                    salt_from: list[str] | None = None, fits: bool | None = None) -> DataFrame:
    """Equi join of a large flow-side table with an asset-side table.

    ``fits`` tells whether the asset side fits a broadcast where the caller has found out already.

    * asset side provably small (<= ``max_rows`` rows): broadcast it, the big side is not shuffled;
    * otherwise a shuffle join. With ``salt_buckets`` > 1 every big-side row gets a salt from a
      hash of ``salt_from`` and the small side is replicated once per salt value, so one hot key
      (say a gateway IP with a third of all flows) is spread over ``salt_buckets`` tasks. AQE's
      skew-join split covers the remaining cases.
    Column names of the two sides must not collide except through the join keys.
    """
    if fits is None:
        fits = fits_broadcast(small, max_rows)
    small_b = F.broadcast(small) if fits else small
    cond = [big[lk] == small_b[rk] for lk, rk in zip(left_on, right_on)]
    if salt_buckets > 1 and small_b is small:
        salt_cols = salt_from or left_on
        big = big.withColumn("_salt", F.pmod(F.xxhash64(*salt_cols), F.lit(salt_buckets)))
        small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
        cond = [big[lk] == small[rk] for lk, rk in zip(left_on, right_on)] + [big["_salt"] == small["_salt"]]
        out = big.join(small, cond, how)
        return out.drop(big["_salt"]).drop(small["_salt"]) if how not in ("left_semi", "left_anti") \
            else out.drop("_salt")
    c = cond[0]
    for x in cond[1:]:
        c = c & x
    return big.join(small_b, c, how)
