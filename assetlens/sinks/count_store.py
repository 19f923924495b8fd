"""A store of flow counts that accumulates over batches and survives their replay.

A count, unlike a set, must not be added twice. So partial counts are keyed by (batch, edge): a batch owns a folder, and a
batch that is run again replaces it. Folders are folded in tiers, ``tier`` of them into one of the next level, so each
row is rewritten once per level, not once per fold, and a reader sums over few folders.

Layout under ``root``: ``level=L/from=A/upto=B`` holds the counts of batches A to B. A folder hides all those of lower levels
within its range; only batches before the running one are folded, as those cannot be run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .folder import Folder
from ..schemas import EDGE_KEY

_COUNTS = T.StructType([T.StructField("model_id", T.StringType()), T.StructField("entity_id", T.StringType()),
                        T.StructField("segment_key", T.IntegerType()), T.StructField("host_ip", T.StringType()),
                        T.StructField("n", T.LongType())])


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*EDGE_KEY).agg(F.sum("n").cast("long").alias("n"))


class CountStore:
    def __init__(self, spark: SparkSession, root: str, tier: int = 10):
        if tier < 2:
            raise ValueError("tier must be at least 2")
        self.spark, self.root, self.tier = spark, root.rstrip("/"), tier

    def _folders(self) -> list[tuple[int, int, int]]:
        """(level, from, upto) of the complete folders that no higher one hides."""
        found = []
        for level in Folder(self.spark, self.root).names():
            for start in Folder(self.spark, f"{self.root}/{level}").names():
                inside = Folder(self.spark, f"{self.root}/{level}/{start}")
                found += [(int(level[6:]), int(start[5:]), int(n[5:])) for n in inside.names() if inside.exists(f"{n}/_SUCCESS")]
        return [f for f in sorted(found) if not any(g[0] > f[0] and g[1] <= f[1] and f[2] <= g[2] for g in found)]

    def _path(self, level: int, start: int, upto: int) -> str:
        return f"{self.root}/level={level}/from={start}/upto={upto}"

    def _read(self, folders: list[tuple[int, int, int]]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], _COUNTS)
        return self.spark.read.schema(_COUNTS).parquet(*[self._path(*f) for f in folders])

    def write_batch(self, counts: DataFrame, batch_id: int) -> None:
        """Store the counts (edge key and ``n``) of a batch, in place of what an earlier attempt of it stored."""
        rows = _summed(counts.select(*[F.col(f.name).cast(f.dataType) for f in _COUNTS.fields]))
        rows.write.mode("overwrite").parquet(self._path(0, batch_id, batch_id))
        self.fold(batch_id)

    def read_counts(self) -> DataFrame:
        """(edge key, n): the flows of every edge so far."""
        return _summed(self._read(self._folders()))

    def fold(self, batch_id: int) -> None:
        """Fold full tiers of folders before a batch, level by level."""
        level = 0
        while True:
            whole = [f for f in self._folders() if f[0] == level and f[2] < batch_id]
            if len(whole) < self.tier:
                return
            path = self._path(level + 1, whole[0][1], whole[-1][2])
            _summed(self._read(whole)).write.mode("overwrite").parquet(path)
            for f in whole:  # hidden from now on
                Folder(self.spark, f"{self.root}/level={level}").delete(f"from={f[1]}/upto={f[2]}")
            level += 1
