"""H2: what later assets may still match. A store of past flows, reduced to one row per profile edge they could make.

The original joins flows and assets as two streams and keeps both sides, so a flow that comes before its asset is matched
when the asset arrives. Here each batch leaves the distinct (ids and IPs, hour, weekday, month) of its flows behind, and a
refresh of the static side matches only what is new in it with them.

Layout under ``root``: ``batches/b=N`` holds the rows of batch N, ``folded/b=N`` all those up to batch N. A batch that is run
again replaces its own folder; folding only takes batches before the running one, which cannot be run again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import segment_candidates
from .folder import Folder
from ..schemas import FLOW

_COLUMNS = ["src_id", "src_ip", "dst_id", "dst_ip", "area_id"]


def representative_flows(flows: DataFrame, keep: Sequence[str], tz: str | None = None, time_col: str = "event_time") -> DataFrame:
    """One flow per distinct values of ``keep`` and segment keys of every span: the latest, other columns null. Any model's
    edges of these are those of all flows. Reduced map-side before the shuffle."""
    keys = [c.alias(f"_seg{i}") for i, c in enumerate(segment_candidates(time_col, tz))]
    rows = flows.select(*keep, *keys, F.col(time_col).alias("event_time"))
    one = rows.groupBy(*keep, *[f"_seg{i}" for i in range(len(keys))]).agg(F.max("event_time").alias("event_time"))
    types = {f.name: f.dataType for f in FLOW.fields}
    return one.select(*[F.col(c) if c in keep else F.lit(None).cast(types[c]).alias(c) for c in _COLUMNS],
                      F.lit(None).cast("string").alias("flow_id"), "event_time")


class FlowMemory:
    def __init__(self, spark: SparkSession, root: str, keep: Sequence[str], tz: str | None = None,
                 retention: dt.timedelta | None = None, fold_every: int = 20):
        self.spark, self.root, self.keep, self.tz = spark, root.rstrip("/"), list(keep), tz
        self.retention, self.fold_every = retention, fold_every
        self.batches, self.folded = Folder(spark, f"{self.root}/batches"), Folder(spark, f"{self.root}/folded")

    @staticmethod
    def _numbers(folder: Folder) -> list[int]:
        """Numbers of the complete folders."""
        return sorted(int(n[2:]) for n in folder.names() if n.startswith("b=") and folder.exists(f"{n}/_SUCCESS"))

    def write(self, flows: DataFrame, batch_id: int, time_col: str = "event_time") -> None:
        """Leave a batch's flows; the folder is replaced as a whole, also by nothing."""
        one = representative_flows(flows, self.keep, self.tz, time_col)
        one.write.mode("overwrite").parquet(f"{self.root}/batches/b={batch_id}")
        if self.fold_every and len([n for n in self._numbers(self.batches) if n < batch_id]) >= self.fold_every:
            self.fold(batch_id)

    def before(self, batch_id: int) -> DataFrame | None:
        """The flows of all batches before this one (None: there are none), without those past the retention."""
        done = [n for n in self._numbers(self.folded) if n < batch_id]
        paths = [f"{self.folded.path}/b={done[-1]}"] if done else []
        paths += [f"{self.batches.path}/b={n}" for n in self._numbers(self.batches) if n < batch_id and (not done or n > done[-1])]
        if not paths:
            return None
        rows = self.spark.read.parquet(*paths)
        return rows if self.retention is None else rows.where(F.col("event_time") >= self._horizon(rows))

    def _horizon(self, rows: DataFrame):
        last = rows.select(F.max("event_time")).scalar()
        return last - F.lit(self.retention)

    def fold(self, batch_id: int) -> None:
        """Put the folders before a batch together into one, without repeated and expired rows."""
        rows = self.before(batch_id)
        numbers = [n for n in self._numbers(self.batches) if n < batch_id]
        if rows is None or not numbers:
            return
        representative_flows(rows, self.keep, self.tz).write.mode("overwrite").parquet(f"{self.folded.path}/b={numbers[-1]}")
        for n in numbers:
            self.batches.delete(f"b={n}")
        for n in self._numbers(self.folded)[:-1]:
            self.folded.delete(f"b={n}")
