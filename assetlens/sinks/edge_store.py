"""An idempotent, mergeable edge table on plain parquet.

Layout under ``root``::

    edges/model_id=M/gen=G/batch_id=N/attempt=A/bucket=B/part-*.parquet   edge rows, B from a hash of the asset id
    commits/part-*.parquet   (model_id, gen, batch_id, span): what began a generation, and its dimension
    batches/part-*.parquet   (batch_id, attempt, model_id, gen): the manifest, the folders each attempt of a batch owns
    modes/part-*.parquet     (model_id, accumulate, batch_id): update modes applied
    shown                    where batches are held back: the last one shown to readers, and when

* Every attempt of a batch writes folders of its own and is recorded in the manifest after its data (a row without a
  model stands for the attempt itself). Readers take the folders of each batch's last recorded attempt and nothing else, so a
  replay replaces what the attempt before it wrote, also for models it has no edges for any more, and an attempt
  that died leaves nothing visible (exactly-once, B5).
* Accumulate (B3) = append a batch; the read view deduplicates the edge key (set union, E4).
* Replace (B2) = a batch begins generation G+1 of a model; a replay goes on with the generation its batch began. A model
  is only replaced by a batch that has edges for it: a batch without any leaves its profile alone.
* A generation has one dimension (the model's result span). A batch of another span begins a new generation, whatever the
  update mode, so hours and weekdays never mix in a profile (D7). The dimension is kept with the generation, over restarts.
* A model's current generation is the highest one that the manifest owns folders of. The read view is an equi join of
  the edges with these (few) folders on the partition columns: dynamic partition pruning skips all others.
* ``hold`` and ``flush`` keep batches from readers until enough of them wait (H5). They are stored all the same, so what waits
  is neither lost nor written twice by a restart.
* ``fold`` puts full tiers of older batches together, level by level: a row is rewritten once per level, and the newest
  batches, which may be run again, are left alone. ``compact`` rewrites the whole current profile as one folder per model.
  ``vacuum`` removes what no reader needs any more.
* With ``only_new`` a batch is met with the stored keys of its own models and buckets only.

The driver holds the models' generations and update modes: some numbers per model, a configuration-sized table.
"""

from __future__ import annotations

import time
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.common import bounded_broadcast
from ..operators.profile import dedupe_edges
from ..schemas import EDGE, EDGE_KEY
from .folder import Folder

_FOLDER = ["model_id", "gen", "batch_id", "attempt"]
_STORED = T.StructType(EDGE.fields + [T.StructField("gen", T.IntegerType()), T.StructField("batch_id", T.LongType()),
                                      T.StructField("attempt", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
_FOLDED = -(1 << 40)  # ids from here down are folded batches; above, negative ones are compactions
_LEVELS = 16
_COMMIT = T.StructType([T.StructField("model_id", T.StringType()), T.StructField("gen", T.IntegerType()),
                        T.StructField("batch_id", T.LongType()), T.StructField("span", T.IntegerType())])
_BATCH = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("attempt", T.IntegerType()),
                       T.StructField("model_id", T.StringType()), T.StructField("gen", T.IntegerType())])
_MODE = T.StructType([T.StructField("model_id", T.StringType()), T.StructField("accumulate", T.BooleanType()),
                      T.StructField("batch_id", T.LongType())])


class EdgeStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 1):
        self.spark, self.buckets = spark, buckets
        # set by a job that is the only writer: what it wrote last need not be read again before its next batch
        self.exclusive = False
        self._memo: tuple[dict[str, tuple], int] | None = None
        self.root = root.rstrip("/")
        self.data = f"{self.root}/edges"
        self.commits = f"{self.root}/commits"
        self.batches = f"{self.root}/batches"
        self.modes = f"{self.root}/modes"

    def init(self) -> "EdgeStore":
        """Create empty tables (no-op when they exist)."""
        empty = self.spark.createDataFrame([], _STORED)
        empty.write.mode("ignore").partitionBy(*_FOLDER, "bucket").parquet(self.data)
        self.spark.createDataFrame([], _BATCH).write.mode("ignore").parquet(self.batches)
        self.spark.createDataFrame([], _COMMIT).write.mode("ignore").parquet(self.commits)
        self.spark.createDataFrame([], _MODE).write.mode("ignore").parquet(self.modes)
        return self

    # ------------------------------------------------------------------ reads
    # one partition: some rows per model and unfolded batch, put together without a shuffle
    def commit_rows(self) -> DataFrame:
        return self.spark.read.schema(_COMMIT).parquet(self.commits).coalesce(1)

    def batch_rows(self) -> DataFrame:
        return self.spark.read.schema(_BATCH).parquet(self.batches).coalesce(1)

    def owned(self, upto: int | None = None) -> DataFrame:
        """The folders that count: those of the last recorded attempt of each batch (up to batch ``upto``)."""
        rows = self.batch_rows()
        rows = rows if upto is None else rows.where(F.col("batch_id") <= upto)
        last = rows.groupBy("batch_id").agg(F.max("attempt").alias("attempt"))
        return rows.where("model_id is not null").join(last, ["batch_id", "attempt"]).select(*_FOLDER).distinct()

    def generations(self, upto: int | None = None) -> DataFrame:
        """(model_id, gen): the current generation of every model that has a profile."""
        return self.owned(upto).groupBy("model_id").agg(F.max("gen").alias("gen"))

    def current_folders(self, upto: int | None = None) -> DataFrame:
        """The folders of the current generations."""
        return self.owned(upto).join(self.generations(upto), ["model_id", "gen"]).select(*_FOLDER)

    # ------------------------------------------------------------------ held back and shown
    def _shown(self) -> tuple[int, float] | None:
        text = Folder(self.spark, self.root).read("shown")
        return None if text is None else (int(text.split()[0]), float(text.split()[1]))

    def hold(self) -> None:
        """From now on batches are shown to readers by ``flush`` only."""
        if self._shown() is None:
            top = self.batch_rows().agg(F.max("batch_id")).first()[0]
            Folder(self.spark, self.root).write("shown", f"{-1 if top is None else max(top, -1)} {time.time()}")

    def flush(self, batch_id: int, assets: int = 0, seconds: float = 0.0) -> bool:
        """Show all batches up to ``batch_id`` if more than ``assets`` assets wait in them, or the last flush was ``seconds``
        ago. Returns whether it did."""
        shown = self._shown()
        if shown is None:
            return True
        if time.time() - shown[1] < seconds:
            waiting = self._rows(self.owned().where(F.col("batch_id") > shown[0]))
            if waiting.select("entity_id").distinct().limit(assets + 1).count() <= assets:
                return False
        Folder(self.spark, self.root).write("shown", f"{max(batch_id, shown[0])} {time.time()}")
        return True

    def dimensions(self) -> DataFrame:
        """(model_id, gen, span): the dimension of every current generation (null: unknown)."""
        spans = self.commit_rows().groupBy("model_id", "gen").agg(F.max("span").alias("span"))
        return self.generations().join(spans, ["model_id", "gen"], "left")

    def _rows(self, folders: DataFrame, within=None) -> DataFrame:
        rows = self.spark.read.schema(_STORED).parquet(self.data)
        rows = rows if within is None else rows.where(within)
        return rows.join(bounded_broadcast(folders), _FOLDER, "inner")

    def bucket(self, entity_id="entity_id"):
        """The bucket of an asset id."""
        return F.pmod(F.xxhash64(entity_id), F.lit(self.buckets)).cast("int")

    def raw_edges(self) -> DataFrame:
        """The rows of all owned folders as they were written, older generations included."""
        return self._rows(self.owned())

    def read_edges(self) -> DataFrame:
        """The current profile as distinct edges with the latest ``updated_at``, of the batches that are shown."""
        shown = self._shown()
        return dedupe_edges(self._rows(self.current_folders(shown and shown[0])).select(*EDGE_KEY, "updated_at"))

    def read_model(self, model_id: str) -> DataFrame:
        """A9 for one model (partition pruned on model_id)."""
        return self.read_edges().where(F.col("model_id") == model_id)

    def read_asset(self, model_id: str, entity_id: str) -> DataFrame:
        """A9 for one asset (partition pruned on model and bucket)."""
        mine = (F.col("model_id") == model_id) & (F.col("entity_id") == entity_id) & (F.col("bucket") == self.bucket(F.lit(entity_id)))
        shown = self._shown()
        return dedupe_edges(self._rows(self.current_folders(shown and shown[0]), mine).select(*EDGE_KEY, "updated_at"))

    def applied_modes(self) -> dict[str, bool]:
        """The update mode (True: accumulate) last applied to each model."""
        rows = self.spark.read.schema(_MODE).parquet(self.modes)
        return dict(rows.groupBy("model_id").agg(F.max_by("accumulate", "batch_id")).collect())

    # ------------------------------------------------------------------ writes
    def record_modes(self, modes: dict[str, bool], batch_id: int) -> None:
        """Remember update modes as applied from batch ``batch_id`` on."""
        if modes:
            rows = [(m, acc, batch_id) for m, acc in sorted(modes.items())]
            self.spark.createDataFrame(rows, _MODE).coalesce(1).write.mode("append").parquet(self.modes)

    def _known(self, batch_id: int) -> tuple[dict[str, tuple], int]:
        """Per model (current generation, its span, highest generation begun, the one this batch began and its span), and
        the last recorded attempt of this batch (-1: none). Some numbers per model."""
        if self._memo and batch_id > self._memo[1]:
            return self._memo[0], -1
        begun = self.commit_rows().groupBy("model_id").agg(
            F.max("gen").alias("top"), F.max(F.when(F.col("batch_id") == batch_id, F.struct("gen", "span"))).alias("mine"))
        rows = self.dimensions().withColumnRenamed("gen", "cur").join(begun, "model_id", "full_outer").collect()
        last = self.batch_rows().where(F.col("batch_id") == batch_id).agg(F.max("attempt")).first()[0]
        return {r["model_id"]: (r["cur"], r["span"], -1 if r["top"] is None else r["top"], r["mine"]) for r in rows}, -1 if last is None else last

    def _write(self, edges: DataFrame, gens: dict[str, int], batch_id: int, attempt: int = 0) -> None:
        # a row per model of the batch
        table = self.spark.createDataFrame(sorted(gens.items()), "model_id string, gen int")
        rows = edges.select(*EDGE_KEY, "updated_at").join(bounded_broadcast(table, bound=len(gens)), "model_id", "inner") \
            .withColumn("batch_id", F.lit(batch_id).cast("long")).withColumn("attempt", F.lit(attempt)) \
            .withColumn("bucket", self.bucket())
        # REBALANCE groups rows by their output folder and lets AQE split an oversized model into
        # advisory-size chunks: few, evenly sized files per (model, gen, batch) instead of one file
        # per model in every task
        rows = rows.hint("rebalance", *_FOLDER, "bucket")
        (rows.select(*[f.name for f in _STORED.fields]).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(*_FOLDER, "bucket").parquet(self.data))

    def _clear(self, batch_id: int, attempt: int) -> None:
        """Remove what an attempt that died before it was recorded may have left: the next one has the same number."""
        jvm = self.spark._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.data}/model_id=*/gen=*/batch_id={batch_id}/attempt={attempt}")
        fs = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for status in fs.globStatus(pattern) or []:
            fs.delete(status.getPath(), True)

    def _append(self, rows: list[tuple], schema: T.StructType, path: str) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)

    def stored_except(self, batch_id: int, models: Iterable[str] | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """Current edge keys written by batches other than ``batch_id``, of some models and buckets only if they are given:
        other folders are not read."""
        within = None
        for column, values in (("model_id", models), ("bucket", buckets)):
            if values is not None:
                one = F.col(column).isin(sorted(values))
                within = one if within is None else within & one
        return self._rows(self.current_folders().where(F.col("batch_id") != batch_id), within).select(*EDGE_KEY)

    def write_batch(self, edges: DataFrame, batch_id: int, replace_models: DataFrame | Iterable[str] | None = None,
                    only_new: bool = False, spans: dict[str, int] | None = None) -> set[str]:
        """B1/B3 (accumulate) and, for ``replace_models`` (ids, or a table with a column model_id), B2 (replace).

        Returns the models that had edges. Those without any keep their profile, also when they are to be replaced.
        ``edges`` should be deduplicated already (``profile_edges`` output is) and cheap to read twice. ``spans`` is the
        models' dimension: one that differs from the current generation's begins a new generation. A batch that
        was written before is replaced as a whole, by nothing if there are no edges now. With
        ``only_new`` edges that are already stored are not written again (a left anti join with the current
        profile, excluding this batch's own folders so that a replay does not erase itself); this
        keeps the table growing with new edges only, at the cost of reading the stored keys.
        """
        if isinstance(replace_models, DataFrame):
            replace_models = [r[0] for r in replace_models.select("model_id").distinct().collect()]
        replace, spans = set(replace_models or ()), spans or {}
        # a row per model and bucket of the batch
        touched = edges.select("model_id", *([self.bucket().alias("bucket")] if only_new else [])).distinct().collect()
        present = {r[0] for r in touched}
        known, last = self._known(batch_id)
        if not present and last < 0:
            return present
        gens, new, fresh = {}, [], set()
        for m in sorted(present):
            cur, span, top, mine = known.get(m, (None, None, -1, None))
            wanted = spans.get(m)
            fits = lambda have: wanted is None or have is None or have == wanted
            if mine is not None and fits(mine["span"]) and (m in replace or mine["gen"] >= (-1 if cur is None else cur)):
                gens[m] = mine["gen"]  # a replay goes on with what its batch began
            elif cur is None or m in replace or not fits(span):
                gens[m] = top + 1
                new.append((m, gens[m], batch_id, wanted))
            else:
                gens[m] = cur
                if span is None and wanted is not None:  # written before its dimension was known
                    new.append((m, cur, None, wanted))
            if m in replace or gens[m] != cur or (mine is not None and gens[m] == mine["gen"]):
                fresh.add(m)
        if only_new:
            old = self.stored_except(batch_id, present - fresh, {r[1] for r in touched})
            edges = edges.join(old, EDGE_KEY, "left_anti")
        memo, self._memo = self._memo, None  # a failure below leaves nothing to go by
        if memo is None or batch_id <= memo[1]:  # else this object has begun no such batch
            self._clear(batch_id, last + 1)
        if present:
            self._write(edges, gens, batch_id, last + 1)
        # after the data, so that a crash in between changes nothing; the manifest comes last
        if new:
            self._append(new, _COMMIT, self.commits)
        self._append([(batch_id, last + 1, None, None), *((batch_id, last + 1, m, g) for m, g in gens.items())], _BATCH, self.batches)
        if self.exclusive:
            after = {m: (*k[:3], None) for m, k in known.items()}
            for m, g in gens.items():
                cur, span, top, _ = known.get(m, (None, None, -1, None))
                after[m] = (g, spans.get(m, span if g == cur else None), max(top, g), None)
            # an older batch written again may change which generation is current
            self._memo = (after, max(batch_id, memo[1] if memo else batch_id)) if last < 0 else None
        return present

    def fold(self, batch_id: int, tier: int = 10) -> int:
        """Put older batches of the current generations together, ``tier`` or more of a level into one of the next. Only
        batches before ``batch_id``, the running one, are taken. Returns how many were folded.

        The folded folder and the end of those it replaces are one entry of the manifest, so readers see either.
        """
        if tier < 2:
            raise ValueError("tier must be at least 2")
        shown = self._shown()
        if shown is not None:  # what is not shown stays apart
            batch_id = min(batch_id, shown[0] + 1)
        folded = 0
        for level in range(_LEVELS - 1):
            at = F.when(F.col("batch_id") <= _FOLDED, (F.lit(_FOLDED) - F.col("batch_id")) % _LEVELS).otherwise(0)
            upto = F.when(F.col("batch_id") <= _FOLDED, F.expr(f"({_FOLDED} - batch_id) div {_LEVELS}")).otherwise(F.col("batch_id"))
            mine = self.current_folders().where(((F.col("batch_id") >= 0) | (F.col("batch_id") <= _FOLDED)) & (at == level) & (upto < batch_id))
            ids = sorted((r["upto"], r["batch_id"]) for r in mine.select("batch_id", upto.alias("upto")).distinct().collect())
            if len(ids) < tier:
                break
            new = _FOLDED - (ids[-1][0] * _LEVELS + level + 1)
            last = {r["batch_id"]: r["attempt"] for r in self.batch_rows().where(F.col("batch_id").isin([new, *[b for _, b in ids]]))
                    .groupBy("batch_id").agg(F.max("attempt").alias("attempt")).collect()}
            attempt = last.get(new, -1) + 1
            gens = {r["model_id"]: r["gen"] for r in mine.select("model_id", "gen").distinct().collect()}
            self._clear(new, attempt)
            # deduplicated while it is rewritten; the manifest holds these folders, so nothing is read that is not current
            self._write(dedupe_edges(self._rows(mine).select(*EDGE_KEY, "updated_at")), gens, new, attempt)
            self._append([(new, attempt, None, None), *((new, attempt, m, g) for m, g in gens.items()),
                          *((b, last[b] + 1, None, None) for _, b in ids)], _BATCH, self.batches)
            folded += len(ids)
        return folded

    def compact(self, batch_id: int | None = None) -> None:
        """Rewrite every model's current profile as one new generation (fewer files, no duplicates).

        Without ``batch_id`` a fresh id is taken; a given one (even and negative, see ``compaction_id``) makes a
        replay of the same compaction do nothing. The snapshot is written as a table under the store root first, which also
        cuts the lineage.
        """
        seen = self.batch_rows().agg(F.min(F.when(F.col("batch_id") > _FOLDED, F.col("batch_id"))), F.max(F.col("batch_id") == F.lit(batch_id))).first()
        if seen[1]:
            return
        if batch_id is None:
            batch_id = min(seen[0] or 0, 0) - 1
            batch_id -= 1 - batch_id % 2  # odd: apart from the ids of a stream's compactions
        if self._shown() is not None:
            self.flush(self.batch_rows().agg(F.max("batch_id")).first()[0] or 0)
        path = f"{self.root}/compact/batch_id={batch_id}"
        self.read_edges().write.mode("overwrite").parquet(path)
        snap = self.spark.read.parquet(path)
        spans = {r["model_id"]: r["span"] for r in self.dimensions().collect()}  # a row per model
        self.write_batch(snap, batch_id, replace_models=spans, spans=spans)

    @staticmethod
    def compaction_id(batch_id: int) -> int:
        """The id of the compaction that follows stream batch ``batch_id``."""
        return -2 * (batch_id + 1)

    def vacuum(self, keep: int = 1) -> None:
        """Remove generations older than the last ``keep`` before the current one, folders that no manifest owns, compaction
        snapshots, and all rows of the small tables that nothing needs. Run it where batches are written, not beside a
        running batch; readers that began under a kept generation are not disturbed."""
        jvm = self.spark._jvm
        conf, new_path = self.spark._jsc.hadoopConfiguration(), jvm.org.apache.hadoop.fs.Path
        fs = new_path(self.root).getFileSystem(conf)
        current = {r["model_id"]: r["gen"] for r in self.generations().collect()}
        kept = self.owned().join(self.generations().withColumnRenamed("gen", "cur"), "model_id").where(F.col("gen") >= F.col("cur") - keep)
        folders = {tuple(r) for r in kept.select(*_FOLDER).toLocalIterator()}  # as many as the folders listed below
        for status in fs.globStatus(new_path(f"{self.data}/model_id=*/gen=*/batch_id=*/attempt=*")) or []:
            path, part = status.getPath(), status.getPath()
            values = []
            for _ in _FOLDER:
                values.append(unquote(part.getName().split("=", 1)[1]))
                part = part.getParent()
            model, gen, batch, attempt = reversed(values)
            if (model, int(gen), int(batch), int(attempt)) not in folders:
                fs.delete(path, True)
        for status in fs.globStatus(new_path(f"{self.data}/model_id=*/gen=*")) or []:
            path = status.getPath()
            model, gen = unquote(path.getParent().getName().split("=", 1)[1]), path.getName().split("=", 1)[1]
            if model in current and gen.isdigit() and int(gen) < current[model] - keep:
                fs.delete(path, True)
        fs.delete(new_path(f"{self.root}/compact"), True)
        commits = self.commit_rows().join(kept.select("model_id", "gen").distinct(), ["model_id", "gen"]).select(*_COMMIT.names).distinct()
        top = self.commit_rows().groupBy("model_id").agg(F.max(F.struct("gen", "batch_id", "span")).alias("r")).select("model_id", "r.*")
        rows = kept.select("batch_id", "attempt", "model_id", "gen")
        marks = self.batch_rows().groupBy("batch_id").agg(F.max("attempt").alias("attempt"))
        marks = marks.where("batch_id >= 0").orderBy(F.desc("batch_id")).limit(1).unionByName(marks.join(rows.select("batch_id"), "batch_id", "left_semi"))
        marks = marks.select("batch_id", "attempt", F.lit(None).cast("string").alias("model_id"), F.lit(None).cast("int").alias("gen"))
        modes = self.spark.read.schema(_MODE).parquet(self.modes)
        last = modes.groupBy("model_id").agg(F.max_by(F.struct(*modes.columns), "batch_id").alias("r")).select("r.*")
        for table, small, schema in ((self.commits, commits.unionByName(top).distinct(), _COMMIT),
                                     (self.batches, rows.unionByName(marks).distinct(), _BATCH), (self.modes, last, _MODE)):
            files = [f.getPath() for f in fs.globStatus(new_path(f"{table}/part-*")) or []]
            merged = small.collect()  # rows per model, and per folder that is left
            if len(files) > 1 and merged:
                # repeated rows change nothing, so the merged file may stand beside the old ones for a moment
                self._append(merged, schema, table)
                for f in files:
                    fs.delete(f, False)
