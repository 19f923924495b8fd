"""H1-H8 + B1: flows stream -> (parse, quarantine) -> complete -> profile edges -> edge store.

* Event time (H1) is the flow's ``event_time`` (from rTime or the Kafka timestamp); segment keys
  come from it, not from the wall clock.
* The asset side is static and re-read inside ``foreachBatch`` once it is older than ``ttl_s``
  (H6), because a static DataFrame keeps its file listing / JDBC snapshot for the life of the
  query. A stream-static join needs no join state (H2). Each version of it is kept, and each batch is pinned to one: a
  batch that is run again after a restart matches with the version it began with (``ScopeLog``).
* Each micro-batch is aggregated once and written as a batch of the edge store (B1, B5), whose readers only see the last
  attempt, so the checkpoint (H4) gives exactly-once results after a restart or a lost executor.
* With a ``FlowMemory`` flows also match assets that come after them (H2): when a refresh brings new (model, asset) pairs,
  those alone are matched with the past flows, which are kept reduced to one per possible edge. A model that
  changes its dimension is such a change too, so its new profile covers the past.
* ``matcher="touch"`` profiles by area and IP (D5, E2) instead of the asset id. The (area, IP) index is part of the pinned
  version, and a refresh matches past flows with the index rows that are new in it only (E5).
* With ``flush_assets`` a batch is stored at once but shown to readers when more than so many assets wait, or after
  ``flush_s`` (H5); what waits survives a restart.
* With a ``CountStore`` the flows per edge (E3) accumulate beside the profile.
* With ``honour_update_mode`` (H7) the models' update modes are compared with those last applied, which the store
  keeps, so the comparison survives a restart. A model that has turned to replace (0) is written as a new
  generation once, by the first batch that has edges for it. The live path of the original job always
  accumulates, which is the default here.
* Malformed records go to a quarantine table instead of failing the query (H8).
* Status events (B7): ``running`` when the query starts, ``failed`` for models that cannot run, ``success`` after
  a model's first batch with edges, ``stop`` when the query fails.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import operators as op
from ..functions import segment_candidates
from ..operators.common import ASSET_BROADCAST_ROWS
from ..schemas import EDGE_KEY
from ..session import scratch_path
from ..sinks.count_store import CountStore
from ..sinks.edge_store import EdgeStore
from ..sinks.flow_memory import FlowMemory
from ..sinks.scope_log import ScopeLog
from ..sinks.status_log import StatusLog

# Returns the runnable models, the (model, asset) table and, optionally, the models that cannot run.
ScopeLoader = Callable[[], "tuple[DataFrame, DataFrame] | tuple[DataFrame, DataFrame, DataFrame]"]


class _Scope:
    """One version of the static side, cached while it is in use."""

    def __init__(self, version: str, tables: dict[str, DataFrame], max_rows: int):
        self.version = version
        # of the assets, what edges are matched by; the snapshot keeps all their columns
        self.params, self.scoped = tables["params"].cache(), tables["assets"].select("model_id", "entity_id", "span").cache()
        self.index = tables["index"].cache() if "index" in tables else None
        rows = self.params.select("model_id", "span", "accumulate").collect()  # a row per model
        self.modes = {r["model_id"]: bool(r["accumulate"]) for r in rows}
        self.dimensions = {r["model_id"]: r["span"] for r in rows}
        self.spans = sorted({r["span"] for r in rows if r["span"] is not None})  # decides the pre-aggregation keys
        # once per version
        self.fits = op.scope_fits(self.scoped, max_rows) if self.index is None else op.index_fits(self.index, max_rows)

    def unpersist(self) -> None:
        for df in (self.params, self.scoped, self.index):
            if df is not None:
                df.unpersist()


class ProfileStream:
    def __init__(self, spark: SparkSession, scope_loader: ScopeLoader, store: EdgeStore, *,
                 status: StatusLog | None = None, quarantine_path: str | None = None,
                 prepare: Callable[[DataFrame], DataFrame] | None = None, parse: bool = False,
                 tz: str | None = None, ttl_s: float = 3600.0, honour_update_mode: bool = False,
                 side: str = "src", host: str = "own", join_opts: dict | None = None,
                 segment_time: str = "event", only_new_edges: bool = False, compact_every: int = 100,
                 matcher: str = "id", memory: FlowMemory | None = None, counts: CountStore | None = None,
                 scopes: ScopeLog | None = None, fold_tier: int = 0, flush_assets: int | None = None,
                 flush_s: float = 3600.0):
        self.spark = spark
        self.scope_loader = scope_loader
        self.store = store
        self.status = status
        self.quarantine_path = quarantine_path
        self.prepare = prepare
        self.parse = parse
        self.tz = tz
        self.ttl_s = ttl_s
        self.honour_update_mode = honour_update_mode
        self.side, self.host = side, host
        # e.g. {"max_rows": 1_000_000, "salt_buckets": 16}: how the asset side is joined
        self.join_opts = join_opts or {}
        if segment_time not in ("event", "processing"):
            raise ValueError("segment_time must be 'event' or 'processing'")
        # 'processing' keys segments by the wall clock when the batch runs, as the original job did
        self.segment_time = segment_time
        self.only_new_edges = only_new_edges
        # every N batches the current profile is rewritten as one generation and older ones removed (0 = never)
        self.compact_every = compact_every
        if matcher not in ("id", "touch"):
            raise ValueError("matcher must be 'id' or 'touch'")
        self.matcher, self.memory, self.counts = matcher, memory, counts
        self.scopes = scopes or ScopeLog(spark, f"{store.root}_scopes")
        store.exclusive = True  # this job is the only writer
        # readers see a batch when more than so many assets, or for so long, have been waiting (None = at once)
        self.flush_assets, self.flush_s = flush_assets, flush_s
        # full tiers of so many older batches are folded (0 = never)
        self.fold_tier = fold_tier
        self._loaded_at: float | None = None
        self._latest: str | None = None        # version of the last refresh
        self._scope: _Scope | None = None      # the version in use
        self._before: str | None = None        # the version of the batch before
        self._begun: int | None = None         # the last batch begun by this object
        self._schemas: dict[str, dict] = {}
        self._applied: dict[str, bool] | None = None  # update modes last applied
        self._succeeded: set[str] = set()
        self._failed: set[str] = set()

    @staticmethod
    def memory_columns(matcher: str = "id", side: str = "src", host: str = "own") -> list[str]:
        """What a ``FlowMemory`` must keep of the flows for this kind of profile."""
        return ["area_id", "src_ip", "dst_ip"] if matcher == "touch" else list(op.host_columns(side, host))

    # H6: refresh the static side when it is older than the TTL
    def _refresh(self) -> None:
        if self._loaded_at is not None and time.monotonic() - self._loaded_at < self.ttl_s:
            self._use(self._latest)
            return
        params, scoped, *failed = self.scope_loader()
        # read once for the digest and, where it changed, the snapshot
        tables = {"params": params.cache(), "assets": scoped.cache()}
        if self.matcher == "touch":
            tables["index"] = op.ip_index(tables["assets"]).cache()
        self._latest = self.scopes.save(tables)
        self._schemas[self._latest] = {k: df.schema for k, df in tables.items()}
        for df in tables.values():
            df.unpersist()
        self._use(self._latest)
        self._loaded_at = time.monotonic()
        if self.status is not None and failed:
            ids = {r[0] for r in failed[0].select("model_id").distinct().collect()}
            self._report(ids - self._failed, "failed")
            self._failed = ids

    def _use(self, version: str) -> None:
        """Switch to a version of the static side."""
        if self._scope is None or self._scope.version != version:
            scope = _Scope(version, self.scopes.load(version, self._schemas.get(version)),
                           self.join_opts.get("max_rows", ASSET_BROADCAST_ROWS))
            if self._scope is not None:
                self._scope.unpersist()
            self._scope = scope

    def _begin(self, batch_id: int) -> None:
        """Settle the version that a batch is run with: the pinned one if it was begun before, else the latest."""
        pinned = self.scopes.pinned(batch_id) if self._begun is None or batch_id <= self._begun else None
        if pinned is None:
            self._refresh()
            pinned = self.scopes.pin(batch_id, self._latest)
        version, self._before = pinned
        self._use(version)
        self._begun = max(batch_id, self._begun if self._begun is not None else batch_id)

    def _report(self, models: Iterable[str], status: str) -> None:
        """One status event per model, in a folder of its own, so that nothing overwrites earlier events."""
        models = sorted(models)
        if self.status is not None and models:
            table = self.spark.createDataFrame([(m,) for m in models], "model_id string")
            self.status.append(op.status_event(table, status, F.current_timestamp()), time.time_ns())

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch; a failure is reported as ``stop`` before it ends the query."""
        try:
            self._process(batch, batch_id)
        except Exception:
            self._report(self._models(), "stop")
            raise

    def _models(self) -> set[str]:
        return set(self._scope.modes) if self._scope else set()

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        self._begin(batch_id)
        df = self.prepare(batch) if self.prepare else batch
        parsed = None
        if self.parse:
            parsed = op.parse_flows(df)
            if self.quarantine_path:
                # parsed once for both uses: the quarantine write and the profile
                parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
                (op.quarantine(parsed, op.host_columns(self.side, self.host)[1] if self.matcher == "id" else None)
                 .withColumn("batch_id", F.lit(batch_id).cast("long"))
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("batch_id").parquet(self.quarantine_path))
            df = parsed
        try:
            self._write_profile(df, batch_id)
        finally:
            if parsed is not None and self.quarantine_path:
                parsed.unpersist()
        if self.fold_tier and (batch_id + 1) % self.fold_tier == 0:
            self.store.fold(batch_id, self.fold_tier)
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            self.store.compact(self.store.compaction_id(batch_id))
            self.store.vacuum()

    def _write_profile(self, df: DataFrame, batch_id: int) -> None:
        flows = op.complete_flows(df)
        time_col = "event_time"
        if self.segment_time == "processing":
            flows, time_col = flows.withColumn("_processing_time", F.current_timestamp()), "_processing_time"
        edges = self._edges(flows, time_col)
        past = self._past_edges(batch_id)
        if past is not None:
            edges = op.dedupe_edges(edges.unionByName(past))
        # the batch's edges are used by up to three writes and a probe: compute them once
        edges = edges.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            replace = self._to_replace(batch_id)
            if self.flush_assets is not None:
                self.store.hold()
            present = self.store.write_batch(edges, batch_id, replace_models=replace, only_new=self.only_new_edges,
                                             spans=self._scope.dimensions)
            if done := replace & present:
                self.store.record_modes({m: False for m in done}, batch_id)
                self._applied.update({m: False for m in done})
            if self.flush_assets is not None:
                self.store.flush(batch_id, self.flush_assets, self.flush_s)
            if self.memory is not None:
                self.memory.write(flows, batch_id, time_col)
            if self.counts is not None:
                timed = flows if time_col == "event_time" else flows.withColumn("event_time", F.col(time_col))
                self.counts.write_batch(op.multiset_counts(timed, self._scope.params, self.side, self.tz), batch_id)
            self._report(present - self._succeeded, "success")
            self._succeeded |= present
        finally:
            edges.unpersist()

    def _edges(self, flows: DataFrame, time_col: str = "event_time") -> DataFrame:
        """The edges of flows with the scope in use."""
        scope = self._scope
        if self.matcher == "id":
            return op.profile_edges(flows, scope.scoped, side=self.side, host=self.host, tz=self.tz,
                                    time_col=time_col, spans=scope.spans, fits=scope.fits, **self.join_opts)
        timed = flows if time_col == "event_time" else flows.withColumn("event_time", F.col(time_col))
        return op.match_edges(op.touch_pairs(timed, scope.index, fits=scope.fits, **self.join_opts), self.tz)

    def _past_edges(self, batch_id: int) -> DataFrame | None:
        """Edges of past flows with what is new in the scope since the batch before; None where there is nothing."""
        if self.memory is None or self._before in (None, self._scope.version):
            return None
        past = self.memory.before(batch_id)
        if past is None:
            return None
        old = self.scopes.load(self._before, self._schemas.get(self._before))
        fits = self._scope.fits or None  # a part of a scope that fits does too
        if self.matcher == "id":
            new = op.scope_delta(old["assets"], self._scope.scoped, ["model_id", "entity_id", "span"])
            return op.profile_edges(past, new, side=self.side, host=self.host, tz=self.tz, spans=self._scope.spans,
                                    fits=fits, **self.join_opts)
        new = op.scope_delta(old["index"], self._scope.index, ["model_id", "area_id", "entity_id", "ip", "span"])
        return op.match_edges(op.touch_pairs(past, new, owners=self._scope.index, fits=fits, owners_fit=self._scope.fits,
                                             **self.join_opts), self.tz)

    def _to_replace(self, batch_id: int) -> set[str]:
        """Models that turned from accumulate to replace and have not been replaced since.

        A model met for the first time, or turned to accumulate, only has its mode recorded.
        """
        if not self.honour_update_mode:
            return set()
        if self._applied is None:
            self._applied = self.store.applied_modes()
        turned = {m for m, acc in self._scope.modes.items() if not acc and self._applied.get(m)}
        learned = {m: acc for m, acc in self._scope.modes.items() if m not in turned and self._applied.get(m) != acc}
        if learned:
            self.store.record_modes(learned, batch_id)
            self._applied.update(learned)
        return turned

    def close(self) -> None:
        """Release the cached static-side snapshot (call after the query has stopped)."""
        if self._scope is not None:
            self._scope.unpersist()
        self._scope = None

    def start(self, flows_stream: DataFrame, checkpoint: str, trigger: dict | None = None,
              query_name: str | None = None):
        if self.status is not None:
            self._refresh()
            self._report(self._models(), "running")
        w = flows_stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        if query_name:
            w = w.queryName(query_name)
        if trigger:
            w = w.trigger(**trigger)
        return w.start()

    def await_end(self, query) -> None:
        """Wait for the query; report ``stop`` for every model if it failed, also outside a micro-batch, and raise."""
        try:
            query.awaitTermination()
        except Exception:
            self._report(self._models(), "stop")
            raise
        finally:
            self.close()


def start_profile_stream(spark: SparkSession, flows_stream: DataFrame, scope_loader: ScopeLoader,
                         store: EdgeStore, checkpoint: str, trigger: dict | None = None, **kw):
    """Start the profile job; returns the StreamingQuery."""
    return ProfileStream(spark, scope_loader, store, **kw).start(flows_stream, checkpoint, trigger)


def run_profile_stream_on_files(spark: SparkSession, sf_dir: str, root: str | None = None) -> DataFrame:
    """The live path over Kafka-shaped files: the first topic partition is read, the query ends, the others arrive, and
    a new query goes on from the checkpoint, re-reading its static side before each of its batches. Records are
    parsed, bad ones quarantined. Returns the rendered profile read back from the edge store, with the number of
    quarantined records."""
    from ..plans.queries import Inputs
    from ..sources import fixtures as fx
    from ..sources.files import read_kafka_files
    from ..sources.kafka import kafka_envelope

    root = root or scratch_path(spark, f"profile_stream/{uuid.uuid4().hex}")
    store = EdgeStore(spark, f"{root}/store").init()
    status = StatusLog(spark, f"{root}/status").init()
    records, topic = Inputs(spark, sf_dir).kafka, f"{root}/topic"

    def scope_loader():
        fresh = Inputs(spark, sf_dir)
        return fresh.runnable, fresh.scoped("contains"), op.failed_params(fresh.params, as_of=fx.AS_OF)

    for arrived, ttl_s in ((F.col("partition") == 0, 3600.0), (F.col("partition") > 0, 0.0)):
        records.where(arrived).write.mode("append").partitionBy("partition").parquet(topic)
        files = len(spark.read.parquet(topic).inputFiles())
        job = ProfileStream(spark, scope_loader, store, status=status, prepare=kafka_envelope, parse=True,
                            quarantine_path=f"{root}/quarantine", ttl_s=ttl_s)
        stream = read_kafka_files(spark, topic, streaming=True, max_files_per_trigger=-(-files // 3))
        job.await_end(job.start(stream, f"{root}/checkpoint", trigger={"availableNow": True}))
    bad = spark.read.parquet(f"{root}/quarantine").count()
    return op.named_csv_rows(store.read_edges()).withColumn("n_quarantined", F.lit(bad).cast("long"))


def edge_stream(flows_stream: DataFrame, scoped: DataFrame, side: str = "src", host: str = "own",
                tz: str | None = None, once_within: str | None = None) -> DataFrame:
    """H3 (append form): a streaming DataFrame of edges, however late their flows come.

    Flows are matched with the static (model, asset) table (stream-static join, no join state). Nothing is held
    back or dropped by event time: an edge seen again is appended again, and the read view of
    the edge table (``dedupe_edges``) makes it a set, as for every other writer.

    With ``once_within`` ("1 hour") an edge that comes again within that time of its arrival is not appended (H1). The watermark
    runs on the time of arrival, which no row is late for, so late flows still count; the state holds the edges of that
    time only. An edge's ``updated_at`` may then stay behind by as much.
    """
    from ..functions.segments import key_for_span

    id_col, ip_col = op.host_columns(side, host)
    models = scoped.select("model_id", "span", F.col("entity_id").alias("_eid"))
    f = op.complete_flows(flows_stream).where(F.col(ip_col).isNotNull())
    j = f.join(op.bounded_broadcast(models), f[id_col] == F.col("_eid"), "inner")
    seg = segment_candidates("event_time", tz)
    e = j.select("model_id", "span", F.col("_eid").alias("entity_id"), F.col(ip_col).alias("host_ip"),
                 "event_time", *seg)
    edges = e.select("model_id", "entity_id", key_for_span("span").cast("int").alias("segment_key"), "host_ip",
                     F.col("event_time").alias("updated_at"))
    if once_within is None:
        return edges
    arrived = edges.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", once_within)
    return arrived.dropDuplicatesWithinWatermark(EDGE_KEY).drop("_arrived")


def start_edge_file_stream(edges: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Append the edge stream to parquet (file sink + checkpoint = exactly once)."""
    w = (edges.writeStream.format("parquet").outputMode("append").option("path", path)
         .option("checkpointLocation", checkpoint).partitionBy("model_id"))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
