"""The profile application: options -> sources -> streaming profile job -> edge store + status log.

Run as ``python -m assetlens.app [--config job.properties] key=value ...``. Keys:

  flows.format      kafka | kafka-files | json-files        (default kafka)
  flows.path        folder for the file formats
  flows.max.files   files per micro-batch for the file formats (the poll cap of the file sources)
  kafka.*, topic, bootstrap.servers, group.id, max.poll.records   Kafka client settings (A1, A10)
  assets.url / assets.table, params.url / params.table     JDBC inventory and parameters; <name>.jdbc.<option>
                    passes reader options on (driver, user, and partitionColumn, lowerBound, upperBound,
                    numPartitions for a read in parts), or
  assets.path / params.path                                parquet folders with the same columns
  groups.mode       contains | exact                       (default contains)
  child.type        model child type                       (default 1)
  store.path        edge store root (default: <spark.checkpoint.dir>/assetlens/store; outside local mode one of
                    the two must be set, as for the checkpoint)
  checkpoint        streaming checkpoint (default: <spark.checkpoint.dir>/assetlens/checkpoint)
  trigger           processing-time interval, e.g. "1 minute"; "once" = availableNow; "model" = the
                    shortest model rate (F8) among the runnable models
  refresh.seconds   TTL of the static side (default 3600)
  update.mode       honour | accumulate                    (default accumulate, as the live job)
  zone              zone of the segment keys               (default: session zone)
  broadcast.rows    largest (model, asset) table to broadcast (default 1000000)
  salt.buckets      salt for hot assets when the asset side is shuffled (default 1 = off)
  segment.time      event | processing: segment keys from event time or the wall clock (default event)
  only.new.edges    true: write only edges not stored yet (anti join with the profile; default false)
  matcher           id | touch: profile by the source asset id, or by area and IP (default id)
  late.assets       true: flows also match assets (and models) that come after them (default false)
  late.days         days that past flows are kept for that (default: for ever)
  counts.path       also accumulate the flows per edge in a store at this path (default: none)
  store.buckets     hash buckets of the asset id in the edge store (default 1); only.new.edges reads a batch's buckets only
  fold.tier         put every so many older batches together, level by level (default 0 = never)
  flush.assets      show batches to readers only when more than so many assets wait (default: each batch at once), or
  flush.seconds     after this time since the last flush (default 3600)
  compact.every     rewrite the profile as one generation every N batches, and remove older ones
                    (default 100; 0 = never)
"""

from __future__ import annotations

import datetime as dt
import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import operators as op
from .session import get_session, scratch_path
from .sinks import CountStore, EdgeStore, FlowMemory, StatusLog
from .sources import jdbc, load_options, read_kafka, read_flow_files, read_kafka_files
from .sources.kafka import kafka_envelope
from .streaming import ProfileStream


def jdbc_extra(opts: dict[str, str], name: str) -> dict[str, str]:
    """Reader options given as ``<name>.jdbc.<option>=value`` (driver, user, fetchsize, ...)."""
    prefix = f"{name}.jdbc."
    return {k[len(prefix):]: v for k, v in opts.items() if k.startswith(prefix)}


def _table(spark: SparkSession, opts: dict[str, str], name: str) -> DataFrame:
    if opts.get(f"{name}.url"):
        read = {"params": jdbc.read_params_jdbc, "assets": jdbc.read_assets_jdbc}[name]
        return read(spark, opts[f"{name}.url"], opts.get(f"{name}.table", name), **jdbc_extra(opts, name))
    return spark.read.parquet(opts[f"{name}.path"])


def scope_loader(spark: SparkSession, opts: dict[str, str]):
    """Re-reads params and assets (called by the job whenever its TTL expires)."""
    def load():
        params = op.normalise_params(_table(spark, opts, "params"))
        child = int(opts.get("child.type", "1"))
        runnable = op.runnable_params(op.active_params(params, child_type=child))
        assets = _table(spark, opts, "assets")
        return (runnable, op.scope_assets(assets, runnable, opts.get("groups.mode", "contains")),
                op.failed_params(params, child))
    return load


def flow_source(spark: SparkSession, opts: dict[str, str]) -> DataFrame:
    fmt = opts.get("flows.format", "kafka")
    if fmt == "kafka":
        cap = opts.get("max.poll.records")
        client = {k: v for k, v in opts.items() if k in ("topic", "bootstrap.servers", "group.id")
                  or k.startswith("kafka.")}
        return kafka_envelope(read_kafka(spark, client, True, int(cap) if cap else None))
    max_files = int(opts["flows.max.files"]) if opts.get("flows.max.files") else None
    if fmt == "kafka-files":
        return kafka_envelope(read_kafka_files(spark, opts["flows.path"], streaming=True,
                                               max_files_per_trigger=max_files))
    if fmt == "json-files":
        return read_flow_files(spark, opts["flows.path"], streaming=True, max_files_per_trigger=max_files)
    raise ValueError(f"unknown flows.format {fmt}")


def resolve_trigger(spark: SparkSession, opts: dict[str, str]) -> dict:
    trig = opts.get("trigger", "1 minute")
    if trig == "once":
        return {"availableNow": True}
    if trig == "model":
        runnable, *_ = scope_loader(spark, opts)()
        secs = runnable.agg(F.min("rate_seconds")).first()[0]
        return {"processingTime": f"{int(secs) if secs else 60} seconds"}
    return {"processingTime": trig}


def build(spark: SparkSession, opts: dict[str, str]) -> tuple[ProfileStream, EdgeStore, StatusLog]:
    root = opts.get("store.path") or scratch_path(spark, "assetlens/store")
    store = EdgeStore(spark, root, int(opts.get("store.buckets", "1"))).init()
    status = StatusLog(spark, opts.get("status.path") or f"{root}_status").init()
    matcher, memory = opts.get("matcher", "id"), None
    if opts.get("late.assets", "false").lower() == "true":
        days = opts.get("late.days")
        memory = FlowMemory(spark, f"{root}_flows", ProfileStream.memory_columns(matcher), opts.get("zone"),
                            dt.timedelta(days=float(days)) if days else None)
    job = ProfileStream(spark, scope_loader(spark, opts), store, status=status, parse=True,
                        matcher=matcher, memory=memory,
                        counts=CountStore(spark, opts["counts.path"]) if opts.get("counts.path") else None,
                        quarantine_path=opts.get("quarantine.path") or f"{root}_quarantine",
                        tz=opts.get("zone"), ttl_s=float(opts.get("refresh.seconds", "3600")),
                        honour_update_mode=opts.get("update.mode", "accumulate") == "honour",
                        join_opts={"max_rows": int(opts.get("broadcast.rows", "1000000")),
                                   "salt_buckets": int(opts.get("salt.buckets", "1"))},
                        segment_time=opts.get("segment.time", "event"),
                        only_new_edges=opts.get("only.new.edges", "false").lower() == "true",
                        compact_every=int(opts.get("compact.every", "100")),
                        fold_tier=int(opts.get("fold.tier", "0")),
                        flush_assets=int(opts["flush.assets"]) if opts.get("flush.assets") else None,
                        flush_s=float(opts.get("flush.seconds", "3600")))
    return job, store, status


def start_job(spark: SparkSession, opts: dict[str, str], job: ProfileStream):
    trigger = resolve_trigger(spark, opts)
    checkpoint = opts.get("checkpoint") or scratch_path(spark, "assetlens/checkpoint")
    return job.start(flow_source(spark, opts), checkpoint, trigger, query_name="assetlens_profile")


def start(spark: SparkSession, opts: dict[str, str]):
    job, store, status = build(spark, opts)
    return start_job(spark, opts, job), store, status


def main(argv: list[str] | None = None) -> int:
    argv = list(sys.argv[1:] if argv is None else argv)
    config = None
    if "--config" in argv:
        i = argv.index("--config")
        config = argv[i + 1]
        del argv[i:i + 2]
    opts = load_options(config, argv)
    spark = get_session()
    job, _, _ = build(spark, opts)
    job.await_end(start_job(spark, opts, job))
    return 0


if __name__ == "__main__":
    sys.exit(main())
