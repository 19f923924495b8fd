"""Replayed batches, pinned scopes, changed dimensions, late assets and counts that accumulate."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from assetlens import operators as op
from assetlens.plans.queries import Inputs
from assetlens.sinks import CountStore, EdgeStore, FlowMemory, ScopeLog, representative_flows
from assetlens.sources import fixtures as fx
from assetlens.streaming import ProfileStream

from sf_dirs import SF001

T0 = dt.datetime(2024, 1, 1)


def edges(spark, rows, t=T0):
    return spark.createDataFrame([(m, e, k, ip, t) for m, e, k, ip in rows],
                                 "model_id string, entity_id string, segment_key int, host_ip string, updated_at timestamp")


def keyset(df):
    return sorted((r.model_id, r.entity_id, r.segment_key, r.host_ip) for r in df.collect())


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# ---------------------------------------------------------------- the manifest
OLD, A, B = ("m1", "a", 1, "old"), ("m1", "a", 2, "x"), ("m2", "a", 1, "y")


@pytest.mark.parametrize("exclusive", [False, True])
def test_a_replay_replaces_the_whole_attempt(spark, tmp_dir, exclusive):
    st = EdgeStore(spark, f"{tmp_dir}/store").init()
    st.exclusive = exclusive
    st.write_batch(edges(spark, [OLD]), 4)
    st.write_batch(edges(spark, [A, B]), 5)
    assert keyset(st.read_edges()) == sorted([OLD, A, B])
    st.write_batch(edges(spark, [A]), 5)              # fewer models
    assert keyset(st.read_edges()) == sorted([OLD, A])
    st.write_batch(edges(spark, []), 5)               # nothing at all
    assert keyset(st.read_edges()) == [OLD]
    st.write_batch(edges(spark, [B]), 5)
    assert keyset(st.read_edges()) == sorted([OLD, B])
    st.compact()
    st.vacuum(keep=0)
    assert keyset(st.read_edges()) == sorted([OLD, B])
    st.write_batch(edges(spark, [A]), 6)
    assert keyset(EdgeStore(spark, f"{tmp_dir}/store").read_edges()) == sorted([OLD, A, B])


def test_an_attempt_that_died_leaves_nothing_visible(spark, tmp_dir):
    st = EdgeStore(spark, f"{tmp_dir}/store").init()
    st.write_batch(edges(spark, [OLD]), 0)
    st._write(edges(spark, [A, B]), {"m1": 0, "m2": 0}, 1)    # files of both models, then the job died
    assert keyset(st.read_edges()) == [OLD]
    st.write_batch(edges(spark, [A]), 1)                      # the retry has one model only
    assert keyset(st.read_edges()) == sorted([OLD, A])
    st._write(edges(spark, [B]), {"m2": 0}, 1, attempt=1)     # and so did a replay of it
    assert keyset(st.read_edges()) == sorted([OLD, A])
    st.vacuum()
    folders = [d for d, _, names in os.walk(f"{tmp_dir}/store/edges") if any(n.startswith("part-") for n in names)]
    assert len(folders) == 2 and keyset(st.read_edges()) == sorted([OLD, A])


def test_a_replaced_profile_comes_back_if_the_replay_has_none(spark, tmp_dir):
    st = EdgeStore(spark, f"{tmp_dir}/store").init()
    st.write_batch(edges(spark, [OLD, B]), 0)
    st.write_batch(edges(spark, [A]), 1, replace_models=["m1"])
    assert keyset(st.read_edges()) == sorted([A, B])
    st.write_batch(edges(spark, []), 1, replace_models=["m1"])
    assert keyset(st.read_edges()) == sorted([OLD, B])
    st.write_batch(edges(spark, [A]), 1, replace_models=["m1"])
    assert keyset(st.read_edges()) == sorted([A, B])
    assert {r.model_id: r.gen for r in st.generations().collect()} == {"m1": 1, "m2": 0}


# ---------------------------------------------------------------- dimensions
def test_a_changed_span_begins_a_new_profile(spark, tmp_dir):
    st = EdgeStore(spark, f"{tmp_dir}/store").init()
    st.write_batch(edges(spark, [("m1", "a", 23, "x"), ("m2", "a", 5, "x")]), 0, spans={"m1": 1, "m2": 2})
    st.write_batch(edges(spark, [("m1", "a", 22, "x")]), 1, spans={"m1": 1, "m2": 2})
    again = EdgeStore(spark, f"{tmp_dir}/store")      # kept over a restart
    again.write_batch(edges(spark, [("m1", "a", 7, "x"), ("m2", "a", 6, "x")]), 2, spans={"m1": 2, "m2": 2})
    want = [("m1", "a", 7, "x"), ("m2", "a", 5, "x"), ("m2", "a", 6, "x")]
    assert keyset(again.read_edges()) == want
    again.write_batch(edges(spark, [("m1", "a", 7, "x"), ("m2", "a", 6, "x")]), 2, spans={"m1": 2, "m2": 2})  # replay
    again.compact()
    again.vacuum()
    again.write_batch(edges(spark, [("m1", "a", 1, "x")]), 3, spans={"m1": 2})
    assert keyset(again.read_edges()) == sorted([*want, ("m1", "a", 1, "x")])
    assert {r.model_id: r.span for r in again.dimensions().collect()} == {"m1": 2, "m2": 2}
    again.write_batch(edges(spark, [("m1", "a", 0, "x")]), 4, spans={"m1": 1})  # and back to hours
    assert keyset(again.read_model("m1")) == [("m1", "a", 0, "x")]


def test_a_dimension_that_was_unknown_is_learned(spark, tmp_dir):
    st = EdgeStore(spark, f"{tmp_dir}/store").init()
    st.write_batch(edges(spark, [("m1", "a", 23, "x")]), 0)
    st.write_batch(edges(spark, [("m1", "a", 22, "x")]), 1, spans={"m1": 1})
    assert len(keyset(st.read_edges())) == 2
    st.write_batch(edges(spark, [("m1", "a", 7, "x")]), 2, spans={"m1": 2}, only_new=True)
    assert keyset(st.read_edges()) == [("m1", "a", 7, "x")]


# ---------------------------------------------------------------- buckets and tiers
def test_only_new_reads_the_buckets_of_the_batch(spark, tmp_dir):
    st = EdgeStore(spark, f"{tmp_dir}/store", buckets=16).init()
    st.write_batch(edges(spark, [(m, f"a{i}", 1, "x") for m in ("m1", "m2") for i in range(200)]), 0)
    everything = len(st.raw_edges().inputFiles())
    asked, real = [], st.stored_except

    def stored_except(*args):
        asked.append(real(*args))
        return asked[-1]

    st.stored_except = stored_except
    st.write_batch(edges(spark, [("m1", "a7", 1, "x"), ("m1", "a7", 1, "y")]), 1, only_new=True)
    read = asked[0]._jdf.queryExecution().executedPlan().toString()
    assert "bucket#" in read and "PartitionFilters" in read
    assert st.raw_edges().where("batch_id = 1").count() == 1
    files = [f for f in asked[0].inputFiles() if "model_id=m1" in f and f"bucket={spark.range(1).select(st.bucket(F.lit('a7'))).first()[0]}/" in f]
    assert len(files) == 1 and everything >= 32 and asked[0].count() < 60
    assert keyset(st.read_asset("m1", "a7")) == [("m1", "a7", 1, "x"), ("m1", "a7", 1, "y")]


def test_tiers_of_batches_are_folded(spark, tmp_dir):
    st = EdgeStore(spark, f"{tmp_dir}/store", buckets=2).init()
    st.exclusive = True
    live = lambda: {(r.model_id, r.batch_id) for r in st.current_folders().collect()}
    for b in range(7):
        st.write_batch(edges(spark, [("m1", "a", b, "x"), ("m1", "b", 1, "y"), ("m2", "a", b % 2, "z")]), b, spans={"m1": 1, "m2": 1})
        st.fold(b, tier=2)
    want = sorted([("m1", "a", b, "x") for b in range(7)] + [("m1", "b", 1, "y"), ("m2", "a", 0, "z"), ("m2", "a", 1, "z")])
    assert keyset(st.read_edges()) == want
    assert len(live()) <= 2 * 5 and (("m1", 6) in live())
    assert st.raw_edges().where("entity_id = 'b'").count() < 7      # repeated rows are gone
    st.write_batch(edges(spark, [("m1", "a", 6, "x"), ("m1", "a", 20, "x")]), 6, spans={"m1": 1, "m2": 1})  # the last one again
    want = sorted([*want, ("m1", "a", 20, "x")])
    assert keyset(st.read_edges()) == want
    again = EdgeStore(spark, f"{tmp_dir}/store", buckets=2)
    again.write_batch(edges(spark, [("m1", "a", 3, "new")]), 7, replace_models=["m1"])
    again.fold(8, tier=2)
    again.vacuum()
    assert keyset(again.read_edges()) == [("m1", "a", 3, "new"), ("m2", "a", 0, "z"), ("m2", "a", 1, "z")]
    with pytest.raises(ValueError):
        st.fold(8, tier=1)


def test_the_job_folds(spark, tmp_dir):
    inp = Inputs(spark, SF001)
    job = ProfileStream(spark, lambda: (inp.runnable, inp.scoped()), EdgeStore(spark, f"{tmp_dir}/store", 4).init(),
                        only_new_edges=True, fold_tier=2)
    for b in range(4):
        job.process(inp.complete.where(f"cast(flow_id as long) % 4 = {b}"), b)
    assert keyset(job.store.read_edges()) == keyset(inp.src_edges)
    assert len({r.batch_id for r in job.store.current_folders().collect()}) < 4


def test_buckets_of_a_dead_attempt_are_not_taken_over(spark, tmp_dir):
    st = EdgeStore(spark, f"{tmp_dir}/store", buckets=8).init()
    many = edges(spark, [("m1", f"a{i}", 1, "x") for i in range(30)])
    st._write(many, {"m1": 0}, 0)                     # died before it was recorded
    st.write_batch(edges(spark, [("m1", "a3", 1, "x")]), 0)
    assert keyset(st.read_edges()) == [("m1", "a3", 1, "x")]


# ---------------------------------------------------------------- pinned scopes
def test_versions_and_pins(spark, tmp_dir):
    log = ScopeLog(spark, f"{tmp_dir}/scopes")
    table = lambda n: {"assets": spark.range(n).selectExpr("id", "cast(null as string) as x")}
    one = log.save(table(3))
    assert log.save({"assets": table(3)["assets"].repartition(3)}) == one and log.save(table(4)) != one
    assert log.pinned(0) is None
    assert log.pin(0, one) == (one, None) == log.pinned(0)
    two = log.save(table(4))
    assert log.pin(1, two) == (two, one) == ScopeLog(spark, f"{tmp_dir}/scopes").pinned(1)
    assert log.pin(2, two) == (two, two)
    assert log.pin(3, two) == (two, two)              # version one is in no pin any more
    assert os.listdir(f"{tmp_dir}/scopes/tables") == [f"v={two}"]
    assert sorted(n for n in os.listdir(f"{tmp_dir}/scopes/pins") if n.isdigit()) == ["2", "3"]
    assert log.load(two)["assets"].count() == 4


def _inventory(spark, state):
    inp = Inputs(spark, SF001)
    return inp, lambda: (inp.runnable, op.scope_assets(inp.assets.where(state["assets"]), inp.runnable))


def test_a_restarted_batch_uses_the_scope_it_began_with(spark, tmp_dir):
    state = {"assets": "true"}
    inp, loader = _inventory(spark, state)
    flows = inp.complete
    half = flows.where("cast(flow_id as long) % 2 = 0")
    store = EdgeStore(spark, f"{tmp_dir}/store").init()
    ProfileStream(spark, loader, store, ttl_s=0).process(half, 0)
    state["assets"] = "area_id = 0"
    job = ProfileStream(spark, loader, EdgeStore(spark, f"{tmp_dir}/store"), ttl_s=0)
    job.process(half, 0)                              # begun before: the whole inventory
    whole = keyset(op.profile_edges(half, inp.scoped()))
    assert keyset(job.store.read_edges()) == whole
    job.process(flows, 1)                             # a new one: what there is now
    assert keyset(job.store.read_edges()) == sorted(set(whole) | set(keyset(op.profile_edges(flows, inp.scoped().where("area_id = 0")))))


# ---------------------------------------------------------------- late assets
def flow(i, src_id, src_ip, t, dst_ip="9.9.9.9", area=1):
    return (src_id, src_ip, "d", dst_ip, area, str(i), 0, t)


FLOW = "src_id string, src_ip string, dst_id string, dst_ip string, area_id int, flow_id string, r_time long, event_time timestamp"


def test_representatives_make_the_edges_of_all_flows(spark):
    inp = Inputs(spark, SF001)
    few = representative_flows(inp.complete, ["src_id", "src_ip"])
    assert keyset(op.profile_edges(few, inp.scoped())) == keyset(inp.src_edges)
    for span in (1, 2, 3, 4):                         # whatever span a later model has
        scope = inp.scoped().withColumn("span", F.lit(span))
        assert keyset(op.profile_edges(few, scope)) == keyset(op.profile_edges(inp.complete, scope))


def test_memory_folds_forgets_and_survives_replays(spark, tmp_dir):
    days = [dt.datetime(2024, 1, d, 12) for d in (1, 5, 9, 10)]
    part = lambda ts: spark.createDataFrame([flow(i, "s", f"10.0.0.{t.day}", t) for i, t in enumerate(ts)], FLOW)
    ips = lambda df: sorted({r.src_ip for r in df.collect()})
    for keep in (None, dt.timedelta(days=6)):
        mem = FlowMemory(spark, f"{tmp_dir}/m{keep is None}", ["src_id", "src_ip"], retention=keep, fold_every=2)
        assert mem.before(0) is None
        for b, t in enumerate(days):
            mem.write(part([t, t]), b)
        mem.write(part([days[3]]), 3)                 # replayed
        mem.write(part([]), 2)                        # replayed with nothing
        want = ["10.0.0.1", "10.0.0.5", "10.0.0.10"] if keep is None else ["10.0.0.5", "10.0.0.10"]
        assert ips(mem.before(9)) == sorted(want)
        assert "10.0.0.10" not in ips(mem.before(3))
        assert [n for n in os.listdir(f"{mem.root}/folded")] != []


@pytest.mark.parametrize("matcher,mode", [("id", "contains"), ("touch", "exact")])
def test_late_assets_are_matched_once_and_only_they(spark, tmp_dir, monkeypatch, matcher, mode):
    inp = Inputs(spark, SF001)
    state = {"thirds": 1}

    def loader():
        known = inp.assets.where(F.pmod(F.xxhash64("entity_id"), F.lit(3)) < state["thirds"])
        return inp.runnable, op.scope_assets(known, inp.runnable, mode)

    met = []
    real = op.scope_delta
    monkeypatch.setattr(op, "scope_delta", lambda old, new, keys: met.append((old.count(), new.count(), real(old, new, keys).count())) or real(old, new, keys))
    memory = FlowMemory(spark, f"{tmp_dir}/flows", ProfileStream.memory_columns(matcher))
    job = ProfileStream(spark, loader, EdgeStore(spark, f"{tmp_dir}/store").init(), ttl_s=0, matcher=matcher, memory=memory)
    for b in range(4):
        state["thirds"] = min(b + 1, 3)
        job.process(inp.complete.where(f"cast(flow_id as long) % 4 = {b}"), b)
    if matcher == "id":
        want = op.profile_edges(inp.complete, inp.scoped(mode))
    else:
        want = op.match_edges(op.touch_pairs(inp.complete, op.ip_index(inp.scoped(mode))))
    assert keyset(job.store.read_edges()) == keyset(want)
    # two refreshes brought something, and only what they brought was met with past flows; the last one changed nothing
    assert len(met) == 2 and all(delta == new - old > 0 for old, new, delta in met)
    # run again, after a restart, the second last batch finds the same
    again = ProfileStream(spark, loader, EdgeStore(spark, f"{tmp_dir}/store"), ttl_s=0, matcher=matcher, memory=memory)
    again.process(inp.complete.where("cast(flow_id as long) % 4 = 3"), 3)
    assert keyset(again.store.read_edges()) == keyset(want)


def test_an_asset_that_owns_the_source_matches_by_it_alone(spark):
    """A new destination address of a known asset does not match flows that come from the asset itself."""
    flows = spark.createDataFrame([flow(1, "s", "10.0.0.1", T0, "10.0.0.2"), flow(2, "s", "10.0.0.3", T0, "10.0.0.2")], FLOW)
    index = spark.createDataFrame([("m", 1, True, "a", 1, "10.0.0.1"), ("m", 1, True, "a", 1, "10.0.0.2")],
                                  "model_id string, span int, accumulate boolean, entity_id string, area_id int, ip string")
    delta = op.scope_delta(index.limit(1), index, ["model_id", "area_id", "entity_id", "ip", "span"])
    assert [r.ip for r in delta.collect()] == ["10.0.0.2"]
    got = op.touch_pairs(flows, delta, owners=index).collect()
    assert [(r.flow_id, r.ip, r.side) for r in got] == [("2", "10.0.0.2", "dst")]


def test_delta_of_rows_with_nulls(spark):
    old = spark.createDataFrame([("m", None, 1), ("m", "a", None)], "model_id string, entity_id string, span int")
    new = spark.createDataFrame([("m", None, 1), ("m", "a", None), ("m", "a", 1), ("n", None, 1)], old.schema)
    assert rows(op.scope_delta(old, new, ["model_id", "entity_id", "span"])) == [("m", "a", 1), ("n", None, 1)]


def test_a_changed_dimension_covers_the_past_where_flows_are_kept(spark, tmp_dir):
    inp = Inputs(spark, SF001)
    later = op.runnable_params(op.active_params(inp.next_params, as_of=fx.AS_OF))
    state = {"params": inp.runnable}
    loader = lambda: (state["params"], op.scope_assets(inp.assets, state["params"]))
    memory = FlowMemory(spark, f"{tmp_dir}/flows", ProfileStream.memory_columns())
    job = ProfileStream(spark, loader, EdgeStore(spark, f"{tmp_dir}/store").init(), ttl_s=0, memory=memory)
    half = lambda i: inp.complete.where(f"cast(flow_id as long) % 2 = {i}")
    job.process(half(0), 0)
    state["params"] = later
    job.process(half(1), 1)
    want = keyset(op.profile_edges(inp.complete, op.scope_assets(inp.assets, later)))
    models = {r.model_id for r in later.collect()}
    assert [k for k in keyset(job.store.read_edges()) if k[0] in models] == want


# ---------------------------------------------------------------- counts
def test_counts_accumulate_in_tiers(spark, tmp_dir):
    one = lambda n, ip="x": spark.createDataFrame([("m", "a", 1, ip, n)], "model_id string, entity_id string, segment_key int, host_ip string, n long")
    st = CountStore(spark, f"{tmp_dir}/counts", tier=2)
    assert st.read_counts().collect() == []
    for b in range(7):
        st.write_batch(one(1 << b), b)
        st.write_batch(one(1 << b), b)                # run again
        assert st.read_counts().first().n == (2 << b) - 1
    assert len(st._folders()) <= 3 and max(f[0] for f in st._folders()) >= 2
    # a fold that died before its sources were removed counts nothing twice
    import shutil
    before = st.read_counts().first().n
    top = max(st._folders())
    shutil.copytree(st._path(*top), st._path(0, top[1], top[1]))
    assert st.read_counts().first().n == before
    # and one that died while it wrote is not there
    os.makedirs(st._path(7, 0, 99))
    assert st.read_counts().first().n == before
    st.write_batch(one(5, "y"), 7)
    assert {r.host_ip: r.n for r in st.read_counts().collect()} == {"x": before, "y": 5}
    with pytest.raises(ValueError):
        CountStore(spark, tmp_dir, tier=1)


def test_counts_of_the_job(spark, tmp_dir):
    inp = Inputs(spark, SF001)
    counts = CountStore(spark, f"{tmp_dir}/counts")
    job = ProfileStream(spark, lambda: (inp.runnable, inp.scoped()), EdgeStore(spark, f"{tmp_dir}/store").init(), counts=counts)
    for b in (0, 1, 1, 2):
        job.process(inp.complete.where(f"cast(flow_id as long) % 3 = {b}"), b)
    assert rows(counts.read_counts()) == rows(op.multiset_counts(inp.complete, inp.runnable).withColumn(
        "segment_key", F.col("segment_key").cast("int")))


# ---------------------------------------------------------------- flush by number or time, and bounded state
def test_batches_are_shown_by_number_of_assets_or_by_time(spark, tmp_dir):
    st = EdgeStore(spark, f"{tmp_dir}/store").init()
    st.write_batch(edges(spark, [("m1", "z", 1, "x")]), 0)
    st.hold()
    seen = lambda: sorted({k[1] for k in keyset(EdgeStore(spark, st.root).read_edges())})
    for b, asset in enumerate("abca", 1):
        st.write_batch(edges(spark, [("m1", asset, 1, "x"), ("m2", asset, 1, "x")]), b)
        flushed = st.flush(b, assets=2, seconds=3600)
        assert (flushed, seen()) == ((True, ["a", "b", "c", "z"]) if b == 3 else (False, ["a", "b", "c", "z"] if b > 3 else ["z"]))
    st.write_batch(edges(spark, [("m1", "q", 1, "x")]), 4, replace_models=["m1"])  # run again, now as a replacement
    again = EdgeStore(spark, st.root)                 # after a restart what waits is still there
    assert seen() == ["a", "b", "c", "z"] and again.flush(4, assets=100, seconds=0.0)
    assert keyset(again.read_edges()) == sorted([("m1", "q", 1, "x"), *(("m2", a, 1, "x") for a in "abc")])


def test_the_job_holds_batches_back(spark, tmp_dir):
    inp = Inputs(spark, SF001)
    job = ProfileStream(spark, lambda: (inp.runnable, inp.scoped()), EdgeStore(spark, f"{tmp_dir}/store").init(), flush_assets=10**6)
    for b in range(2):
        job.process(inp.complete.where(f"cast(flow_id as long) % 2 = {b}"), b)
    assert keyset(job.store.read_edges()) == []
    job.flush_s = 0
    job.process(inp.complete.where("cast(flow_id as long) % 2 = 1"), 1)
    assert keyset(job.store.read_edges()) == keyset(inp.src_edges)


def test_repeated_edges_are_appended_once_within_the_time(spark, tmp_dir):
    from assetlens.streaming import edge_stream, start_edge_file_stream

    inp = Inputs(spark, SF001)
    flows = inp.complete.unionAll(inp.complete)
    for i in range(3):                                # the last part holds the oldest flows: late by their own time
        flows.where(f"cast(flow_id as long) % 3 = {i}").orderBy(F.desc("event_time")).coalesce(1).write.parquet(f"{tmp_dir}/in/p{i}")
    counts = {}
    for within in (None, "1 hour"):
        stream = spark.readStream.schema(flows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_dir}/in")
        out = f"{tmp_dir}/out-{within is None}"
        q = start_edge_file_stream(edge_stream(stream, inp.scoped(), once_within=within), out, f"{tmp_dir}/ck-{within is None}", {"availableNow": True})
        q.awaitTermination()
        got = spark.read.parquet(out)
        counts[within] = got.count()
        assert keyset(op.dedupe_edges(got)) == keyset(inp.src_edges)
        state = q.lastProgress["stateOperators"]
        assert (state == []) if within is None else state[0]["numRowsTotal"] == counts[within]
    assert counts["1 hour"] == len(keyset(inp.src_edges)) < counts[None]
