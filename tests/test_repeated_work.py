"""What a batch needs more than once is computed once."""

import datetime as dt

from assetlens.operators import match
from assetlens.sinks import EdgeStore, FlowMemory
from assetlens.streaming import ProfileStream

DAY = dt.datetime(2024, 1, 1, 10)
FLOW = "src_id string, src_ip string, dst_id string, dst_ip string, area_id int, flow_id string, r_time long, event_time timestamp"


def flow(spark, *ips):
    return spark.createDataFrame([("a", s, "b", d, 0, str(i), 0, DAY) for i, (s, d) in enumerate(ips)], FLOW)


def test_index_kept_for_its_snapshot_and_sized_once_a_version(spark, tmp_dir, monkeypatch):
    params = spark.createDataFrame([("m", 1, True)], "model_id string, span int, accumulate boolean")
    known = ["a"]

    def loader():
        rows = [("m", 1, True, e, e, '{"00:00":["%s"]}' % ip, 0) for e, ip in (("a", "1.1.1.1"), ("b", "2.2.2.2")) if e in known]
        return params, spark.createDataFrame(rows, "model_id string, span int, accumulate boolean, entity_id string, entity_name string, asset_ip string, area_id int")

    memory = FlowMemory(spark, f"{tmp_dir}/flows", ProfileStream.memory_columns("touch"))
    store = EdgeStore(spark, f"{tmp_dir}/store").init()
    job = ProfileStream(spark, loader, store, ttl_s=0.0, matcher="touch", memory=memory)
    kept, sized = [], []
    save, fits = job.scopes.save, match.fits_broadcast
    monkeypatch.setattr(job.scopes, "save", lambda tables: (kept.append(tables["index"].storageLevel.useMemory), save(tables))[1])
    monkeypatch.setattr(match, "fits_broadcast", lambda *a, **k: (sized.append(1), fits(*a, **k))[1])
    job.process(flow(spark, ("1.1.1.1", "9.9.9.9"), ("8.8.8.8", "2.2.2.2")), 0)
    known.append("b")
    job.process(flow(spark, ("7.7.7.7", "1.1.1.1")), 1)
    job.close()
    assert kept == [True, True] and len(sized) == 2
    edges = {(r.entity_id, r.host_ip) for r in store.read_edges().collect()}
    assert edges == {("a", "1.1.1.1"), ("b", "2.2.2.2")}


def test_scope_in_use_keeps_what_edges_need(spark, tmp_dir):
    params = spark.createDataFrame([("m", 1, True)], "model_id string, span int, accumulate boolean")
    scoped = spark.createDataFrame([("m", 1, "a", "long name")], "model_id string, span int, entity_id string, entity_name string")
    job = ProfileStream(spark, lambda: (params, scoped), EdgeStore(spark, f"{tmp_dir}/store").init())
    job.process(flow(spark, ("1.1.1.1", "9.9.9.9")), 0)
    assert set(job._scope.scoped.columns) == {"model_id", "entity_id", "span"}
    assert "entity_name" in job.scopes.load(job._scope.version)["assets"].columns
    job.close()
