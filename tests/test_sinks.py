"""Edge store idempotence, replace generations, status log, day files, JDBC (embedded Derby)."""

import datetime as dt
import uuid


from assetlens import operators as op
from assetlens.sinks import EdgeStore, StatusLog, write_day_files
from assetlens.sources import jdbc, load_options, kafka_reader_options

T0 = dt.datetime(2024, 1, 1)


def edges(spark, rows, t=T0):
    return spark.createDataFrame([(m, e, k, ip, t) for m, e, k, ip in rows],
                                 "model_id string, entity_id string, segment_key int, host_ip string, "
                                 "updated_at timestamp")


def keyset(df):
    return sorted((r.model_id, r.entity_id, r.segment_key, r.host_ip) for r in df.collect())


def test_accumulate_and_replay(spark, tmp_dir):
    st = EdgeStore(spark, f"{tmp_dir}/store").init()
    assert keyset(st.read_edges()) == []
    b0 = edges(spark, [("m1", "a", 1, "x"), ("m2", "a", 1, "y")])
    b1 = edges(spark, [("m1", "a", 1, "x"), ("m1", "a", 2, "z")])
    st.write_batch(b0, 0)
    st.write_batch(b1, 1)
    want = [("m1", "a", 1, "x"), ("m1", "a", 2, "z"), ("m2", "a", 1, "y")]
    assert keyset(st.read_edges()) == want
    st.write_batch(b1, 1)                       # replay of batch 1
    assert keyset(st.read_edges()) == want
    assert st.raw_edges().count() == 4          # the replay rewrote its folder, no extra rows
    assert keyset(st.read_model("m2")) == [("m2", "a", 1, "y")]


def test_replace_generation(spark, tmp_dir):
    st = EdgeStore(spark, f"{tmp_dir}/store").init()
    st.write_batch(edges(spark, [("m1", "a", 1, "x"), ("m2", "a", 1, "y")]), 0)
    rm = spark.createDataFrame([("m2",)], "model_id string")
    st.write_batch(edges(spark, [("m2", "b", 3, "q"), ("m1", "a", 5, "n")]), 1, replace_models=rm)
    want = [("m1", "a", 1, "x"), ("m1", "a", 5, "n"), ("m2", "b", 3, "q")]
    assert keyset(st.read_edges()) == want
    st.write_batch(edges(spark, [("m2", "b", 3, "q"), ("m1", "a", 5, "n")]), 1, replace_models=rm)  # replay
    assert keyset(st.read_edges()) == want
    assert {(r.model_id, r.gen) for r in st.generations().collect()} == {("m1", 0), ("m2", 1)}
    st.compact(batch_id=2)
    assert keyset(st.read_edges()) == want


def test_status_log(spark, tmp_dir):
    log = StatusLog(spark, f"{tmp_dir}/status").init()
    m = spark.createDataFrame([("m1",), ("m2",)], "model_id string")
    log.append(op.status_event(m, "running", T0), -1)
    log.append(op.status_event(m.where("model_id = 'm1'"), "success", T0 + dt.timedelta(1)), 0)
    log.append(op.status_event(m.where("model_id = 'm1'"), "success", T0 + dt.timedelta(1)), 0)  # replay
    assert {r.model_id: r.status for r in log.current().collect()} == {"m1": "success", "m2": "running"}
    assert log.events().count() == 3


def test_day_files(spark, tmp_dir):
    rows = [("f1", dt.datetime(2024, 1, 1, 15, 59)), ("f2", dt.datetime(2024, 1, 1, 16, 0))]
    df = spark.createDataFrame(rows, "flow_id string, event_time timestamp")
    write_day_files(df, f"{tmp_dir}/days")
    got = {r.flow_id: str(r.dt) for r in spark.read.parquet(f"{tmp_dir}/days").collect()}
    assert got == {"f1": "2024-01-01", "f2": "2024-01-02"}   # Asia/Shanghai = UTC+8
    many = spark.range(10).selectExpr("cast(id as string) as flow_id",
                                      "timestamp'2024-01-01 00:00:00' as event_time").coalesce(1)
    write_day_files(many, f"{tmp_dir}/roll", max_records_per_file=3)
    import glob
    assert len(glob.glob(f"{tmp_dir}/roll/dt=2024-01-01/*.parquet")) == 4


def test_jdbc_round_trip_embedded_derby(spark):
    url = f"jdbc:derby:memory:al{uuid.uuid4().hex[:8]};create=true"
    assets = spark.createDataFrame(
        [("c1", "n1", '{"m":["10.0.0.1"]}', 1, "BUILDING"), ("c2", "n2", '{"m":["10.0.0.2"]}', 2, "AUTOMOBILE")],
        "entity_id string, entity_name string, asset_ip string, area_id int, entity_groups string")
    jdbc.write_jdbc(assets, url, "ASSET", mode="overwrite", driver="org.apache.derby.jdbc.EmbeddedDriver",
                    createTableColumnTypes="entity_id VARCHAR(64), entity_name VARCHAR(64), asset_ip VARCHAR(256), "
                                           "entity_groups VARCHAR(64)")
    got = jdbc.read_assets_jdbc(spark, url, "ASSET", groups=["BUILDING", "X"],
                                driver="org.apache.derby.jdbc.EmbeddedDriver")
    assert [(r.entity_id, r.area_id) for r in got.collect()] == [("c1", 1)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "*In(entity_groups, [BUILDING,X])" in plan


def test_options(tmp_dir):
    p = f"{tmp_dir}/kafka.properties"
    with open(p, "w") as fh:
        fh.write("# comment\nbootstrap.servers=h1:9092\ntopic=csp_flow\ngroup.id=g1\n")
    opts = load_options(p, ["--group.id=g2", "session.timeout.ms=30000"])
    assert opts == {"bootstrap.servers": "h1:9092", "topic": "csp_flow", "group.id": "g2",
                    "session.timeout.ms": "30000"}
    k = kafka_reader_options(opts, max_records_per_trigger=30)
    assert k == {"kafka.bootstrap.servers": "h1:9092", "subscribe": "csp_flow", "kafka.group.id": "g2",
                 "kafka.session.timeout.ms": "30000", "maxOffsetsPerTrigger": "30"}


def test_export_profiles_to_staging_table(spark):
    from assetlens.sinks import export_profiles_jdbc
    url = f"jdbc:derby:memory:ex{uuid.uuid4().hex[:8]};create=true"
    e = edges(spark, [("m1", "a", 9, "10.0.0.2"), ("m1", "a", 10, "10.0.0.1"), ("m1", "b", 1, "1.1.1.1")])
    scoped = spark.createDataFrame([("m1", "a", '{"m":["10.0.0.1"]}'), ("m1", "b", '{"m":["1.1.1.1"]}')],
                                   "model_id string, entity_id string, asset_ip string")
    types = ("id VARCHAR(80), modeling_params_id VARCHAR(64), src_id VARCHAR(64), src_ip VARCHAR(256), "
             "dst_ip_segment VARCHAR(4000)")
    export_profiles_jdbc(e, scoped, url, "PROFILE_STAGE", driver="org.apache.derby.jdbc.EmbeddedDriver",
                         createTableColumnTypes=types)
    back = jdbc.read_jdbc(spark, url, "PROFILE_STAGE", driver="org.apache.derby.jdbc.EmbeddedDriver")
    got = {r.SRC_ID if "SRC_ID" in back.columns else r.src_id: r for r in back.collect()}
    assert got["a"].dst_ip_segment == '[{"name":"9","value":"10.0.0.2"},{"name":"10","value":"10.0.0.1"}]'
    assert got["b"].src_ip == '"1.1.1.1"' and got["a"].id.startswith("mdl_")


def test_only_new_edges_and_replay(spark, tmp_dir):
    st = EdgeStore(spark, f"{tmp_dir}/store").init()
    b0 = edges(spark, [("m1", "a", 1, "x"), ("m1", "a", 2, "y")])
    b1 = edges(spark, [("m1", "a", 1, "x"), ("m1", "a", 3, "z")])
    st.write_batch(b0, 0, only_new=True)
    st.write_batch(b1, 1, only_new=True)
    assert st.raw_edges().where("batch_id = 1").count() == 1          # only the new edge was written
    want = [("m1", "a", 1, "x"), ("m1", "a", 2, "y"), ("m1", "a", 3, "z")]
    assert keyset(st.read_edges()) == want
    st.write_batch(b1, 1, only_new=True)                                # replay: must not erase itself
    assert keyset(st.read_edges()) == want
    st.write_batch(b0, 0, only_new=True)                                # replay of an older batch
    assert keyset(st.read_edges()) == want


def test_crash_between_data_and_commit(spark, tmp_dir):
    """Replace mode: data written, commit lost -> old profile still visible; the retry reuses the generation."""
    st = EdgeStore(spark, f"{tmp_dir}/store").init()
    st.write_batch(edges(spark, [("m1", "a", 1, "old")]), 0)
    rm = spark.createDataFrame([("m1",)], "model_id string")
    new = edges(spark, [("m1", "a", 2, "new")])
    st._write(new, {"m1": 1}, 1)                              # the task wrote its files, then the job died
    assert keyset(st.read_edges()) == [("m1", "a", 1, "old")]
    st.write_batch(new, 1, replace_models=rm)                 # the batch is retried
    assert keyset(st.read_edges()) == [("m1", "a", 2, "new")]
    assert {(r.model_id, r.gen) for r in st.generations().collect()} == {("m1", 1)}
