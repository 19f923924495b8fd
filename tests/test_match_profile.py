"""D1/D2, D4/D5, E1-E4, G1/G2 against brute force on small flows."""

import datetime as dt
import random

import pytest

from assetlens import operators as op
from assetlens.schemas import FLOW

T0 = dt.datetime(2024, 1, 1)


def make(spark, n_flows=400, n_assets=12, seed=7):
    rnd = random.Random(seed)
    ips = [f"10.0.0.{i}" for i in range(20)]
    assets = []
    for i in range(n_assets):
        own = rnd.sample(ips, rnd.choice([1, 2]))
        assets.append((f"a{i}", f"n{i}", '{"mac":[%s]}' % ",".join(f'"{x}"' for x in own), i % 3, "G"))
    flows = []
    for k in range(n_flows):
        s, d = rnd.randrange(n_assets + 3), rnd.randrange(n_assets + 3)
        flows.append((f"a{s}", rnd.choice(ips), f"a{d}", rnd.choice(ips), rnd.randrange(3), f"f{k}",
                      None, T0 + dt.timedelta(hours=rnd.randrange(24 * 60))))
    a = spark.createDataFrame(assets, "entity_id string, entity_name string, asset_ip string, area_id int, "
                                      "entity_groups string")
    p = spark.createDataFrame([("m1", 1, True, "G"), ("m2", 2, False, "G"), ("m3", 3, True, "G")],
                              "model_id string, span int, accumulate boolean, entity_group_list string")
    f = spark.createDataFrame(flows, FLOW)
    return f, a, p, flows, assets


def key(span, ts):
    return {1: ts.hour, 2: ts.isoweekday(), 3: ts.month, 4: ts.month}[span]


SPANS = {"m1": 1, "m2": 2, "m3": 3}

# broadcast path, shuffle path, salted shuffle path
STRATEGIES = [dict(), dict(max_rows=0), dict(max_rows=0, salt_buckets=4)]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_profile_edges_brute_force(spark, strategy):
    f, a, p, flows, assets = make(spark)
    scoped = op.scope_assets(a, p, "exact")
    for side, host in [("src", "own"), ("src", "peer"), ("dst", "own")]:
        got = sorted((r.model_id, r.entity_id, r.segment_key, r.host_ip)
                     for r in op.profile_edges(f, scoped, side, host, **strategy).collect())
        ids = {x[0] for x in assets}
        want = set()
        for fl in flows:
            ent = fl[0] if side == "src" else fl[2]
            ip = {("src", "own"): fl[1], ("src", "peer"): fl[3], ("dst", "own"): fl[3]}[(side, host)]
            if ent in ids:
                for m, s in SPANS.items():
                    want.add((m, ent, key(s, fl[7]), ip))
        assert got == sorted(want), (side, host)


def _owned(assets):
    import json
    return {(a[0], a[3]): set(ip for v in json.loads(a[2]).values() for ip in v) for a in assets}


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_touch_pairs_and_semi_brute_force(spark, strategy):
    f, a, p, flows, assets = make(spark)
    idx = op.ip_index(op.scope_assets(a, p, "exact"))
    got = sorted((r.model_id, r.flow_id, r.entity_id, r.ip, r.side)
                 for r in op.touch_pairs(f, idx, **strategy).collect())
    want, semi = [], set()
    for fl in flows:
        for (ent, area), ips in _owned(assets).items():
            if area != fl[4]:
                continue
            hit = (fl[1], "src") if fl[1] in ips else ((fl[3], "dst") if fl[3] in ips else None)
            if hit:
                for m in SPANS:
                    want.append((m, fl[5], ent, hit[0], hit[1]))
                    semi.add((m, fl[5]))
    assert got == sorted(want)
    got_semi = sorted((r.model_id, r.flow_id) for r in op.touch_semi(f, idx, **strategy).collect())
    assert got_semi == sorted(semi)
    plan = op.touch_pairs(f, idx, **strategy)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert ("xxhash64" in plan) == (strategy.get("salt_buckets", 1) > 1)
    if "max_rows" not in strategy:       # (without it Spark may still broadcast by its own size stats)
        assert "BroadcastHashJoin" in plan


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_join_assets(spark, strategy):
    f, a, p, flows, assets = make(spark)
    scoped = op.scope_assets(a, p.where("model_id = 'm1'"), "exact")
    got = sorted((r.entity_id, r.host_ip, r.peer_ip, r.flow_id)
                 for r in op.join_assets(f, scoped, "dst", **strategy).collect())
    ids = {x[0] for x in assets}
    want = sorted((fl[2], fl[3], fl[1], fl[5]) for fl in flows if fl[2] in ids)
    assert got == want


def test_multiset_counts_every_flow(spark):
    f, a, p, flows, assets = make(spark, n_flows=200)
    got = {(r.model_id, r.entity_id, r.segment_key): r.host_ips
           for r in op.multiset_profile(f, p.where("model_id = 'm3'")).collect()}
    want = {}
    for fl in flows:
        want.setdefault(("m3", fl[0], fl[7].month), []).append(fl[1])
    assert got == {k: ",".join(sorted(v)) for k, v in want.items()}


def edges(spark, rows):
    return spark.createDataFrame([(m, e, k, ip, T0) for m, e, k, ip in rows],
                                 "model_id string, entity_id string, segment_key int, host_ip string, "
                                 "updated_at timestamp")


def keyset(df):
    return sorted((r.model_id, r.entity_id, r.segment_key, r.host_ip) for r in df.collect())


def test_merge_modes(spark):
    hist = edges(spark, [("m1", "a", 1, "x"), ("m2", "a", 1, "x"), ("m1", "b", 2, "y")])
    new = edges(spark, [("m1", "a", 1, "x"), ("m1", "a", 3, "z"), ("m2", "a", 5, "w")])
    acc = keyset(op.merge_edges(hist, new))
    assert acc == [("m1", "a", 1, "x"), ("m1", "a", 3, "z"), ("m1", "b", 2, "y"), ("m2", "a", 1, "x"),
                   ("m2", "a", 5, "w")]
    rep = keyset(op.merge_edges(hist, new, spark.createDataFrame([("m2",)], "model_id string")))
    assert rep == [("m1", "a", 1, "x"), ("m1", "a", 3, "z"), ("m1", "b", 2, "y"), ("m2", "a", 5, "w")]
    # merging the same batch twice changes nothing (idempotent); empty history = new
    assert keyset(op.merge_edges(op.merge_edges(hist, new), new)) == acc
    assert keyset(op.merge_edges(edges(spark, []), new)) == keyset(new)


def test_encode_decode_round_trip(spark):
    e = edges(spark, [("m1", "a", 9, "10.0.0.2"), ("m1", "a", 10, "10.0.0.1"), ("m1", "a", 10, "10.0.0.3"),
                      ("m1", "b", 1, "1.1.1.1"), ("m2", "a", 7, "9.9.9.9")])
    scoped = spark.createDataFrame([("m1", "a", '{"m":["10.0.0.1"]}'), ("m1", "b", '{"m":["1.1.1.1"]}'),
                                    ("m2", "a", '{"m":["10.0.0.1"]}')], "model_id string, entity_id string, asset_ip string")
    for enc in op.ENCODINGS:
        stored = op.render_profiles(e, scoped, enc)
        assert keyset(op.decode_profiles(stored, enc)) == keyset(e), enc
    keyed = {r.src_id + r.modeling_params_id: r.dst_ip_segment for r in op.render_profiles(e, scoped, "keyed").collect()}
    assert keyed["am1"] == '[{"9":["10.0.0.2"],"10":["10.0.0.1","10.0.0.3"]}]'
    csv = {r.src_id + r.modeling_params_id: r.dst_ip_segment
           for r in op.render_profiles(e, scoped, "named_csv").collect()}
    assert csv["am1"] == '[{"name":"9","value":"10.0.0.2"},{"name":"10","value":"10.0.0.1,10.0.0.3"}]'
    nl = {r.src_id + r.modeling_params_id: r.dst_ip_segment
          for r in op.render_profiles(e, scoped, "named_list").collect()}
    assert nl["bm1"] == '[{"name":1,"value":["1.1.1.1"]}]'


def test_decode_bad_and_empty(spark):
    rows = [("m", "a", "[]", T0), ("m", "b", "{bad", T0), ("m", "c", None, T0),
            ("m", "d", '[{"1":["x"]},{"2":["y","z"]}]', T0)]
    df = spark.createDataFrame(rows, "modeling_params_id string, src_id string, dst_ip_segment string, time timestamp")
    assert keyset(op.decode_profiles(df, "keyed")) == [("m", "d", 1, "x"), ("m", "d", 2, "y"), ("m", "d", 2, "z")]
    df2 = spark.createDataFrame([("m", "a", '[{"name":"1","value":"IP1,IP2"}]', T0)],
                                "modeling_params_id string, src_id string, dst_ip_segment string, time timestamp")
    assert keyset(op.decode_profiles(df2, "named_csv")) == [("m", "a", 1, "IP1"), ("m", "a", 1, "IP2")]


def test_latest_status(spark):
    ev = spark.createDataFrame([("m1", "running", T0), ("m1", "SUCCESS", T0), ("m2", "running", T0),
                                ("m2", "failed", T0 - dt.timedelta(1))], "model_id string, status string, at timestamp")
    got = {r.model_id: r.status for r in op.latest_status(ev).collect()}
    assert got == {"m1": "success", "m2": "running"}


def test_preaggregation_limited_to_needed_spans(spark):
    f, a, p, flows, assets = make(spark)
    for model in ("m1", "m2", "m3"):
        scoped = op.scope_assets(a, p.where(f"model_id = '{model}'"), "exact")
        full = keyset(op.profile_edges(f, scoped))
        spans = op.model_spans(p.where(f"model_id = '{model}'"))
        lean = op.profile_edges(f, scoped, spans=spans)
        assert keyset(lean) == full and full
    # hourly models: the pre-aggregate groups on the hour only (weekday and month are constant)
    pre = op.preaggregate(f, "src_id", "src_ip", spans=[1])
    assert pre.where("seg_isodow is not null or seg_month is not null").count() == 0
    assert pre.count() < op.preaggregate(f, "src_id", "src_ip").count()
