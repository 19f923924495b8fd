"""Parsing, completeness and quarantine."""


from assetlens import operators as op

GOOD_LOWER = '{"srcId":"c1","srcIp":"10.0.0.1","dstId":"c2","dstIp":"10.0.0.2","areaId":3,"flowId":"f1","rTime":1704067200000}'
GOOD_UPPER = '{"SrcID":"c3","SrcIP":"10.0.0.3","DstID":"c4","DstIP":"10.0.0.4","AreaID":"2","FlowID":"f2","rTime":"1704067200000"}'


def parse(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return op.parse_flows(df)


def test_both_spellings_and_types(spark):
    rows = parse(spark, [GOOD_LOWER, GOOD_UPPER]).orderBy("flow_id").collect()
    assert [(r.src_id, r.dst_ip, r.area_id, r.r_time, r.parse_status) for r in rows] == [
        ("c1", "10.0.0.2", 3, 1704067200000, "ok"), ("c3", "10.0.0.4", 2, 1704067200000, "ok")]
    assert str(rows[0].event_time) == "2024-01-01 00:00:00"


def test_malformed_and_quarantine(spark):
    vals = ["{bad", "", None, "[]", "{}", "  ", GOOD_LOWER,
            '{"srcId":"null","dstId":"c2"}', '{"srcId":"c1","dstId":"\\t"}']
    p = parse(spark, vals)
    q = {r.raw_value: r.reason for r in op.quarantine(p).collect()}
    assert q == {"{bad": "malformed_json", "": "empty_value", None: "empty_value", "[]": "malformed_json",
                 "{}": "blank_src_id", "  ": "empty_value", '{"srcId":"null","dstId":"c2"}': "blank_src_id",
                 '{"srcId":"c1","dstId":"\\t"}': "blank_dst_id"}
    good = op.complete_flows(p).collect()
    assert len(good) == 1 and good[0].flow_id == "f1"


def test_projection_and_upper_json(spark):
    p = op.complete_flows(parse(spark, [GOOD_LOWER]))
    assert op.flow_projection(p).columns == ["src_id", "src_ip", "dst_id", "dst_ip", "area_id", "flow_id", "r_time"]
    j = op.to_upper_json(op.flow_projection(p)).first().flow_json
    assert j == ('{"SrcID":"c1","SrcIP":"10.0.0.1","DstID":"c2","DstIP":"10.0.0.2","AreaID":3,'
                 '"FlowID":"f1","rTime":1704067200000}')


def test_json_parsed_once_in_plan(spark):
    """A filter on parsed fields must not inline from_json into every reference."""
    p = op.complete_flows(parse(spark, [GOOD_LOWER]))
    plan = p._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
