"""Fixed schemas of the data model (flow, asset, params, edge, status, stored profile)."""

from pyspark.sql import types as T

FLOW = T.StructType([
    T.StructField("src_id", T.StringType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("dst_id", T.StringType()),
    T.StructField("dst_ip", T.StringType()),
    T.StructField("area_id", T.IntegerType()),
    T.StructField("flow_id", T.StringType()),
    T.StructField("r_time", T.LongType()),
    T.StructField("event_time", T.TimestampType()),
])

# The seven columns of the flow projection (event time excluded).
FLOW_COLUMNS = ["src_id", "src_ip", "dst_id", "dst_ip", "area_id", "flow_id", "r_time"]

# JSON keys accepted for each flow field: the reader's camel case and the writer's upper case.
# These spellings must equal the wire format.
FLOW_JSON_KEYS = {
    "src_id": ("srcId", "SrcID"),
    "src_ip": ("srcIp", "SrcIP"),
    "dst_id": ("dstId", "DstID"),
    "dst_ip": ("dstIp", "DstIP"),
    "area_id": ("areaId", "AreaID"),
    "flow_id": ("flowId", "FlowID"),
    "r_time": ("rTime",),
}

KAFKA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

ASSET = T.StructType([
    T.StructField("entity_id", T.StringType()),
    T.StructField("entity_name", T.StringType()),
    T.StructField("asset_ip", T.StringType()),
    T.StructField("area_id", T.IntegerType()),
    T.StructField("entity_groups", T.StringType()),
])

PARAMS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("model_type", T.IntegerType()),
    T.StructField("model_child_type", T.IntegerType()),
    T.StructField("model_rate_timeunit", T.StringType()),
    T.StructField("model_rate_timeunit_num", T.IntegerType()),
    T.StructField("model_result_span", T.IntegerType()),
    T.StructField("model_result_template", T.StringType()),
    T.StructField("model_confidence_interval", T.FloatType()),
    T.StructField("model_history_data_span", T.IntegerType()),
    T.StructField("model_update", T.IntegerType()),
    T.StructField("model_switch", T.IntegerType()),
    T.StructField("model_switch_2", T.IntegerType()),
    T.StructField("model_alt_params", T.StringType()),
    T.StructField("model_task_status", T.StringType()),
    T.StructField("modify_time", T.TimestampType()),
])

EDGE = T.StructType([
    T.StructField("model_id", T.StringType()),
    T.StructField("entity_id", T.StringType()),
    T.StructField("segment_key", T.IntegerType()),
    T.StructField("host_ip", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
])
EDGE_KEY = ["model_id", "entity_id", "segment_key", "host_ip"]

STATUS = T.StructType([
    T.StructField("model_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("at", T.TimestampType()),
])

# The model status domain, written in lower case.
MODEL_STATUSES = ("prepare", "running", "success", "failed", "stop")

STORED_PROFILE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("modeling_params_id", T.StringType()),
    T.StructField("src_id", T.StringType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("dst_ip_segment", T.StringType()),
    T.StructField("time", T.TimestampType()),
])
