"""Adapters that derive the application's inputs from the driver tables.

Every adapter is a plain DataFrame transformation, so its size grows with the tables.
The same formulas are written in SQL in ``assetlens.plans.oracle`` for the DuckDB check.

flow (from events)
    src_id  = 'c' || user_id                       src_ip = 10.0.(user_id div 256).(user_id mod 256)
    k       = (event_id * 7) mod N, N = number of customers
    dst_id  = 'null' for event_type 'error' (a blank id), else 'c' || k
    dst_ip  = 10.0.(k div 256).(k mod 256)         area_id = user_id mod 5
    flow_id = event_id as text                     event_time = ts, r_time = epoch ms of ts
flow (from lineitem and orders)
    customer o_custkey -> supplier l_suppkey at l_shipdate; flow_id = l_orderkey-l_linenumber
asset (from customer)
    entity_id = 'c' || c_custkey, group = c_mktsegment, area_id = c_custkey mod 5,
    asset_ip = {"00:00":["<ip>"]}; every tenth customer also has {"00:01":["10.1.x.y","<ip>"]}
Kafka rows (from flows)
    key = flow_id, value = JSON of the flow (odd event ids use the upper-case keys),
    topic csp_flow, partition = event_id mod 3, offset = event_id, timestamp = ts;
    event ids divisible by 97 carry malformed JSON, those divisible by 89 an empty value.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.ips import ip_of_key
from ..schemas import PARAMS

# Fixed values of the fixture.
TOPIC = "csp_flow"
AS_OF = dt.datetime(2024, 2, 1, 0, 0, 0)
SPLIT_AT = dt.datetime(2024, 1, 16, 0, 0, 0)
LOCAL_ZONE = "Asia/Shanghai"
N_AREAS = 5
BAD_JSON_EVERY = 97
EMPTY_VALUE_EVERY = 89


def _ip(prefix: str, key) -> F.Column:
    return F.concat_ws(".", F.lit("10"), F.lit(prefix), (key / 256).cast("long").cast("string"),
                       (key % 256).cast("string"))


def flows_from_events(events: DataFrame, customers: DataFrame) -> DataFrame:
    n = customers.select(F.count(F.lit(1))).scalar()
    user = F.col("user_id")
    k = (F.col("event_id") * 7) % n
    ts = F.col("ts").cast("timestamp")
    return events.select(
        F.concat(F.lit("c"), user.cast("string")).alias("src_id"),
        ip_of_key(user).alias("src_ip"),
        F.when(F.col("event_type") == "error", F.lit("null"))
        .otherwise(F.concat(F.lit("c"), k.cast("string"))).alias("dst_id"),
        ip_of_key(k).alias("dst_ip"),
        (user % N_AREAS).cast("int").alias("area_id"),
        F.col("event_id").cast("string").alias("flow_id"),
        F.unix_millis(ts).alias("r_time"),
        ts.alias("event_time"),
    )


def flows_from_lineitem(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    od = orders.select("o_orderkey", "o_custkey")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    ts = F.col("l_shipdate").cast("timestamp")
    return j.select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("src_id"),
        ip_of_key(F.col("o_custkey")).alias("src_ip"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("dst_id"),
        _ip("2", F.col("l_suppkey")).alias("dst_ip"),
        (F.col("o_custkey") % N_AREAS).cast("int").alias("area_id"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("flow_id"),
        F.unix_millis(ts).alias("r_time"),
        ts.alias("event_time"),
    )


def assets_from_customers(customers: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    first = F.concat(F.lit('{"00:00":["'), ip_of_key(key), F.lit('"]'))
    second = F.concat(F.lit(',"00:01":["'), _ip("1", key), F.lit('","'), ip_of_key(key), F.lit('"]'))
    asset_ip = F.concat(first, F.when(key % 10 == 0, second).otherwise(F.lit("")), F.lit("}"))
    return customers.select(
        F.concat(F.lit("c"), key.cast("string")).alias("entity_id"),
        F.col("c_name").alias("entity_name"),
        asset_ip.alias("asset_ip"),
        (key % N_AREAS).cast("int").alias("area_id"),
        F.col("c_mktsegment").alias("entity_groups"),
    )


def _groups(text: str) -> str:
    return '{"model_entity_group":"%s"}' % text


_OLD = dt.datetime(2024, 1, 1, 0, 0, 0)

# The model parameter rows of the fixture (see FIXTURES.md).
#  id, type, child, unit, num, span, template, confidence, history, update, switch, switch2, alt, status, modified
PARAM_ROWS = [
    ("m1", 1, 1, "hh", 1, 1, "", 0.95, 1, 1, 1, 1, _groups("BUILDING,MACHINERY"), "prepare", _OLD),
    ("m2", 1, 1, "dd", 1, 2, "", 0.95, 7, 0, 1, 1, _groups("AUTOMOBILE"), "prepare", _OLD),
    ("m3", 1, 1, "MM", 1, 4, "", 0.9, 30, 1, 0, 1, _groups("HOUSEHOLD"), "stop", _OLD),
    ("m4", 1, 3, "hh", 1, 1, "", 0.9, 1, 1, 1, 1, _groups("FURNITURE"), "prepare", _OLD),
    ("m5", 1, 1, "hh", 1, 1, "", 0.9, 1, 1, 1, 1, _groups("FURNITURE"), "prepare",
     AS_OF - dt.timedelta(minutes=5)),
    ("m6", 1, 1, "hh", 1, 9, "", 0.9, 1, 1, 1, 1, _groups("BUILDING"), "prepare", _OLD),
    ("m7", 1, 1, "MM", 1, 3, "", 0.9, 90, 1, 1, 1, _groups("FURNITURE,HOUSEHOLDS"), "prepare", _OLD),
]

# A later snapshot of the same table (m1 switches to replace, m2 changes its
# dimension, m7 changes its rate number, m4 is gone, m8 is new).
PARAM_ROWS_NEXT = [
    ("m1", 1, 1, "hh", 1, 1, "", 0.95, 1, 0, 1, 1, _groups("BUILDING,MACHINERY"), "running", _OLD),
    ("m2", 1, 1, "hh", 1, 1, "", 0.95, 7, 0, 1, 1, _groups("AUTOMOBILE"), "running", _OLD),
    ("m3", 1, 1, "MM", 1, 4, "", 0.9, 30, 1, 0, 1, _groups("HOUSEHOLD"), "stop", _OLD),
    ("m5", 1, 1, "hh", 1, 1, "", 0.9, 1, 1, 1, 1, _groups("FURNITURE"), "prepare",
     AS_OF - dt.timedelta(minutes=5)),
    ("m6", 1, 1, "hh", 1, 9, "", 0.9, 1, 1, 1, 1, _groups("BUILDING"), "prepare", _OLD),
    ("m7", 1, 1, "MM", 3, 3, "", 0.9, 90, 1, 1, 1, _groups("FURNITURE,HOUSEHOLDS"), "running", _OLD),
    ("m8", 1, 1, "dd", 1, 2, "", 0.9, 7, 1, 1, 1, _groups("MACHINERY"), "prepare", _OLD),
]


def model_params(spark: SparkSession, rows=None) -> DataFrame:
    """The configuration table (one row per model; it does not grow with the data)."""
    return spark.createDataFrame(rows if rows is not None else PARAM_ROWS, PARAMS)


def kafka_rows(events: DataFrame, customers: DataFrame) -> DataFrame:
    """Kafka-shaped records carrying the flows of ``flows_from_events`` as JSON."""
    flows = flows_from_events(events, customers)
    ev = F.col("flow_id").cast("long")
    lower = F.to_json(F.struct(
        F.col("src_id").alias("srcId"), F.col("src_ip").alias("srcIp"),
        F.col("dst_id").alias("dstId"), F.col("dst_ip").alias("dstIp"),
        F.col("area_id").alias("areaId"), F.col("flow_id").alias("flowId"),
        F.col("r_time").alias("rTime")))
    upper = F.to_json(F.struct(
        F.col("src_id").alias("SrcID"), F.col("src_ip").alias("SrcIP"),
        F.col("dst_id").alias("DstID"), F.col("dst_ip").alias("DstIP"),
        F.col("area_id").alias("AreaID"), F.col("flow_id").alias("FlowID"),
        F.col("r_time").alias("rTime")))
    value = (F.when(ev % BAD_JSON_EVERY == 0, F.concat(F.lit("{bad"), F.col("flow_id")))
             .when(ev % EMPTY_VALUE_EVERY == 0, F.lit(""))
             .when(ev % 2 == 1, upper)
             .otherwise(lower))
    return flows.select(
        F.col("flow_id").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (ev % 3).cast("int").alias("partition"),
        ev.alias("offset"),
        F.col("event_time").alias("timestamp"),
    )


# Spellings of numbers and switches as configuration tables hold them.
INT_TEXTS = ["1", " 2 ", "12.9", "", "null", "bad", "-3.7", "4"]
BOOL_TEXTS = ["1", "yes", " TRUE", "no", "0", "maybe", None, "False"]


def text_params(customers: DataFrame) -> DataFrame:
    """A parameter table with one model per customer and every field as text, in all spellings."""
    key = F.col("c_custkey")

    def pick(texts: list, at) -> F.Column:
        return F.get(F.array(*[F.lit(t).cast("string") for t in texts]), (at % len(texts)).cast("int"))

    return customers.select(
        F.concat(F.lit("p"), key.cast("string")).alias("id"),
        pick(["1", "1.0", "2", "x"], key).alias("model_type"),
        pick(["1", "3"], key).alias("model_child_type"),
        pick(["hh", "dd", "MM", "??", None], key).alias("model_rate_timeunit"),
        pick(INT_TEXTS, F.floor(key / 8)).alias("model_rate_timeunit_num"),
        pick(INT_TEXTS, key).alias("model_result_span"),
        pick(BOOL_TEXTS, F.floor(key / 4)).alias("model_update"),
        pick(BOOL_TEXTS, key).alias("model_switch"),
        pick(BOOL_TEXTS, F.floor(key / 2)).alias("model_switch_2"),
        F.concat(F.lit('{"model_entity_group":"'), F.col("c_mktsegment"), F.lit('"}')).alias("model_alt_params"),
        pick(["prepare", None], key).alias("model_task_status"),
        F.lit("2024-01-01 00:00:00").alias("modify_time"),
    )
