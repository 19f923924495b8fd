"""DuckDB SQL for each named query, over the driver tables registered as views.

The fixture adapters of ``sources.fixtures`` are written again here as CTEs; the parameter
rows are rendered from the same Python constants so both sides use one configuration.
"""

from __future__ import annotations

from ..functions.rates import RATE_UNIT_SECONDS
from ..sources import fixtures as fx


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if hasattr(v, "strftime"):
        return "TIMESTAMP '" + v.strftime("%Y-%m-%d %H:%M:%S") + "'"
    return repr(v)


def _values(rows) -> str:
    return ",\n    ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)


_PARAM_COLS = ("id, model_type, model_child_type, model_rate_timeunit, model_rate_timeunit_num, "
               "model_result_span, model_result_template, model_confidence_interval, model_history_data_span, "
               "model_update, model_switch, model_switch_2, model_alt_params, model_task_status, modify_time")
AS_OF = _lit(fx.AS_OF)
SPLIT = _lit(fx.SPLIT_AT)


def _ip(prefix: str, key: str) -> str:
    return f"'10.{prefix}.' || CAST(({key}) // 256 AS VARCHAR) || '.' || CAST(({key}) % 256 AS VARCHAR)"


def _blank(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) = '' OR {c} = 'null')"


_UNIT_CASE = "CASE rate_unit " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in RATE_UNIT_SECONDS.items()) + " END"


def _normalise(src: str) -> str:
    return f"""SELECT id AS model_id, model_type, model_child_type, model_rate_timeunit AS rate_unit,
           model_rate_timeunit_num AS rate_num, model_result_span AS span, model_update AS update_mode,
           COALESCE(model_update = 1, false) AS accumulate, COALESCE(model_switch = 1, false) AS switch_on,
           COALESCE(model_switch_2 = 1, false) AS switch2_on,
           json_extract_string(model_alt_params, '$.model_entity_group') AS entity_group_list,
           COALESCE(model_task_status, '') AS task_status, modify_time
    FROM {src}"""


_NORM_EXTRA = f"""SELECT *, CAST(rate_num AS VARCHAR) || rate_unit AS model_rate,
           CAST(rate_num AS BIGINT) * {_UNIT_CASE} AS rate_seconds,
           COALESCE((span = 1 AND rate_unit IN ('ss','mm','hh')) OR (span = 2 AND rate_unit = 'dd')
                    OR (span IN (3, 4) AND rate_unit = 'MM'), false) AS valid_rate,
           CASE span WHEN 1 THEN 'DAYS' WHEN 2 THEN 'WEEK' WHEN 3 THEN 'QUARTER' WHEN 4 THEN 'YEAR' END AS model_cycle,
           COALESCE(span IN (1, 2, 3, 4), false) AS valid_span"""

BASE = f"""
n_cust AS (SELECT count(*) AS n FROM customer),
flows AS (
    SELECT 'c' || CAST(user_id AS VARCHAR) AS src_id,
           {_ip('0', 'user_id')} AS src_ip,
           CASE WHEN event_type = 'error' THEN 'null'
                ELSE 'c' || CAST((event_id * 7) % (SELECT n FROM n_cust) AS VARCHAR) END AS dst_id,
           {_ip('0', '(event_id * 7) % (SELECT n FROM n_cust)')} AS dst_ip,
           CAST(user_id % 5 AS INTEGER) AS area_id,
           CAST(event_id AS VARCHAR) AS flow_id,
           epoch_us(ts) // 1000 AS r_time,
           ts AS event_time,
           event_id
    FROM events),
complete AS (SELECT * FROM flows WHERE NOT {_blank('src_id')} AND NOT {_blank('dst_id')}),
assets AS (
    SELECT 'c' || CAST(c_custkey AS VARCHAR) AS entity_id, c_name AS entity_name,
           '{{"00:00":["' || {_ip('0', 'c_custkey')} || '"]'
             || CASE WHEN c_custkey % 10 = 0
                     THEN ',"00:01":["' || {_ip('1', 'c_custkey')} || '","' || {_ip('0', 'c_custkey')} || '"]'
                     ELSE '' END || '}}' AS asset_ip,
           CAST(c_custkey % 5 AS INTEGER) AS area_id, c_mktsegment AS entity_groups
    FROM customer),
params_raw({_PARAM_COLS}) AS (VALUES
    {_values(fx.PARAM_ROWS)}),
params_base AS ({_normalise('params_raw')}),
params AS ({_NORM_EXTRA} FROM params_base),
active AS (SELECT * FROM params WHERE model_type = 1 AND model_child_type = 1 AND switch_on AND switch2_on
           AND modify_time < {AS_OF} - INTERVAL 10 MINUTE),
runnable AS (SELECT * FROM active WHERE valid_span),
scoped AS (SELECT p.model_id, p.span, p.accumulate, a.*
           FROM assets a JOIN runnable p ON contains(p.entity_group_list, a.entity_groups)),
scoped_exact AS (SELECT p.model_id, p.span, p.accumulate, a.*
                 FROM assets a JOIN (SELECT DISTINCT model_id, span, accumulate,
                                            unnest(string_split(entity_group_list, ',')) AS grp FROM runnable) p
                 ON a.entity_groups = p.grp),
asset_ips AS (SELECT DISTINCT entity_id, area_id,
                     unnest(json_extract_string(asset_ip, '$.*[*]')) AS ip FROM assets),
src_edges AS (
    SELECT s.model_id, s.entity_id,
           CAST(CASE s.span WHEN 1 THEN hour(f.event_time) WHEN 2 THEN isodow(f.event_time)
                ELSE month(f.event_time) END AS INTEGER) AS segment_key,
           f.src_ip AS host_ip, max(f.event_time) AS updated_at
    FROM complete f JOIN scoped s ON f.src_id = s.entity_id
    WHERE f.src_ip IS NOT NULL
    GROUP BY ALL)"""

KAFKA = f"""
kafka AS (
    SELECT flow_id AS key,
           CASE WHEN event_id % {fx.BAD_JSON_EVERY} = 0 THEN '{{bad' || flow_id
                WHEN event_id % {fx.EMPTY_VALUE_EVERY} = 0 THEN ''
                WHEN event_id % 2 = 1 THEN CAST(json_object('SrcID', src_id, 'SrcIP', src_ip, 'DstID', dst_id,
                     'DstIP', dst_ip, 'AreaID', area_id, 'FlowID', flow_id, 'rTime', r_time) AS VARCHAR)
                ELSE CAST(json_object('srcId', src_id, 'srcIp', src_ip, 'dstId', dst_id,
                     'dstIp', dst_ip, 'areaId', area_id, 'flowId', flow_id, 'rTime', r_time) AS VARCHAR) END AS value,
           '{fx.TOPIC}' AS topic, CAST(event_id % 3 AS INTEGER) AS partition, event_id AS "offset",
           event_time AS "timestamp"
    FROM flows),
checked AS (
    SELECT *, CASE WHEN COALESCE(json_valid(value), false) THEN value END AS j FROM kafka),
parsed AS (
    SELECT key, topic, partition, "offset", "timestamp",
           CASE WHEN value IS NULL OR trim(value) = '' THEN 'empty_value'
                WHEN j IS NULL OR json_type(j) <> 'OBJECT' THEN 'malformed_json'
                ELSE 'ok' END AS parse_status,
           coalesce(json_extract_string(j, '$.srcId'), json_extract_string(j, '$.SrcID')) AS src_id,
           coalesce(json_extract_string(j, '$.srcIp'), json_extract_string(j, '$.SrcIP')) AS src_ip,
           coalesce(json_extract_string(j, '$.dstId'), json_extract_string(j, '$.DstID')) AS dst_id,
           coalesce(json_extract_string(j, '$.dstIp'), json_extract_string(j, '$.DstIP')) AS dst_ip,
           CAST(coalesce(json_extract_string(j, '$.areaId'), json_extract_string(j, '$.AreaID')) AS INTEGER) AS area_id,
           coalesce(json_extract_string(j, '$.flowId'), json_extract_string(j, '$.FlowID')) AS flow_id,
           CAST(json_extract_string(j, '$.rTime') AS BIGINT) AS r_time
    FROM checked)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _named_csv(edges: str) -> str:
    return f"""SELECT model_id, entity_id, segment_key, string_agg(host_ip, ',' ORDER BY host_ip) AS host_ips,
       count(*) AS n_ips FROM {edges} GROUP BY model_id, entity_id, segment_key"""


def _edges(flow_rel: str, id_col: str, ip_col: str, scoped: str = "scoped") -> str:
    return f"""SELECT s.model_id, s.entity_id,
           CAST(CASE s.span WHEN 1 THEN hour(f.event_time) WHEN 2 THEN isodow(f.event_time)
                ELSE month(f.event_time) END AS INTEGER) AS segment_key,
           f.{ip_col} AS host_ip, max(f.event_time) AS updated_at
    FROM {flow_rel} f JOIN {scoped} s ON f.{id_col} = s.entity_id
    WHERE f.{ip_col} IS NOT NULL GROUP BY ALL"""


_SEG_AGG = """segs AS (
    SELECT model_id, entity_id, segment_key,
           string_agg('"' || host_ip || '"', ',' ORDER BY host_ip) AS ips_json,
           string_agg(host_ip, ',' ORDER BY host_ip) AS ips_csv, max(updated_at) AS t
    FROM src_edges GROUP BY ALL)"""


def _rendered(seg_expr: str) -> str:
    return _with(BASE, _SEG_AGG) + f"""
SELECT 'mdl_' || sha256(g.model_id || '|' || g.entity_id) AS id, g.model_id AS modeling_params_id,
       g.entity_id AS src_id, regexp_extract(s.asset_ip, '\\[([^\\]]*)\\]', 1) AS src_ip,
       g.dst_ip_segment, g.time
FROM (SELECT model_id, entity_id, {seg_expr} AS dst_ip_segment, max(t) AS time
      FROM segs GROUP BY model_id, entity_id) g
LEFT JOIN (SELECT DISTINCT model_id, entity_id, asset_ip FROM scoped) s
  ON g.model_id = s.model_id AND g.entity_id = s.entity_id"""


_NEXT = f"""
params_next_raw({_PARAM_COLS}) AS (VALUES
    {_values(fx.PARAM_ROWS_NEXT)}),
params_next_base AS ({_normalise("(SELECT * REPLACE (modify_time + INTERVAL 19 DAY AS modify_time) FROM params_next_raw)")}),
params_next AS ({_NORM_EXTRA} FROM params_next_base)"""

_SPLIT = f"""
hist_edges AS ({_edges(f"(SELECT * FROM complete WHERE event_time < {SPLIT})", 'src_id', 'src_ip')}),
new_edges AS ({_edges(f"(SELECT * FROM complete WHERE event_time >= {SPLIT})", 'src_id', 'src_ip')})"""


def _merged(replaced: str) -> str:
    return _with(BASE, _SPLIT, f"""
merged AS (SELECT model_id, entity_id, segment_key, host_ip, max(updated_at) AS updated_at FROM (
    SELECT * FROM hist_edges WHERE model_id NOT IN ({replaced})
    UNION ALL SELECT * FROM new_edges) GROUP BY ALL)""") + "\n" + _named_csv("merged")


_LOCAL = "(event_time + INTERVAL 8 HOUR)"   # Asia/Shanghai has had no daylight saving since 1991

ORACLE_SQL: dict[str, str] = {
    "flow_parse_complete": _with(BASE, KAFKA) + f"""
SELECT src_id, src_ip, dst_id, dst_ip, area_id, flow_id, r_time FROM parsed
WHERE parse_status = 'ok' AND NOT {_blank('src_id')} AND NOT {_blank('dst_id')}""",

    "flow_quarantine": _with(BASE, KAFKA) + f"""
SELECT reason, count(*) AS n FROM (
    SELECT CASE WHEN parse_status <> 'ok' THEN parse_status
                WHEN {_blank('src_id')} THEN 'blank_src_id'
                WHEN {_blank('dst_id')} THEN 'blank_dst_id' END AS reason FROM parsed)
WHERE reason IS NOT NULL GROUP BY reason""",

    "kafka_envelope": _with(BASE, KAFKA) + """
SELECT key, topic, partition, "offset", "timestamp", parse_status,
       CASE WHEN parse_status = 'ok' THEN CAST(json_object('SrcID', src_id, 'SrcIP', src_ip, 'DstID', dst_id,
            'DstIP', dst_ip, 'AreaID', area_id, 'FlowID', flow_id, 'rTime', r_time) AS VARCHAR) END AS flow_json
FROM parsed""",

    "active_params": _with(BASE) + """
SELECT r.model_id, r.span, r.model_rate, r.rate_seconds, r.valid_rate, r.model_cycle, r.accumulate,
       COALESCE(c.n, 0) AS n_assets
FROM runnable r LEFT JOIN (SELECT model_id, count(*) AS n FROM scoped GROUP BY model_id) c USING (model_id)""",

    "normalised_params": _with(BASE) + """
SELECT p.model_id, model_type, model_child_type, rate_unit, rate_num, span, update_mode, accumulate, switch_on,
       switch2_on, entity_group_list, task_status, modify_time, model_rate, rate_seconds, valid_rate, model_cycle,
       valid_span, COALESCE(c1.n, 0) AS n_contains, COALESCE(c2.n, 0) AS n_exact
FROM params p
LEFT JOIN (SELECT p.model_id, count(*) AS n FROM assets a JOIN params p
           ON contains(p.entity_group_list, a.entity_groups) GROUP BY p.model_id) c1 USING (model_id)
LEFT JOIN (SELECT p.model_id, count(*) AS n FROM assets a JOIN
             (SELECT DISTINCT model_id, unnest(string_split(entity_group_list, ',')) AS grp FROM params) p
           ON a.entity_groups = p.grp GROUP BY p.model_id) c2 USING (model_id)""",

    "latest_params": _with(BASE, _NEXT, """
both_p AS (SELECT * FROM params UNION ALL SELECT * FROM params_next),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY modify_time DESC) AS rn
                          FROM both_p) WHERE rn = 1)""") + """
SELECT l.model_id, l.span, l.rate_unit, l.rate_num, l.update_mode, l.task_status, l.modify_time,
       COALESCE(c.n, 0) AS n_assets
FROM latest l LEFT JOIN (SELECT p.model_id, count(*) AS n FROM assets a JOIN latest p
                         ON contains(p.entity_group_list, a.entity_groups) GROUP BY p.model_id) c USING (model_id)""",

    "params_diff": _with(BASE, _NEXT) + """,
kept AS (
  SELECT o.model_id, COALESCE(n.update_mode <> o.update_mode, n.update_mode IS NOT NULL) AS update_changed,
         COALESCE(n.span <> o.span, n.span IS NOT NULL) AS span_changed,
         COALESCE(n.rate_num <> o.rate_num, n.rate_num IS NOT NULL) AS num_changed,
         CASE WHEN COALESCE(trim(n.rate_unit), '') IN ('', 'null') THEN COALESCE(trim(o.rate_unit), '') NOT IN ('', 'null')
              ELSE COALESCE(n.rate_unit <> o.rate_unit, true) END AS unit_changed
  FROM params o JOIN params_next n ON o.model_id = n.model_id),
ids AS (SELECT model_id FROM params UNION SELECT model_id FROM params_next)
SELECT i.model_id, i.model_id NOT IN (SELECT model_id FROM params) AS added,
       i.model_id NOT IN (SELECT model_id FROM params_next) AS removed,
       COALESCE(update_changed, false) AS update_changed, COALESCE(span_changed, false) AS span_changed,
       COALESCE(unit_changed, false) AS unit_changed, COALESCE(num_changed, false) AS num_changed,
       COALESCE(span_changed OR unit_changed OR num_changed, false) AS dimension_changed,
       (SELECT count(*) FROM src_edges e WHERE e.model_id = i.model_id) AS n_edges
FROM ids i LEFT JOIN kept k ON k.model_id = i.model_id""",

    "asset_scope_contains": _with(BASE) + """
SELECT model_id, entity_id, entity_name, asset_ip, area_id FROM scoped""",

    "asset_scope_exact": _with(BASE) + """
SELECT model_id, entity_id, entity_name, asset_ip, area_id FROM scoped_exact""",

    "asset_ip_inventory": _with(BASE) + """
SELECT entity_id, area_id, ip FROM asset_ips""",

    "area_ip_index": _with(BASE) + """
SELECT area_id, entity_id, string_agg(ip, ',' ORDER BY ip) AS ips, count(*) AS n_ips
FROM (SELECT DISTINCT area_id, entity_id, ip FROM asset_ips) GROUP BY area_id, entity_id""",

    "flow_src_asset": _with(BASE) + """
SELECT s.model_id, s.entity_id, s.asset_ip, f.src_id AS host_id, f.src_ip AS host_ip, f.flow_id
FROM complete f JOIN scoped s ON f.src_id = s.entity_id""",

    "flow_dst_asset": _with(BASE) + """
SELECT s.model_id, s.entity_id, s.asset_ip, f.dst_id AS host_id, f.dst_ip AS host_ip, f.flow_id
FROM complete f JOIN scoped s ON f.dst_id = s.entity_id""",

    "flow_touch_semi": _with(BASE, """
idx AS (SELECT DISTINCT s.model_id, s.area_id, unnest(json_extract_string(s.asset_ip, '$.*[*]')) AS ip
        FROM scoped_exact s)""") + """
SELECT k.model_id, f.flow_id, f.src_ip, f.dst_ip, f.area_id
FROM complete f JOIN (SELECT DISTINCT model_id FROM idx) k ON true
WHERE EXISTS (SELECT 1 FROM idx i WHERE i.model_id = k.model_id AND i.area_id = f.area_id
              AND (i.ip = f.src_ip OR i.ip = f.dst_ip))""",

    "flow_touch_pairs": _with(BASE, """
idx AS (SELECT DISTINCT s.model_id, s.entity_id, s.area_id, unnest(json_extract_string(s.asset_ip, '$.*[*]')) AS ip
        FROM scoped_exact s),
owns AS (SELECT model_id, entity_id, area_id, list(ip) AS ips FROM idx GROUP BY ALL)""") + """
SELECT o.model_id, f.flow_id, o.entity_id,
       CASE WHEN list_contains(o.ips, f.src_ip) THEN f.src_ip ELSE f.dst_ip END AS ip,
       CASE WHEN list_contains(o.ips, f.src_ip) THEN 'src' ELSE 'dst' END AS side
FROM complete f JOIN owns o ON o.area_id = f.area_id
WHERE list_contains(o.ips, f.src_ip) OR list_contains(o.ips, f.dst_ip)""",

    "segment_keys": _with(BASE, f"""
li AS (SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem),
li_flows AS (SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS flow_id,
                    l.l_shipdate AS event_time
             FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
both_f AS (SELECT 'events' AS source, flow_id, event_time FROM complete
           UNION ALL SELECT 'lineitem', flow_id, event_time FROM li_flows)""") + f"""
SELECT source, flow_id, CAST(hour(event_time) AS INTEGER) AS seg_hour,
       CAST(isodow(event_time) AS INTEGER) AS seg_isodow, CAST(month(event_time) AS INTEGER) AS seg_month,
       CAST(hour({_LOCAL}) AS INTEGER) AS local_hour, CAST(isodow({_LOCAL}) AS INTEGER) AS local_isodow,
       CAST(month({_LOCAL}) AS INTEGER) AS local_month, strftime({_LOCAL}, '%Y-%m-%d') AS local_day
FROM both_f""",

    "profile_src": _with(BASE) + "\n" + _named_csv("src_edges"),

    "profile_src_peer": _with(BASE, f"e AS ({_edges('complete', 'src_id', 'dst_ip')})") + "\n" + _named_csv("e"),

    "profile_dst": _with(BASE, f"e AS ({_edges('complete', 'dst_id', 'dst_ip')})") + "\n" + _named_csv("e"),

    "profile_match": _with(BASE, """
idx AS (SELECT DISTINCT s.model_id, s.span, s.entity_id, s.area_id,
               unnest(json_extract_string(s.asset_ip, '$.*[*]')) AS ip FROM scoped_exact s),
owns AS (SELECT model_id, span, entity_id, area_id, list(ip) AS ips FROM idx GROUP BY ALL),
pairs AS (SELECT o.model_id, o.span, o.entity_id, f.event_time,
                 CASE WHEN list_contains(o.ips, f.src_ip) THEN f.src_ip ELSE f.dst_ip END AS ip
          FROM complete f JOIN owns o ON o.area_id = f.area_id
          WHERE list_contains(o.ips, f.src_ip) OR list_contains(o.ips, f.dst_ip)),
e AS (SELECT model_id, entity_id,
             CAST(CASE span WHEN 1 THEN hour(event_time) WHEN 2 THEN isodow(event_time)
                  ELSE month(event_time) END AS INTEGER) AS segment_key,
             ip AS host_ip, max(event_time) AS updated_at
      FROM pairs GROUP BY ALL)""") + "\n" + _named_csv("e"),

    "profile_multiset_csv": _with(BASE, """
e AS (SELECT r.model_id, f.src_id AS entity_id,
             CAST(CASE r.span WHEN 1 THEN hour(f.event_time) WHEN 2 THEN isodow(f.event_time)
                  ELSE month(f.event_time) END AS INTEGER) AS segment_key, f.src_ip AS host_ip
      FROM complete f JOIN runnable r ON true WHERE f.src_ip IS NOT NULL)""") + """
SELECT model_id, entity_id, segment_key, string_agg(host_ip, ',' ORDER BY host_ip) AS host_ips,
       count(*) AS n_flows
FROM e GROUP BY model_id, entity_id, segment_key""",

    "profile_keyed_json": _rendered(
        """'[{' || string_agg('"' || segment_key || '":[' || ips_json || ']', ',' ORDER BY segment_key) || '}]'"""),
    "profile_named_list": _rendered(
        """'[' || string_agg('{"name":' || segment_key || ',"value":[' || ips_json || ']}', ',' ORDER BY segment_key) || ']'"""),
    "profile_named_csv": _rendered(
        """'[' || string_agg('{"name":"' || segment_key || '","value":"' || ips_csv || '"}', ',' ORDER BY segment_key) || ']'"""),

    "profile_decode": _with(BASE) + """
SELECT model_id, entity_id, segment_key, host_ip FROM src_edges""",

    "profile_decode_list": _with(BASE) + """
SELECT model_id, entity_id, segment_key, host_ip FROM src_edges""",

    "profile_decode_csv": _with(BASE) + """
SELECT model_id, entity_id, segment_key, host_ip FROM src_edges""",

    "profile_peer_edges": _with(BASE, f"""
peer AS ({_edges('complete', 'src_id', 'dst_ip')})""") + """
SELECT model_id, entity_id, segment_key, host_ip FROM peer""",

    "profile_multiset_counts": _with(BASE) + """
SELECT r.model_id, f.src_id AS entity_id,
       CAST(CASE r.span WHEN 1 THEN hour(f.event_time) WHEN 2 THEN isodow(f.event_time) ELSE month(f.event_time) END AS INTEGER) AS segment_key,
       f.src_ip AS host_ip, count(*) AS n
FROM complete f, runnable r WHERE f.src_ip IS NOT NULL GROUP BY ALL""",

    "active_params_child3": _with(BASE) + f"""
SELECT p.model_id, p.span, p.model_rate, p.accumulate,
       (SELECT count(*) FROM assets a WHERE contains(p.entity_group_list, a.entity_groups)) AS n_assets
FROM params p
WHERE p.model_type = 1 AND p.model_child_type = 3 AND p.switch_on AND p.switch2_on AND p.valid_span
  AND p.modify_time < {AS_OF} - INTERVAL 10 MINUTE""",

    # what each spelling of the fixture must become, as plain values
    "text_params": """
WITH ints AS (SELECT [1, 2, 12, NULL, NULL, NULL, -3, 4]::INTEGER[] AS v),
bools AS (SELECT [true, true, true, false, false, false, false, false] AS v),
p AS (SELECT 'p' || c_custkey AS model_id, ([1, 1, 2, NULL]::INTEGER[])[c_custkey % 4 + 1] AS model_type,
        ([1, 3]::INTEGER[])[c_custkey % 2 + 1] AS model_child_type, (['hh', 'dd', 'MM', '??', NULL])[c_custkey % 5 + 1] AS rate_unit,
        ints.v[(c_custkey // 8) % 8 + 1] AS rate_num, ints.v[c_custkey % 8 + 1] AS span,
        bools.v[(c_custkey // 4) % 8 + 1] AS accumulate, bools.v[c_custkey % 8 + 1] AS switch_on,
        bools.v[(c_custkey // 2) % 8 + 1] AS switch2_on, c_mktsegment AS entity_group_list,
        CASE WHEN c_custkey % 2 = 0 THEN 'prepare' ELSE '' END AS task_status
      FROM customer, ints, bools)
SELECT *, CAST(rate_num AS VARCHAR) || rate_unit AS model_rate,
       rate_num::BIGINT * CASE rate_unit WHEN 'hh' THEN 3600 WHEN 'dd' THEN 86400 WHEN 'MM' THEN 2592000 END AS rate_seconds,
       COALESCE((span = 1 AND rate_unit = 'hh') OR (span = 2 AND rate_unit = 'dd') OR (span = 4 AND rate_unit = 'MM'), false) AS valid_rate,
       CASE span WHEN 1 THEN 'DAYS' WHEN 2 THEN 'WEEK' WHEN 4 THEN 'YEAR' END AS model_cycle,
       COALESCE(span IN (1, 2, 4), false) AS valid_span
FROM p""",

    "store_accumulate": _merged("SELECT NULL WHERE false"),
    "store_replace": _merged("SELECT model_id FROM new_edges"),
    "store_replay": _with(BASE, _SPLIT, f"""
smaller AS (SELECT * FROM scoped WHERE area_id <> 0),
odd_edges AS ({_edges(f"(SELECT * FROM complete WHERE event_time >= {SPLIT} AND event_id % 2 = 1)", 'src_id', 'src_ip', 'smaller')}),
even_edges AS ({_edges(f"(SELECT * FROM complete WHERE event_time >= {SPLIT} AND event_id % 2 = 0)", 'src_id', 'src_ip')}),
kept AS (SELECT DISTINCT model_id, entity_id, segment_key, host_ip FROM (
    SELECT * FROM hist_edges UNION ALL SELECT * FROM even_edges UNION ALL SELECT * FROM odd_edges))""") + "\n" + _named_csv("kept"),
    "store_dimension_change": _with(BASE, _SPLIT, _NEXT, f"""
later AS (SELECT * FROM params_next WHERE model_type = 1 AND model_child_type = 1 AND switch_on AND switch2_on
          AND modify_time < {AS_OF} - INTERVAL 10 MINUTE AND valid_span),
scoped_later AS (SELECT p.model_id, p.span, p.accumulate, a.* FROM assets a JOIN later p ON contains(p.entity_group_list, a.entity_groups)),
later_edges AS ({_edges(f"(SELECT * FROM complete WHERE event_time >= {SPLIT})", 'src_id', 'src_ip', 'scoped_later')}),
turned AS (SELECT l.model_id FROM later l JOIN runnable r USING (model_id) WHERE l.span <> r.span),
kept AS (SELECT DISTINCT model_id, entity_id, segment_key, host_ip FROM (
    SELECT * FROM hist_edges WHERE model_id NOT IN (SELECT model_id FROM turned) UNION ALL SELECT * FROM later_edges))""") + "\n" + _named_csv("kept"),
    "profile_accumulate": _merged("SELECT NULL WHERE false"),
    "profile_replace": _merged("SELECT model_id FROM runnable"),
    "profile_by_mode": _merged("SELECT model_id FROM runnable WHERE NOT accumulate"),

    "status_latest": _with(BASE, f"""
ev AS (
    SELECT model_id, task_status AS status, modify_time AS "at" FROM params
    UNION ALL SELECT model_id, 'running', (SELECT min(event_time) FROM complete) FROM runnable
    UNION ALL SELECT s.model_id, 'success', min(f.event_time)
              FROM complete f JOIN scoped s ON f.src_id = s.entity_id GROUP BY s.model_id
    UNION ALL SELECT model_id, 'failed', {AS_OF} FROM active WHERE NOT valid_span
    UNION ALL SELECT model_id, 'stop', {AS_OF} FROM params WHERE NOT switch_on),
ranked AS (SELECT model_id, lower(status) AS status, "at",
                  CASE lower(status) WHEN 'prepare' THEN 0 WHEN 'running' THEN 1 WHEN 'success' THEN 2
                       WHEN 'failed' THEN 3 WHEN 'stop' THEN 4 ELSE -1 END AS rk FROM ev)""") + """
SELECT model_id, status, "at" FROM (
    SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY "at" DESC, rk DESC) AS rn FROM ranked)
WHERE rn = 1""",

    "flow_day_files": _with(BASE) + f"""
SELECT strftime({_LOCAL}, '%Y-%m-%d') AS dt, count(*) AS n_flows FROM complete GROUP BY 1""",
}

# The live path: the profile of the flows that parse, and how many records do not.
ORACLE_SQL["profile_stream"] = _with(BASE, KAFKA, f"""
good AS (SELECT *, make_timestamp(r_time * 1000) AS event_time FROM parsed
         WHERE parse_status = 'ok' AND NOT {_blank('src_id')} AND NOT {_blank('dst_id')}),
live_edges AS ({_edges('good', 'src_id', 'src_ip')}),
live AS ({_named_csv('live_edges')})""") + """
SELECT live.*, (SELECT count(*) FROM parsed) - (SELECT count(*) FROM good) AS n_quarantined FROM live"""

# The job ends where the batch queries begin: with all flows and all assets.
ORACLE_SQL["profile_late_assets"] = ORACLE_SQL["profile_src"]
ORACLE_SQL["profile_match_stream"] = ORACLE_SQL["profile_match"]
ORACLE_SQL["store_multiset"] = ORACLE_SQL["profile_multiset_counts"]
ORACLE_SQL["kafka_backfill"] = ORACLE_SQL["kafka_envelope"]
ORACLE_SQL["profile_bitmap"] = ORACLE_SQL["profile_src_peer"]
ORACLE_SQL["profile_bitmap_counts"] = f"SELECT model_id, entity_id, segment_key, n_ips FROM ({ORACLE_SQL['profile_src_peer']})"
