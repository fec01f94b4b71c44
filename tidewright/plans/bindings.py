"""The domain's tables as views over the generated tables: plain SQL that Spark and DuckDB both read, with ``{table}`` for a table."""

from __future__ import annotations

import re
import string

from pyspark.sql import DataFrame, SparkSession

GATE = """SELECT event_id AS id, CASE WHEN event_type IN ('signup', 'click') THEN 'GATE_IN' ELSE 'GATE_OUT' END AS type,
  CASE WHEN k % 2 = 0 THEN 'E' ELSE 'I' END AS direction, CAST(user_id AS STRING) AS container_no,
  'UN' || CAST(user_id % 40 AS STRING) AS vesselcode, CAST(user_id % 7 AS STRING) AS voyage,
  substr('1234LX', k % 6 + 1, 1) || '5GP' AS size_code, ts AS event_time, value,
  CASE WHEN event_type IN ('signup', 'click') THEN t12 ELSE substr(t12, 1, 8) || '0000' END AS in_time,
  CASE WHEN event_type IN ('purchase', 'view') THEN t12 END AS out_time, 'T' || CAST(user_id % 4 AS STRING) AS terminal
FROM (SELECT event_id, event_type, user_id, ts, value, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
  replace(replace(replace(substr(CAST(ts AS STRING), 1, 16), '-', ''), ' ', ''), ':', '') AS t12
  FROM {events} WHERE event_type <> 'error') e"""
QUARANTINED = "SELECT DISTINCT 'UN' || CAST(user_id % 40 AS STRING) AS vesselcode, CAST(user_id % 7 AS STRING) AS voyage FROM {events} WHERE user_id % 37 = 0"
PLANS = """SELECT CAST(l_suppkey AS STRING) AS vessel_code, CAST(l_partkey % 50 AS STRING) AS voyage, l_linestatus AS terminal, l_returnflag AS direction,
  l_shipdate AS snapshot_time, CAST(l_shipdate AS DATE) + 2900 AS flow_date, CAST(l_quantity AS STRING) AS record_hash, l_quantity > 10 AS arrived,
  l_quantity * 20 - 40 AS arrival_delay_h, l_quantity * 15 - 30 AS departure_delay_h, l_orderkey AS t1, l_linenumber AS t2, l_extendedprice AS t3, l_partkey AS t4
FROM {lineitem}"""
VERSIONS = """SELECT l_orderkey, l_linenumber, l_shipdate AS observed_at, l_partkey * 100000 + l_suppkey AS version_id,
  CAST(l_quantity AS DECIMAL(18, 4)) AS quantity, CAST(l_extendedprice AS DECIMAL(18, 4)) AS price, l_returnflag AS direction, l_linestatus AS terminal FROM {lineitem}"""
VGM = "SELECT CAST(l_shipdate AS DATE) + 2900 AS flow_date, l_linestatus AS terminal, l_returnflag AS direction, CAST(l_quantity AS DECIMAL(18, 4)) AS weight_kg FROM {lineitem}"
RELEASE = """SELECT CAST(o_orderdate AS DATE) + 2900 AS flow_date, o_orderstatus AS terminal, o_orderpriority AS direction, 'C' || CAST(o_custkey % 5 AS STRING) AS operator,
  CASE WHEN o_orderkey % 9 = 0 THEN ' ' ELSE CAST(o_orderkey AS STRING) END AS bill_no, CAST(o_totalprice AS DECIMAL(18, 4)) AS weight,
  CAST(CASE WHEN o_custkey % 3 = 0 THEN o_totalprice END AS DECIMAL(18, 4)) AS weight_kg, CAST(o_orderkey % 100 AS DECIMAL(18, 4)) AS volume, CAST(o_custkey AS DECIMAL(18, 4)) AS pieces FROM {orders}"""
TRANSSHIP = """SELECT CAST(l_shipdate AS DATE) + 2900 AS flow_date, l_linestatus AS terminal, p_brand || ':' || p_type AS route, CASE WHEN p_size < 40 THEN p_type END AS cargo_group,
  CAST(l_orderkey AS STRING) AS container_no, CAST(l_quantity AS DECIMAL(18, 4)) AS weight, CAST(l_extendedprice AS DECIMAL(18, 4)) AS volume
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey WHERE l_linenumber = 1"""
CURRENT = "SELECT o_orderkey AS id, o_orderstatus AS status, CAST(o_custkey AS STRING) AS customer, o_orderpriority AS priority, CAST(o_orderdate AS STRING) AS compare_time FROM {orders}"
INCOMING = """SELECT o_orderkey + CASE WHEN o_orderkey % 11 = 0 THEN 100000000 ELSE 0 END AS id, CASE WHEN o_custkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS status,
  CAST(o_custkey AS STRING) AS customer, CASE WHEN o_custkey % 14 = 0 THEN '9' ELSE o_orderpriority END AS priority,
  CASE WHEN o_custkey % 7 = 1 THEN 'later' ELSE CAST(o_orderdate AS STRING) END AS compare_time FROM {orders} WHERE o_custkey % 7 <> 2"""
CURVES = """SELECT 'orders' AS curve_type, n_name AS entity_key, 'weekly' AS granularity, 'v1' AS model_version, CAST(date_trunc('week', o_orderdate) AS DATE) AS time_bucket,
  CAST(CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS DOUBLE) AS value, CASE WHEN count(*) > 1 THEN 'complete' ELSE 'partial' END AS quality_flag
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey GROUP BY n_name, date_trunc('week', o_orderdate)"""
PAGE_LOG = """SELECT event_type AS endpoint, CAST(user_id % 3 AS STRING) AS fingerprint, CAST((event_id - event_id % 100) / 100 AS BIGINT) AS page,
  CAST(CAST(floor(value) AS BIGINT) % 50 AS STRING) AS payload_hash, event_id AS seq FROM {events}"""
CANDIDATES = "SELECT ' UN' || CAST(l_suppkey AS STRING) || ' ' AS vesselcode, CASE l_partkey % 27 WHEN 0 THEN '/' WHEN 9 THEN '/' WHEN 18 THEN '\u3000/\r' WHEN 1 THEN '1\u30002' WHEN 2 THEN '1\t2' WHEN 3 THEN '1\u00a02' WHEN 4 THEN '\u822a1' WHEN 5 THEN '\u3000' ELSE CAST(l_partkey % 20 AS STRING) END AS voyage, CAST(l_shipdate AS DATE) AS eta, l_returnflag AS vessel_en_name FROM {lineitem}"
CATALOG = "SELECT 'UN' || CAST(s_suppkey AS STRING) AS vesselcode, CAST(s_nationkey % 20 AS STRING) AS voyage FROM {supplier} WHERE s_suppkey % 2 = 0"

#: A gate log as it comes: containers padded, in lower case, blank or missing; times blank, in two forms, malformed or far off; directions missing.
GATE_RAW = """SELECT event_id AS id, CASE WHEN event_type IN ('signup', 'click') THEN 'GATE_IN' ELSE 'GATE_OUT' END AS type, CASE WHEN event_id % 19 = 0 THEN NULL WHEN k % 2 = 0 THEN 'E' ELSE 'I' END AS direction,
  CASE user_id % 9 WHEN 0 THEN '  ' WHEN 1 THEN NULL WHEN 2 THEN ' abcu' || number || ' ' ELSE 'ABCU' || number END AS container_no,
  'UN' || CAST(user_id % 40 AS STRING) AS vesselcode, CAST(user_id % 7 AS STRING) AS voyage, CASE WHEN k % 11 = 0 THEN NULL ELSE substr('124lLX', k % 6 + 1, 1) || '5GP' END AS size_code,
  CASE event_id % 17 WHEN 0 THEN ' ' WHEN 1 THEN '209901010000' WHEN 2 THEN t16 WHEN 3 THEN NULL ELSE t12 END AS in_time,
  CASE event_id % 17 WHEN 4 THEN '' WHEN 5 THEN '199912310000' WHEN 6 THEN t16 WHEN 7 THEN 'bad' WHEN 8 THEN NULL ELSE t12 END AS out_time, t12 AS received_time, ts AS fetched_at
FROM (SELECT event_id, event_type, user_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, substr(CAST(10000000 + (user_id - user_id % 9) AS STRING), 2, 7) AS number,
  substr(CAST(ts AS STRING), 1, 16) AS t16, replace(replace(replace(substr(CAST(ts AS STRING), 1, 16), '-', ''), ' ', ''), ':', '') AS t12, ts FROM {events}) e"""
_dates = "CAST(CAST({0} AS DATE) AS STRING) AS d, replace(CAST(CAST({0} AS DATE) AS STRING), '-', '') AS d8"
_time = "CASE {0} % 6 WHEN 0 THEN d8 || '101500\r' WHEN 1 THEN '\u00a0' || d8 || '1015' WHEN 2 THEN ' ' || d || ' 10:15:00' WHEN 3 THEN d || 'T10:15:00' WHEN 4 THEN 'n/a' END"
_weight = "CASE {0} % 7 WHEN 0 THEN 'heavy' WHEN 1 THEN '\u3000' WHEN 2 THEN '-4' WHEN 3 THEN '\t' || CAST(CAST(floor({1}) AS INT) AS STRING) || '.5 ' WHEN 4 THEN 'NaN' WHEN 5 THEN NULL ELSE CAST(CAST(floor({1}) AS INT) AS STRING) END"
SOURCE_VGM = f"""SELECT CASE WHEN none THEN ' ' WHEN k = 1 THEN NULL WHEN k = 2 THEN '\t abcu' || number || '\u3000\r' WHEN k = 5 THEN '\u3000\u00a0' ELSE 'ABCU' || number END AS containerNumber, CASE WHEN none THEN NULL ELSE vessel END AS vesselcode,
  CASE WHEN none THEN '' ELSE voyage END AS voyage, CASE WHEN none THEN NULL ELSE {_time.format("l_linenumber")} END AS operatetime, CASE WHEN none OR k = 3 THEN NULL ELSE mode END AS senderCode, 'T' || flag AS receiverCode,
  ' ' || flag AS containerType, {_weight.format("l_partkey", "l_quantity")} AS vgmGrossWeight, {_time.format("l_suppkey")} AS portreceiverdate, ' name of ' || vessel AS vessel, 'OP' || flag AS ctnOperatorCode, CASE WHEN k = 4 THEN 'SM1' END AS vgmMethod
FROM (SELECT *, l_orderkey % 33 = 0 AS none, l_orderkey % 11 AS k, CAST(l_orderkey AS STRING) AS number, 'UN' || CAST(l_suppkey AS STRING) AS vessel, CAST(l_partkey % 50 AS STRING) AS voyage, l_linestatus AS mode, l_returnflag AS flag, {_dates.format("l_shipdate")} FROM {{lineitem}}) x"""
SOURCE_RELEASE = f"""SELECT CASE WHEN none OR k = 1 THEN NULL ELSE ' B' || CAST(o_orderkey AS STRING) END AS billno, CASE WHEN none THEN '' ELSE 'UN' || CAST(o_custkey % 40 AS STRING) END AS vesselcode, CASE WHEN none OR k = 2 THEN '  ' ELSE CAST(o_custkey % 9 AS STRING) END AS voyage,
  CASE WHEN none THEN NULL ELSE {_time.format("o_custkey")} END AS passtime, CASE WHEN none THEN NULL ELSE o_orderstatus END AS cpcode, o_orderpriority AS direct, CASE WHEN k = 3 THEN 'Y' END AS flag, 'ship ' || o_orderstatus AS envessel,
  {_weight.format("o_orderkey", "o_totalprice")} AS grossweight, {_weight.format("o_custkey", "o_custkey")} AS cargovolum
FROM (SELECT *, o_orderkey % 33 = 0 AS none, o_orderkey % 11 AS k, {_dates.format("o_orderdate")} FROM {{orders}}) x"""
SOURCE_TRANSSHIP = f"""SELECT CASE WHEN none THEN NULL ELSE 'ABCU' || CAST(l_orderkey AS STRING) END AS ctnNo, CASE WHEN none THEN '' ELSE 'B' || CAST(l_partkey AS STRING) END AS billNo, CASE WHEN none THEN NULL ELSE 'UN' || CAST(l_suppkey AS STRING) END AS firstVesselCode,
  CASE WHEN none THEN NULL ELSE '1' END AS firstVoyage, CASE WHEN none OR k = 1 THEN NULL ELSE 'UN' || CAST(l_suppkey + 1 AS STRING) END AS secondVesselCode, CASE WHEN none THEN ' ' ELSE '2' END AS secondVoyage, p_brand AS firstLoadPortCode, CASE WHEN k = 2 THEN ' ' ELSE 'NGB' END AS firstDischargePortCode,
  CASE WHEN k = 3 THEN NULL ELSE l_linestatus END AS secondTransPortCode, CASE k WHEN 4 THEN ' Steel   coils' WHEN 5 THEN NULL WHEN 6 THEN '  ' ELSE lower(p_type) END AS cargoDescription, {_weight.format("l_orderkey", "l_quantity")} AS quantity, {_weight.format("l_partkey", "l_extendedprice")} AS weight,
  {_weight.format("l_suppkey", "l_quantity")} AS volume, {_time.format("l_partkey")} AS sailingDate, {_time.format("l_suppkey")} AS cutOffDate, l_linestatus AS terminal, 'OP' AS ctnOperatorCode, CASE WHEN k = 7 THEN 'Y' END AS checkFlag, 'N' AS sendFlag
FROM (SELECT *, l_orderkey % 33 = 0 AS none, l_orderkey % 11 AS k, {_dates.format("l_shipdate")} FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey) x"""
SOURCE_EVENT = """SELECT 'ABCU' || CAST(user_id AS STRING) AS asked_container, CASE WHEN event_id % 5 = 0 THEN ' ' ELSE ' ABCU' || CAST(user_id AS STRING) END AS ctnno, 'UN' || CAST(user_id % 40 AS STRING) AS vesselcode, CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(user_id % 7 AS STRING) END AS voyage,
  CASE WHEN event_id % 2 = 0 THEN 'T1' ELSE 'T2' END AS cpcode, event_type AS operateId, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'B' || CAST(user_id AS STRING) END AS blNo, CASE WHEN event_id % 4 = 0 THEN 'E' ELSE 'I' END AS direct FROM {events}"""
SOURCE_PLAN = f"""SELECT 'UN' || CAST(l_suppkey AS STRING) AS vesselUnCode, CASE WHEN k = 1 THEN '\u2003' ELSE CAST(l_partkey % 50 AS STRING) END AS voyage, CASE WHEN k = 2 THEN NULL ELSE l_linestatus END AS terminal, l_returnflag AS vesselDirect, '\u3000ever\u3000 \u00a0lotus\r' AS vesselEnName, CASE WHEN k = 3 THEN 'cn' END AS vesselCnName,
  {_time.format("l_linenumber")} AS eta, {_time.format("l_suppkey")} AS etd, {_time.format("l_partkey")} AS ata, {_time.format("l_orderkey")} AS publishTime, {_time.format("l_orderkey + 1")} AS customCloseTime, {_time.format("l_orderkey + 2")} AS portCloseTime, {_time.format("l_orderkey + 3")} AS etanchor, {_time.format("l_orderkey + 4")} AS atanchor,
  'Y' AS published, ' S' AS status, 'CNNGB' AS nextPortCode FROM (SELECT *, l_orderkey % 11 AS k, {_dates.format("l_shipdate")} FROM {{lineitem}}) x"""
SOURCE_NOTICE = f"""SELECT 'UN' || CAST(o_custkey AS STRING) AS vesselcode, CASE WHEN k = 1 THEN ' ' ELSE CAST(o_custkey % 50 AS STRING) END AS voyage, o_orderstatus AS matou, CASE WHEN k = 2 THEN NULL ELSE 'I' END AS ioflag, {_time.format("o_orderkey")} AS ctnstart, {_time.format("o_custkey")} AS ctnend,
  CASE WHEN k < 4 THEN 'CNNGB,CNSHA' WHEN k < 7 THEN 'CNSHA; CNNGB' WHEN k = 8 THEN NULL ELSE ' USLAX ' END AS ediports, ' ever  lotus' AS vesselename, 'own' AS vesselowner, {_time.format("o_orderkey + 1")} AS revtime
FROM (SELECT *, o_orderkey % 11 AS k, {_dates.format("o_orderdate")} FROM {{orders}}) x"""

CAPTURE_JOBS = """SELECT o_orderkey AS job_id, o_custkey AS candidate_id, CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN 'partial' ELSE 'error' END AS status,
  CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE CAST(o_custkey AS BIGINT) END AS planned_total FROM {orders}"""
HISTORY_CANDIDATES = """SELECT 'UN' || CAST(l_suppkey AS STRING) AS vesselcode, CAST(l_partkey % 20 AS STRING) AS voyage, 'name' AS vessel_en_name, CASE min(l_orderkey) % 4 WHEN 0 THEN 'hit' WHEN 1 THEN 'no_data' ELSE 'pending' END AS status,
  CAST(min(l_shipdate) AS DATE) AS first_eta, CAST(max(l_shipdate) AS DATE) AS last_eta, count(*) AS source_plan_rows, l_suppkey % 3 = 0 AS vessel_in_catalog FROM {lineitem} GROUP BY l_suppkey, l_partkey % 20"""
HISTORY_MONTHS = """SELECT 'UN' || CAST(l_suppkey AS STRING) AS vesselcode, CAST(l_partkey % 20 AS STRING) AS voyage, substr(CAST(l_shipdate AS STRING), 1, 7) AS eta_month, CAST(min(l_shipdate) AS DATE) AS first_eta, CAST(max(l_shipdate) AS DATE) AS last_eta
FROM {lineitem} GROUP BY l_suppkey, l_partkey % 20, substr(CAST(l_shipdate AS STRING), 1, 7)"""
HISTORY_REJECTED = "SELECT DISTINCT 'UN' || CAST(l_suppkey AS STRING) AS vesselcode, CAST(l_partkey % 20 AS STRING) AS voyage FROM {lineitem} WHERE l_partkey % 20 = 7"
GATE_CATALOG = "SELECT 'UN' || CAST(s_suppkey AS STRING) AS vesselcode, CAST(s_nationkey % 20 AS STRING) AS voyage, CASE WHEN s_suppkey % 2 = 0 THEN 'done' END AS in_done_at, s_suppkey * 3 AS in_total, CAST(NULL AS STRING) AS out_done_at, s_suppkey * 5 AS out_total FROM {supplier}"
GATE_VOYAGES = """SELECT 'UN' || CAST(user_id % 40 AS STRING) AS vesselcode, CAST(user_id % 97 AS STRING) AS voyage, max(ts) AS last_event_at, CASE WHEN user_id % 40 % 11 = 0 THEN 1 ELSE 0 END AS inactive
FROM {events} GROUP BY user_id % 40, user_id % 97"""
NPP_CATALOG = """SELECT 'UN' || CAST(s_suppkey AS STRING) AS unvessel, CAST(s_nationkey AS STRING) AS voyage, s_name AS envessel, CASE WHEN s_suppkey % 3 = 0 THEN TIMESTAMP '2024-01-20 10:00:00' END AS portclose_at, CASE WHEN s_suppkey % 3 = 0 THEN '01-20 10:00' ELSE '' END AS portclose_raw,
  TIMESTAMP '2024-01-01 00:00:00' AS first_seen_at, TIMESTAMP '2024-01-10 00:00:00' AS last_seen_at FROM {supplier}"""
NPP_BATCH = """SELECT 'UN' || CAST(CASE WHEN k % 5 = 0 THEN k + 100000 ELSE k END AS STRING) AS unvessel, CAST(n AS STRING) AS voyage, 'ship ' || CAST(k AS STRING) AS envessel, CASE WHEN c = 2 THEN TIMESTAMP '2024-02-02 08:00:00' WHEN c = 1 AND k % 2 = 0 THEN TIMESTAMP '2024-02-01 08:00:00' END AS portclose_at,
  CASE WHEN c = 2 THEN '02-02 08:00' WHEN c = 1 AND k % 2 = 0 THEN '02-01 08:00' ELSE '01-01 00:00' END AS portclose_raw
FROM (SELECT s_suppkey AS k, s_nationkey AS n, 0 AS c FROM {supplier} WHERE s_suppkey % 7 <> 0 UNION ALL SELECT s_suppkey, s_nationkey, 1 FROM {supplier} WHERE s_suppkey % 4 = 0 UNION ALL SELECT s_suppkey, s_nationkey, 2 FROM {supplier} WHERE s_suppkey % 6 = 0) x"""
FLOW_VERSIONS = """SELECT l_orderkey, l_linenumber, l_shipdate + INTERVAL 2900 DAY AS observed_at, l_partkey * 100000 + l_suppkey AS version_id, CAST(l_shipdate AS DATE) + CAST(2898 + l_linenumber AS INT) AS flow_date, l_linestatus AS terminal, l_returnflag AS direction, 'R' || CAST(l_suppkey % 3 AS STRING) AS route,
  CAST(l_quantity AS DECIMAL(18, 4)) AS weight_kg FROM {lineitem}"""

RELEASE_VERSIONS = """SELECT o_custkey AS release_key, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 2900 DAY AS observed_at, o_orderkey AS version_id, CAST(o_orderdate AS DATE) + 2890 AS flow_date, o_orderstatus AS terminal, 'E' AS direction,
  substr(o_orderpriority, 1, 1) AS operator, CASE WHEN o_orderkey % 9 = 0 THEN ' ' ELSE 'B' || CAST(o_orderkey AS STRING) END AS bill_no, CAST(o_totalprice AS DECIMAL(18, 4)) AS weight, CAST(CASE WHEN o_custkey % 3 = 0 THEN o_totalprice END AS DECIMAL(18, 4)) AS weight_kg,
  CAST(o_orderkey % 100 AS DECIMAL(18, 4)) AS volume, CAST(o_custkey AS DECIMAL(18, 4)) AS pieces FROM {orders}"""
TRANSSHIP_VERSIONS = """SELECT l_partkey AS part_key, l_suppkey AS supp_key, CAST(l_shipdate AS TIMESTAMP) + INTERVAL 2905 DAY AS observed_at, l_orderkey * 10 + l_linenumber AS version_id, CAST(l_shipdate AS DATE) + 2895 AS flow_date, l_linestatus AS terminal, 'R' || CAST(l_suppkey % 3 AS STRING) AS route,
  CASE WHEN l_partkey % 4 > 0 THEN 'G' || CAST(l_partkey % 4 AS STRING) END AS cargo_group, CASE WHEN l_linenumber = 2 THEN NULL ELSE 'ABCU' || CAST(l_orderkey AS STRING) END AS container_no, CAST(l_quantity AS DECIMAL(18, 4)) AS weight, CAST(l_extendedprice AS DECIMAL(18, 4)) AS volume FROM {lineitem}"""
PLAN_VERSIONS = """SELECT l_suppkey AS call_key, l_partkey % 50 AS call_voyage, CAST(l_shipdate AS TIMESTAMP) + INTERVAL 2890 DAY AS observed_at, l_orderkey * 10 + l_linenumber AS version_id, l_linestatus AS terminal, l_returnflag AS direction, CAST(l_shipdate AS DATE) + 2895 AS flow_date, l_quantity > 10 AS arrived,
  l_quantity * 20 - 40 AS arrival_delay_h, l_quantity * 15 - 30 AS departure_delay_h FROM {lineitem}"""
#: What suppliers look like, as vectors made of whole numbers, and the course of their year.
SUPPLIER_VECTORS = """SELECT CAST(l_suppkey AS STRING) AS id, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / count(*) AS quantity, CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) / count(*) AS discount,
  CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS DOUBLE) / count(*) AS tax, CAST(count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS DOUBLE) / count(*) * 10 AS returned FROM {lineitem} GROUP BY l_suppkey"""
SUPPLIER_SEASONS = "SELECT CAST(l_suppkey AS STRING) AS id, CAST(month(l_shipdate) AS INT) AS month, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / count(*) AS value FROM {lineitem} GROUP BY l_suppkey, month(l_shipdate)"
#: Gate moves of containers with times in two columns; every third OUT carries its own in time, some messages come twice, some lack a time.
STAY_EVENTS = """SELECT event_id, CAST(user_id AS STRING) AS container_no, type, CASE WHEN type = 'GATE_IN' THEN minute WHEN event_id % 3 = 0 THEN minute - INTERVAL 2 DAY END AS in_time, CASE WHEN type = 'GATE_OUT' AND event_id % 23 <> 0 THEN minute END AS out_time
FROM (SELECT event_id, user_id, CASE WHEN event_type IN ('signup', 'click') THEN 'GATE_IN' ELSE 'GATE_OUT' END AS type, date_trunc('minute', ts) AS minute FROM {events}
  UNION ALL SELECT -event_id, user_id, CASE WHEN event_type IN ('signup', 'click') THEN 'GATE_IN' ELSE 'GATE_OUT' END, date_trunc('minute', ts) FROM {events} WHERE event_id % 10 = 0) e"""
#: Facts over half a year, and the same after corrections: days of five in March and of one in June come a day later and count twice.
VGM_DEALT = "SELECT DATE '2004-01-01' + CAST(l_partkey % 180 AS INT) AS flow_date, l_linestatus AS terminal, l_returnflag AS direction, CAST(l_quantity AS DECIMAL(18, 4)) AS weight_kg FROM {lineitem}"
VGM_CORRECTED = "SELECT CASE WHEN c THEN flow_date + 1 ELSE flow_date END AS flow_date, terminal, direction, CASE WHEN c THEN weight_kg * 2 ELSE weight_kg END AS weight_kg FROM (SELECT *, flow_date BETWEEN DATE '2004-03-05' AND DATE '2004-03-09' OR flow_date = DATE '2004-06-20' AS c FROM (" + VGM_DEALT + ") x) y"
#: Gate events and containers as JSON objects with keys that no schema knows.
GATE_JSON = """SELECT event_id, 'UN' || CAST(user_id % 40 AS STRING) AS asked_vessel, CAST(user_id % 7 AS STRING) AS asked_voyage, CASE WHEN event_type IN ('signup', 'click') THEN 'GATE_IN' ELSE 'GATE_OUT' END AS direction,
  '{{"id":' || CASE event_id % 20 WHEN 0 THEN 'null' WHEN 1 THEN '" "' ELSE CAST(event_id AS STRING) END || ',"vesselcode":"other","voyage":' || CASE WHEN event_id % 3 = 0 THEN '"  "' ELSE '" V' || CAST(user_id % 5 AS STRING) || '\u3000"' END
  || ',"ctnNo":"' || chr(92) || 'tABCU' || CAST(user_id AS STRING) || chr(92) || 'r' || chr(92) || 'n"' || CASE WHEN event_id % 4 = 0 THEN '' ELSE ',"billNo":null' END || ',"zeta":' || CASE event_id % 5 WHEN 0 THEN 'null' WHEN 1 THEN '""' WHEN 2 THEN '{{"b":1,"a":[true,"x"]}}' WHEN 3 THEN '12' ELSE '" "' END
  || ',"Alpha":' || CASE WHEN event_id % 7 = 0 THEN '""' ELSE '"n' || CAST(user_id AS STRING) || '"' END || ',"BILLNO":"shadow"}}' AS body FROM {events}"""
CONTAINER_JSON = """SELECT o_orderkey, '{{"id":"' || CASE WHEN o_orderkey % 17 = 0 THEN ' ' ELSE CAST(o_orderkey AS STRING) END || '","status":' || CASE o_orderkey % 3 WHEN 0 THEN 'null' WHEN 1 THEN '"\u00a0' || o_orderstatus || ' "' ELSE 'true' END
  || CASE WHEN o_orderkey % 2 = 0 THEN ',"more":null' ELSE '' END || CASE WHEN o_orderkey % 5 = 0 THEN ',"count":3,"also":""' ELSE '' END || ',"priority":"' || o_orderpriority || '"}}' AS body FROM {orders}"""

#: States of containers in the catalog; voyages with their life cycle; candidates and what happened to them.
CONTAINER_STATES = """SELECT 'ABCU' || CAST(c_custkey AS STRING) AS container_no, CASE c_custkey % 5 WHEN 0 THEN 'complete' WHEN 1 THEN 'error' WHEN 2 THEN 'invalid' ELSE 'pending' END AS vgm_status,
  CASE c_custkey % 7 WHEN 0 THEN 'invalid' WHEN 1 THEN 'complete' WHEN 2 THEN 'complete' ELSE 'pending' END AS history_status, CAST(c_custkey % 50 AS BIGINT) AS gate_event_count FROM {customer}"""
VOYAGE_STATES = """SELECT 'UN' || CAST(s_suppkey AS STRING) AS vesselcode, CAST(s_nationkey AS STRING) AS voyage, CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE s_name END AS vesselename, TIMESTAMP '2024-01-01 00:00:00' AS first_seen_at, TIMESTAMP '2024-01-10 00:00:00' AS last_seen_at,
  CASE WHEN s_suppkey % 2 = 0 THEN TIMESTAMP '2024-01-02 00:00:00' END AS in_done_at, CAST(s_suppkey * 3 AS BIGINT) AS in_total, CASE WHEN s_suppkey % 3 = 0 THEN TIMESTAMP '2024-01-03 00:00:00' END AS out_done_at, CAST(NULL AS BIGINT) AS out_total, CAST(CASE WHEN s_suppkey % 11 = 0 THEN 1 ELSE 0 END AS INT) AS inactive FROM {supplier}"""
CANDIDATE_STATES = """SELECT 'UN' || CAST(s_suppkey + k AS STRING) AS vesselcode, CAST(s_nationkey AS STRING) AS voyage, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'ship ' || CAST(s_suppkey AS STRING) END AS vessel_en_name, CASE s_suppkey % 6 WHEN 0 THEN 'hit' WHEN 1 THEN 'empty' ELSE 'pending' END AS status,
  CAST(s_suppkey % 3 AS INT) AS attempt_count, CAST(NULL AS TIMESTAMP) AS probed_at, CASE WHEN s_suppkey % 4 = 1 THEN CAST(7 AS BIGINT) END AS in_total, CAST(NULL AS BIGINT) AS out_total, TIMESTAMP '2024-01-01 00:00:00' AS updated_at, s_suppkey % 3 = 0 AS vessel_in_catalog
FROM (SELECT s_suppkey, s_nationkey, 0 AS k FROM {supplier} UNION ALL SELECT s_suppkey, s_nationkey, 1000000 FROM {supplier} WHERE s_suppkey % 3 = 0) x"""
CANDIDATE_PROBES = """SELECT 'UN' || CAST(l_suppkey AS STRING) AS vesselcode, CAST(s_nationkey AS STRING) AS voyage, CAST(l_shipdate AS TIMESTAMP) AS at, CASE WHEN l_quantity > 48 THEN CAST(l_quantity AS BIGINT) WHEN l_quantity > 20 THEN CAST(0 AS BIGINT) END AS in_total, CASE WHEN l_partkey % 50 = 0 THEN CAST(l_linenumber AS BIGINT) END AS out_total
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey WHERE l_suppkey % 4 <> 2 AND l_orderkey % 97 = 0"""
STATES_REJECTED = "SELECT 'UN' || CAST(s_suppkey AS STRING) AS vesselcode, CAST(s_nationkey AS STRING) AS voyage FROM {supplier} WHERE s_suppkey % 9 = 0"
DIRECTION_MARKS = """SELECT 'UN' || CAST(s_suppkey AS STRING) AS vesselcode, CAST(s_nationkey AS STRING) AS voyage, CASE WHEN s_suppkey % 2 = 0 THEN 'GATE_OUT' ELSE 'GATE_IN' END AS direction, TIMESTAMP '2024-02-01 00:00:00' + INTERVAL 1 DAY * CAST(d AS INT) AS at, CAST(s_suppkey * 10 + d AS BIGINT) AS total
FROM (SELECT s_suppkey, s_nationkey, 1 AS d FROM {supplier} WHERE s_suppkey % 5 < 2 UNION ALL SELECT s_suppkey, s_nationkey, 2 FROM {supplier} WHERE s_suppkey % 5 = 1) x"""
RUN_LEDGER = """SELECT o_orderkey AS run_id, CASE o_custkey % 3 WHEN 0 THEN 'backfill' WHEN 1 THEN 'incremental' ELSE 'gate' END AS kind, CAST(o_orderdate AS TIMESTAMP) AS started_at, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 HOUR END AS finished_at,
  CASE o_orderstatus WHEN 'O' THEN 'running' WHEN 'F' THEN 'ok' ELSE 'error' END AS status, CASE WHEN o_orderstatus = 'P' THEN 'boom' END AS error FROM {orders}"""
CLUSTER_RECORDS = """SELECT p_brand || '/' || CAST(p_size AS STRING) AS run_id, p_type AS algorithm, count(*) AS sample_count, count(DISTINCT p_name) AS cluster_count, CAST(NULL AS DOUBLE) AS silhouette, TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 DAY * CAST(max(p_partkey) AS INT) AS created_at FROM {part} GROUP BY p_brand, p_size, p_type"""
METRIC_FACTS = """SELECT CAST(l_shipdate AS DATE) AS flow_date, l_linestatus AS terminal, l_returnflag AS direction, CASE WHEN l_orderkey % 13 = 0 THEN ' ' ELSE ' abcu' || CAST(l_partkey % 40 AS STRING) END AS container_no, CAST(l_quantity AS BIGINT) AS weight_kg, CAST(l_shipdate AS TIMESTAMP) AS operator_time,
  CASE WHEN l_suppkey % 6 = 0 THEN NULL ELSE CAST(l_shipdate AS TIMESTAMP) + INTERVAL 1 HOUR * CAST(l_linenumber - 2 AS INT) END AS received_time, CASE WHEN l_partkey % 3 = 0 THEN 'N' ELSE 'Y' END AS result_code, CASE WHEN l_suppkey % 7 = 0 THEN '' ELSE 'B' || CAST(l_orderkey AS STRING) END AS bill_no,
  CASE WHEN l_suppkey % 5 > 0 THEN 'R' || CAST(l_suppkey % 5 AS STRING) END AS route, CAST(l_shipdate AS TIMESTAMP) AS estimated_anchor, CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE CAST(l_shipdate AS TIMESTAMP) + INTERVAL 1 HOUR * CAST(l_quantity * 20 - 100 AS INT) END AS actual_anchor FROM {lineitem}"""
#: Curves as a dashboard gets them: several types, two entities a nation, some values that are missing, implausible or 0 throughout.
BOARD_CURVES = """SELECT t AS curve_type, n_name || ':' || substr(o_orderpriority, 1, 1) AS entity_key, 'week' AS granularity, 'v1' AS model_version, CAST(date_trunc('week', o_orderdate) AS DATE) AS time_bucket,
  CASE WHEN t = 'arrival_delay' AND min(o_orderkey) % 10 = 0 THEN CAST(900 AS DOUBLE) WHEN t = 'released_bill_count' AND min(o_orderkey) % 9 = 0 THEN NULL WHEN t = 'departure_delay' AND min(o_orderkey) % 9 = 0 THEN CAST('NaN' AS DOUBLE) WHEN t = 'transshipment_container_count' THEN CAST(0 AS DOUBLE) ELSE CAST(count(*) * f + min(o_custkey) % 7 AS DOUBLE) END AS value
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey JOIN (SELECT 'planned_demand' AS t, 1 AS f UNION ALL SELECT 'released_bill_count', 2 UNION ALL SELECT 'cargo_release', 1000 UNION ALL SELECT 'gate_in_teu', 3 UNION ALL SELECT 'gate_out_teu', 4 UNION ALL SELECT 'arrival_delay', 5
  UNION ALL SELECT 'departure_delay', 6 UNION ALL SELECT 'pressure_index', 7 UNION ALL SELECT 'transshipment_container_count', 0) k ON o_orderkey % 3 <> f % 3 OR f = 1 GROUP BY t, f, n_name, substr(o_orderpriority, 1, 1), date_trunc('week', o_orderdate)"""

#: Pages of jobs, two rows a page; by job an empty page, a short one, a total that shrinks, a page or the last page missing, or nothing wrong.
JOB_PAGES = """SELECT job, n AS page, CAST(CASE WHEN job % 6 = 1 AND n = 2 THEN 0 WHEN job % 6 = 2 AND n = 3 THEN 1 ELSE 2 END AS INT) AS row_count, CAST(c * 2 - CASE WHEN job % 6 = 3 AND n >= 2 THEN 1 ELSE 0 END AS INT) AS total
FROM (SELECT l_suppkey AS job, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS INT) AS n, count(*) OVER (PARTITION BY l_suppkey) AS c FROM {lineitem}) x WHERE NOT (job % 6 = 4 AND n = 2) AND NOT (job % 6 = 5 AND n = c)"""

ALL = {k.lower(): v for k, v in list(globals().items()) if k.isupper() and isinstance(v, str)}


def source_columns(name: str) -> list[str]:
    """Names of a source binding's columns, in its order: what stands behind an AS outside of parentheses, before its FROM."""
    depth, out, words = 0, [], ALL[name].replace("(", " ( ").replace(")", " ) ").split()
    for before, word in zip(words, words[1:], strict=False):
        depth += (before == "(") - (before == ")")
        if depth == 0 and before == "FROM":
            break
        if depth == 0 and before == "AS":
            out.append(word.rstrip(","))
    return out


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A binding, or a generated table, by name."""
    if name not in ALL:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    tables = {t for _, t, _, _ in string.Formatter().parse(ALL[name]) if t}
    return spark.sql(ALL[name], **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables})


def sql(text: str) -> str:
    """``text`` with each ``:name:`` replaced by that binding, as DuckDB reads it."""
    for name, body in ALL.items():
        tables = {t: t for _, t, _, _ in string.Formatter().parse(body) if t}
        text = text.replace(f":{name}:", f"({body.format(**tables)})")
    return text


def ask(spark: SparkSession, sf_dir: str, text: str, **values) -> DataFrame:
    """Any SQL over the bindings, those it names as temporary views; ``:name`` in it takes one of ``values``. Reads only: it returns rows and stores nothing."""
    for name in set(re.findall(r"\w+", text)) & set(ALL):
        view(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(text, args=values)
