"""Queries of the normalizers: source rows as texts, some blank, padded, malformed or with keys missing, to facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.functions.text import WHITE_SPACE, parse_number, parse_time
from tidewright.operators import normalize, quality
from tidewright.plans.bindings import source_columns
from tidewright.plans.registry import query


def _trim(c: str) -> str:
    return f"trim({c}, '{WHITE_SPACE}')"


def _text(c: str) -> str:
    return f"nullif({_trim(c)}, '')"


def _texts(names: dict[str, str]) -> str:
    return ", ".join(f"{_text(c)} AS {n}" for c, n in names.items())


def _time(c: str) -> str:
    forms = ((r"\d{14}", "%Y%m%d%H%M%S"), (r"\d{12}", "%Y%m%d%H%M"), (r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", "%Y-%m-%d %H:%M:%S"), (r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d", "%Y-%m-%dT%H:%M:%S"))
    return "CASE " + " ".join(f"WHEN regexp_full_match({_trim(c)}, '{shape}') THEN try_strptime({_trim(c)}, '{form}')" for shape, form in forms) + " END"


def _number(c: str) -> str:
    return f"CASE WHEN isfinite(try_cast({_trim(c)} AS DOUBLE)) THEN try_cast({_trim(c)} AS DOUBLE) END"


def _json(columns: list[str]) -> str:
    """The row as JSON in order of names; what is null isn't there."""
    escaped = "replace(replace({0}, chr(9), chr(92) || 't'), chr(13), chr(92) || 'r')"
    return "'{' || concat_ws(',', " + ", ".join(f"""'"{c}":"' || {escaped.format(c)} || '"'""" for c in sorted(columns)) + ") || '}'"


def _key(columns: list[str], *parts: str, need_all: bool = False) -> str:
    missing = (" OR " if need_all else " AND ").join(f"{_text(p)} IS NULL" for p in parts)
    joined = " || '|' || ".join(f"coalesce({_text(p)}, '')" for p in parts)
    return f"sha256(CASE WHEN {missing} THEN {_json(columns)} ELSE {joined} END) AS business_key_hash"


_VGM = source_columns("source_vgm")


@query(f"""SELECT {_key(_VGM, "containerNumber", "vesselcode", "voyage", "operatetime", "senderCode")},
  {_texts({"containerNumber": "container_no", "vesselcode": "vessel_code", "vessel": "vessel_name_raw", "voyage": "voyage", "receiverCode": "terminal_code", "ctnOperatorCode": "operator_code", "containerType": "direction"})},
  {_text("containerType")} AS container_type, {_text("vgmMethod")} AS vgm_method, CAST(NULL AS STRING) AS result_code, CAST(NULL AS STRING) AS result_description, {_text("senderCode")} AS sender_code, {_text("receiverCode")} AS receiver_code,
  {_number("vgmGrossWeight")} AS vgm_weight_kg, {_time("operatetime")} AS operator_time, {_time("portreceiverdate")} AS terminal_received_time,
  CASE WHEN {_text("vgmGrossWeight")} IS NOT NULL AND ({_number("vgmGrossWeight")}) IS NULL THEN '{{"invalid_vgm_weight":true}}' ELSE '{{}}' END AS quality, sha256({_json(_VGM)}) AS record_hash FROM :source_vgm:""")
def silver_vgm(v):
    return normalize.normalize_vgm(v("source_vgm"))


_RELEASE = source_columns("source_release")


@query(f"""SELECT {_key(_RELEASE, "billno", "vesselcode", "voyage", "passtime", "cpcode")},
  {_texts({"billno": "bill_no", "vesselcode": "vessel_code", "envessel": "vessel_name_raw", "voyage": "voyage", "direct": "direction", "cpcode": "terminal_code", "flag": "flag"})},
  {_time("passtime")} AS pass_time, {_number("cargovolum")} AS cargo_volume, {_number("grossweight")} AS gross_weight, {_number("cargovolum")} AS piece_count,
  CASE WHEN ({_number("grossweight")}) >= 0 THEN {_number("grossweight")} END AS gross_weight_kg, CASE WHEN ({_number("grossweight")}) >= 0 THEN 'kg' END AS weight_unit,
  CASE WHEN ({_number("grossweight")}) >= 0 THEN 'cargo-weight-kg-v1' END AS weight_rule, sha256({_json(_RELEASE)}) AS record_hash FROM :source_release:""")
def silver_release(v):
    return normalize.normalize_release(v("source_release"))


_TRANSSHIP = source_columns("source_transship")
_CARGO = f"regexp_replace(upper({_trim('cargoDescription')}), '[{WHITE_SPACE}]+', ' ', 'g')"
_GROUP = f"CASE WHEN coalesce({_CARGO}, '') = '' THEN ['UNKNOWN', 'unknown'] WHEN {_CARGO} = 'STEEL COILS' THEN ['METAL', 'exact'] WHEN regexp_matches({_CARGO}, 'PROMO') THEN ['PROMOTED', 'regex'] WHEN regexp_matches({_CARGO}, '^STANDARD') THEN ['STANDARD', 'regex'] ELSE ['UNKNOWN', 'unknown'] END"


@query(f"""SELECT {_key(_TRANSSHIP, "ctnNo", "firstVesselCode", "firstVoyage", "secondVesselCode", "secondVoyage", "billNo")},
  {_texts({"ctnNo": "container_no", "ctnOperatorCode": "operator_code", "billNo": "bill_no", "cargoDescription": "cargo_description_raw", "firstVesselCode": "first_vessel_code", "firstVoyage": "first_voyage", "firstLoadPortCode": "first_load_port_code", "firstDischargePortCode": "first_discharge_port_code", "secondVesselCode": "second_vessel_code", "secondVoyage": "second_voyage", "secondTransPortCode": "second_trans_port_code", "terminal": "terminal_code", "checkFlag": "check_flag", "sendFlag": "send_flag"})},
  coalesce({_text("firstLoadPortCode")}, '') || ':' || coalesce({_text("firstDischargePortCode")}, '') || ':' || coalesce({_text("secondTransPortCode")}, '') AS route,
  ({_GROUP})[1] AS cargo_group, ({_GROUP})[2] AS cargo_match, {", ".join(f"{_number(c)} AS {c}" for c in ("quantity", "weight", "volume"))},
  {_time("sailingDate")} AS sailing_date, {_time("cutOffDate")} AS cutoff_date, sha256({_json(_TRANSSHIP)}) AS record_hash FROM :source_transship:""")
def silver_transshipment(v):
    return normalize.normalize_transshipment(v("source_transship"), {" steel  Coils ": "METAL"}, [("promo", "PROMOTED"), ("^standard", "STANDARD")])


_EVENT = [c for c in source_columns("source_event") if c != "asked_container"]


@query(f"""SELECT {_key(_EVENT, "asked_container", "vesselcode", "voyage", "cpcode", "operateId", "blNo")}, coalesce({_text("ctnno")}, asked_container) AS container_no, 'UNKNOWN' AS event_type, CAST(NULL AS TIMESTAMP) AS event_time,
  {_texts({"operateId": "event_code_raw", "vesselcode": "vessel_code", "voyage": "voyage", "cpcode": "terminal_code", "direct": "direction", "blNo": "bill_no"})},
  'ediContainerlog' AS event_source, 'unverified' AS event_confidence, sha256({_json(_EVENT)}) AS record_hash FROM :source_event:""")
def silver_container_event(v):
    return normalize.normalize_container_event(v("source_event"))


_PLAN = source_columns("source_plan")
_NAME = f"nullif(trim(regexp_replace(upper({{0}}), '[{WHITE_SPACE}]+', ' ', 'g')), '')"


@query(f"""SELECT {_key(_PLAN, "vesselUnCode", "voyage", "terminal", "vesselDirect", need_all=True)}, {_NAME.format("vesselEnName")} AS vessel_en_name,
  {", ".join(f"{_text(c) if c in _PLAN else 'CAST(NULL AS STRING)'} AS {n}" for c, n in normalize.PLAN_TEXTS.items())},
  {", ".join(f"{_time(c) if c in _PLAN else 'CAST(NULL AS TIMESTAMP)'} AS {n}" for c, n in normalize.PLAN_TIMES.items())}, {_time("publishTime")} AS source_update_time, sha256({_json(_PLAN)}) AS record_hash FROM :source_plan:""")
def silver_plan(v):
    return normalize.normalize_plan(v("source_plan"))


_NOTICE = source_columns("source_notice")
_PORTS = f"array_to_string(list_sort(regexp_split_to_array(coalesce({_text('ediports')}, ''), '[,;\\s]+')), ',')"


@query(f"""SELECT {_key(_NOTICE, "vesselcode", "voyage", "matou", "ctnstart", "ctnend", need_all=True)}, {_NAME.format("vesselename")} AS vessel_en_name,
  {_texts({"vesselcode": "vessel_code", "voyage": "voyage", "matou": "terminal_code", "ioflag": "direction", "ediports": "ports_raw", "vesselowner": "vessel_operator"})},
  {_time("ctnstart")} AS ctn_start_time, {_time("ctnend")} AS ctn_end_time, {_time("revtime")} AS source_update_time, {_PORTS} AS ports,
  sha256({_json([c for c in _NOTICE if c != "ediports"])} || '|' || {_PORTS}) AS record_hash FROM :source_notice:""")
def silver_notice(v):
    return normalize.normalize_notice(v("source_notice"))


@query("""WITH k AS (SELECT vesselcode, voyage, trim(vesselcode) || '|' || trim(voyage) AS pair, CAST(count(*) AS BIGINT) AS n FROM :source_release: WHERE trim(vesselcode) <> '' AND trim(voyage) <> '' GROUP BY ALL)
SELECT 'good' AS side, CAST(sum(n) AS BIGINT) AS n FROM k UNION ALL SELECT 'bad', (SELECT count(*) FROM :source_release:) - (SELECT CAST(sum(n) AS BIGINT) FROM k)""")
def silver_dead_letters(v):
    good, bad = normalize.dead_letters(v("source_release"), {"vessel": F.trim("vesselcode") != "", "voyage": F.trim("voyage") != ""})
    return good.agg(F.lit("good").alias("side"), F.count("*").alias("n")).unionByName(bad.agg(F.lit("bad").alias("side"), F.count("*").alias("n")))


_GATE_EXTRA = """concat_ws(',', CASE WHEN event_id % 7 <> 0 THEN '"Alpha":"n' || substr(ctn, 5) || '"' END, CASE event_id % 5 WHEN 2 THEN '"zeta":{"a":[true,"x"],"b":1}' WHEN 3 THEN '"zeta":12' WHEN 4 THEN '"zeta":" "' END)"""


@query(f"""WITH g AS (SELECT *, CAST(json_extract_string(body, '$.id') AS VARCHAR) AS id, trim(json_extract_string(body, '$.ctnNo'), '{WHITE_SPACE}') AS ctn, trim(json_extract_string(body, '$.voyage'), '{WHITE_SPACE}') AS voyage FROM :gate_json:)
SELECT id, direction AS type, asked_vessel AS vesselcode, coalesce(nullif(voyage, ''), asked_voyage) AS voyage, ctn AS "ctnNo", '' AS "billNo", CASE WHEN {_GATE_EXTRA} = '' THEN '' ELSE '{{' || {_GATE_EXTRA} || '}}' END AS extra FROM g WHERE event_id % 20 > 1""")
def silver_gate_event(v):
    rows = v("gate_json").withColumn("record", F.try_parse_json("body"))
    return normalize.normalize_gate_event(rows).select("id", "type", "vesselcode", "voyage", "ctnNo", "billNo", "extra")


_CONTAINER_EXTRA = """concat_ws(',', CASE WHEN o_orderkey % 5 = 0 THEN '"also":"","count":3' END, CASE WHEN o_orderkey % 2 = 0 THEN '"more":null' END)"""


@query(f"""WITH c AS (SELECT trim(json_extract_string(body, '$.id')) AS id, trim(coalesce(json_extract_string(body, '$.status'), ''), '{WHITE_SPACE}') AS status, json_extract_string(body, '$.priority') AS priority, CASE WHEN {_CONTAINER_EXTRA} = '' THEN '' ELSE '{{' || {_CONTAINER_EXTRA} || '}}' END AS extra FROM :container_json: WHERE o_orderkey % 17 <> 0)
SELECT *, sha256('{{"id":"' || id || '","priority":"' || priority || '","status":"' || status || '","extra":"' || replace(extra, '"', chr(92) || '"') || '"}}') AS row_hash FROM c""")
def silver_container(v):
    return normalize.normalize_container(v("container_json").withColumn("record", F.try_parse_json("body")), ["id", "status", "priority"])


@query("""SELECT key, kind, count(*) AS n FROM (SELECT unnest(json_keys(body)) AS key, body FROM :container_json:), LATERAL (SELECT CASE json_type(body, '$.' || key) WHEN 'VARCHAR' THEN 'STRING' WHEN 'NULL' THEN 'VOID' WHEN 'UBIGINT' THEN 'BIGINT' ELSE json_type(body, '$.' || key) END AS kind) GROUP BY key, kind""")
def json_fields(v):
    """Every key of the records with the type of its values."""
    rows = v("container_json").select(F.try_parse_json("body").alias("record"))
    return normalize.json_each(rows, "record").groupBy("key", "kind").agg(F.count("*").alias("n"))


_FAILED = {"weight": ("vgmGrossWeight", _number), "operator_time": ("operatetime", _time), "received_time": ("portreceiverdate", _time)}


@query(" UNION ALL ".join(f"""SELECT '{n}' AS "check", count(*) FILTER ({_text(c)} IS NOT NULL AND ({typed(c)}) IS NULL) AS failures FROM :source_vgm:""" for n, (c, typed) in _FAILED.items()))
def parse_failures(v):
    parse = {"weight": parse_number, "operator_time": parse_time, "received_time": parse_time}
    return quality.parse_failures(v("source_vgm"), {n: (c, parse[n](F.col(c))) for n, (c, _) in _FAILED.items()})
