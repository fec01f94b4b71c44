"""Source rows (all text) to typed facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.codes import classify_name
from tidewright.functions.text import digest, filled, key_of, normalize_name, number_of, row_json, time_of, trimmed

#: Version of the rule by which a cargo weight is taken as kilograms.
WEIGHT_RULE = "cargo-weight-kg-v1"
#: The times of a vessel plan, and its texts, by the name that the source gives them.
PLAN_TIMES = {
    "ctnStartTime": "ctn_start_time", "ctnEndTime": "ctn_end_time", "customCloseTime": "custom_close_time", "portCloseTime": "port_close_time", "eta": "eta", "etd": "etd",
    "ata": "ata", "atd": "atd", "etanchor": "estimated_anchor_time", "atanchor": "actual_anchor_time", "publishTime": "publish_time",
}
PLAN_TEXTS = {
    "vesselUnCode": "vessel_code", "vesselCnName": "vessel_cn_name", "voyage": "voyage", "terminal": "terminal_code", "vesselDirect": "direction", "tradeFlag": "trade_flag",
    "lastPortCode": "last_port_code", "nextPortCode": "next_port_code", "berthReference": "berth_reference", "status": "status", "published": "published",
}


def _have(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with a null text column for each name it lacks."""
    return df.withColumns({n: F.lit(None).cast("string") for n in names if n not in df.columns})


class _Read:
    """``rows`` read once: clean texts and times as arrays, and the JSON of the columns ``keep`` (all by default); columns ``also`` stay.

    Each value is worked out once, by a function over an array. Written out in one select, all of them make a method that is too large for the JVM to compile, and each row takes many times as long.
    """

    def __init__(self, rows: DataFrame, texts: list[str], times: list[str] = [], keep: list[str] | None = None, names: list[str] = [], also: list[str] = []):  # noqa: B006
        raw = list(dict.fromkeys([*texts, *times]))
        self.text = {c: F.get(F.col("_texts"), F.lit(i)) for i, c in enumerate(raw)}
        self.time = {c: F.get(F.col("_times"), F.lit(i)) for i, c in enumerate(times)}
        self.name = {c: F.get(F.col("_names"), F.lit(i)) for i, c in enumerate(names)}
        given = lambda columns: F.array(*[F.col(c).cast("string") for c in columns])
        cleaned = [F.transform(F.transform(given(raw), trimmed), lambda t: F.nullif(t, F.lit(""))).alias("_texts"), row_json(*(rows.columns if keep is None else keep)).alias("_json")]
        if names:
            cleaned.append(F.transform(given(names), normalize_name).alias("_names"))
        self.rows = rows.select(*cleaned, *also)
        if times:
            self.rows = self.rows.withColumn("_times", F.transform(F.array(*[self.text[c] for c in times]), time_of))

    def texts(self, names: dict[str, str]) -> list[Column]:
        return [self.text[c].alias(n) for c, n in names.items()]

    def times(self, names: dict[str, str]) -> list[Column]:
        return [self.time[c].alias(n) for c, n in names.items()]

    def key(self, *names: str, need_all: bool = False) -> Column:
        return key_of([self.text[c] for c in names], F.col("_json"), need_all).alias("business_key_hash")

    def record_hash(self) -> Column:
        """Digest of the whole source row; fields that it lacks don't count."""
        return digest(F.col("_json")).alias("record_hash")


def normalize_vgm(rows: DataFrame) -> DataFrame:
    """Verified gross mass. ``direction`` is the source's container type; ``quality`` notes a weight that is given but not a number."""
    texts = {"containerNumber": "container_no", "vesselcode": "vessel_code", "vessel": "vessel_name_raw", "voyage": "voyage", "receiverCode": "terminal_code", "ctnOperatorCode": "operator_code", "containerType": "direction"}
    more = {"containerType": "container_type", "vgmMethod": "vgm_method", "resultCode": "result_code", "resultDescripts": "result_description", "senderCode": "sender_code", "receiverCode": "receiver_code"}
    times = {"operatetime": "operator_time", "portreceiverdate": "terminal_received_time"}
    rows = _have(rows, *texts, *more, "vgmGrossWeight", *times)
    read = _Read(rows, [*texts, *more, "vgmGrossWeight"], list(times))
    weight = number_of(read.text["vgmGrossWeight"])
    bad = read.text["vgmGrossWeight"].isNotNull() & weight.isNull()
    return read.rows.select(
        read.key("containerNumber", "vesselcode", "voyage", "operatetime", "senderCode"), *read.texts(texts), *read.texts(more), weight.alias("vgm_weight_kg"), *read.times(times),
        F.when(bad, '{"invalid_vgm_weight":true}').otherwise("{}").alias("quality"), read.record_hash(),
    )


def normalize_release(rows: DataFrame) -> DataFrame:
    """Cargo release. ``cargovolum`` is a piece count, kept as a volume too; a gross weight counts as kilograms only when it is a number from 0 on."""
    texts = {"billno": "bill_no", "vesselcode": "vessel_code", "envessel": "vessel_name_raw", "voyage": "voyage", "direct": "direction", "cpcode": "terminal_code", "flag": "flag"}
    rows = _have(rows, *texts, "passtime", "cargovolum", "grossweight")
    read = _Read(rows, [*texts, "cargovolum", "grossweight"], ["passtime"])
    weight, pieces = number_of(read.text["grossweight"]), number_of(read.text["cargovolum"])
    good = F.coalesce(weight >= 0, F.lit(False))
    return read.rows.select(
        read.key("billno", "vesselcode", "voyage", "passtime", "cpcode"), *read.texts(texts), *read.times({"passtime": "pass_time"}), pieces.alias("cargo_volume"),
        weight.alias("gross_weight"), pieces.alias("piece_count"), F.when(good, weight).alias("gross_weight_kg"), F.when(good, "kg").alias("weight_unit"),
        F.when(good, WEIGHT_RULE).alias("weight_rule"), read.record_hash(),
    )


def normalize_transshipment(rows: DataFrame, exact: dict[str, str], patterns: list[tuple[str, str]]) -> DataFrame:
    """Transshipments, with the cargo's group; ``route`` joins the three ports."""
    texts = {
        "ctnNo": "container_no", "ctnOperatorCode": "operator_code", "billNo": "bill_no", "cargoDescription": "cargo_description_raw", "firstVesselCode": "first_vessel_code", "firstVoyage": "first_voyage",
        "firstLoadPortCode": "first_load_port_code", "firstDischargePortCode": "first_discharge_port_code", "secondVesselCode": "second_vessel_code", "secondVoyage": "second_voyage",
        "secondTransPortCode": "second_trans_port_code", "terminal": "terminal_code", "checkFlag": "check_flag", "sendFlag": "send_flag",
    }
    numbers, times = ("quantity", "weight", "volume"), {"sailingDate": "sailing_date", "cutOffDate": "cutoff_date"}
    rows = _have(rows, *texts, *numbers, *times)
    read = _Read(rows, [*texts, *numbers], list(times), names=["cargoDescription"])
    cargo = read.rows.withColumn("_cargo", classify_name(read.name["cargoDescription"], exact, patterns))
    route = F.concat_ws(":", *[F.coalesce(read.text[c], F.lit("")) for c in ("firstLoadPortCode", "firstDischargePortCode", "secondTransPortCode")])
    return cargo.select(
        read.key("ctnNo", "firstVesselCode", "firstVoyage", "secondVesselCode", "secondVoyage", "billNo"), *read.texts(texts), route.alias("route"), F.col("_cargo.group").alias("cargo_group"),
        F.col("_cargo.match").alias("cargo_match"), *[number_of(read.text[c]).alias(c) for c in numbers], *read.times(times), read.record_hash(),
    )


def normalize_container_event(rows: DataFrame, asked: str = "asked_container") -> DataFrame:
    """History rows of the container named in ``asked``, which is part of the key: the code isn't interpreted and the time isn't known, so both say so."""
    texts = {"operateId": "event_code_raw", "vesselcode": "vessel_code", "voyage": "voyage", "cpcode": "terminal_code", "direct": "direction", "blNo": "bill_no"}
    rows = _have(rows, asked, "ctnno", *texts)
    read = _Read(rows, [asked, "ctnno", *texts], keep=[c for c in rows.columns if c != asked], also=[asked])
    return read.rows.select(
        read.key(asked, "vesselcode", "voyage", "cpcode", "operateId", "blNo"), F.coalesce(read.text["ctnno"], F.col(asked)).alias("container_no"), F.lit("UNKNOWN").alias("event_type"), F.lit(None).cast("timestamp").alias("event_time"),
        *read.texts(texts), F.lit("ediContainerlog").alias("event_source"), F.lit("unverified").alias("event_confidence"), read.record_hash(),
    )


def normalize_plan(rows: DataFrame) -> DataFrame:
    """Vessel plan snapshots; the estimate of arrival isn't part of the key, so a revised plan keeps it. The source's update time is its publish time."""
    rows = _have(rows, *PLAN_TEXTS, *PLAN_TIMES, "vesselEnName")
    read = _Read(rows, list(PLAN_TEXTS), list(PLAN_TIMES), names=["vesselEnName"])
    return read.rows.select(
        read.key("vesselUnCode", "voyage", "terminal", "vesselDirect", need_all=True), read.name["vesselEnName"].alias("vessel_en_name"), *read.texts(PLAN_TEXTS),
        *read.times(PLAN_TIMES), *read.times({"publishTime": "source_update_time"}), read.record_hash(),
    )


def normalize_notice(rows: DataFrame) -> DataFrame:
    """Container notices; the two container times belong to the key, the direction doesn't. Ports are sorted before they are hashed, so their order is no revision."""
    texts = {"vesselcode": "vessel_code", "voyage": "voyage", "matou": "terminal_code", "ioflag": "direction", "ediports": "ports_raw", "vesselowner": "vessel_operator"}
    rows = _have(rows, *texts, "ctnstart", "ctnend", "vesselename", "revtime")
    times = {"ctnstart": "ctn_start_time", "ctnend": "ctn_end_time", "revtime": "source_update_time"}
    rest = sorted(set(rows.columns) - {"ediports"})
    read = _Read(rows.withColumn("_rest", row_json(*rest)), list(texts), list(times), keep=rows.columns, names=["vesselename"], also=["_rest"])
    ports = F.array_join(F.array_sort(F.split(F.coalesce(read.text["ediports"], F.lit("")), r"[,;\s]+")), ",")
    return read.rows.withColumn("ports", ports).select(
        read.key("vesselcode", "voyage", "matou", "ctnstart", "ctnend", need_all=True), read.name["vesselename"].alias("vessel_en_name"), *read.texts(texts), *read.times(times),
        "ports", digest(F.concat_ws("|", "_rest", "ports")).alias("record_hash"),
    )


def split_extra(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Rows of a ``record map<string,string>`` column: each known field stripped (null is empty), unknown keys that have a value kept as ``extra``;
    ``row_hash`` covers both; rows without an ``id`` go."""
    extra = F.map_filter("record", lambda k, v: ~k.isin(*fields) & (filled(v) != ""))
    out = rows.withColumns({f: filled(F.col("record")[f]) for f in fields} | {"extra": F.map_from_entries(F.array_sort(F.map_entries(extra)))})
    return out.withColumn("row_hash", digest(F.to_json(F.struct(*[F.col(f) for f in sorted(fields)], "extra")))).filter("id <> ''").drop("record")


def json_each(rows: DataFrame, record: str, spark: SparkSession | None = None) -> DataFrame:
    """``rows`` with a row for each key of the variant object ``record``: key, value (variant), kind (type of the value), in order of keys.

    A lateral table function beside each row, so types and nesting stay as they are in the source. Rows whose record is no object have none.
    """
    each = (spark or rows.sparkSession).tvf.variant_explode(F.col(record).outer())
    return rows.lateralJoin(each).filter("key is not null").withColumn("kind", F.schema_of_variant("value")).drop("pos")


def _field(record: str, name: str) -> Column:
    """The field as text, stripped; missing and null are empty. Numbers and booleans are written as JSON writes them."""
    return filled(F.try_variant_get(F.col(record), f"$.{name}", "string"))


def _extra(record: str, known: list[str], filled_only: bool) -> Column:
    """Keys beside ``known`` (whatever their case) as a map of variants, so a number stays a number; null without any. ``filled_only`` leaves out null and empty values."""
    entries = F.map_entries(F.col(record).cast("map<string, variant>"))
    names = [k.lower() for k in known]
    kept = F.filter(entries, lambda e: ~F.lower(e["key"]).isin(*names))
    if filled_only:
        kept = F.filter(kept, lambda e: ~F.coalesce(F.is_variant_null(e["value"]), F.lit(True)) & (F.coalesce(F.try_variant_get(e["value"], "$", "string"), F.lit("x")) != ""))
    # Keys of an object are unique; to_json of a variant writes the keys of inner objects in order.
    listed = F.transform(kept, lambda e: F.struct(e["key"].alias("key"), F.to_json(e["value"]).alias("value")))
    text = F.array_join(F.transform(F.array_sort(listed), lambda e: F.concat(_quoted(e["key"]), F.lit(":"), e["value"])), ",")
    return F.when(F.size(listed) > 0, F.concat(F.lit("{"), text, F.lit("}")))


def _quoted(c: Column) -> Column:
    """Text as a JSON string."""
    whole = F.to_json(F.struct(c.alias("k")))
    return F.substr(whole, F.lit(6), F.length(whole) - 6)


#: Fields of a gate event as the source names them.
GATE_FIELDS = ("id", "vesselcode", "voyage", "ctnNo", "ctnSizeType", "ctnStatus", "billNo", "inGateTime", "outGateTime", "msgReceiveTime", "direct")


def normalize_gate_event(rows: DataFrame, record: str = "record", fields: tuple[str, ...] = GATE_FIELDS) -> DataFrame:
    """Gate events from a VARIANT ``record`` and the query they answer (direction, asked_vessel, asked_voyage): stripped fields, ``type`` and ``vesselcode`` of the query, its
    voyage where the row has none; unknown keys with a value as sorted JSON text in ``extra``, with their types; rows without an id go."""
    out = rows.select(
        _field(record, "id").alias("id"), F.col("direction").alias("type"), F.col("asked_vessel").alias("vesselcode"), F.coalesce(F.nullif(_field(record, "voyage"), F.lit("")), F.col("asked_voyage")).alias("voyage"),
        *[_field(record, f).alias(f) for f in fields if f not in ("id", "vesselcode", "voyage")], F.coalesce(_extra(record, [*fields, "type"], True), F.lit("")).alias("extra"),
    )
    return out.filter("id <> ''")


def normalize_container(rows: DataFrame, fields: list[str], record: str = "record") -> DataFrame:
    """Container rows from a VARIANT ``record``: stripped fields, all unknown keys as sorted JSON text in ``extra``, and ``row_hash`` over both; rows without an id go."""
    out = rows.select(*[_field(record, f).alias(f) for f in fields], F.coalesce(_extra(record, fields, False), F.lit("")).alias("extra"))
    return out.withColumn("row_hash", digest(F.to_json(F.struct(*[F.col(f) for f in sorted(fields)], "extra")))).filter("id <> ''")


def dead_letters(rows: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good, bad): a row that fails a check goes to ``bad`` with the first failed check's name and its JSON; the rest goes on."""
    reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()])
    marked = rows.withColumn("_reason", reason)
    return marked.filter("_reason is null").drop("_reason"), marked.filter("_reason is not null").select(F.col("_reason").alias("reason"), F.to_json(F.struct(*rows.columns)).alias("row_json"))
