import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewright.functions import codes, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_parse_number(spark):
    got = [one(spark, text.parse_number(F.lit(v))) for v in (" 12.5 ", "bad", "nan", "inf", "1_0", "", None)]
    assert got == [12.5, None, None, None, None, None, None]


def test_parse_time(spark):
    got = [one(spark, text.parse_time(F.lit(v))) for v in ("20260801000000", "202608010102", "2026-08-01 01:02:03", "2026-08-01T01:02:03", "not-a-date", "20261301000000", " ")]
    assert got[:4] == [dt.datetime(2026, 8, 1), dt.datetime(2026, 8, 1, 1, 2), dt.datetime(2026, 8, 1, 1, 2, 3), dt.datetime(2026, 8, 1, 1, 2, 3)] and got[4:] == [None] * 3


def test_clean_and_names(spark):
    assert one(spark, text.clean(F.lit("  "))) is None and one(spark, text.normalize_name(F.lit(" TEST　 ship "))) == "TEST SHIP"


def test_iso6346(spark):
    got = [one(spark, codes.iso6346_valid(F.lit(v))) for v in ("CSQU3054383", "ABCU0000017", "ABCU0000018", "not-a-container", None)]
    assert got == [True, True, False, False, False]


@pytest.mark.parametrize("pair, reason", [(("0", "2501"), "placeholder_vesselcode"), (("UN1", "/"), "placeholder_voyage"), (("XX123", "2501E"), ""), (("FC0000000", "2502E"), "placeholder_vesselcode"), (("", "1"), "empty_vesselcode"), (("UN1", " "), "empty_voyage"), (("UN1", "25 01"), "voyage_contains_whitespace"), (("UN1", "２５"), "voyage_non_ascii")])
def test_invalid_pairs(spark, pair, reason):
    assert one(spark, codes.invalid_pair_reason(F.lit(pair[0]), F.lit(pair[1]))) == reason


def test_cargo(spark):
    got = [one(spark, codes.classify_cargo(F.lit(v), {"STEEL": "METAL"}, [("frozen|fish", "FOOD")]))["group"] for v in ("  Steel  ", "Frozen fish", "unclassified cargo", None)]
    assert got == ["METAL", "FOOD", "UNKNOWN", "UNKNOWN"]


def test_pseudo_vessels(spark):
    rules = [("en", "%TRUCK%", "TRUCK"), ("code", "XX%", "POOL")]
    classify = lambda en, code, imo: one(spark, codes.classify_vessel(F.lit(None).cast("string"), F.lit(en), F.lit(code), F.lit(imo).cast("string"), F.lit(None).cast("string"), rules))
    assert [classify("a truck", "XX1", None), classify("b", "xx1", "12"), classify("truck", "XX", "1234567"), classify("b", "c", None)] == ["TRUCK", "POOL", None, None]


def test_teu_and_prefix(spark):
    assert [one(spark, codes.teu(F.lit(v))) for v in ("22G1", "45GP", "L5G1", "12", "XX", None)] == [1.0, 2.0, 2.25, 0.5, None, None]
    assert [one(spark, codes.vessel_prefix(F.lit(v))) for v in ("UN1", "fc2", "CN3", "XX", None)] == ["UN", "FC", "CN", "OTHER", "OTHER"]


def test_gate_times(spark):
    assert [one(spark, text.flow_date(F.lit(v))) for v in ("202608011230", "2026-08-01 12", "bad", None)] == [dt.date(2026, 8, 1), dt.date(2026, 8, 1), None, None]
    assert [one(spark, text.readable_time(F.lit(v))) for v in ("20260801123059", "202608011230", "x")] == ["2026-08-01 12:30:59", "2026-08-01 12:30", "x"]
    assert one(spark, text.week_start(F.lit(dt.date(2026, 1, 11)))) == dt.date(2026, 1, 5)


def test_month_day_without_a_year(spark):
    now = F.lit(dt.datetime(2026, 1, 3))
    got = [one(spark, text.month_day_near(F.lit(v), now)) for v in ("12-30 10:00", "01-05 08:00", "01-01 00:00", "02-29 00:00", "bad", None)]
    assert got == [dt.datetime(2025, 12, 30, 10), dt.datetime(2026, 1, 5, 8), None, None, None, None]


def test_cutoffs():
    assert text.parse_as_of("2026-01-31") == dt.datetime(2026, 1, 31, 23, 59, 59, 999999) and text.parse_as_of("2026-01-31T10:00:00+08:00") == dt.datetime(2026, 1, 31, 2) and text.parse_as_of(None) is None
    with pytest.raises(ValueError):
        text.parse_as_of("soon")
    assert text.model_version_as_of("v1", text.parse_as_of("2026-01-31")) == "v1@as_of=2026-01-31T23:59:59.999999+00:00"


def test_business_keys(spark):
    key = lambda *parts, all_=False: one(spark, text.business_key([F.lit(p).cast("string") for p in parts], F.lit("row"), all_))
    assert key("a", " b ") == key("a", "b") != key("a", None) and key(None, " ") == one(spark, F.sha2(F.lit("row"), 256)) == key("a", None, all_=True)


def test_white_space_of_every_kind(spark):
    """Ends of fields, names, keys and reasons take the same characters for white space as Python's strip."""
    every = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
    assert set(text.WHITE_SPACE) == set(every)
    rows = [(f"{c}a{c}{c}B{c}", c) for c in every] + [(f"{every}20260801000000{every}", every), (f"{every}12.5{every}", every), ("​x", "​")]
    df = spark.createDataFrame(rows, "c string, w string")
    got = df.select(text.clean(F.col("c")).alias("clean"), text.clean(F.col("w")).alias("blank"), text.filled(F.col("c")).alias("filled"), text.has_value(F.col("w")).alias("has"), text.normalize_name(F.col("c")).alias("name"), text.parse_time(F.col("c")).alias("t"), text.parse_number(F.col("c")).alias("n"), codes.invalid_pair_reason(F.lit("UN1"), F.col("c")).alias("reason")).collect()
    for (c, w), r in zip(rows, got, strict=True):
        assert (r["clean"], r["filled"], r["blank"], r["has"]) == (c.strip() or None, c.strip(), w.strip() or None, bool(w.strip()))
        assert r["name"] == " ".join(c.upper().split())
    assert all(r["reason"] == "voyage_contains_whitespace" for r in got[: len(every)]) and got[-1]["reason"] == "voyage_non_ascii"
    assert got[-3]["t"] == dt.datetime(2026, 8, 1) and got[-2]["n"] == 12.5


def test_times_read_by_shape_are_those_of_the_formats(spark):
    texts = ["20240229101500", "202402291015", "2024-02-29 10:15:00", "2024-02-29T10:15:00", "20230229101500", "202313011015", "2024-02-29 24:00:00", "2024-02-29 10:15:60", "2024-02-29 10:15", "2024-02-29", "2024022910150", "20240229101500Z"]
    texts += ["0000-02-29 00:00:00", "000002290000", "99991231235959", "2024-2-29 10:15:00", "+2024-02-29 10:15:00", "\u0662\u0660240229101500", "\u30002024-02-29 10:15:00\r\n", "", " ", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    shapes = (r"^\d{14}$", r"^\d{12}$", r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$", r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d$")
    clean = text.clean(F.col("t"))
    by_format = F.coalesce(*[F.when(clean.rlike(s), F.try_to_timestamp(clean, F.lit(f))) for s, f in zip(shapes, text.TIME_FORMATS, strict=True)])
    assert rows.filter(~text.parse_time(F.col("t")).eqNullSafe(by_format)).collect() == []
    assert rows.filter(text.parse_time(F.col("t")).isNotNull()).count() >= 6
    assert rows.filter(~text.trimmed(F.col("t")).eqNullSafe(text.stripped(F.col("t")))).collect() == []


def test_normalizers_clean_each_text_once(spark):
    from tidewright.operators import normalize

    rows = spark.createDataFrame([(" a ", "b")], "vesselUnCode string, voyage string")
    for made in (normalize.normalize_plan(rows), normalize.normalize_vgm(rows), normalize.normalize_transshipment(rows, {}, [])):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Some(\t") <= 4 and plan.count("try_cast") < 30 and "gettimestamp" not in plan.lower()
