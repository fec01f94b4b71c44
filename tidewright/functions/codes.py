"""Container, vessel and cargo codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewright.functions.text import WHITE_CLASS, filled, normalize_name, stripped

#: TEU by the first character of a size code.
TEU_BY_SIZE = {"1": 0.5, "2": 1.0, "3": 1.5, "4": 2.0, "L": 2.25}
#: ISO 6346 letter values in alphabetical order; multiples of 11 are skipped.
ISO_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ISO_VALUES = (10, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 23, 24, 25, 26, 27, 28, 29, 30, 31, 32, 34, 35, 36, 37, 38)
#: A code made of these characters only stands for "none", and so does this vessel.
PLACEHOLDER_CHARACTERS = "0?/.· -_"
PLACEHOLDER_VESSEL = "FC0000000"


def teu(size_code: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in TEU_BY_SIZE.items() for x in pair])
    return table[F.upper(F.substring(F.trim(size_code), 1, 1))]


def iso6346_valid(c: Column) -> Column:
    """Four letters (the fourth U, J or Z), six digits and a check digit that agrees; null is not valid."""
    text = F.upper(stripped(c))
    values = F.create_map(*[x for k, v in zip(ISO_LETTERS + "0123456789", (*ISO_VALUES, *range(10)), strict=True) for x in (F.lit(k), F.lit(v))])
    total = F.aggregate(F.sequence(F.lit(1), F.lit(10)), F.lit(0), lambda acc, i: acc + values[F.substr(text, i, F.lit(1))] * F.pow(F.lit(2), i - 1).cast("int"))
    ok = F.when(text.rlike("^[A-Z]{3}[UJZ][0-9]{7}$"), total % 11 % 10 == F.substring(text, 11, 1).cast("int"))
    return F.coalesce(ok, F.lit(False))


def invalid_pair_reason(vessel: Column, voyage: Column) -> Column:
    """Why a vessel/voyage pair must not be asked for; empty if nothing is wrong. The first rule that fits counts. The reasons are fixed values."""
    v, y = filled(vessel), filled(voyage)
    placeholder = lambda c: F.translate(c, PLACEHOLDER_CHARACTERS, "") == ""
    return (
        F.when(v == "", "empty_vesselcode")
        .when((F.upper(v) == PLACEHOLDER_VESSEL) | placeholder(v), "placeholder_vesselcode")
        .when(y == "", "empty_voyage")
        .when(placeholder(y), "placeholder_voyage")
        .when(y.rlike(WHITE_CLASS), "voyage_contains_whitespace")
        .when(~y.rlike(r"^[\x00-\x7F]*$"), "voyage_non_ascii")
        .otherwise("")
    )


def vessel_prefix(c: Column) -> Column:
    code = F.upper(filled(c))
    return F.when(F.startswith(code, F.lit("UN")), "UN").when(F.startswith(code, F.lit("FC")), "FC").when(F.startswith(code, F.lit("CN")), "CN").otherwise("OTHER")


def _cargo(group: str, match: str) -> Column:
    return F.struct(F.lit(group).alias("group"), F.lit(match).alias("match"))


def classify_cargo(c: Column, exact: dict[str, str], patterns: list[tuple[str, str]]) -> Column:
    """struct(group, match): a normalized text by the dictionary, whose keys are normalized likewise (of keys that become one the last counts), else by
    the first pattern found in it (in order, any case), else UNKNOWN. The dictionary is one map, looked up by hash."""
    return classify_name(normalize_name(c), exact, patterns)


def classify_name(text: Column, exact: dict[str, str], patterns: list[tuple[str, str]]) -> Column:
    """As ``classify_cargo``, of a text that is normalized already."""
    out = F.when(text.isNull(), _cargo("UNKNOWN", "unknown"))
    known = {" ".join(key.upper().split()): group for key, group in exact.items()}
    if known:
        table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
        out = out.when(table[text].isNotNull(), F.struct(table[text].alias("group"), F.lit("exact").alias("match")))
    for pattern, group in patterns:
        out = out.when(text.rlike(f"(?i){pattern}"), _cargo(group, "regex"))
    return out.otherwise(_cargo("UNKNOWN", "unknown"))


def classify_vessel(name_cn: Column, name_en: Column, code: Column, imo: Column, mmsi: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Bucket of a pseudo vessel by ordered rules (field: cn, en or code; LIKE pattern; bucket); null where a real IMO or MMSI number is given, or no rule fits."""
    real = F.coalesce(F.trim(imo).rlike("^[0-9]{7}$"), F.lit(False)) | F.coalesce(F.trim(mmsi).rlike("^[0-9]{9}$"), F.lit(False))
    by = {"cn": F.upper(filled(name_cn)), "en": F.upper(filled(name_en)), "code": F.upper(filled(code))}
    out = F.when(real, F.lit(None).cast("string"))
    for field, pattern, bucket in rules:
        out = out.when(by[field].like(pattern.upper()), bucket)
    return out
