"""Cleaning and parsing of text fields; a value that cannot be read is null, never a default."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The time formats of the sources, in the order in which they are tried.
TIME_FORMATS = ("yyyyMMddHHmmss", "yyyyMMddHHmm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss")
#: What counts as white space at the ends of a field and inside names: ASCII, the four separators, next line, and the Unicode spaces.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: The same as a class of a regular expression.
WHITE_CLASS = r"[\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def stripped(c: Column) -> Column:
    """Without WHITE_SPACE at both ends."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def trimmed(c: Column) -> Column:
    """As ``stripped``, for a plain column or a lambda's variable: a trim by so many characters is slow, so only texts that begin or end with one of them are trimmed."""
    ends = F.substring(c, 1, 1).isin(*WHITE_SPACE) | F.substring(c, -1, 1).isin(*WHITE_SPACE)
    return F.when(ends, stripped(c)).otherwise(c)


def clean(c: Column) -> Column:
    """Stripped text; blank text is null."""
    return F.nullif(stripped(c), F.lit(""))


def filled(c: Column) -> Column:
    """Stripped text; null is empty."""
    return stripped(F.coalesce(c, F.lit("")))


def has_value(c: Column) -> Column:
    return F.coalesce(stripped(c.cast("string")) != "", F.lit(False))


def parse_time(c: Column) -> Column:
    """Timestamp (in the session's zone, UTC by convention) by the first of TIME_FORMATS whose shape the text has."""
    return time_of(clean(c))


def time_of(text: Column) -> Column:
    """As ``parse_time``, of text that is clean already. The shape is checked, so a plain cast reads it; a formatter is many times slower."""
    spread = F.regexp_replace(F.rpad(text, 14, "0"), r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3 $4:$5:$6")
    return F.when(text.rlike(r"^\d{4}-\d\d-\d\d[ T]\d\d:\d\d:\d\d$"), text.try_cast("timestamp")).when(text.rlike(r"^\d{12}(\d\d)?$"), spread.try_cast("timestamp"))


def parse_number(c: Column) -> Column:
    """Finite double, or null."""
    return number_of(clean(c))


def number_of(text: Column) -> Column:
    """As ``parse_number``, of text that is clean already."""
    n = text.try_cast("double")
    return F.when(~F.isnan(n) & (F.abs(n) != float("inf")), n)


def normalize_name(c: Column) -> Column:
    return F.nullif(F.btrim(F.regexp_replace(F.upper(c), f"{WHITE_CLASS}+", " ")), F.lit(""))


def row_json(*names: str) -> Column:
    """Key-sorted JSON of the columns."""
    return F.to_json(F.struct(*[F.col(n) for n in sorted(names)]))


def digest(c: Column) -> Column:
    return F.sha2(c, 256)


def business_key(parts: list[Column], row: Column, need_all: bool = False) -> Column:
    """SHA-256 of the cleaned parts joined by ``|``; of the whole ``row`` text when all parts are empty, or, with ``need_all``, any is."""
    return key_of([clean(p.cast("string")) for p in parts], row, need_all)


def key_of(given: list[Column], row: Column, need_all: bool = False) -> Column:
    """As ``business_key``, of parts that are clean already."""
    missing = [g.isNull() for g in given]
    use_row = missing[0]
    for m in missing[1:]:
        use_row = (use_row | m) if need_all else (use_row & m)
    return digest(F.when(use_row, row).otherwise(F.concat_ws("|", *[F.coalesce(g, F.lit("")) for g in given])))


def flow_date(c: Column) -> Column:
    """Date of a raw gate time: ``yyyy-MM-dd...`` or ``yyyyMMdd...``, else null."""
    text = F.trim(c)
    digits = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    return F.when(F.substring(text, 5, 1) == "-", F.substring(text, 1, 10).try_cast("date")).when(text.rlike(r"^\d{8}"), digits.try_cast("date"))


def readable_time(c: Column) -> Column:
    """14- and 12-digit times as ``yyyy-MM-dd HH:mm[:ss]``; other text as it is."""
    return F.when(c.rlike(r"^\d{14}$"), F.regexp_replace(c, r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3 $4:$5:$6")).when(c.rlike(r"^\d{12}$"), F.regexp_replace(c, r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3 $4:$5")).otherwise(c)


def week_start(c: Column) -> Column:
    """Monday of the ISO week."""
    return F.date_trunc("week", c).cast("date")


def month_day_near(c: Column, now: Column) -> Column:
    """``M-d H:mm`` without a year (one or two digits, any white space between), in the year that puts it nearest to ``now``, of equal ones the earlier;
    ``01-01 00:00`` means unknown, a 29 February falls only in leap years."""
    text = F.trim(c)
    parts = [F.regexp_extract(text, r"^(\d{1,2})-(\d{1,2})\s+(\d{1,2}):(\d{2})$", i + 1) for i in range(4)]
    month, day, hour, minute = (F.lpad(p, 2, "0") for p in parts)
    moment = F.concat(month, F.lit("-"), day, F.lit(" "), hour, F.lit(":"), minute)
    tries = F.array(*[F.try_to_timestamp(F.concat((F.year(now) + k).cast("string"), F.lit("-"), moment), F.lit("yyyy-MM-dd HH:mm")) for k in (-1, 0, 1)])
    gaps = F.transform(F.filter(tries, lambda t: t.isNotNull()), lambda t: F.struct(F.abs(F.unix_timestamp(t) - F.unix_timestamp(now)).alias("gap"), t.alias("t")))
    return F.when((parts[3] != "") & (moment != "01-01 00:00"), F.array_min(gaps)["t"])


def before(c: Column, mark: str) -> Column:
    """Text before the first ``mark`` (a vessel before ``/``, a ship's name before ``(``)."""
    return F.trim(F.substring_index(c, mark, 1))


def parse_as_of(value: str | None) -> dt.datetime | None:
    """A cutoff given as an argument: a date is the inclusive end of that UTC day; ISO text with Z or an offset is taken to UTC."""
    if value is None or not value.strip():
        return None
    value = value.strip()
    if len(value) == 10:
        return dt.datetime.combine(dt.date.fromisoformat(value), dt.time.max)
    at = dt.datetime.fromisoformat(value.replace("Z", "+00:00"))
    return at.astimezone(dt.timezone.utc).replace(tzinfo=None) if at.tzinfo else at


def model_version_as_of(version: str, as_of: dt.datetime | None) -> str:
    return version if as_of is None else f"{version}@as_of={as_of.replace(tzinfo=dt.timezone.utc).isoformat()}"
