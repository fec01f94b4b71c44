"""The rules that people ask for in SQL, as temporary SQL functions: plain expressions, so Spark inlines them into the query's plan."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidewright.functions.codes import ISO_LETTERS, ISO_VALUES, PLACEHOLDER_CHARACTERS, PLACEHOLDER_VESSEL

_CODE, _V, _Y = "upper(trim(value))", "trim(coalesce(vessel, ''))", "trim(coalesce(voyage, ''))"
_VALUES = ", ".join(map(str, (*ISO_VALUES, *range(10))))
_TOTAL = " + ".join(f"element_at(array({_VALUES}), locate(substr({_CODE}, {i + 1}, 1), '{ISO_LETTERS}0123456789')) * {2**i}" for i in range(10))
_ISO6346 = f"CASE WHEN {_CODE} RLIKE '^[A-Z][A-Z][A-Z][UJZ][0-9]+$' AND length({_CODE}) = 11 THEN CAST(({_TOTAL}) % 11 % 10 = CAST(substr({_CODE}, 11, 1) AS INT) AS INT) ELSE 0 END"
_SPACES = "concat(' ', char(9), char(10), char(11), char(12), char(13))"
_REASON = f"""CASE WHEN {_V} = '' THEN 'empty_vesselcode' WHEN upper({_V}) = '{PLACEHOLDER_VESSEL}' OR translate({_V}, '{PLACEHOLDER_CHARACTERS}', '') = '' THEN 'placeholder_vesselcode'
  WHEN {_Y} = '' THEN 'empty_voyage' WHEN translate({_Y}, '{PLACEHOLDER_CHARACTERS}', '') = '' THEN 'placeholder_voyage' WHEN translate({_Y}, {_SPACES}, '') <> {_Y} THEN 'voyage_contains_whitespace'
  WHEN octet_length({_Y}) <> char_length({_Y}) THEN 'voyage_non_ascii' ELSE '' END"""


def register(spark: SparkSession) -> None:
    """``iso6346_valid(text)``: 1 or 0; ``gate_history_invalid_reason(vessel, voyage)``: empty where nothing is wrong. For this session."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION iso6346_valid(value STRING) RETURNS INT RETURN {_ISO6346}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION gate_history_invalid_reason(vessel STRING, voyage STRING) RETURNS STRING RETURN {_REASON}")
