"""Named queries and the SQL that says the same, with helpers to compare them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.plans.bindings import sql, view
from tidewright.sources.sinks import shared_base

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Views:
    """Reads a binding or a table by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)

    def place(self, name: str) -> str:
        """A folder of this application and input that all executors share."""
        return f"{shared_base(self.spark)}/{self.spark.sparkContext.applicationId}-{name}-{hashlib.md5(self.sf_dir.encode()).hexdigest()}"

    def once(self, name: str, make: Callable[[], object]) -> object:
        """What ``make`` returns, made once per application and input."""
        key = self.spark.sparkContext.applicationId, self.sf_dir, name
        if key not in _MADE:
            _MADE[key] = make()
        return _MADE[key]

    def stored(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """What ``make`` returns, written once per application as a Parquet table that several queries read."""
        application = self.spark.sparkContext.applicationId
        key = application, self.sf_dir, name
        if key not in _STORED:
            path = self.place(name)
            make().write.mode("overwrite").parquet(path)
            _STORED[key] = path
        return self.spark.read.parquet(_STORED[key])


#: Paths of the tables that this process has written, by application, input and name.
_STORED: dict[tuple[str, str, str], str] = {}
_MADE: dict[tuple[str, str, str], object] = {}


def query(oracle: str | None = None):
    """Register the function under its name. It gets ``v``, which reads a binding or table by name."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if oracle:
            ORACLES[f.__name__] = sql(oracle)
        return f

    return register


def doubles(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Measures as doubles, rounded so that the order of a sum doesn't show."""
    return df.withColumns({n: F.round(F.col(n).cast("double"), digits) for n in names})


def longs(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})
