"""M1, M2, F3 from file statistics: the first and last date of stored events without reading them.

Parquet footers hold the least and largest value of a column in each row
group. Spark's second-generation Parquet reader answers MIN, MAX and COUNT from
them when nothing is filtered; the session's default reader does not. The
bounds are therefore read in a session of their own (same Spark context) that
uses it, so that nobody else's settings change. They are two dates, taken
once and used as constants in every plan that needs the last month.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import month_of


def _footer_session(spark: SparkSession) -> SparkSession:
    other = spark.newSession()
    other.conf.set("spark.sql.sources.useV1SourceList", "")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return other


def stored_range(spark: SparkSession, path: str, column: str = "event_date") -> DataFrame:
    """(least, largest, n_rows) of a date, number or boolean column of the Parquet files below `path`, from their footers."""
    found = _footer_session(spark).read.parquet(path).agg(F.min(column).alias("least"), F.max(column).alias("largest"),
                                                          F.count(F.lit(1)).alias("n_rows"))
    return found.select("least", "largest", F.greatest("n_rows", F.lit(0)).alias("n_rows"))  # files without row groups answer null


class MonthBounds:
    """M1 of stored events: first and last event month as dates (None without events)."""

    def __init__(self, spark: SparkSession, path: str, column: str = "event_date"):
        row = stored_range(spark, path, column).select(month_of("least").alias("a"), month_of("largest").alias("b"), "n_rows").first()
        self.first_month: dt.date | None = row["a"]
        self.last_month: dt.date | None = row["b"]
        self.n_rows: int = row["n_rows"]
        self._spark = spark

    def end(self) -> Column:
        """The last month as a constant, for `segments`, `asof_snapshot` and the like in place of a scan."""
        return F.lit(self.last_month).cast("date")

    def spine(self) -> DataFrame:
        """M2: every month from the first to the last, inclusive; no rows without events."""
        months = F.sequence(F.lit(self.first_month).cast("date"), self.end(), F.expr("INTERVAL 1 MONTH"))
        return self._spark.range(1).select(F.explode(months).alias("month_date"))

    def options(self) -> DataFrame:
        """the months, newest first."""
        return self.spine().orderBy(F.col("month_date").desc())
