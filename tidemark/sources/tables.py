"""Typed readers, conformance with reject reporting, row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S


def conform(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Select ``schema``'s columns by name with a safe cast.

    Returns ``(ok, rejects)``: rows where every non-NULL input value casts, in
    the schema's types; and the other rows, as strings, with the list of
    columns whose value did not cast. One pass, no job is started here.
    """
    casts = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    bad = [
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(),
               F.lit(f.name))
        for f in schema.fields
    ]
    tagged = df.select(*casts, F.array_compact(F.array(*bad)).alias("_bad"),
                       *[F.col(f.name).cast("string").alias(f"_raw_{f.name}") for f in schema.fields])
    ok = tagged.where(F.size("_bad") == 0).select(*schema.fieldNames())
    rejects = tagged.where(F.size("_bad") > 0).select(
        *[F.col(f"_raw_{f.name}").alias(f.name) for f in schema.fields],
        F.col("_bad").alias("reject_columns"),
    )
    return ok, rejects


def conform_counts(df: DataFrame, schema: T.StructType) -> DataFrame:
    """(ok_rows, rejected_rows) of conforming ``df`` to ``schema``, in one pass."""
    bad = F.lit(False)
    for f in schema.fields:
        bad = bad | (F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
    return df.agg(F.count(F.when(~bad, F.lit(1))).alias("ok_rows"),
                  F.count(F.when(bad, F.lit(1))).alias("rejected_rows"))


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Rejected values per column: (column_name, rejects)."""
    return (rejects.select(F.explode("reject_columns").alias("column_name"))
            .groupBy("column_name").agg(F.count(F.lit(1)).alias("rejects")))


def _read(spark: SparkSession, path: str, schema: T.StructType, with_rejects: bool):
    ok, rejects = conform(spark.read.parquet(path), schema)
    return (ok, rejects) if with_rejects else ok


def read_plans(spark: SparkSession, path: str, with_rejects: bool = False):
    """Plan dimension in its declared types. Rows that do not cast are left
    out; with ``with_rejects`` the result is ``(ok, rejects)``."""
    return _read(spark, path, S.PLANS, with_rejects)


def read_customers(spark: SparkSession, path: str, with_rejects: bool = False):
    """Customer dimension; string dates become DATE (see ``read_plans``)."""
    return _read(spark, path, S.CUSTOMERS, with_rejects)


def read_events(spark: SparkSession, path: str, with_rejects: bool = False):
    """S3: event fact; string dates become DATE, floats DECIMAL(10,2) (see
    ``read_plans``)."""
    return _read(spark, path, S.EVENTS, with_rejects)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table, (table_name, row_count), in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class ResultTooLarge(RuntimeError):
    pass


def to_client(df: DataFrame, max_rows: int = 100_000):
    """A small result as a pandas frame for a client (a report, a chart).

    ``max_rows`` is the caller's bound: a larger result raises instead of being
    pulled through the driver, which never holds more than ``max_rows + 1`` rows. Ledgers belong in a table, not here."""
    pdf = df.limit(max_rows + 1).toPandas()
    if len(pdf) > max_rows:
        raise ResultTooLarge(f"result has more than {max_rows} rows; write it to a table instead")
    return pdf
