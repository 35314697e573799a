"""V4 in full: which customers the dimension and the ledger do not share, found by bitmaps.

Each side is reduced to one bit per customer, in bitmaps of 32,768 neighbouring
customer numbers that are built on the map side, so that a customer's many
ledger rows are never shuffled to be counted once. Counts are the bits set.
Only where the two sides' bitmaps differ are customers looked at by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def number_of(column: str = "customer_id") -> Column:
    """The digits that end an identifier, as a number. Exact where they tell all customers apart (one prefix)."""
    return F.regexp_extract(column, "([0-9]{1,18})$", 1).try_cast("bigint")


def bitmaps(df: DataFrame, number: Column | None = None) -> DataFrame:
    """(bucket, bits): the customers of `df` as bitmaps; rows without a number have none."""
    n = number if number is not None else number_of()
    return (df.select(n.alias("_n")).where(F.col("_n").isNotNull())
            .groupBy(F.bitmap_bucket_number("_n").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias("bits")))


def distinct_customers(df: DataFrame, number: Column | None = None) -> DataFrame:
    """One row, n: how many different customers `df` has; `number` must tell them apart."""
    return bitmaps(df, number).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))


def customer_coverage(customers: DataFrame, ledger: DataFrame, number: Column | None = None) -> DataFrame:
    """V4: (dimension_customers, model_customers, passed), exact counts of both sides."""
    dim, mod = (distinct_customers(df, number).withColumnRenamed("n", name) for df, name in
                ((customers, "dimension_customers"), (ledger, "model_customers")))
    counts = dim.select("dimension_customers", mod.scalar().alias("model_customers"))
    return counts.withColumn("passed", F.col("dimension_customers") == F.col("model_customers"))


def customer_differences(customers: DataFrame, ledger: DataFrame, number: Column | None = None) -> DataFrame:
    """(customer_id, missing_in): every customer that only one side has; rows behind a failed V4.

    Only customers in bitmaps that differ are read by name, so where the sides agree nothing is shuffled but the bitmaps.
    """
    n = number if number is not None else number_of()
    left, right = bitmaps(customers, number), bitmaps(ledger, number)
    differ = (left.withColumnRenamed("bits", "a").join(right.withColumnRenamed("bits", "b"), "bucket", "full")
              .where(~F.col("a").eqNullSafe(F.col("b"))).select("bucket"))

    def named(df: DataFrame) -> DataFrame:
        rows = df.select("customer_id", F.bitmap_bucket_number(n).alias("bucket")).where(n.isNotNull())
        return rows.join(differ, "bucket", "left_semi").select("customer_id").distinct()

    both = named(customers).withColumn("_dim", F.lit(True)).join(named(ledger).withColumn("_mod", F.lit(True)), "customer_id", "full")
    return both.where(F.col("_dim").isNull() | F.col("_mod").isNull()).select(
        "customer_id", F.when(F.col("_dim").isNull(), "dimension").otherwise("model").alias("missing_in"))
