"""Map the driver's TPC-H-like tables onto the three model inputs.

orders -> subscription events (one order = one event), customer + nation ->
customer dimension, order priorities -> plan dimension. Everything is plain
projection, one grouped aggregate (signup date) and the lifecycle rule that
derives ``event_type`` from the ordered amounts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.plans.lifecycle import derive_event_type

# Plan price by the first character of the order priority.
PRICE_BY_PRIORITY = {"1": 199, "2": 99, "3": 49, "4": 29}
DEFAULT_PRICE = 19
# Account-balance limits of the SMB and Mid-Market sizes.
SMB_BELOW = 4500
MID_MARKET_BELOW = 8350


_SCHEMAS: dict[str, T.StructType] = {}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a driver table; its schema is inferred once per path (inference runs a
    job) and given explicitly afterwards."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _customer_key(c) -> F.Column:
    return F.concat(F.lit("cust_"), F.lpad(F.col(c).cast("string"), 9, "0"))


def _price(priority) -> F.Column:
    first = F.substring(F.col(priority), 1, 1)
    expr = F.lit(DEFAULT_PRICE)
    for digit, price in reversed(list(PRICE_BY_PRIORITY.items())):
        expr = F.when(first == digit, F.lit(price)).otherwise(expr)
    return expr.cast(S.MONEY)


def plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    return (
        o.select("o_orderpriority").distinct()
        .select(
            F.col("o_orderpriority").alias("plan_id"),
            F.substring("o_orderpriority", 3, 1 << 20).alias("plan_name"),
            _price("o_orderpriority").alias("monthly_price"),
            F.lit("monthly").alias("billing_cycle"),
        )
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer; the signup date is the first order's (NULL without orders)."""
    c, n, o = (_read(spark, sf_dir, t) for t in ("customer", "nation", "orders"))
    first = o.groupBy("o_custkey").agg(F.min("o_orderdate").cast("date").alias("signup_date"))
    size = (
        F.when(F.col("c_acctbal") < SMB_BELOW, F.lit("SMB"))
        .when(F.col("c_acctbal") < MID_MARKET_BELOW, F.lit("Mid-Market"))
        .otherwise(F.lit("Enterprise"))
    )
    return (
        c.join(n, c.c_nationkey == n.n_nationkey, "inner")
        .join(first, c.c_custkey == first.o_custkey, "left")
        .select(
            _customer_key("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            "signup_date",
            F.col("n_name").alias("country"),
            F.col("c_mktsegment").alias("industry"),
            size.alias("company_size"),
        )
    )


def supplier_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of another table in the customers' form: a parent that lacks most customers."""
    return _read(spark, sf_dir, "supplier").select(_customer_key("s_suppkey").alias("customer_id"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without ``event_type``: status F cancels (amount 0), and a cancel
    on an even order key also drops the plan."""
    o = _read(spark, sf_dir, "orders")
    cancel = F.col("o_orderstatus") == "F"
    return o.select(
        F.concat(F.lit("evt_"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("event_id"),
        _customer_key("o_custkey").alias("customer_id"),
        F.when(cancel & (F.col("o_orderkey") % 2 == 0), F.lit(None).cast("string"))
        .otherwise(F.col("o_orderpriority")).alias("plan_id"),
        F.col("o_orderdate").cast("date").alias("event_date"),
        F.when(cancel, F.lit(0).cast(S.MONEY)).otherwise(_price("o_orderpriority"))
        .alias("monthly_amount"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the input schema's column order, ``event_type`` derived by L1."""
    return derive_event_type(raw_events(spark, sf_dir)).select(*S.EVENTS.fieldNames())


def model_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the movement model reads them: it never reads ``event_type``, so the
    (sequential) derivation of that column is left out."""
    return raw_events(spark, sf_dir)


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows at other times than the events': one per order line, its customer and the day it was shipped."""
    o, line = _read(spark, sf_dir, "orders"), _read(spark, sf_dir, "lineitem")
    return line.join(o, line.l_orderkey == o.o_orderkey).select(
        _customer_key("o_custkey").alias("customer_id"), "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("shipped"))


def inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(plans, customers, events)."""
    return plans(spark, sf_dir), customers(spark, sf_dir), events(spark, sf_dir)
