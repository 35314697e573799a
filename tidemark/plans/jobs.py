"""The two batch jobs: refresh (load, check, publish, build the ledger) and validate.

``refresh`` reads the three inputs with their declared types, refuses rows that
do not cast, checks every declared constraint, publishes the inputs as a new
version (listed only after all checks pass), writes the ledger of that version
partitioned by month and registers temporary views; the version becomes
visible only after its ledger is stored (and, optionally, validated). ``validate`` runs every
validator on a published version and returns the summary DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators.movement import month_close, movements_of_closes
from tidemark.plans import checks as V
from tidemark.plans import quality as Q
from tidemark.sources import publish as P
from tidemark.sources.clustered import Clustering, read_clustered, write_clustered
from tidemark.sources.stats import MonthBounds
from tidemark.sources.tables import conform

LEDGER = "ledger"
CLOSES = "closes"


class RejectedRows(RuntimeError):
    pass


def _conformed(spark: SparkSession, path: str, schema) -> tuple[DataFrame, DataFrame]:
    return conform(spark.read.parquet(path), schema)


def refresh(spark: SparkSession, plans_path: str, customers_path: str, events_path: str, base: str,
            expected_plans: int | None = None, validate: bool = False, partitions: int | None = None) -> str:
    """Load, check and store the inputs, build and store the ledger in the same
    version, optionally validate it, and only then list the version. Returns
    the version. Raises when rows do not cast, a constraint fails or (with
    ``validate``) a validator fails; nothing becomes visible in that case.
    ``partitions`` (default: ``spark.sql.shuffle.partitions``) sizes the stages that build and write the ledger:
    customers and month-close rows are stored in that many buckets by customer, from which this
    and every later ledger is built without a shuffle of either."""
    buckets = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    layouts = {"customers": Clustering("customer_id", buckets), CLOSES: Clustering("customer_id", buckets, ("customer_id", "month_date"))}
    loaded = {
        "plans": _conformed(spark, plans_path, S.PLANS),
        "customers": _conformed(spark, customers_path, S.CUSTOMERS),
        "events": _conformed(spark, events_path, S.EVENTS),
    }
    rejected = Q.union_all([rej.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("t"), "n")
                            for name, (_, rej) in loaded.items()]).where(F.col("n") > 0).collect()
    if rejected:
        raise RejectedRows(", ".join(f"{r.t}: {r.n} rows did not cast" for r in rejected))
    tables = {name: ok for name, (ok, _) in loaded.items()}

    def constraints(stored: dict[str, DataFrame]) -> DataFrame:
        return Q.check_inputs(stored["plans"], stored["customers"], stored["events"], expected_plans)

    def built(stored: dict[str, DataFrame]) -> dict:
        closes = month_close(stored["events"])

        def ledger(path: str) -> None:
            version_path = path.removesuffix(f"/{LEDGER}")
            stored_closes = read_clustered(spark, f"{version_path}/{CLOSES}", layouts[CLOSES])
            end = MonthBounds(spark, f"{version_path}/events").end()
            P.write_ledger(movements_of_closes(stored_closes, stored["customers"], stored["plans"], end, True, partitions), path, by_year=True)
        return {CLOSES: lambda path: write_clustered(closes, path, layouts[CLOSES]), LEDGER: ledger}

    def ledger_checks(stored: dict[str, DataFrame]) -> DataFrame:
        return V.run_checks(stored[LEDGER], stored["customers"], stored["plans"])

    version = P.publish(spark, tables, base, checks=constraints, derived=built, clustered=layouts,
                        post_checks=ledger_checks if validate else None)
    register(spark, base, version)
    return version


def register(spark: SparkSession, base: str, version: str | None = None) -> None:
    """Temporary views over a published version: dim_plans, dim_customers,
    subscription_events and mrr_movements."""
    v = version or P.current_version(spark, base)
    P.register_views({
        "dim_plans": P.read_published(spark, base, "plans", v),
        "dim_customers": P.read_published(spark, base, "customers", v),
        "subscription_events": P.read_published(spark, base, "events", v),
        "mrr_movements": P.read_published(spark, base, LEDGER, v),
    })


def validate(spark: SparkSession, base: str, version: str | None = None) -> DataFrame:
    """All validators on the stored ledger of a published version."""
    v = version or P.current_version(spark, base)
    return V.run_checks(P.read_published(spark, base, LEDGER, v),
                        P.read_published(spark, base, "customers", v),
                        P.read_published(spark, base, "plans", v))
