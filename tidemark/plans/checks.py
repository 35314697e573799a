"""Set-oriented validators over any ledger-shaped DataFrame.

Each check returns a summary DataFrame ``(check_name, passed, violations)``
and, where it helps, a ``*_violations`` function returning the offending
rows. Inputs only need the columns a check reads, so a check can run on a
stand-in table as well as on the full ledger. Monthly rollups have one row
per month; only those (never customer rows) go through an unpartitioned
window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas as S

SUMMARY_COLUMNS = ["check_name", "passed", "violations"]


def _money_sum(c) -> F.Column:
    return F.round(F.sum(c), 2)


def monthly_waterfall(ledger: DataFrame) -> DataFrame:
    """V1: per month, starting and ending MRR and the five category sums, exact."""
    cat = F.col("mrr_category")
    sums = [
        _money_sum(F.when(cat == name, F.col("mrr_change")).otherwise(F.lit(0))).alias(alias)
        for name, alias in zip(S.WATERFALL_CATEGORIES, WATERFALL_ALIASES)
    ]
    return ledger.groupBy("month_date").agg(
        _money_sum("prev_mrr").alias("starting_mrr"),
        _money_sum("current_mrr").alias("ending_mrr"),
        *sums,
    )


# Output names of the five category sums, in WATERFALL_CATEGORIES order.
WATERFALL_ALIASES = ["new_mrr", "expansion_mrr", "reactivation_mrr", "contraction_mrr", "churn_mrr"]


def _summary(name: str, bad: DataFrame) -> DataFrame:
    return bad.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(name).alias("check_name"), (F.col("violations") == 0).alias("passed"), "violations")


def _cents_apart(a, b) -> F.Column:
    """|a - b| rounded to the cent: exact for decimals, and free of binary
    noise when a stand-in table carries money as DOUBLE. NULL on one side counts
    as apart (the difference itself stays NULL)."""
    return F.round(F.abs(a - b), 2)


def _differ(a, b) -> F.Column:
    """Apart by a cent or more, or NULL on one side only."""
    return F.coalesce(_cents_apart(a, b) != 0, ~a.eqNullSafe(b))


def reconciliation_violations(waterfall: DataFrame) -> DataFrame:
    """V2 rows: months where start + movements and end differ by a cent or more."""
    expected = F.col("starting_mrr") + sum(F.col(a) for a in WATERFALL_ALIASES)
    return waterfall.select(
        "month_date", expected.alias("expected_ending_mrr"), "ending_mrr",
        _cents_apart(expected, F.col("ending_mrr")).alias("difference"),
    ).where(_differ(F.col("expected_ending_mrr"), F.col("ending_mrr")))


def check_reconciliation(ledger: DataFrame) -> DataFrame:
    """V2: the accounting identity holds to the cent in every month."""
    return _summary("mrr_reconciliation", reconciliation_violations(monthly_waterfall(ledger)))


def continuity_violations(ledger: DataFrame) -> DataFrame:
    """V3 rows: a month whose starting MRR differs from the previous row's ending
    MRR (adjacent rows of the monthly rollup; the first month has none)."""
    monthly = ledger.groupBy("month_date").agg(
        _money_sum("prev_mrr").alias("starting_mrr"), _money_sum("current_mrr").alias("ending_mrr"))
    by_month = Window.orderBy("month_date")  # one row per month
    return (
        monthly.select("month_date", "starting_mrr", F.lag("ending_mrr").over(by_month).alias("prior_ending_mrr"),
                       F.row_number().over(by_month).alias("_n"))
        .where((F.col("_n") > 1) & _differ(F.col("starting_mrr"), F.col("prior_ending_mrr"))).drop("_n")
    )


def check_continuity(ledger: DataFrame) -> DataFrame:
    """V3: month-over-month continuity of the MRR balance."""
    return _summary("mrr_continuity", continuity_violations(ledger))


def customer_count_pair(customers: DataFrame, ledger: DataFrame) -> DataFrame:
    """V4 detail: exact distinct customers on both sides, in one job."""
    dim = customers.agg(F.countDistinct("customer_id").alias("n")).select(F.lit("dimension").alias("side"), "n")
    mod = ledger.agg(F.countDistinct("customer_id").alias("n")).select(F.lit("model").alias("side"), "n")
    return dim.unionByName(mod)


def check_customer_counts(customers: DataFrame, ledger: DataFrame) -> DataFrame:
    """V4: distinct customers in the dimension equal distinct customers in the model."""
    pair = customer_count_pair(customers, ledger).agg(
        F.max(F.when(F.col("side") == "dimension", F.col("n"))).alias("dim"),
        F.max(F.when(F.col("side") == "model", F.col("n"))).alias("mod"),
    )
    return pair.select(
        F.lit("customer_counts").alias("check_name"),
        (F.col("dim") == F.col("mod")).alias("passed"),
        F.abs(F.col("dim") - F.col("mod")).alias("violations"),
    )


def orphan_customer_rows(ledger: DataFrame, customers: DataFrame) -> DataFrame:
    """V5 rows: ledger rows whose customer is not in the dimension."""
    return ledger.join(customers.select("customer_id"), "customer_id", "left_anti")


def orphan_plan_rows(ledger: DataFrame, plans: DataFrame) -> DataFrame:
    """V6 rows: ledger rows with a non-NULL current plan missing from the dimension."""
    return ledger.where(F.col("current_plan_id").isNotNull()).join(
        plans.select(F.col("plan_id").alias("current_plan_id")), "current_plan_id", "left_anti")


def _orphan_count(name: str, rows_per_key: DataFrame, parent_keys: DataFrame, key: str) -> DataFrame:
    """Anti join of per-key row counts (pre-aggregated, so a hot key is one row)."""
    n = rows_per_key.join(parent_keys, key, "left_anti").agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("violations"))
    return n.select(F.lit(name).alias("check_name"), (F.col("violations") == 0).alias("passed"),
                    "violations")


def check_orphan_customers(ledger: DataFrame, customers: DataFrame) -> DataFrame:
    """V5 summary: ledger rows whose customer is missing from the dimension."""
    per_key = ledger.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return _orphan_count("orphan_customers", per_key, customers.select("customer_id"), "customer_id")


def check_orphan_plans(ledger: DataFrame, plans: DataFrame) -> DataFrame:
    """V6 summary: ledger rows whose non-NULL current plan is missing."""
    per_key = ledger.where(F.col("current_plan_id").isNotNull()).groupBy("current_plan_id").agg(
        F.count(F.lit(1)).alias("n_rows"))
    return _orphan_count("orphan_plans", per_key,
                         plans.select(F.col("plan_id").alias("current_plan_id")), "current_plan_id")


def check_integrity(ledger: DataFrame, customers: DataFrame, plans: DataFrame) -> DataFrame:
    """V7: no orphan customers and no orphan plans."""
    parts = check_orphan_customers(ledger, customers).unionByName(check_orphan_plans(ledger, plans))
    return parts.agg(
        F.lit("referential_integrity").alias("check_name"),
        F.bool_and("passed").alias("passed"),
        F.sum("violations").alias("violations"),
    )


def run_checks(ledger: DataFrame, customers: DataFrame, plans: DataFrame) -> DataFrame:
    """V8: every check runs (none short-circuits), plus an ``all_checks`` row
    that ANDs them.

    The ledger is read by two aggregations, each with the columns it needs: one
    by month (a few hundred rows; V2 and V3) and one that counts rows by
    (customer, current plan) (V4-V7), both combined before their shuffle. Lazy:
    no job runs and nothing is stored, so a ledger that is not stored is built
    twice: pass the stored one (as ``jobs.validate`` does)."""
    by_month = Window.orderBy("month_date")  # one row per month
    expected = F.col("starting_mrr") + sum(F.col(a) for a in WATERFALL_ALIASES)
    balances = monthly_waterfall(ledger).select(
        _differ(expected, F.col("ending_mrr")).alias("unbalanced"),
        ((F.row_number().over(by_month) > 1)
         & _differ(F.col("starting_mrr"), F.lag("ending_mrr").over(by_month))).alias("broken"))
    money = balances.agg(F.count_if("unbalanced").alias("unbalanced"), F.count_if("broken").alias("broken"))

    pairs = ledger.groupBy("customer_id", "current_plan_id").agg(F.count(F.lit(1)).alias("n"))
    known_plans = plans.select(F.col("plan_id").alias("current_plan_id"), F.lit(True).alias("_plan")).distinct()
    per_customer = (pairs.join(known_plans, "current_plan_id", "left").groupBy("customer_id").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("current_plan_id").isNotNull() & F.col("_plan").isNull(), F.col("n")).otherwise(0)).alias("planless")))
    # V4 and V5 in one join: both sides hold each customer once
    dim_keys = customers.select("customer_id").distinct().withColumn("_dim", F.lit(True))
    keys = per_customer.join(dim_keys, "customer_id", "full").agg(
        F.count_if(F.col("_dim") & F.col("customer_id").isNotNull()).alias("dim"),
        F.count_if(F.col("n").isNotNull() & F.col("customer_id").isNotNull()).alias("mod"),
        F.coalesce(F.sum(F.when(F.col("_dim").isNull(), F.col("n")).otherwise(0) + F.coalesce("planless", F.lit(0))),
                   F.lit(0)).alias("orphans"))

    def rows(df: DataFrame, **violations) -> DataFrame:
        return df.select(F.inline(F.array(*[F.struct(F.lit(name).alias("check_name"), v.cast("bigint").alias("violations"))
                                            for name, v in violations.items()])))
    found = rows(money, mrr_reconciliation=F.col("unbalanced"), mrr_continuity=F.col("broken")).unionByName(
        rows(keys, customer_counts=F.abs(F.col("dim") - F.col("mod")), referential_integrity=F.col("orphans")))
    return with_overall(found.select("check_name", (F.col("violations") == 0).alias("passed"), "violations"))


def with_overall(parts: DataFrame) -> DataFrame:
    """Check rows plus an ``all_checks`` row, from one rollup over the check rows."""
    return parts.rollup("check_name").agg(
        F.bool_and("passed").alias("passed"), F.sum("violations").alias("violations")
    ).select(F.coalesce("check_name", F.lit("all_checks")).alias("check_name"), "passed",
             F.col("violations").cast("bigint").alias("violations"))


# The report's wording for each check (name, formula, tolerance).
REPORT_TEXT = [
    ("mrr_reconciliation", "MRR Accounting Equation Balance",
     "Starting MRR + New + Expansion + Reactivation - Contraction - Churn = Ending MRR",
     "$0.00 (Zero Cent Margin)"),
    ("mrr_continuity", "Month-over-Month MRR Continuity",
     "Current Starting MRR = Previous Ending MRR", "$0.00 (Zero Cent Margin)"),
    ("referential_integrity", "Referential Integrity Constraints",
     "Orphan customers count in movements = 0", "0 rows mismatch"),
    ("customer_counts", "Customer Count Consistency",
     "Distinct active customer counts match dimensions", "0 records offset"),
]


def validation_report(checks: DataFrame) -> DataFrame:
    """The status table, with statuses computed from ``run_checks`` output."""
    spark = checks.sparkSession
    text = spark.createDataFrame(
        REPORT_TEXT, "check_name string, validation_check string, constraint_formula string, tolerance string")
    return checks.join(F.broadcast(text), "check_name", "inner").select(
        "check_name", "validation_check", "constraint_formula", "tolerance",
        F.when(F.col("passed"), F.lit("PASSED")).otherwise(F.lit("FAILED")).alias("status"),
        "violations",
    )
