"""Declared constraints and lifecycle rules as data checks.

Spark tables enforce no keys or CHECKs, so each constraint becomes a query
that counts its violations. Summaries share ``(rule, violations, passed)``.
Key checks group by the key with partial aggregation (a hot key is combined
on the map side); foreign-key checks are anti joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators.sequence import ordered_lag
from tidemark.plans.lifecycle import ID_PREFIX, ORDER, day_cut


def _rule(name: str, violations: DataFrame) -> DataFrame:
    """Summary row from a one-row DataFrame with a ``violations`` column."""
    return violations.select(F.lit(name).alias("rule"), F.col("violations").cast("bigint"),
                             (F.col("violations") == 0).alias("passed"))


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys present more than once, with their counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_unique(df: DataFrame, key: str, rule: str) -> DataFrame:
    """Primary key = unique and not NULL. Violations = duplicated key
    values + rows with a NULL key. One pass: rows are counted per key (the
    NULL key is one group), then the per-key counts are summarized."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    k = F.col(key)
    return _rule(rule, per_key.agg(
        (F.count(F.when(k.isNotNull() & (F.col("n") > 1), F.lit(1)))
         + F.coalesce(F.sum(F.when(k.isNull(), F.col("n"))), F.lit(0))).alias("violations")))


def check_not_null(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    """C4: one pass counting NULLs in every listed column; one row per column."""
    counts = df.agg(*[F.sum(F.when(F.col(c).isNull(), F.lit(1)).otherwise(F.lit(0))).alias(c)
                      for c in columns])
    pairs = F.array(*[F.struct(F.lit(f"{table}.{c}.not_null").alias("rule"),
                               F.col(c).cast("bigint").alias("violations")) for c in columns])
    return counts.select(F.inline(pairs)).select(
        "rule", F.coalesce("violations", F.lit(0)).alias("violations"),
        (F.coalesce("violations", F.lit(0)) == 0).alias("passed"))


def check_domain(df: DataFrame, column: str, values: list[str], rule: str) -> DataFrame:
    """Values outside the allowed set (NULL passes, as with SQL CHECK)."""
    return _rule(rule, _count(df.where(F.col(column).isNotNull() & ~F.col(column).isin(values))))


def check_min(df: DataFrame, column: str, lowest, rule: str) -> DataFrame:
    """Values below a lower bound."""
    return _rule(rule, _count(df.where(F.col(column) < F.lit(lowest))))


def check_range(df: DataFrame, column: str, lowest=None, highest=None, rule: str = "") -> DataFrame:
    """C8 in general form: values outside [lowest, highest] (either bound optional)."""
    cond = F.lit(False)
    if lowest is not None:
        cond = cond | (F.col(column) < F.lit(lowest))
    if highest is not None:
        cond = cond | (F.col(column) > F.lit(highest))
    return _rule(rule or f"{column}.range", _count(df.where(cond)))


def check_fk(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, rule: str) -> DataFrame:
    """Non-NULL child keys missing from the parent. Child rows are first
    counted per key (partial aggregation collapses a hot key on the map side),
    then the per-key counts are anti-joined with the parent keys."""
    keys = parent.select(F.col(parent_key).alias(child_key))
    per_key = child.where(F.col(child_key).isNotNull()).groupBy(child_key).agg(
        F.count(F.lit(1)).alias("n"))
    missing = per_key.join(keys, child_key, "left_anti")
    return _rule(rule, missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")))


def check_row_count(df: DataFrame, expected: int, rule: str) -> DataFrame:
    """C11: the table has exactly ``expected`` rows; violations = |difference|."""
    return _rule(rule, df.agg(F.abs(F.count(F.lit(1)) - F.lit(expected)).alias("violations")))


def row_rules(df: DataFrame, table: str, not_null: list[str], domains: dict[str, list[str]] | None = None,
              minimums: dict[str, object] | None = None) -> DataFrame:
    """C4-C8 for one table in a single aggregation: NULLs per column, values
    outside each domain (NULL passes), values below each minimum; one row
    per rule."""
    domains, minimums = domains or {}, minimums or {}
    rules = [(f"{table}.{c}.not_null", F.col(c).isNull()) for c in not_null]
    rules += [(f"{table}.{c}.domain", F.col(c).isNotNull() & ~F.col(c).isin(v)) for c, v in domains.items()]
    rules += [(f"{table}.{c}.min", F.col(c) < F.lit(v)) for c, v in minimums.items()]
    counts = df.agg(*[F.count(F.when(cond, F.lit(1))).alias(f"_r{i}") for i, (_, cond) in enumerate(rules)])
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"_r{i}").cast("bigint").alias("violations"))
                      for i, (name, _) in enumerate(rules)])
    return counts.select(F.inline(pairs)).select("rule", "violations", (F.col("violations") == 0).alias("passed"))


def check_inputs(plans: DataFrame, customers: DataFrame, events: DataFrame,
                 expected_plans: int | None = None) -> DataFrame:
    """All declared constraints of the three inputs, one row per rule: one
    aggregation per table for the row-level rules, one grouped count per key,
    one pre-aggregated anti join per foreign key."""
    parts = [
        check_unique(plans, "plan_id", "plans.plan_id.unique"),
        check_unique(customers, "customer_id", "customers.customer_id.unique"),
        check_unique(events, "event_id", "events.event_id.unique"),
        row_rules(plans, "plans", S.NOT_NULL["plans"], {"billing_cycle": S.BILLING_CYCLES}),
        row_rules(customers, "customers", S.NOT_NULL["customers"], {"company_size": S.COMPANY_SIZES}),
        row_rules(events, "events", S.NOT_NULL["events"], {"event_type": S.EVENT_TYPES},
                  {"monthly_amount": 0}),
        check_fk(events, customers, "customer_id", "customer_id", "events.customer_id.fk"),
        check_fk(events, plans, "plan_id", "plan_id", "events.plan_id.fk"),
    ]
    if expected_plans is not None:
        parts.append(check_row_count(plans, expected_plans, "plans.row_count"))
    return union_all(parts)


# ------------------------------------------------------------- lifecycle (L2/L3)

def lifecycle_violations(events: DataFrame, split_rows: int | None = None, id_prefix: int | None = ID_PREFIX) -> DataFrame:
    """L2: events breaking the lifecycle, one reason each (first match wins).

    Active means the previous amount is positive. The first event must be a
    signup and only the first; an upgrade needs an active customer and an amount
    that is not lower, a downgrade an active customer and a lower one; a cancel
    needs an active customer; a reactivation a cancelled one. What
    ``derive_event_type`` writes can only break the cancel rule (two zero amounts
    in a row). ``split_rows`` and ``id_prefix`` as there."""
    lagged = ordered_lag(events.select("event_id", "customer_id", "event_type", "event_date",
                                       "monthly_amount"),
                         "customer_id", ORDER, ["event_id", "monthly_amount"],
                         split_rows=split_rows, cut=day_cut(id_prefix))
    t, amt = F.col("event_type"), F.col("monthly_amount")
    first = F.col("prev_event_id").isNull()
    prev = F.col("prev_monthly_amount")
    active = prev > 0
    reason = (
        F.when(first & (t != "signup"), F.lit("first_event_not_signup"))
        .when(~first & (t == "signup"), F.lit("signup_after_first_event"))
        .when((t == "upgrade") & ~F.coalesce(active & (amt >= prev), F.lit(False)), F.lit("upgrade_to_cheaper_plan_or_while_inactive"))
        .when((t == "downgrade") & ~F.coalesce(active & (amt < prev), F.lit(False)), F.lit("downgrade_not_to_cheaper_plan_while_active"))
        .when((t == "cancel") & ~F.coalesce(active, F.lit(False)), F.lit("cancel_while_inactive"))
        .when((t == "reactivate") & ~F.coalesce(prev == 0, F.lit(False)), F.lit("reactivate_without_cancel"))
    )
    return lagged.select("event_id", "customer_id", "event_type", "event_date",
                         reason.alias("reason")).where(F.col("reason").isNotNull())


def price_violations(events: DataFrame, plans: DataFrame) -> DataFrame:
    """L3: a cancel must carry amount 0; any other event must name a known plan
    and carry exactly its price."""
    j = events.join(plans.select("plan_id", "monthly_price"), "plan_id", "left")
    t, amt = F.col("event_type"), F.col("monthly_amount")
    reason = (
        F.when((t == "cancel") & (amt != 0), F.lit("cancel_with_amount"))
        .when((t != "cancel") & F.col("plan_id").isNull(), F.lit("active_without_plan"))
        .when((t != "cancel") & F.col("monthly_price").isNull(), F.lit("unknown_plan"))
        .when((t != "cancel") & (amt != F.col("monthly_price")), F.lit("amount_not_plan_price"))
    )
    return j.select("event_id", "customer_id", "event_type", "plan_id", "monthly_amount",
                    reason.alias("reason")).where(F.col("reason").isNotNull())


def reason_counts(violations: DataFrame) -> DataFrame:
    """(rule, violations) per reason."""
    return violations.groupBy(F.col("reason").alias("rule")).agg(
        F.count(F.lit(1)).alias("violations"))


# Names used by the inventory.
audit_lifecycle = lifecycle_violations
audit_price = price_violations
