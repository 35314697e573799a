"""C1-C10 as rows: every row of the inputs that breaks a rule, with the names of the rules it breaks.

Row rules (not null, domain, minimum) are tested in the scan that reads the
row. Keys and foreign keys need other rows: the key values that break the rule
are found by pre-aggregated counts and anti joins, and joined back to the rows.
These tables hold broken key values only, so adaptive execution broadcasts them
when their size at run time allows and splits the rows of a hot key otherwise.
Counts per rule come from the tagged rows, so rows and counts cannot disagree.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.plans.quality import union_all

BROKEN = "broken_rules"


@dataclass(frozen=True)
class Rules:
    """The declared constraints of one table. `foreign` maps a column to (parent, its key column)."""

    table: str
    key: str | None = None
    not_null: list[str] = field(default_factory=list)
    domains: dict[str, list] = field(default_factory=dict)
    minimums: dict[str, object] = field(default_factory=dict)
    foreign: dict[str, tuple[DataFrame, str]] = field(default_factory=dict)

    def row_rules(self) -> list[tuple[str, Column]]:
        rules = [(f"{self.table}.{c}.not_null", F.col(c).isNull()) for c in self.not_null]
        rules += [(f"{self.table}.{c}.domain", ~F.col(c).isin(v)) for c, v in self.domains.items()]
        rules += [(f"{self.table}.{c}.min", F.col(c) < F.lit(v)) for c, v in self.minimums.items()]
        if self.key and self.key not in self.not_null:
            rules.append((f"{self.table}.{self.key}.not_null", F.col(self.key).isNull()))
        return rules

    def names(self) -> list[str]:
        """Every rule of the table, in order."""
        out = [name for name, _ in self.row_rules()]
        out += [f"{self.table}.{self.key}.unique"] if self.key else []
        return out + [f"{self.table}.{c}.fk" for c in self.foreign]


def _tag(df: DataFrame, rules: list[tuple[str, Column]]) -> Column:
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules])) if rules else F.array().cast("array<string>")


def tagged(df: DataFrame, rules: Rules) -> DataFrame:
    """`df` with `broken_rules`: the names of the rules that each row breaks, in order of `rules.names()`.

    A row breaks the key rule when another row has its key (all of them do), a
    foreign-key rule when its value is not null and has no parent. Null breaks
    neither these nor domains and minimums, as with SQL constraints; not_null says so.
    """
    out = df.withColumn(BROKEN, _tag(df, rules.row_rules()))
    keyed: list[tuple[str, str, DataFrame]] = []
    if rules.key:
        again = (df.where(F.col(rules.key).isNotNull()).groupBy(rules.key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
                 .select(rules.key))
        keyed.append((f"{rules.table}.{rules.key}.unique", rules.key, again))
    for column, (parent, parent_key) in rules.foreign.items():
        lost = (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n")).select(column)
                .join(parent.select(F.col(parent_key).alias(column)), column, "left_anti"))
        keyed.append((f"{rules.table}.{column}.fk", column, lost))
    for i, (name, column, values) in enumerate(keyed):
        hit = f"_hit{i}"
        out = out.join(values.withColumn(hit, F.lit(True)), column, "left")
        out = out.withColumn(BROKEN, F.when(F.col(hit), F.array_append(BROKEN, F.lit(name))).otherwise(F.col(BROKEN))).drop(hit)
    return out.select(*df.columns, BROKEN)


def violating_rows(df: DataFrame, rules: Rules) -> DataFrame:
    """The rows of `df` that break a rule, with `broken_rules`."""
    return tagged(df, rules).where(F.size(BROKEN) > 0)


def violation_counts(rows: DataFrame, rules: Rules) -> DataFrame:
    """(rule, violating_rows, passed) for every rule of the table, also those without violations, from its violating rows."""
    names = F.array(*[F.lit(n) for n in rules.names()])
    every = rows.sparkSession.range(1).select(F.explode(names).alias("rule"))
    found = rows.select(F.explode(BROKEN).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    return every.join(found, "rule", "left").select("rule", F.coalesce("n", F.lit(0)).alias("violating_rows"),
                                                    F.col("n").isNull().alias("passed"))


def input_rules(plans: DataFrame, customers: DataFrame) -> dict[str, Rules]:
    """The declared constraints of the three inputs; the events' parents are `plans` and `customers`."""
    return {
        "plans": Rules("plans", "plan_id", S.NOT_NULL["plans"], {"billing_cycle": S.BILLING_CYCLES}),
        "customers": Rules("customers", "customer_id", S.NOT_NULL["customers"], {"company_size": S.COMPANY_SIZES}),
        "events": Rules("events", "event_id", S.NOT_NULL["events"], {"event_type": S.EVENT_TYPES}, {"monthly_amount": 0},
                        {"customer_id": (customers, "customer_id"), "plan_id": (plans, "plan_id")}),
    }


def input_violations(plans: DataFrame, customers: DataFrame, events: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """({table: its violating rows}, counts per rule over all tables) of the three inputs."""
    rules = input_rules(plans, customers)
    rows = {name: violating_rows(df, rules[name]) for name, df in (("plans", plans), ("customers", customers), ("events", events))}
    return rows, union_all([violation_counts(rows[name], rules[name]) for name in rows])
