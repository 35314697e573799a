"""As-of join: the last row of one time-ordered side at or before each row of another.

Both sides are cut into buckets of time and merged: their union is partitioned
by (key, bucket), sorted once, and every left row takes the last right row
above it. What lies before a bucket comes from a carry table, one row per
(key, bucket): the last right row of each bucket, pre-aggregated on the map
side, and the last of these before each bucket. The carry rows join the union
as rows that sort first, so there is no join at all, neither by range nor
back to a large side.

A hot key is spread over as many tasks as it has buckets; the window over the
carry table holds one row per bucket of a key. Three exchanges (buckets, keys, the union), two scans of
each side; the first two move only keys, times and the taken columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tasks over which left rows without a key or a time are dealt; they meet nothing.
_LOST = 1024
_CARRY = 0


def asof_join(left: DataFrame, right: DataFrame, key: str | Sequence[str], times: tuple[str, str], tie: Sequence[str] = (),
              values: Sequence[str] | None = None, strict: bool = False, how: str = "left",
              bucket: Callable[[Column], Column] | None = None) -> DataFrame:
    """Every row of `left` with the `values` of the last row of `right` of its key whose time is not later.

    `key` names the key columns (the same on both sides), `times` the time
    column of each side (comparable types). Of right rows at one time the one with the largest
    `tie` counts (compared in order, nulls smallest; give columns that make
    rows unique for a defined result). `strict`: only earlier right rows count. `values` default to all
    other columns of `right`; their names must not be in `left`. `how`: `left`
    keeps rows without a match (with nulls), `inner` drops them.

    `bucket` is a non-decreasing function of time (default: its date); a (key,
    bucket) is the most that one task gets, and a key's carry has a row per
    bucket: choose hours for a key with very many rows a day, months for long
    sparse histories. Left rows without key or time meet nothing; such right rows are never met.
    """
    keys = [key] if isinstance(key, str) else list(key)
    left_time, right_time = times
    taken = list(values) if values is not None else [c for c in right.columns if c not in keys]
    if clash := set(taken) & set(left.columns):
        raise ValueError(f"columns on both sides: {', '.join(sorted(clash))}; rename or list `values`")
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how!r}")
    bucket = bucket or (lambda t: t.cast("date"))
    # fixed names for the parts, so that neither side's columns can clash with them
    k = [f"_k{i}" for i in range(len(keys))]

    def cast(side: DataFrame, time: str) -> list[Column]:
        return [*[F.col(f"`{c}`").alias(a) for c, a in zip(keys, k, strict=True)], bucket(F.col(f"`{time}`")).alias("_b"),
                F.col(f"`{time}`").alias("_t")]

    found = F.lit(True)
    for c in [*k, "_t"]:
        found = found & F.col(c).isNotNull()
    tied = F.struct(*[F.col(f"`{c}`") for c in tie]) if tie else F.struct(F.lit(0))
    right_rows = right.select(*cast(right, right_time), tied.alias("_tie"), F.struct(*[F.col(f"`{c}`") for c in taken]).alias("_v")).where(found)
    left_rows = left.select(*cast(left, left_time), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row"))

    last = F.struct("_t", "_tie", "_v")
    ends = (right_rows.select(*k, "_b", last.alias("_last"))
            .unionByName(left_rows.where(found).select(*k, "_b"), allowMissingColumns=True)
            .groupBy(*k, "_b").agg(F.max("_last").alias("_last")))
    before = Window.partitionBy(*k).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = (ends.select(*k, "_b", F.last("_last", ignorenulls=True).over(before).alias("_in")).where(F.col("_in").isNotNull())
             .select(*k, "_b", F.col("_in._v").alias("_v"), F.lit(_CARRY).alias("_side"), F.lit(0).alias("_lost")))

    left_side, right_side = (1, 2) if strict else (2, 1)
    lost = F.when(found, F.lit(0)).otherwise(F.pmod(F.xxhash64("_row"), F.lit(_LOST)).cast("int") + 1)
    merged = (left_rows.select(*k, "_b", "_t", "_row", F.lit(left_side).alias("_side"), lost.alias("_lost"))
              .unionByName(right_rows.select(*k, "_b", "_t", "_tie", "_v", F.lit(right_side).alias("_side"), F.lit(0).alias("_lost")),
                           allowMissingColumns=True)
              .unionByName(carry, allowMissingColumns=True))
    upto = (Window.partitionBy(*k, "_b", "_lost").orderBy(F.col("_side") > _CARRY, "_t", "_side", "_tie")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = F.when(F.col("_lost") == 0, F.last("_v", ignorenulls=True).over(upto))
    out = merged.select("_side", "_row", met.alias("_v")).where(F.col("_side") == left_side)
    if how == "inner":
        out = out.where(F.col("_v").isNotNull())
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in left.columns], *[F.col(f"_v.`{c}`").alias(c) for c in taken])


def state_asof(times: DataFrame, events: DataFrame, time: str, strict: bool = False, how: str = "left",
               bucket: Callable[[Column], Column] | None = None) -> DataFrame:
    """M5/M6 for any times: rows of `times` (customer_id, `time`, ...) with the customer's monthly_amount and plan_id
    after the last event not later (`strict`: earlier) than the row; of one day's events the largest event_id counts."""
    return asof_join(times, events, "customer_id", (time, "event_date"), tie=["event_id"], strict=strict, how=how, bucket=bucket,
                     values=["monthly_amount", "plan_id"])
