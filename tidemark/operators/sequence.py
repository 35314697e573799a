"""Previous-row values within a key, exact under key skew.

A plain ``lag().over(Window.partitionBy(key))`` sends every row of a key to
one task, so a key holding a third of the data becomes one huge task. Here
the window is partitioned by ``(key, bucket, cut)``, where bucket and cut are
fixed monotone functions of the ordering (by default the first ordering
column, a day), so a hot key is spread over as many tasks as it has of them.
What precedes a bucket is carried in: the last row of each bucket
(pre-aggregated, one row per bucket) becomes an extra first row of the key's next bucket.
The extra rows join the others by a union, so nothing is counted, sampled or
joined back: three exchanges (buckets, keys, rows) and two scans, the first
of them pruned to the columns that the lag reads. Everything is
deterministic, lazy and JVM-side.

Callers that cannot name a ``cut`` and have groups too large for a task can
pass ``split_rows``: such groups are counted and cut at sampled boundaries
(``hot_group_cuts``), at the price of that pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SAMPLE_SPACE = 1 << 30


def hot_group_cuts(df: DataFrame, key: str, order: list[str], base: Column, split_rows: int,
                   per_piece: int = 4) -> DataFrame:
    """(key, _b0, _cuts): boundaries that cut every (key, bucket) group above
    ``split_rows`` rows into pieces of about that many.

    Groups are counted with partial aggregation. The boundaries come from a
    sample of the next ordering column, ``per_piece`` values per piece in
    expectation, taken by a hash of the value: every evaluation sees the same
    boundaries, and no row leaves the executors."""
    staged = df.withColumn("_b0", base)
    hot = (staged.groupBy(key, "_b0").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > split_rows)
           .withColumn("_pieces", F.ceil(F.col("_n") / split_rows)))
    nxt = order[1]
    share = F.col("_pieces") * per_piece / F.col("_n")
    sample = (staged.select(key, "_b0", nxt).join(hot, [key, "_b0"])
              .where(F.pmod(F.xxhash64(nxt), F.lit(_SAMPLE_SPACE)) < share * _SAMPLE_SPACE))
    values = sample.groupBy(key, "_b0").agg(F.sort_array(F.collect_set(nxt)).alias("_v"))
    return values.select(key, "_b0", F.filter("_v", lambda _, i: i % per_piece == per_piece - 1).alias("_cuts"))


def ordered_lag(df: DataFrame, key: str, order: list[str], cols: list[str],
                prefix: str = "prev_", bucket: Column | None = None,
                split_rows: int | None = None, cut: Column | None = None) -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` on the previous row of the same ``key``
    in ``order`` (NULL on a key's first row). ``order`` must make rows unique
    within a key; ``bucket`` must be non-decreasing along ``order``, and ``cut``
    non-decreasing along it within a bucket. The largest (key, bucket, cut) is
    the most that one task gets.

    With ``split_rows``, (key, bucket) groups larger than that are split further
    on the next ordering column: a row's cut is the number of boundaries
    not above its value, which is non-decreasing along ``order``, so the result
    stays exact whatever the sampled boundaries; only the balance depends on
    them."""
    base = bucket if bucket is not None else F.col(order[0])
    if split_rows is not None and len(order) > 1:
        nxt = F.col(order[1])
        rows = (df.withColumn("_b0", base).join(hot_group_cuts(df, key, order, base, split_rows), [key, "_b0"], "left")
                .withColumn("_b1", F.coalesce(F.size(F.filter("_cuts", lambda c: c <= nxt)), F.lit(0))).drop("_cuts"))
    else:
        rows = df.withColumn("_b0", base).withColumn("_b1", cut if cut is not None else F.lit(0))
    buckets = ["_b0", "_b1"]
    taken = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)])
    last = F.max(F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], taken.alias("v")))
    ends = rows.groupBy(key, *buckets).agg(last.alias("_end"))
    carry = ends.select(key, *buckets, F.lag("_end.v").over(Window.partitionBy(key).orderBy(*buckets)).alias("_v"),
                        F.lit(False).alias("_own")).where(F.col("_v").isNotNull())
    merged = rows.select(*df.columns, *buckets, taken.alias("_v"), F.lit(True).alias("_own")).unionByName(carry, allowMissingColumns=True)
    w = Window.partitionBy(key, *buckets).orderBy("_own", *order)
    lagged = merged.select(*df.columns, "_own", F.lag("_v").over(w).alias("_before")).where("_own")
    return lagged.select(*df.columns, *[F.col(f"_before.v{i}").alias(prefix + c) for i, c in enumerate(cols)])
