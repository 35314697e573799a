"""Mixing sources to target weights by Pareto order sampling (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of more than 1/LONG of their source's words are decided first.
LONG = 200
#: Rank intervals per source; only the interval in which a source's target falls is ranked row by row.
INTERVALS = 1024
#: The interval of a source's long documents.
LONG_DOCS = -1


def uniform(id_col: Column, seed: str) -> Column:
    """A number in (0, 1) that depends on the identifier and the seed alone (52 bits of an MD5)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def source_targets(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """`target` words for each row (source, source_size) of a table of sources, whose other columns stay.

    Sources in code-point order, null last, weigh `cycle`, repeating. They share
    the total by weight; a share stops at `most` times the source's size and the
    excess is shared again by weight. Closed form: with the sources in order of
    most*size/weight, the first ones are capped, and the level t of the others
    is (total - capped)/(their weights).
    """
    numbered = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sources.withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in cycle]), ((F.row_number().over(numbered) - 1) % len(cycle) + 1)))
    by_cap = Window.orderBy(F.col("source_size") * most / F.col("weight"), F.col("source").asc_nulls_last())
    before, every = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    levels = weighed.withColumn("level", level)
    reached = F.min(F.when(F.col("level") <= F.col("source_size") * most / F.col("weight"),
                           F.struct((F.col("source_size") * most / F.col("weight")).alias("cap"), "level")))
    return levels.withColumn("t", reached.over(every)["level"]).select(
        *sources.columns, F.least(F.col("t") * F.col("weight"), (F.col("source_size") * most).cast("double")).alias("target"))


def mixed(docs: DataFrame, seed: str = "mix", cycle: tuple[int, ...] = (1, 2, 3), most: int = 3,
          id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weight_col: str | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    Size is the number of words of the text. Every document of a source gets
    floor(target/source_size) certain copies. The rest of the target is filled
    with one further copy of some documents by Pareto order sampling: document i
    with inclusion probability p_i and uniform u_i ranks by
    u/(1-u) / (p/(1-p)), and the sample is the prefix of that order whose
    words come nearest the rest. p_i is the rest's share of the source, times the
    document's relative weight if `weight_col` names one.

    Documents of more than 1/200 of their source (fewer than 200 a source) are
    sampled first, to their own share, so that the others can fill what they
    leave and the prefix ends within half a small document of the target. The
    prefix is found by adding up words per (source, rank interval); only the
    interval in which the target falls is summed row by row, so a source with a
    third of all rows is never one task. Documents are joined twice, with their
    source and with their interval; the long ones of a source count as one more
    interval, LONG_DOCS.

    Null text has size 0, a null source is a source of its own, a null doc_id is
    sampled as "null", rows that repeat a doc_id are sampled row by row, an empty
    table gives no rows, other columns are ignored. Reruns agree: u is a hash.
    """
    weight = F.col(f"`{weight_col}`").cast("double") if weight_col else F.lit(1.0)
    sized = staged(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.greatest(F.coalesce(weight, F.lit(1.0)), F.lit(0.0)).alias("w")), "sized")
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("w")).alias("ww"))
    targets = (source_targets(sums, cycle, most)
               .select(F.col("source").alias("s"), "source_size", "target",
                       F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).alias("whole"),
                       F.when(F.col("ww") > 0, F.col("source_size") / F.col("ww")).otherwise(1.0).alias("per_w"))
               .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    targets = staged(targets, "targets")
    p = F.least(F.col("rest") / F.col("source_size") * F.col("w") * F.col("per_w"), F.lit(1.0))
    u = uniform(F.col("doc_id"), seed)
    ranked = (sized.join(targets, F.col("source").eqNullSafe(F.col("s")))
              .withColumn("p", F.when(F.col("source_size") > 0, p).otherwise(0.0))
              .withColumn("q", F.when(F.col("p") > 0, u / (1 - u) * ((1 - F.col("p")) / F.col("p"))))
              # rank in [0, 1], rising with q; 1 where nothing is to be sampled
              .withColumn("rank", F.when(F.col("q").isNull(), 1.0).otherwise(F.col("q") / (1 + F.col("q"))))
              .withColumn("interval", F.when(F.col("size") * LONG > F.col("source_size"), F.lit(LONG_DOCS)).otherwise(
                  F.least(F.floor(F.col("rank") * INTERVALS), F.lit(INTERVALS - 1)).cast("int"))))
    ranked = staged(ranked.select("doc_id", "source", "size", "source_size", "target", "whole", "rest", "rank", "interval",
                                  (F.col("p") > 0).alias("sampled")), "ranked")

    # the few long documents of each source, to their own share
    order = (Window.partitionBy("source", "interval").orderBy("rank", F.col("doc_id").asc_nulls_last(), "size")
             .rowsBetween(Window.unboundedPreceding, 0))
    upto = F.sum("size").over(order) - F.col("size") / 2
    words = F.sum("size").over(Window.partitionBy("source", "interval"))
    long_docs = ranked.where(F.col("interval") == LONG_DOCS).withColumn("share", F.col("rest") * (words / F.col("source_size")))
    long_taken = F.when((upto <= F.col("share")) & F.col("sampled"), F.col("size")).otherwise(0)

    # words by source and rank interval: those taken of the long documents, all of the others
    cells = (long_docs.select("source", "interval", "rest", "share", long_taken.alias("cell"))
             .unionByName(ranked.where(F.col("interval") != LONG_DOCS)
                          .select("source", "interval", "rest", F.lit(None).cast("double").alias("share"), F.col("size").alias("cell")))
             .groupBy("source", "interval").agg(*[F.max(c).alias(c) for c in ("rest", "share")], F.sum("cell").alias("cell")))
    of_source, is_long = Window.partitionBy("source"), F.col("interval") == LONG_DOCS
    before = F.sum(F.when(is_long, 0).otherwise(F.col("cell"))).over(of_source.orderBy("interval").rowsBetween(Window.unboundedPreceding, 0))
    cells = (cells.withColumn("before", before - F.col("cell"))
             .withColumn("left", F.col("rest") - F.coalesce(F.max(F.when(is_long, F.col("cell"))).over(of_source), F.lit(0))))
    cells = staged(cells.select(F.col("source").alias("cs"), F.col("interval").alias("ci"),
                                F.when(is_long, 0).otherwise(F.col("before")).alias("before"),
                                F.when(is_long, F.col("share")).otherwise(F.col("left")).alias("limit"),
                                F.when(is_long, "part").when(F.col("before") + F.col("cell") <= F.col("left"), "all")
                                .when(F.col("before") >= F.col("left"), "none").otherwise("part").alias("state")), "cells")

    placed = ranked.join(cells, (F.col("interval") == F.col("ci")) & F.col("source").eqNullSafe(F.col("cs")))
    part = placed.where("state = 'part'").withColumn("extra", (F.col("before") + upto <= F.col("limit")) & F.col("sampled"))
    rest = placed.where("state <> 'part'").withColumn("extra", (F.col("state") == "all") & F.col("sampled"))
    rows = part.unionByName(rest).select("doc_id", "source", "size", "source_size", "target",
                                         (F.col("whole") + F.col("extra").cast("long")).cast("long").alias("copies"))
    return rows.withColumn("taken", F.col("size") * F.col("copies"))
