"""Exact duplicates by content sort (DataFrame operations only)."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, staged


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def exact_duplicates(docs: DataFrame, keep: str = "smallest", share: int = 1000, most: int = 100_000, pieces: int = 64,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after `ascii_lower`; of equal texts the row
    with the `keep` ("smallest" or "largest") identifier stays.

    Content sort: splitters that Spark samples range-partition the normalised
    texts (by their first characters and a hash of the rest), each partition is
    sorted (spilling where needed), so that equal texts lie side by side, and a
    running window compares each full text with its neighbour. A text held by more than 1/`share` of all rows, or by more than `most` rows
    (there are at most `share`, or one per `most` rows, of such texts), is dealt into
    `pieces` runs or more by a hash of the identifier, so that a run has about `most` rows at the most,
    because one run of a third of all rows would be one task. The runs of such a
    text, and the identifiers of every group, meet again on the text's SHA-256
    in narrow pre-aggregated rows.

    Null text counts as empty; an identifier that is null never represents a
    group that has others; of rows that repeat the kept identifier one is kept;
    an empty table gives no rows; other columns are ignored.
    """
    base = id_and_text(docs, id_col, text_col)
    # equal normalised texts have equal hashes of lower(); used only to see which contents are frequent
    counts = staged(base.groupBy(F.xxhash64(F.lower("text")).alias("h")).agg(F.count("*").alias("n")), "counts")
    limit = counts.agg(F.least(F.sum("n") / share, F.lit(most))).scalar()
    hot = counts.where(F.col("n") > limit).select("h", F.greatest(F.lit(pieces), F.ceil(F.col("n") / most)).alias("runs"))

    keyed = (base.withColumn("h", F.xxhash64(F.lower("text")))
             .join(F.broadcast(hot), "h", "left")  # 16 bytes for at most `share` texts, or one per `most` rows
             .select("doc_id", ascii_lower(F.col("text")).alias("norm"),
                     F.when(F.col("runs").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.col("runs"))).otherwise(F.lit(0)).alias("piece")))
    order = F.col("doc_id").desc_nulls_last() if keep == "largest" else F.col("doc_id").asc_nulls_last()
    # the splitters are samples of the sort key's bounded part, so the driver never holds whole texts
    head = ["head", "h", "piece"]
    run = Window.partitionBy(*head, "norm").orderBy(order)
    rows = staged(keyed.withColumns({"head": F.substring("norm", 1, 32), "h": F.xxhash64("norm")}).repartitionByRange(*head)
                  .select("doc_id", "norm", "piece", F.row_number().over(run).alias("nth"),
                          F.first("doc_id").over(run.rowsBetween(Window.unboundedPreceding, 0)).alias("run_keep"))
                  .select("doc_id", "piece", "nth", "run_keep", F.sha2("norm", 256).alias("text_sha256")), "sorted")

    best = F.max if keep == "largest" else F.min
    runs = rows.groupBy("text_sha256", "piece").agg(best("run_keep").alias("run_best"), F.count("*").alias("n"))
    whole = Window.partitionBy("text_sha256")  # a row per run
    groups = runs.select("text_sha256", "piece", best("run_best").over(whole).alias("keep_id"),
                         F.sum("n").over(whole).alias("group_size"))
    return rows.join(groups, ["text_sha256", "piece"]).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        "text_sha256")
