"""A training-corpus pipeline over `documents`: quality, near-duplicates, contamination, mixture, token ids.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents. Every stage
handles null columns, empty texts and empty tables as its operator states.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, row_key, scratch, staged
from tidemark.llm.decontaminate import contaminated
from tidemark.llm.mixing import mixed
from tidemark.llm.near_dup import near_duplicates
from tidemark.llm.quality import fit_quality
from tidemark.llm.token_store import read_store, write_store
from tidemark.llm.words import slices

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the quality classifier rejects go (score below 0.5).

    The classifier is applied to the rows where they stand, so texts are not shuffled.
    """
    prepare(spark)
    docs = docs.select(*COLUMNS)
    score = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))

    def keep(batches):
        for whole in batches:
            for batch in slices(whole, "scored", 1 << 20):
                good = score(batch.column(len(COLUMNS))) >= 0.5
                yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=COLUMNS).filter(pa.array(good, pa.bool_()))

    return docs.withColumn("scored", F.coalesce("text", F.lit(""))).mapInArrow(keep, docs.schema)


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key of identifier and text, so that decisions reach rows without an identifier and rows that repeat one."""
    return docs.select(*COLUMNS, row_key(F.col("doc_id"), F.col("text")).alias("row_key"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: one row of each near-duplicate group stays (five words, 0.8), that of the smallest doc_id.

    Rows without doc_id take part; of rows that repeat identifier and text one stays. Texts without words all stay.
    """
    found = staged(near_duplicates(docs).select("row_key", "n_shingles", "stays"), "decisions")
    gone = found.where("not stays").select("row_key").distinct()
    again = staged(found.where("stays and n_shingles > 0").groupBy("row_key").agg(F.count("*").alias("n")).where("n > 1").select("row_key"), "again")
    rows = _keyed(docs)
    once = rows.join(gone.union(again), "row_key", "left_anti")
    return once.unionByName(rows.join(again, "row_key", "left_semi").dropDuplicates(["row_key"])).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that hold a copy of a benchmark item go, with or without a doc_id."""
    rows = _keyed(docs)
    found = contaminated(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="row_key").select(F.col("doc_id").alias("row_key"))
    return rows.join(found.distinct(), "row_key", "left_anti").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: each document as often as the mix takes it; 0 to 3 rows."""
    copies = (mixed(docs).where("copies > 0").groupBy(F.col("doc_id").alias("id"))
              .agg(F.max("copies").cast("int").alias("copies")))
    return (docs.select(*COLUMNS).join(copies, F.col("doc_id").eqNullSafe(F.col("id")))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the texts' token ids in a store; per document (doc_id, start, n_tokens, ids_crc32)."""
    path = scratch(spark, "tokens")
    write_store(docs, path)
    return read_store(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", token_ids),
]

#: A trained classifier and a tokenizer's ids are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each one written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        path = scratch(spark, f"stage-{k}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
