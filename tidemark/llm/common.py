"""Shared helpers: stage tables in the cluster's shared folder, Arrow batch size, stable hashes."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir

#: Rows of text in one Arrow batch; bounds a Python worker's memory whatever the partition size.
BATCH_ROWS = 512


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this module's that a later one has replaced (not under Spark Connect, where the server owns it)."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def staged(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """`df` written once to the shared folder (compressed by `codec`, else as the session says) and read back.

    Cuts lineage, so that a lost executor repeats a read instead of the work
    before it, and so that several readers share one evaluation.
    """
    path = scratch(df.sparkSession, label)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prepare(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """For operators with Python functions: bound the rows of an Arrow batch (texts can be
    long), and let workers on this machine import the package from where the driver did (a
    cluster gets it by --py-files)."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) != rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """The operator's own columns under fixed names (extra columns cannot clash); null text is empty."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                     *[F.col(f"`{c}`") for c in more])


def row_key(id_col: Column, text: Column) -> Column:
    """128 bits of a row's identifier (null told from any text) and text, as 32 hex digits: one key per different row."""
    known = F.coalesce(F.concat(F.lit("="), id_col.cast("string")), F.lit(""))
    return F.md5(F.concat(known, F.lit("\0"), F.coalesce(text.cast("string"), F.lit(""))).cast("binary"))


def held_out(id_col: Column) -> Column:
    """True where crc32 of the id as text leaves remainder 1 by 3; such rows are never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))
