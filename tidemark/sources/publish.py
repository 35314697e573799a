"""All-or-nothing publication of the inputs and views over them.

Parquet folders have no multi-table transaction, so publication is staged:
every table is written into a new version folder, counted back and checked,
and only then is the version listed. Readers resolve the
newest version listed, so a failed or half-written load is
never visible (the "rollback" is simply never listing it).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.clustered import Clustering, read_clustered, write_clustered
from tidemark.sources.versions import FOLDER as MANIFEST
from tidemark.sources.versions import current, list_version, new_version, versions


__all__ = ["MANIFEST", "PublishError", "current_version", "load_counts", "publish", "read_published", "register_views",
           "stored_counts", "write_ledger"]


#: Month files that a task of ``write_ledger`` has open at once; rows of further months are sorted.
WRITERS = 24


class PublishError(RuntimeError):
    pass


def load_counts(inputs: dict[str, DataFrame], stored: dict[str, DataFrame]) -> DataFrame:
    """(table_name, input_rows, stored_rows, passed) for each table, in one job."""
    parts = []
    for name, df in inputs.items():
        for side, frame in (("input", df), ("stored", stored[name])):
            parts.append(frame.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(name).alias("table_name"), F.lit(side).alias("side"), "n"))
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    return (
        counts.groupBy("table_name")
        .agg(F.sum(F.when(F.col("side") == "input", F.col("n"))).alias("input_rows"),
             F.sum(F.when(F.col("side") == "stored", F.col("n"))).alias("stored_rows"))
        .withColumn("passed", F.col("input_rows") == F.col("stored_rows"))
    )


def stored_counts(written: dict[str, int], stored: dict[str, DataFrame]) -> DataFrame:
    """S6 against counts taken while writing: (table_name, input_rows, stored_rows, passed)."""
    parts = [stored[name].agg(F.count(F.lit(1)).alias("stored_rows")).select(
        F.lit(name).alias("table_name"), F.lit(n).cast("bigint").alias("input_rows"), "stored_rows")
        for name, n in written.items()]
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("input_rows") == F.col("stored_rows"))


def publish(spark: SparkSession, tables: dict[str, DataFrame], base: str,
            checks: Callable[[dict[str, DataFrame]], DataFrame] | None = None,
            derived: Callable[[dict[str, DataFrame]], dict[str, Callable[[str], None]]] | None = None,
            post_checks: Callable[[dict[str, DataFrame]], DataFrame] | None = None,
            clustered: dict[str, Clustering] | None = None) -> str:
    """Write ``tables`` as a new version under ``base`` and list it only
    when everything belonging to it is stored and checked.

    Order: write the tables, counting the rows in the job that writes them; the
    stored counts must equal these;
    ``checks`` (a function of the stored tables returning rows with a
    ``passed`` column) must all pass; ``derived`` (a function of the stored
    tables returning ``{name: writer(path)}``) writes tables built from them,
    e.g. the ledger, into the same version, one after the other; ``post_checks`` (a function of
    stored and derived tables) must pass; only then is the version listed
    (``sources.versions``: several publishers may run at once, each version is listed once).
    A failure at any step leaves the version unlisted, for ``remove_unlisted`` to clear.

    ``clustered`` names tables, derived ones too, that are stored in buckets; those of
    ``tables`` are written so here, a derived one by its own writer."""
    layouts = clustered or {}
    version = new_version()
    stage = f"{base}/{version}"
    written: dict[str, int] = {}
    for name, df in tables.items():
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("n"))
        if name in layouts:
            write_clustered(counted, f"{stage}/{name}", layouts[name])
        else:
            counted.write.mode("errorifexists").parquet(f"{stage}/{name}")
        written[name] = seen.get["n"]

    def reader(name: str) -> DataFrame:
        path = f"{stage}/{name}"
        return read_clustered(spark, path, layouts[name]) if name in layouts else spark.read.parquet(path)

    stored = {name: reader(name) for name in tables}
    failed = stored_counts(written, stored).where(~F.col("passed")).count()
    if failed:
        raise PublishError(f"{failed} table(s) stored a different row count; version {version} not listed")
    if checks is not None:
        bad = checks(stored).where(~F.col("passed")).count()
        if bad:
            raise PublishError(f"{bad} check(s) failed; version {version} not listed")
    if derived is not None:
        for name, write in derived(stored).items():
            write(f"{stage}/{name}")
            stored[name] = reader(name)
    if post_checks is not None:
        bad = post_checks(stored).where(~F.col("passed")).count()
        if bad:
            raise PublishError(f"{bad} check(s) on derived tables failed; version {version} not listed")
    list_version(spark, base, version, {name: c.as_list() for name, c in layouts.items()})
    return version


def current_version(spark: SparkSession, base: str) -> str | None:
    """The version listed last, or None before the first successful publication.

    The order is that of listing, not of starting: a long load that ends last is the newest."""
    entry = current(spark, base)
    return entry["version"] if entry else None


def read_published(spark: SparkSession, base: str, name: str, version: str | None = None) -> DataFrame:
    """A table of a published version (default: the current one), in its buckets where it is stored in buckets."""
    if version is None:
        entry = current(spark, base)
    else:
        entry = versions(spark, base).where(F.col("version") == version).first()
    if entry is None:
        raise PublishError(f"nothing published under {base}" if version is None else f"version {version} is not listed under {base}")
    path = f"{base}/{entry['version']}/{name}"
    layout = (entry["clustered"] or {}).get(name)
    return read_clustered(spark, path, Clustering.from_list(layout)) if layout else spark.read.parquet(path)


def write_ledger(ledger: DataFrame, path: str, mode: str = "errorifexists",
                 partitions: int | None = None, by_year: bool = False) -> None:
    """Write a ledger partitioned by ``month_date``: a month filter on the stored
    ledger then prunes whole folders instead of scanning every month.

    A rebalance on the month puts a month's rows together; at run time AQE merges
    small months into one task and splits a large one over several, by the sizes
    of the shuffle. There is no sampling pass, so the ledger is evaluated once.
    ``partitions`` sets the shuffle's initial count. ``by_year``: the rows come together by
    year already (``movements(by_year=True)``), and no dense row is shuffled. A task keeps the
    files of up to WRITERS months open, so that its rows need no sort by month."""
    keys = [partitions, "month_date"] if partitions else ["month_date"]
    spark, limit = ledger.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(limit)
    spark.conf.set(limit, str(max(WRITERS, int(before))))
    try:
        (ledger if by_year else ledger.hint("rebalance", *keys)).write.mode(mode).partitionBy("month_date").parquet(path)
    finally:
        spark.conf.set(limit, before)


def register_views(views: dict[str, DataFrame]) -> None:
    """(re)register DataFrames as temporary views for SQL users."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
