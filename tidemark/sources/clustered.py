"""Tables stored in buckets by a key: joins, groupings and windows on it need no shuffle.

Spark keeps a table's buckets in its catalog, not in the files. `Clustering`
is what has to be remembered beside a path, so that any session can name the
files as a bucketed table again. A bucket is read by one task: cluster tables
with few rows per key (month-close rows, dimensions), not raw facts whose keys
may hold any share of the rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Clustering:
    """Rows in `buckets` files by hash of `key`, each sorted by `sort`."""

    key: str
    buckets: int
    sort: tuple[str, ...] = ()

    def as_list(self) -> list:
        return [self.key, self.buckets, *self.sort]

    @classmethod
    def from_list(cls, values: list) -> Clustering:
        return cls(values[0], int(values[1]), tuple(values[2:]))


def _table(path: str) -> str:
    """A catalog name of its own for every path."""
    return f"tidemark_{hashlib.sha256(path.rstrip('/').encode()).hexdigest()[:32]}"


def write_clustered(df: DataFrame, path: str, clustering: Clustering) -> None:
    """Write `df` below `path` (which must not exist), one file per bucket."""
    c = clustering
    (df.repartition(c.buckets, c.key).write.format("parquet").mode("errorifexists").bucketBy(c.buckets, c.key)
     .sortBy(*(c.sort or (c.key,))).option("path", path).saveAsTable(_table(path)))


def read_clustered(spark: SparkSession, path: str, clustering: Clustering) -> DataFrame:
    """The bucketed table below `path`, named to this session's catalog if it does not know it yet."""
    name = _table(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        sort = ", ".join(f"`{s}`" for s in clustering.sort or (clustering.key,))
        where = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{clustering.key}`) SORTED BY ({sort}) "
                  f"INTO {clustering.buckets} BUCKETS LOCATION '{where}'")
    return spark.table(name)
