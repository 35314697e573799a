"""The list of published versions: one numbered entry per version, created only if absent.

Several writers may publish at once. Each lists its version under the number
after the highest that it sees; creating the entry fails if another writer has taken that number, and
the next one is tried. So every version is listed once, in one order that all readers see,
whatever the clocks of the writers say; the entry with the highest number is current. A
version that never gets an entry is invisible, and can be removed later.

Creating a file only if it is absent is one atomic step on HDFS and (by a hard
link) on a local or mounted file system; on an object store it is where the store's connector
makes it so (conditional writes).
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = "_manifest"
ENTRY = "number long, version string, listed_at string, clustered map<string, array<string>>"
_VERSION = re.compile(r"v(\d{15})-[0-9a-f]{8}")
_NUMBER = re.compile(r"(\d{20})\.json")


def new_version() -> str:
    """A name that no other version has; its digits say when its load began."""
    return f"v{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"


def _fs(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _names(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """(name, time of the last change in seconds) of everything directly below `path`."""
    folder, fs = _fs(spark, path)
    return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in fs.listStatus(folder)] if fs.exists(folder) else []


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file `path` with `text`; False, and nothing changed, if it exists."""
    target, fs = _fs(spark, path)
    if fs.getScheme() == "file":
        local = target.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        draft = os.path.join(os.path.dirname(local), f".{uuid.uuid4().hex}")
        with open(draft, "x", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(draft, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    from py4j.protocol import Py4JJavaError

    try:
        out = fs.create(target, False)
    except Py4JJavaError as e:
        if fs.exists(target) and "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def highest(spark: SparkSession, base: str) -> int:
    """The highest number taken so far, 0 if none is."""
    return max([int(m.group(1)) for name, _ in _names(spark, f"{base}/{FOLDER}") if (m := _NUMBER.fullmatch(name))], default=0)


def list_version(spark: SparkSession, base: str, version: str, clustered: dict[str, list] | None = None) -> int:
    """List `version` as the newest and return its number. Its folder must still be there."""
    folder, fs = _fs(spark, f"{base}/{version}")
    if not fs.exists(folder):
        raise FileNotFoundError(f"version {version} is gone: it was removed before it could be listed")
    number = highest(spark, base) + 1
    while True:
        entry = {"number": number, "version": version, "listed_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()),
                 "clustered": {k: [str(x) for x in v] for k, v in (clustered or {}).items()}}
        if create_if_absent(spark, f"{base}/{FOLDER}/{number:020d}.json", json.dumps(entry)):
            return number
        number += 1


def versions(spark: SparkSession, base: str) -> DataFrame:
    """Every listed version: number, version, listed_at, clustered. An entry that cannot be read is an error; one that
    its writer has created but not yet filled lists nothing."""
    return spark.read.schema(ENTRY).option("mode", "FAILFAST").json(f"{base}/{FOLDER}")


def current(spark: SparkSession, base: str):
    """The entry of the newest version, or None before the first. Only a missing list means that nothing is published."""
    try:
        return versions(spark, base).agg(F.max_by(F.struct("number", "version", "clustered"), "number").alias("e")).first()["e"]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def unlisted(spark: SparkSession, base: str, older_than: float) -> list[str]:
    """Version folders without an entry whose load began, and whose folder changed last, more than `older_than` seconds ago."""
    try:
        listed = {r.version for r in versions(spark, base).select("version").collect()}
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        listed = set()
    limit = time.time() - older_than
    found = [(name, changed, _VERSION.fullmatch(name)) for name, changed in _names(spark, base)]
    return sorted(name for name, changed, m in found
                  if m and name not in listed and changed < limit and int(m.group(1)) / 1000 < limit)


def remove_unlisted(spark: SparkSession, base: str, older_than: float = 7 * 86400) -> list[str]:
    """Delete what failed or abandoned loads left below `base`, and return their names.

    `older_than` must exceed the longest load: a load that takes longer finds its folder gone and fails when it wants to be
    listed. Listed versions and anything that is not a version folder are never touched.
    """
    gone = unlisted(spark, base, older_than)
    for name in gone:
        folder, fs = _fs(spark, f"{base}/{name}")
        fs.delete(folder, True)
    return gone
