"""Operator 12: Lloyd's clustering of integer vectors with heap-ordered bounds.

A vector's gap is its lower bound on the distance to every other centroid less
its upper bound on the distance to its own. While the gap is positive the
nearest centroid cannot have changed. When centroids move, every gap of a
cluster shrinks by at most the same amount, the cluster's own drift plus the
largest drift of another one. So gaps are not touched: each cluster keeps a
heap of gaps, offset by the drift accumulated when they were entered, and a
round pops the vectors whose gap has expired and rescans only these, exactly.

On Spark a row is a block of vectors with their heaps. A round is one pass over
the blocks that writes them to the shared folder again, with the sums by
cluster of the vectors that moved; the sums of all blocks are added by Spark, and
only k sums come to the driver. Distances, sums and centroids are exact
integers; bounds are floating point and expire early by a margin above their
rounding error.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import discard, prepare, scratch

SCALE = 256
#: Vectors in a block; bounds a Python worker's memory.
BLOCK = 1024
#: Components beyond this could overflow the long of a squared distance.
LARGEST = 1 << 26
#: Below this, products of float64 are exact for any sensible number of components.
_EXACT_FLOAT = 1 << 20
#: Gaps expire this much early, relative to the distances that they were taken from.
_MARGIN = 1e-9


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def integer_vectors(column: pa.Array, size: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(kept, vectors): which lists have `size` components, none null or non-finite, and floor(scale * x) of those."""
    lists = column.cast(pa.list_(pa.float64()))
    lengths = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    kept = lengths == size
    flat = lists.filter(pa.array(kept, pa.bool_())).flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)  # nulls are NaN
    finite = np.isfinite(values).all(axis=1)
    kept[np.flatnonzero(kept)[~finite]] = False
    scaled = np.floor(values[finite] * scale)
    if scaled.size and np.abs(scaled).max() > LARGEST:
        raise OverflowError(f"a component of more than {LARGEST} after scaling: squared distances would not fit a long")
    return kept, scaled.astype(np.int32)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared Euclidean distances of integer vectors, int64."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) <= _EXACT_FLOAT:
        a, b = x.astype(np.float64), centroids.astype(np.float64)
        d = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]
        return d.astype(np.int64)
    a = x.astype(np.int64)
    return np.stack([((a - c) ** 2).sum(axis=1) for c in centroids.astype(np.int64)], axis=1)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, squared distance, gap) of each vector; ties go to the smaller number."""
    d = distances(x, centroids)
    own = d.argmin(axis=1)
    best = d[np.arange(len(x)), own]
    if len(centroids) == 1:
        return own, best, np.full(len(x), np.inf)
    d[np.arange(len(x)), own] = np.iinfo(np.int64).max
    upper, lower = np.sqrt(best.astype(np.float64)), np.sqrt(d.min(axis=1).astype(np.float64))
    return own, best, lower - upper - _MARGIN * (1 + lower + upper)


class Heaps:
    """One block's vectors by cluster, each cluster's in a heap of gap plus the offset at entry."""

    def __init__(self, entries: list[list[tuple[float, int]]]):
        self.entries = entries

    def expired(self, offsets: np.ndarray) -> list[int]:
        """Pop the vectors whose gap is used up: entry key not above the cluster's offset now (but for rounding)."""
        out = []
        for heap, offset in zip(self.entries, (offsets * (1 + _MARGIN / 1000)).tolist(), strict=True):
            while heap and heap[0][0] <= offset:
                out.append(heapq.heappop(heap)[1])
        return sorted(out)

    def enter(self, vectors, clusters, gaps, offsets: np.ndarray) -> None:
        for i, c, key in zip(vectors, clusters.tolist(), (gaps + offsets[clusters]).tolist(), strict=True):
            heapq.heappush(self.entries[c], (key, i))

    def pack(self) -> tuple[bytes, bytes, bytes]:
        """Sizes by cluster, keys and vectors, each heap in its own order."""
        flat = [e for heap in self.entries for e in heap]
        return (np.array([len(h) for h in self.entries], "<i4").tobytes(), np.array([k for k, _ in flat], "<f8").tobytes(),
                np.array([i for _, i in flat], "<i4").tobytes())

    @classmethod
    def unpack(cls, sizes: bytes, keys: bytes, vectors: bytes) -> Heaps:
        pairs = list(zip(np.frombuffer(keys, "<f8").tolist(), np.frombuffer(vectors, "<i4").tolist(), strict=True))
        ends = np.cumsum(np.frombuffer(sizes, "<i4")).tolist()
        return cls([pairs[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)])


def moved_sums(x: np.ndarray, before: np.ndarray | None, after: np.ndarray) -> list[dict]:
    """What the vectors `x` that went from cluster `before` to `after` change in counts and sums; clusters without change left out."""
    found: dict[int, list] = {}
    for clusters, sign in ((before, -1), (after, 1)):
        if clusters is None:
            continue
        for c in np.unique(clusters).tolist():
            rows = x[clusters == c]
            n, s = found.get(c, (0, 0))
            found[c] = n + sign * len(rows), s + sign * rows.sum(axis=0, dtype=np.int64)
    return [{"cluster": c, "n": n, "sums": s.tolist()} for c, (n, s) in sorted(found.items())]


_STATE = ("size int, vectors binary, clusters binary, heap_sizes binary, heap_keys binary, heap_vectors binary, rescanned long, "
          "moved array<struct<cluster: int, n: long, sums: array<long>>>")
_STATE_ARROW = [("size", pa.int32()), ("vectors", pa.binary()), ("clusters", pa.binary()), ("heap_sizes", pa.binary()),
                ("heap_keys", pa.binary()), ("heap_vectors", pa.binary()), ("rescanned", pa.int64()),
                ("moved", pa.list_(pa.struct([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])))]


def _block(schema: pa.Schema, ids: pa.Array, x: np.ndarray, clusters: np.ndarray, heaps: Heaps, rescanned: int, moved: list) -> pa.RecordBatch:
    small = x.astype("<i2") if np.abs(x).max(initial=0) < 1 << 15 else x.astype("<i4")
    sizes, keys, vectors = heaps.pack()
    id_list = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
    values = [len(ids), small.tobytes(), clusters.astype("<i4").tobytes(), sizes, keys, vectors, rescanned, moved]
    return pa.RecordBatch.from_arrays([id_list, *[pa.array([v], t) for v, (_, t) in zip(values, _STATE_ARROW, strict=True)]], schema=schema)


def _matrix(blob: bytes, rows: int, size: int) -> np.ndarray:
    kind = "<i2" if len(blob) == rows * size * 2 else "<i4"
    return np.frombuffer(blob, kind).reshape(rows, size).astype(np.int32)


def _first(schema: pa.Schema, size: int, scale: int, centroids: np.ndarray):
    """Blocks from rows (id, embedding): every vector is scanned and entered into its cluster's heap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held = [], [], 0

        def out() -> pa.RecordBatch:
            all_ids, x = pa.concat_arrays(ids), np.concatenate(parts)
            own, _, gaps = nearest(x, centroids)
            heaps = Heaps([[] for _ in centroids])
            heaps.enter(range(len(x)), own, gaps, np.zeros(len(centroids)))
            return _block(schema, all_ids, x, own, heaps, len(x), moved_sums(x, None, own))

        for batch in batches:
            kept, x = integer_vectors(batch.column(1), size, scale)
            found = batch.column(0).filter(pa.array(kept, pa.bool_()))
            for a in range(0, len(x), BLOCK):
                ids.append(found.slice(a, BLOCK))
                parts.append(x[a:a + BLOCK])
                held += len(parts[-1])
                if held >= BLOCK:
                    yield out()
                    ids, parts, held = [], [], 0
        if held:
            yield out()
    return run


def _round(schema: pa.Schema, size: int, centroids: np.ndarray, offsets: np.ndarray):
    """Blocks from blocks: expired vectors are popped, rescanned against `centroids` and entered again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids = batch.column(0).slice(r, 1).flatten()
                n, blob, own, sizes, keys, vectors = (batch.column(c)[r].as_py() for c in range(1, 7))
                x, own = _matrix(blob, n, size), np.frombuffer(own, "<i4").copy()
                heaps = Heaps.unpack(sizes, keys, vectors)
                due = heaps.expired(offsets)
                moved: list = []
                if due:
                    again = x[due]
                    now, _, gaps = nearest(again, centroids)
                    heaps.enter(due, now, gaps, offsets)
                    changed = now != own[due]
                    moved = moved_sums(again[changed], own[due][changed], now[changed])
                    own[due] = now
                yield _block(schema, ids, x, own, heaps, len(due), moved)
    return run


def drifts(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """By how much each cluster's gaps shrink: its own drift and the largest of the others, rounded up."""
    moved = np.sqrt(((old.astype(np.float64) - new.astype(np.float64)) ** 2).sum(axis=1))
    if len(moved) == 1:
        return moved
    order = np.argsort(moved)
    largest = np.full(len(moved), moved[order[-1]])
    largest[order[-1]] = moved[order[-2]]
    return (moved + largest) * (1 + _MARGIN)


def start_centroids(vectors: DataFrame, k: int, size: int, scale: int) -> np.ndarray:
    """The `k` kept vectors with the smallest sha256 of `2:<vec_id>`, in that order (null ids last, equal ids by components)."""
    prepare(vectors.sparkSession)
    ok = (F.size("embedding") == size) & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    top = (vectors.where(ok).withColumn("hash", F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256))
           .orderBy(F.col("hash").asc_nulls_last(), "embedding").limit(k).select("embedding").toArrow())
    if not top.num_rows:
        return np.zeros((0, size), np.int64)
    return integer_vectors(top.column(0).combine_chunks(), size, scale)[1].astype(np.int64)


def heap_kmeans(vectors: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, scale: int = SCALE, id_col: str = "vec_id",
                vector_col: str = "embedding") -> DataFrame:
    """Cluster the vectors of `vectors`; one row per kept vector.

    Kept are vectors of exactly `size` components, none null or non-finite; each
    component x becomes floor(scale * x). Each of `rounds` rounds assigns every
    vector to the nearest centroid (ties: smaller number) and replaces every
    non-empty centroid by the floor of its vectors' mean; then vectors are
    assigned once more. Returns vec_id, cluster, distance (squared),
    cluster_inertia, inertia, centroid_sha256 and rescanned (how many vectors were scanned,
    summed over all assignments; `k` scans per vector and assignment are the plain method's).

    Null and repeated identifiers are rows like others; fewer vectors than `k`
    give fewer centroids, an empty table no rows; other columns are ignored.
    Components beyond 2^26 after scaling raise an OverflowError, since their
    distances need not fit a long. Eager: each assignment is a job, and its
    state replaces that of the one before in the shared folder.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("embedding"))
    id_kind = rows.schema["vec_id"].dataType
    centroids = start_centroids(rows, k, size, scale)
    schema = pa.schema([("ids", pa.list_(_arrow_type(id_kind))), *_STATE_ARROW])
    ddl = f"ids array<{id_kind.simpleString()}>, {_STATE}"
    folder = scratch(spark, "kmeans")
    k = len(centroids)
    counts, sums, offsets = [0] * k, [[0] * size for _ in range(k)], np.zeros(k)
    rescanned = 0
    state = rows.mapInArrow(_first(schema, size, scale, centroids), ddl)
    for step in range(rounds + 1):
        path = f"{folder}/{step}"
        state.write.option("compression", "zstd").parquet(path)
        state = spark.read.schema(state.schema).parquet(path)
        if step:
            discard(spark, f"{folder}/{step - 1}")
        rescanned += state.agg(F.sum("rescanned")).first()[0] or 0
        if step == rounds:
            break
        for c, n, by_component in _gathered(state):
            counts[c] += n
            sums[c] = [a + b for a, b in zip(sums[c], by_component, strict=True)]
        new = np.array([[s // counts[c] for s in sums[c]] if counts[c] else centroids[c].tolist() for c in range(k)],
                       np.int64).reshape(k, size)
        offsets = offsets + drifts(centroids, new) if k else offsets
        centroids = new
        state = state.select("ids", "size", "vectors", "clusters", "heap_sizes", "heap_keys", "heap_vectors").mapInArrow(
            _round(schema, size, centroids, offsets), ddl)
    return _assigned(state, id_kind, size, centroids, rescanned)


def _gathered(state: DataFrame) -> list[tuple[int, int, list[int]]]:
    """(cluster, change of count, change of sums) over all blocks: at most k rows come back."""
    cells = (state.select(F.inline("moved")).select("cluster", "n", F.posexplode("sums").alias("at", "v"))
             .groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("v")))
    rows = cells.groupBy("cluster").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "v"))).alias("s"))
    return [(r.cluster, r.n, [int(v) for _, v in r.s]) for r in rows.collect()]


def _assigned(state: DataFrame, id_kind: T.DataType, size: int, centroids: np.ndarray, rescanned: int) -> DataFrame:
    """One row per vector from the last blocks, with distances taken again and inertias summed by Spark."""
    fields = pa.schema([("vec_id", _arrow_type(id_kind)), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                n, blob, own = (batch.column(c)[r].as_py() for c in range(1, 4))
                x, own = _matrix(blob, n, size), np.frombuffer(own, "<i4")
                d = ((x.astype(np.int64) - centroids[own]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(r, 1).flatten(), pa.array(own), pa.array(d)], schema=fields)

    rows = state.select("ids", "size", "vectors", "clusters").mapInArrow(
        run, f"vec_id {id_kind.simpleString()}, cluster int, distance long")
    spark = state.sparkSession
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    inertia = {r[0]: r[1] for r in rows.groupBy("cluster").agg(F.sum("distance")).collect()}  # one row a centroid
    table = spark.createDataFrame([(c, inertia[c], sum(inertia.values()), sha[c], rescanned) for c in sorted(inertia)],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, rescanned long")
    return rows.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "rescanned")
