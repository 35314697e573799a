"""Token-ID output: bit-plane or byte-plane shuffled, zstandard-compressed blocks with a chunk index.

A store is a folder of Parquet files, written by Spark's committed writer (any
file system, safe against lost or repeated tasks). One row is one chunk:

    shard     long            the range of documents; shards ascend with doc_id
    chunk     long            number of the chunk within its shard
    first     long            ids of the shard before this chunk
    n_ids     long            ids in the chunk: BLOCK, fewer in a shard's last one
    planes    array<binary>   the block's planes, each one zstandard frame
    docs      array<struct<doc_id, number, begin, n>>   the documents that have ids in the
              chunk, their number in the shard, their first id in the shard, their ids

The columns besides `planes` are the chunk index; Parquet reads them without the planes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, prepare
from tidemark.llm.tokens import encode_all, tokenizer_path
from tidemark.llm.words import slices

#: Ids in a block.
BLOCK = 1 << 16
SCHEMA = ("shard long, chunk long, first long, n_ids long, planes array<binary>, "
          "docs array<struct<doc_id: {id}, number: long, begin: long, n: long>>")


def shuffle_planes(ids: np.ndarray, kind: str = "byte") -> list[bytes]:
    """The block's 4 byte planes (least byte first), or 32 bit planes (least bit first)."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [p.tobytes() for p in raw.T]
    return [np.packbits(b).tobytes() for b in np.unpackbits(raw, axis=1, bitorder="little").T]


def unshuffle_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The ids of planes; the kind follows from how many there are."""
    if len(planes) == 4:
        raw = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").ravel()


def _writer(path: str, end_id: int, kind: str, level: int, id_type: pa.DataType):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        press = zstandard.ZstdCompressor(level=level)
        shard, end = TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes()
        held, docs, chunk, total, number = bytearray(), [], 0, 0, 0

        def row(block: bytes) -> pa.RecordBatch:
            first, n = chunk * BLOCK, len(block) // 4
            return pa.record_batch([
                pa.array([shard], pa.int64()), pa.array([chunk], pa.int64()), pa.array([first], pa.int64()),
                pa.array([n], pa.int64()),
                pa.array([[press.compress(p) for p in shuffle_planes(np.frombuffer(block, "<u4"), kind)]],
                         pa.list_(pa.binary())),
                pa.array([[d for d in docs if d["begin"] < first + n]], pa.list_(pa.struct(
                    [("doc_id", id_type), ("number", pa.int64()), ("begin", pa.int64()), ("n", pa.int64())])))],
                names=["shard", "chunk", "first", "n_ids", "planes", "docs"])

        for whole in batches:
            for batch in slices(whole, "text"):
                for doc_id, ids in zip(batch.column(0).to_pylist(), encode_all(path, batch.column(1).to_pylist()), strict=True):
                    ids += end
                    docs.append({"doc_id": doc_id, "number": number, "begin": total, "n": len(ids) // 4})
                    held += ids
                    total += len(ids) // 4
                    number += 1
                    while len(held) >= 4 * BLOCK:
                        yield row(bytes(held[:4 * BLOCK]))
                        del held[:4 * BLOCK]
                        chunk += 1
                        docs = [d for d in docs if d["begin"] + d["n"] > chunk * BLOCK]
        if held:
            yield row(bytes(held))
    return write


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, kind: str = "byte",
                level: int = 3, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append `end_id`, and write the ids in ascending order of the identifier.

    Spark range-partitions and sorts the documents; each task encodes its range
    in order and writes it as one shard, so texts are shuffled once and ids never.
    Null text is empty (only the end id); null identifiers come first; rows that
    repeat an identifier are all written, in the order of their texts; an empty
    table gives an empty store; other columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    base = id_and_text(docs, id_col, text_col)
    id_type = base.schema["doc_id"].dataType
    arrow_id = pa.string() if id_type.simpleString() == "string" else pa.int32() if id_type.simpleString() == "int" else pa.int64()
    (base.withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h")
     .sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
     .mapInArrow(_writer(tokenizer or tokenizer_path(), end_id, kind, level, arrow_id),
                 SCHEMA.format(id=id_type.simpleString()))
     .write.option("compression", "none").parquet(path))


def _reader(id_type: pa.DataType):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            out = {k: [] for k in ("shard", "chunk", "doc_id", "number", "begin", "n", "got", "crc")}
            for r in batch.to_pylist():
                ids = unshuffle_planes([unpress.decompress(p) for p in r["planes"]], r["n_ids"])
                for d in r["docs"]:
                    part = ids[max(0, d["begin"] - r["first"]):d["begin"] + d["n"] - r["first"]]
                    for k, v in (("shard", r["shard"]), ("chunk", r["chunk"]), ("doc_id", d["doc_id"]), ("number", d["number"]),
                                 ("begin", d["begin"]), ("n", d["n"]), ("got", len(part)), ("crc", zlib.crc32(part.tobytes()))):
                        out[k].append(v)
            yield pa.record_batch([pa.array(v, id_type if k == "doc_id" else pa.int64()) for k, v in out.items()],
                                  names=list(out))
    return read


def _joined_crc(crcs, lengths) -> int:
    """The CRC-32 of a document's parts one after another, from the parts' own (CRC-32 is linear)."""
    if len(crcs) == 1:
        return crcs[0]
    total = 0
    for crc, n in zip(crcs, lengths, strict=True):
        zeros = bytes(4 * n)
        total = zlib.crc32(zeros, total) ^ zlib.crc32(zeros) ^ crc
    return total


def _join_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = batch.column(batch.schema.get_field_index("parts")).to_pylist()
        yield pa.record_batch([*batch.columns[:-1], pa.array([sum(p["got"] for p in ps) for ps in parts], pa.int64()),
                               pa.array([_joined_crc([p["crc"] for p in ps], [p["got"] for p in ps]) for ps in parts], pa.int64())],
                              names=["shard", "doc_id", "number", "begin", "n_tokens", "ids_crc32"])


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a store, from its decoded chunks: doc_id, start, n_tokens, ids_crc32.

    Chunks are decoded independently; a document that crosses chunks is put
    together from its parts' lengths and checksums, not from its ids. `start`
    adds the ids of earlier shards, from the chunk index (a row per shard).
    """
    prepare(spark, 64)
    chunks = spark.read.parquet(path)
    id_type = chunks.schema["docs"].dataType.elementType["doc_id"].dataType.simpleString()
    arrow_id = pa.string() if id_type == "string" else pa.int32() if id_type == "int" else pa.int64()
    parts = chunks.mapInArrow(_reader(arrow_id), f"shard long, chunk long, doc_id {id_type}, number long, begin long, "
                                                 "n long, got long, crc long")
    docs = (parts.groupBy("shard", "doc_id", "number", "begin")
            .agg(F.sort_array(F.collect_list(F.struct("chunk", "got", "crc"))).alias("parts"))
            .mapInArrow(_join_parts, f"shard long, doc_id {id_type}, number long, begin long, n_tokens long, ids_crc32 long"))
    sizes = chunks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    offsets = sizes.select("shard", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("offset"))
    return docs.join(offsets, "shard").select("doc_id", (F.col("offset") + F.col("begin")).alias("start"),
                                              "n_tokens", "ids_crc32")
