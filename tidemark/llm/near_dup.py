"""MinHash near-duplicates: SuperMinHash signatures, banding, verification, union-find grouping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, prepare, row_key, staged
from tidemark.llm.groups import components
from tidemark.llm.spread import spread_join
from tidemark.llm.words import mix, shingle_set, slices, text_words

UNSET = np.uint64(0xFFFFFFFFFFFFFFFF)


def super_minhash(elements: np.ndarray, m: int) -> np.ndarray:
    """SuperMinHash signature (m 64-bit values) of a set of 64-bit hashes.

    Element x visits the m slots in a random order of its own (a Fisher-Yates
    shuffle drawn from x) and offers slot j-th visited the value j + r. Values of
    visit j exceed all of earlier visits, so the visits run level by level for
    all elements at once and stop when every slot is filled (early stopping).
    """
    sig = np.full(m, UNSET, np.uint64)
    order = None
    rows = np.arange(len(elements))
    pending = None  # the first draw, replayed when later levels need the permutations
    for level in range(m if len(elements) else 0):
        draw = mix(elements + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64))
        at = level + (((draw >> np.uint64(40)) * np.uint64(m - level)) >> np.uint64(24)).astype(np.int64)
        value = np.uint64(level << 40) | (draw & np.uint64((1 << 40) - 1))
        if level == 0:
            slot, pending = at, at
        else:
            if order is None:
                order = np.tile(np.arange(m, dtype=np.int32), (len(elements), 1))
                order[rows, pending] = 0
                order[:, 0] = pending
            slot = order[rows, at]
            order[rows, at] = order[:, level]
            order[:, level] = slot
        np.minimum.at(sig, slot, value)
        if not (sig == UNSET).any():
            break
    return sig


def _signer(k: int, m: int, band: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words = text_words(batch.column(2))
                sizes, keys, bands = [], [], []
                for i in range(len(words)):
                    s = shingle_set(words.of(i), k)
                    sizes.append(len(s))
                    # the set's identity: two independent 64-bit sums of its hashes
                    keys.append(np.array([s.sum(dtype=np.uint64), mix(s ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64)],
                                         np.uint64).tobytes() if len(s) else None)
                    sig = super_minhash(s, m).reshape(-1, band)
                    acc = np.zeros(len(sig), np.uint64)
                    for t in range(band):
                        acc = mix(acc + sig[:, t])
                    bands.append(acc.view(np.int64) if len(s) else None)
                yield pa.record_batch([*batch.columns[:2], pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                                       pa.array(bands, pa.list_(pa.int64()))],
                                      names=["row_key", "doc_id", "n_shingles", "set_key", "bands"])
    return sign


def _verifier(k: int, percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text_a", 4 << 20):
                a, b = text_words(batch.column(2)), text_words(batch.column(3))
                linked = []
                for i in range(len(a)):
                    x, y = shingle_set(a.of(i), k), shingle_set(b.of(i), k)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                yield pa.record_batch(batch.columns[:2], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))
    return verify


def _setter(k: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words = text_words(batch.column(1))
                found = [shingle_set(words.of(i), k).view(np.int64) for i in range(len(words))]
                yield pa.record_batch([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "shingles"])
    return sets


def _prefix_pairs(nodes: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different components among `nodes` (node, n, component) that could be similar enough.

    Prefix filtering, which loses no link: with every set in one order, rarest
    shingles first, two sets of n1 and n2 elements with at least `need` in common
    share one of their first n1-need+1 and n2-need+1. Rare shingles are those of
    few of these nodes, so what all copies share stays out of the prefixes.
    """
    sets = staged(texts.join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "text")
                  .mapInArrow(_setter(k), "node long, shingles array<long>"), "sets")
    each = sets.select("node", F.explode("shingles").alias("s"))
    common = each.groupBy("s").agg(F.count("*").alias("df"))
    first = F.ceil(F.col("n") * (100 - percent) / 100) + 1  # at least what any partner asks for
    prefix = (spread_join(each, common, "s", F.col("node")).groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("order"))
              .join(nodes, "node").select("node", "n", "component", F.posexplode(F.slice("order", F.lit(1), first.cast("int"))).alias("i", "x"))
              .where("x.df > 1").select("node", "n", "component", "i", F.col("x.s").alias("s")))
    prefix = staged(prefix, "prefix")
    mixed = prefix.groupBy("s").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("s")
    prefix = prefix.join(mixed, "s")
    other = prefix.select("s", *[F.col(c).alias(f"{c}2") for c in ("node", "n", "component", "i")])
    need = F.ceil((F.col("n") + F.col("n2")) * percent / (100 + percent) - 1e-9)
    return (prefix.join(other, "s").where((F.col("node") < F.col("node2")) & (F.col("component") != F.col("component2")))
            .where(F.least(F.col("n") - F.col("i"), F.col("n2") - F.col("i2")) >= need)
            .select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct())


def _linked(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the similarity, from the whole texts."""
    # a hub may be compared with a third of all documents: its comparisons are dealt over tasks
    rows = (spread_join(pairs.select("a", "b"), texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a", F.col("b"))
            .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
            .select("a", "b", "text_a", "text_b"))
    return rows.mapInArrow(_verifier(k, percent), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, slots: int = 128, band: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are runs of non-blank characters, A-Z folded; a document's set holds
    its distinct `shingle`-word shingles (fewer words: all of them as one).
    Documents are linked when their Jaccard similarity is at least `percent`/100
    on the full sets; component_id is the smallest doc_id reachable.

    1. Sign: one SuperMinHash signature per document, cut into slots/band bands
       (a pair at 0.8 shares no band of 4 with a probability of 5e-8).
    2. Documents with equal sets form a class, represented by its smallest row;
       only representatives go on, so copies cost nothing further.
    3. Verify: in each bucket the members are compared with its smallest, which
       joins most copies at once. The members of buckets that still hold several
       components are then compared across components, but for pairs that prefix
       filtering rules out, so no candidate link is lost; pairs inside a component
       would change nothing. Comparisons read the full sets.
    4. Components by union-find (`groups.components`).

    Any type of identifier that can be ordered will do. Rows are told apart by
    `row_key` (128 bits of identifier and text), so rows that repeat an
    identifier with different texts are documents of their own; rows that repeat
    both get equal rows. Null or blank texts have an empty set and are linked
    with nothing. A null doc_id is no smallest identifier: its component_id is
    that of the others it reaches, null if these have none either.

    kept: doc_id is the component_id (without identifier: stays). Further columns: row_key, and
    stays, true for exactly one row_key of every component (that of the smallest
    identifier, then the smallest row_key) and for texts with an empty set. An
    empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    base = id_and_text(docs, id_col, text_col).select(row_key(F.col("doc_id"), F.col("text")).alias("row_key"), "doc_id", "text")
    id_type = base.schema["doc_id"].dataType.simpleString()
    signed = staged(base.mapInArrow(_signer(shingle, slots, band),
                                    f"row_key string, doc_id {id_type}, n_shingles long, set_key binary, bands array<long>"), "signed")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key"))
    # equal sets have equal bands; nodes are numbered in the order of their smallest identifiers, so that the hub of a
    # bucket is its smallest document: the one that copies are likely to have been made from, and close to most of them
    classes = staged(signed.where("set_key is not null").groupBy("set_key")
                     .agg(least.alias("least"), F.max("n_shingles").alias("n"), F.any_value("bands").alias("bands"))
                     .orderBy("least").withColumn("node", F.monotonically_increasing_id()), "classes")
    members = classes.select("node", "n", F.posexplode("bands").alias("slot", "value"))
    buckets = (members.groupBy("slot", "value").agg(F.min("node").alias("hub"), F.min_by("n", "node").alias("n2"), F.count("*").alias("m"))
               .where("m > 1"))
    members = staged(members.join(buckets, ["slot", "value"]).select("slot", "value", "node", "n", "hub", "n2"), "members")

    involved = classes.select("node", F.col("least.row_key").alias("row_key")).join(members.select("node").distinct(), "node", "left_semi")
    texts = staged(base.select("row_key", "text").join(involved, "row_key").dropDuplicates(["row_key"])
                   .select(F.col("node").alias("doc_id"), "text"), "texts")

    # sets of too different sizes cannot be that similar
    pairs = (members.where((F.col("node") != F.col("hub")) & (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")))
             .select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
    links = staged(_linked(pairs, texts, shingle, percent), "links")
    labels = components(links)
    labelled = (members.join(labels, "node", "left")
                .select("slot", "value", "node", "n", F.coalesce("component", "node").alias("component")))
    split = (labelled.groupBy("slot", "value").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo < hi").select("slot", "value"))
    open_ = staged(labelled.join(split, ["slot", "value"]).select("node", "n", "component").distinct(), "open")
    if not open_.isEmpty():
        more = _linked(_prefix_pairs(open_, texts, shingle, percent), texts, shingle, percent)
        labels = components(staged(links.union(more), "links"))

    grouped = classes.select("node", "set_key", "least").join(labels, "node")  # classes with links
    first = grouped.groupBy("component").agg(F.min("least").alias("first"))
    of_class = (classes.select("set_key", "least").join(grouped.join(first, "component").select("set_key", "first"), "set_key", "left")
                .select("set_key", F.coalesce("first", "least").alias("first")))
    rows = spread_join(signed.drop("bands"), of_class, "set_key", F.col("row_key"), "left")
    alone = F.col("set_key").isNull()
    rows = rows.select("doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
                       "row_key", (alone | (F.col("row_key") == F.col("first.row_key"))).alias("stays"))
    return rows.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), "stays").alias("kept"),
                       "row_key", "stays")
