"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, held_out, id_and_text, prepare, scratch
from tidemark.llm.labelled import fitted, labelled_sample
from tidemark.llm.words import Words, mix, slices, text_words

#: Dimensions (4 of an index vector are not zero, one in each quarter), words to either side.
DIMENSIONS, WINDOW = 32, 2
#: A word has a vector from the whole corpus if it makes one in so many of all words, or more; no more than so many words can.
ONE_IN = 1 << 18
#: Words counted at a time within a task; words whose vectors are held at a time, however long their text.
CHUNK, BLOCK = 1 << 21, 1 << 15
#: Bytes that are capitals, digits, ASCII punctuation.
CLASSES = np.zeros((3, 256), bool)
CLASSES[0, 0x41:0x5B] = CLASSES[1, 0x30:0x3A] = True
CLASSES[2, 0x21:0x7F] = True
CLASSES[2] &= ~(CLASSES[0] | CLASSES[1])
CLASSES[2, 0x61:0x7B] = False


class Table(NamedTuple):
    """What the corpus says of its frequent words (or shapes): ascending hashes, unit vectors, weights; and the mean context of all words."""

    hashes: np.ndarray
    vectors: np.ndarray
    weight: np.ndarray
    mean: np.ndarray


def index_vectors(hashes: np.ndarray) -> np.ndarray:
    """Each hash's sparse random index vector, by its bits: +1 or -1 at one place of every quarter."""
    bits = mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    out = np.zeros((len(hashes), DIMENSIONS), np.int8)
    row, quarter = np.arange(len(hashes)), DIMENSIONS // 4
    for k in range(4):
        place = ((bits >> np.uint64(16 * k)) % np.uint64(quarter)).astype(np.int64)
        out[row, quarter * k + place] = 1 - 2 * ((bits >> np.uint64(16 * k + 15)) & np.uint64(1)).astype(np.int8)
    return out


def shapes(words: Words) -> np.ndarray:
    """For every word a hash of its shape: the class of its first two and last two bytes (the byte
    itself unless a letter), its length, whether it repeats the word before."""
    kind = np.arange(256, dtype=np.int64)
    kind[0x30:0x3A], kind[0x41:0x5B], kind[0x61:0x7B], kind[0x80:] = 1, 2, 3, 4
    data, s, e = words.data, words.starts, words.ends
    if not len(s):
        return np.zeros(0, np.uint64)
    again = np.zeros(len(s), np.int64)
    again[1:] = words.hashes[1:] == words.hashes[:-1]
    shape = np.minimum(e - s, 15) * 2 + again
    for at in (s, np.minimum(s + 1, e - 1), np.maximum(e - 2, s), e - 1):
        shape = shape * 256 + kind[data[at]]
    return mix(shape.astype(np.uint64))


def streams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The two sequences that get vectors: the words, and their shapes."""
    return words.hashes, shapes(words)


def text_of_words(words: Words) -> np.ndarray:
    """For every word the number of its text in the batch."""
    return np.repeat(np.arange(len(words)), np.diff(words.ptr))


class Block(NamedTuple):
    """At most BLOCK words of a batch, whatever their texts: `which` of the `different` hashes each is, and the sum of
    the index vectors of the words around each in its text."""

    lo: int
    hi: int
    different: np.ndarray
    which: np.ndarray
    around: np.ndarray


def blocks(hashes: np.ndarray, text_of: np.ndarray) -> Iterator[Block]:
    for lo in range(0, len(hashes), BLOCK):
        hi = min(lo + BLOCK, len(hashes))
        a, b = max(lo - WINDOW, 0), min(hi + WINDOW, len(hashes))
        different, which = np.unique(hashes[a:b], return_inverse=True)
        vectors = index_vectors(different)[which]
        around = np.zeros_like(vectors)
        for o in range(1, WINDOW + 1):
            around[o:] += vectors[:-o]
            around[:-o] += vectors[o:]
            apart = np.flatnonzero(text_of[a + o:b] != text_of[a:b][:-o])
            around[apart + o] -= vectors[apart]
            around[apart] -= vectors[apart + o]
        yield Block(lo, hi, different, which[lo - a:hi - a], around[lo - a:hi - a])


def places(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Where each hash stands among the ascending `known`, or -1."""
    if not len(known):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at, -1)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk of a task's words: every different word and shape with its count."""
    def counted(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for k, parts in enumerate(zip(*held)):
            found, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.record_batch([pa.array(np.full(len(found), k, np.int32)), pa.array(found.view(np.int64)), pa.array(n)],
                                  names=["stream", "word", "n"])

    held, size = [], 0
    for whole in batches:
        for batch in slices(whole, "text", 1 << 20):
            words = text_words(batch.column(1))
            held.append(streams(words))
            size += len(words.starts)
            if size >= CHUNK:
                yield from counted(held)
                held, size = [], 0
    yield from counted(held)


def _context_sums(known: list[np.ndarray]) -> Callable:
    """Per task: the sum of the contexts of every known word, and behind these that of all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((len(k) + 1, DIMENSIONS), np.int64) for k in known]
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                words = text_words(batch.column(1))
                text_of = text_of_words(words)
                for total, table, hashes in zip(sums, known, streams(words)):
                    for block in blocks(hashes, text_of):
                        total[-1] += block.around.sum(0, dtype=np.int64)
                        at = places(block.different, table)
                        order = np.argsort(block.which.astype(np.uint16) if len(at) <= 1 << 16 else block.which, kind="stable")
                        n = np.bincount(block.which, minlength=len(at))
                        seen = np.flatnonzero(n)
                        each = np.add.reduceat(block.around[order], (np.cumsum(n) - n)[seen], axis=0, dtype=np.int64)
                        known_here = at[seen] >= 0
                        total[at[seen][known_here]] += each[known_here]
        for k, total in enumerate(sums):
            seen = np.flatnonzero(total.any(1))
            for i in range(0, len(seen), 8192):
                at = seen[i:i + 8192]
                ends = pa.array(np.arange(len(at) + 1, dtype=np.int32) * DIMENSIONS)
                yield pa.record_batch([pa.array(np.full(len(at), k, np.int32)), pa.array(at),
                                       pa.ListArray.from_arrays(ends, pa.array(total[at].ravel()))], names=["stream", "at", "v"])
    return run


def word_vectors(docs: DataFrame, one_in: int = ONE_IN) -> list[Table]:
    """Random-indexing vectors over all of `docs` (doc_id, text), one table for words and one for shapes.

    All words are counted exactly by Spark; those that make one in `one_in` of
    all words are at most `one_in`, and only they come to the driver. A second
    pass sums their contexts over all texts: each task adds up its own, Spark
    adds those of the tasks. A word's vector is this sum less what as many mean
    contexts would give, at length one. No two words share a vector.
    """
    spark = docs.sparkSession
    prepare(spark)
    path = scratch(spark, "word-counts")
    (docs.mapInArrow(_counts, "stream int, word long, n long").groupBy("stream", "word").agg(F.sum("n").alias("n"))
     .write.parquet(path))
    counts = spark.read.schema("stream int, word long, n long").parquet(path)
    total = counts.where("stream = 0").agg(F.sum("n")).first()[0] or 0
    least = max(1, -(-total // one_in))
    frequent = counts.where(F.col("n") >= least).toPandas()  # at most `one_in` rows of each stream
    discard(spark, path)

    known, n = [], []
    for k in range(2):
        rows = frequent[frequent["stream"] == k]
        hashes = rows["word"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(hashes)
        known.append(hashes[order])
        n.append(rows["n"].to_numpy(np.float64)[order])
    sums = [np.zeros((len(k) + 1, DIMENSIONS)) for k in known]
    rows = docs.mapInArrow(_context_sums(known), "stream int, at long, v array<long>")
    got = rows.groupBy("stream", "at").agg(*[F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(DIMENSIONS)]).toPandas()
    for k in range(2):
        mine = got[got["stream"] == k]
        sums[k][mine["at"].to_numpy(np.int64)] = mine.iloc[:, 2:].to_numpy(np.float64)
    out = []
    for hashes, count, v in zip(known, n, sums):
        mean = v[-1] / max(total, 1)
        vectors = v[:-1] - count[:, None] * mean
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-6)
        out.append(Table(hashes, vectors.astype(np.float32), 1e-3 / (1e-3 + count / max(total, 1)), mean.astype(np.float32)))
    return out


def pooled(words: Words, tables: list[Table]) -> np.ndarray:
    """Per text: the mean vector of its words and of their shapes (frequent ones count less),
    and six plain measures (words, word length, capitals, digits, punctuation, different words).

    A word without a row in its table, thus rarer than one in `one_in`, takes
    the vector of the one context it stands in here, less the mean context, at
    weight one.
    """
    n = len(words)
    out = np.zeros((n, 2 * DIMENSIONS + 6))
    if not len(words.starts):
        return out
    text_of = text_of_words(words)
    for k, (table, hashes) in enumerate(zip(tables, streams(words))):
        sums, weights = out[:, k * DIMENSIONS:(k + 1) * DIMENSIONS], np.zeros(n)
        for block in blocks(hashes, text_of):
            at = places(block.different, table.hashes)[block.which]
            vectors, weight = np.empty((len(at), DIMENSIONS)), np.ones(len(at))
            common, rare = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
            vectors[common], weight[common] = table.vectors[at[common]], table.weight[at[common]]
            own = block.around[rare] - table.mean
            vectors[rare] = own / np.maximum(np.sqrt(np.einsum("ij,ij->i", own, own)), 1e-6)[:, None]
            for i in range(text_of[block.lo], text_of[block.hi - 1] + 1):
                a, b = max(words.ptr[i] - block.lo, 0), min(words.ptr[i + 1], block.hi) - block.lo
                sums[i] += weight[a:b] @ vectors[a:b]
                weights[i] += weight[a:b].sum()
        sums /= np.maximum(weights, 1e-12)[:, None]
    data = words.data
    ends = np.zeros((3, len(data) + 1), np.int64)
    np.cumsum(CLASSES[:, data], axis=1, out=ends[:, 1:])
    for i in range(n):
        a, b = words.ptr[i], words.ptr[i + 1]
        if a == b:
            continue
        x, y = words.offsets[i], words.offsets[i + 1]
        out[i, -6:] = (np.log(b - a), (words.ends[a:b] - words.starts[a:b]).mean(),
                       *(ends[:, y] - ends[:, x]) / (y - x), len(np.unique(words.hashes[a:b])) / (b - a))
    return out


def scorer(model: Callable, tables: list[Table]) -> Callable[[pa.Array], np.ndarray]:
    """A function from an Arrow column of texts (no nulls) to scores."""
    def score(texts: pa.Array) -> np.ndarray:
        return model(pooled(text_words(texts), tables))
    return score


def fit_quality(docs: DataFrame, labels: DataFrame, most: int = 20000, label: str = "quality", one_in: int = ONE_IN) -> Callable:
    """Word vectors over all documents, then the network on at most `most` labelled ones; gives a `scorer`."""
    base = id_and_text(docs)
    tables = word_vectors(base, one_in)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                x = pooled(text_words(batch.column(1)), tables)
                yield pa.record_batch([batch.column(0), batch.column(2), pa.array(list(x), pa.list_(pa.float64()))],
                                      names=["doc_id", "y", "x"])

    sample = labelled_sample(base.withColumn("doc_id", F.col("doc_id").cast("long")), labels, label, most)
    rows = sample.select("doc_id", "text", "y").mapInArrow(features, "doc_id long, y int, x array<double>").toPandas()
    rows = rows.sort_values("doc_id", kind="stable")  # the fit does not depend on the order of tasks
    x = np.stack(rows["x"].to_list()) if len(rows) else np.zeros((0, 2 * DIMENSIONS + 6))
    return scorer(fitted(x, rows["y"].to_numpy()), tables)


def scored(docs: DataFrame, score: Callable, threshold: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every document, by a function of its whole text."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                yield pa.record_batch([batch.column(0), pa.array(score(batch.column(1)), pa.float64())], names=["doc_id", "score"])

    base = id_and_text(docs, id_col, text_col)
    rows = base.mapInArrow(run, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame, most: int = 20000, threshold: float = 0.5) -> DataFrame:
    """Per document: doc_id, held_out, score (1: good), predicted.

    Word vectors come from all documents (a word rarer than one in `ONE_IN` takes
    that of its context in the text at hand); labels only of rows that are not
    held out, at most `most` of them. Every row is scored, whole texts; null and
    empty texts get the score of a text without words; without labels of both
    kinds every score is the share of label 1 (or 0.5). A null doc_id is scored
    like any other; repeated rows get equal scores; an empty table gives no
    rows; other columns are ignored.
    """
    return scored(docs, fit_quality(docs, labels, most), threshold)
