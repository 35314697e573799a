"""Repeated passages by a sparse suffix array."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, prepare, staged
from tidemark.llm.spread import spread_join
from tidemark.llm.words import Words, grams, mix, powers, slices, text_words

#: Words of a minimiser.
MINIMISER = 8
#: Parts into which the suffixes of a key are dealt where they meet its one row.
PIECES = 64
_LOCAL = np.uint64((1 << 24) - 1)


class Runs:
    """Hashes of any runs of a batch's words, from running sums; equal runs agree wherever they stand."""

    def __init__(self, words: Words) -> None:
        n = len(words.hashes)
        up, self.down = powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words.hashes * up[:n], out=self.sums[1:])

    def __call__(self, at: np.ndarray, length: int) -> np.ndarray:
        return mix((self.sums[at + length] - self.sums[at]) * self.down[at])


def owned(words: Words, window: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Retained positions, and for each the first and last passage of `least` words that it stands for.

    A passage belongs to the position whose 8-gram is the least of the passage's first
    `window` ones (ties go to the leftmost), so equal passages choose equal positions wherever
    they stand. The passages of one position begin side by side.
    """
    h = grams(words.hashes, MINIMISER)
    n = len(h) - window + 1
    if n <= 0 or len(words.hashes) < least:
        return (np.zeros(0, np.int64),) * 3
    low = (h & ~_LOCAL) | (np.arange(len(h), dtype=np.uint64) & _LOCAL)
    size = 1
    while 2 * size <= window:  # minima of runs of 1, 2, 4, ...
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    low = np.minimum(low[:n], low[window - size:window - size + n])
    text_of = np.repeat(np.arange(len(words)), np.diff(words.ptr))
    n = len(text_of) - least + 1
    begin = np.flatnonzero(text_of[:n] == text_of[least - 1:])
    at = begin + ((low[begin] - begin.astype(np.uint64)) & _LOCAL).astype(np.int64)
    change = np.flatnonzero(at[1:] != at[:-1])
    first = np.concatenate((np.zeros(min(1, len(at)), np.int64), change + 1))
    last = np.concatenate((change, np.full(min(1, len(at)), len(at) - 1)))
    return at[first], begin[first], begin[last]


def _retained(words: Words, window: int, least: int):
    """Of every retained position: key (hash of the words from there that all its passages hold),
    context (hash of all its passages' words), first passage, its number of passages, text."""
    at, first, last = owned(words, window, least)
    run = Runs(words)
    keys = run(at, least - window + 1)
    with np.errstate(over="ignore"):
        contexts = mix(run(first, least) * np.uint64(0xD6E8FEB86659FD93) + run(last, least) + (last - first).astype(np.uint64))
    return keys.view(np.int64), contexts.view(np.int64), first, last - first + 1, np.searchsorted(words.ptr, first, "right") - 1, run


def _suffixes(window: int, least: int):
    """(key, context, doc_id, place) of the retained positions; place: first passage * window + passages - 1."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                words = text_words(batch.column(1))
                keys, contexts, first, n, text, _ = _retained(words, window, least)
                yield pa.record_batch([pa.array(keys), pa.array(contexts), batch.column(0).take(pa.array(text)),
                                       pa.array((first - words.ptr[text]) * window + n - 1)], names=["key", "context", "doc_id", "place"])
    return find


def _passages(window: int, least: int):
    """Every passage of the marked contexts, each with its hash: (key, passage, context, nth, lo, hi)."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                words = text_words(batch.column(1))
                marks = batch.column(2)
                marked = np.repeat(np.arange(len(words)), np.diff(np.asarray(marks.offsets)))
                flat = marks.flatten()
                place, key, context, hi = (np.asarray(flat.field(i)) for i in range(4))
                keys, contexts, first, n, _, run = _retained(words, window, least)
                row = np.searchsorted(first, words.ptr[marked] + place // window)
                own = row < len(first)
                own[own] = (keys[row[own]] == key[own]) & (contexts[row[own]] == context[own])  # else of an identifier's other row
                row, marked, hi = row[own], marked[own], hi[own]
                of = np.repeat(np.arange(len(row)), n[row])
                nth = np.arange(len(of)) - np.repeat(np.cumsum(n[row]) - n[row], n[row])
                yield pa.record_batch([pa.array(keys[row][of]), pa.array(run(first[row][of] + nth, least).view(np.int64)),
                                       pa.array(contexts[row][of]), pa.array(nth.astype(np.int32)),
                                       batch.column(0).take(pa.array(marked[of])), pa.array(hi[of])],
                                      names=["key", "passage", "context", "nth", "lo", "hi"])
    return find


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping spans of a document become one."""
    for batch in batches:
        out = []
        for doc, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            start, end, other = spans[0]["start"], spans[0]["end"], spans[0]["other"]
            for s in spans[1:]:
                if s["start"] > end:
                    out.append((doc, start, end, end - start, other))
                    start, end, other = s["start"], s["end"], s["other"]
                end, other = max(end, s["end"]), min(other, s["other"])
            out.append((doc, start, end, end - start, other))
        yield pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [()] * 5)],
                              names=["doc_id", "start_word", "end_word", "n_words", "other_doc"])


def repeated_passages(docs: DataFrame, least: int = 50, window: int = 20, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Passages of at least `least` words that stand in more than one document.

    One row per maximal stretch of a document that such passages cover: doc_id,
    start_word, end_word (exclusive), n_words, other_doc (the smallest identifier
    that shares part of it; in the document of the smallest, the smallest of the
    largest that share a part). Words are runs of non-blank characters, A-Z folded.

    Sparse suffix array: of a document's suffixes those at minimiser positions
    are retained, about 2 in window+1. Every passage of `least` words belongs to
    one among its first `window` words, so copies share at least
    least-window+1 words from there on. Suffixes whose first so many words stand
    in one document only are dropped (a pre-aggregated count). The others are counted by
    their context, all words of their passages: where a key has one context
    only, its passages are repeated as a whole. Of the contexts of other keys one
    copy each is read again, its passages are hashed, and the least and largest
    identifier per passage tell which stand in more than one document. So every
    passage is compared with all others of the corpus, by 64-bit hashes of all its words
    within equal keys, and a hot passage is added up before it is shuffled.

    Null and short texts have no such passage; rows with a null identifier are
    left out, since a result could not name them; rows that repeat an identifier are one
    document; an empty table gives no rows; other columns are ignored.
    """
    prepare(docs.sparkSession)
    base = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long")).where("doc_id is not null")
    suffixes = staged(base.mapInArrow(_suffixes(window, least), "key long, context long, doc_id long, place long"), "suffixes")
    # by key and piece first, so that a passage of a third of all documents is spread where its suffixes meet its count
    dealt = suffixes.withColumn("piece", F.pmod(F.xxhash64("doc_id", "place"), F.lit(PIECES)).cast("int"))
    pieces = staged(dealt.groupBy("key", "piece").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")), "pieces")
    repeated = pieces.groupBy("key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi").select("key")
    candidates = staged(dealt.join(pieces.join(repeated, "key").select("key", "piece"), ["key", "piece"]).drop("piece"), "candidates")
    contexts = staged(candidates.groupBy("key", "context")
                      .agg(F.min(F.struct("doc_id", "place")).alias("least"), F.max("doc_id").alias("hi"))
                      .select("key", "context", F.col("least.doc_id").alias("lo"), "least.place", "hi"), "contexts")
    contexts = spread_join(contexts, contexts.groupBy("key").agg(F.count("*").alias("n")), "key", F.col("context"), pieces=PIECES)
    alone = contexts.where("n = 1").select("key", "context", F.lit(0).alias("a"), (F.col("place") % window).cast("int").alias("b"), "lo", "hi")
    marks = (contexts.where("n > 1").groupBy(F.col("lo").alias("doc_id"))
             .agg(F.collect_list(F.struct("place", "key", "context", "hi")).alias("marks")))
    passages = staged(base.join(marks, "doc_id").select("doc_id", "text", "marks")
                      .mapInArrow(_passages(window, least), "key long, passage long, context long, nth int, lo long, hi long"), "passages")
    shared = passages.groupBy("key", "passage").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi")
    some = (passages.select("key", "passage", "context", "nth").join(shared, ["key", "passage"]).groupBy("key", "context")
            .agg(F.min("nth").alias("a"), F.max("nth").alias("b"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    # passages of one context overlap, so those from its first shared one to its last cover one stretch
    start = F.floor(F.col("place") / window)
    spans = (spread_join(candidates, alone.unionByName(some), ["key", "context"], F.struct("doc_id", "place"), pieces=PIECES)
             .select("doc_id", (start + F.col("a")).alias("start"), (start + F.col("b") + least).alias("end"),
                     F.when(F.col("lo") != F.col("doc_id"), F.col("lo")).otherwise(F.col("hi")).alias("other")).distinct())
    return (spans.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end", "other"))).alias("spans"))
            .mapInArrow(_merged, "doc_id long, start_word long, end_word long, n_words long, other_doc long"))
