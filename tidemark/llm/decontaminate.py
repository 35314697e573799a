"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, prepare, staged
from tidemark.llm.words import Words, grams, slices, text_words

#: Words of a seed; share of an item's n-grams, the rarest ones, that seed it; seeds that a window needs.
SEED, RAREST, LEAST_SEEDS = 3, 0.75, 2
#: Items that may share a seed, unless an item has too few others; least weight of a word in an alignment.
SHARED, LEAST_WEIGHT = 8, 0.05
#: Alignment scores, and bytes of benchmark text handled in one pass over the documents.
MATCH, MISMATCH, GAP = 2, -1, -1
BLOCK_BYTES = 8 << 20
_LOW = np.uint64((1 << 22) - 1)


def align(a: np.ndarray, b: np.ndarray, weights: np.ndarray | None = None) -> tuple[float, int]:
    """Best local alignment score of two word sequences, and where it ends in `b` (exclusive).

    A word of `a` scores `weights` (default 1) times MATCH, MISMATCH or GAP; a word that only `b` has costs GAP times their mean.
    """
    at = np.arange(len(b) + 1)
    w = np.ones(len(a)) if weights is None else weights
    row = np.zeros(len(b) + 1)
    best, end = 0.0, 0
    aside = GAP * (float(w.mean()) if len(w) else 1.0) * at
    for x, weight in zip(a, w.tolist(), strict=True):
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + np.where(b == x, MATCH * weight, MISMATCH * weight), row[1:] + GAP * weight)
        # a gap of any length along b: the running maximum of score minus its cost so far
        row = np.maximum(np.maximum.accumulate(new - aside) + aside, 0)
        row[0] = 0
        j = int(row.argmax())
        if row[j] > best + 1e-9:
            best, end = float(row[j]), j
    return best, end


class Index:
    """Seeds of a block of items, as sorted arrays: n-gram hashes, and for each where it stands in which items.

    With corpus `counts` only the rarest n-grams of each item are seeds, and of these only those that at most
    SHARED items hold; an item that is left with fewer than LEAST_SEEDS takes its rarest, however many share them.
    An item of fewer than SEED words is one n-gram as a whole.
    `weights` says for each word of each item how rare among the items its rarest n-gram is: 1 where no other item
    has it, LEAST_WEIGHT at least, so that a phrase which many items share weighs little in an alignment with any.
    """

    def __init__(self, items: list[np.ndarray], counts: Mapping[int, int] | None = None) -> None:
        self.lengths = np.array([len(h) for h in items], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.lengths)])
        self.words = np.concatenate([np.zeros(0, np.uint64), *items])
        self.sizes = sorted(set(np.minimum(self.lengths[self.lengths > 0], SEED).tolist()))
        gram, place, item = self._grams()
        known, which = np.unique(gram, return_inverse=True)
        pair, of_pair = np.unique(item * max(len(known), 1) + which, return_inverse=True)  # an item's different n-grams
        pair_item, pair_gram = pair // max(len(known), 1), pair % max(len(known), 1)
        shared = np.bincount(pair_gram, minlength=len(known))
        self._weigh(shared[which], place, item)
        if counts is not None:
            n = np.fromiter((counts.get(g, 0) for g in known.tolist()), np.int64, len(known))
            seeds = self._rarest(pair_item, shared[pair_gram], n[pair_gram], known[pair_gram])[of_pair]
            gram, place, item = gram[seeds], place[seeds], item[seeds]
        order = np.lexsort((place, item, gram))
        self.hashes, start = np.unique(gram[order], return_index=True)
        self.start = np.append(start, len(order))
        self.item, self.place = item[order].astype(np.int32), (place - self.first[item])[order].astype(np.int32)
        self.sieve = np.zeros(int(_LOW) + 1, bool)
        self.sieve[(self.hashes & _LOW).astype(np.int64)] = True

    def _grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The n-grams of all items, where they stand in `words`, and their items."""
        of_word = np.repeat(np.arange(len(self.lengths)), self.lengths)
        size = np.minimum(self.lengths, SEED)[of_word]
        found, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for n in self.sizes:
            g = grams(self.words, n)
            p = np.arange(len(g))
            p = p[(size[p] == n) & (of_word[p] == of_word[p + n - 1])]
            found.append(g[p])
            places.append(p)
        places = np.concatenate(places)
        return np.concatenate(found), places, of_word[places]

    def _weigh(self, shared: np.ndarray, place: np.ndarray, item: np.ndarray) -> None:
        total = math.log(len(self.lengths) + 1)
        weight = np.log((len(self.lengths) + 1) / shared) / total if len(shared) else np.zeros(0)
        self._weights = np.full(len(self.words), LEAST_WEIGHT)
        for t in range(SEED):
            inside = place + t < self.first[item + 1]
            np.maximum.at(self._weights, place[inside] + t, weight[inside])

    @staticmethod
    def _rarest(item: np.ndarray, shared: np.ndarray, n: np.ndarray, gram: np.ndarray) -> np.ndarray:
        """Which of the items' different n-grams (grouped by item) are seeds."""
        order = np.lexsort((gram, n, shared > SHARED, item))
        many = np.bincount(item)
        rank = np.empty(len(item), np.int64)
        rank[order] = np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many)
        chosen = (many <= 4)[item] | (rank < np.ceil(RAREST * many)[item])
        own = chosen & (shared <= SHARED)
        enough = np.bincount(item, weights=own, minlength=len(many)) >= LEAST_SEEDS
        return np.where(((many > 4) & enough)[item], own, chosen)

    @property
    def where(self) -> dict[int, list[tuple[int, int]]]:
        """Each seed's (item, place) pairs."""
        pairs = list(zip(self.item.tolist(), self.place.tolist(), strict=True))
        return {g: pairs[a:b] for g, a, b in zip(self.hashes.tolist(), self.start[:-1].tolist(), self.start[1:].tolist(), strict=True)}

    def of(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes and weights of item k."""
        return self.words[self.first[k]:self.first[k + 1]], self._weights[self.first[k]:self.first[k + 1]]

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Positions (in the batch's words) of all seeds in a batch, and which of `hashes` they are."""
        at, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        text_of = np.repeat(np.arange(len(words)), np.diff(words.ptr))
        for n in self.sizes:
            g = grams(words.hashes, n)
            p = np.flatnonzero(self.sieve[(g & _LOW).astype(np.int64)])
            p = p[text_of[p] == text_of[p + n - 1]]
            k = np.minimum(np.searchsorted(self.hashes, g[p]), len(self.hashes) - 1)
            same = self.hashes[k] == g[p]
            at.append(p[same])
            found.append(k[same])
        return np.concatenate(at), np.concatenate(found)

    def stretches(self, text: np.ndarray, at: np.ndarray, found: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, first word, end) of the stretches to align, by text, item and place: around seeds (`found`, at word `at`
        of `text`) whose implied starts of an item lie near each other, with a quarter of the item to either side."""
        many = self.start[found + 1] - self.start[found]
        up = np.repeat(np.arange(len(found)), many)
        entry = np.arange(len(up)) - np.repeat(np.cumsum(many) - many, many) + self.start[found][up]
        text, at, item = text[up], at[up], self.item[entry].astype(np.int64)
        begin = at - self.place[entry]
        order = np.lexsort((at, begin, item, text))
        text, at, item, begin = text[order], at[order], item[order], begin[order]
        pad = (self.lengths // 4 + 4)[item]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (np.diff(begin) > pad[1:])
        group = np.cumsum(new) - 1
        seeds = np.unique(np.stack([group, at]), axis=1)[0] if len(group) else group  # places, each counted once
        least = np.minimum(LEAST_SEEDS, np.maximum(1, self.lengths[item] - SEED + 1))[new]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(new)) - 1
        keep = np.flatnonzero(np.bincount(seeds, minlength=len(first)) >= least)
        a, b = first[keep], last[keep]
        yield from zip(text[a].tolist(), item[a].tolist(), np.maximum(0, begin[a] - pad[a]).tolist(),
                       (begin[b] + self.lengths[item[b]] + pad[b]).tolist(), strict=True)


def _counter(index: Index):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(index.hashes), np.int64)
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                words = text_words(batch.column(1), trim=True)
                at, found = index.hits(words)
                text = np.searchsorted(words.ptr, at, "right") - 1
                pairs = np.unique(np.stack([text, found]), axis=1) if len(at) else np.zeros((2, 0), int)
                total += np.bincount(pairs[1], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["gram", "n"])
    return count


def runs(text: np.ndarray, many: np.ndarray, most: int = 1 << 20) -> Iterator[np.ndarray]:
    """Hits in runs of whole texts that lead to at most `most` places of items together (a text with more stands alone)."""
    order = np.argsort(text, kind="stable")
    ends = np.append(np.flatnonzero(np.diff(text[order])) + 1, len(order))  # after each text's hits
    total = np.concatenate([[0], np.cumsum(many[order])])
    a = 0
    while a < len(order):
        b = int(ends[max(np.searchsorted(total[ends], total[a] + most, "right") - 1, np.searchsorted(ends, a, "right"))])
        yield order[a:b]
        a = b


def _finder(index: Index, keys: list[list], least_score: float, least_words: int, id_type: pa.DataType, item_type: pa.DataType):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                words = text_words(batch.column(1), trim=True)
                at, found = index.hits(words)
                text = np.searchsorted(words.ptr, at, "right") - 1
                best: dict[tuple[int, int], tuple[float, int, int]] = {}
                for part in runs(text, index.start[found + 1] - index.start[found]):
                    for t, k, a, b in index.stretches(text[part], at[part] - words.ptr[text[part]], found[part]):
                        (item, weights), mine = index.of(k), words.of(t)
                        score, end = align(item, mine[a:b], weights)
                        score /= MATCH * float(weights.sum())
                        if score > best.get((t, k), (0.0,))[0] + 1e-9:
                            _, length = align(item[::-1], mine[a:a + end][::-1], weights[::-1])
                            best[t, k] = (score, a + end - length, a + end)
                out = []
                for (t, k), (score, a, b) in best.items():
                    score, m = round(score, 9), int(index.lengths[k])  # sums of weights
                    if score >= least_score and score * m >= min(m, least_words) * least_score:
                        passage = words.text(int(words.ptr[t]) + a, int(words.ptr[t]) + b)
                        out += [(batch.column(0)[t].as_py(), key, score, a, b, passage) for key in keys[k]]
                columns = list(zip(*out, strict=True)) or [()] * 6
                yield pa.record_batch([pa.array(c, ty) for c, ty in zip(columns, (
                    id_type, item_type, pa.float64(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                    names=["doc_id", "item_id", "score", "start", "end", "passage"])
    return find


def _arrow(kind: str) -> pa.DataType:
    return {"string": pa.string(), "int": pa.int32()}.get(kind, pa.int64())


def contaminated(docs: DataFrame, benchmark: DataFrame, least_score: float = 0.5, least_words: int = 8,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages that copy a benchmark item: doc_id, item_id, score, start, end, passage.

    One row per (document, item): the best Smith-Waterman alignment of the whole
    item with the document, scored from 0 to 1 (1: the item word for word;
    match 2, mismatch and gap -1, times the word's weight, over twice the weights of the item's words), where it is at
    least `least_score`; a word weighs log((n+1)/d) / log(n+1), at least 0.05, where d of the n items hold
    the rarest 3-gram that it is part of, so a phrase that many items share is no copy of any of them; start and end count words, end exclusive. Words are
    compared without case (A-Z) and without punctuation at their ends.

    1. Corpus counts of the items' 3-grams, over all documents.
    2. Of each item the rarest three quarters of its 3-grams are seeds: rarity is
       relative to the item, so a passage that very many documents copy keeps
       its seeds. 3-grams that more than 8 items share are left out where an item
       has two others, so a hit leads to few items. A text's stretches with at least two seeds on nearby diagonals are aligned.

    Documents never move: the items' index (sorted arrays, about 40 bytes a word) goes to them, in blocks of at most
    8 MB of benchmark text, each a pass over all documents. Null and empty
    texts and items match nothing; an item of fewer than three words is a seed as
    a whole; repeated rows of documents give repeated results, repeated items
    one each (items of equal words are aligned once); empty tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    base = id_and_text(docs, id_col, text_col)
    kind, item_kind = base.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    items = benchmark.select("item_id", F.col("text").alias("item_text")).where("item_text is not null")
    size = items.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    found = None
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "item_text"), F.lit(blocks)) == block)
        rows = sorted(mine.distinct().collect(), key=lambda r: (r[0] is None, r[0], r[1]))  # a block, see above
        texts = text_words(pa.array([r[1] for r in rows], pa.string()), trim=True)
        same: dict[bytes, list[int]] = {}
        for i in range(len(rows)):
            same.setdefault(texts.of(i).tobytes(), []).append(i)  # items of the same words are one
        hashes = [texts.of(of[0]) for of in same.values()]
        keys = [list(dict.fromkeys(rows[i][0] for i in of)) for of in same.values()]
        index = Index(hashes)
        seen = (base.mapInArrow(_counter(index), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
                .toArrow())  # the block's n-grams
        counts = dict(zip(index.hashes[seen["gram"].to_numpy()].tolist(), seen["n"].to_pylist(), strict=True))
        part = base.mapInArrow(_finder(Index(hashes, counts), keys, least_score, least_words,
                                       _arrow(kind), _arrow(item_kind)),
                               f"doc_id {kind}, item_id {item_kind}, score double, start long, end long, passage string")
        part = staged(part, "leaks") if blocks > 1 else part
        found = part if found is None else found.unionByName(part)
    return found
