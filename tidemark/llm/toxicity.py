"""Toxicity: a lexicon trie intersected with Levenshtein automata, and scores of context windows."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, prepare
from tidemark.llm.labelled import fitted, labelled_sample
from tidemark.llm.quality import scored
from tidemark.llm.words import Words, slices, text_words

#: Words on either side of a hit that its window holds.
WINDOW = 6
#: Words that speak to or about the reader, and words that report others' speech (fixed values).
ADDRESS = ("you", "your", "you're", "u", "ur", "are", "such", "du", "dein", "ihr", "tu", "vous", "toi", "tú", "eres", "usted")
REPORT = ("said", "says", "wrote", "called", "calls", "word", "term", "quote", "quoted", "quotes", "phrase", "insult",
          "slur", "sagte", "wort", "mot", "dit", "terme", "palabra", "dijo", "término")
QUOTES = "\"'`«»‘’“”„"
#: Least evidence for a learned term: log-likelihood ratio, share of toxic documents among those that hold it.
LEAST_G2, LEAST_SHARE = 25.0, 0.7
#: Letters of a word's beginning that may be a term of their own.
STEMS = (4, 5, 6)
#: Letters of a word up to which the automaton's rows fit 64 bits and words are walked many at a time; a longer word walks alone.
LONG = 60
#: States held at a time in a walk of many words, and words of a walk.
STATES, BLOCK = 1 << 20, 1024
_CACHE: dict = {}


def plain(raw: bytes) -> str:
    """A word in lower case, without punctuation and symbols (of all scripts) at either end."""
    word = raw.decode("utf-8", "replace")
    a, b = 0, len(word)
    while a < b and unicodedata.category(word[a])[0] in "PS":
        a += 1
    while a < b and unicodedata.category(word[b - 1])[0] in "PS":
        b -= 1
    return word[a:b].lower()


class Lexicon:
    """A trie of terms, walked together with words' Levenshtein automata.

    The automaton of a word of n letters is bit-parallel: row j has bit i set when
    i letters are read with j edits. States follow the trie's edges, and a branch
    ends where no state is alive, so the walk visits only prefixes within reach.
    `match` walks one word, `match_all` many words side by side, level by level.
    """

    def __init__(self, terms: list[str], stems: list[str]) -> None:
        self.terms, self.stems = sorted(terms), sorted(stems)
        self.trie: dict = {}
        for k, term in enumerate(self.terms):
            node = self.trie
            for c in term:
                node = node.setdefault(c, {})
            node[""] = k
        self._flatten()
        self._stems = frozenset(self.stems)
        self._stem_lengths = sorted({len(s) for s in self.stems})

    def _flatten(self) -> None:
        """The trie as arrays, a level after the other: each node's letter, children (side by side) and term and, as bits, the
        lengths of the terms at and below it that may be misspelt and that a word of LONG letters reaches, the letters that
        none of these terms has and those that all of them have (letters that share a bit count as one)."""
        letters = {c: k for k, c in enumerate(sorted({c for t in self.terms for c in t}))}
        nodes, letter, parent, first, children = [self.trie], [len(letters)], [0], [], []
        for k, node in enumerate(nodes):  # grows while it is read
            edges = [c for c in node if c]
            first.append(len(nodes))
            children.append(len(edges))
            nodes += [node[c] for c in edges]
            letter += [letters[c] for c in edges]
            parent += [k] * len(edges)
        term = [node.get("", -1) for node in nodes]
        below, some, all_ = [0] * len(nodes), [0] * len(nodes), [2**64 - 1] * len(nodes)
        for k in range(len(nodes) - 1, -1, -1):
            own = self.terms[term[k]] if term[k] >= 0 else ""
            if len(own) <= LONG + 2 and self.edits(len(own)):
                bits = sum({1 << (letters[c] & 63) for c in own})
                below[k], some[k], all_[k] = below[k] | 1 << len(own), some[k] | bits, all_[k] & bits
            if below[k]:
                below[parent[k]], some[parent[k]], all_[parent[k]] = below[parent[k]] | below[k], some[parent[k]] | some[k], all_[parent[k]] & all_[k]
        self._letters = letters
        self._letter, self._first, self._children, self._term = (np.array(x, np.int64) for x in (letter, first, children, term))
        self._below, self._none, self._every = np.array(below, np.uint64), ~np.array(some, np.uint64), np.array(all_, np.uint64)
        self._most = np.array([self.edits(len(t)) for t in self.terms], np.int64)

    @staticmethod
    def edits(n: int) -> int:
        """Misspellings allowed in a word of n letters."""
        return 0 if n < 5 else 1 if n < 8 else 2

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its distance, or None."""
        k, n = self.edits(len(word)), len(word)
        letters: dict[str, int] = {}
        for i, c in enumerate(word):
            letters[c] = letters.get(c, 0) | (2 << i)
        best, goal = None, 1 << n

        def step(rows: tuple, c: str) -> tuple:
            hit = letters.get(c, 0)
            new = [(rows[0] << 1) & hit]
            for j in range(1, k + 1):
                new.append(((rows[j] << 1) & hit) | rows[j - 1] | (rows[j - 1] << 1) | (new[j - 1] << 1))
            return tuple(new)

        rows = tuple((1 << (j + 1)) - 1 for j in range(k + 1))
        stack = [(self.trie, rows)]
        while stack:
            node, rows = stack.pop()
            term = node.get("")
            if term is not None:
                d = next((j for j, r in enumerate(rows) if r & goal), None)
                if d is not None and d <= self._most[term] and (best is None or (d, term) < best):
                    best = (d, term)
            for c, below in node.items():
                if c:
                    new = step(rows, c)
                    if any(r & ((goal << 1) - 1) for r in new):
                        stack.append((below, new))
        return (self.terms[best[1]], best[0]) if best else None

    def match_all(self, words: list[str]) -> dict[str, tuple[str, int]]:
        """The nearest term and its distance of those different words that have one within reach."""
        lens = np.array([len(w) for w in words], np.int64)
        found = {words[i]: self.match(words[i]) for i in np.flatnonzero(lens > LONG).tolist()}
        found = {w: m for w, m in found.items() if m}
        edits = np.array([self.edits(n) for n in range(LONG + 1)])
        for k in (1, 2):
            some = np.flatnonzero((lens <= LONG) & (edits[np.minimum(lens, LONG)] == k))
            for part in np.split(some, range(BLOCK, len(some), BLOCK)):
                found |= self._walk([words[i] for i in part.tolist()], lens[part], k)
        return found

    def _walk(self, words: list[str], lens: np.ndarray, k: int) -> dict[str, tuple[str, int]]:
        """`match_all` of words of at most LONG letters that may be misspelt in k.

        A state is (word, node, k+1 rows); states that are alive are replaced by those of the node's children, a chunk at a time.
        """
        one = np.uint64(1)
        strange = len(self._letters)
        mask = np.zeros((len(words), strange + 1), np.uint64)  # a letter's places in each word; the last: letters of no term
        codes = np.array([self._letters.get(c, strange) for c in "".join(words)], np.int64)
        owner = np.repeat(np.arange(len(words)), lens)
        place = np.arange(len(codes)) - np.repeat(np.cumsum(lens) - lens, lens)
        np.bitwise_or.at(mask, (owner, codes), np.uint64(2) << place.astype(np.uint64))
        bag = np.zeros(len(words), np.uint64)
        np.bitwise_or.at(bag, owner[codes < strange], one << (codes[codes < strange] & 63).astype(np.uint64))
        spare = k - np.bitwise_count(mask[:, strange]).astype(np.int64)  # each letter of no term is an edit
        goal = one << lens.astype(np.uint64)
        within = (goal << one) - one
        reach = sum(one << np.uint64(d) for d in range(2 * k + 1)) << (lens - k).astype(np.uint64)  # lengths of terms within k
        best = np.full(len(words), np.iinfo(np.int64).max)
        start = [np.full(len(words), (1 << (j + 1)) - 1, np.uint64) for j in range(k + 1)]
        likely = np.flatnonzero(spare >= 0)
        stack = [(likely, np.zeros(len(likely), np.int64), [r[likely] for r in start])]
        while stack:
            word, node, rows = stack.pop()
            many = self._children[node]
            if many.sum() > STATES and len(word) > 1:
                half = len(word) // 2
                stack += [(word[c], node[c], [r[c] for r in rows]) for c in (slice(half), slice(half, None))]
                continue
            up = np.repeat(np.arange(len(word)), many)
            node = np.arange(len(up)) - np.repeat(np.cumsum(many) - many, many) + self._first[node][up]
            mine = word[up]
            near = np.flatnonzero(((self._below[node] & reach[mine]) > 0)
                                  & (np.bitwise_count(bag[mine] & self._none[node]) <= spare[mine])
                                  & (np.bitwise_count(self._every[node] & ~bag[mine]) <= k))
            up, node = up[near], node[near]
            word, rows = word[up], [r[up] for r in rows]
            hit = mask[word, self._letter[node]]
            new = [(rows[0] << one) & hit]
            for j in range(1, k + 1):
                new.append(((rows[j] << one) & hit) | rows[j - 1] | (rows[j - 1] << one) | (new[j - 1] << one))
            alive = np.flatnonzero(new[k] & within[word])  # what is read with fewer edits is read with k
            word, node, rows = word[alive], node[alive], [r[alive] for r in new]
            term = self._term[node]
            for j in range(k, -1, -1):
                end = np.flatnonzero((term >= 0) & ((rows[j] & goal[word]) > 0))
                end = end[self._most[term[end]] >= j]
                np.minimum.at(best, word[end], j * len(self.terms) + term[end])
            if len(word):
                stack.append((word, node, rows))
        got = np.flatnonzero(best < np.iinfo(np.int64).max)
        return {words[w]: (self.terms[v % len(self.terms)], v // len(self.terms)) for w, v in zip(got.tolist(), best[got].tolist(), strict=True)}

    def stem(self, word: str) -> str | None:
        return next((word[:n] for n in self._stem_lengths if word[:n] in self._stems), None)


class Finder:
    """Finds a lexicon's hits in a batch of words.

    A worker looks at each different word once; the automata of a batch's new words walk the
    whole trie side by side. The comparison is by characters of the lower-cased word, whatever their bytes.
    """

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon
        self.terms = frozenset(lexicon.terms)
        self.longest = max(map(len, lexicon.terms), default=0) + 2
        self.key = (tuple(lexicon.terms), tuple(lexicon.stems))

    def _hits(self, words: list[str]) -> list[tuple[int, str] | None]:
        """(kind, term) of lower-cased words."""
        near = self.lexicon.match_all(list({w for w in words if 5 <= len(w) <= self.longest and w not in self.terms}))
        out: list[tuple[int, str] | None] = []
        for w in words:
            if w in self.terms:
                out.append((0, w))
            elif w in near:
                out.append((1, near[w][0]))
            else:
                stem = self.lexicon.stem(w)
                out.append((2, stem) if stem else None)
        return out

    def find(self, words: Words) -> list[tuple[int, int, str]]:
        """(word, kind, term): kind 0 exact, 1 misspelt, 2 stem."""
        if not len(words.starts):
            return []
        hashes, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
        cache = _CACHE.setdefault(self.key, {})
        if len(cache) > 500_000:
            cache.clear()
        hashes = hashes.tolist()
        new = [k for k, h in enumerate(hashes) if h not in cache]
        spans = zip(words.starts[first[new]].tolist(), words.ends[first[new]].tolist(), strict=True)
        cache.update(zip((hashes[k] for k in new), self._hits([plain(words.data[s:e].tobytes()) for s, e in spans]), strict=True))
        hits = [cache[h] for h in hashes]
        at = np.flatnonzero(np.array([h is not None for h in hits])[which])
        return [(i, *hits[k]) for i, k in zip(at.tolist(), which[at].tolist(), strict=True)]


def context(words: Words, text: int, at: int) -> tuple[bool, bool]:
    """Whether the window around a hit quotes it, and whether it addresses someone."""
    a, b = max(words.ptr[text], at - WINDOW), min(words.ptr[text + 1], at + WINDOW + 1)
    before, hit, after = words.text(a, at).lower(), words.text(at, at + 1), words.text(at + 1, b).lower()
    around = {w.strip(".,;:!?()" + QUOTES) for w in (before + " " + after).split()}
    opened = sum(before.count(q) for q in QUOTES) % 2 == 1 and any(q in after or q in hit for q in QUOTES)
    marked = hit[:1] in QUOTES and hit.rstrip(".,;:!?")[-1:] in QUOTES
    return opened or marked or not around.isdisjoint(REPORT), not around.isdisjoint(ADDRESS)


def features(words: Words, finder: Finder) -> np.ndarray:
    """Per text: logs of its hits that are used rather than quoted (exact, misspelt, stem), of quoted
    and of addressing ones, of different terms, and the share of its words that are hits."""
    out = np.zeros((len(words), 7))
    terms: list[set] = [set() for _ in range(len(words))]
    hits = finder.find(words)
    texts = np.searchsorted(words.ptr, [h[0] for h in hits], "right") - 1
    for (at, kind, term), text in zip(hits, texts.tolist(), strict=True):
        quoted, addressed = context(words, text, at)
        if quoted:
            out[text, 3] += 1
        else:
            out[text, kind] += 1
            out[text, 4] += addressed
            terms[text].add(term)
    used = out[:, :3].sum(1)
    out[:, :5] = np.log1p(out[:, :5])
    out[:, 5] = np.log1p([len(t) for t in terms])
    out[:, 6] = used / np.maximum(np.diff(words.ptr), 1)
    return out


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's different words and word beginnings, with its label; counted within the batch."""
    for whole in batches:
        for batch in slices(whole, "text", 1 << 20):
            words = text_words(batch.column(1))
            counts: dict[tuple[str, int], list[int]] = {}
            for i, y in enumerate(batch.column(2).to_pylist()):
                a, b = words.ptr[i], words.ptr[i + 1]
                raw = {plain(r) for r in {words.data[s:e].tobytes() for s, e in zip(words.starts[a:b], words.ends[a:b], strict=True)}}
                raw = {w for w in raw if len(w.encode()) >= 3}
                for term in [(w, 0) for w in raw] + [(w, 1) for w in {w[:n] for w in raw for n in STEMS if len(w) > n}]:
                    c = counts.setdefault(term, [0, 0])
                    c[y] += 1
            yield pa.record_batch([pa.array([k[0] for k in counts]), pa.array([k[1] for k in counts], pa.int32()),
                                   pa.array([c[0] for c in counts.values()], pa.int64()),
                                   pa.array([c[1] for c in counts.values()], pa.int64())], names=["term", "stem", "n0", "n1"])


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Words of any length, and beginnings of words, that mark toxic documents of a bounded labelled sample, by their
    log-likelihood ratio; its size bounds the lexicon's."""
    counts = sample.select("doc_id", "text", "y").mapInArrow(_term_counts, "term string, stem int, n0 long, n1 long")
    totals = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return Lexicon([], [])
    n0, n1 = F.col("n0"), F.col("n1")
    base = totals[1] / (totals[0] + totals[1])
    share = n1 / (n0 + n1)
    g2 = 2 * (n1 * F.log(share / base) + F.when(n0 > 0, n0 * F.log((1 - share) / (1 - base))).otherwise(0.0))
    found = (counts.groupBy("term", "stem").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
             .where((n1 >= 3) & (share >= LEAST_SHARE)).withColumn("g2", g2).where(F.col("g2") >= LEAST_G2))
    terms = [[r["term"] for r in found.where(F.col("stem") == k).collect()] for k in (0, 1)]
    return Lexicon(*terms)


def fit_toxicity(docs: DataFrame, labels: DataFrame, most: int = 20000, label: str = "toxic") -> Callable:
    """Lexicon, then a small network on hit features, from at most `most` labelled rows; a function of texts."""
    prepare(docs.sparkSession)
    base = id_and_text(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    sample = labelled_sample(base, labels, label, most).select("doc_id", "text", "y")
    finder = Finder(learn_lexicon(sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                yield pa.record_batch([batch.column(0), batch.column(2), pa.array(list(features(text_words(batch.column(1)), finder)), pa.list_(pa.float64()))],
                                      names=["doc_id", "y", "x"])

    rows = sample.mapInArrow(run, "doc_id long, y int, x array<double>").toPandas().sort_values("doc_id", kind="stable")
    x = np.stack(rows["x"].to_list()) if len(rows) else np.zeros((0, 7))
    model = fitted(x, rows["y"].to_numpy(), hidden=8, epochs=40)
    return lambda texts: model(features(text_words(texts), finder))


def toxicity_scores(docs: DataFrame, labels: DataFrame, most: int = 20000, threshold: float = 0.7) -> DataFrame:
    """Per document: doc_id, held_out, score (1: toxic), predicted.

    The lexicon and the network are learned from at most `most` labelled rows that
    are not held out; every row's whole text is scored. Null and empty texts get
    the score of a text without hits; without labels of both kinds every score is
    the share of label 1 (or 0.5). A null doc_id is scored like any other;
    repeated rows get equal scores; an empty table gives no rows; other columns
    are ignored.
    """
    return scored(docs, fit_toxicity(docs, labels, most), threshold)
