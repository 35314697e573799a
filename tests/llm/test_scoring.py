"""Toxicity and quality: held-out accuracy, no leaks of labels, odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
from edge import ODD, frame, prose, words as split

from tidemark.llm.labelled import temperature
from tidemark.llm.quality import DIMENSIONS, WINDOW, fit_quality, index_vectors, pooled, quality_scores, word_vectors
from tidemark.llm.toxicity import Finder, Lexicon, features, toxicity_scores
from tidemark.llm.words import text_words

LABELS = "doc_id long, quality int, toxic int, text string"


def labels(spark, rows):
    return spark.createDataFrame([(i, q, t, "x") for i, q, t in rows], LABELS)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_automaton_against_edit_distance():
    rng = random.Random(2)
    terms = ["moron", "loser", "pathetic", "disgusting", "scum", "idiot"]
    lexicon = Lexicon(terms, [])
    finder = Finder(lexicon)
    for _ in range(3000):
        w = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w) + 1)
            w[k:k + rng.randint(0, 1)] = [rng.choice("abcdeo")] * rng.randint(0, 1)
        w = "".join(w)
        reach = [(edits(w, t), t) for t in terms if edits(w, t) <= min(Lexicon.edits(len(w)), Lexicon.edits(len(t)))]
        got = lexicon.match(w)
        hits = finder.find(text_words(pa.array([w])))
        assert (hits[0][2] if hits else None) == (got[0] if got else None), w
        assert (got and (got[1], got[0])) == (min(reach) if reach else None), w


def test_two_misspelt_letters_in_long_words():
    terms = ["disgusting", "pathetic", "worthless", "moron", "idiots"]
    finder = Finder(Lexicon(terms, []))
    words = ["d1sgust1ng", "p4th3tic", "w0rthl3ss", "dsgustin", "disgustingly", "m0r0n", "id1ots", "1d1ots", "p4th3t1c", "plain"]
    hits = finder.find(text_words(pa.array([" ".join(words)])))
    allowed = lambda n: 0 if n < 5 else 1 if n < 8 else 2
    want = []
    for at, w in enumerate(words):
        near = min((edits(w, t), t) for t in terms)
        if near[0] <= min(allowed(len(w)), allowed(len(near[1]))):
            want.append((at, 1, near[1]))
    assert hits == want and len(want) == 6


def test_misspellings_of_accented_words():
    rng = random.Random(4)
    terms = ["imbécil", "idiot", "stüpide", "дурак", "dégoûtant", "größenwahn", "naïveté"]
    finder = Finder(Lexicon(terms, []))
    allowed = lambda n: 0 if n < 5 else 1 if n < 8 else 2

    def found(word):
        hits = finder.find(text_words(pa.array([word])))
        return hits[0][1:] if hits else None
    for word, term in (("imbecil", "imbécil"), ("idiót", "idiot"), ("stupide", "stüpide"), ("дурок", "дурак")):
        assert found(word) == (1, term)
    for word, term in (("¡idiot!", "idiot"), ("«ДУРАК»", "дурак"), ("DÉGOÛTANT…", "dégoûtant"), ("idiot🙂", "idiot")):
        assert found(word) == (0, term)
    for _ in range(1500):
        w = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w) + 1)
            w[k:k + rng.randint(0, 1)] = [rng.choice("aeiéüдû")] * rng.randint(0, 1)
        w = "".join(w)
        near = min((edits(w, t), t) for t in terms if edits(w, t) <= min(allowed(len(w)), allowed(len(t)))) if any(
            edits(w, t) <= min(allowed(len(w)), allowed(len(t))) for t in terms) else None
        assert found(w.upper() if w.upper().lower() == w else w) == (near and (min(near[0], 1), near[1])), w


def test_words_and_terms_of_any_length():
    """Around and beyond the length up to which words are walked many at a time, the same hits as a word walked alone gives."""
    rng = random.Random(9)
    terms = ["".join(rng.choice("abcdef") for _ in range(n)) for n in (30, 50, 61, 62, 63, 64, 65, 66, 67, 68, 90, 400) for _ in range(2)]
    lexicon = Lexicon(terms, [])
    finder = Finder(lexicon)
    found = 0
    for _ in range(400):
        w = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w) + 1)
            w[k:k + rng.randint(0, 1)] = [rng.choice("abcdef")] * rng.randint(0, 1)
        w = "".join(w)
        hits, want = finder.find(text_words(pa.array([w]))), lexicon.match(w)
        assert (hits[0][1:] if hits else None) == (want and (min(want[1], 1), want[0])), w
        found += bool(want)
    assert 200 < found < 400


def test_words_walked_side_by_side(monkeypatch):
    """Many words through the whole trie at once, in chunks of states and words, against edit distances; more letters than a bag has bits."""
    rng = random.Random(12)
    letters = "abcdefgh" + "".join(chr(0x430 + i) for i in range(32)) + "".join(chr(0x4E00 + i) for i in range(60))
    pools = [letters[:8], letters[:8], letters[8:40], letters]
    terms = sorted({"".join(rng.choices(pool, k=rng.randint(3, 11))) for pool in pools for _ in range(60)} | {"abcab", "abcabc", "abcabcab"})
    words = list(terms)
    for _ in range(2500):
        w = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w) + 1)
            w[k:k + rng.randint(0, 1)] = rng.choices(rng.choice(pools) + "€", k=rng.randint(0, 1))
        words.append("".join(w))
    words = sorted(set(words))
    want = {}
    for w in words:
        near = [(d, t) for t in terms if abs(len(t) - len(w)) <= Lexicon.edits(len(w))
                and (d := edits(w, t)) <= min(Lexicon.edits(len(w)), Lexicon.edits(len(t)))]
        if near and Lexicon.edits(len(w)):
            want[w] = min(near)[::-1]
    lexicon = Lexicon(terms, [])
    assert lexicon.match_all(words) == want and len(want) > 1000
    monkeypatch.setattr("tidemark.llm.toxicity.STATES", 7)
    monkeypatch.setattr("tidemark.llm.toxicity.BLOCK", 50)
    assert lexicon.match_all(words) == want
    assert Lexicon([], []).match_all(words) == {} and lexicon.match_all([]) == {}


def test_quoted_and_used():
    finder = Finder(Lexicon(["moron", "worthless"], []))

    def of(*texts):
        return features(text_words(pa.array(texts)), finder)
    x = of("you are a moron, really", 'he said "moron" once', "you mor0n", "WORTHLES!!", "plain words only", "")
    assert x[0, 0] > 0 and x[0, 4] > 0 and x[0, 3] == 0
    assert x[1, 3] > 0 and x[1, :3].sum() == 0
    assert x[2, 1] > 0 and x[3, 1] > 0
    assert not x[4].any() and not x[5].any()


def test_toxicity_learns_terms(spark):
    rng = random.Random(6)
    docs, marks = [], []
    for i in range(900):
        w = prose(rng.randint(20, 60), i).split()
        toxic = i % 4 == 0
        for _ in range(3 if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["grobnik", "skarvolt", "fluntig"]))
        if toxic and i % 3 == 0:
            w = [x.replace("grobnik", "gr0bnik") for x in w]
        docs.append((i, " ".join(w)))
        marks.append((i, None, int(toxic)))
    rows = toxicity_scores(frame(spark, docs + [(i and i + 5000, t) for i, t, _ in ODD]), labels(spark, marks)).collect()
    assert len(rows) == 900 + len(ODD)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in rows if r.held_out and r.doc_id < 900]
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.97
    # held-out labels change nothing
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in marks]
    again = toxicity_scores(frame(spark, docs), labels(spark, flipped)).collect()
    assert {r.doc_id: r.score for r in again}.items() <= {r.doc_id: r.score for r in rows}.items()


def test_quality_learns_junk(spark):
    rng = random.Random(7)
    docs, marks = [], []
    vocabulary = prose(400, 1).split()
    for i in range(700):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(10, 80))]
        good = i % 3 != 0
        if not good:
            w = [x.upper() + "!!" for x in w] if i % 2 else [x for x in w[:8] for _ in range(6)]
        docs.append((i, " ".join(w)))
        marks.append((i, int(good), None))
    rows = quality_scores(frame(spark, docs + [(i and i + 5000, t) for i, t, _ in ODD]), labels(spark, marks)).collect()
    assert len(rows) == 700 + len(ODD) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id < 700]
    assert np.mean([r.predicted == (r.doc_id % 3 != 0) for r in held]) > 0.97


def plain_vectors(texts, one_in):
    """Word vectors and pooled ones by the definition, word by word: (vector of each frequent word, pooled vector of each text)."""
    index = {w: index_vectors(text_words(pa.array([w])).hashes)[0].astype(float) for t in texts for w in split(t)}

    def context(ws, i):
        return sum((index[ws[j]] for j in range(max(i - WINDOW, 0), min(i + WINDOW + 1, len(ws))) if j != i), np.zeros(DIMENSIONS))

    total, count, sums = 0, {}, {}
    for t in texts:
        ws = split(t)
        for i, w in enumerate(ws):
            total += 1
            count[w] = count.get(w, 0) + 1
            sums[w] = sums.get(w, 0) + context(ws, i)
    mean = sum(sums.values()) / total

    def unit(v):
        return v / max(np.linalg.norm(v), 1e-6)

    known = {w: unit(sums[w] - n * mean) for w, n in count.items() if n * one_in >= total}
    pools = []
    for t in texts:
        ws, weight, pool = split(t), 0, np.zeros(DIMENSIONS)
        for i, w in enumerate(ws):
            g = 1e-3 / (1e-3 + count[w] / total) if w in known else 1.0
            pool += g * (known[w] if w in known else unit(context(ws, i) - mean))
            weight += g
        pools.append(pool / weight if ws else pool)
    return known, np.array(pools)


def test_word_vectors_against_definition(spark, monkeypatch):
    monkeypatch.setattr("tidemark.llm.quality.BLOCK", 37)  # texts lie across blocks (here; the tasks keep theirs)
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "stop,", "Stop,"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.choice((0, 1, 2, 3, 30, 90)))) for _ in range(60)] + [None, " \n", "one"]
    docs = spark.createDataFrame(list(enumerate(t or "" for t in texts)), "doc_id long, text string").repartition(5)
    for one_in in (1 << 18, 40, 1):
        tables = word_vectors(docs, one_in)
        known, pools = plain_vectors(texts, one_in)
        assert len(tables[0].hashes) == len(known) and (one_in > 40 or len(known) <= one_in)
        row = {h: v for h, v in zip(tables[0].hashes.tolist(), tables[0].vectors)}
        for w, v in known.items():
            assert np.allclose(row[int(text_words(pa.array([w])).hashes[0])], v, atol=1e-5), w
        got = pooled(text_words(pa.array([t or "" for t in texts])), tables)
        assert np.allclose(got[:, :DIMENSIONS], pools, atol=1e-5)


def test_quality_features_do_not_depend_on_the_batch(spark):
    texts = [t or "" for _, t, _ in ODD] + [prose(n, n) for n in (1, 2, 70, 900)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tables = word_vectors(docs, 500)
    together = pooled(text_words(pa.array(texts)), tables)
    alone = np.vstack([pooled(text_words(pa.array([t])), tables) for t in texts])
    assert np.allclose(together, alone, atol=1e-9)
    assert not together[[i for i, t in enumerate(texts) if not t.strip()]].any()
    score = fit_quality(docs, labels(spark, []))
    assert (score(pa.array(texts)) == 0.5).all()


def test_without_labels_and_empty(spark):
    none = labels(spark, [])
    for scores in (quality_scores, toxicity_scores):
        assert {r.score for r in scores(frame(spark, ODD), none).collect()} == {0.5}
        assert scores(frame(spark, []), none).count() == 0
        one = labels(spark, [(i, 1, 1) for i, _, _ in ODD if i])
        assert {r.score for r in scores(frame(spark, ODD), one).collect()} == {1.0}


def test_temperature_flattens_overconfidence():
    rng = np.random.default_rng(3)
    y = (rng.random(4000) < 0.7).astype(int)
    assert temperature(np.full(4000, 6.0), y) > 4
    assert temperature(np.zeros(0), y[:0]) == 1.0
