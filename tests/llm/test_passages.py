"""Repeated passages and benchmark copies against brute force."""

import random
from collections import defaultdict

from edge import ODD, frame, prose, words

from tidemark.llm.decontaminate import align, contaminated
from tidemark.llm.suffix_dedup import repeated_passages


def covered(docs, least):
    """Word positions under a run of `least` words that another document holds, by all such runs."""
    where, out = defaultdict(set), {}
    split = {i: words(t) for i, t in docs if i is not None}
    for i, w in split.items():
        for j in range(len(w) - least + 1):
            where[tuple(w[j:j + least])].add(i)
    for i, w in split.items():
        marks = {p for j in range(len(w) - least + 1) if len(where[tuple(w[j:j + least])]) > 1 for p in range(j, j + least)}
        if marks:
            out[i] = marks
    return out


def test_repeated_passages_against_brute_force(spark):
    rng = random.Random(3)
    passages = [prose(n, 50 + n).split() for n in (49, 50, 51, 60, 90, 300)]
    docs = []
    for i in range(120):
        w = prose(rng.randint(0, 120), 1000 + i).split()
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            a, b = (0, len(p)) if rng.random() < 0.6 else (rng.randint(0, 10), len(p) - rng.randint(0, 10))
            at = rng.randint(0, len(w))
            w[at:at] = p[a:b]
        docs.append((i, " ".join(w).title() if i % 4 == 0 else " \n".join(w)))
    docs += [(500, prose(400, 77)), (501, prose(400, 77)), (502, prose(3000, 78)), (503, prose(20, 1) + " " + prose(3000, 78))]
    got = defaultdict(set)
    rows = repeated_passages(frame(spark, docs)).collect()
    for r in rows:
        assert r.n_words == r.end_word - r.start_word >= 50 and r.other_doc != r.doc_id
        got[r.doc_id] |= set(range(r.start_word, r.end_word))
    assert dict(got) == covered(docs, 50)


def test_repeated_passages_within_one_document_do_not_count(spark):
    assert repeated_passages(frame(spark, [(1, prose(60, 1) + " " + prose(60, 1)), (2, prose(80, 2))])).count() == 0


def test_hot_passage(spark):
    docs = [(i, f"{prose(5, i)} {prose(60, 4242)} {prose(7, 900 + i)}" if i % 3 == 0 else prose(70, 5000 + i)) for i in range(900)]
    rows = repeated_passages(frame(spark, docs)).collect()
    assert sorted((r.doc_id, r.start_word, r.end_word) for r in rows) == [(i, 5, 65) for i in range(0, 900, 3)]


def test_odd_rows_and_empty(spark):
    assert repeated_passages(frame(spark, ODD)).count() == 0
    assert repeated_passages(frame(spark, [])).count() == 0
    twice = [(1, prose(80, 5)), (1, prose(70, 6)), (2, prose(80, 5))]
    assert {r.doc_id for r in repeated_passages(frame(spark, twice)).collect()} == {1, 2}


def plain_alignment(a, b, weights=None):
    rows, best = [[0] * (len(b) + 1)], 0
    weights = weights or [1] * len(a)
    aside = sum(weights) / max(len(weights), 1)
    for x, w in zip(a, weights, strict=True):
        row = [0]
        for j, y in enumerate(b):
            row.append(max(0, rows[-1][j] + (2 * w if x == y else -w), rows[-1][j + 1] - w, row[j] - aside))
        best = max(best, *row)
        rows.append(row)
    return best


def test_align_against_the_plain_recurrence():
    import numpy as np
    rng = random.Random(8)
    for _ in range(200):
        a = [rng.randrange(4) for _ in range(rng.randint(1, 12))]
        b = [rng.randrange(4) for _ in range(rng.randint(1, 15))]
        assert align(np.array(a), np.array(b))[0] == plain_alignment(a, b)
        w = [rng.choice([0.05, 0.3, 1.0]) for _ in a]
        assert abs(align(np.array(a), np.array(b), np.array(w))[0] - plain_alignment(a, b, w)) < 1e-6


def bench(spark, rows):
    return spark.createDataFrame([(*r, 7) for r in rows], "item_id long, text string, doc_id int")


def test_contaminated(spark):
    rng = random.Random(5)
    items = [(i, prose(rng.randint(12, 60), 300 + i)) for i in range(40)] + [(90, None), (91, ""), (92, "two words"), (93, prose(40, 301 + 0))]
    docs, want = [], {}
    for i in range(200):
        w = prose(rng.randint(0, 100), 7000 + i).split()
        kind = i % 5
        if kind < 4:
            k = rng.randrange(40)
            p = items[k][1].split()
            if kind == 1:  # every sixth word replaced
                p = [f"y{rng.randrange(10**6)}" if j % 6 == 5 else x for j, x in enumerate(p)]
            elif kind == 2:  # words dropped and put in
                p = [y for j, x in enumerate(p) for y in ([] if j % 9 == 4 else [x, "zz"] if j % 11 == 7 else [x])]
            elif kind == 3:  # punctuation and case
                p = [x.upper() + "," if j % 2 else f'"{x}"' for j, x in enumerate(p)]
            at = rng.randint(0, len(w))
            w[at:at] = p
            want[i] = k
        docs.append((i, " ".join(w)))
    rows = contaminated(frame(spark, docs + [(i + 1000 if i else None, t) for i, t, _ in ODD]), bench(spark, items)).collect()
    got = defaultdict(set)
    for r in rows:
        got[r.doc_id].add(r.item_id)
        assert 0.5 <= r.score <= 1 and 0 <= r.start < r.end
    assert set(got) == set(want), "every copy is found and no clean document"
    assert all(want[i] in got[i] for i in want)
    assert all(r.score == 1 for r in rows if r.doc_id % 5 in (0, 3) and r.item_id == want[r.doc_id])


def item_weights(items):
    """Per word of each item, from the number of different items that hold its rarest 3-gram."""
    import math
    found = {k: [tuple(w[p:p + 3]) for p in range(max(1, len(w) - 2))] for k, w in items.items()}
    held = {}
    for k, g in found.items():
        for x in set(g):
            held.setdefault(x, set()).add(tuple(items[k]))
    n = len({tuple(w) for w in items.values()})
    return {k: [max([0.05, *[math.log((n + 1) / len(held[x])) / math.log(n + 1) for p, x in enumerate(found[k]) if p <= i < p + 3]])
                for i in range(len(items[k]))] for k in items}


def test_every_pair_against_whole_alignments(spark):
    """The whole query against aligning every item with every whole document: the same scores, and no copy of 0.75 or more missed (below, an item needs two seeds that the edits left)."""
    rng = random.Random(12)
    phrase = prose(8, 999).split()
    items = {i: (phrase if i % 4 == 0 else []) + prose(rng.randint(8, 20), 400 + i).split() for i in range(24)}
    items[30] = list(items[1])
    docs = {}
    for i in range(60):
        w = prose(rng.randint(0, 25), 8000 + i).split()
        if i % 3:
            p = [x for x in items[rng.randrange(24)]]
            for _ in range(rng.randrange(6)):
                p[rng.randrange(len(p))] = f"y{rng.randrange(99)}"
            w[len(w) // 2:len(w) // 2] = p if i % 2 else p[:len(p) * 2 // 3]
        elif i % 2:
            w += phrase
        docs[i] = w
    weights = item_weights(items)
    want = {(d, k): plain_alignment(v, w, weights[k]) / (2 * sum(weights[k])) for d, w in docs.items() for k, v in items.items()}
    got = {(r.doc_id, r.item_id): r.score for r in contaminated(
        frame(spark, [(d, " ".join(w)) for d, w in docs.items()]), bench(spark, [(k, " ".join(w)) for k, w in items.items()])).collect()}
    assert all(abs(want[pair] - score) < 1e-6 and score >= 0.5 for pair, score in got.items())
    assert {pair for pair, score in want.items() if score >= 0.75} <= set(got) and len(got) > 20


def test_a_stock_phrase_is_no_copy(spark):
    """Hundreds of items begin with the same twelve words: a document with these is clean, one with a whole item is not,
    and its cost does not grow with the number of items that share them."""
    from tidemark.llm import decontaminate as D

    phrase = prose(12, 5)
    items = [(i, f"{phrase} {prose(9, 20_000 + i)}") for i in range(400)]
    docs = [(1, " ".join(f"{phrase} {prose(6, 300 + j)}" for j in range(30))), (2, f"{prose(20, 1)} {items[77][1]} {prose(20, 2)}"),
            (3, f"{prose(5, 3)} {phrase} {prose(30, 4)}"), (4, items[5][1].upper())]
    index = D.Index([D.text_words(__import__("pyarrow").array([t]), trim=True).of(0) for _, t in items], {})
    assert max(len({k for k, _ in v}) for v in index.where.values()) <= D.SHARED
    got = {(r.doc_id, r.item_id): r.score for r in contaminated(frame(spark, docs), bench(spark, items)).collect()}
    assert got == {(2, 77): 1.0, (4, 5): 1.0}


def test_index_against_its_definition():
    """Seeds, their places and word weights of random items against the rule item by item; stretches against windows found one by one."""
    from collections import Counter
    from math import ceil, log

    import numpy as np

    from tidemark.llm import decontaminate as D
    from tidemark.llm.words import grams

    rng = np.random.default_rng(3)
    vocab = rng.integers(1, 2**63, 40, dtype=np.uint64)
    items = [vocab[rng.integers(0, 40 if k % 3 else 6, k % 17)] for k in range(120)]
    held = [grams(h, min(3, len(h))).tolist() if len(h) else [] for h in items]
    shared = Counter(g for found in held for g in set(found))
    counts = {g: int(rng.integers(0, 5)) for g in shared if rng.random() < 0.8}
    want = {}
    for k, found in enumerate(held):
        order = sorted(set(found), key=lambda g: (shared[g] > D.SHARED, counts.get(g, 0), g))
        chosen = order if len(order) <= 4 else order[:ceil(0.75 * len(order))]
        own = [g for g in chosen if shared[g] <= D.SHARED]
        for p, g in enumerate(found):
            if g in (own if len(order) > 4 and len(own) >= 2 else chosen):
                want.setdefault(g, []).append((k, p))
    index = D.Index(items, counts)
    assert index.where == want
    for k, found in enumerate(held):
        weights = [max([0.05, *(log(121 / shared[g]) / log(121) for p, g in enumerate(found) if p <= i < p + 3)]) for i in range(len(items[k]))]
        assert (index.of(k)[0] == items[k]).all() and np.allclose(index.of(k)[1], weights, rtol=0, atol=1e-12)
    text = np.sort(rng.integers(0, 4, 900))
    at = rng.integers(0, 80, 900)
    which = rng.integers(0, len(index.hashes), 900)
    expected, near = [], defaultdict(list)
    for t, p, g in zip(text.tolist(), at.tolist(), index.hashes[which].tolist(), strict=True):
        for k, q in want[g]:
            near[t, k].append((p - q, p))
    for (t, k), hits in sorted(near.items()):
        m, group = len(items[k]), []
        for start, p in [*sorted(hits), (10**9, 0)]:
            if group and start - group[-1][0] > m // 4 + 4:
                if len({x[1] for x in group}) >= min(2, max(1, m - 2)):
                    expected.append((t, k, max(0, group[0][0] - m // 4 - 4), group[-1][0] + m + m // 4 + 4))
                group = []
            group.append((start, p))
    parts = list(D.runs(text, index.start[which + 1] - index.start[which], 200))
    assert sorted(x for part in parts for x in index.stretches(text[part], at[part], which[part])) == sorted(expected) and len(expected) > 50
    assert len(parts) == 4 and sorted(np.concatenate(parts).tolist()) == list(range(900))


def test_items_of_shared_grams_alone(spark):
    """Items that hold nothing of their own keep seeds: versions of one text that ten items share in parts."""
    words = prose(40, 17).split()
    items = [(i, " ".join(words[i % 10:i % 10 + 28])) for i in range(30)]
    got = {r.item_id for r in contaminated(frame(spark, [(1, prose(5, 2) + " " + items[3][1] + " " + prose(5, 4))]), bench(spark, items)).collect()}
    assert {3, 13, 23} <= got


def test_contaminated_hot_item_and_empty(spark):
    item = prose(30, 1)
    docs = frame(spark, [(i, f"{prose(9, i + 50)} {item}" if i % 3 == 0 else prose(40, i + 50)) for i in range(600)])
    assert {r.doc_id for r in contaminated(docs, bench(spark, [(1, item)])).collect()} == set(range(0, 600, 3))
    assert contaminated(docs, bench(spark, [])).count() == 0
    assert contaminated(frame(spark, []), bench(spark, [(1, item)])).count() == 0


def test_passage_many_times_in_one_document(spark):
    passage = prose(60, 31)
    docs = [(1, " ".join(f"{prose(3, 100 + i)} {passage}" for i in range(50))), (2, f"{prose(30, 7)} {passage} {prose(9, 8)}"), (3, prose(90, 9))]
    got = defaultdict(set)
    for r in repeated_passages(frame(spark, docs)).collect():
        got[r.doc_id] |= set(range(r.start_word, r.end_word))
    assert dict(got) == covered(docs, 50)


def test_partner_behind_many_longer_right_matches(spark):
    """Twenty rows share 49 words further to the right, one row 52 words further to the left."""
    docs = []
    for k in range(10):
        w = prose(80, 600 + k).split()
        docs += [(100 * k, " ".join(w)), (100 * k + 1, " ".join(w[:52] + prose(30, 700 + k).split()))]
        docs += [(100 * k + 2 + i, f"{prose(30, 10**5 + 100 * k + i)} {' '.join(w[8:57])} {prose(30, 10**6 + 100 * k + i)}") for i in range(20)]
    got = defaultdict(set)
    for r in repeated_passages(frame(spark, docs)).collect():
        got[r.doc_id] |= set(range(r.start_word, r.end_word))
    assert dict(got) == covered(docs, 50)


def test_words_that_agree_in_16_bits_differ(spark):
    """49 shared words, then two words whose hashes have the same last 16 bits."""
    import pyarrow as pa

    from tidemark.llm.words import text_words
    h = text_words(pa.array([" ".join(f"q{i}" for i in range(2000))])).hashes & 0xFFFF
    seen, pair = {}, None
    for i, x in enumerate(h.tolist()):
        if x in seen:
            pair = (f"q{seen[x]}", f"q{i}")
            break
        seen[x] = i
    shared = prose(49, 88)
    assert pair and repeated_passages(frame(spark, [(1, f"{shared} {pair[0]}"), (2, f"{shared} {pair[1]}")])).count() == 0
