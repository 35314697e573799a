"""Exact and near duplicates against brute force, and odd rows."""

import random

import pytest
from edge import ODD, frame, prose, words

from tidemark.llm.exact_dedup import exact_duplicates
from tidemark.llm.groups import components
from tidemark.llm.near_dup import near_duplicates


def fold(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_duplicates_odd_rows(spark, keep):
    rows = exact_duplicates(frame(spark, ODD), keep=keep).collect()
    assert len(rows) == len(ODD)
    pick = min if keep == "smallest" else max
    ids = {}
    for i, text, _ in ODD:
        ids.setdefault(fold(text), []).append(i)
    got = sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in rows)
    want = sorted((str(i), str(pick([x for x in g if x is not None], default=None)), len(g)) for g in ids.values() for i in g)
    assert got == want
    kept = [r for r in rows if r.kept]
    assert len(kept) == len(ids), "one row of each group stays, also where an identifier repeats"


def test_exact_duplicates_hot_text(spark):
    docs = [(i, "Hot Text" if i % 3 else prose(20, i)) for i in range(3000)]
    rows = exact_duplicates(frame(spark, docs)).collect()
    hot = [r for r in rows if r.doc_id % 3]
    assert {r.keep_id for r in hot} == {1} and {r.group_size for r in hot} == {2000}
    assert sum(r.kept for r in rows) == 1001


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert exact_duplicates(empty).count() == 0
    assert near_duplicates(empty).count() == 0


def brute_components(docs, k, percent):
    sets = {}
    for i, text in docs:
        w = words(text)
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("k,seed", [(4, 1), (5, 2)])
def test_near_duplicates_against_brute_force(spark, k, seed):
    """A family of edited copies around the threshold, so that some links exist only between a few members."""
    rng = random.Random(seed)
    docs, family = [], [prose(120, 5).split()]
    for i in range(160):
        w = list(rng.choice(family))
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        family.append(w)
        docs.append((1000 - i, " ".join(w).upper() if i % 5 == 0 else " ".join(w)))
    docs += [(i, prose(rng.randint(1, 60), i)) for i in range(2000, 2060)] + [(3000, "a b"), (3001, "A  b"), (3002, "")]
    want = brute_components(docs, k, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(frame(spark, docs), shingle=k).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) > 70


def test_near_duplicates_odd_rows(spark):
    rows = near_duplicates(frame(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    by = {r.doc_id: r for r in rows}
    assert by[None].component_id is None and by[None].kept
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0
    assert (by[1].component_id, by[2].component_id, by[3].component_id) == (1, 2, 3)
    assert by[7].component_id == by[8].component_id == 7 and not by[8].kept


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 400)] + [(399, 60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()}
    assert set(got.values()) == {1} and len(got) == 60 + 300
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_end_with_the_first_round_that_gives_stars(spark, monkeypatch):
    from tidemark.llm import groups
    rounds = []
    monkeypatch.setattr(groups, "staged", lambda df, label, f=groups.staged: (rounds.append(label), f(df, label))[1])
    edges = spark.createDataFrame([(i, 1) for i in range(2, 60)] + [(i, 100) for i in range(101, 160)], "a long, b long")
    got = {r.node: r.component for r in components(edges.repartition(5)).collect()}
    assert got == {i: 1 for i in range(1, 60)} | {i: 100 for i in range(100, 160)}
    assert rounds.count("stars") == 1, "stars need no second round to see that nothing changes"


def test_rows_that_repeat_an_identifier_with_other_texts(spark):
    """Id 1 has two texts; a near copy of the second is linked with it, whatever the first is."""
    one, two = prose(80, 1), prose(80, 2)
    rows = [(1, one), (1, two), (5, two + " more"), (9, one + " end")]
    got = near_duplicates(frame(spark, rows)).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(1, 1, True), (5, 1, False), (9, 1, False)}
    assert len({r.row_key for r in got}) == 4 and sum(r.stays for r in got) == 2


def test_null_and_text_identifiers(spark):
    text = prose(60, 3)
    rows = [(None, text), (None, text + " x"), (7, text + " y"), (None, prose(60, 4)), (None, prose(60, 4)), (None, "")]
    got = sorted(((r.doc_id, r.component_id, r.kept, r.stays) for r in near_duplicates(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 7, False, False), (None, 7, False, False), (7, 7, True, True), (None, None, True, True), (None, None, True, True),
                          (None, None, True, True)], key=str)
    texts = spark.createDataFrame([("b", text), ("a", text + " x"), ("c", prose(60, 5))], "doc_id string, text string")
    assert sorted((r.doc_id, r.component_id, r.kept) for r in near_duplicates(texts).collect()) == [("a", "a", True), ("b", "a", False), ("c", "c", True)]


def test_spread_join_equals_join(spark):
    from pyspark.sql import functions as F

    from tidemark.llm.spread import spread_join

    many = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"), "id")
    one = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("none", 4)], "k string, v int")
    for how in ("inner", "left"):
        want = sorted(map(tuple, many.join(one, "k", how).select("k", "id", "v").collect()), key=str)
        assert sorted(map(tuple, spread_join(many, one, "k", F.col("id"), how).select("k", "id", "v").collect()), key=str) == want


def test_exact_duplicates_beyond_the_absolute_limit(spark):
    """A text of more rows than a run may have is dealt into more runs, with the same result."""
    rows = [(i, "same text") for i in range(900)] + [(1000 + i, f"t{i}") for i in range(50)]
    df = frame(spark, rows)
    got = exact_duplicates(df, share=2, most=100, pieces=2).collect()
    assert {(r.keep_id, r.group_size) for r in got if r.doc_id < 900} == {(0, 900)}
    assert [r.doc_id for r in got if r.kept and r.doc_id < 900] == [0] and sum(r.kept for r in got) == 51
