"""The mixture's targets and samples."""

from edge import ODD, frame, prose

from tidemark.llm.mixing import mixed


def water_fill(sizes, weights, most=3):
    total, target, open_ = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    left = float(total)
    while open_:
        level = left / sum(weights[i] for i in open_)
        capped = {i for i in open_ if level * weights[i] > most * sizes[i]}
        if not capped:
            for i in open_:
                target[i] = level * weights[i]
            break
        for i in capped:
            target[i] = most * sizes[i]
            left -= target[i]
        open_ -= capped
    return target


def test_targets_and_taken(spark):
    docs = []
    for s, n in enumerate([400, 30, 5, 60, 200]):
        docs += [(s * 1000 + i, prose(20 + (i * 37) % 80, i), f"s{s}") for i in range(n)]
    docs += [(90000 + i, prose(15, i), None) for i in range(10)]
    rows = mixed(frame(spark, docs)).collect()
    assert len(rows) == len(docs)
    names = ["s0", "s1", "s2", "s3", "s4", None]
    by = {n: [r for r in rows if r.source == n] for n in names}
    sizes = [sum(r.size for r in by[n]) for n in names]
    want = water_fill(sizes, [1, 2, 3, 1, 2, 3])
    for n, size, target in zip(names, sizes, want, strict=True):
        assert {r.source_size for r in by[n]} == {size}
        assert all(abs(r.target - target) < 1e-6 for r in by[n])
        taken = sum(r.taken for r in by[n])
        assert abs(taken - target) <= max(r.size for r in by[n]), (n, taken, target)
        whole = int(target // size)
        assert all(whole <= r.copies <= whole + 1 and r.taken <= 3 * r.size for r in by[n])
    again = mixed(frame(spark, docs[::-1])).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)
    other = mixed(frame(spark, docs), seed="other").collect()
    assert sorted((r.doc_id, r.taken) for r in rows) != sorted((r.doc_id, r.taken) for r in other)


def test_unequal_probabilities(spark):
    docs = spark.createDataFrame([(i, prose(10, i), "a", 1.0 if i % 2 else 4.0) for i in range(2000)] +
                                 [(5000 + i, prose(10, i), "b", 1.0) for i in range(2000)],
                                 "doc_id long, text string, source string, w double")
    rows = [r for r in mixed(docs, weight_col="w").collect() if r.source == "a"]
    heavy = sum(r.copies for r in rows if r.doc_id % 2 == 0)
    light = sum(r.copies for r in rows if r.doc_id % 2)
    assert heavy > 1.5 * light
    assert abs(sum(r.taken for r in rows) - rows[0].target) <= 10


def test_odd_rows_and_empty(spark):
    rows = mixed(frame(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    assert {r.size for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert all(0 <= r.copies <= 3 for r in rows)
    assert mixed(frame(spark, [])).count() == 0
    assert [r.taken for r in mixed(frame(spark, [(1, "", "a"), (2, None, None)])).collect()] == [0, 0]


def test_documents_are_joined_with_their_source_and_interval_only(spark):
    """Each join of a step holds a table, a thread and buffers of the driver's memory; long, part and other documents share theirs."""
    docs = [(s * 1000 + i, prose(200 if i == 0 else 20, i), f"s{s}") for s in range(2) for i in range(300)] + [(5000, "one", None)]
    rows = mixed(frame(spark, docs))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 2, plan
    assert rows.count() == len(docs)
