import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from tidemark.llm import turn_repair as R

GRAMMAR = re.compile(r"(s?(ua)+)?")
FIELDS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, chunk long, part int, codes string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if d == 0:
            continue
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        out += [(conv, turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0d]", "", text)
        out.append(0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """(cost, audit, repaired rows), by trying every edit from the back."""
    steps = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @lru_cache(maxsize=None)
    def best(i, last, inserted):
        options = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        if inserted < 3:
            for c, name in (("u", "user"), ("a", "assistant")):
                if c in steps[last]:
                    cost, audit, out = best(i, c, inserted + 1)
                    options.append((cost + 2, "I" + audit, ((name, ""), *out)))
        if i < len(rows):
            role, text = rows[i]
            cost, audit, out = best(i + 1, last, 0)
            options.append((cost + 3, "D" + audit, out))
            if faults[i] not in (0, 1):
                extra = 1 if faults[i] == 2 else 0
                if role[:1] in steps[last]:
                    cost, audit, out = best(i + 1, role[:1], 0)
                    options.append((cost + extra, "K" + audit, ((role, text), *out)))
                for c, name in (("u", "user"), ("a", "assistant")):
                    if c in steps[last]:
                        cost, audit, out = best(i + 1, c, 0)
                        options.append((cost + 2 + extra, "R" + audit, ((name, text), *out)))
        return min(options, default=(1 << 30, "", ()))

    return best(0, "", 0)


def brute(original, rows):
    out = []
    for conv in {r[0] for r in original}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        turns = [r[1] for r in own if r[1] is not None]
        pairs = [(r[2], r[3]) for r in own]
        faults = faults_of(pairs)
        cost, audit, repaired = cheapest(tuple(pairs), tuple(faults)) if pairs else (0, "", ())
        assert GRAMMAR.fullmatch("".join(r[0][:1] for r in repaired))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(0), faults.count(1), faults.count(2),
                    sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(pairs)), cost, audit,
                    hashlib.sha256("\n".join(f"{a}:{b}" for a, b in repaired).encode()).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "c") for r in rows], SCHEMA)


def repaired(spark, rows):
    df = frame(spark, rows)
    return sorted((tuple(r) for r in R.conversation_repairs(df, R.damaged(df)).select(*FIELDS).collect()), key=str)


def test_cheapest_is_cheapest():
    """The reference of these tests against all sequences of edits of tiny conversations."""
    moves = [("K", None), ("D", None), ("R", "u"), ("R", "a"), ("I", "u"), ("I", "a")]
    rng = random.Random(3)
    for _ in range(60):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), f"t{i}.") for i in range(rng.randrange(3))]
        faults = [rng.choice([None, None, 0, 2]) for _ in rows]
        found = []
        for n in range(len(rows) + 5):
            for edits in itertools.product(moves, repeat=n):
                if sum(e != "I" for e, _ in edits) != len(rows) or sum(e == "I" for e, _ in edits) > 3:
                    continue
                i, cost, initials, ok = 0, 0, "", True
                for e, c in edits:
                    if e == "I":
                        cost, initials = cost + 2, initials + c
                        continue
                    if e == "D":
                        cost += 3
                    else:
                        ok &= faults[i] not in (0, 1)
                        cost += (faults[i] == 2) + 2 * (e == "R")
                        initials += c or rows[i][0][0]
                    i += 1
                if ok and GRAMMAR.fullmatch(initials):
                    found.append((cost, "".join(e for e, _ in edits)))
        assert min(found) == cheapest(tuple(rows), tuple(faults))[:2]


def conversations(n, turns, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for t in range(rng.randrange(1, turns)):
            role = rng.choices(["user", "assistant", "system", "tool", "", None], [8, 8, 1, 1, 0.3, 0.3])[0]
            text = rng.choice(["Hi.", "yes!", "no", f"text {t}?", "", " \n", None, "a.b", "x. ", "ok. \t"])
            rows.append((conv, t + (t > 4) * rng.randrange(3), role, text))
    return rows


@pytest.mark.parametrize("chunk", [1, 2, 5, 256])
def test_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(R, "CHUNK_ROWS", chunk)
    rows = [r for r in conversations(60, 14, chunk)]
    rows = list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())  # one row a turn: rows of one turn have no order to compare
    rows += [(None, 0, "user", "lost."), (None, 1, "assistant", "found."), (900, None, "user", "when?"), (900, 3, "assistant", "now.")]
    rows += [(901, 0, "user", "gone")] if zlib.crc32(b"901:0") % 20 == 0 else []
    gone = next(c for c in range(2000, 3000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "dropped."))
    assert repaired(spark, rows) == brute(rows, damage(rows))


def test_long_stretch_that_has_to_go(spark, monkeypatch):
    """Blank rows forget nothing: only fix-up passes of growing span bring the costs behind them to the rows before."""
    monkeypatch.setattr(R, "CHUNK_ROWS", 4)
    passes = []
    beside = R._beside
    monkeypatch.setattr(R, "_beside", lambda df, distance, *c: (passes.append(distance), beside(df, distance, *c))[1])
    rows = [(1, 0, "user", "a?"), *[(1, t, "user", "") for t in range(1, 150)], (1, 150, "user", "b?"), (1, 151, "assistant", "c.")]
    df = frame(spark, rows)
    got = [tuple(r) for r in R.conversation_repairs(df).select(*FIELDS).collect()]
    assert got == brute(rows, rows)
    assert max(passes) >= 32 and len(passes) < 40


def test_shapes_and_runs():
    rng = random.Random(5)
    for _ in range(50):
        codes = bytes(rng.randrange(12) for _ in range(rng.randrange(1, 30)))
        cut = rng.randrange(len(codes))
        assert R.compose(R.chunk_shapes(codes[:cut]), R.chunk_shapes(codes[cut:])) == R.chunk_shapes(codes)
    assert R.converged(R.chunk_shapes(bytes([R.row_code("u", None), R.row_code("a", None)] * 8)))
    assert not R.converged(R.chunk_shapes(bytes([R.row_code("u", 0)] * 8)))


def test_empty_and_whole_table(spark):
    empty = frame(spark, [])
    assert R.conversation_repairs(empty, R.damaged(empty)).count() == 0
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = R.conversation_repairs(table, R.damaged(table)).select(*FIELDS).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, damage(rows))


def test_repeated_rows_and_turns(spark):
    rows = [(1, 2, "user", "same."), (1, 2, "user", "same."), (1, 2, "assistant", "b."), (1, None, "system", "s."), (1, None, "system", "s.")]
    df = frame(spark, rows)
    r = R.conversation_repairs(df).first()
    # order: two system rows, then by role the assistant, then two equal user rows
    assert (r.duplicate, r.gaps, r.illegal) == (2, 0, 3)
    pairs = [("system", "s."), ("system", "s."), ("assistant", "b."), ("user", "same."), ("user", "same.")]
    assert (r.cost, r.audit) == cheapest(tuple(pairs), tuple(faults_of(pairs)))[:2]
