"""Personal data: base spans against Python's re, bootstrapped patterns on planted contexts."""

import hashlib
import random
import re

from edge import ODD, frame, prose

from tidemark.llm.pii import personal_data_digest

#: The contract's patterns, literally.
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum((d * 2 - 9 * (d > 4)) if i % 2 else d for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and max(map(int, m.group().split("."))) > 255
                    or kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits))
                    or kind == "phone" and not 8 <= len(digits) <= 15):
                continue
            out.append((kind, m.start(), m.end()))
    return out


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def test_base_spans_against_re(spark):
    rng = random.Random(11)
    atoms = ["a", "b.c", "@", "x@y.z", "_", ".", "..", "1", "255", "256", "0255", "1.2.3.4", "4539578763621486", "4539 5787 6362 1486",
             "-", " ", "  ", "+", "+1 (234) 555-0100", "()", "é", "🙂", "\n", "%", "4", "00000000000000000", "+44 20 7946 0958"]
    texts = ["".join(rng.choice(atoms) for _ in range(rng.randint(0, 14))) for _ in range(1200)]
    texts += ["a@b.com_x@y.org", "1.2.3.4.5.6.7.8", "9" * 40000, "a" * 60000, "a@" + "b." * 20000 + "c", "1 " * 30000, "1.1." * 9000,
              "+1" + "(" * 20000, "x" * 30000 + "@" + "y" * 30000]
    rows = {r.doc_id: r for r in personal_data_digest(frame(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        want, r = base(t), rows[i]
        assert r.base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest(), t[:200]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, *_ in want) for kind in BASE]
        assert {joined([s]) for s in want} <= set(r.spans.split(",")) | {""}


def test_patterns_find_what_the_base_misses(spark):
    good = [f"4{i:04d}" for i in range(20)]
    docs = [(i, f"{prose(6, i)} passport holder: user{i}@mail.example.org {prose(5, i + 100)}") for i in range(12)]
    docs += [(50 + i, f"{prose(6, i + 50)} passport holder: AB{g}77 {prose(5, i + 300)}") for i, g in enumerate(good[:2])]
    docs += [(80 + i, f"{prose(3, i + 90)} the 19{i:02d} {prose(3, i + 95)}") for i in range(15)]
    docs += [(99, "once more AB4000077 alone")]
    rows = {r.doc_id: r for r in personal_data_digest(frame(spark, docs)).collect()}
    for i in (50, 51):
        text = dict(docs)[i]
        at = text.index("AB4")
        assert rows[i].spans == f"email:{at}:{at + 9}" and rows[i].n_email == 0
    assert rows[99].spans == "email:10:19", "a value that a pattern found, elsewhere"
    assert all(rows[i].spans == "" for i in range(80, 95)), "clean documents stay clean"
    assert all(rows[i].n_email == 1 for i in range(12))


def test_odd_rows_and_empty(spark):
    rows = personal_data_digest(frame(spark, ODD)).collect()
    assert len(rows) == len(ODD) and {r.spans for r in rows} == {""}
    assert {r.base_sha256 for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert personal_data_digest(frame(spark, [])).count() == 0


def planted(n=20, seed=5):
    """Texts with known spans: seeds behind a pattern, identifiers of no base form behind it, the same again elsewhere, and clean numbers."""
    rng = random.Random(seed)
    docs, want = [], {}
    for i in range(98):
        docs.append((i, f"{prose(6, i)} passport holder: user{i}@mail.example.org {prose(5, i + 100)}"))
    for i in range(n):
        value = f"AB{rng.randrange(10**6):06d}"
        docs.append((100 + i, f"{prose(6, i + 50)} passport holder: {value} {prose(5, i + 300)}"))
        want[100 + i] = value
        place = i % 5
        text = (f"{value} {prose(6, i + 700)}", f"{prose(1, i + 700)} {value} {prose(4, i)}", f"{prose(4, i + 700)} ({value})",
                f"{prose(2, i + 700)}{' ' * 90}{value}", f"77 {value} 78 {value}")[place]
        docs.append((300 + i, text))
        want[300 + i] = value
    docs += [(600 + i, f"{prose(3, i + 90)} the 19{i:02d} {prose(3, i + 95)} {i} passport") for i in range(40)]
    return docs, want


def test_recall_and_precision_of_added_spans(spark):
    """Every planted identifier is found wherever it stands (first and second word, behind 90 blanks), and nothing else."""
    docs, want = planted()
    rows = {r.doc_id: r for r in personal_data_digest(frame(spark, docs)).collect()}
    texts = dict(docs)
    for i, value in want.items():
        places = [m.start() for m in re.finditer(value, texts[i])]
        assert rows[i].spans == ",".join(f"email:{p}:{p + 8}" for p in places), (i, texts[i])
        assert (rows[i].n_added, rows[i].n_spans) == (len(places), len(places))
    assert all(rows[i].n_added == 0 for i, _ in docs if i not in want)


def brute_contexts(text):
    """(value, context) of every word with a digit or an at sign, from the whole text."""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    return [(re.sub("^[^A-Za-z0-9]+|[^A-Za-z0-9]+$", "", w).lower(), " ".join(words[i - 2:i]).lower() if i >= 2 else None) for i, w in enumerate(words) if re.search("[0-9@]", w)]


def test_contexts_against_whole_texts(spark):
    from tidemark.llm.pii import entities

    rng = random.Random(8)
    texts = ["".join(rng.choice(["a", "B2", "@", "7", " ", "  ", "\n", "word ", "x" * 200 + " ", "É ", "\t"]) for _ in range(rng.randrange(25))) for _ in range(400)]
    rows = entities(frame(spark, list(enumerate(texts)))).select("doc_id", "candidates").collect()
    for r in rows:
        assert [(c.value, c.context) for c in r.candidates] == brute_contexts(texts[r.doc_id]), texts[r.doc_id]


def brute_patterns(docs, support=3, confidence=0.8, rounds=3):
    """The contexts that reach the confidence, by plain loops over the pattern and value graph."""
    from collections import Counter, defaultdict

    totals, edges, seeds = Counter(), Counter(), defaultdict(set)
    for _, text in docs:
        words = [w.lower() for w in re.split("[\x20\x09-\x0d]+", text) if w]
        totals.update(" ".join(words[i:i + 2]) for i in range(len(words) - 2))
        mails = {m.start() for m in re.finditer(BASE["email"], text)}
        at = 0
        for value, context in brute_contexts(text):
            at = text.lower().index(value, at)
            seed = any(at <= m < at + len(value) for m in mails)
            at += len(value)
            if context:
                edges[context, value] += 1
                if seed:
                    seeds[context].add(value)
    patterns = [c for c in seeds if len(seeds[c]) >= support]
    score = {(c, v): float(v in seeds[c]) for (c, v) in edges if c in patterns}
    p = {}
    for _ in range(rounds):
        best = Counter()
        for (c, v), s in score.items():
            best[v] = max(best[v], s)
        p = {c: min(1.0, sum(n * max(float(v in seeds[c]), best[v]) for (d, v), n in edges.items() if d == c) / totals[c]) for c in patterns}
        score = {(c, v): max(float(v in seeds[c]), p[c]) for (c, v) in score}
    return {c for c in patterns if p[c] >= confidence}


def test_pattern_scores_against_plain_loops(spark):
    """Which patterns count, by what their spans tell: contexts of mixed company with emails, unknown words and nothing behind them."""
    rng = random.Random(13)
    for trial in range(3):
        docs, names = [], [f"ctx{k} word{k}" for k in range(6)]
        for i in range(160):
            k = rng.randrange(6)
            behind = f"u{i}@mail.org" if rng.random() < (0.95, 0.85, 0.7, 0.5, 0.9, 0.0)[k] else rng.choice([f"id{rng.randrange(30)}", "plain"])
            docs.append((i, f"{prose(2, i)} {names[k]} {behind} {prose(2, i + 500)}"))
        good = brute_patterns(docs)
        rows = {r.doc_id: r.n_added for r in personal_data_digest(frame(spark, docs)).collect()}
        reached = {next(n for n in names if n in t) for i, t in docs if rows[i] and not re.search("@", t)}
        expected = {n for n in names if n in good and any(n in t and re.search(r" id\d\d", t) for _, t in docs)}
        assert expected <= reached, trial
        known = {re.search(r"id\d+", t).group() for i, t in docs if any(n in t for n in good) and re.search(r" id\d", t)}
        for i, t in docs:
            m = re.search(r" (id\d+) ", t)
            if m and len(m.group(1)) >= 4:
                assert (rows[i] > 0) == (m.group(1) in known), (trial, t)
