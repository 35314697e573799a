"""Rows that every operator has to survive, under columns whose names clash with the operators' own."""

import random
import re

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, h long, node long, key string, "
          "copies int, score double, base string, row_key int")
BLANK = "[\x20\x09-\x0d]+"


def frame(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None, 1, 2, "k", 9, 0.5, "b", 3) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(n, seed=0):
    """n words, the same for the same seed."""
    rng = random.Random(seed * 7919 + 1)
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


ODD = [(1, None, None), (2, "", "a"), (3, "   \n\t ", "b"), (4, "one", "b"), (5, prose(30000, 3), None), (6, "é" * 5000, "b"),
       (7, "Same Text here for all five", "a"), (8, "same text HERE for all five", "a"), (8, "same text HERE for all five", "a"),
       (None, "nobody's text", "b"), (10, "🙂 <|endoftext|> [INST]", "c")]


def words(text):
    fold = (text or "").translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}))
    return [w for w in re.split(BLANK, fold) if w]
