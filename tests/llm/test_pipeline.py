"""The pipeline's stages on a small corpus, one after another."""

import zlib
from collections import Counter

import corpus_pipeline as P
import numpy as np
from edge import prose

from tidemark.llm import tokens as T

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    docs, labels = [], []
    vocabulary = prose(300, 1).split()
    import random
    rng = random.Random(1)
    for i in range(300):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(30, 60))]
        bad = i % 5 == 0
        text = " ".join(x.upper() + "!!" for x in w) if bad else " ".join(w)
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, int(not bad), 0))
    near = docs[1][1].split()
    near[0] = "changed"
    docs.append((400, " ".join(near), "en", None, None))
    docs.append((401, docs[2][1], None, "s1", 3))
    docs.append((402, docs[4][1] + " " + prose(30, 777), "en", "s2", 1))
    return docs, labels


def test_stages(spark, tmp_path):
    docs, labels = corpus()
    d = str(tmp_path)
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, prose(30, 777))], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    assert [n for n, _ in P.STAGES][:4] == ["quality classifier", "MinHash near-dedup", "benchmark decontamination",
                                            "mixing sources to target weights"]
    df, ids = spark.read.parquet(f"{d}/documents.parquet"), []
    for k, (_, stage) in enumerate(P.STAGES[:-1]):
        stage(spark, df, d).write.parquet(f"{d}/{k}")
        df = spark.read.parquet(f"{d}/{k}")
        assert df.columns == P.COLUMNS
        ids.append({r.doc_id for r in df.select("doc_id").collect()})
    good = {i for i in range(300) if i % 5} | {400, 401, 402}
    assert ids[0] == good
    assert good - ids[1] == {400, 401}
    assert ids[1] - ids[2] == {402}
    assert ids[3] <= ids[2]
    copies = Counter(r.doc_id for r in df.collect())
    assert set(copies.values()) <= {1, 2, 3}
    rows = P.STAGES[-1][1](spark, df, d).orderBy("start").collect()
    tokenizer, text, start = T.load(T.tokenizer_path())[0], {r[0]: r[1] for r in docs}, 0
    assert [r.doc_id for r in rows] == sorted(copies.elements())
    for r in rows:
        want = np.array(tokenizer.encode(text[r.doc_id], add_special_tokens=False).ids + [2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)


def test_rows_without_or_with_repeated_identifiers(spark, tmp_path):
    """Decisions are on rows: no identifier, one identifier with two texts, whole rows repeated."""
    d = str(tmp_path)
    a, b, item = prose(60, 1), prose(60, 2), prose(30, 777)
    rows = [(None, a, "en", "s", 1), (None, a + " x", "en", "s", 1), (3, a + " y", "en", "s", 1),            # one group: 3 stays
            (7, b, "en", "s", 1), (7, prose(60, 3), "en", "s", 1), (8, b + " z", "en", "s", 1),               # 8 goes, both of 7 stay
            (9, prose(60, 4), "en", "s", 1), (9, prose(60, 4), "de", "t", 2), (None, prose(60, 5), None, None, None),
            (None, prose(60, 5), None, None, None), (None, "", "en", "s", 0), (None, None, None, None, None),
            (None, prose(20, 8) + " " + item, "en", "s", 1), (11, prose(20, 9) + " " + item + " " + prose(5, 3), "en", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    kept = Counter((r.doc_id, r.text) for r in P.near_dedup(spark, df, d).collect())
    assert kept == Counter({(3, a + " y"): 1, (7, b): 1, (7, prose(60, 3)): 1, (9, prose(60, 4)): 1, (None, prose(60, 5)): 1, (None, ""): 1,
                            (None, None): 1, (None, rows[12][1]): 1, (11, rows[13][1]): 1})
    left = P.decontaminate(spark, df, d)
    assert left.columns == P.COLUMNS and Counter(r.text for r in left.collect()) == Counter(r[1] for r in rows[:12])


def test_empty_corpus(spark, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    assert P.run(spark, d).count() == 0
