"""Personal data: base patterns, and identifiers found by bootstrapped lexical patterns (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import row_key, staged

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. Possessive where a retry could not match either, and begun only where a match
#: can begin, so that long runs of such characters take linear time and no stack.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain for a kind to be looked for.
HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
#: A word that could be an identifier: it holds a digit or an at sign.
CANDIDATE = r"(?<![^\x20\x09-\x0D])[^0-9@\x20\x09-\x0D]*+[0-9@][^\x20\x09-\x0D]*+"
BLANKS = r"[\x20\x09-\x0D]+"
#: Matches whose lengths are added up at a time.
BLOCK = 128


def _valid(kind: str, m: Column) -> Column:
    """The conditions that a match of the kind's pattern has to meet."""
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return m.rlike(rf"^{part}(?:\.{part}){{3}}$")
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "card":
        figures = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.ascii(F.substr(F.reverse(digits), i, F.lit(1))) - 48)
        # every second figure from the right counts twice, less 9 from 10 on
        total = F.aggregate(F.transform(figures, lambda d, i: F.when(i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)),
                            F.lit(0), lambda a, d: a + d)
        return F.when(F.length(digits).between(16, 19), total % 10 == 0).otherwise(False)
    return F.lit(True)


def _located(df: DataFrame, out: str, pattern: str, wanted: Column) -> DataFrame:
    """Adds `out`: all matches of the pattern as (value, start, end) in code points."""
    none = F.array().cast("array<string>")
    df = df.withColumns({
        f"{out}_m": F.when(wanted, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none),
    }).withColumns({
        # the text between the matches; searched again only where there are some
        f"{out}_g": F.when(F.size(f"{out}_m") > 0, F.transform(F.split("text", pattern, -1), F.length)).otherwise(F.array().cast("array<int>")),
        f"{out}_n": F.transform(f"{out}_m", F.length)})
    # starts are running sums; by blocks, so that a text with very many matches takes n * BLOCK steps
    blocks = F.sequence(F.lit(0), F.floor(F.size(f"{out}_n") / BLOCK).cast("int"))
    df = df.withColumn(f"{out}_s", F.zip_with(F.slice(f"{out}_g", F.lit(1), F.size(f"{out}_n")), f"{out}_n", lambda g, n: g + n))
    df = df.withColumn(f"{out}_b", F.transform(blocks, lambda j: _sum(F.slice(f"{out}_s", j * BLOCK + 1, F.lit(BLOCK)))))
    df = df.withColumn(f"{out}_p", F.transform(blocks, lambda j: _sum(F.slice(f"{out}_b", F.lit(1), j))))

    def located(m: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        start = (F.get(f"{out}_p", block) + _sum(F.slice(f"{out}_s", block * BLOCK + 1, i % BLOCK)) + F.get(f"{out}_g", i))
        return F.struct(m.alias("value"), start.alias("start"), (start + F.length(m)).alias("end"))
    return df.withColumn(out, F.transform(f"{out}_m", located)).drop(*[f"{out}_{x}" for x in "mgnsbp"])


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def _last_words(text: Column) -> Column:
    """The last two words of a text, fewer if it has no more."""
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    return F.slice(words, F.greatest(F.size(words) - 1, F.lit(1)), F.lit(2))


def _checked(number: int, kind: str) -> Column:
    """The valid matches of a kind as (kind number, start, end)."""
    return F.transform(F.filter(kind, lambda s: _valid(kind, s["value"])), lambda s: F.struct(
        F.lit(number).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def _digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: row_key, doc_id, base (array of kind, start, end) and its candidate words.

    A candidate carries its two words to the left (`context`, lower case; null for the first two words of a text), the kind of the base
    span that begins in it (else -1, or -2 where it lies within one), and its span.
    """
    df = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    df = df.withColumn("row_key", row_key(F.col("doc_id"), F.col("text")))
    for kind in KINDS:
        hint = F.contains("text", F.lit(HINTS[kind])) if HINTS[kind] else F.lit(True)
        df = _located(df, kind, PATTERNS[kind], hint)
    df = _located(df, "words", CANDIDATE, F.lit(True))
    df = df.withColumn("base", F.concat(*[_checked(k, kind) for k, kind in enumerate(KINDS)]))

    # candidates are whole words, so the two words before one are the last of those between it and the candidate
    # before, that candidate, the last of those before this one, and the candidate before that
    none = F.array().cast("array<string>")
    between = F.when(F.size("words") > 0, F.transform(F.split(F.lower("text"), CANDIDATE, -1), _last_words)).otherwise(F.array().cast("array<array<string>>"))
    df = df.withColumn("between", between)

    def near(w: Column, i: Column) -> Column:
        one, two = (F.when(i >= k, F.array(F.lower(F.get("words", i - k)["value"]))).otherwise(none) for k in (1, 2))
        before = F.concat(two, F.when(i >= 1, F.get("between", i - 1)).otherwise(none), one, F.get("between", i))
        return F.slice(before, F.greatest(F.size(before) - 1, F.lit(1)), F.lit(2))
    df = df.withColumn("near", F.transform("words", near))

    def candidate(w: Column, i: Column) -> Column:
        near = F.get("near", i)
        head = F.length(F.regexp_extract(w["value"], "^[^A-Za-z0-9]*", 0))
        tail = F.length(F.regexp_extract(w["value"], "[^A-Za-z0-9]*$", 0))
        begun = F.filter("base", lambda s: (s["start"] >= w["start"]) & (s["start"] < w["end"]))
        within = F.exists("base", lambda s: (s["start"] < w["end"]) & (s["end"] > w["start"]))
        return F.struct(
            F.lower(F.regexp_replace(w["value"], "^[^A-Za-z0-9]+|[^A-Za-z0-9]+$", "")).alias("value"),  # without signs at its ends
            F.when(F.size(near) == 2, F.array_join(near, " ")).alias("context"),
            F.when(F.size(begun) > 0, F.element_at(begun, 1)["kind"]).when(within, -2).otherwise(-1).alias("kind"),
            (w["start"] + head).alias("start"), F.greatest(w["end"] - tail, w["start"] + head).alias("end"))

    return df.select("row_key", "doc_id", "base", F.transform("words", candidate).alias("candidates"))


def bootstrapped(found: DataFrame, texts: DataFrame, rounds: int = 3, support: int = 3, confidence: float = 0.8) -> DataFrame:
    """Spans (row_key, kind, start, end) that high-confidence patterns find beyond the base.

    A pattern is the pair of words before an identifier. Seeds are the base spans.
    Patterns that precede at least `support` different seed values of a kind form a
    graph with the values that stand behind them. In each round a pattern's score is
    the sum of its occurrences' value scores (base spans of other kinds count nothing)
    over all its occurrences in the corpus, whatever follows it there, and a value that is no seed takes the score of its best
    pattern. Candidates behind patterns of at least `confidence`, and further
    occurrences of values that reach it, are found.
    """
    every = found.select("row_key", F.explode("candidates").alias("c")).select("row_key", "c.*")
    rows = every.where("context is not null")
    seeds = rows.where("kind >= 0")
    best = (seeds.groupBy("context", "kind").agg(F.countDistinct("value").alias("values"), F.count("*").alias("own"))
            .groupBy("context").agg(F.max(F.struct("values", "kind", "own")).alias("best"), F.sum("own").alias("seeds")))
    # base entities of another kind never count for a pattern, so where they exceed 1 - confidence of
    # the candidates behind it, no score of the others can lift it
    behind = rows.where("kind <> -2").groupBy("context").agg(F.count("*").alias("behind"))
    patterns = staged(best.where(F.col("best.values") >= support).join(behind, "context")
                      .where(F.col("behind") - (F.col("seeds") - F.col("best.own")) >= confidence * F.col("behind"))
                      .select("context", F.col("best.kind").alias("of")), "patterns")
    words = F.split(F.lower(F.trim(F.regexp_replace("text", BLANKS, " "))), " ")
    pairs = F.when(F.size("w") > 2, F.transform(F.sequence(F.lit(1), F.size("w") - 2), lambda i: F.concat_ws(
        " ", F.element_at("w", i), F.element_at("w", i + 1))))
    totals = (texts.select(words.alias("w")).select(F.explode(pairs).alias("context")).join(patterns, "context")
              .groupBy("context").agg(F.count("*").alias("total")))
    patterns = staged(patterns.join(totals, "context"), "patterns")
    # one edge per pattern and value: how often, and whether the value is a seed of the pattern's kind
    edges = staged(rows.where("kind <> -2").join(patterns, "context").where("kind = -1 or kind = of")
                   .groupBy("context", "of", "total", "value")
                   .agg(F.count("*").alias("n"), F.max((F.col("kind") == F.col("of")).cast("double")).alias("score")), "edges")
    scores = edges.select("value", "of", "score")
    for _ in range(rounds):
        seed = F.col("edges.score")
        values = scores.groupBy("value", "of").agg(F.max("score").alias("s"))
        weighed = edges.alias("edges").join(values, ["value", "of"]).groupBy("context", "of").agg(
            F.least(F.sum(F.col("n") * F.greatest(seed, F.col("s"))) / F.first("total"), F.lit(1.0)).alias("p"))
        scores = staged(edges.drop("of").join(weighed, "context").select("value", "of", "context", F.greatest("score", "p").alias("score"), "p"), "scores")
    good = scores.where(F.col("p") >= confidence).select("context", F.col("of").alias("kind_c")).distinct() if rounds else patterns.limit(0)
    known = scores.where((F.col("score") >= confidence) & (F.col("p") >= confidence)).groupBy("value").agg(F.min("of").alias("kind_v"))
    free = every.where("kind = -1 and end - start >= 4").drop("kind")
    return (free.join(good, "context", "left").join(known, "value", "left")
            .withColumn("kind", F.coalesce("kind_c", "kind_v")).where("kind is not null")
            .select("row_key", "kind", "start", "end").distinct())


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: doc_id, base and all (arrays of kind number, start, end; code points, end exclusive).

    `base` holds the matches of the four patterns, `all` also what
    `bootstrapped` adds (never inside a base span). Texts are searched whole. Null
    text is empty; a null identifier is a row like any other; repeated rows get
    equal results; an empty table gives no rows; other columns are ignored.
    """
    found = staged(entities(docs, id_col, text_col), "entities")
    texts = docs.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    added = bootstrapped(found, texts, **options).groupBy("row_key").agg(F.collect_set(F.struct("kind", "start", "end")).alias("added"))
    return (found.join(added, "row_key", "left")
            .select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<kind:int,start:int,end:int>>")))).alias("all")))


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """The spans as counts and strings: n_email, n_ip, n_card, n_phone, base_sha256 (base), spans (all), n_spans (all)
    and n_added (those beyond the base)."""
    df = personal_data(docs)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return df.select("doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
                     F.sha2(_digest(F.col("base")), 256).alias("base_sha256"), _digest(F.col("all")).alias("spans"),
                     F.size("all").cast("long").alias("n_spans"), (F.size("all") - F.size("base")).cast("long").alias("n_added"))
