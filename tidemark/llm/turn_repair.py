"""Operator 13: cheapest repair of conversations by rank-convergence parallel Viterbi.

A conversation's rows are a path through four states (nothing yet, after a
system turn, after a user's, after an assistant's); editing costs make the
cheapest legal path a shortest path over (min, +). Backward cost vectors of a
conversation depend on everything behind a row, so conversations are cut into
chunks that Spark handles apart:

1. Every chunk starts backwards from speculative cost vectors. Constants aside,
   few vectors can stand behind a row (`SHAPES`), so it runs from all of them.
   Where the resulting vectors differ only by constants the chunk has
   converged: whatever follows changes its costs by a constant and no decision.
2. Fix-up passes rerun the others from their successor's vectors until none is
   left whose vectors differ by more. A pass spans twice as many chunks as
   the last, so that a stretch of any length that forgets nothing (rows that
   have to go) takes a logarithmic number of passes.
3. The stitched backward costs drive the forward trace, which takes the
   ASCII-least edit among the cheapest at each step. The state in which a
   chunk begins is speculative too: each chunk traces from all four, the traces
   that agree have converged, the others are composed as above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, staged
from tidemark.llm.spread import spread_join

#: Rows and characters in a chunk; bounds a Python worker's memory and a task's smallest unit.
CHUNK_ROWS, CHUNK_CHARS = 256, 1 << 17

# Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# Faults in the order in which they count.
FAULTS = ["blank", "duplicate", "truncated"]

# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant; a conversation may end in 0 or 3.
_NEXT = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
_NAMES = {"u": "user", "a": "assistant"}
_INF = 1 << 40
_LEGAL = ("su", "ua", "au")


def _insertable(state: int) -> list[tuple[int, str]]:
    return [(t, c) for c, t in _NEXT[state].items() if c in _NAMES]


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    """Costs from each state when rows may be inserted first (a cycle of inserts only adds)."""
    costs = list(costs)
    for _ in range(3):
        for q in range(4):
            costs[q] = min([costs[q], *[INSERT + costs[t] for t, _ in _insertable(q)]])
    return tuple(costs)


#: Costs behind a conversation's last row.
END = _with_inserts([0, _INF, _INF, 0])

# A row is a byte: 4 * (0 may stay, 1 truncated, 2 has to go) + its role's initial, of "sua" or another.
_INITIALS = "sua"


def row_code(initial: str, fault: int | None) -> int:
    """`fault` is an index of FAULTS or None."""
    kind = {None: 0, 0: 2, 1: 2, 2: 1}[fault]
    return 4 * kind + (_INITIALS.index(initial) if initial and initial in _INITIALS else 3)


def _edits(code: int, state: int) -> list[tuple[str, int, int, str | None]]:
    """(edit, cost, next state, new role's initial) of the row in `state`, without inserts; ASCII order of edits."""
    kind, role = divmod(code, 4)
    out = [("D", DELETE, state, None)]
    if kind < 2:
        extra = TRUNCATED * kind
        if role < 3 and _INITIALS[role] in _NEXT[state]:
            out.append(("K", extra, _NEXT[state][_INITIALS[role]], None))
        out += [("R", REROLE + extra, t, c) for t, c in _insertable(state)]
    return out


def _normal(costs) -> tuple[int, ...]:
    least = min(costs)
    return tuple(c - least for c in costs)


@lru_cache(maxsize=1 << 16)
def back(code: int, behind: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before the row from costs behind it, less their least."""
    return _normal(_with_inserts([min(c + behind[t] for _, c, t, _ in _edits(code, q)) for q in range(4)]))


def _reachable() -> list[tuple[int, ...]]:
    found, new = {END}, [END]
    while new:
        behind = new.pop()
        for code in range(12):
            before = back(code, behind)
            if before not in found:
                found.add(before)
                new.append(before)
    return sorted(found)


#: Every cost vector, constants aside, that can stand behind a row.
SHAPES = _reachable()
_NUMBER = {shape: n for n, shape in enumerate(SHAPES)}


def chunk_shapes(codes: bytes) -> list[int]:
    """For every speculative vector behind a chunk (by its number in SHAPES) the one before it; runs that meet go on as one."""
    at = list(range(len(SHAPES)))
    for code in reversed(codes):
        step = {n: _NUMBER[back(code, SHAPES[n])] for n in set(at)}
        at = [step[n] for n in at]
    return at


def compose(first: list[int], then: list[int]) -> list[int]:
    """`then`, and `first` on what it gives."""
    return [first[n] for n in then]


def converged(run: list[int]) -> bool:
    """Whether all starts ended in one: the vectors differ only by constants."""
    return len(set(run)) == 1


def behind_rows(codes: bytes, end: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Normalised costs behind each row, given those behind the chunk."""
    out, costs = [], end
    for code in reversed(codes):
        out.append(costs)
        costs = back(code, costs)
    return out[::-1]


def _moves(state: int, code: int | None, behind: tuple[int, ...], before: tuple[int, ...]) -> tuple[str, int, int, str | None]:
    """The ASCII-least edit that keeps to the cheapest: before a row (`code`), or behind the last one."""
    edits = [("I", INSERT + before[t], t, c, INSERT) for t, c in _insertable(state)]
    if code is not None:
        edits += [(e, cost + behind[t], t, c, cost) for e, cost, t, c in _edits(code, state)]
    least = min(total for _, total, _, _, _ in edits)
    edit, _, t, c, cost = min((e for e in edits if e[1] == least), key=lambda e: e[0])
    return edit, cost, t, c


@lru_cache(maxsize=1 << 16)
def _row_trace(state: int, code: int, behind: tuple[int, ...]) -> tuple[tuple[tuple[str, str | None], ...], int, int]:
    """(edits up to and with the row's own, cost, next state)."""
    raw = [min(c + behind[t] for _, c, t, _ in _edits(code, q)) for q in range(4)]
    before, out, cost = _with_inserts(raw), [], 0
    while True:
        edit, c, state, role = _moves(state, code, behind, before)
        out.append((edit, role))
        cost += c
        if edit != "I":
            return tuple(out), cost, state


def end_trace(state: int) -> tuple[list[tuple[str, str | None]], int]:
    """Edits and cost behind a conversation's last row."""
    out, cost = [], 0
    while state not in (0, 3):
        edit, c, state, role = _moves(state, None, END, END)
        out.append((edit, role))
        cost += c
    return out, cost


def end_state(state: int, codes: bytes, behind: list[tuple[int, ...]]) -> int:
    for code, costs in zip(codes, behind, strict=True):
        state = _row_trace(state, code, costs)[2]
    return state


# ------------------------------------------------------------------ on Spark

def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of `conversations` (conv_id, turn, role, text) damaged by crc32(`conv_id:turn`) % 20, nulls read as one space:
    0 drops the row, 1 empties its text, 2 removes its full stops, exclamation and question marks, 3 repeats it, 4 makes it the user's."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    text = F.coalesce(F.col("text").cast("string"), space)
    rows = conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), space).alias("role"), text.alias("text"),
                                (F.crc32(key.cast("binary")) % 20).alias("_d"))
    return (rows.where("_d <> 0")
            .withColumn("text", F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
            .withColumn("role", F.when(F.col("_d") == 4, "user").otherwise(F.col("role")))
            .withColumn("_copy", F.explode(F.when(F.col("_d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select("conv_id", "turn", "role", "text"))


_BLANK = r"\x20\x09-\x0D"


def _blank(text: Column) -> Column:
    return ~text.rlike(f"[^{_BLANK}]")


def _truncated(text: Column) -> Column:
    return ~text.rlike(f"[.!?][{_BLANK}]*\\z")


def _chunker(id_type: pa.DataType, turn_type: pa.DataType):
    row = pa.struct([("role", pa.string()), ("text", pa.string())])
    light = pa.struct([("at", pa.int32()), ("key", pa.string())])
    schema = pa.schema([("conv_id", id_type), ("part", pa.int32()), ("seq", pa.int64()), ("codes", pa.binary()), ("n_blank", pa.int64()),
                        ("n_truncated", pa.int64()), ("illegal", pa.int64()), ("first_initial", pa.string()), ("last_initial", pa.string()),
                        ("first_turn", turn_type), ("last_turn", turn_type), ("turns", pa.int64()),
                        ("keys", pa.list_(light)), ("rows", pa.list_(row))])

    def chunk(conv, part: int, seq: int, rows: list[tuple]) -> dict:
        initials = [r[1][:1] for r in rows]
        turns = [r[0] for r in rows if r[0] is not None]
        faults = [r[3] for r in rows]
        return {"conv_id": conv, "part": part, "seq": seq,
                "codes": bytes(row_code(i, f) for i, f in zip(initials, faults, strict=True)),
                "n_blank": faults.count(0), "n_truncated": faults.count(2),
                "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False)),
                "first_initial": initials[0], "last_initial": initials[-1], "first_turn": turns[0] if turns else None,
                "last_turn": turns[-1] if turns else None, "turns": len(set(turns)),
                "keys": [{"at": n, "key": r[4]} for n, r in enumerate(rows) if r[3] != 0],
                "rows": [{"role": r[1], "text": r[2]} for r in rows]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, out, rows, chars, held, current, begun = TaskContext.get().partitionId(), 0, [], [], 0, 0, None, False
        for batch in batches:
            for conv, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if begun and (conv != current or len(rows) >= CHUNK_ROWS or chars >= CHUNK_CHARS):
                    out.append(chunk(current, part, seq, rows))
                    seq, held, rows, chars = seq + 1, held + chars, [], 0
                    if len(out) >= 256 or held >= CHUNK_CHARS:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out, held = [], 0
                current, begun = conv, True
                rows.append(rest)
                chars += len(rest[1]) + len(rest[2])
        if rows:
            out.append(chunk(current, part, seq, rows))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    return run


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def conversation_chunks(rows: DataFrame) -> DataFrame:
    """Chunks of the conversations in `rows` (conv_id, turn, role, text), numbered through by `chunk` in order of
    (conv_id, turn, place), a conversation's chunks next to each other; turn nulls first, rows of one turn by role, then text hash.

    Rows are range-partitioned by that order, so that a conversation of any share of all rows is spread over tasks.
    """
    rows = (rows.withColumn("h", F.xxhash64("text"))
            .withColumn("key", F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
            .withColumn("fault", F.when(_blank(F.col("text")), 0).when(_truncated(F.col("text")), 2))
            .withColumn("n", F.monotonically_increasing_id()))
    order = ["conv_id", "turn", "role", "h", "n"]
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    made = (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "fault", "key")
            .mapInArrow(_chunker(_arrow(rows, "conv_id"), _arrow(rows, "turn")),
                        f"conv_id {kinds['conv_id']}, part int, seq long, codes binary, n_blank long, n_truncated long, illegal long, "
                        f"first_initial string, last_initial string, first_turn {kinds['turn']}, last_turn {kinds['turn']}, turns long, "
                        "keys array<struct<at: int, key: string>>, rows array<struct<role: string, text: string>>"))
    made = staged(made, "chunks")
    counts = made.groupBy("part").agg(F.count("*").alias("n"))  # one row a partition
    sums = [(r.part, r.n) for r in counts.orderBy("part").collect()]
    starts, at = [], 0
    for part, n in sums:
        starts.append((part, at))
        at += n
    table = made.sparkSession.createDataFrame(starts, "part int, start long")
    return made.join(F.broadcast(table), "part").withColumn("chunk", F.col("start") + F.col("seq")).drop("part", "seq", "start")


def _duplicates(chunks: DataFrame) -> DataFrame:
    """(chunk, again): the places of rows whose role and text their conversation had before."""
    rows = chunks.select("conv_id", "chunk", F.inline("keys")).withColumn("key", F.concat_ws(
        "|", F.coalesce(F.col("conv_id").cast("string"), F.lit("\0")), "key"))
    first = (rows.groupBy("key").agg(F.min(F.struct("chunk", "at")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    again = spread_join(rows, first, "key", F.struct("chunk", "at")).where(F.struct("chunk", "at") > F.col("first"))
    return again.groupBy("chunk").agg(F.sort_array(F.collect_list("at")).alias("again"))


def _arrow_map(df: DataFrame, fields: list[tuple[str, pa.DataType]], ddl: str, row) -> DataFrame:
    """Every row of `df` (a dict) through `row`, to a tuple of `fields`."""
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [row(r) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), schema, strict=True)]
                                             if made else [pa.array([], f.type) for f in schema], schema=schema)
    return df.mapInArrow(run, ddl)


def _same_conversation(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _coded(chunks: DataFrame) -> DataFrame:
    """(conv_id, chunk, codes, n_duplicate, n_truncated): codes with the duplicates, their first fault, marked."""
    def mark(r: dict) -> tuple:
        codes = bytearray(r["codes"])
        lost = 0
        for at in r["again"] or []:
            lost += codes[at] // 4 == 1
            codes[at] = 8 + codes[at] % 4
        return r["chunk"], bytes(codes), len(r["again"] or []), r["n_truncated"] - lost

    light = chunks.select("chunk", "codes", "n_truncated").join(_duplicates(chunks), "chunk", "left")
    coded = _arrow_map(light, [("chunk", pa.int64()), ("codes", pa.binary()), ("n_duplicate", pa.int64()), ("n_truncated", pa.int64())],
                       "chunk long, codes binary, n_duplicate long, n_truncated long", mark)
    return staged(chunks.select("conv_id", "chunk").join(coded, "chunk"), "codes")


def _beside(df: DataFrame, distance: int, *columns: str) -> DataFrame:
    """`df` (conv_id, chunk, ...) with the `columns` of the chunk `distance` further on in the same conversation as other_*."""
    other = df.select((F.col("chunk") - distance).alias("chunk"), F.col("conv_id").alias("other_conv"),
                      *[F.col(c).alias(f"other_{c}") for c in columns])
    same = F.col("other_conv").eqNullSafe(F.col("conv_id")) & F.col("has_other")
    joined = df.join(other.withColumn("has_other", F.lit(True)), "chunk", "left")
    return joined.select(*df.columns, *[F.when(same, F.col(f"other_{c}")).alias(f"other_{c}") for c in columns],
                         F.coalesce(same, F.lit(False)).alias("has_other"))


_INTS = pa.list_(pa.int32())


def _fix_ups(runs: DataFrame, fields: list[tuple[str, pa.DataType]], ddl: str, distance: int, label: str) -> DataFrame:
    """Fix-up passes over `runs` (conv_id, chunk, run, open) until no run is open: neither with different ends nor with
    a chunk of its conversation left to meet, looking `distance` (1 or -1) chunks on, then twice as far each time."""
    def fix_up(r: dict) -> tuple:
        if not r["open"] or not r["has_other"]:  # converged, or meets the conversation's own end next
            return r["conv_id"], r["chunk"], r["run"], False
        run = compose(r["run"], r["other_run"])
        return r["conv_id"], r["chunk"], run, not converged(run)

    while not runs.where("open").isEmpty():
        runs = staged(_arrow_map(_beside(runs, distance, "run"), fields, ddl, fix_up), label)
        distance *= 2
    return runs


def _run_fields(df: DataFrame) -> tuple[list[tuple[str, pa.DataType]], str]:
    return ([("conv_id", _arrow(df, "conv_id")), ("chunk", pa.int64()), ("run", _INTS), ("open", pa.bool_())],
            f"conv_id {df.schema['conv_id'].dataType.simpleString()}, chunk long, run array<int>, open boolean")


def _end_costs(coded: DataFrame) -> DataFrame:
    """`coded` with behind (costs behind each chunk but for a constant, a number of SHAPES) and last (whether nothing of
    its conversation follows), by speculative runs and fix-up passes."""
    fields, ddl = _run_fields(coded)

    def speculate(r: dict) -> tuple:
        run = chunk_shapes(r["codes"])
        return r["conv_id"], r["chunk"], run, not converged(run)

    runs = staged(_arrow_map(coded.select("conv_id", "chunk", "codes"), fields, ddl, speculate), "vectors")
    runs = _fix_ups(runs, fields, ddl, 1, "vectors")
    before = runs.select("conv_id", "chunk", F.col("run")[_NUMBER[END]].alias("before"))
    behind = _beside(before, 1, "before").select(
        "chunk", F.coalesce("other_before", F.lit(_NUMBER[END])).alias("behind"), (~F.col("has_other")).alias("last"))
    return staged(coded.join(behind, "chunk"), "behind")


def _start_states(costs: DataFrame) -> DataFrame:
    """(chunk, start): the state in which each chunk begins, by traces from all states and fix-up passes."""
    fields, ddl = _run_fields(costs)

    def speculate(r: dict) -> tuple:
        behind = behind_rows(r["codes"], SHAPES[r["behind"]])
        run = [end_state(q, r["codes"], behind) for q in range(4)]
        return r["conv_id"], r["chunk"], run, not converged(run)

    runs = staged(_arrow_map(costs.select("conv_id", "chunk", "codes", "behind"), fields, ddl, speculate), "traces")
    runs = _fix_ups(runs, fields, ddl, -1, "traces")
    return _beside(runs, -1, "run").select("chunk", F.coalesce(F.col("other_run")[0], F.lit(0)).alias("start"))


def repair_edits(chunks: DataFrame, coded: DataFrame) -> DataFrame:
    """The cheapest edits, a row a chunk: conv_id, chunk, audit (initials of the edits in order), cost, and the repaired
    rows as edited (role, text)."""
    costs = _end_costs(coded)
    plan = costs.select("chunk", "codes", "behind", "last").join(_start_states(costs), "chunk")
    row = pa.struct([("role", pa.string()), ("text", pa.string())])

    def trace(r: dict) -> tuple:
        state, cost, audit, out = r["start"], 0, [], []
        behind = behind_rows(r["codes"], SHAPES[r["behind"]])
        for code, costs_behind, old in zip(r["codes"], behind, r["rows"], strict=True):
            edits, add, state = _row_trace(state, code, costs_behind)
            cost += add
            for edit, role in edits:
                audit.append(edit)
                if edit == "I":
                    out.append({"role": _NAMES[role], "text": ""})
                elif edit != "D":
                    out.append({"role": old["role"] if edit == "K" else _NAMES[role], "text": old["text"]})
        if r["last"]:
            edits, add = end_trace(state)
            cost += add
            audit += [e for e, _ in edits]
            out += [{"role": _NAMES[c], "text": ""} for _, c in edits]
        return r["conv_id"], r["chunk"], "".join(audit), cost, out

    return _arrow_map(chunks.select("conv_id", "chunk", "rows").join(plan, "chunk"),
                      [("conv_id", _arrow(chunks, "conv_id")), ("chunk", pa.int64()), ("audit", pa.string()), ("cost", pa.int64()),
                       ("edited", pa.list_(row))],
                      f"conv_id {chunks.schema['conv_id'].dataType.simpleString()}, chunk long, audit string, cost long, "
                      "edited array<struct<role: string, text: string>>", trace)


def chunk_faults(chunks: DataFrame, coded: DataFrame) -> DataFrame:
    """Per conversation: gaps, blank, duplicate, truncated, illegal; chunk figures and what happens between chunks, summed."""
    light = chunks.select("conv_id", "chunk", "n_blank", "illegal", "first_initial", "last_initial", "first_turn", "last_turn", "turns")
    both = _beside(light, 1, "first_initial", "first_turn").join(coded.select("chunk", "n_duplicate", "n_truncated"), "chunk")
    between = F.col("has_other") & ~F.concat("last_initial", "other_first_initial").isin(*_LEGAL)
    # a turn number that ends one chunk and begins the next is one
    shared = F.col("last_turn").isNotNull() & (F.col("last_turn") == F.col("other_first_turn"))
    return both.groupBy("conv_id").agg(
        F.coalesce(F.max("last_turn") - F.min("first_turn") + 1 - (F.sum("turns") - F.count_if(shared)), F.lit(0)).cast("long").alias("gaps"),
        F.sum("n_blank").alias("blank"), F.sum("n_duplicate").alias("duplicate"), F.sum("n_truncated").alias("truncated"),
        (F.sum("illegal") + F.count_if(between)).alias("illegal"))


def _folder(id_type: pa.DataType):
    schema = pa.schema([("conv_id", id_type), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, current, state = [], None, None

        def close() -> None:
            done.append({"conv_id": current, "cost": state[0], "audit": "".join(state[1]), "repaired_sha256": state[2].hexdigest()})

        for batch in batches:
            for r in batch.to_pylist():
                if state is None or r["conv_id"] != current:
                    if state is not None:
                        close()
                    current, state = r["conv_id"], [0, [], hashlib.sha256(), False]
                state[0] += r["cost"]
                state[1].append(r["audit"])
                for e in r["edited"]:
                    state[2].update((b"\n" if state[3] else b"") + f"{e['role']}:{e['text']}".encode())
                    state[3] = True
            if len(done) >= 512:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
                done = []
        if state is not None:
            close()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)
    return run


def conversation_repairs(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """One row per conv_id of `conversations`, whose rows after damage are `rows` (conv_id, turn, role, text; default
    `conversations` itself): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A row's first fault counts: blank, duplicate (its conversation had the role and text before), truncated. The
    repaired role initials follow (s?(ua)+)?; audit is the ASCII-least among the cheapest. Rows are taken by
    turn, nulls first; rows of one turn by role, then by a hash of their text. Null role or text is one space;
    a role whose first character is not s, u or a (an empty one too) cannot be kept. Rows without a conv_id are one
    conversation. A conversation without rows has zeros, an empty audit and the empty string's digest; an empty table
    gives no rows; other columns are ignored. Eager: building the result runs jobs.

    Only the last step, SHA-256 over a whole conversation, passes a conversation through one task: chunk by chunk.
    """
    space = F.lit(" ")
    given = conversations if rows is None else rows
    prepare(given.sparkSession)
    chunks = conversation_chunks(given.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), space).alias("role"),
                                              F.coalesce(F.col("text").cast("string"), space).alias("text")))
    coded = _coded(chunks)
    edits = staged(repair_edits(chunks, coded), "edits")
    folded = edits.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").select("conv_id", "cost", "audit", "edited").mapInArrow(
        _folder(_arrow(edits, "conv_id")), f"conv_id {edits.schema['conv_id'].dataType.simpleString()}, cost long, audit string, repaired_sha256 string")
    ids = conversations.select("conv_id").distinct()
    faults = chunk_faults(chunks, coded)
    zero = F.lit(0).cast("long")
    out = (ids.join(faults.withColumnRenamed("conv_id", "f"), F.col("conv_id").eqNullSafe(F.col("f")), "left")
           .join(folded.withColumnRenamed("conv_id", "e"), F.col("conv_id").eqNullSafe(F.col("e")), "left"))
    return out.select("conv_id", *[F.coalesce(F.col(c).cast("long"), zero).alias(c) for c in
                                   ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))
