"""Chat formatting with offset-aligned loss masks."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare
from tidemark.llm.tokens import load, tokenizer_path

#: The template: every turn starts with "<" and ends with ">\n", so no token of a byte-level
#: BPE crosses a turn's edge and conversations may be encoded in runs of whole turns.
START, END = "<|im_start|>", "<|im_end|>\n"
#: Control strings of this and other templates; inside texts a backslash goes behind their first character.
_CONTROL = re.compile(r"([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(\||/?s>|/?INST\]|</?SYS>>)")
#: Turns of a conversation that are always rendered together, and the most of a run.
BLOCK_TURNS, RUN_TURNS, RUN_CHARS = 256, 256, 1 << 18


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted turns (role, text) and the character spans of the assistant's texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = f"{START}{escape(role).replace('%', '%25').replace(chr(10), '%0A')}\n"
        body = escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, END)
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text; the inverse of `render`."""
    turns = []
    for turn in formatted.split(END)[:-1]:
        role, _, text = turn[len(START):].partition("\n")
        turns.append((unescape(role.replace("%0A", "\n").replace("%25", "%")), unescape(text)))
    return turns


def masked_tokens(offsets: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The loss mask of tokens with sorted (start, end) offsets, and the characters it covers.

    A token is masked in when it shares a character with a span; both lists are
    sorted, so a span's tokens are found by two binary searches. Covered are the
    intersections of tokens and spans, merged.
    """
    mask, covered = np.zeros(len(offsets), bool), []
    if not len(offsets):
        return mask, covered
    ends = offsets[:, 1]
    # the library trims blanks off a token's start; every character belongs to some token
    starts = np.minimum(offsets[:, 0], np.concatenate(([0], ends[:-1])))
    for s, e in spans:
        i, j = np.searchsorted(ends, s, "right"), np.searchsorted(starts, e, "left")
        if e <= s or j <= i:
            continue
        mask[i:j] = True
        for a, b in zip(np.maximum(starts[i:j], s).tolist(), np.minimum(ends[i:j], e).tolist(), strict=True):
            if covered and a <= covered[-1][1] and covered[-1][0] >= s:
                covered[-1] = (covered[-1][0], max(b, covered[-1][1]))
            else:
                covered.append((a, b))
    return mask, covered


def _formatter(path: str, id_type: pa.DataType):
    def rows(runs: list, part: int, seq: int) -> pa.RecordBatch:
        tokenizer = load(path, special_as_text=True)[0]
        rendered = [render(turns) for _, turns in runs]
        encoded = tokenizer.encode_batch([text for text, _ in rendered], add_special_tokens=False)
        masks = [masked_tokens(np.array(e.offsets, np.int64).reshape(-1, 2), spans)
                 for e, (_, spans) in zip(encoded, rendered, strict=True)]
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return pa.record_batch([
            pa.array([c for c, _ in runs], id_type), pa.array([part] * len(runs), pa.int64()),
            pa.array(range(seq, seq + len(runs)), pa.int64()), pa.array([len(t) for _, t in runs], pa.int64()),
            pa.array([text for text, _ in rendered], pa.string()), pa.array([e.ids for e in encoded], pa.list_(pa.int32())),
            pa.array([m.tolist() for m, _ in masks], pa.list_(pa.bool_())),
            pa.array([[{"start": a, "end": b} for a, b in c] for _, c in masks], pa.list_(span))],
            names=["conv_id", "part", "seq", "n_turns", "formatted", "ids", "loss", "loss_spans"])

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        runs, turns, chars, held, current, begun = [], [], 0, 0, None, False
        for batch in batches:
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if begun and (conv != current or len(turns) >= RUN_TURNS or chars >= RUN_CHARS):
                    runs.append((current, turns))
                    turns, held, chars = [], held + chars, 0
                    if len(runs) >= 256 or held >= RUN_CHARS:
                        yield rows(runs, part, seq)
                        seq, runs, held = seq + len(runs), [], 0
                current, begun = conv, True
                turns.append((role, text))
                chars += len(text)
        if turns:
            runs.append((current, turns))
        if runs:
            yield rows(runs, part, seq)
    return form


def _arrow_id(df: DataFrame, column: str) -> pa.DataType:
    return {"string": pa.string(), "int": pa.int32()}.get(df.schema[column].dataType.simpleString(), pa.int64())


def format_conversations(conversations: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Formatted, encoded and masked conversations from rows (conv_id, turn, role, text).

    One row per run of a conversation's turns, in order of (part, seq): conv_id,
    part, seq, n_turns, formatted, ids, loss (per token), loss_spans (the
    characters of `formatted` under the mask). A conversation of up to 256 turns
    is one run; a longer one is cut between turns, where no token crosses, so
    its ids and masks, put together, are those of the whole. Rows are
    range-partitioned by (conversation, block of 256 turn numbers) and streamed
    in order, so neither a task's memory nor, for a conversation of very many
    turns, a task's share grows with one conversation.

    The assistant's texts are under the mask. Turns are ordered by turn (null
    first), then role and text, where turns repeat. Null text or role is empty, a
    null conv_id is a conversation of its own, an empty table gives no rows,
    other columns are ignored. Control strings in texts and roles are escaped
    reversibly (`parse`).
    """
    prepare(conversations.sparkSession)
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text"))
    id_type = rows.schema["conv_id"].dataType.simpleString()
    return (rows.withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS)).repartitionByRange("conv_id", "block")
            .sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
            .mapInArrow(_formatter(tokenizer or tokenizer_path(), _arrow_id(rows, "conv_id")),
                        f"conv_id {id_type}, part long, seq long, n_turns long, formatted string, ids array<int>, "
                        "loss array<boolean>, loss_spans array<struct<start: long, end: long>>"))


def _digester(id_type: pa.DataType):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, state, current = [], None, None

        def close() -> None:
            n, turns, chars, loss, formatted = state
            done.append((current, n, turns.hexdigest(), chars, loss.hexdigest(), formatted))

        def out() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            for r in batch.to_pylist():
                if state is None or r["conv_id"] != current:
                    if state is not None:
                        close()
                    current, state = r["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(r["formatted"]):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for s in r["loss_spans"]:
                    text = unescape(r["formatted"][s["start"]:s["end"]])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(r["formatted"])
            if done:
                yield out()
                done = []
        if state is not None:
            close()
            yield out()
    return digest


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from `format_conversations`: number of turns, SHA-256 of the
    turns and of the text under the mask, characters. A digest of a sequence is folded in its
    order, so a conversation's runs pass one task, as a stream of one run at a time."""
    prepare(formatted.sparkSession)
    id_type = formatted.schema["conv_id"].dataType.simpleString()
    return (formatted.select("conv_id", "part", "seq", "formatted", "loss_spans").repartition("conv_id")
            .sortWithinPartitions("conv_id", "part", "seq")
            .mapInArrow(_digester(_arrow_id(formatted, "conv_id")),
                        f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                        "formatted_chars long"))
