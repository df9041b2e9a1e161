"""Conversations as one training text each, with a mask over the tokens that a model should learn.

A conversation is rendered once, encoded once with character offsets, and the sorted spans of its assistant texts are intersected with
the token spans by bisection. The marks of the template are tokens of their own, added to the vocabulary, so no token lies
on both sides of a span's edge. Inside roles and texts a backslash is doubled and the opening of a mark is broken by one, which
can be undone and makes forged marks ordinary text.

Turns are ordered by turn, role and text, NULL first; a repeated row is another turn. NULL texts and roles are empty. Rows without
a conv_id are one conversation. Rows of a conversation arrive sorted, one conversation is in memory at a time.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

TURN, TEXT, END = MARKS = ("<|turn|>", "<|text|>", "<|end|>")
LEARNED = "assistant"
AT_ONCE = 1 << 20  # characters that are encoded together

FORMATTED = "formatted string, input_ids array<int>, starts array<int>, ends array<int>, loss_mask array<boolean>"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of the learned texts in it."""
    out, at, spans = [], 0, []
    for role, text in turns:
        head, body = TURN + escape(role) + TEXT, escape(text)
        if role == LEARNED:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for part in formatted.split(END)[:-1]:
        role, text = part.removeprefix(TURN).split(TEXT)
        turns.append((unescape(role), unescape(text)))
    return turns


def mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie in one of the sorted spans."""
    if not spans:
        return np.zeros(len(starts), bool)
    low, high = np.array(spans).T
    at = np.searchsorted(low, starts, "right") - 1
    return (at >= 0) & (ends <= high[at]) & (starts < high[at])


def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens(list(MARKS))
    return tokenizer


def format_conversations(rows: DataFrame, tokenizer: str) -> DataFrame:
    """conv_id, formatted, input_ids, starts, ends (of each token in characters), loss_mask."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    turns = rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def encoded(tokenizer_, waiting, id_type) -> pa.RecordBatch:
        found = tokenizer_.encode_batch([text for _, text, _ in waiting], add_special_tokens=False)
        columns = ([], [], [], [])
        for (_, _, spans), e in zip(waiting, found):
            places = np.array(e.offsets, np.int32).reshape(-1, 2)
            learned = mask(places[:, 0], places[:, 1], spans)
            for column, value in zip(columns, (e.ids, places[:, 0], places[:, 1], learned)):
                column.append(value)
        ids, starts, ends, learned = columns
        ints = pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([c for c, _, _ in waiting], id_type),
                pa.array([text for _, text, _ in waiting], pa.string()),
                pa.array(ids, ints),
                pa.array(starts, ints),
                pa.array(ends, ints),
                pa.array(learned, pa.list_(pa.bool_())),
            ],
            names=["conv_id", "formatted", "input_ids", "starts", "ends", "loss_mask"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer_ = load_tokenizer(tokenizer)
        now, turns, waiting, size, id_type = None, [], [], 0, None
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if turns and conv != now:
                    waiting.append((now, *render(turns)))
                    size += len(waiting[-1][1])
                    turns = []
                    if size > AT_ONCE:
                        yield encoded(tokenizer_, waiting, id_type)
                        waiting, size = [], 0
                now = conv
                turns.append((role, text))
        if turns:
            waiting.append((now, *render(turns)))
        if waiting:
            yield encoded(tokenizer_, waiting, id_type)

    return dealt.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, {FORMATTED}")


def learned_text(formatted: str, starts: np.ndarray, ends: np.ndarray, learned: np.ndarray) -> str:
    """What lies under the mask, unescaped."""
    out, at = [], -1
    begin = at
    for a, b in zip(starts[learned].tolist(), ends[learned].tolist()):
        if a > at:
            out.append(formatted[begin:at] if at >= 0 else "")
            begin = a
        at = max(at, b)
    if at >= 0:
        out.append(formatted[begin:at])
    return "".join(map(unescape, out))


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader finds in the formatted conversations."""
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts = batch.column("formatted").to_pylist()
            arrays = [batch.column(c) for c in ("starts", "ends", "loss_mask")]
            for i, text in enumerate(texts):
                turns = parse(text)
                starts, ends, learned = (np.array(a[i].values.to_numpy(zero_copy_only=False)) for a in arrays)
                loss = learned_text(text, starts, ends, learned.astype(bool))
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                rows.append((len(turns), sha(whole), len(loss), sha(loss), len(text), len(starts)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns], names=names)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]
    schema = f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_tokens bigint"
    return formatted.select("conv_id", "formatted", "starts", "ends", "loss_mask").mapInArrow(run, schema)
