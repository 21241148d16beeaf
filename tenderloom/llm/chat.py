"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with character offsets, and the
spans of the turns that count for the loss are cut out of the token offsets by
binary search.  Control strings are tokens of their own, so no token crosses
the border of a turn's text.

Template: ``<|im_start|>`` role ``<|im_sep|>`` text ``<|im_end|>`` newline.  In
roles and texts each ``<``, any backslashes, ``|`` gets one backslash more, so
a control string can't come from a text; reading back takes it away.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import tokenizer_path
from .shared import prepared_tasks

START, SEP, STOP = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
_escape, _unescape = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")
_turn = re.compile(re.escape(START) + r"(.*?)" + re.escape(SEP) + r"(.*?)" + re.escape(STOP) + r"\n", re.DOTALL)
_tokenizers: dict[str, object] = {}


def escaped(text: str) -> str:
    return _escape.sub(lambda m: f"<{m[1]}\\|", text)


def unescaped(text: str) -> str:
    return _unescape.sub(lambda m: f"<{m[1]}|", text)


def rendered(turns: list[tuple[str, str]], loss_roles: tuple[str, ...]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the spans of the texts that count for the loss."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escaped(role)}{SEP}", escaped(text)
        if role in loss_roles and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        out.append(f"{head}{body}{STOP}\n")
        at += len(out[-1])
    return "".join(out), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns, from the formatted conversation."""
    return [(unescaped(m[1]), unescaped(m[2])) for m in _turn.finditer(formatted)]


def chat_tokenizer(path: str):
    """The public vocabulary, with the control strings as further tokens."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.add_special_tokens([START, SEP, STOP])
        _tokenizers[path] = t
    return _tokenizers[path]


def masked(offsets: list[tuple[int, int]], spans: list[tuple[int, int]]) -> np.ndarray:
    """1 for each token inside a span; offsets and spans ascend."""
    edges = np.array(offsets, np.int64).reshape(-1, 2)
    mask = np.zeros(len(edges), np.uint8)
    if len(edges) and spans:
        bounds = np.array(spans, np.int64)
        first = np.searchsorted(edges[:, 0], bounds[:, 0], "left")
        last = np.searchsorted(edges[:, 1], bounds[:, 1], "right")
        for a, b in zip(first, last):
            mask[a:b] = 1
    return mask


def mask_spans(offsets: list[tuple[int, int]], mask: np.ndarray) -> list[tuple[int, int]]:
    """The character spans under runs of masked tokens."""
    turn = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
    return [(offsets[a][0], offsets[b - 1][1]) for a, b in turn.tolist()]


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", loss_roles: tuple[str, ...] = ("assistant",), path: str | None = None) -> DataFrame:
    """One row per conversation: conv_col, n_turns, formatted, ids (little-endian unsigned 32-bit), loss_mask (a byte per token), loss_spans.

    loss_spans are read off the mask and the tokens' offsets: [start, end) code
    points of ``formatted``.  Null roles and texts count as empty; a row
    without a conversation is one of its own, with null in conv_col; ties in
    the turn go by role, then text; repeated rows are turns each.  Other
    columns are ignored.  An empty table gives an empty result.  A
    conversation is one row, so it must fit a task; conversations are
    streamed, not collected.
    """
    spark = turns.sparkSession
    path = path or tokenizer_path()
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    alone = F.when(F.col("conv").isNull(), F.xxhash64("turn", "role", "text"))
    rows = rows.repartition(prepared_tasks(spark), "conv", alone).sortWithinPartitions("conv", "turn", "role", "text").select("conv", "role", "text")
    kind = turns.schema[conv_col].dataType.simpleString()

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = chat_tokenizer(path)
        spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        schema = None

        def out(done):
            texts = [rendered(t, loss_roles) for _, t in done]
            columns = [[], [], []]
            for (text, spans), e in zip(texts, tokenizer.encode_batch([t for t, _ in texts], add_special_tokens=False)):
                mask = masked(e.offsets, spans)
                columns[0].append(np.array(e.ids, np.uint32).tobytes()), columns[1].append(mask.tobytes())
                columns[2].append([{"start": a, "end": b} for a, b in mask_spans(e.offsets, mask)])
            return pa.record_batch([pa.array([c for c, _ in done], schema), pa.array([len(t) for _, t in done], pa.int64()), pa.array([t for t, _ in texts], pa.string()), pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.binary()), pa.array(columns[2], spans_type)], ["conv", "n_turns", "formatted", "ids", "loss_mask", "loss_spans"])

        conv, own, done, size, any_ = None, [], [], 0, False
        for batch in batches:
            schema = batch.schema.field(0).type
            for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if any_ and (c is None or c != conv):
                    done.append((conv, own))
                    own = []
                    if size > 1 << 20:
                        yield out(done)
                        done, size = [], 0
                conv, any_ = c, True
                own.append((role, text))
                size += len(text)
        if any_:
            yield out([*done, (conv, own)])

    out = rows.mapInArrow(formatted, f"conv {kind}, n_turns long, formatted string, ids binary, loss_mask binary, loss_spans array<struct<start:int,end:int>>")
    return out.withColumnRenamed("conv", conv_col)
