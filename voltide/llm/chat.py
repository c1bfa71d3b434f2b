"""Chat formatting on token level.

A turn is ``<|turn|> role <|text|> text <|end|>``. The three marks are reserved ids above the vocabulary that no text can
produce; role and text are encoded on their own, so no token spans a border. The loss mask of a row of tokens is the prefix
sum of +1 where an assistant's text begins and -1 where it ends; a turn's place in its conversation is the prefix sum of
turn lengths.

Control strings of common templates that occur in roles or texts are escaped: a backslash goes behind their first
character, one more where backslashes stand there already, so that ``unescape`` gives back every text.

Conversations are sorted by range of (conversation, turn), so one with very many turns lies in several tasks. Places are
summed within a task first; what earlier tasks hold of a conversation is carried in by a join of one row per
conversation and task. ``digests`` reads a conversation as a stream: the hash over all its turns needs them in order, but
only one batch is in memory.

Rows are ordered by turn, then role, then text; missing values come first. A null text or role is empty. Rows
without a conversation id form one conversation. Repeated rows are turns of their own. Other columns are not read. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltide.llm.encoding import encoder
from voltide.session import stage

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNED = "assistant"
# Control strings of common chat templates, behind their first character.
_REST = r"\|\w{1,40}\|>|/?s>|<SYS>>|</SYS>>|/?INST\]|(?:unk|pad|bos|eos|mask)>|(?:start|end)_of_turn>|/?think>"
_ESCAPE = re.compile(rf"([<\[])(\\*)(?={_REST})")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)(?={_REST})")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def reserved(n_ranks: int) -> tuple[int, int, int]:
    """Ids of the three marks; the first id above the ranks is left to the vocabulary's own end mark."""
    return n_ranks + 1, n_ranks + 2, n_ranks + 3


def assemble_turn(role: str, text: str, encode, marks: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, mask) of one turn."""
    parts = [
        np.asarray(marks[:1], "<u4"),
        np.frombuffer(encode(escape(role)), "<u4"),
        np.asarray(marks[1:2], "<u4"),
        np.frombuffer(encode(escape(text)), "<u4"),
        np.asarray(marks[2:], "<u4"),
    ]
    borders = np.cumsum([len(part) for part in parts])
    change = np.zeros(borders[-1] + 1, np.int8)
    if role == LEARNED:
        change[borders[2]] += 1
        change[borders[3]] -= 1
    return np.concatenate(parts), np.cumsum(change[:-1], dtype=np.int8)


def assemble(conversations: DataFrame, ranks_path: str) -> DataFrame:
    """A row per turn: conv_id, turn_no, first_token (its place in the conversation), ids, loss_mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part = encoder(ranks_path), TaskContext.get().partitionId()
        marks = reserved(codec.codec.max_token_value + 1)
        current, number, place = object(), 0, 0
        for batch in batches:
            rows = []
            for conv, role, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if conv != current:
                    current, number, place = conv, 0, 0
                ids, mask = assemble_turn(role or "", text or "", codec.encode, marks)
                rows.append((conv, part, number, place, len(ids), ids.astype("<i4"), mask))
                number, place = number + 1, place + len(ids)
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in kinds])

    kinds = [
        ("conv_id", pa.int64()), ("part", pa.int32()), ("number", pa.int64()), ("place", pa.int64()),
        ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.int8())),
    ]
    schema = "conv_id long, part int, number long, place long, n_tokens long, ids array<int>, loss_mask array<byte>"
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("head", F.substring("text", 1, 64))
    keys = ["conv_id", "turn", "role", "head"]  # the head of a text keeps the order of texts
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys, "text")
    turns = stage(placed.select("conv_id", "role", "text").mapInArrow(run, schema), "turns")
    before = Window.partitionBy("conv").orderBy("in_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        turns.groupBy(F.col("conv_id").alias("conv"), F.col("part").alias("in_part"))
        .agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))
        .select(
            "conv",
            "in_part",
            F.sum("tokens").over(before).alias("tokens_before"),
            F.sum("n").over(before).alias("turns_before"),
        )
        .filter("turns_before is not null")  # only conversations that an earlier task has begun
    )
    same = turns["conv_id"].eqNullSafe(carried["conv"]) & (turns["part"] == carried["in_part"])
    return turns.join(carried, same, "left").select(
        "conv_id",
        (F.col("number") + F.coalesce("turns_before", F.lit(0))).alias("turn_no"),
        (F.col("place") + F.coalesce("tokens_before", F.lit(0))).alias("first_token"),
        "ids",
        "loss_mask",
    )


def read_turn(ids: np.ndarray, codec, marks: tuple[int, int, int]) -> tuple[str, str]:
    """(role, text) as they were before escaping, from the ids of one turn."""
    borders = [int(np.flatnonzero(ids == mark)[0]) for mark in marks]
    if borders[0] != 0 or borders[2] != len(ids) - 1:
        raise ValueError("a turn must begin and end with its marks")
    role, text = (ids[a + 1 : b].tolist() for a, b in zip(borders, borders[1:]))
    return tuple(unescape(codec.codec.decode_bytes(part).decode()) for part in (role, text))


def formatted(ids: np.ndarray, codec, marks: tuple[int, int, int]) -> str:
    """The turn as text, marks written out."""
    role_at, text_at = (int(np.flatnonzero(ids == mark)[0]) for mark in marks[1:])
    role, text = ids[1:role_at].tolist(), ids[role_at + 1 : text_at].tolist()
    return TURN + codec.codec.decode_bytes(role).decode() + TEXT + codec.codec.decode_bytes(text).decode() + END


def digests(turns: DataFrame, ranks_path: str) -> DataFrame:
    """Per conversation, from the tokens alone: turns, their digest, the text under the mask, formatted characters."""

    class Open:
        def __init__(self, conv):
            self.conv, self.n, self.loss_chars, self.chars = conv, 0, 0, 0
            self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

        def add(self, ids, mask, codec, marks) -> None:
            role, text = read_turn(ids, codec, marks)
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            self.chars += len(formatted(ids, codec, marks))
            under = unescape(codec.codec.decode_bytes(ids[mask == 1].tolist()).decode())
            self.loss_chars += len(under)
            self.loss.update(under.encode())

        def row(self) -> tuple:
            return self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(ranks_path)
        marks, open_one = reserved(codec.codec.max_token_value + 1), None
        for batch in batches:
            done = []
            for conv, ids, mask in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                if open_one is None or conv != open_one.conv:
                    if open_one is not None:
                        done.append(open_one.row())
                    open_one = Open(conv)
                open_one.add(np.asarray(ids.values), np.asarray(mask.values), codec, marks)
            if done:
                yield as_batch(done)
        if open_one is not None:
            yield as_batch([open_one.row()])

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(zip(*rows, strict=True), kinds, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in columns], names=[n for n, _ in kinds])

    number, text = pa.int64(), pa.string()
    kinds = [
        ("conv_id", number), ("n_turns", number), ("turns_sha256", text), ("loss_chars", number),
        ("loss_sha256", text), ("formatted_chars", number),
    ]
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn_no")
    return ordered.select("conv_id", "ids", "loss_mask").mapInArrow(run, schema)
