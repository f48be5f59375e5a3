"""Packing by concatenation: all ids in one line, cut into windows of equal length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType
from pyspark.sql.window import Window

from meterlake.llm.common import fresh, joined_by_row
from meterlake.llm.word_ids import word_ids
from meterlake.session import stored

WINDOW = 4096
END_ID = 2
# Prefix sums over the tasks are taken within groups of this many, and over the groups.
TASKS_A_GROUP = 4096
# Ids below this are kept in two bytes.
NARROW = 1 << 16

_MADE = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _tokens(docs: DataFrame, text: str, names: dict[str, str], tokenizer: str, end: int) -> DataFrame:
    """Each document's ids and end id, how many they are, the task that made them, and
    how many ids that task had made before.
    """
    kept = [c for c in docs.columns if c != text]
    schema = StructType([docs.schema[c] for c in kept])
    schema.add(names["ids"], BinaryType()).add(names["tokens"], LongType())
    schema.add(names["task"], LongType()).add(names["before"], LongType())

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer)
        kind = "<u2" if max(encoder.size, end + 1) <= NARROW else "<u4"
        last = np.array([end], dtype=kind).tobytes()
        task = TaskContext.get().partitionId()
        before = 0
        for batch in batches:
            for first, ids, bounds in encoder.encode(batch.column(0)):
                data, width = ids.astype(kind).tobytes(), np.dtype(kind).itemsize
                at = (bounds * width).tolist()
                n = np.diff(bounds) + 1
                some = batch.slice(first, len(n))
                blobs = [data[a:b] + last for a, b in zip(at, at[1:], strict=False)]
                ahead = before + np.cumsum(n) - n
                before += int(n.sum())
                arrays = [
                    *some.columns[1:], pa.array(blobs, pa.binary()), pa.array(n),
                    pa.array(np.full(len(n), task)), pa.array(ahead),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return docs.select(text, *kept).mapInArrow(made, schema)


def task_offsets(totals: DataFrame, task: str, total: str, ahead: str) -> DataFrame:
    """`task` and how many ids all tasks before it have, from the sum `total` of each.

    Sums run within groups of tasks, then over the groups' totals, so the one task that
    sees all groups reads a row for every `TASKS_A_GROUP` tasks.
    """
    grouped = totals.withColumn("group", F.expr(f"`{task}` div {TASKS_A_GROUP}"))
    earlier = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = grouped.groupBy("group").agg(F.sum(total).alias("sum")).select(
        "group", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("earlier")
    )
    within = Window.partitionBy("group").orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    summed = grouped.withColumn("within", F.coalesce(F.sum(total).over(within), F.lit(0)))
    return summed.join(groups, "group").select(
        task, (F.col("earlier") + F.col("within")).alias(ahead)
    )


def windows_of_rest(rest: int) -> list[int]:
    """Lengths of the windows for the ids left over: the powers of two that add up to it."""
    return [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


class Windows:
    """Fixed windows over a line of `total` ids, and those that end it.

    All but the last few are `size` long. What is left over is cut into windows whose
    lengths are powers of two, which need no padding; `whole_rest` leaves it in one.
    """

    def __init__(self, total: int, size: int, whole_rest: bool):
        self.size, self.full = size, total // size
        rest = total % size
        lengths = ([rest] if rest else []) if whole_rest else windows_of_rest(rest)
        self.starts = self.full * size + np.cumsum([0, *lengths])

    def number(self, place: np.ndarray) -> np.ndarray:
        """The window that holds each place of the line."""
        last = self.full + np.searchsorted(self.starts, place, side="right") - 1
        return np.where(place < self.starts[0], place // self.size, last)

    def start(self, number: np.ndarray) -> np.ndarray:
        """The place where each window starts; of the one after the last, where all ends."""
        last = self.starts[np.clip(number - self.full, 0, len(self.starts) - 1)]
        return np.where(number < self.full, number * self.size, last)


def _cut(batch: pa.RecordBatch, windows: Windows, with_ids: bool) -> pa.RecordBatch:
    """The pieces of documents given with their ids, number of ids and place in the line."""
    blobs, tokens, place = batch.column(0), *(c.to_numpy() for c in batch.columns[1:3])
    first, last = windows.number(place), windows.number(place + tokens - 1)
    n = last - first + 1
    doc = np.repeat(np.arange(len(n)), n)
    sequence = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    opens = windows.start(sequence)
    begin = np.maximum(opens, place[doc])
    end = np.minimum(windows.start(sequence + 1), (place + tokens)[doc])
    start = begin - place[doc]
    checks, parts, held, data = [], [], -1, b""
    for i, a, b in zip(doc.tolist(), start.tolist(), (end - place[doc]).tolist(), strict=True):
        if i != held:
            held, data = i, blobs[i].as_buffer()
            width = len(data) // int(tokens[i])
            data = np.frombuffer(data, dtype=f"<u{width}").astype("<u4", copy=False)
        part = data[a:b].tobytes()
        checks.append(zlib.crc32(part))
        if with_ids:
            parts.append(part)
    made = [
        pa.array(start), pa.array(end - begin), pa.array(checks, pa.int64()),
        pa.array(tokens[doc]), pa.array(sequence), pa.array(begin - opens),
    ]
    if with_ids:
        made.append(pa.array(parts, pa.binary()))
    kept = [c.take(pa.array(doc)) for c in batch.columns[3:]]
    names = [*batch.schema.names[3:], *_MADE, *["ids"] * with_ids]
    return pa.RecordBatch.from_arrays([*kept, *made], names=names)


def concat_and_cut(
    docs: DataFrame,
    tokenizer: str,
    keep: list[str],
    size: int = WINDOW,
    end_id: int = END_ID,
    with_ids: bool = False,
    whole_rest: bool = False,
) -> DataFrame:
    """Pieces of documents: `keep`, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, and ids (little-endian 32-bit numbers) if asked for.

    `docs` is a stored table with a column text; `keep` names columns of it, other than
    those above. Each document's ids and `end_id` follow those of the one read before;
    this line is cut every `size` ids, wherever that is, and a document that lies across
    a cut has a piece on either side. Only the rest at the end is shorter: it is cut into
    powers of two, or left as it is with `whole_rest`. A null or empty text gives the end
    id alone. Repeated rows are packed each. An empty table gives no rows.

    The first pass writes each document's ids and its place among those of its task; the
    tasks' totals, added up, tell where each task's ids start; the second pass cuts. No
    document meets another, and what is summed is a row for each task.
    """
    names = {n: fresh(docs, n) for n in ("text", "ids", "tokens", "task", "before", "ahead")}
    ids, tokens, task, before, ahead = (
        names[n] for n in ("ids", "tokens", "task", "before", "ahead")
    )
    text = F.col("text").cast("string").alias(names["text"])
    made = stored(
        _tokens(docs.select(text, *keep), names["text"], names, tokenizer, end_id), "tokens"
    )
    totals = stored(made.groupBy(task).agg(F.sum(tokens).alias("total")), "totals")
    total = totals.agg(F.sum("total")).first()[0] or 0
    windows = Windows(total, size, whole_rest)
    offsets = stored(task_offsets(totals, task, "total", ahead), "offsets")
    line = joined_by_row(made, offsets, task).select(
        ids, tokens, (F.col(before) + F.col(ahead)).alias(before), *keep
    )
    schema = StructType([docs.schema[c] for c in keep])
    for name in _MADE:
        schema.add(StructField(name, LongType()))
    if with_ids:
        schema.add("ids", BinaryType())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _cut(batch, windows, with_ids)

    return line.mapInArrow(cut, schema)
