"""Packing documents into token sequences: dominance reduction, then best fit."""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterlake.llm.common import fresh, joined_by_row
from meterlake.llm.word_ids import word_ids
from meterlake.session import stored

SEQUENCE = 2048
END_ID = 0

_PIECE = "piece int, start long, length long, ids_crc32 long, ids binary"


def pieces_of(ids: bytes, size: int) -> Iterator[tuple[int, int, bytes]]:
    """Cut a document's ids into (piece, start, ids) of at most `size` ids."""
    for piece, start in enumerate(range(0, len(ids) // 4, size)):
        yield piece, start, ids[start * 4 : (start + size) * 4]


def tokenized(
    docs: DataFrame, keep: list[str], tokenizer: str, size: int, with_ids: bool
) -> tuple[DataFrame, str, str]:
    """Pieces of each document: `keep`, piece, start, length, ids_crc32, ids, and the
    task that made them with the piece's number among those of its length there; also
    the names of these last two columns.
    """
    text, task_name, place_name = (fresh(docs, n) for n in ("text", "task", "place"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer)
        task = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            for first, found, bounds in encoder.encode(batch.column(0)):
                data, ends = found.tobytes(), (bounds * 4).tolist()
                rows: list[tuple] = []
                for at, (a, b) in enumerate(zip(ends, ends[1:], strict=False), first):
                    for piece, start, part in pieces_of(data[a:b] + end, size):
                        length = len(part) // 4
                        rows.append(
                            (at, piece, start, length, zlib.crc32(part),
                             part if with_ids else None, task, seen[length])
                        )
                        seen[length] += 1
                at, *rest = zip(*rows, strict=True)
                kept = [c.take(pa.array(at)) for c in batch.columns[1:]]
                made = [pa.array(x, f.type) for x, f in zip(rest, made_types, strict=True)]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=names)

    made_types = [
        pa.field(n, t)
        for n, t in (
            ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
            ("ids_crc32", pa.int64()), ("ids", pa.binary()), (task_name, pa.int32()),
            (place_name, pa.int64()),
        )
    ]
    names = [*keep, *(f.name for f in made_types)]
    kept = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    made = docs.select(F.col("text").cast("string").alias(text), *keep).mapInArrow(
        cut, f"{kept}{_PIECE}, `{task_name}` int, `{place_name}` long"
    )
    return made, task_name, place_name


# --- the plan: how many sequences hold which lengths ---------------------------------

Pattern = tuple[tuple[int, int], ...]  # (length, how often) within one sequence


def reduce_by_dominance(counts: dict[int, int], size: int) -> list[tuple[Pattern, int]]:
    """Fix sets that dominate all others with one of their pieces; shrink `counts`.

    A set with piece a dominates every feasible set with a if the others' pieces can
    be parted so that each part fits in the place of one of its own pieces: then some
    best solution has it. For every length a with rest r, largest first, fix {a} if
    nothing fits in r, and {a, b} with b the largest piece that fits, if
      - b fills r, or
      - no two pieces fit in r, or
      - two fit but not three, and no two that fit are longer together than b.
    Fixing some makes others possible, so this goes on until nothing changes.
    """
    fixed: list[tuple[Pattern, int]] = []
    changed = True
    while changed:
        changed = False
        for a in sorted(counts, reverse=True):
            while counts.get(a):
                b = _dominating_partner(counts, a, size - a)
                if b is None:
                    break
                changed = True
                if b == 0:
                    fixed.append((((a, 1),), counts.pop(a)))
                elif b == a:
                    fixed.append((((a, 2),), counts[a] // 2))
                    _take(counts, a, counts[a] // 2 * 2)
                else:
                    n = min(counts[a], counts[b])
                    fixed.append((((a, 1), (b, 1)), n))
                    _take(counts, a, n)
                    _take(counts, b, n)
    return fixed


def _take(counts: dict[int, int], length: int, n: int) -> None:
    counts[length] -= n
    if not counts[length]:
        del counts[length]


def _dominating_partner(counts: dict[int, int], a: int, rest: int) -> int | None:
    """The one piece to put with `a`; 0 if `a` stays alone, None if nothing dominates."""

    def left(length: int) -> int:
        return counts.get(length, 0) - (length == a)

    fit = sorted(x for x in counts if x <= rest and left(x))
    if not fit:
        return 0
    b = fit[-1]
    if b == rest:
        return b
    smallest: list[int] = []
    for x in fit:
        smallest += [x] * min(left(x), 3 - len(smallest))
        if len(smallest) == 3:
            break
    if len(smallest) < 2 or sum(smallest[:2]) > rest:
        return b
    if len(smallest) == 3 and sum(smallest) <= rest:
        return None
    best = 0
    for x in fit:
        k = bisect_right(fit, min(rest - x, x)) - 1
        if k >= 0 and fit[k] == x and left(x) < 2:
            k -= 1
        if k >= 0:
            best = max(best, x + fit[k])
    return b if best <= b else None


def best_fit(counts: dict[int, int], size: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on lengths with counts; equal sequences are one entry.

    A sequence with the least room that still takes the length is filled with it until
    it takes no more; then the next, then new ones. A length parts at most one entry,
    so entries stay fewer than twice the lengths, however many pieces there are.
    """
    rooms: list[int] = []
    open_: dict[int, list[tuple[Pattern, int]]] = {}
    done: list[tuple[Pattern, int]] = []

    def put(room: int, pattern: Pattern, n: int) -> None:
        if not n:
            return
        if not room:
            done.append((pattern, n))
            return
        if room not in open_:
            rooms.insert(bisect_left(rooms, room), room)
            open_[room] = []
        open_[room].append((pattern, n))

    def fill(room: int, pattern: Pattern, n: int, a: int, pieces: int) -> int:
        """Fill up to `n` equal sequences; the pieces that are over."""
        each = room // a
        full = min(n, pieces // each)
        put(room - each * a, (*pattern, (a, each)), full)
        pieces -= full * each
        n -= full
        if n and 0 < pieces < each:
            put(room - pieces * a, (*pattern, (a, pieces)), 1)
            pieces, n = 0, n - 1
        put(room, pattern, n)
        return pieces

    for a in sorted(counts, reverse=True):
        pieces = counts[a]
        at = bisect_left(rooms, a)
        for room in rooms[at:]:
            if not pieces:
                break
            del rooms[bisect_left(rooms, room)]
            for pattern, n in open_.pop(room):
                if pieces:
                    pieces = fill(room, pattern, n, a, pieces)
                else:
                    put(room, pattern, n)
        if pieces:
            each = size // a
            fill(size, (), -(-pieces // each), a, pieces)
    return done + [entry for entries in open_.values() for entry in entries]


def plan(counts: dict[int, int], size: int) -> list[tuple[Pattern, int]]:
    """(pattern, number of sequences) that take every piece of `counts` once."""
    counts = {length: n for length, n in counts.items() if n}
    fixed = reduce_by_dominance(counts, size)
    return fixed + best_fit(counts, size)


def slots(entries: list[tuple[Pattern, int]]) -> np.ndarray:
    """Where the pieces of each length go, in the order of their numbers.

    Rows of (length, first number, number after the last, times in a sequence, first
    sequence, offset). Those of a length follow one another without gaps.
    """
    rows, used, sequence = [], Counter(), 0
    for pattern, n in entries:
        offset = 0
        for length, times in pattern:
            first = used[length]
            used[length] += times * n
            rows.append((length, first, used[length], times, sequence, offset))
            offset += length * times
        sequence += n
    return np.array(rows, dtype=np.int64).reshape(-1, 6)


def pack(
    docs: DataFrame,
    tokenizer: str,
    keep: list[str],
    size: int = SEQUENCE,
    with_ids: bool = False,
) -> DataFrame:
    """Rows of packed pieces: `keep`, piece, start, length, ids_crc32, sequence_id,
    offset, and ids (little-endian 32-bit numbers) if asked for.

    `docs` is a stored table with a column text; `keep` names columns of it, other
    than those above. Strings of the tokenizer's special tokens in a text are those
    tokens, as in its default call. A null text is empty and gives the end id alone; a document of
    more than `size` ids is cut, and only then. Repeated rows are packed each. An empty
    table gives no rows. Which of equally long pieces goes where follows from the order
    of reading.

    All that is planned with, and sent to the driver, is how many pieces there are of
    each of the `size` lengths. Pieces are numbered within (task, length), and the
    numbers of the tasks added up, so no length's pieces ever meet in one task. A piece
    gets its place by a join with the plan, so no ids go back to a Python worker.
    """
    spark = docs.sparkSession
    pieces, task, place = tokenized(docs, keep, tokenizer, size, with_ids)
    made = stored(pieces, "pieces")
    per_task = stored(made.groupBy(task, "length").agg(F.count("*").alias("n")), "lengths")
    counts = {
        r["length"]: r["n"]
        for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    before = Window.partitionBy("length").orderBy(task).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ahead, number = fresh(docs, "ahead"), fresh(docs, "number")
    offsets = stored(
        per_task.select(
            task, "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias(ahead)
        ),
        "ahead",
    )
    numbered = joined_by_row(made, offsets, [task, "length"]).withColumn(
        number, F.col(place) + F.col(ahead)
    )

    columns = [fresh(docs, n) for n in ("of", "first", "until", "times", "sequence", "at")]
    of, first, until, times, sequence, at = columns
    planned = spark.createDataFrame(pa.table(list(slots(plan(counts, size)).T), names=columns))
    placed = numbered.join(
        F.broadcast(planned),
        (F.col("length") == F.col(of))
        & (F.col(number) >= F.col(first))
        & (F.col(number) < F.col(until)),
    )
    nth = f"(`{number}` - `{first}`)"
    return placed.select(
        *keep, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids,
        F.expr(f"`{sequence}` + {nth} div `{times}`").alias("sequence_id"),
        F.expr(f"`{at}` + {nth} % `{times}` * length").alias("offset"),
    )
