"""Exact top-k search by inner product over impact-ordered posting segments."""

from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType
from pyspark.sql.window import Window

from meterlake.llm.common import numbered
from meterlake.session import stored

SCALE = 1024
BLOCK_VECTORS = 8192
GROUP_QUERIES = 16_384
BATCH_QUERIES = 64
# A posting keeps so many bits of its component.
IMPACT_BITS = 8
# A query stops as soon as no more vectors than this can still be among its best.
FEW = 64
# Whole numbers below this are 64-bit ones with room for a sum.
_SAFE = 1 << 62
_DIGITS = 10**38


def taking_part(vector: str) -> Column:
    """Whether all components are there and finite."""
    return F.col(vector).isNotNull() & F.forall(
        F.col(vector), lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float("inf"))
    )


def scaled(rows: list[np.ndarray], width: int) -> np.ndarray:
    """floor(1024 * x) of each component, exactly, as 64-bit numbers or, if one needs
    more, as Python's. Shorter vectors go on with zeros.
    """
    x = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        x[i, : len(row)] = row
    if np.abs(x).max(initial=0) < _SAFE // SCALE:
        return np.floor(x * SCALE).astype(np.int64)
    # what is too large to be multiplied is a whole number
    whole = [
        [math.floor(v * SCALE) if abs(v) < 2.0**900 else int(v) * SCALE for v in row]
        for row in x.tolist()
    ]
    return np.array(whole, dtype=object).reshape(len(rows), width)


def _largest(numbers: np.ndarray) -> int:
    return max(abs(int(numbers.max(initial=0))), abs(int(numbers.min(initial=0))))


def _approximate(numbers: np.ndarray) -> np.ndarray:
    """The numbers over a power of two that brings the largest one near to 1."""
    over = _largest(numbers).bit_length()
    if numbers.dtype == object:
        cut = max(0, over - 900)
        numbers, over = np.array([[float(v >> cut) for v in row] for row in numbers]), over - cut
    return np.ldexp(numbers.astype(np.float64).reshape(numbers.shape), -over)


def inner_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products of whole vectors with a query."""
    if vectors.dtype != object and query.dtype != object:
        if _largest(vectors) * _largest(query) * max(1, len(query)) < _SAFE:
            return vectors @ query
    return (vectors.astype(object) * query.astype(object)).sum(axis=1) if len(query) else (
        np.zeros(len(vectors), dtype=np.int64)
    )


class ImpactIndex:
    """Postings of a block of vectors, in segments of falling impact.

    A posting is a component of a vector that is not zero: the vector's place and the
    component's leading bits. The postings of a dimension are parted by the power of two
    that their size is below; such a segment's impact on a query is that power times the
    query's weight there. Segments of all dimensions are taken by falling impact, each for
    a batch of queries. What the segments not yet taken can add to a score is known for
    each dimension, by its next segment: when no more than a few vectors can still be
    among a query's best, these are scored exactly.
    """

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        self.vectors, self.ids, self.rows = vectors, ids, rows
        self.width = vectors.shape[1]
        mantissa, power = np.frexp(_approximate(vectors))
        kept = np.trunc(np.ldexp(mantissa, IMPACT_BITS))
        impact = np.ldexp(kept + np.copysign(0.5, kept), power - IMPACT_BITS)
        self.places: list[np.ndarray] = []
        self.impacts: list[np.ndarray] = []
        dimension, size, then = [], [], []
        self.top = np.zeros(self.width)
        for j in range(self.width):
            there = np.flatnonzero(mantissa[:, j])
            if not len(there):
                continue
            order = there[np.argsort(-power[there, j], kind="stable")]
            cuts = np.flatnonzero(np.diff(power[order, j])) + 1
            segments = np.split(order, cuts)
            sizes = [math.ldexp(1.0, int(power[s[0], j])) for s in segments]
            self.top[j] = sizes[0]
            self.places += segments
            self.impacts += [impact[s, j] for s in segments]
            dimension += [j] * len(segments)
            size += sizes
            then += [*sizes[1:], 0.0]
        self.dimension = np.array(dimension, dtype=np.int64)
        self.size, self.then = np.array(size), np.array(then)

    def members(self, queries: np.ndarray, query_rows: np.ndarray, k: int) -> list[np.ndarray]:
        """Of each query, the places of the vectors that can be among its best `k`."""
        n = len(self.ids)
        weight = _approximate(queries)
        heavy = np.abs(weight)
        active = np.arange(len(queries))
        known = np.zeros((n, len(queries)))
        own = self.rows[:, None] == query_rows[None, :]
        # rounding of what is kept of a component, and of the sums
        doubt = heavy @ self.top * 2.0**-IMPACT_BITS + 1e-12 * (heavy.sum(axis=1) + 1e-300)
        rest = heavy @ self.top
        found: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(queries)
        strongest = heavy.max(axis=0, initial=0)[self.dimension] * self.size
        order = np.argsort(-strongest, kind="stable")
        checked = strongest[order[0]] if len(order) else 0.0
        for step, s in enumerate([*order, -1]):
            last = step == len(order)
            if not last:
                j = self.dimension[s]
                known[self.places[s]] += np.outer(self.impacts[s], weight[active, j])
                rest -= heavy[active, j] * (self.size[s] - self.then[s])
                if strongest[s] > checked / 2:
                    continue
                checked = strongest[s]
            bound = doubt[active] + (0.0 if last else np.maximum(rest, 0.0))
            score = np.where(own[:, active], -np.inf, known)
            if n > k:
                # only what reaches this can be among the best k: that is the proof
                limit = np.partition(score, n - k, axis=0)[n - k] - 2 * bound
            else:
                limit = np.full(len(active), -np.inf)
            possible = (score >= limit) & ~own[:, active]
            ended = last | (possible.sum(axis=0) <= max(FEW, k))
            for q in np.flatnonzero(ended):
                found[active[q]] = np.flatnonzero(possible[:, q])
            active, known, rest = active[~ended], known[:, ~ended], rest[~ended]
            if not len(active):
                break
        return found

    def best(
        self, queries: np.ndarray, query_rows: np.ndarray, k: int
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """(places, exact scores) of each query's `k` best, ties to the smaller id."""
        found = []
        for q, at in enumerate(self.members(queries, query_rows, k)):
            score = inner_products(self.vectors[at], queries[q])
            order = sorted(
                range(len(at)), key=lambda i: (-score[i], self.ids[at[i]], self.rows[at[i]])
            )[:k]
            found.append((at[order], score[order]))
        return found


def ordered(score: int) -> bytes:
    """Bytes that sort as the whole numbers they stand for, of any size."""
    data = abs(score).to_bytes((abs(score).bit_length() + 7) // 8, "big")
    data = len(data).to_bytes(4, "big") + data
    return b"\x01" + data if score >= 0 else b"\x00" + bytes(255 - b for b in data)


_FOUND = pa.schema(
    [("query_row", pa.int64()), ("query_id", pa.int64()), ("row", pa.int64()),
     ("vec_id", pa.int64()), ("score", pa.decimal128(38, 0)), ("order", pa.binary())]
)


def _searched(k: int):
    def of(block: pa.Table, queries: pa.Table) -> pa.Table:
        made: list[tuple] = []
        if len(block) and len(queries):
            read = [[np.array(v) for v in t.column("x").to_pylist()] for t in (block, queries)]
            width = max(len(v) for rows in read for v in rows)
            ids, rows = (block.column(c).to_numpy() for c in ("vec_id", "row"))
            index = ImpactIndex(scaled(read[0], width), ids, rows)
            query_ids, query_rows = (queries.column(c).to_numpy() for c in ("vec_id", "row"))
            for a in range(0, len(queries), BATCH_QUERIES):
                b = a + BATCH_QUERIES
                asked = scaled(read[1][a:b], width)
                for q, (at, scores) in enumerate(index.best(asked, query_rows[a:b], k), a):
                    for i, score in zip(at.tolist(), scores.tolist(), strict=True):
                        shown = Decimal(score) if abs(score) < _DIGITS else None
                        made.append(
                            (query_rows[q], query_ids[q], rows[i], ids[i], shown, ordered(score))
                        )
        columns = list(zip(*made, strict=True)) or [()] * len(_FOUND)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, _FOUND, strict=True)]
        return pa.Table.from_arrays(arrays, schema=_FOUND)

    return of


def top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row its `k` highest inner products.

    `vectors` is a stored table with vec_id and embedding; `is_query`, a condition on
    vec_id, says which rows are queries. Candidates are all rows but the query's own,
    copies of it too. A row takes no part if its vec_id or vector is null, or a component
    is null or not finite; components may have any size. A shorter vector goes on with
    zeros. Ties go to the smaller vec_id, then to the row read first. Repeated query rows
    are answered each; an empty table gives no rows. Other columns are not read. A score
    is a whole decimal, null beyond 38 digits (its rank is exact all the same).

    Queries meet the vectors in blocks of both: a block is indexed once for up to
    `GROUP_QUERIES` queries and sends each query's best k on.
    """
    narrow = vectors.schema["embedding"].dataType == ArrayType(FloatType(), True)
    x = F.col("embedding").cast("array<float>" if narrow else "array<double>")
    ready = stored(
        numbered(vectors.select("vec_id", x.alias("x")), "row")
        .where(F.col("vec_id").isNotNull() & taking_part("x"))
        .withColumn("asks", is_query),
        "vectors",
    )
    n, asked = ready.agg(F.count("*"), F.count_if("asks")).first()
    blocks, groups = max(1, -(-n // BLOCK_VECTORS)), max(1, -(-asked // GROUP_QUERIES))
    spread = F.xxhash64("row")

    def copies(count: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)

    columns = ["row", "vec_id", "x"]
    index = ready.select(
        *columns, F.pmod(spread, F.lit(blocks)).cast("int").alias("block"), copies(groups, "part")
    )
    queries = ready.where("asks").select(
        *columns, copies(blocks, "block"), F.pmod(spread, F.lit(groups)).cast("int").alias("part")
    )
    keys = ["block", "part"]
    found = (
        index.groupBy(*keys)
        .cogroup(queries.groupBy(*keys))
        .applyInArrow(
            _searched(k),
            "query_row long, query_id long, row long, vec_id long, score decimal(38,0), order binary",
        )
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("order"), "vec_id", "row")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
