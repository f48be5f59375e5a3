"""Whitening of embeddings by the principal components of their distinct values."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, LongType, StructType

from meterlake.llm.common import fresh
from meterlake.llm.eigen import leading
from meterlake.session import stored

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
# A component of less variance than this, against the first one's, is rounding error.
LEAST = 1e-11
# Below this, differences of two whole numbers are themselves 64-bit numbers.
_SAFE = 1 << 61
_LONG = float(2**63 - 2**21)
_DIGITS = 10**38


def scaled(vector: str) -> Column:
    """floor(64 * c) + 1000000 of each entry; null for a vector that takes no part."""
    entries = F.transform(F.col(vector), lambda c: c.cast("double") * SCALE)
    # also false for NaN, which is greater than any number here
    fine = F.forall(entries, lambda c: c.isNotNull() & (F.abs(c) < _LONG))
    return F.when(fine, F.transform(entries, lambda c: F.floor(c) + OFFSET))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass(frozen=True)
class Centre:
    """Number of fitted vectors and the exact sums of their entries."""

    n: int
    sums: tuple[int, ...]

    def whole(self) -> list[int]:
        return [s // self.n for s in self.sums]

    def rest(self) -> list[int]:
        return [s % self.n for s in self.sums]

    def apart(self, x: np.ndarray) -> np.ndarray | None:
        """x less the whole part of the mean, exactly; None if that is beyond 64 bits."""
        middle = self.whole()
        far = max((abs(m) for m in middle), default=0)
        if max(far, abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) >= _SAFE:
            return None
        return x - np.array(middle, dtype=np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, as doubles: what is subtracted first loses nothing."""
        apart = self.apart(x)
        if apart is None:
            return x.astype(np.float64) - np.array([s / self.n for s in self.sums])
        return apart - np.array([r / self.n for r in self.rest()])

    def deviations(self, x: np.ndarray) -> list[int]:
        """The sum over the entries of (n * x - S)^2 of each row, exactly.

        With z = x less the mean's whole part and r the rest, that is
        n^2 * sum z^2 - 2 * n * sum r * z + sum r^2, whose sums fit 64 bits as a rule.
        """
        n, rest = self.n, self.rest()
        z = self.apart(x)
        big = None if z is None else max(abs(int(z.min(initial=0))), abs(int(z.max(initial=0))))
        if big is None or big * max(big, n) * max(1, x.shape[1]) >= 1 << 62:
            z = x.astype(object) - np.array(self.whole(), dtype=object)
            r = np.array(rest, dtype=object)
        else:
            r = np.array(rest, dtype=np.int64)
        squares, mixed = (z * z).sum(axis=1).tolist(), (z * r).sum(axis=1).tolist()
        last = sum(r * r for r in rest)
        return [n * n * a - 2 * n * b + last for a, b in zip(squares, mixed, strict=True)]


def _centre(fitted: DataFrame, width: int) -> Centre:
    """Number of rows of `fitted` and the sum of each entry of x."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        # upper and lower halves apart: neither sum leaves 64 bits
        halves = np.zeros((2, width), dtype=np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), width)
            n += len(x)
            halves += (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
        columns = np.arange(width), np.full(width, n), *halves
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["entry", "n", "high", "low"]
        )

    kinds = "entry long, n long, high long, low long"
    total = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("n", "high", "low")]
    found = {
        r["entry"]: (int(r["n"]), int(r["high"]) * 2**32 + int(r["low"]))
        for r in fitted.mapInArrow(sums, kinds).groupBy("entry").agg(*total).collect()
    }
    return Centre(found[0][0] if found else 0, tuple(found[i][1] for i in sorted(found)))


def _products(fitted: DataFrame, width: int, shared, centre: Centre) -> np.ndarray:
    """Covariance of the rows, centred, and then projected on what `shared` holds, if any."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = shared.value if shared else np.eye(width)
        total = np.zeros((base.shape[1], base.shape[1]))
        for batch in batches:
            rows = centre.centred(_matrix(batch.column(0), width))
            rows = rows @ base if shared else rows
            total += rows.T @ rows
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "sum"]
        )

    size = shared.value.shape[1] if shared else width
    cells = fitted.mapInArrow(sums, "i long, j long, sum double")
    found = np.zeros((size, size))
    for r in cells.groupBy("i", "j").agg(F.sum("sum").alias("sum")).collect():
        found[r["i"], r["j"]] = found[r["j"], r["i"]] = r["sum"] / centre.n
    return found


def whiten(
    vectors: DataFrame, keep: list[str], vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """Rows `keep`, component, n, deviation, whitened, explained, identity_error: each
    vector projected on the leading components of the covariance of all distinct ones.

    `vectors` is a stored table; `keep` names columns of it, other than those above. An
    entry c becomes the whole number x = floor(64 * c) + 1000000. A vector takes no part
    if it is null, or if an entry is null, not finite, or so large that x is no 64-bit
    number. A shorter vector goes on with zeros. Repeated vectors are fitted once and
    answered each. Components are numbered from 1 by falling variance; those of no
    variance (less than `LEAST` of the first one's) are left out, so a table whose
    vectors are all equal, or without vectors, gives no rows. `deviation` is a whole
    decimal, null beyond 38 digits. Components of equal variance are any basis of their
    space.

    Three passes over the distinct vectors add up counts and exact sums, the centred
    products, and those of the whitened rows. What meets on the driver is a number for
    each entry and pair of entries: the square of the vectors' length, whatever the rows.
    """
    spark = vectors.sparkSession
    x, length = fresh(vectors, "x"), fresh(vectors, "length")
    ready = stored(
        vectors.select(*keep, scaled(vector).alias(x)).where(F.col(x).isNotNull()), "scaled"
    )
    width = ready.agg(F.max(F.size(x))).first()[0] or 0
    schema = StructType([vectors.schema[c] for c in keep])
    schema.add("component", IntegerType()).add("n", LongType())
    schema.add("deviation", DecimalType(38, 0))
    for name in ("whitened", "explained", "identity_error"):
        schema.add(name, DoubleType())
    nothing = spark.createDataFrame([], schema)
    if not width:
        return nothing
    missing = F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(width) - F.col(length))
    ready = ready.withColumn(length, F.size(x)).withColumn(
        x, F.when(F.col(length) < width, F.concat(x, missing)).otherwise(F.col(x))
    )
    fitted = stored(ready.select(x).distinct(), "distinct")
    centre = _centre(fitted, width)
    covariance = _products(fitted, width, None, centre)
    values, basis = leading(covariance, components)
    some = values > LEAST * max(values, default=0)
    values, basis = values[some], basis[:, some]
    count = len(values)
    if not count:
        return nothing
    shared = spark.sparkContext.broadcast(basis / np.sqrt(values))
    explained = values / covariance.trace()
    error = float(np.abs(_products(fitted, width, shared, centre) - np.eye(count)).max())

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(0), width)
            found = centre.centred(rows) @ shared.value
            exact = pa.array(
                [Decimal(d) if d < _DIGITS else None for d in centre.deviations(rows)],
                pa.decimal128(38, 0),
            )
            row = pa.array(np.repeat(np.arange(len(rows)), count))
            made = [
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                pa.array(np.full(len(row), centre.n)),
                exact.take(row),
                pa.array(found.ravel()),
                pa.array(np.tile(explained, len(rows))),
                pa.array(np.full(len(row), error)),
            ]
            kept = [c.take(row) for c in batch.columns[1:]]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=schema.names)

    return ready.select(x, *keep).mapInArrow(projected, schema)
