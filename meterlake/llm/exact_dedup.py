"""Exact duplicates by composable polynomial fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import SPACES, fresh, joined_by_row, numbered
from meterlake.session import stored

# Two independent fingerprints of 31 bits each. The moduli are prime.
MODULI = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 1_812_433_253)
CHUNK_BYTES = 64 * 1024
# 8192 products of a byte and a 31-bit power add up to less than 2 ** 53, so that a
# float dot product of that length is exact.
LANE = 8192
_FINGERPRINT = ["n_bytes", "h1", "h2"]


def normalised(text: str) -> Column:
    """Each run of white space as one space; null as empty."""
    runs = SPACES + r"{2,}|[\x09-\x0D]"
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), runs, " ")


class Polynomial:
    """Value of a byte string as a polynomial in each base, modulo each prime."""

    def __init__(self, moduli: tuple[int, int], bases: tuple[int, int]):
        self.moduli = moduli
        self.bases = bases
        powers = np.ones((LANE, 2))
        for k, (base, prime) in enumerate(zip(bases, moduli, strict=True)):
            value = 1
            for i in range(LANE - 1, -1, -1):
                powers[i, k] = value
                value = value * base % prime
        self.powers = powers
        self.step = [pow(b, LANE, p) for b, p in zip(bases, moduli, strict=True)]

    def of(self, data: bytes) -> list[int]:
        """Hash of one chunk: lanes are hashed together and combined by shifting."""
        values = np.frombuffer(data, dtype=np.uint8).astype(np.float64)
        head = len(values) % LANE
        total = [int(x) for x in values[:head] @ self.powers[LANE - head :]]
        total = [x % p for x, p in zip(total, self.moduli, strict=True)]
        if len(values) > head:
            for lane in values[head:].reshape(-1, LANE) @ self.powers:
                total = [
                    (x * s + int(y)) % p
                    for x, s, y, p in zip(
                        total, self.step, lane, self.moduli, strict=True
                    )
                ]
        return total

    def shifted(self, value: list[int], length: int) -> list[int]:
        """The value's share in a text that goes on for `length` bytes after it."""
        if not length:
            return value
        return [
            x * pow(b, length, p) % p
            for x, b, p in zip(value, self.bases, self.moduli, strict=True)
        ]


def _chunks(bytes_: str) -> Column:
    """The chunks of a binary column, with place and number of bytes after them."""
    size = F.octet_length(bytes_)
    last = F.greatest(F.ceil(size / F.lit(CHUNK_BYTES)).cast("int") - 1, F.lit(0))

    def chunk(i: Column) -> Column:
        data = F.substring(F.col(bytes_), i * CHUNK_BYTES + 1, F.lit(CHUNK_BYTES))
        rest = F.greatest(size - (i + 1) * CHUNK_BYTES, F.lit(0)).cast("long")
        return F.struct(i.alias("place"), data.alias("data"), rest.alias("rest"))

    return F.transform(F.sequence(F.lit(0), last), chunk)


def fingerprints(
    rows: DataFrame,
    carry: list[str],
    moduli: tuple[int, int] = MODULI,
    bases: tuple[int, int] = BASES,
) -> DataFrame:
    """`carry` with n_bytes, h1 and h2 of the binary column `data` of `rows`.

    `carry` holds narrow columns. Every chunk is hashed on its own; the hashes, each
    shifted by the bytes after its chunk, add up to the hash of the whole. A row's
    chunks follow each other in its task, the last one with no bytes after it, so they
    are added there, whatever batches they come in, and nothing is shuffled.
    """
    names = [*carry, "n_bytes"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly = Polynomial(moduli, bases)
        total = [0, 0]
        for batch in batches:
            data, rest = batch.column("data"), batch.column("rest").to_pylist()
            ends, found = [], []
            for i, (x, n) in enumerate(zip(data, rest, strict=True)):
                share = poly.shifted(poly.of(x.as_buffer()), n)
                total = [
                    (t + s) % p for t, s, p in zip(total, share, moduli, strict=True)
                ]
                if n == 0:
                    ends.append(i)
                    found.append(total)
                    total = [0, 0]
            h = np.array(found, dtype=np.int64).reshape(-1, 2)
            at = pa.array(ends, pa.int64())
            kept = [batch.column(c).take(at) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(h[:, 0]), pa.array(h[:, 1])],
                names=[*names, "h1", "h2"],
            )

    parts = rows.select(
        *carry,
        F.octet_length("data").cast("long").alias("n_bytes"),
        F.explode(_chunks("data")).alias("chunk"),
    ).select(*carry, "n_bytes", "chunk.data", "chunk.rest")
    kinds = ", ".join(
        f"{f.name} {f.dataType.simpleString()}"
        for f in parts.schema.fields
        if f.name in carry
    )
    schema = f"{kinds}, n_bytes long, h1 long, h2 long"
    return parts.mapInArrow(hashed, schema)


def _class_of(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: group_size, keep_id and the row that stays (`keep_row`).

    Equal ids are put together first, and both steps combine where they read.
    """
    order = F.coalesce("doc_id", F.lit(2**63 - 1))
    return (
        rows.groupBy(*keys, "doc_id")
        .agg(F.count("*").alias("n"), F.min("row").alias("row"))
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("group_size"),
            F.min("doc_id").alias("keep_id"),
            F.min_by("row", order).alias("keep_row"),
        )
    )


def exact_duplicates(
    docs: DataFrame,
    digest: bool = False,
    moduli: tuple[int, int] = MODULI,
    bases: tuple[int, int] = BASES,
) -> DataFrame:
    """One row per document: row, doc_id, keep_id, group_size, kept (and text_sha256).

    `docs` is a stored table with doc_id and text; other columns are not read. `row`
    is its number, as of `numbered`. Texts are equal when identical with each run of
    white space as one space; a null text is empty. Of equal texts the row with the
    smallest doc_id stays, null last, and of rows with the same id the first one read.
    An empty table gives no rows.

    Rows of equal fingerprint and length are compared chunk by chunk, and a group in
    which some chunk differs is parted by its whole texts, so no collision can merge
    different texts.
    """
    data = normalised("text").cast("binary").alias("data")
    rows = numbered(docs.select("doc_id", "text"), "row")
    carry = ["row", "doc_id"]
    if digest:
        rows = rows.withColumn("text_sha256", F.sha2(normalised("text"), 256))
        carry = [*carry, "text_sha256"]
    marks = stored(
        fingerprints(rows.select(*carry, data), carry, moduli, bases), "marks"
    )
    groups = stored(_class_of(marks, _FINGERPRINT), "groups")

    # Joined once: the members of groups and the result are both read from it.
    classed = marks.join(groups, _FINGERPRINT).drop(*_FINGERPRINT)
    result = stored(classed, "classed")
    members = result.where("group_size > 1").select("row", "keep_row")
    texts = joined_by_row(rows, members, "row").select(
        "row", "doc_id", "keep_row", data
    )
    mixed = stored(
        texts.select("keep_row", F.explode(_chunks("data")).alias("chunk"))
        .groupBy("keep_row", "chunk.place", "chunk.data")
        .agg(F.lit(1).alias("one"))
        .groupBy("keep_row", "place")
        .count()
        .where("count > 1")
        .select("keep_row")
        .distinct(),
        "mixed",
    )

    if not mixed.isEmpty():
        result = _parted(result, texts.join(mixed, "keep_row"))
    kept = (F.col("row") == F.col("keep_row")).alias("kept")
    columns = ["keep_id", "group_size", kept] + ["text_sha256"] * digest
    return result.select("row", "doc_id", *columns)


def _parted(result: DataFrame, texts: DataFrame) -> DataFrame:
    """`result` with the collided groups parted by their whole texts."""
    texts = stored(texts.select("row", "doc_id", "keep_row", "data"), "collided")
    keys = ["group", "data"]
    texts = texts.withColumnRenamed("keep_row", "group")
    classes = stored(_class_of(texts, keys), "classes").withColumnsRenamed(
        {"keep_row": "own_row", "group_size": "own_size", "keep_id": "own_id"}
    )
    parted = texts.join(classes, keys).select("row", "own_row", "own_size", "own_id")
    found = F.col("own_row").isNotNull()
    return result.join(stored(parted, "parted"), "row", "left").select(
        *[c for c in result.columns if c not in ("keep_row", "group_size", "keep_id")],
        F.coalesce("own_row", "keep_row").alias("keep_row"),
        F.coalesce("own_size", "group_size").alias("group_size"),
        F.when(found, F.col("own_id")).otherwise(F.col("keep_id")).alias("keep_id"),
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """`docs` without the rows that repeat an earlier text; all its columns stay."""
    row = fresh(docs, "row")
    gone = exact_duplicates(docs).where(~F.col("kept"))
    gone = stored(gone.select(F.col("row").alias(row)), "gone")
    return joined_by_row(numbered(docs, row), gone, row, "left_anti").drop(row)
