"""Text quality: random-indexing word vectors, pooled, and a two-layer network."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from meterlake.llm.common import fresh, held_out

BUCKETS = 1 << 13
WIDTH = 24
REACH = 2
NONZERO = 6
TRAINING_ROWS = 4000
HIDDEN = 24
EPOCHS = 400
SLICE_BYTES = 1 << 21
GROUPS = 64

_SPACE, _LETTER, _DIGIT, _MARK = range(4)
_KIND = np.full(256, _LETTER, dtype=np.int8)
for _b in range(128):
    if chr(_b) in " \t\n\r\x0b\x0c":
        _KIND[_b] = _SPACE
    elif chr(_b).isdigit():
        _KIND[_b] = _DIGIT
    elif not chr(_b).isalpha():
        _KIND[_b] = _MARK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_SMALL = np.zeros(256, dtype=bool)
_SMALL[97:123] = True

_DRAW = np.random.default_rng(31)
# Each bucket's index vector: a few +1 and -1 at random places.
_INDEX = np.zeros((BUCKETS + 1, WIDTH), dtype=np.int32)
for _row in _INDEX[:BUCKETS]:
    _row[_DRAW.choice(WIDTH, NONZERO, replace=False)] = _DRAW.choice((-1, 1), NONZERO)


def words(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word of a text, and whether it is all capitals.

    A word is a run of letters, of digits or of other marks. Letters count in lower
    case; all digits and their number are one word, however long the text.
    """
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    if not len(raw):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
    kind = _KIND[raw]
    turn = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    start = np.concatenate([[0], turn])
    own = kind[start]
    length = np.diff(np.append(start, len(raw)))
    value = np.where(kind == _DIGIT, np.uint8(48), _LOWER[raw]).astype(np.uint64)
    place = (np.arange(len(raw)) - np.repeat(start, length)).astype(np.uint64)
    # the same in any order would collide: the place goes into the mix
    mixed = (value + np.uint64(1)) * (place * np.uint64(2) + np.uint64(0x9E37_79B9_7F4A_7C15))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58_476D_1CE4_E5B9)
    total = np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), start)
    total = (total ^ (total >> np.uint64(31))) * np.uint64(0x94D0_49BB_1331_11EB)
    bucket = (total >> np.uint64(64 - 13)).astype(np.int64)
    capitals = np.add.reduceat(_UPPER[raw].astype(np.int64), start)
    small = np.add.reduceat(_SMALL[raw].astype(np.int64), start)
    kept = own != _SPACE
    return bucket[kept], ((capitals >= 2) & (small == 0))[kept]


def contexts(bucket: np.ndarray) -> np.ndarray:
    """For each word the sum of its neighbours' index vectors."""
    index = _INDEX[bucket]
    total = np.zeros_like(index)
    for step in range(1, REACH + 1):
        total[step:] += index[:-step]
        total[:-step] += index[step:]
    return total


def gather(docs: DataFrame) -> np.ndarray:
    """Word vectors (bucket x width): what stood around each bucket's words, as a unit
    vector. Every word of every text of `docs` counts.

    Tasks add up what they read before anything is exchanged, and the sums of a task
    are the same few numbers whatever it has read: `BUCKETS` * `WIDTH`. So is what the
    driver receives.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS + 1, WIDTH), dtype=np.int64)
        waiting: list[np.ndarray] = []
        size = 0

        def settle() -> None:
            bucket = np.concatenate(waiting)
            around = contexts(bucket)
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            total[bucket[first]] += np.add.reduceat(around[order], first, axis=0)
            waiting.clear()

        gap = np.full(REACH, BUCKETS)  # between texts stands a word without a vector
        for batch in batches:
            for text in batch.column(0):
                for part in _windows(text.as_py()):
                    waiting += [words(part)[0], gap]
                    size += len(part)
                    if size >= SLICE_BYTES:
                        settle()
                        size = 0
        if waiting:
            settle()
        groups = np.split(total[:BUCKETS], GROUPS)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(GROUPS), pa.int32()),
                pa.array([zlib.compress(g.astype("<i8").tobytes(), 1) for g in groups]),
            ],
            names=["part", "sums"],
        )

    def added(part: pa.Table) -> pa.Table:
        total = sum(
            np.frombuffer(zlib.decompress(x.as_py()), dtype="<i8") for x in part.column("sums")
        )
        return pa.table({"part": part.column("part")[:1], "sums": [total.astype("<i8").tobytes()]})

    kinds = "part int, sums binary"
    found = (
        docs.select("text").where(F.col("text").isNotNull()).mapInArrow(summed, kinds)
        .groupBy("part").applyInArrow(added, kinds)
        .collect()
    )
    vectors = np.zeros((GROUPS, BUCKETS // GROUPS, WIDTH))
    for row in found:
        vectors[row["part"]] = np.frombuffer(row["sums"], dtype="<i8").reshape(-1, WIDTH)
    vectors = vectors.reshape(BUCKETS, WIDTH)
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.maximum(length, 1e-9)).astype(np.float32)


def _windows(text: str) -> Iterator[str]:
    for at in range(0, len(text), SLICE_BYTES):
        yield text[at : at + SLICE_BYTES]


def pooled(text: str | None, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of a text's word vectors, how alike neighbours are, and shares of
    capitals, of repeated words and of different ones, with the logarithm of the length.
    """
    n = capitals = repeated = 0
    total = np.zeros(2 * WIDTH + 1)
    seen = np.zeros(BUCKETS, dtype=bool)
    for part in _windows(text or ""):
        bucket, large = words(part)
        v = vectors[bucket].astype(np.float64)
        n += len(bucket)
        total[:WIDTH] += v.sum(axis=0)
        total[WIDTH:-1] += (v * v).sum(axis=0)
        total[-1] += (v[1:] * v[:-1]).sum()
        capitals += int(large.sum())
        repeated += int((bucket[1:] == bucket[:-1]).sum())
        seen[bucket] = True
    mean = total / max(n, 1)
    spread = np.sqrt(np.maximum(mean[WIDTH:-1] - mean[:WIDTH] ** 2, 0))
    shares = np.array([capitals, repeated, seen.sum()]) / max(n, 1)
    return np.concatenate([mean[:WIDTH], spread, mean[-1:], shares, [np.log1p(n)]])


@dataclass(frozen=True)
class QualityModel:
    """Word vectors; the network's layers over standardised features; temperature."""

    vectors: np.ndarray
    middle: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, float]
    temperature: float

    def score(self, features: np.ndarray) -> np.ndarray:
        x = (features - self.middle) / self.scale
        return 1 / (1 + np.exp(-np.clip(_logits(x, self.layers) / self.temperature, -30, 30)))


def _logits(x: np.ndarray, layers: tuple) -> np.ndarray:
    w, b, v, c = layers
    return np.tanh(x @ w + b) @ v + c


def _network(x: np.ndarray, y: np.ndarray) -> tuple:
    """Two layers by full-batch Adam on the logistic loss with weight decay."""
    draw = np.random.default_rng(5)
    w = draw.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN))
    v = draw.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN)
    parts = [w, np.zeros(HIDDEN), v, np.zeros(1)]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, EPOCHS + 1):
        h = np.tanh(x @ parts[0] + parts[1])
        p = 1 / (1 + np.exp(-np.clip(h @ parts[2] + parts[3], -30, 30)))
        d = (p - y) / len(y)
        back = np.outer(d, parts[2]) * (1 - h * h)
        grads = [
            x.T @ back + 1e-4 * parts[0], back.sum(axis=0), h.T @ d + 1e-4 * parts[2],
            np.array([d.sum()]),
        ]
        for i, g in enumerate(grads):
            first[i] += 0.1 * (g - first[i])
            second[i] += 0.001 * (g * g - second[i])
            up = first[i] / (1 - 0.9**step)
            down = np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8
            parts[i] = parts[i] - 0.01 * up / down
    return parts[0], parts[1], parts[2], float(parts[3][0])


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least logistic loss on rows not trained on."""
    best, least = 1.0, np.inf
    for t in np.geomspace(0.25, 8, 61):
        loss = (np.logaddexp(0, logits / t) - y * logits / t).mean()
        if loss < least - 1e-12:
            best, least = float(t), loss
    return best


def fit(vectors: np.ndarray, features: np.ndarray, y: np.ndarray, fold: np.ndarray) -> QualityModel:
    """Train on rows with `fold` false, set the temperature on those with it true.

    With labels of one sort only, or none, every text gets their smoothed share.
    """
    size = 2 * WIDTH + 5
    middle, scale = np.zeros(size), np.ones(size)
    if len(y):
        middle, scale = features.mean(axis=0), np.maximum(features.std(axis=0), 1e-3)
    if len(np.unique(y[~fold])) < 2:
        odds = np.log((y.sum() + 1) / ((1 - y).sum() + 1))
        layers = np.zeros((size, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), float(odds)
        return QualityModel(vectors, middle, scale, layers, 1.0)
    x = (features - middle) / scale
    layers = _network(x[~fold], y[~fold])
    out = _temperature(_logits(x[fold], layers), y[fold]) if fold.any() else 1.0
    return QualityModel(vectors, middle, scale, layers, out)


def train(docs: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS) -> QualityModel:
    """Word vectors from all texts, the network from about `training_rows` labelled ones.

    Labels are those of rows that are not held out. Which of them are taken follows from
    a hash of the id, at a rate from their number; one in five of these sets the
    temperature. The driver receives their pooled features, not their texts.
    """
    vectors = gather(docs)
    known = labels.where(
        F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id")
    ).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    n = known.count()
    place = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    picked = known.where(place < training_rows / max(n, 1))
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pooled(t.as_py(), shared.value) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"),
                 pa.array(found, pa.list_(pa.float64()))],
                names=["doc_id", "quality", "features"],
            )

    sample = (
        rows.mapInArrow(described, "doc_id long, quality int, features array<double>")
        .orderBy("doc_id", "quality").collect()
    )
    features = np.array([r["features"] for r in sample]).reshape(-1, 2 * WIDTH + 5)
    y = np.array([r["quality"] for r in sample], dtype=float)
    fold = np.array([zlib.crc32(b"t%d" % r["doc_id"]) % 5 == 0 for r in sample], dtype=bool)
    return fit(vectors, features, y, fold)


def score(docs: DataFrame, model: QualityModel, keep: list[str]) -> DataFrame:
    """Columns `keep` of `docs` with score, from 0 to 1, of its column text.

    `keep` has no column score. The whole text is read, and nothing else of the row;
    null is an empty text, which has a score like any other. Repeated rows get equal
    scores, an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([docs.schema[c] for c in keep]).add("score", DoubleType())
    names = [f.name for f in schema]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = batch.column(0)
            found = np.array([pooled(t.as_py(), known.vectors) for t in texts])
            made = known.score(found) if len(texts) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(made)], names=names)

    text = fresh(docs, "text")
    return docs.select(F.col("text").alias(text), *keep).mapInArrow(scored, schema)
