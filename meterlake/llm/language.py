"""Language identification with error-correcting output codes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

from meterlake.llm.common import fresh, held_out, joined_by_row, numbered
from meterlake.session import stored

FEATURES = 1 << 14
ROWS_PER_LANGUAGE = 400
# Documents whose margins the driver gets to calibrate bits, and at least for a language.
CALIBRATED_ROWS = 80_000
CALIBRATED_LEAST = 20
# Shares of trigrams are summed as whole numbers, so their order does not matter.
UNIT = 1 << 40
WINDOW = 1 << 20
# Below this lead of the best language over the next, the answer counts as ambiguous.
LEAD = 0.05
UNKNOWN = "und"

# ASCII bytes other than letters separate words; all others belong to letters.
_WORDS = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in range(256))
_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    """Whether some character is a letter in any script."""
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def trigrams(text: str) -> Iterator[np.ndarray]:
    """Hashed byte trigrams of the whole text, letters only, in windows."""
    data = text.lower().encode("utf-8", "replace").translate(_WORDS)
    raw = np.frombuffer(b" " + data + b" ", dtype=np.uint8)
    for start in range(0, max(len(raw) - 2, 0), WINDOW):
        part = raw[start : start + WINDOW + 2].astype(np.uint32)
        a, b, c = part[:-2], part[1:-1], part[2:]
        inside = (b != 32) | ((a != 32) & (c != 32))
        mixed = (a * 0x9E3779B1 + b * 0x85EBCA6B + c * 0xC2B2AE35) & 0xFFFFFFFF
        yield (mixed >> 18)[inside].astype(np.int64)


def _least_apart(code: np.ndarray) -> float:
    """Least distance between two rows, by blocks of rows."""
    least = np.inf
    for start in range(0, len(code), 1024):
        apart = (code.shape[1] - code[start : start + 1024] @ code.T) / 2
        rows = np.arange(len(apart))
        apart[rows, start + rows] = np.inf
        least = min(least, apart.min())
    return least


def codewords(count: int) -> np.ndarray:
    """One row of +1/-1 per language, rows far apart, no two columns alike.

    Up to five languages get every way of parting them in two. More get the best of a
    fixed number of random codes by least distance between rows.
    """
    if count < 2:
        return np.zeros((count, 0))
    if count <= 5:
        columns = [
            (1, *rest) for rest in product((1, -1), repeat=count - 1) if -1 in rest
        ]
        return np.array(columns, dtype=float).T
    bits = 10 * int(np.ceil(np.log2(count)))
    draw = np.random.default_rng(17)
    best, most = None, -1
    for _ in range(200):
        code = draw.choice((-1.0, 1.0), size=(count, bits))
        code = code[:, np.abs(code.sum(axis=0)) < count]
        least = _least_apart(code)
        if least > most:
            best, most = code, least
    return best


@dataclass(frozen=True)
class LanguageModel:
    """languages; code (language x bit); weights (feature x bit) with slope and shift
    per bit; trust (language x bit), how far to believe each bit for each language."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    slope: np.ndarray
    shift: np.ndarray
    trust: np.ndarray

    def margins(self, text: str) -> np.ndarray:
        total, n = np.zeros(self.weights.shape[1]), 0
        for index in trigrams(text):
            total += self.weights[index].sum(axis=0, dtype=np.float64)
            n += len(index)
        return self.slope * (total / max(n, 1)) + self.shift

    def decode(self, margins: np.ndarray) -> np.ndarray:
        """Probability of each language: loss-weighted distance to its codeword."""
        loss = np.logaddexp(0, -self.code * margins)
        distance = (self.trust * loss).sum(axis=1)
        likely = np.exp(-(distance - distance.min()))
        return likely / likely.sum()

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, probability, and whether the next language is as likely."""
        if text is None or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        likely = self.decode(self.margins(text))
        best = int(likely.argmax())
        others = np.delete(likely, best)
        lead = likely[best] - (others.max() if len(others) else 0.0)
        return self.languages[best], float(likely[best]), bool(lead < LEAD)


def _platt(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps with a small ridge."""
    scale = x.std() or 1.0
    design = np.stack([x / scale, np.ones_like(x)], axis=1)
    theta, goal = np.zeros(2), (y + 1) / 2
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        grad = design.T @ (p - goal) + 0.1 * theta
        hess = (design.T * (p * (1 - p))) @ design + 0.1 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        theta -= step
        if np.abs(step).max() < 1e-6:
            break
    return theta[0] / scale, theta[1]


def _weights(code: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Weights (feature x bit) from sums of trigram shares (language x feature)."""
    share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1e-9)
    weights = np.zeros((FEATURES, code.shape[1]), dtype=np.float32)
    smooth = 1e-6
    for b in range(code.shape[1]):
        is_up = (code[:, b] > 0).astype(float)
        up = is_up @ share / is_up.sum() + smooth
        down = (1 - is_up) @ share / (1 - is_up).sum() + smooth
        weights[:, b] = np.log(up) - np.log(down)
    return weights


def _values(weights: np.ndarray, index: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Mean weight of a document's trigrams, by bit."""
    return (weights[index] * n[:, None]).sum(axis=0) / max(n.sum(), 1)


def _calibrated(
    languages: list[str],
    code: np.ndarray,
    weights: np.ndarray,
    is_of: np.ndarray,
    values: np.ndarray,
) -> LanguageModel:
    """The model, with bits calibrated on documents' languages and values."""
    bits = code.shape[1]
    slope, shift = np.ones(bits), np.zeros(bits)
    trust = np.ones((len(languages), bits))
    seen = np.bincount(is_of, minlength=len(languages))
    for b in range(bits):
        truth = code[is_of, b]
        slope[b], shift[b] = _platt(values[:, b], truth)
        right = (slope[b] * values[:, b] + shift[b]) * truth > 0
        of_each = np.bincount(is_of, weights=right, minlength=len(languages))
        trust[:, b] = (of_each + 1) / (seen + 2)
    if bits:
        trust *= bits / trust.sum(axis=1, keepdims=True)
    return LanguageModel(languages, code, weights, slope, shift, trust)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]]) -> LanguageModel:
    """Train on (language, feature numbers, their counts) of sampled documents."""
    languages = sorted({lang for lang, _, _ in rows})
    code = codewords(len(languages))
    place = {lang: i for i, lang in enumerate(languages)}
    counts = np.zeros((len(languages), FEATURES))
    for lang, index, n in rows:
        counts[place[lang], index] += n / max(n.sum(), 1)
    weights = _weights(code, counts)
    is_of = np.array([place[lang] for lang, _, _ in rows], dtype=int)
    values = np.array([_values(weights, i, n) for _, i, n in rows])
    return _calibrated(
        languages, code, weights, is_of, values.reshape(len(rows), code.shape[1])
    )


def train(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> LanguageModel:
    """Fit on about `rows_per_language` documents of each language.

    Only rows with a language and text that are not held out count. Which of them are
    taken follows from a hash of their id, at a rate from the language's row count, so
    no language's rows meet in one task. Every value of lang is learned. The driver
    receives a sum per language and trigram, at most `FEATURES` a language, and a value
    per bit of some of the documents: about `CALIBRATED_ROWS` in all, or
    `CALIBRATED_LEAST` a language where that is more.
    """
    usable = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id")
    )
    found = stored(usable.groupBy("lang").agg(F.count("*").alias("rows")), "languages")
    languages = sorted(r["lang"] for r in found.select("lang").collect())
    if not languages:
        return fit([])
    number = {lang: i for i, lang in enumerate(languages)}
    rate = F.least(F.lit(1.0), F.lit(float(rows_per_language)) / F.col("rows"))
    mixed = F.xxhash64(F.lit("language"), "doc_id", F.length("text"))
    place = F.pmod(mixed, F.lit(1 << 30)) / (1 << 30)
    each = max(CALIBRATED_LEAST, CALIBRATED_ROWS / len(languages))
    calibrates = place < rate * F.lit(min(1.0, each / rows_per_language))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, counts, shares = [], [], []
            for text in batch.column("text").to_pylist():
                total = np.zeros(FEATURES, dtype=np.int64)
                for part in trigrams(text):
                    total += np.bincount(part, minlength=FEATURES)
                at = np.flatnonzero(total)
                index.append(at.astype(np.int32))
                counts.append(total[at])
                shares.append((total[at] / max(total.sum(), 1) * UNIT).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang"),
                    batch.column("calibrates"),
                    pa.array(index, type=pa.list_(pa.int32())),
                    pa.array(counts, type=pa.list_(pa.int64())),
                    pa.array(shares, type=pa.list_(pa.int64())),
                ],
                names=["lang", "calibrates", "idx", "n", "share"],
            )

    sample = stored(
        joined_by_row(usable, found, "lang")
        .where(place < rate)
        .select("lang", calibrates.alias("calibrates"), "text")
        .mapInArrow(
            counted,
            "lang string, calibrates boolean, idx array<int>, n array<long>, share array<long>",
        ),
        "sample",
    )

    def places(table: pa.Table) -> np.ndarray:
        coded = table.column("lang").combine_chunks().dictionary_encode()
        known = np.array([number[x] for x in coded.dictionary.to_pylist()], dtype=int)
        return known[coded.indices.to_numpy()]

    sums = (
        sample.select("lang", F.explode(F.arrays_zip("idx", "share")).alias("f"))
        .groupBy("lang", F.col("f.idx").alias("idx"))
        .agg(F.sum("f.share").alias("share"))
        .toArrow()
    )
    counts = np.zeros((len(languages), FEATURES))
    counts[places(sums), sums.column("idx").to_numpy()] = sums.column("share").to_numpy() / UNIT
    code = codewords(len(languages))
    weights = _weights(code, counts)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def valued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [
                _values(shared.value, i.values.to_numpy(), n.values.to_numpy())
                for i, n in zip(batch.column("idx"), batch.column("n"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array(values, type=pa.list_(pa.float64()))],
                names=["lang", "value"],
            )

    said = (
        sample.where("calibrates").select("lang", "idx", "n")
        .mapInArrow(valued, "lang string, value array<double>")
        .toArrow()
    )
    values = said.column("value").combine_chunks().flatten().to_numpy()
    return _calibrated(
        languages, code, weights, places(said), values.reshape(len(said), code.shape[1])
    )


def identify(docs: DataFrame, model: LanguageModel, keep: list[str]) -> DataFrame:
    """Columns `keep` of `docs` with lang_pred, score and ambiguous.

    `docs` has a column text; `keep` has none of the three new names. The whole text
    is read. Null text, and text without any letter, is `und` with score 0; so is
    every text if the model knows no language. Repeated rows get equal answers, an
    empty table gives no rows, and equally likely languages go to the first by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = [known.predict(t.as_py()) for t in batch.column(0)]
            lang, score, unsure = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:],
                    pa.array(lang, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(unsure, pa.bool_()),
                ],
                names=[f.name for f in schema],
            )

    schema = (
        StructType([docs.schema[c] for c in keep])
        .add("lang_pred", StringType())
        .add("score", DoubleType())
        .add("ambiguous", BooleanType())
    )
    text = fresh(docs, "text")
    return docs.select(F.col("text").alias(text), *keep).mapInArrow(scored, schema)


def keep_known(docs: DataFrame) -> DataFrame:
    """`docs` without texts in no known language; all its columns stay.

    Rejected are texts that are `und` or ambiguous between two languages. If no row has
    a language to learn from, only null texts and texts without letters are.
    """
    model = train(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    row = fresh(docs, "row")
    placed = numbered(docs, row)
    said = identify(placed.select(row, "text"), model, [row])
    gone = said.where((F.col("lang_pred") == UNKNOWN) | F.col("ambiguous"))
    gone = stored(gone.select(row), "rejected")
    return joined_by_row(placed, gone, row, "left_anti").drop(row)
