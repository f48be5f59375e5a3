import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm.top_k import ImpactIndex, ordered, top_k

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k):
    vectors = []
    for vec_id, x, _ in rows:
        if vec_id is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        vectors.append((vec_id, [math.floor(1024 * float(np.float32(v))) for v in x]))
    out = []
    for i, (q, x) in enumerate(vectors):
        if q % 100:
            continue
        scores = sorted(
            (-sum(a * b for a, b in zip(x, y, strict=False)), v)
            for j, (v, y) in enumerate(vectors)
            if j != i
        )
        out += [(q, r, v, -s) for r, (s, v) in enumerate(scores[:k], 1)]
    return sorted(out)


def answer(table, k=10):
    rows = top_k(table, F.col("vec_id") % 100 == 0, k).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows)


def test_equals_brute_force(stored_table):
    draw = np.random.default_rng(2)
    near = draw.normal(size=16)
    rows = [(i, (near + draw.normal(size=16) * draw.choice([0.01, 1])).tolist(), 0) for i in range(700)]
    rows += [(700 + i, near.tolist(), 0) for i in range(40)]
    assert answer(stored_table(rows, SCHEMA)) == brute(rows, 10)


def test_odd_vectors_and_repeated_rows(stored_table):
    rows = [
        (0, [1.0, 2.0], 1), (100, [1.0, 2.0], 1), (100, [1.0, 2.0], 1), (3, [-0.5], 1), (4, [], 1),
        (5, None, 1), (6, [float("nan"), 1.0], 1), (7, [float("inf"), 1.0], 1), (8, [None, 1.0], 1),
        (None, [1.0, 1.0], 1), (9, [1e-9, -1e-9], 1), (200, [0.0, 0.0], 1),
        (10, [1000.0, -1000.0], 1),
    ]
    assert answer(stored_table(rows, SCHEMA)) == brute(rows, 10)
    assert answer(stored_table(rows, SCHEMA), 2) == brute(rows, 2)
    assert answer(stored_table([], SCHEMA)) == []
    assert answer(stored_table([(0, [1.0], 1)], SCHEMA)) == []


def test_components_of_any_size(stored_table):
    rows = [
        (0, [3e6, 1.0, 1.0], 1), (550, [3e6, 1.0, 1.0], 1), (551, [-4e6, 7.0, 1.0], 1),
        (100, [0.5, 0.25, 0.125], 1), (200, [1e15, -1e15, 3.0], 1), (201, [-1e15, 1e15, 3.0], 1),
        (300, [1e30, 1.0, 1.0], 1), (301, [1e30, -1e30, 2.0], 1), (400, [1e308, 1e308], 1),
        (401, [-1e308, 1e307], 1), (402, [1e300, 1e300], 1),
    ]
    rows += [(1000 + i, [i / 7, -i / 11, 0.5], 0) for i in range(40)]
    wide = stored_table(rows, "vec_id long, embedding array<double>, label int")
    whole = {}
    for vec_id, x, _ in rows:
        whole[vec_id] = [math.floor(v * 1024) if abs(v) < 1e290 else int(v) * 1024 for v in x]
    want = []
    for q, x in whole.items():
        if q % 100 == 0:
            scores = sorted(
                (-sum(a * b for a, b in zip(x, y, strict=False)), v) for v, y in whole.items() if v != q
            )
            want += [(q, r, v, -s if abs(s) < 10**38 else None) for r, (s, v) in enumerate(scores[:10], 1)]
    got = answer(wide)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(v == 550 for _, _, v, _ in got)


def test_clashing_columns(spark, tmp_path):
    path = str(tmp_path / "clash")
    layout = "vec_id long, embedding array<float>, row int, x int, asks int, block int, part int"
    rows = [(0, [1.0, 2.0], 9, 9, 9, 9, 9), (5, [1.0, 3.0], 9, 9, 9, 9, 9)]
    spark.createDataFrame(rows, layout).write.parquet(path)
    assert answer(spark.read.parquet(path)) == [(0, 1, 5, 1024 * 1024 * 7)]


def test_whole_numbers_sort_as_bytes():
    numbers = [0, 1, -1, 255, 256, -256, 10**40, -(10**40), 10**40 + 1, 3 * 2**64]
    assert sorted(numbers, key=ordered) == sorted(numbers)


@pytest.mark.parametrize("scale", [3, 1000, 100_000])
def test_bands_prove_the_best(scale):
    draw = np.random.default_rng(scale)
    vectors = draw.integers(-scale, scale + 1, size=(900, 24))
    ids, rows = draw.permutation(900), np.arange(900)
    index = ImpactIndex(vectors, ids, rows)
    queries = draw.integers(-scale, scale + 1, size=(40, 24))
    for query, (at, score) in zip(queries, index.best(queries, np.arange(40), 7), strict=True):
        exact = vectors @ query
        own = np.flatnonzero((queries == query).all(axis=1))[0]
        exact = np.where(rows == own, -(2**60), exact)
        order = np.lexsort((ids, -exact))[:7]
        assert at.tolist() == order.tolist()
        assert score.tolist() == exact[order].tolist()
