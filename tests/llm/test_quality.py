import zlib

import numpy as np
import pandas as pd
import pytest

from meterlake.llm.quality import (
    BUCKETS, WIDTH, contexts, fit, gather, pooled, score, train, words, _INDEX,
)
from tests.llm.conftest import DOC_SCHEMA

LABELS = "doc_id long, quality int, toxic int"
FOLDER = "/root/testdata/sf0.01"


def out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_held_out_labels_are_told_apart(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = pd.read_parquet(f"{FOLDER}/labels.parquet")
    scores = score(docs, train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")), ["doc_id"])
    found = scores.toPandas().merge(labels, on="doc_id")
    assert scores.count() == docs.count()
    rest = found[[out(d) for d in found["doc_id"]]]
    assert len(rest) > 50
    good = rest[rest["quality"] == 1]["score"].to_numpy()
    bad = rest[rest["quality"] == 0]["score"].to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert ((rest["score"] >= 0.7) == (rest["quality"] == 1)).mean() > 0.95
    assert rest["score"].between(0, 1).all()


def test_vectors_are_sums_over_the_whole_corpus(docs):
    texts = ["the cat sat", "The dog, sat!", "x" * 40, "", None]
    got = gather(docs(list(enumerate(texts))))
    want = np.zeros((BUCKETS, WIDTH))
    for text in texts:
        bucket = words(text or "")[0]
        for i, b in enumerate(bucket):
            for j in range(max(0, i - 2), min(len(bucket), i + 3)):
                if j != i:
                    want[b] += _INDEX[bucket[j]]
    length = np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    assert np.allclose(got, want / length, atol=1e-6)
    assert (contexts(words("a b c")[0])[1] == _INDEX[words("a")[0][0]] + _INDEX[words("c")[0][0]]).all()


def test_words_are_runs_of_one_kind():
    bucket, capitals = words("The THE the 12 3456 78!! ??")
    assert bucket[0] == bucket[1] == bucket[2]
    assert capitals.tolist()[:3] == [False, True, False]
    assert bucket[3] == words("99")[0][0] and bucket[4] == words("0000")[0][0]
    assert len(bucket) == 8
    assert len(words("")[0]) == 0


def test_odd_texts_have_scores(stored_table):
    rows = [(i, f"good words number {i} in here", "en", "s", 1) for i in range(40)]
    rows += [(100 + i, f"BAD!! WORDS!! {i} !!", "en", "s", 1) for i in range(40)]
    rows += [(None, None, None, None, None), (200, "", None, None, None), (201, "w " * 300_000, "", "", 1)]
    rows += [rows[0]]
    table = stored_table(rows, DOC_SCHEMA)
    labels = [(r[0], int(r[0] < 100), 0) for r in rows[:80]]
    labels += [labels[0], (None, 1, 0), (300, None, 1), (9, 5, 0)]
    model = train(table, stored_table(labels, LABELS))
    found = score(table, model, ["doc_id", "text"]).collect()
    assert len(found) == len(rows)
    assert all(0 <= r["score"] <= 1 for r in found)
    by_id = {r["doc_id"]: r["score"] for r in found}
    assert min(by_id[i] for i in range(40)) > 0.7 > max(by_id[100 + i] for i in range(40))
    assert by_id[None] == by_id[200]


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 0, 1)]])
def test_one_sort_of_labels_or_none(stored_table, labels):
    table = stored_table([(1, "a text", "en", "s", 1)], DOC_SCHEMA)
    model = train(table, stored_table(labels, LABELS))
    value = score(table, model, ["doc_id"]).first()["score"]
    assert 0 < value < 1
    empty = stored_table([], DOC_SCHEMA)
    assert score(empty, train(empty, stored_table([], LABELS)), ["doc_id"]).collect() == []


def test_fit_is_repeatable():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(200, len(pooled("", np.zeros((BUCKETS, WIDTH))))))
    y, fold = (x[:, 0] > 0).astype(float), np.arange(200) % 5 == 0
    one, two = (fit(np.zeros((BUCKETS, WIDTH)), x, y, fold) for _ in range(2))
    assert (one.score(x) == two.score(x)).all()
    assert ((one.score(x) > 0.5) == (y > 0)).mean() > 0.9
