import hashlib
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meterlake.llm.exact_dedup import (
    CHUNK_BYTES,
    LANE,
    MODULI,
    BASES,
    Polynomial,
    drop_duplicates,
    exact_duplicates,
    fingerprints,
)
from meterlake.session import shared_root

LONG = "word and more " * 20_000
PAIRS = [
    (5, "a  b"), (3, "a b"), (9, "a\t\nb"), (1, "A b"), (2, None), (4, ""), (7, " "), (8, "  "),
    (6, "é b"), (10, LONG), (11, LONG), (12, LONG[:-2] + "x "), (3, "a b"), (None, "a b"),
    (None, "only here"),
]


def brute(pairs):
    groups = {}
    for doc_id, text in pairs:
        groups.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", text or ""), []).append(doc_id)
    rows = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        rows += [(i, keep, len(ids), sha) for i in ids]
    return sorted(rows, key=str)


@pytest.mark.parametrize("moduli", [MODULI, (3, 2)])
def test_groups_equal_texts_whatever_the_fingerprint(docs, moduli):
    # with moduli this small nearly all texts of a length collide
    found = exact_duplicates(docs(PAIRS), True, moduli).collect()
    got = [(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found]
    assert sorted(got, key=str) == brute(PAIRS)
    kept = [r for r in found if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in found})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_chunk_hashes_combine_to_the_hash_of_the_whole():
    poly = Polynomial(MODULI, BASES)
    data = bytes(range(256)) * 700
    value = [0, 0]
    for byte in data:
        value = [(v * b + byte) % p for v, b, p in zip(value, BASES, MODULI, strict=True)]
    assert poly.of(data) == value
    for cut in (1, LANE, LANE + 1, CHUNK_BYTES):
        parts = [data[i : i + cut] for i in range(0, len(data), cut)][:50]
        whole = b"".join(parts)
        total, rest = [0, 0], len(whole)
        for part in parts:
            rest -= len(part)
            share = poly.shifted(poly.of(part), rest)
            total = [(t + s) % p for t, s, p in zip(total, share, MODULI, strict=True)]
        assert total == poly.of(whole)


@pytest.fixture
def settings(spark):
    """Set settings of the session for one test."""
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("records", [1, 2, 3, 10_000])
def test_chunks_are_added_whatever_batches_they_come_in(docs, settings, records):
    settings("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))
    texts = [LONG, "", "a", LONG[:-3] + "é", "b" * CHUNK_BYTES, "c" * (2 * CHUNK_BYTES), "", "d"]
    # not in the order of their ids, and one id twice
    rows = docs([(i % 7, t) for i, t in enumerate(texts)])
    marks = fingerprints(rows.select("doc_id", F.col("text").cast("binary").alias("data")), ["doc_id"])
    poly = Polynomial(MODULI, BASES)
    want = [(i % 7, len(t.encode()), *poly.of(t.encode())) for i, t in enumerate(texts)]
    assert sorted(tuple(r) for r in marks.collect()) == sorted(want)


def test_few_files_are_written(spark, docs, settings, tmp_path):
    # where Hadoop's own library is missing, each file costs an executor several forks
    settings("spark.sql.shuffle.partitions", "16")
    settings("spark.sql.adaptive.coalescePartitions.enabled", "false")
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    shared = Path(shared_root(spark).removeprefix("file://"))
    parts = lambda: set(shared.rglob("part-*.parquet"))
    table, before = docs([(i, f"text {i % 150}") for i in range(400)]), parts()
    exact_duplicates(table, digest=True).write.parquet(str(tmp_path / "out"))
    written = len(parts() - before) + len(list((tmp_path / "out").glob("part-*.parquet")))
    # the groups and the classed rows; the rest follows the splits of the scans
    assert 16 <= written < 3 * 16


def test_empty_table_and_clashing_columns(docs, stored_table):
    assert exact_duplicates(docs([])).collect() == []
    rows = [(1, "x", 7, "k"), (2, "x", 8, "l"), (3, "y", 9, None)]
    clash = stored_table(rows, "doc_id long, text string, row long, keep_row string")
    kept = drop_duplicates(clash)
    assert kept.columns == clash.columns
    assert sorted(kept.collect()) == [rows[0], rows[2]]
