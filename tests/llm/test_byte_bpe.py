import base64
import hashlib
import random

import pytest
import public_tokenizers
import tiktoken

import meterlake.llm.byte_bpe as byte_bpe
from meterlake.llm.byte_bpe import BpeDatabase, code_texts, encode

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ODD = [
    "", None, "  a  b \r\n\x1c\x1d 😀👍🏽  ’s 中文字符測試" * 3, "x" * 5000, "ab" * 700,
    "!?" * 300 + " " * 500 + "q", "１２３４５", "a" * 96, "é" * 60, "\x01 \x7f",
    "<|endoftext|>", "don't we'll",
]


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coding = tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return lambda text: coding.encode_ordinary(text or "")


def digests(text, ids):
    joined = " ".join(map(str, ids)).encode()
    return (
        len(ids), hashlib.sha256(joined).hexdigest(),
        hashlib.sha256((text or "").encode()).hexdigest(),
    )


def test_ids_are_those_of_the_usual_library(docs, sample, reference):
    pairs = [(d, t) for d, t, _ in sample[:80]] + [(10_000 + i, t) for i, t in enumerate(ODD)]
    pairs += [pairs[0], (None, "no id")]
    rows = encode(docs(pairs), PATH, PATTERN, ["doc_id"], outputs=True).collect()
    got = [(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows]
    want = [(d, *digests(t, reference(t))) for d, t in pairs]
    assert sorted(got, key=str) == sorted(want, key=str)
    texts = dict(pairs)
    for r in rows:
        if r["doc_id"] is not None:
            assert r["decoded"].decode() == (texts[r["doc_id"]] or "")
            assert [int(x) for x in r["ids"].split()] == reference(texts[r["doc_id"]])


def test_slices_and_forgetting_change_nothing(monkeypatch, reference, sample):
    texts = [t for _, t, _ in sample[:30]] + ODD
    monkeypatch.setattr(byte_bpe, "SLICE_WORDS", 50)
    monkeypatch.setattr(byte_bpe, "LONG_TEXT", 200)
    monkeypatch.setattr(byte_bpe, "CACHE_WORDS", 300)
    monkeypatch.setattr(byte_bpe, "BATCH_WORDS", 40)
    byte_bpe._databases.clear()
    got = code_texts(texts, PATH, PATTERN, False)
    byte_bpe._databases.clear()
    assert got == [digests(t, reference(t)) for t in texts]


@pytest.mark.parametrize("merge", [byte_bpe._MERGE, byte_bpe._MERGE_LONG])
@pytest.mark.parametrize("rows", [300, 10**7])
def test_both_queries_give_the_ids_of_the_usual_library(sample, reference, monkeypatch, merge, rows):
    monkeypatch.setattr(byte_bpe, "ROUND_ROWS", rows)
    words = [w for _, t, _ in sample[:10] for w in (t or "").split() if w.isalpha()][:400]
    words += ["aaaaaaa", "hahahahahaha", "xxxxy" * 9, "mississippimississippi", "é" * 9 + "ab" * 8]
    words = list(dict.fromkeys(words))
    ids, data = BpeDatabase(PATH).merged([w.encode() for w in words], merge)
    assert data == [w.encode() for w in words]
    assert [[int(i) for i in x.split()] for x in ids] == [reference(w) for w in words]


def test_long_words(reference):
    draw = random.Random(6)
    words = ["".join(draw.choices("abcdefghij", k=5000)), "x" * 100_000, "ab" * 30_000, "ü" * 2000]
    words += ["".join(draw.choices("eta", k=n)) for n in (63, 64, 65, 200)]
    got = code_texts(words, PATH, PATTERN, False)
    assert got == [digests(w, reference(w)) for w in words]


def test_empty_table(docs):
    assert encode(docs([]), PATH, PATTERN, ["doc_id"]).collect() == []


def test_clashing_columns(spark, tmp_path):
    path = str(tmp_path / "clash")
    layout = "doc_id long, text string, w int, k int, ids int, data int, _text int"
    spark.createDataFrame([(1, "some words", 2, 3, 4, 5, 6), (2, None, 2, 3, 4, 5, 6)], layout).write.parquet(path)
    keep = ["doc_id", "w", "k", "ids", "data", "_text"]
    rows = encode(spark.read.parquet(path), PATH, PATTERN, keep).collect()
    assert sorted(tuple(r[c] for c in keep) for r in rows) == [(1, 2, 3, 4, 5, 6), (2, 2, 3, 4, 5, 6)]
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {1: 2, 2: 0}
