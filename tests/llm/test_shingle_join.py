import random
import re

import numpy as np
import pytest

from meterlake.llm.components import components
from meterlake.llm.shingle_join import drop_near_duplicates, near_duplicates
from meterlake.llm.shingles import shingle_set, word_hashes
from meterlake.llm.signature_tree import links_between, links_within
from tests.llm.conftest import DOC_SCHEMA


def brute_set(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    width = min(5, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if width else set()


def brute(pairs):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [brute_set(t) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(pairs):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(
        ((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(pairs, sets, strict=True))),
        key=str,
    )


def answer(table, **options):
    rows = near_duplicates(table, **options).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=str)


def variants(seed, n, words, edits):
    """Near copies of one text: some linked to each other, some only by way of others."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(400)}" for _ in range(words)]
    for _ in range(n):
        copy = list(base)
        for _ in range(draw.randrange(edits)):
            copy[draw.randrange(words)] = f"x{draw.randrange(10**6)}"
        yield " ".join(copy)


def test_components_equal_all_pairs(docs):
    texts = [t for s in range(6) for t in variants(s, 12, 60 + 20 * s, 7)]
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{passage} {' '.join(f'q{i}_{j}' for j in range(k))}" for i, k in enumerate(range(0, 60, 5))]
    texts += [
        None, "", " \t\n", "one two", "ONE  two", "one two three", "ÄB äb", "äB äb", "a b c d e",
        "a b c d e f", "same " * 1000, "same " * 2000, "word " * 4 + "x" * 50_000,
    ]
    pairs = list(enumerate(texts)) + [(3, texts[3]), (None, texts[4]), (None, "alone in here")]
    assert answer(docs(pairs)) == brute(pairs)


@pytest.mark.parametrize("rounds", [0, 2])
def test_clusters_of_many_blocks(docs, rounds, monkeypatch):
    import meterlake.llm.shingle_join as module

    monkeypatch.setattr(module, "BLOCK_DOCS", 16)
    texts = list(variants(11, 120, 80, 9)) + list(variants(12, 40, 80, 5))
    pairs = list(enumerate(texts))
    assert answer(docs(pairs), rounds=rounds) == brute(pairs)


def test_real_documents(docs, sample):
    pairs = [(d, t) for d, t, _ in sample]
    assert answer(docs(pairs)) == brute(pairs)


def test_one_document_of_each_component_stays(stored_table):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [
        (7, text, 1), (2, text + " more", 2), (2, text + " more", 3), (5, "other", 4), (6, None, 5),
        (8, None, 6),
    ]
    table = stored_table(rows, "doc_id long, text string, row int")
    kept = drop_near_duplicates(table)
    assert kept.columns == table.columns
    got = sorted(kept.collect())
    assert [r["doc_id"] for r in got] == [2, 5, 6, 8]


def test_empty_table(stored_table):
    assert near_duplicates(stored_table([], DOC_SCHEMA)).collect() == []


def test_shingles_are_those_of_the_words():
    text = "The  cat\tsat\non the MAT the cat sat on the mat"
    assert len(shingle_set(text)) == len(brute_set(text))
    assert (shingle_set("A b C d E") == shingle_set("a B c D e")).all()
    assert len(shingle_set("É b c d e x")) == 2
    assert (shingle_set("É b c d e") != shingle_set("é b c d e")).all()
    assert len(word_hashes(b"  ab  ba ab ")) == 3
    assert len(set(word_hashes(b"ab ba abab baba").tolist())) == 4
    draw = random.Random(1)
    words = {"".join(draw.choice("ab") for _ in range(draw.randrange(1, 18))) for _ in range(5000)}
    assert len(set(word_hashes(" ".join(words).encode()).tolist())) == len(words)


def linked(sets, labels, left=None):
    """Joined classes by comparing all pairs."""
    root = {x: x for x in labels.tolist()}
    for i in range(len(sets)):
        for j in range(i):
            if left is not None and left[i] == left[j]:
                continue
            both = len(np.intersect1d(sets[i], sets[j]))
            if 7 * both >= 3 * (len(sets[i]) + len(sets[j])):
                a, b = sorted((root[labels[i]], root[labels[j]]))
                root = {k: a if v == b else v for k, v in root.items()}
    return {k: v for k, v in root.items() if k != v}


def test_tree_finds_what_all_pairs_find():
    draw = np.random.default_rng(3)
    for trial in range(25):
        sets = []
        for _ in range(int(draw.integers(1, 8))):
            base = draw.integers(0, 2**63, size=int(draw.integers(1, 400)), dtype=np.uint64)
            for _ in range(int(draw.integers(1, 30))):
                keep = base[draw.random(len(base)) < draw.uniform(0.7, 1)]
                more = draw.integers(0, 2**63, size=int(draw.integers(0, 20)), dtype=np.uint64)
                sets.append(np.unique(np.concatenate([keep, more, base[:1]])))
        labels = draw.integers(0, len(sets), size=len(sets)) if trial % 2 else np.arange(len(sets))
        left = draw.random(len(sets)) < 0.4
        u, v = links_within(sets, labels)
        assert dict(zip(u.tolist(), v.tolist(), strict=True)) == linked(sets, labels)
        u, v = links_between(sets, labels, left)
        assert dict(zip(u.tolist(), v.tolist(), strict=True)) == linked(sets, labels, left)


def test_graph_components(spark):
    draw = random.Random(9)
    chain = [(i + 1, i) for i in range(40)]
    star = [(i, 100) for i in range(101, 180)]
    random_edges = [(draw.randrange(1001, 1200), draw.randrange(1000, 1001 + i)) for i in range(90)]
    edges = [(max(e), min(e)) for e in chain + star + random_edges if e[0] != e[1]]
    root = {x: x for e in edges for x in e}
    for u, v in edges:
        a, b = sorted((root[u], root[v]))
        root = {k: a if r == b else r for k, r in root.items()}
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r["u"]: r["v"] for r in got} == {k: r for k, r in root.items() if k != r}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
