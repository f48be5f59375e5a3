import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from meterlake.llm import spelling
from meterlake.llm.spelling import _fingerprints, roots_of, variants


def edited(word):
    """All words one code point apart that are made of a few letters."""
    letters = sorted(set(word)) + ["a", "q", "é"]
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    out |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return out - {word}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :]
    a, b = sorted((a, b), key=len)
    return a[i:] == b[i + 1 :]


def brute(rows, ratio=10):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}
    by_length = defaultdict(list)
    for w in counts:
        by_length[len(w)].append(w)
    form, out = {}, []
    for w, n in counts.items():
        around = [v for m in (-1, 0, 1) for v in by_length[len(w) + m] if near(w, v)]
        best = min(around, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= ratio * n:
            form[w] = best
        out.append((w, n, len(around)))
    found = set()
    for w, n, n_near in out:
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        found.add((w, f, root, n, n_near, counts[f] if f else None))
    return found


def answer(table, **options):
    rows = variants(table, **options).collect()
    found = {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(found) == len(rows)
    return found


def test_equals_brute_force(docs):
    draw = random.Random(4)
    base = ["aabbaaab", "strasse", "straßen", "ÉTUDIER", "étudier", "mmmmmmm", "abcabcabc", "question"]
    pool = list(base)
    for w in base:
        pool += draw.sample(sorted(edited(w.lower())), 12)
    for w in draw.sample(pool, 20):
        pool += draw.sample(sorted(edited(w)), 4)
    rows = []
    for d in range(300):
        rows.append((d, " ".join(draw.choices(pool, [1 / (i + 1) ** 1.3 for i in range(len(pool))], k=40))))
    rows += [(None, "Question, question!"), (7, None), (8, ""), rows[0], (301, "×÷×÷×÷×÷ ×÷×÷×÷×÷ short")]
    want = brute(rows)
    assert len({w[1] for w in want}) > 5 and any(w[2] != w[1] and w[1] for w in want)
    assert answer(docs(rows)) == want
    assert answer(docs(rows), ratio=3) == brute(rows, 3)


def test_real_words(docs, sample):
    rows = [(d, t) for d, t, _ in sample]
    assert answer(docs(rows)) == brute(rows)


@pytest.mark.parametrize("letters", [8, 9, 12])
def test_words_of_many_letters(docs, monkeypatch, letters):
    monkeypatch.setattr(spelling, "SPELLED_LETTERS", letters)
    draw = random.Random(9)
    pool = ["aabbaaabcc", "aaaaaaaaa", "questioned", "abababab"]
    for w in list(pool):
        pool += draw.sample(sorted(edited(w)), 25)
    rows = [(d, " ".join(draw.choices(pool, k=30))) for d in range(200)]
    assert answer(docs(rows)) == brute(rows)


def test_a_very_long_word(docs):
    long = "ab" * 20_000
    rows = [(1, f"{long} {long} {long[:-1]} {long[:-1]}"), (2, "c" * 300 + " " + "c" * 300)]
    found = answer(docs(rows))
    assert {(len(w), n, m) for w, _, _, n, m, _ in found} == {(40_000, 2, 1), (39_999, 2, 1), (300, 2, 0)}


def test_empty_tables(docs):
    assert answer(docs([])) == set()
    assert answer(docs([(1, None), (2, "some few words")])) == set()


def test_other_columns(spark, tmp_path):
    path = str(tmp_path / "clash")
    rows = [(1, "different different", 1, "x", 2)]
    spark.createDataFrame(rows, "n int, text string, word int, key string, form int").write.parquet(path)
    assert answer(spark.read.parquet(path), doc_id="n") == brute([(1, rows[0][1])])


def test_roots(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(13)] + [("x", "w3"), ("y", "z")]
    found = roots_of(spark.createDataFrame(links, "word string, root string")).collect()
    assert {r["word"]: r["root"] for r in found} == {a: "w13" for a, _ in links} | {"y": "z"}


def test_fingerprints_follow_rotations():
    def spelled(word):
        marked = word + "$"
        for i in range(len(marked)):
            yield marked[i + 1 :] + marked[: i + 1], None
            if i < len(word):
                yield marked[i + 1 :] + marked[:i], word[i]

    keys = {}
    for word in ("abcab", "abcb", "aacab", "bcaba", "aaaa", "aaaaa"):
        for (text, last), (key, found, _) in zip(spelled(word), _fingerprints(word), strict=True):
            assert last == found
            assert keys.setdefault(text, key) == key
    assert len(set(keys.values())) == len(keys)
