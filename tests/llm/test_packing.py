import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from meterlake.llm.packing import best_fit, pack, plan, reduce_by_dominance, slots
from tests.llm.test_word_ids import ODD

PATH = public_tokenizers.path("word_bpe_49k.json")

def reference(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [
        np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4")
        for t in texts
    ]


@pytest.mark.parametrize("size", [60, 2048])
def test_pieces_fill_sequences_without_gaps(docs, sample, size):
    pairs = [(d, t) for d, t, _ in sample[:60]] + [(10_000 + i, t) for i, t in enumerate(ODD)]
    pairs += [pairs[0], (None, "again")]
    want = Counter()
    total = 0
    for (doc_id, _), ids in zip(pairs, reference([t for _, t in pairs]), strict=True):
        total += len(ids)
        for piece, start in enumerate(range(0, len(ids), size)):
            part = ids[start : start + size].tobytes()
            want[doc_id, piece, start, len(part) // 4, zlib.crc32(part), part] += 1
    found = pack(docs(pairs), PATH, ["doc_id"], size, with_ids=True).collect()
    got = Counter(
        (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"]))
        for r in found
    )
    assert got == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    assert len(sequences) <= total / size * 1.05 + 2


def test_special_tokens_and_clashing_columns(spark, tmp_path):
    path = str(tmp_path / "clash")
    layout = "doc_id long, text string, task int, place int, number int, ahead int, _task int"
    spark.createDataFrame([(1, "a<|endoftext|>b", 2, 3, 4, 5, 6)], layout).write.parquet(path)
    keep = ["doc_id", "task", "place", "number", "ahead", "_task"]
    rows = pack(spark.read.parquet(path), PATH, keep, with_ids=True).collect()
    assert [tuple(r[c] for c in keep) for r in rows] == [(1, 2, 3, 4, 5, 6)]
    assert np.frombuffer(rows[0]["ids"], dtype="<u4").tolist() == [320, 49407, 321, 0]


def test_ids_go_through_python_once(docs, sample):
    packed = pack(docs([(d, t) for d, t, _ in sample[:5]]), PATH, ["doc_id"], with_ids=True)
    said = packed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in said
    assert "InArrow" not in said and "Python" not in said


def test_slots_of_a_length_follow_without_gaps():
    random.seed(7)
    counts = Counter(random.randint(1, 60) for _ in range(500))
    entries = plan(dict(counts), 100)
    filled, used = Counter(), Counter()
    for length, first, until, times, sequence, offset in slots(entries).tolist():
        assert first == used[length] and times >= 1 and (until - first) % times == 0
        used[length] = until
        for nth in range(until - first):
            assert offset + nth % times * length + length <= 100
            filled[sequence + nth // times] += length
    assert used == counts
    assert len(filled) == sum(n for _, n in entries) and max(filled.values()) <= 100


def test_empty_table(docs):
    assert pack(docs([]), PATH, ["doc_id"]).collect() == []


def fewest(lengths, size):
    """The least number of sequences, by search."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for room in sorted(set(rooms)):
            if room >= lengths[i]:
                rest = list(rooms)
                rest.remove(room)
                place(i + 1, [*rest, room - lengths[i]])
        place(i + 1, [*rooms, size - lengths[i]])

    place(0, [])
    return best


def test_dominance_never_costs_a_sequence():
    random.seed(4)
    for _ in range(150):
        size = random.choice([7, 10, 15])
        lengths = [random.randint(1, size) for _ in range(random.randint(0, 8))]
        counts = dict(Counter(lengths))
        fixed = reduce_by_dominance(counts, size)
        rest = [x for x, n in counts.items() for _ in range(n)]
        assert sum(n for _, n in fixed) + fewest(rest, size) == fewest(lengths, size)


def test_plan_places_every_piece_once():
    random.seed(5)
    for _ in range(200):
        size = random.choice([5, 20, 100])
        counts = Counter(random.randint(1, size) for _ in range(random.randint(0, 60)))
        placed = Counter()
        for pattern, n in plan(dict(counts), size):
            assert sum(length * times for length, times in pattern) <= size
            for length, times in pattern:
                placed[length] += times * n
        assert placed == counts


def test_plan_stays_small_for_huge_counts():
    random.seed(6)
    counts = {x: random.randint(1, 10**9) for x in range(1, 2049)}
    entries = plan(dict(counts), 2048)
    least = sum(x * n for x, n in counts.items()) / 2048
    assert len(entries) < 3 * 2048
    assert sum(n for _, n in entries) < 1.01 * least
    assert len(best_fit({3: 10**12}, 2048)) <= 2
