import hashlib
import re

from meterlake.llm.boosting import boost, calibrated_threshold
from meterlake.llm.pii import KINDS, redact, summarised

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ODD = [
    "", None, "a@b.c..d@e.f x_y@z.q_w@r.s", "1.2.3.4.5.6.7.8.9 300.1.1.1 0255.1.1.1 1.2.3",
    "4785 3805 9239 1139 47853805923911394785380592391139 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7",
    "+1 (743) 555-3824 +1(((((2 +12345678. +1-----5555555-- +", "@a.b a@.b a@b a@b.",
    "😀é a@b.co 😀 1.2.3.4 😀 4785380592391139é@x.yz\n+49 (30) 123456", "1-2-3", "0 " * 30,
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text):
    spans = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and max(map(int, m.group().split("."))) > 255:
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            spans.append(f"{kind}:{m.start()}:{m.end()}")
    return spans


def test_base_spans_equal_the_patterns(docs, sample):
    pairs = [(d, t) for d, t, _ in sample] + [(10_000 + i, t) for i, t in enumerate(ODD)]
    pairs += [(10_002, ODD[2]), (None, ODD[3])]
    found = summarised(docs(pairs)).collect()

    def row(doc_id, text):
        spans = base_spans(text)
        digest = hashlib.sha256(",".join(spans).encode()).hexdigest()
        return (doc_id, *(sum(s.startswith(k + ":") for s in spans) for k in KINDS), digest)

    got = [(r["doc_id"], *(r[f"n_{k}"] for k in KINDS), r["base_sha256"]) for r in found]
    assert sorted(got, key=str) == sorted((row(*p) for p in pairs), key=str)
    texts = dict(pairs)
    for r in found:
        if r["doc_id"] is not None:
            assert set(base_spans(texts[r["doc_id"]])) <= set(r["spans"].split(",")) - {""}


def test_very_long_texts_take_no_longer_than_their_length(docs):
    chain = "x" * 50_000 + "@" + "a." * 5_000 + "b"
    texts = [chain, "1" * 100_000, "1." * 50_000, "+1" + "(" * 100_000, "a" * 200_000, "1 " * 50_000]
    found = {r["doc_id"]: r for r in summarised(docs(list(enumerate(texts)))).collect()}
    assert found[0]["spans"] == f"email:0:{len(chain)}"
    assert found[2]["n_ip"] == 12_500
    assert [found[i]["n_email"] + found[i]["n_card"] for i in (1, 3, 4, 5)] == [0] * 4


def test_trees_add_what_looks_like_base_spans(docs):
    number = "+49 (30) 1234{:03d}"
    pairs = [(i, f"words call {number.format(i)} and more words") for i in range(400)]
    pairs += [(1000 + i, f"in 20{i:02d} we sold 3 5 7 things, no {i}") for i in range(60)]
    pairs += [(2000, "words call +49 (30) 12 and more words")]
    spans = {r["doc_id"]: r["spans"] for r in summarised(docs(pairs)).collect()}
    assert all(spans[i].startswith("phone:11:") and "," not in spans[i] for i in range(400))
    assert all(spans[1000 + i] == "" for i in range(60))


def card(digits, i):
    body = f"{i * 7919:0{digits - 1}d}"[: digits - 1]
    body = "4" + body[1:]
    return next(body + c for c in "0123456789" if luhn(body + c))


def test_frequent_forms_that_only_loose_proposals_find_are_added(docs):
    def loose(i):
        number = card(15, i + 12_345_678_901)
        return [
            ("email", f"u{i}.x (at) host{i} (dot) org"),
            ("email", f"u{i}.x [at] host{i}.example.com"),
            ("phone", f"0{300 + i % 90} 555 {1000 + i}"),
            ("card", f"{number[:4]}.{number[4:10]}.{number[10:]}"),
            ("ip", f"10[.]{i % 256}[.]7[.]{i % 200}"),
        ]

    def other(i):
        bad = f"{int(card(15, i + 12_345_678_901)) + 1}"
        return ["host 10[.]999[.]7[.]1", f"order {bad}", f"on 2024-01-{10 + i % 20}", "me @ work. Then"]

    plain = [f"mail a{i}@b.co or call +49 (30) 1234{i:03d}" for i in range(400)]
    pairs = list(enumerate(plain))
    want = {}
    for i in range(400):
        for k, (kind, form) in enumerate(loose(i)):
            pairs.append((1000 + 10 * i + k, f"words use {form} and more"))
            want[pairs[-1][0]] = f"{kind}:10:{10 + len(form)}"
    for i in range(40):
        for k, form in enumerate(other(i)):
            pairs.append((9000 + 10 * i + k, f"words use {form} and more"))
            want[pairs[-1][0]] = ""
    spans = {r["doc_id"]: r["spans"] for r in summarised(docs(pairs)).collect()}
    assert {i: spans[i] for i in want} == want


def test_redaction_takes_spans_out_and_leaves_the_rest(stored_table):
    rows = [
        (1, "write a@b.co, now", 17, "k"), (2, None, None, "k"), (3, "", 0, None),
        (4, "clean 12 words", 14, "k"), (5, "é 1.2.3.4😀4785 3805 9239 1139!", 1, "k"),
        (5, "é 1.2.3.4😀4785 3805 9239 1139!", 1, "k"), (6, "+1 743 555 3824@x.yz", 2, "k"),
    ]
    table = stored_table(rows, "doc_id long, text string, n_chars long, row string")
    clean = redact(table)
    assert clean.columns == table.columns
    got = {r["doc_id"]: (r["text"], r["n_chars"], r["row"]) for r in clean.collect()}
    assert clean.count() == len(rows)
    assert got[1] == ("write [EMAIL], now", 18, "k")
    assert got[2] == (None, None, "k") and got[3] == ("", 0, None)
    assert got[4] == ("clean 12 words", 14, "k")
    assert got[5][0] == "é [IP]😀[CARD]!"
    assert got[6][0] == "[PHONE]"  # overlapping spans go together


def test_empty_table(docs):
    assert summarised(docs([])).collect() == []
    assert redact(docs([])).collect() == []


def test_boosting_learns_a_rule_of_two_features():
    rows = [((a, b), 90.0 * (a > 1 and b < 3) + 1, 90.0 * (not (a > 1 and b < 3)) + 1)
            for a in range(4) for b in range(5)]
    model = boost(rows)
    for (a, b), _, _ in rows:
        assert (model.score((a, b)) > 0.9) == (a > 1 and b < 3)
    assert boost([]).score((1, 1)) == 0.5


def test_threshold_holds_its_precision():
    scored = [(0.9, 50.0, 1.0), (0.8, 40.0, 9.0), (0.7, 1.0, 50.0)]
    assert calibrated_threshold(scored, 0.9, 20) == 0.8
    assert calibrated_threshold(scored, 0.99, 20) is None
    assert calibrated_threshold([], 0.9, 0) is None
