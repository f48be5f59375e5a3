import numpy as np

from meterlake.llm.language import codewords, fit, has_letter, identify, keep_known, train
from tests.llm.conftest import DOC_SCHEMA


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 5, 8, 20):
        code = codewords(n)
        apart = (code.shape[1] - code @ code.T) / 2
        least = apart[~np.eye(n, dtype=bool)].min()
        assert least >= max(1, code.shape[1] // 3 if n > 5 else 2 ** (n - 2))


def test_held_out_documents_get_their_language(spark, stored_table, sample):
    rows = [(d, t, lang, "s", 0) for d, t, lang in sample]
    table = stored_table(rows, DOC_SCHEMA)
    said = identify(table, train(table), ["doc_id", "lang"]).collect()
    assert len(said) == len(rows)
    right = sum(r["lang"] == r["lang_pred"] for r in said)
    assert right >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in said)


def test_every_language_is_learned_however_many_there_are(stored_table):
    draw = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    rows = []
    for k in range(230):
        words = ["".join(draw.choice(letters, 5)) for _ in range(12)]
        rows += [
            (10 * k + i, " ".join(draw.choice(words, 40)), f"l{k:03d}", "s", 0) for i in range(8)
        ]
    table = stored_table(rows, DOC_SCHEMA)
    model = train(table)
    assert model.languages == sorted({r[2] for r in rows})
    said = identify(table, model, ["lang"]).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in said) >= 0.97 * len(rows)


def test_odd_texts_have_a_defined_answer(stored_table, sample):
    odd = [None, "", "123 !!", " \n", "é", "a " * 300_000, "漢字", "²"]
    rows = [(d, t, lang, "s", 0) for d, t, lang in sample[:80]]
    rows += [(None if i == 4 else 10_000 + i, t, None, None, None) for i, t in enumerate(odd)]
    table = stored_table(rows, DOC_SCHEMA)
    said = identify(table, train(table), ["doc_id", "text"]).collect()
    by_text = {r["text"]: r for r in said}
    for text in (None, "", "123 !!", " \n", "²"):
        assert (by_text[text]["lang_pred"], by_text[text]["score"]) == ("und", 0.0)
    for text in ("é", "a " * 300_000, "漢字"):
        assert by_text[text]["lang_pred"] != "und"
    kept = keep_known(table)
    assert kept.columns == table.columns
    texts = {r["text"] for r in kept.collect()}
    assert not texts & {None, "", "123 !!", " \n", "²"}
    assert {t for _, t, _ in sample[:80]} <= texts


def test_without_labels_nothing_is_known(stored_table):
    table = stored_table([(1, "some words", None, None, None)], DOC_SCHEMA)
    said = identify(table, train(table), ["doc_id"]).collect()
    assert [(r["lang_pred"], r["score"], r["ambiguous"]) for r in said] == [("und", 0.0, True)]
    empty = stored_table([], DOC_SCHEMA)
    assert identify(empty, fit([]), ["doc_id"]).collect() == []


def test_without_labels_texts_with_letters_are_kept(stored_table):
    texts = ["some words", "漢字", None, "", "12 ²!", "é"]
    table = stored_table([(i, t, None, "s", 1) for i, t in enumerate(texts)], DOC_SCHEMA)
    kept = keep_known(table)
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 5]


def test_one_language_is_always_the_answer(stored_table):
    rows = [(i, "the words of one tongue", "en", "s", 1) for i in range(20)]
    table = stored_table(rows, DOC_SCHEMA)
    said = identify(table, train(table), ["doc_id"]).collect()
    assert {(r["lang_pred"], r["score"]) for r in said} == {("en", 1.0)}


def test_letters_of_any_script():
    assert has_letter("1é") and has_letter("ß") and has_letter("漢")
    assert not has_letter("1²_-") and not has_letter("")
