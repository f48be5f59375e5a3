import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from meterlake.session import stored
from tests.llm.conftest import DOC_SCHEMA
from tests.llm.test_exact_dedup import brute as exact_groups
from tests.llm.test_pii import base_spans
from tests.llm.test_shingle_join import brute as near_groups

FOLDER = "/root/testdata/sf0.001"


def test_every_stage_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "near_dedup", "pii", "packing",
    ]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        rows = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.count() == len(rows)
        pairs = list(kept.items())
        if name == "language_id":
            # real texts are kept, and texts without letters are not
            letters = {d for d, t in pairs if t and any(c.isalpha() for c in t)}
            assert set(rows) <= letters and len(rows) >= 0.99 * len(letters)
        elif name == "exact_dedup":
            assert set(rows) == {keep for _, keep, _, _ in exact_groups(pairs)}
        elif name == "near_dedup":
            assert set(rows) == {component for _, _, component in near_groups(pairs)}
        else:
            assert set(rows) == set(kept)
            for doc_id, text in rows.items():
                before = base_spans(kept[doc_id])
                assert before or text == kept[doc_id]
                assert all(kept[doc_id][slice(*map(int, s.split(":")[1:]))] not in text for s in before)
        if name != "pii":
            assert all(rows[d] == kept[d] for d in rows)
        kept = rows
    packed = corpus_pipeline.packing(spark, docs, FOLDER).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in kept.items()}
    got = dict.fromkeys(want, 0)
    for r in packed:
        got[r["doc_id"]] += r["length"]
    assert got == want


def test_run_writes_and_returns_the_last_stage(spark, tmp_path):
    text = "the words of a text that is long enough to be one of a kind in this table"
    rows = [
        (1, text, "en", "a", 1), (2, text.replace(" ", "\n"), "en", "a", 1), (3, None, None, None, None),
        (4, "12 34", None, "b", 5), (5, f"{text} more", "en", "a", 1), (6, "", "en", "a", 0),
        (7, "another one, write to a@b.co or +49 30 1234567", "en", "c", 1),
    ]
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, DOC_SCHEMA).write.parquet(f"{path}/documents.parquet")
    found = corpus_pipeline.run(spark, path)
    assert sorted(r["doc_id"] for r in found.collect()) == [1, 7]
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([], DOC_SCHEMA).write.parquet(f"{path}/documents.parquet")
    found = corpus_pipeline.run(spark, path)
    assert found.agg(F.count("*")).first()[0] == 0
    assert {"doc_id", "sequence_id", "offset"} <= set(found.columns)
