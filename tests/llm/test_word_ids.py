import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from meterlake.llm import word_ids as module
from meterlake.llm.word_ids import WordIds

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", "  a b\x85c d é ́x ΑΣ ΌΣΟΣ. it's we'LL <|endoftext|> x\x1fy \x1c", "x" * 5000,
    "Été ŒUVRE Straße.*** «quoted» naïve's foo's. ŉ İx Ⅷ ªb µm ſt ĸ 1,5 a1.. b²! x…! don't.'",
    "İstanbul ǅ ﬁ 1234 a", "ḅ́  q᠎w​z", "don't's'tx '' ''s", None,
    "a<|endoftext|>b", "a<|EndOfText|>b <|startoftext|>", "Word word WORD. word, wOrd", " \n\t ",
    *(f"a{chr(c)}b c" for c in range(0x3100) if chr(c).isspace()),
]


def ids_of(encoder, texts):
    found = [None] * len(texts)
    for first, ids, bounds in encoder.encode(pa.array(texts, pa.string())):
        for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            assert found[first + i] is None
            found[first + i] = ids[a:b].tolist()
    return found


def test_ids_of_words_are_those_of_the_whole_text(sample, monkeypatch):
    tokenizer = Tokenizer.from_file(PATH)
    texts = ODD + [t for _, t, _ in sample[:120]] + ODD
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    encoder = WordIds(PATH)
    assert ids_of(encoder, texts) == want
    monkeypatch.setattr(module, "SLICE_CHARS", 3000)
    monkeypatch.setattr(module, "CACHE_STEMS", 100)
    monkeypatch.setattr(module, "STEMS_AT_ONCE", 7)
    assert ids_of(encoder, texts) == want
    assert len(encoder.recent) <= 100 + 3000


def test_special_tokens_are_ids_of_their_own():
    assert ids_of(WordIds(PATH), ["a<|endoftext|>b"]) == [[320, 49407, 321]]


def test_no_texts():
    assert ids_of(WordIds(PATH), []) == []


def test_memory_of_slices_is_handed_back(monkeypatch):
    freed = []

    class Pool:
        def release_unused(self):
            freed.append(1)

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    monkeypatch.setattr(module, "SLICE_CHARS", 1000)
    encoder = WordIds(PATH)
    ids_of(encoder, ["some words of a text"] * 500)
    assert len(freed) >= 10
    freed.clear()
    ids_of(encoder, ["some words", "a<|endoftext|>b"] * 30)
    assert len(freed) <= 2
