"""Ids of whole texts by a word-wise BPE tokenizer, each distinct word tokenized once."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Stems of one worker are remembered in two halves of this many: when the newer one is
# full, the older one is forgotten. Longer stems are not remembered.
CACHE_STEMS = 200_000
CACHE_LETTERS = 64
SLICE_CHARS = 1 << 22
# So many stems are tokenized by one call.
STEMS_AT_ONCE = 500
# White space to Python, not to the tokenizer: it would hide characters from it.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
# A word of plain letters, which stand for themselves once in lower case, whatever is
# around them, and the marks after it. The tokenizer splits before these marks; an
# apostrophe is not among them.
_MARKS = "".join(re.escape(c) for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
_PLAIN = f"^(?P<stem>[A-Za-zÀ-ÖØ-öø-įı-ňŊ-ž]+)(?P<tail>[{_MARKS}]*)$"
_WORD_END = "</w>"


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers have for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class WordIds:
    """Ids of texts, each distinct word of a slice put together once.

    The tokenizer drops white space and never joins across it, so the ids of a text are
    those of its words, one after the other. Nor does it join a letter with a mark after
    it, so a word's ids are those of its stem and of the marks at its end. Texts that
    hold a special token's string, or white space of another kind, are tokenized whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.whole_only = (*_SEPARATORS, *(t.content for t in added))
        # The model alone, for letters that need no preparation.
        self.stemmer = Tokenizer(self.tokenizer.model)
        self.stemmer.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.ends = np.zeros(self.size, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(_WORD_END)]] = True
        self.letters = _byte_letters()
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        """Ids of any text, by the tokenizer's own steps."""
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _tokenize_stems(self, stems: list[str]) -> dict[str, bytes]:
        """Ids of plain lower-case words, many by one call: an id that ends a word parts them."""
        found: dict[str, bytes] = {}
        for at in range(0, len(stems), STEMS_AT_ONCE):
            some = stems[at : at + STEMS_AT_ONCE]
            spelled = [
                s if s.isascii() else s.encode().decode("latin-1").translate(self.letters)
                for s in some
            ]
            said = self.stemmer.encode(" ".join(spelled), add_special_tokens=False).ids
            ids = np.array(said, dtype="<u4")
            last = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(last) != len(some):
                raise ValueError("this tokenizer's words do not end with a mark of their own")
            data, first = ids.tobytes(), 0
            for stem, end in zip(some, last.tolist(), strict=True):
                found[stem] = data[first:end]
                first = end
        return found

    def _stem_ids(self, stems: list[str]) -> list[bytes]:
        """Ids of each of some distinct stems."""
        ids = list(map(self.recent.get, stems))
        unknown = [i for i, x in enumerate(ids) if x is None]
        again = list(map(self.older.get, [stems[i] for i in unknown]))
        new = self._tokenize_stems([stems[i] for i, x in zip(unknown, again, strict=True) if x is None])
        for i, x in zip(unknown, again, strict=True):
            stem = stems[i]
            ids[i] = x or new[stem]
            if len(stem) <= CACHE_LETTERS:
                self.recent[stem] = ids[i]
        if len(self.recent) > CACHE_STEMS:
            self.recent, self.older = {}, self.recent
        return ids

    def _word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some distinct words, one after the other, and how many each has.

        A word of letters with marks after it has those of both, the letters in lower
        case; each distinct stem, tail and other word is tokenized once.
        """
        parts = pc.extract_regex(words, _PLAIN)
        plain = parts.is_valid().to_numpy(zero_copy_only=False)
        stems = pc.utf8_lower(pc.struct_field(parts, "stem")).filter(parts.is_valid())
        tails = pc.struct_field(parts, "tail").filter(parts.is_valid())
        stems, tails = stems.dictionary_encode(), tails.dictionary_encode()
        others = words.filter(pc.invert(parts.is_valid()))
        segments = [
            *self._stem_ids(stems.dictionary.to_pylist()),
            *map(self.whole, tails.dictionary.to_pylist()),
            *map(self.whole, others.to_pylist()),
            b"",
        ]
        first_tail = len(stems.dictionary)
        first_other = first_tail + len(tails.dictionary)
        picked = np.full((len(words), 2), len(segments) - 1)
        picked[plain, 0] = stems.indices.to_numpy(zero_copy_only=False)
        picked[plain, 1] = first_tail + tails.indices.to_numpy(zero_copy_only=False)
        picked[~plain, 0] = np.arange(first_other, len(segments) - 1)
        size = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments)) // 4
        flat = np.frombuffer(b"".join(segments), dtype="<u4")
        return gathered(flat, size, picked.ravel()), size[picked].sum(axis=1)

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts = pc.utf8_split_whitespace(texts)
        coded = parts.flatten().dictionary_encode()
        flat, size = self._word_ids(coded.dictionary)
        picked = coded.indices.to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(size[picked])])
        return gathered(flat, size, picked), ends[parts.offsets.to_numpy() - parts.offsets[0].as_py()]

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first text, ids, bounds) of slices of `texts` in order: text first + i of the
        slice has ids[bounds[i] : bounds[i + 1]]. Null texts are empty.
        """
        texts = texts.fill_null("")
        odd = pa.array(np.zeros(len(texts), dtype=bool))
        for mark in self.whole_only:
            odd = pc.or_(odd, pc.match_substring(texts, mark))
        chars = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        alone = odd.to_numpy(zero_copy_only=False)
        first = freed = 0
        while first < len(texts):
            if alone[first]:
                ids = np.frombuffer(self.whole(texts[first].as_py()), dtype="<u4")
                yield first, ids, np.array([0, len(ids)])
                first += 1
                continue
            before = chars[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(chars, before + SLICE_CHARS, "right")))
            others = np.flatnonzero(alone[first:last])
            last = first + int(others[0]) if len(others) else last
            yield first, *self._slice(texts.slice(first, last - first))
            first = last
            if chars[last - 1] - freed >= SLICE_CHARS // 2 or last == len(texts):
                # Arrow keeps what a slice has used; the worker's neighbours may need it
                pa.default_memory_pool().release_unused()
                freed = chars[last - 1]


def gathered(flat: np.ndarray, size: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """The runs `picked` of `flat`, which is runs of the lengths `size`, in that order."""
    first = np.cumsum(size) - size
    n = size[picked]
    ends = np.cumsum(n)
    at = np.arange(ends[-1] if len(ends) else 0)
    at += np.repeat(first[picked] - (ends - n), n)
    return flat[at]


_tokenizers: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """This worker's ids for a tokenizer file."""
    if path not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]
