"""Spelling variants by permuterm rotations: words one code point apart, and their forms."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.session import stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
# One in so many (document, run) pairs has a letter taken out.
EDITED = 31
LEAST_LETTERS = 7
LEAST_COUNT = 2
RATIO = 10
TERMINATOR = "$"
# Rotations of words of more letters are told apart by fingerprints: written out they
# would take the square of the word's length.
SPELLED_LETTERS = 128
_PRIME, _BASE = 2**127 - 1, 0x5DEECE66D1B873593C6EF372FE94F82B
# Counts of a task are sent on when it has seen so many words, rows in batches of this.
FLUSH_WORDS = 200_000
BATCH_ROWS = 20_000
LONG_TEXT = 1 << 22


def lowered(run: str) -> str:
    """`run` with only A to Z in lower case."""
    return run.lower() if run.isascii() else run.translate(_LOWER)


def words_of(doc_id: str, text: str) -> Iterator[tuple[str, int]]:
    """The words of a text of at least `LEAST_LETTERS` code points, and how often."""
    if len(text) <= LONG_TEXT:
        runs = Counter(RUN.findall(text))
    else:
        runs = Counter(m.group() for m in RUN.finditer(text))
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in runs.items():
        if len(run) >= LEAST_LETTERS:
            word = lowered(run)
            h = zlib.crc32(word.encode(), start)
            if h % EDITED == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
                if len(word) < LEAST_LETTERS:
                    continue
            yield word, n


def word_counts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """word, n: every word of the texts that occurs `LEAST_COUNT` times or more.

    Each task adds up its own words before they are exchanged, so a word that is
    everywhere comes to its reducer once from each task.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def sent() -> pa.RecordBatch:
            made = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(made, names=["word", "n"])

        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            for i, t in zip(ids, texts, strict=True):
                for word, n in words_of(i or "", t or ""):
                    counts[word] += n
                if len(counts) > FLUSH_WORDS:
                    yield sent()
        yield sent()

    given = docs.select(F.col(doc_id).cast("string").alias("i"), F.col(text).alias("t"))
    found = given.mapInArrow(counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# --- rotations ------------------------------------------------------------------------


def rotations(words: DataFrame) -> DataFrame:
    """key, last, first, n: the rotations of each word with its terminator.

    A rotation that ends with the edited letter has that letter apart, in `last`: words
    that differ in it alone have one key. `first` says that the letter starts a run of
    its kind, so that taking out any of a run counts once. A rotation as a whole, with no
    `last`, is the key of the words that have a letter more in that place.
    """
    marked = F.concat("word", F.lit(TERMINATOR))
    each = words.select(
        "n", marked.alias("marked"), F.explode(F.sequence(F.lit(1), F.length(marked))).alias("i")
    )
    rest = F.expr("substring(marked, i + 1)")
    before = F.expr("substring(marked, 1, i - 1)")
    letter = F.expr("substring(marked, i, 1)")
    whole = each.select(
        F.concat(rest, before, letter).alias("key"), F.lit(None).cast("string").alias("last"),
        F.lit(False).alias("first"), "n",
    )
    skipping = each.where(letter != TERMINATOR).select(
        F.concat(rest, before).alias("key"), letter.alias("last"),
        ((F.col("i") == 1) | (F.expr("substring(marked, i - 1, 1)") != letter)).alias("first"), "n",
    )
    return whole.unionByName(skipping)


def _fingerprints(word: str) -> Iterator[tuple[str, str | None, bool]]:
    """(key, last, first) of a word's rotations, their text replaced by a polynomial of it
    modulo a prime of 127 bits, in time proportional to the word's length.
    """
    codes = [*map(ord, word), 1]
    size = len(codes)
    start, power = [0], [1]
    for c in codes:
        start.append((start[-1] * _BASE + c) % _PRIME)
        power.append(power[-1] * _BASE % _PRIME)
    for i in range(size):
        rest = start[size] - start[i + 1] * power[size - i - 1]
        yield f"{size}:{(rest * power[i + 1] + start[i + 1]) % _PRIME:x}", None, False
        if i < size - 1:
            first = i == 0 or codes[i] != codes[i - 1]
            key = f"{size - 1}:{(rest * power[i] + start[i]) % _PRIME:x}"
            yield key, word[i], first


def _long_rotations(words: DataFrame) -> DataFrame:
    """key, last, first, row: as `rotations`, of the numbered words with many letters."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*rows, strict=True)]
            kinds = (pa.string(), pa.string(), pa.bool_(), pa.int64())
            rows.clear()
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["key", "last", "first", "row"])

        rows: list[tuple] = []
        for batch in batches:
            for word, row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for found in _fingerprints(word):
                    rows.append((*found, row))
                    if len(rows) >= BATCH_ROWS:
                        yield sent()
        if rows:
            yield sent()

    return words.select("word", "row").mapInArrow(
        made, "key string, last string, first boolean, row long"
    )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[list[tuple]]]:
    """Rows with a key that others have too, key by key, from batches sorted by the first
    column. A group has at most one row for each letter and one without.
    """
    held: pa.RecordBatch | None = None

    def some(batch: pa.RecordBatch) -> Iterator[list[tuple]]:
        keys = batch.column(0)
        if len(keys) < 2:
            return
        same = pc.equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
        shared = pa.array([*same, False]), pa.array([False, *same])
        rows = batch.filter(pc.or_(*shared))
        group: list[tuple] = []
        for row in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            if group and group[0][0] != row[0]:
                yield group
                group = []
            group.append(row)
        if group:
            yield group

    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if not len(batch):
            continue
        keys = batch.column(0)
        mine = pc.not_equal(keys, keys[len(keys) - 1]).to_numpy(zero_copy_only=False)
        cut = int(mine.sum())  # sorted: the last key's rows are at the end
        held = batch.slice(cut)
        yield some(batch.slice(0, cut))
    if held is not None:
        yield some(held)


def _word(rotation: str) -> str:
    at = rotation.index(TERMINATOR)
    return rotation[at + 1 :] + rotation[:at]


def neighbours(group: list[tuple]) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words in this group, -n and text of the best of them) of each member.

    The words without the edited letter and with different ones are each other's near
    words; the group's word without a letter is near those where it starts a run. The
    best of the others is the group's best, or the second for the best itself: no pairs.
    """
    skipping = [(-n, _word(key + last), first) for key, last, first, n in group if last is not None]
    whole = [(-n, _word(key)) for key, last, _, n in group if last is None]
    ranked = sorted(s[:2] for s in skipping)[:2]
    for less, word, first in skipping:
        others = [r for r in ranked if r[1] != word][:1] + (whole if first else [])
        near = len(skipping) - 1 + (len(whole) if first else 0)
        if near:
            yield word, near, *min(others)
    firsts = [s[:2] for s in skipping if s[2]]
    for _, word in whole:
        if firsts:
            yield word, len(firsts), *min(firsts)


def _scanned(rows: DataFrame) -> DataFrame:
    """word, near, less, form: each key's contribution to each of its words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in _groups(batches):
            found = [x for group in groups for x in neighbours(group)]
            columns = list(zip(*found, strict=True)) or [()] * 4
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["word", "near", "less", "form"])

    dealt = rows.repartition("key").sortWithinPartitions("key", "last")
    return dealt.mapInArrow(scan, "word string, near long, less long, form string")


def _long_neighbours(words: DataFrame) -> DataFrame:
    """The same, a row for each near word, for words of many letters."""
    long = stored(
        words.where(F.length("word") >= SPELLED_LETTERS).select(
            "word", "n", F.monotonically_increasing_id().alias("row")
        ),
        "long_words",
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in _groups(batches):
            pairs = [
                (a[3], b[3])
                for group in groups
                for a in group
                for b in group
                if a[3] != b[3] and all(x[1] is not None or y[2] for x, y in ((a, b), (b, a)))
            ]
            made = [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(made, names=["row", "other"])

    pairs = (
        _long_rotations(long).repartition("key").sortWithinPartitions("key", "last")
        .mapInArrow(scan, "row long, other long")
    )
    others = long.select(F.col("row").alias("other"), F.col("word").alias("form"), (-F.col("n")).alias("less"))
    found = pairs.join(long.select("row", "word"), "row").join(others, "other")
    # fingerprints only propose; of two words that are both spelled out, the rest has it
    spelled = F.greatest(F.length("word"), F.length("form")) <= SPELLED_LETTERS
    return found.where(~spelled & (F.levenshtein("word", "form", 1) == 1)).select(
        "word", F.lit(1).cast("long").alias("near"), "less", "form"
    )


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of a table's texts.

    Words are runs of letters (A to Z and U+00C0 to U+00FF), A to Z in lower case, some of
    them with a letter taken out by a rule on the document's id, with at least
    `LEAST_LETTERS` code points and `LEAST_COUNT` occurrences. Near words differ by one
    code point that is put in, taken out or replaced. A word's form is its most frequent
    near word, of equal ones the first in code-point order, if that is `ratio` times as
    frequent as the word or more; its root is where forms lead. Null and empty texts have
    no words, a null id is an empty one; repeated rows count each; a table without words
    gives no rows. `docs` is a stored table and may have any other columns.

    Rotations are exchanged by key and sorted, and each key's rows scanned as one group,
    of one row a letter at most. Forms grow `ratio`-fold from step to step, so roots are
    found in a number of doublings that only a logarithm of a logarithm of the counts
    bounds.
    """
    words = stored(word_counts(docs, doc_id, text), "words")
    spelled = words.where(F.length("word") <= SPELLED_LETTERS)
    none = F.lit(None).cast("long").alias("less"), F.lit(None).cast("string").alias("form")
    own = words.select("word", "n", F.lit(0).cast("long").alias("near"), *none)
    parts = [_scanned(rotations(spelled)), _long_neighbours(words)]
    met = own
    for part in parts:
        met = met.unionByName(part.withColumn("n", F.lit(None).cast("long")))
    best = F.min(F.when(F.col("less").isNotNull(), F.struct("less", "form")))
    near = met.groupBy("word").agg(
        F.max("n").alias("n"), F.sum("near").alias("n_near"), best.alias("best")
    )
    leads = -F.col("best.less") >= ratio * F.col("n")
    found = stored(
        near.select(
            "word", "n", "n_near", F.when(leads, F.col("best.form")).alias("form"),
            F.when(leads, -F.col("best.less")).alias("form_n"),
        ),
        "near_words",
    )
    roots = roots_of(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def roots_of(links: DataFrame) -> DataFrame:
    """word, root: where the links of a forest lead, each round twice as far."""
    links = stored(links, "links")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(
            links.join(onward, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"),
                F.col("further").isNotNull().alias("moved"),
            ),
            "links",
        )
        links = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return links
