"""Byte-level BPE with recursive DuckDB queries, one database per Python worker."""

from __future__ import annotations

import base64
import hashlib
from collections import ChainMap
from collections.abc import Iterator
from itertools import islice

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructType

from meterlake.llm.common import fresh

# Texts are worked on in slices of about so many words, and words merged in batches.
SLICE_WORDS = 400_000
BATCH_WORDS = 40_000
LONG_TEXT = 1 << 22
# Words of one worker are remembered in two halves of together this many: when the newer
# one is full, the older one is forgotten. Longer words are not remembered.
CACHE_WORDS = 400_000
CACHE_BYTES = 64
# Longer words contract all pairs of a rank in a round where that is the same. A query
# ends when its rounds have made about so many rows, and the next one goes on.
SHORT_WORD = 64
BATCH_BYTES = 1 << 18
ROUND_ROWS = 4_000_000

# Rows of `tokens` are k = word * 2^32 + position and a token id. `merges` has the id of
# every pair whose joined bytes are a token. In each round every word that has such a
# pair contracts the leftmost of those with the least id. Words without one are not
# carried on, so the rounds end with the last of them. `state` has every word's last round.
_LAST = """
), last AS (
    SELECT k >> 32 AS w, max(round) AS round FROM step GROUP BY k >> 32
)
SELECT last.w, k, id, last.round AS round
FROM step JOIN last ON last.w = k >> 32 AND last.round = step.round
"""
_MERGE = f"""
CREATE OR REPLACE TEMP TABLE state AS
WITH RECURSIVE step AS (
    SELECT k, id, 0 AS round FROM tokens
    UNION ALL (
        WITH best AS (
            SELECT a.k >> 32 AS w, min(joined << 32 | (a.k & 4294967295)) AS pick
            FROM step a
            JOIN step b ON b.k = a.k + 1
            JOIN merges ON pair = a.id << 32 | b.id
            GROUP BY a.k >> 32
        )
        SELECT CASE WHEN (k & 4294967295) > (pick & 4294967295) THEN k - 1 ELSE k END,
               CASE WHEN (k & 4294967295) = (pick & 4294967295) THEN pick >> 32 ELSE id END,
               round + 1
        FROM step JOIN best ON w = k >> 32
        WHERE (k & 4294967295) <> (pick & 4294967295) + 1 AND round < $rounds
    )
{_LAST}"""
# The same for long words, whose positions keep gaps. Where no pair with the joined token
# has a lesser id, the next leftmost pair of least id is another of the same two tokens:
# then all of these are contracted at once, in a run of one token every second pair.
_MERGE_LONG = f"""
CREATE OR REPLACE TEMP TABLE state AS
WITH RECURSIVE step AS (
    SELECT k, id, 0 AS round FROM tokens
    UNION ALL (
        WITH line AS (
            SELECT k, id, round, k >> 32 AS w, lead(k) OVER o AS after, lead(id) OVER o AS next,
                   row_number() OVER o AS i
            FROM step WINDOW o AS (ORDER BY k)
        ), pairs AS (
            SELECT k, after, i, w, joined, safe, id = next AS twin
            FROM line JOIN merges ON pair = id << 32 | next
            WHERE after >> 32 = w
        ), best AS (
            SELECT w, min(joined) AS least FROM pairs GROUP BY w
        ), hits AS (
            SELECT pairs.*, row_number() OVER (PARTITION BY pairs.w ORDER BY k) AS n
            FROM pairs JOIN best ON pairs.w = best.w AND joined = least
        ), chosen AS (
            SELECT k, after, joined FROM hits WHERE n = 1 OR safe AND NOT twin
            UNION
            SELECT k, after, joined FROM (
                SELECT *, row_number() OVER (PARTITION BY w, i - n ORDER BY k) AS place
                FROM hits WHERE safe AND twin
            ) WHERE place % 2 = 1
        )
        SELECT line.k, coalesce(joined, id), round + 1
        FROM line JOIN best ON line.w = best.w LEFT JOIN chosen ON chosen.k = line.k
        ANTI JOIN chosen AS gone ON gone.after = line.k
        WHERE round < $rounds
    )
{_LAST}"""
_CODED = """
SELECT w, list(id ORDER BY k) AS ids, list(data ORDER BY k) AS data
FROM coded JOIN ranks USING (id) GROUP BY w
"""


class BpeDatabase:
    """Ranks and merges in DuckDB, and the words merged so far."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {
                base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)
            }
        if not all(0 <= rank < 1 << 31 for rank in self.ranks.values()):
            raise ValueError("ranks are numbers of at most 31 bits")
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.decimal = {rank: str(rank).encode() for rank in self.ranks.values()}
        pairs, joined = [], []
        least: dict[int, int] = {}
        for data, rank in self.ranks.items():
            for i in range(1, len(data)):
                a, b = self.ranks.get(data[:i]), self.ranks.get(data[i:])
                if a is not None and b is not None:
                    pairs.append(a << 32 | b)
                    joined.append(rank)
                    for part in (a, b):
                        least[part] = min(rank, least.get(part, rank))
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        safe = [least.get(rank, rank + 1) > rank for rank in joined]
        self._load("merges", pair=pairs, joined=joined, safe=safe)
        self._load("ranks", id=list(self.ranks.values()), data=list(self.ranks))
        # ids in decimal with spaces between, and the ids' bytes, of each word
        self.ids: dict[str, bytes] = {}
        self.data: dict[str, bytes] = {}
        self.older: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})

    def _load(self, name: str, **columns) -> None:
        self.con.register("given", pa.table(columns))
        self.con.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM given").fetchall()
        self.con.unregister("given")

    def merged(self, words: list[bytes], merge: str = _MERGE) -> tuple[list[bytes], list[bytes]]:
        """For each word its ids, in decimal with spaces between, and the ids' bytes."""
        n = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        word = np.repeat(np.arange(len(words)), n)
        place = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
        ids = self.byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        self._load("tokens", k=word << 32 | place, id=ids)
        con = self.con
        con.execute("CREATE OR REPLACE TEMP TABLE coded (w BIGINT, k BIGINT, id BIGINT)").fetchall()
        left = len(word)
        while left:
            rounds = max(4, ROUND_ROWS // left)
            con.execute(merge, {"rounds": rounds}).fetchall()
            con.execute(
                "INSERT INTO coded SELECT w, k, id FROM state WHERE round < $rounds",
                {"rounds": rounds},
            ).fetchall()
            con.execute(
                "CREATE OR REPLACE TEMP TABLE tokens AS SELECT"
                " (k >> 32) << 32 | row_number() OVER (PARTITION BY w ORDER BY k) AS k, id"
                " FROM state WHERE round >= $rounds",
                {"rounds": rounds},
            ).fetchall()
            left = con.execute("SELECT count(*) FROM tokens").fetchall()[0][0]
        found = con.sql(_CODED).to_arrow_table().combine_chunks()
        ids, data = (found.column(c).chunk(0) for c in ("ids", "data"))
        order = np.empty(len(words), dtype=np.int64)
        order[found.column("w").to_numpy()] = np.arange(len(words))
        first, last = ids.offsets.to_numpy()[order], ids.offsets.to_numpy()[order + 1]
        said = [*map(self.decimal.__getitem__, ids.values.to_numpy().tolist())]
        # a word's bytes are those of its tokens in order, one after the other
        blob = data.values
        ends = np.frombuffer(blob.buffers()[1], dtype=np.int32)[blob.offset :]
        spelled = blob.buffers()[2].to_pybytes()
        starts = data.offsets.to_numpy()
        cut = zip(ends[starts[order]].tolist(), ends[starts[order + 1]].tolist(), strict=True)
        runs = zip(first.tolist(), last.tolist(), strict=True)
        return [b" ".join(said[a:b]) for a, b in runs], [spelled[a:b] for a, b in cut]

    def resolve(self, words: set[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """Learn the ids and bytes of all `words`; those that are not remembered are
        returned. A word that is a token is that token, as it is to the usual encoders.
        """
        if len(self.ids) > CACHE_WORDS // 2:
            self.older = self.ids, self.data
            self.ids, self.data = {}, {}
        unknown = [w for w in words if w not in self.ids]
        again = [w for w in unknown if w in self.older[0]]
        for known, old in zip((self.ids, self.data), self.older, strict=True):
            known.update(zip(again, map(old.__getitem__, again), strict=True))
        new = [(w, w.encode("utf-8", "replace")) for w in unknown if w not in self.ids]
        kept: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})

        def learn(batch: list[tuple[str, bytes]], ids: list[bytes], data: list[bytes]) -> None:
            for (word, spelled), i, d in zip(batch, ids, data, strict=True):
                to = (self.ids, self.data) if len(spelled) <= CACHE_BYTES else kept
                to[0][word], to[1][word] = i, d

        whole = [(w, d) for w, d in new if d in self.ranks]
        learn(whole, [self.decimal[self.ranks[d]] for _, d in whole], [d for _, d in whole])
        short = [(w, d) for w, d in new if len(d) <= SHORT_WORD and d not in self.ranks]
        for i in range(0, len(short), BATCH_WORDS):
            batch = short[i : i + BATCH_WORDS]
            learn(batch, *self.merged([d for _, d in batch]))
        batch, size = [], 0
        for word, data in new:
            if len(data) > SHORT_WORD and data not in self.ranks:
                batch.append((word, data))
                size += len(data)
                if size >= BATCH_BYTES:
                    learn(batch, *self.merged([d for _, d in batch], _MERGE_LONG))
                    batch, size = [], 0
        if batch:
            learn(batch, *self.merged([d for _, d in batch], _MERGE_LONG))
        return kept


_databases: dict[str, BpeDatabase] = {}


def database(path: str) -> BpeDatabase:
    """This worker's database for a rank file."""
    if path not in _databases:
        _databases.clear()
        _databases[path] = BpeDatabase(path)
    return _databases[path]


class _Coded:
    """What has been coded of one text so far."""

    def __init__(self, outputs: bool):
        self.ids, self.data = hashlib.sha256(), hashlib.sha256()
        self.n = 0
        self.kept: tuple[list[bytes], list[bytes]] | None = ([], []) if outputs else None

    def add(self, ids: bytes, data: bytes) -> None:
        if self.n:
            ids = b" " + ids
        else:
            self.n = 1
        self.n += ids.count(b" ")
        self.ids.update(ids)
        self.data.update(data)
        if self.kept:
            self.kept[0].append(ids)
            self.kept[1].append(data)

    def row(self) -> tuple:
        found = (self.n, self.ids.hexdigest(), self.data.hexdigest())
        return (*found, *(b"".join(x) for x in self.kept)) if self.kept else found


def _word_runs(text: str, pattern: regex.Pattern) -> Iterator[list[str]]:
    """The matches of a text, in one list or, if it is long, several."""
    if len(text) <= LONG_TEXT:
        yield pattern.findall(text)
        return
    words = (m.group() for m in pattern.finditer(text))
    while run := list(islice(words, SLICE_WORDS)):
        yield run


def code_texts(
    texts: list[str | None], path: str, pattern: str, outputs: bool
) -> list[tuple]:
    """(n, sha256 of the ids, sha256 of their bytes[, ids, bytes]) of each text."""
    bpe, split = database(path), regex.compile(pattern)
    done = [_Coded(outputs) for _ in texts]
    waiting: list[tuple[_Coded, list[str]]] = []
    size = 0

    def settle() -> None:
        new_ids, new_data = bpe.resolve(set().union(*(run for _, run in waiting)))
        for coded, run in waiting:
            ids, data = bpe.ids, bpe.data
            if new_ids and not new_ids.keys().isdisjoint(run):
                ids, data = ChainMap(new_ids, ids), ChainMap(new_data, data)
            coded.add(b" ".join(map(ids.__getitem__, run)), b"".join(map(data.__getitem__, run)))
        waiting.clear()

    for coded, text in zip(done, texts, strict=True):
        for run in _word_runs(text or "", split):
            if run:
                waiting.append((coded, run))
                size += len(run)
            if size >= SLICE_WORDS:
                settle()
                size = 0
    if waiting:
        settle()
    return [coded.row() for coded in done]


def encode(
    docs: DataFrame, path: str, pattern: str, keep: list[str], outputs: bool = False
) -> DataFrame:
    """Columns `keep` of `docs` with n_tokens, ids_sha256 and decoded_sha256 of its
    column text, and with ids (decimal, spaces between, as bytes) and decoded if
    `outputs`; `keep` has none of these names.

    `path` is a file of ranks, `pattern` splits a text into the words that are encoded
    separately. A null text is empty and has no ids. Repeated rows are encoded each, an
    empty table gives no rows. Every distinct word of a worker is merged once, and
    decoded from its ids; a text's ids and bytes are those of its words in order.
    """
    schema = StructType([docs.schema[c] for c in keep])
    schema.add("n_tokens", LongType()).add("ids_sha256", StringType())
    schema.add("decoded_sha256", StringType())
    kinds = [pa.int64(), pa.string(), pa.string()]
    if outputs:
        schema.add("ids", BinaryType()).add("decoded", BinaryType())
        kinds += [pa.binary(), pa.binary()]
    names = [f.name for f in schema]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = code_texts(batch.column(0).to_pylist(), path, pattern, outputs)
            columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
            made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made], names=names)

    text = fresh(docs, "text")
    return docs.select(F.col("text").alias(text), *keep).mapInArrow(coded, schema)
