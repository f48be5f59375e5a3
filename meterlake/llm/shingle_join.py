"""Near duplicates by exact Jaccard similarity of word shingles, with signature trees.

The way from documents to classes, each step without losing a link:

1. Every text becomes a sorted set of 64-bit shingle hashes (`shingles`).
2. A set linked to another shares three quarters of its shingles with it. Sets with more
   than a quarter of their shingles found nowhere else are out. Half of the hash range
   is enough to prove that for nearly all of them, so only that half is exchanged.
3. Of the rest, equal sets are put together, shingles are ordered from rare to frequent,
   and each set keeps the first ones: two linked sets share one of those. Sets that
   share one are in one cluster.
4. Clusters, in blocks of bounded size, are searched by signature trees. Clusters of
   several blocks are dealt anew a few times, joined classes counting as one, and what
   has not joined the cluster's largest class then meets every other block.

All exchanges of steps 2 and 3 combine within a slice of documents first: a shingle that
a third of all documents hold is sent once a slice. Slices and parts of the hash range
are sent as packed arrays, one row each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import fresh, joined_by_row, numbered
from meterlake.llm.components import components
from meterlake.llm.shingles import shingle_set
from meterlake.llm.signature_tree import links_between, links_within
from meterlake.session import stored

SLICE_DOCS = 4096
SLICE_SHINGLES = 1 << 20
BLOCK_DOCS = 512
BLOCK_SHINGLES = 1 << 20
BIN_SHINGLES = 1 << 18
PARTS_PER_TASK = 4
# A part of the hash range has the shingles of about so much text, about a tenth of it in
# bytes.
PART_TEXT = 64 << 20
# Documents of a slice go through the exchange of its shingles in groups of this many.
GROUP_DOCS = 64
ROUNDS = 3
MANY = 0xFFFF
_HALF = np.uint64(1 << 63)


# --- packed arrays ---------------------------------------------------------------------


def _packed(*arrays: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _unpacked(data: pa.Buffer, *kinds: str) -> list[np.ndarray]:
    """Arrays of equal length, one after the other."""
    width = sum(np.dtype(k).itemsize for k in kinds)
    n = data.size // width
    found, at = [], 0
    for kind in kinds:
        found.append(np.frombuffer(data, dtype=kind, count=n, offset=at))
        at += n * np.dtype(kind).itemsize
    return found


def _short(hashes: np.ndarray, drop: int) -> tuple[np.ndarray, np.ndarray]:
    """48 bits of each hash in two arrays. Sets are told apart by them nowhere: two
    shingles with the same bits at worst count as one that is found more often."""
    key = hashes >> np.uint64(drop)
    return (key >> np.uint64(16)).astype("<u4"), (key & np.uint64(MANY)).astype("<u2")


def _whole(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return high.astype(np.uint64) << np.uint64(16) | low


def _bounds(parts: int, top: int) -> np.ndarray:
    """Where each part of the hashes below `top` begins, and the end."""
    cuts = [top * k // parts for k in range(parts)]
    return np.array(cuts, dtype=np.uint64)


def _cut(sorted_hashes: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """(part, first, last) of the parts that have hashes."""
    at = np.searchsorted(sorted_hashes, bounds).tolist() + [len(sorted_hashes)]
    return [(k, a, b) for k, (a, b) in enumerate(zip(at, at[1:], strict=False)) if a < b]


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.Table.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


class Slices:
    """Gathers documents of a task into slices of bounded size, numbered over all tasks."""

    def __init__(self) -> None:
        self.next = TaskContext.get().partitionId() << 32
        self.clear()

    def clear(self) -> None:
        self.rows: list[tuple] = []
        self.sets: list[np.ndarray] = []
        self.shingles = 0

    def add(self, row: tuple, shingles: np.ndarray) -> bool:
        """Whether the slice is full now."""
        self.rows.append(row)
        self.sets.append(shingles)
        self.shingles += len(shingles)
        return len(self.rows) >= SLICE_DOCS or self.shingles >= SLICE_SHINGLES

    def number(self) -> int:
        self.next += 1
        return self.next


# --- step 2: sets that may have a link ---------------------------------------------------

_SEEN = pa.schema(
    [("part", pa.int64()), ("slice", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()),
     ("idx", pa.int32()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
     ("data", pa.binary())]
)
_SEEN_SQL = (
    "part long, slice long, row long, doc_id long, idx int, n long, d1 long, d2 long, data binary"
)
_INFO = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()),
     ("d2", pa.int64()), ("maybe", pa.bool_())]
)
_INFO_SQL = "row long, doc_id long, n long, d1 long, d2 long, maybe boolean"


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    turned = (shingles ^ (shingles >> np.uint64(33))) * np.uint64(0xFF51_AFD7_ED55_8CCD)
    total = np.array([shingles.sum(dtype=np.uint64), turned.sum(dtype=np.uint64)])
    first, second = total.view(np.int64).tolist()
    return first, second


def _seen_rows(slice_: Slices, bounds: np.ndarray) -> Iterator[tuple]:
    """A slice's documents, and its shingles of the half range by part.

    A shingle has the number of the one set of the slice that holds it, or `MANY`.
    """
    number = slice_.number()
    place: dict[tuple, int] = {}
    own: list[np.ndarray] = []
    for at, ((row, doc_id), shingles) in enumerate(zip(slice_.rows, slice_.sets, strict=True)):
        key = (len(shingles), *_digest(shingles))
        if key not in place:
            place[key] = len(own)
            own.append(shingles[: np.searchsorted(shingles, _HALF)])
        # documents follow their slice, not a part, and are no group of their own
        group = (number << 7) + at // GROUP_DOCS
        yield -1 - group, number, row, doc_id, place[key], *key, None
    every = np.concatenate(own)
    of = np.repeat(np.arange(len(own), dtype="<u2"), [len(s) for s in own])
    order = np.argsort(every, kind="stable")
    every, of = every[order], of[order]
    new = np.ones(len(every), dtype=bool)
    new[1:] = every[1:] != every[:-1]
    first = np.flatnonzero(new)
    alone = np.diff(np.append(first, len(every))) == 1
    every, of = every[first], np.where(alone, of[first], MANY).astype("<u2")
    high, low = _short(every, 15)
    for part, a, b in _cut(every, bounds):
        data = _packed(high[a:b], low[a:b], of[a:b])
        yield part, number, None, None, None, None, None, None, data


def _seen(parts: int) -> Callable:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, slice_ = _bounds(parts, 1 << 63), Slices()

        def flushed() -> Iterator[pa.RecordBatch]:
            yield from _table(list(_seen_rows(slice_, bounds)), _SEEN).to_batches()
            slice_.clear()

        for batch in batches:
            texts, *rest = batch.columns
            rows = zip(*(c.to_pylist() for c in rest), strict=True)
            for row, text in zip(rows, texts, strict=True):
                if slice_.add(row, shingle_set(text.as_py())):
                    yield from flushed()
        if slice_.rows:
            yield from flushed()

    return of


def _counted_alone(part: pa.Table) -> pa.Table:
    """How many shingles of the part each set of each slice has for itself."""
    if part.column("data").null_count:
        return part
    slices = part.column("slice").to_pylist()
    found = [
        _unpacked(x.as_buffer(), "<u4", "<u2", "<u2") for x in part.column("data")
    ]
    key = np.concatenate([_whole(high, low) for high, low, _ in found])
    of = np.concatenate([x[2] for x in found])
    from_ = np.repeat(np.arange(len(found)), [len(x[2]) for x in found])
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = key[1:] == key[:-1]
    single = np.ones(len(key), dtype=bool)
    single[1:] &= ~same
    single[:-1] &= ~same
    alone = order[single]
    alone = alone[of[alone] != MANY]
    pairs, counts = np.unique(
        from_[alone].astype(np.int64) << 16 | of[alone], return_counts=True
    )
    cut = np.searchsorted(pairs, np.arange(len(found) + 1, dtype=np.int64) << 16)
    rows = []
    for k, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
        if a < b:
            data = _packed((pairs[a:b] & MANY).astype("<u2"), counts[a:b].astype("<u4"))
            rows.append((None, slices[k], None, None, None, None, None, None, data))
    return _table(rows, _SEEN)


def _judged(slice_: pa.Table) -> pa.Table:
    """Documents of a slice with `maybe`: at most a quarter of the set is its own."""
    alone = np.zeros(MANY, dtype=np.int64)
    for data in slice_.column("data"):
        if data.is_valid:
            of, counts = _unpacked(data.as_buffer(), "<u2", "<u4")
            alone[of] += counts
    docs = slice_.filter(slice_.column("data").is_null())
    idx, n = docs.column("idx").to_numpy(), docs.column("n").to_numpy()
    maybe = (n > 0) & (4 * alone[idx] <= n)
    return pa.Table.from_arrays(
        [*(docs.column(c) for c in _INFO.names[:-1]), pa.array(maybe)], schema=_INFO
    )


# --- step 3: clusters ------------------------------------------------------------------

_STAR = pa.schema(
    [("part", pa.int64()), ("slice", pa.int64()), ("data", pa.binary())]
)
_STAR_SQL = "part long, slice long, data binary"
_SETS = pa.schema(
    [("row", pa.int64()), ("slice", pa.int64()), ("n", pa.int64()), ("hashes", pa.binary())]
)
_SETS_SQL = "row long, slice long, n long, hashes binary"
_EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of documents, with the slice each belongs to."""
    slice_ = Slices()
    number = slice_.number()
    for batch in batches:
        texts, rows = batch.columns
        made = []
        for row, text in zip(rows.to_pylist(), texts, strict=True):
            shingles = shingle_set(text.as_py())
            made.append((row, number, len(shingles), shingles.tobytes()))
            if slice_.add((row,), shingles):
                number = slice_.number()
                slice_.clear()
        yield from _table(made, _SETS).to_batches()


def _sets_of(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype="<u8") for x in table.column("hashes")]


def _slice_counts(parts: int) -> Callable[[pa.Table], pa.Table]:
    def of(slice_: pa.Table) -> pa.Table:
        """How many sets of the slice hold each of its shingles, by part."""
        number = slice_.column("slice")[0].as_py()
        every, n = np.unique(np.concatenate(_sets_of(slice_)), return_counts=True)
        high, low = _short(every, 16)
        n = n.astype("<u2")
        return _table(
            [
                (part, number, _packed(high[a:b], low[a:b], n[a:b]))
                for part, a, b in _cut(every, _bounds(parts, 1 << 64))
            ],
            _STAR,
        )

    return of


def _totals(part: pa.Table) -> pa.Table:
    """For each slice, how many sets in all hold each of its shingles, in its order."""
    found = [_unpacked(x.as_buffer(), "<u4", "<u2", "<u2") for x in part.column("data")]
    key = np.concatenate([_whole(high, low) for high, low, _ in found])
    n = np.concatenate([x[2] for x in found])
    _, of = np.unique(key, return_inverse=True)
    total = np.bincount(of, weights=n)[of].astype("<u4")
    at = np.cumsum([0, *(len(x[2]) for x in found)])
    parts, slices = (part.column(c).to_pylist() for c in ("part", "slice"))
    return _table(
        [
            (parts[k], slices[k], _packed(total[a:b]))
            for k, (a, b) in enumerate(zip(at, at[1:], strict=False))
        ],
        _STAR,
    )


def _stars(parts: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def of(key: tuple, sets: pa.Table, totals: pa.Table) -> pa.Table:
        """Edges from each set to the least one of the slice with the same rare shingle,
        and these least ones, by shingle and part, to be joined with other slices'."""
        own, rows = _sets_of(sets), sets.column("row").to_numpy()
        every, local = np.unique(np.concatenate(own), return_counts=True)
        parts_of = totals.column("part").to_numpy()
        data = totals.column("data")
        total = np.concatenate(
            [_unpacked(data[int(k)].as_buffer(), "<u4")[0] for k in np.argsort(parts_of)]
        )
        tokens, docs = [], []
        for shingles, row in zip(own, rows, strict=True):
            at = np.searchsorted(every, shingles)
            held = total[at]
            n = len(shingles)
            first = np.lexsort((shingles, held))[: n - -(-3 * n // 4) + 1]
            first = at[first[held[first] > 1]]
            tokens.append(first)
            docs.append(np.full(len(first), row, dtype=np.int64))
        token, doc = np.concatenate(tokens), np.concatenate(docs)
        order = np.lexsort((doc, token))
        token, doc = token[order], doc[order]
        new = np.ones(len(token), dtype=bool)
        new[1:] = token[1:] != token[:-1]
        first = np.flatnonzero(new)
        least = np.repeat(doc[first], np.diff(np.append(first, len(token))))
        edges = np.unique(np.stack([doc, least], axis=1)[doc != least], axis=0)
        number = key[0].as_py()
        out = [(-1 - number, number, _packed(edges[:, 0], edges[:, 1]))]
        token, doc = token[first], doc[first]
        abroad = total[token] > local[token]
        token, doc = every[token[abroad]], doc[abroad].astype("<i8")
        out += [
            (part, None, _packed(token[a:b], doc[a:b]))
            for part, a, b in _cut(token, _bounds(parts, 1 << 64))
        ]
        return _table(out, _STAR)

    return of


def _joined_stars(part: pa.Table) -> pa.Table:
    """Edges from the least sets of slices to the least one of all, by shingle; the
    edges of one slice as they are."""
    if not part.column("slice").null_count:
        found = [_unpacked(x.as_buffer(), "<i8", "<i8") for x in part.column("data")]
        ends = [pa.array(np.concatenate([x[k] for x in found])) for k in (0, 1)]
        return pa.Table.from_arrays(ends, schema=_EDGES)
    found = [_unpacked(x.as_buffer(), "<u8", "<i8") for x in part.column("data")]
    token, doc = (np.concatenate([x[k] for x in found]) for k in (0, 1))
    order = np.lexsort((doc, token))
    token, doc = token[order], doc[order]
    new = np.ones(len(token), dtype=bool)
    new[1:] = token[1:] != token[:-1]
    first = np.flatnonzero(new)
    least = np.repeat(doc[first], np.diff(np.append(first, len(token))))
    edges = np.unique(np.stack([doc, least], axis=1)[doc != least], axis=0)
    return pa.Table.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], schema=_EDGES)


# --- step 4: links -----------------------------------------------------------------------


def _linked(bin_: pa.Table) -> pa.Table:
    """Joined labels from every block of a bin, each searched on its own."""
    greater, least = [], []
    keys = [bin_.column(c).to_numpy() for c in ("cluster", "block", "facing")]
    label, left = bin_.column("label").to_numpy(), bin_.column("is_left").to_numpy()
    sets = _sets_of(bin_)
    order = np.lexsort(keys[::-1])
    change = np.zeros(len(order), dtype=bool)
    for k in keys:
        change[1:] |= k[order][1:] != k[order][:-1]
    for block in np.split(order, np.flatnonzero(change)):
        if len(block) < 2:
            continue
        own = [sets[i] for i in block]
        if keys[2][block[0]] < 0:
            u, v = links_within(own, label[block])
        else:
            u, v = links_between(own, label[block], left[block])
        greater.append(u)
        least.append(v)
    columns = [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (greater, least)]
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_EDGES)


def _search(blocks: DataFrame) -> DataFrame:
    """Classes joined by the links found in blocks (cluster, block, facing, is_left,
    label, row, n) of a stored table; (u, v) as of `components`.

    Blocks are put into bins, so that small ones don't cost a group each.
    """
    total = blocks.agg(F.sum("n")).first()[0] or 0
    bins = int(total // BIN_SHINGLES) + 16
    key = F.pmod(F.xxhash64("cluster", "block", "facing"), F.lit(bins))
    found = blocks.groupBy(key.alias("bin")).applyInArrow(_linked, "u long, v long")
    return components(found)


def _relabelled(members: DataFrame, joined: DataFrame) -> DataFrame:
    """`members` (cluster, row, n, label) with each label's class."""
    above = joined.select(F.col("u").alias("label"), F.col("v").alias("least"))
    return stored(
        members.join(above, "label", "left").select(
            "cluster", "row", "n", F.coalesce("least", "label").alias("label")
        ),
        "members",
    )


def _blocks_of(members: DataFrame) -> DataFrame:
    """Clusters with how many blocks they need."""
    docs, shingles = F.count("*") / BLOCK_DOCS, F.sum("n") / BLOCK_SHINGLES
    return members.groupBy("cluster").agg(F.ceil(F.greatest(docs, shingles)).alias("blocks"))


def _undecided(members: DataFrame) -> DataFrame:
    """Members of clusters that still have several classes."""
    apart = members.groupBy("cluster").agg(
        F.min("label").alias("low"), F.max("label").alias("high")
    )
    apart = stored(apart.where("low < high").select("cluster"), "undecided")
    return stored(members.join(apart, "cluster"), "members")


def _dealt(members: DataFrame, seed: int) -> DataFrame:
    """Members in blocks of their cluster, by a hash of the row."""
    sizes = stored(_blocks_of(members), "sizes")
    block = F.pmod(F.xxhash64(F.lit(seed), "row"), F.col("blocks"))
    return members.join(sizes, "cluster").select(
        "cluster", "row", "n", "label", "blocks", block.alias("block")
    )


def _with_sets(blocks: DataFrame, sets: DataFrame) -> DataFrame:
    return stored(blocks.join(sets.select("row", "hashes"), "row"), "blocks")


def _classes(members: DataFrame, sets: DataFrame, rounds: int) -> DataFrame:
    """(row, label) of all members (cluster, row, n): label is the least row of those
    that links reach."""
    members = members.withColumn("label", F.col("row"))
    settled: list[DataFrame] = []
    one_side = [F.lit(-1).cast("long").alias("facing"), F.lit(False).alias("is_left")]
    for seed in range(rounds + 1):
        dealt = stored(_dealt(members, seed), "dealt")
        joined = _search(_with_sets(dealt.select("*", *one_side), sets))
        named = _relabelled(dealt, joined)
        large = dealt.where("blocks > 1").select("cluster").distinct()
        large = stored(large, "large")
        settled.append(named.join(large, "cluster", "left_anti"))
        members = named.join(large, "cluster", "left_semi")
        if large.isEmpty():
            break
        rest = _undecided(stored(members, "members"))
        left = rest.select("cluster").distinct()
        settled.append(members.join(stored(left, "left"), "cluster", "left_anti"))
        members = rest
        if members.isEmpty():
            break
    else:
        settled.append(_confronted(members, sets))
    result = settled[0]
    for part in settled[1:]:
        result = result.unionByName(part)
    return stored(result.select("row", "label"), "classes")


def _confronted(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Compare what is outside its cluster's largest class with the whole cluster.

    Two members not in one class are not both in the largest, so nothing is left out.
    """
    counts = members.groupBy("cluster", "label").count()
    largest = stored(
        counts.groupBy("cluster").agg(F.max_by("label", F.struct("count", "label")).alias("main")),
        "largest",
    )
    spread = stored(
        members.join(largest, "cluster").withColumn("outside", F.col("label") != F.col("main")),
        "spread",
    )
    every = stored(_dealt(spread.drop("main"), -1), "every")
    outside = stored(_dealt(spread.where("outside").drop("main"), -2), "outside")
    wide = every.groupBy("cluster").agg(F.max("blocks").alias("across"))
    deep = outside.groupBy("cluster").agg(F.max("blocks").alias("across"))
    left = outside.join(stored(wide, "wide"), "cluster").select(
        "cluster", "row", "n", "label", "block",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("across") - 1)).alias("facing"),
        F.lit(True).alias("is_left"),
    )
    right = every.join(stored(deep, "deep"), "cluster").select(
        "cluster", "row", "n", "label",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("across") - 1)).alias("other"),
        F.col("block").alias("facing"),
        F.lit(False).alias("is_left"),
    ).withColumnRenamed("other", "block")
    joined = _search(_with_sets(left.unionByName(right.select(*left.columns)), sets))
    return _relabelled(members, joined)


# --- the operator ------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: row, doc_id, n_shingles, component_id, first_row.

    `docs` is a stored table with doc_id and text; other columns are not read. `row` is
    its number, as of `numbered`. Two documents link when the Jaccard similarity of
    their shingle sets is three quarters or more; component_id is the smallest doc_id
    that links reach, first_row the first row read with that id there. Null and empty
    texts, and white space alone, have no shingles and link with nothing; repeated rows
    link. Null ids count only where a component has no other. An empty table gives no
    rows.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(PARTS_PER_TASK * width, -(-size // PART_TEXT))
    rows = numbered(docs.select("text", "doc_id"), "row").select(
        "text", "row", F.col("doc_id").cast("long").alias("doc_id")
    )
    info = stored(
        rows.mapInArrow(_seen(parts), _SEEN_SQL)
        .groupBy("part").applyInArrow(_counted_alone, _SEEN_SQL)
        .groupBy("slice").applyInArrow(_judged, _INFO_SQL),
        "seen",
    )
    digest = ["n", "d1", "d2"]
    groups = stored(
        info.where("n > 0").groupBy(*digest).agg(
            F.min("row").alias("rep"),
            F.min("doc_id").alias("least_id"),
            F.min_by("row", F.coalesce("doc_id", F.lit(2**63 - 1))).alias("least_row"),
            F.max("maybe").alias("maybe"),
        ),
        "groups",
    )
    labels = _labels(spark, rows, groups.where("maybe"), parts, rounds)
    named = groups.join(
        labels.select(F.col("row").alias("rep"), "label"), "rep", "left"
    ).withColumn("label", F.coalesce("label", "rep"))
    named = stored(named, "named")
    order = F.coalesce("least_id", F.lit(2**63 - 1))
    answers = stored(
        named.groupBy("label").agg(
            F.min("least_id").alias("component_id"),
            F.min_by("least_row", order).alias("first_row"),
        ),
        "answers",
    )
    by_digest = stored(
        named.join(answers, "label").select(*digest, "component_id", "first_row"), "by_digest"
    )
    found = info.join(by_digest, digest, "left")
    linked = F.col("n") > 0
    return found.select(
        "row", "doc_id", F.col("n").alias("n_shingles"),
        F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(linked, F.col("first_row")).otherwise(F.col("row")).alias("first_row"),
    )


def _labels(
    spark: SparkSession, rows: DataFrame, groups: DataFrame, parts: int, rounds: int
) -> DataFrame:
    """(row, label) of the sets that may have links; steps 3 and 4."""
    picked = stored(groups.select(F.col("rep").alias("row")), "picked")
    texts = joined_by_row(rows.select("row", "text"), picked, "row").select("text", "row")
    sets = stored(texts.mapInArrow(_set_rows, _SETS_SQL), "sets")
    totals = (
        sets.groupBy("slice").applyInArrow(_slice_counts(parts), _STAR_SQL)
        .groupBy("part").applyInArrow(_totals, _STAR_SQL)
    )
    stars = (
        sets.groupBy("slice").cogroup(totals.groupBy("slice"))
        .applyInArrow(_stars(parts), _STAR_SQL)
        .groupBy("part").applyInArrow(_joined_stars, "u long, v long")
    )
    clusters = components(stars)
    clustered = clusters.select(F.col("u").alias("row"), F.col("v").alias("cluster"))
    heads = clusters.select(F.col("v").alias("row"), F.col("v").alias("cluster")).distinct()
    members = stored(
        clustered.unionByName(heads).join(sets.select("row", "n"), "row"), "members"
    )
    return _classes(members, sets, rounds)


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """`docs` with one document of each component, the one with the smallest doc_id;
    all its columns stay."""
    row = fresh(docs, "row")
    gone = near_duplicates(docs).where("row <> first_row")
    gone = stored(gone.select(F.col("row").alias(row)), "gone")
    return joined_by_row(numbered(docs, row), gone, row, "left_anti").drop(row)
