"""Personal data: base patterns, loose generators, and boosted trees that choose."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterlake.llm.boosting import Boosted, boost, calibrated_threshold
from meterlake.llm.common import BROADCAST_ROWS, fresh, numbered
from meterlake.session import stored

KINDS = ("email", "ip", "card", "phone")

# The base patterns, with possessive repeats and look-behinds that change
# no match but make a failing attempt cost no more than its own characters.
BASE = {
    "email": (
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@"
        r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
    ),
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# High recall: the same things as people also write them.
LOOSE = {
    "email": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|[\[(]at[\])])\x20?"
        r"[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]++)++"
    ),
    "ip": (
        r"(?<![0-9.])[0-9]{1,4}+(?:\x20?(?:\.|[\[(](?:\.|dot)[\])])\x20?[0-9]{1,4}+){3}"
        r"(?!\.?[0-9])"
    ),
    "card": r"(?<![0-9A-Za-z])[0-9]{4}+(?:[\x20._/-]?[0-9]){9,16}+(?![0-9A-Za-z])",
    "phone": (
        r"(?<![0-9A-Za-z])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,5}\)?){2,5}"
        r"(?![0-9A-Za-z])"
    ),
}
# Without one of these a text has nothing of the kind.
HINT = {
    "email": r"@|[\[(]at[\])]",
    "ip": r"[0-9][^0-9]{1,7}[0-9]",
    "card": r"[0-9](?:[\x20._/-]?[0-9]){12}",
    "phone": r"[0-9][\x20./)(-]{1,3}[0-9]",
}
BASE_HINT = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){15}",
    "phone": r"\+[0-9]",
}
# Words near personal data, by kind.
CUES = {
    "email": r"(?i)mail|contact|write",
    "ip": r"(?i)\bip\b|host|server|address",
    "card": r"(?i)card|visa|pay|credit",
    "phone": r"(?i)phone|tel\b|call|mobile|fax",
}
CONTEXT = 32
FEATURES = ["kind_no", "digits", "groups", "length", "left", "right", "cue", "style"]
PRECISION = 0.9
LEAST_CANDIDATES = 20


@dataclass(frozen=True)
class PiiModel:
    """Boosted trees and, per kind, the score from which a candidate counts."""

    trees: Boosted
    thresholds: dict[str, float]


def _matches(text: Column, pattern: str, hint: str) -> Column:
    """Matches of `pattern`, each with what stands between it and the one before.

    Pattern and split find the same matches, so gap and match lengths add up to
    positions in code points.
    """
    none = F.array().cast("array<string>")
    maybe = text.rlike(hint)
    found = F.when(maybe, F.regexp_extract_all(text, F.lit(f"({pattern})"))).otherwise(none)
    gaps = F.when(F.size(found) > 0, F.split(text, pattern, -1)).otherwise(none)
    return F.arrays_zip(
        found.alias("found"),
        F.slice(gaps, 1, F.size(found)).alias("gap"),
        F.slice(gaps, 2, F.size(found)).alias("next"),
    )


def _proposal(no: int, base: bool) -> Callable[[Column, Column], Column]:
    def made(match: Column, nth: Column) -> Column:
        return F.struct(
            F.lit(no).alias("kind_no"),
            F.lit(base).alias("base"),
            nth.alias("nth"),
            match["found"].alias("found"),
            F.length(match["gap"]).alias("gap"),
            F.length(match["found"]).alias("length"),
            F.right(match["gap"], F.lit(CONTEXT)).alias("before"),
            F.substring(match["next"], 1, 1).alias("after"),
        )

    return made


def _candidates(rows: DataFrame) -> DataFrame:
    """(row, fold, kind_no, base, found, start, stop, before, after) of every proposal.

    `rows` has row, fold and text. Only the proposals are shuffled, by row.
    """
    per_kind = []
    text = F.col("text")
    for base, patterns, hints in ((True, BASE, BASE_HINT), (False, LOOSE, HINT)):
        for no, kind in enumerate(KINDS):
            found = _matches(text, patterns[kind], hints[kind])
            per_kind.append(F.transform(found, _proposal(no, base)))
    proposals = (
        rows.select("row", "fold", F.explode(F.concat(*per_kind)).alias("p"))
        .select("row", "fold", "p.*")
        .repartition("row")
    )
    so_far = (
        Window.partitionBy("row", "base", "kind_no")
        .orderBy("nth")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    stop = F.sum(F.col("gap").cast("long") + F.col("length")).over(so_far)
    return proposals.withColumn("stop", stop).select(
        "row", "fold", "kind_no", "base", "found",
        (F.col("stop") - F.col("length")).alias("start"), "stop", "before", "after",
    )


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes: every second from the right counts double."""
    doubled = F.translate(digits, "0123456789", "0246813579")
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda sum_, i: sum_
        + F.substring(
            F.when((F.length(digits) - i) % 2 == 0, digits).otherwise(doubled), i, F.lit(1)
        ).cast("int"),
    )
    return total % 10 == 0


def _valid(kind_no: Column, found: Column) -> Column:
    """The checks that a base match must pass."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    n = F.length(digits)
    small = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return (
        F.when(kind_no == 0, F.lit(True))
        .when(kind_no == 1, found.rlike(rf"^{small}\.{small}\.{small}\.{small}$"))
        .when(kind_no == 2, F.when(n.between(16, 19), _luhn(digits)).otherwise(False))
        .otherwise(n.between(8, 15))
    )


def _worth(kind_no: Column, found: Column) -> Column:
    """Whether what a proposal means, written plainly, is a value of its kind.

    For a phone a number that is an address, a card or a date is none.
    """
    plain = F.regexp_replace(found, r"\x20", "")
    plain = F.regexp_replace(plain, r"[\[(]at[\])]", "@")
    plain = F.regexp_replace(plain, r"[\[(](?:dot|\.)[\])]", ".")
    digits = F.regexp_replace(found, "[^0-9]", "")
    n = F.length(digits)
    word = "[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
    mail = plain.rlike(
        rf"^[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*@(?:{word}\.)+(?:[a-z]{{2,24}}|[A-Z]{{2,24}})$"
    )
    card = F.when(n.between(13, 19), _luhn(digits)).otherwise(False)
    octets = _valid(F.lit(1), plain)
    date = found.rlike(
        r"^(?:(?:19|20)[0-9]{2}[\x20./-]{1,2}[01]?[0-9][\x20./-]{1,2}[0-3]?[0-9](?![0-9])"
        r"|[0-3]?[0-9][\x20./-]{1,2}[0-3]?[0-9][\x20./-]{1,2}(?:19|20)[0-9]{2}(?![0-9]))"
    )
    return (
        F.when(kind_no == 0, mail)
        .when(kind_no == 1, octets)
        .when(kind_no == 2, card)
        .otherwise(n.between(8, 15) & ~octets & ~card & ~date)
    )


def _side(char: Column) -> Column:
    """0 nothing, 1 white space, 2 letter, 3 digit, 4 closing mark, 5 anything else."""
    return (
        F.when(F.coalesce(char, F.lit("")) == "", 0)
        .when(char.rlike(r"\s"), 1)
        .when(char.rlike(r"\p{L}"), 2)
        .when(char.rlike(r"[0-9]"), 3)
        .when(char.rlike(r"[.,;:!?)\]\"']"), 4)
        .otherwise(5)
    )


def _described(candidates: DataFrame) -> DataFrame:
    """Candidates with `FEATURES`: format and context, as small whole numbers.

    Whether a proposal's value is one of its kind is none of them: it is what is
    learned. So the digits of a phone, whose number is its check, are left out.
    """
    found = F.col("found")
    digits = F.length(F.regexp_replace(found, "[^0-9]", ""))
    cue = F.lit(False)
    for no, kind in enumerate(KINDS):
        cue = cue | ((F.col("kind_no") == no) & F.col("before").rlike(CUES[kind]))
    return candidates.withColumns(
        {
            "digits": F.when(F.col("kind_no") == 3, 0).otherwise(F.least(digits, F.lit(20))),
            "groups": F.least(F.size(F.split(found, "[^0-9A-Za-z]+")), F.lit(8)),
            "length": F.least(F.floor(F.length(found) / 4).cast("int"), F.lit(12)),
            "left": _side(F.right(F.col("before"), F.lit(1))),
            "right": _side(F.col("after")),
            "cue": F.coalesce(cue, F.lit(False)).cast("int"),
            "style": F.when(found.rlike(r"[\[(](?:at|dot|\.)[\])]"), 3)
            .when(found.rlike(r"^\+"), 2)
            .when(found.rlike(r"[\x20()]"), 1)
            .otherwise(0),
        }
    )


def proposed(rows: DataFrame) -> DataFrame:
    """All proposals of `rows` (row, fold, text) with features, what they touch, whether
    they are base spans, and whether a loose one's value is one of its kind (`worth`);
    base matches that fail their check are gone.

    `touches`: the span shares characters with a base span of any kind; `hit`: of its
    own kind. Both come from running ends over the spans of a text in order, so a text
    with very many spans costs no more than sorting them.
    """
    spans = _described(_candidates(rows)).where(
        ~F.col("base") | _valid(F.col("kind_no"), F.col("found"))
    )
    big = F.lit(2**62)

    def touches(*keys: str) -> Column:
        order = Window.partitionBy("row", *keys).orderBy("start", F.desc("base"))
        upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        after = order.rowsBetween(1, Window.unboundedFollowing)
        end = F.max(F.when(F.col("base"), F.col("stop"))).over(upto)
        begin = F.min(F.when(F.col("base"), F.col("start"))).over(after)
        return (F.coalesce(end, F.lit(-1)) > F.col("start")) | (
            F.coalesce(begin, big) < F.col("stop")
        )

    worth = ~F.col("base") & _worth(F.col("kind_no"), F.col("found"))
    return (
        spans.withColumn("worth", worth)
        .withColumn("hit", touches("kind_no"))
        .withColumn("touches", touches())
    )


def train(spans: DataFrame) -> PiiModel:
    """Boosted trees over all loose proposals of a stored table made by `proposed`.

    A proposal is a hit if its value, written plainly, passes a check the features don't
    see, and it doesn't touch base spans of other kinds only. The driver receives counts
    per combination of feature values: fewer than the product of their ranges, whatever
    the table. Trees are fitted on three of four folds, thresholds on what could be added
    in the fourth: the lowest score from which on `PRECISION` of it are hits. A kind
    without such a score adds nothing.
    """
    right = F.col("worth") & (F.col("hit") | ~F.col("touches"))
    hit = right.cast("long")
    keys = [*FEATURES, "touches"]
    table = (
        spans.where(~F.col("base"))
        .groupBy(*keys, (F.col("fold") == 3).alias("out"))
        .agg(F.sum(hit).alias("hits"), F.sum(1 - hit).alias("misses"))
        .collect()
    )
    rows = [
        (
            r["out"],
            r["touches"],
            (tuple(r[f] for f in FEATURES), float(r["hits"]), float(r["misses"])),
        )
        for r in sorted(table)
    ]
    trees = boost([r for out, _, r in rows if not out])
    thresholds = {}
    for no, kind in enumerate(KINDS):
        scored = [
            (trees.score(x), a, b)
            for out, touches, (x, a, b) in rows
            if out and not touches and x[0] == no
        ]
        found = calibrated_threshold(scored, PRECISION, LEAST_CANDIDATES)
        if found is not None:
            thresholds[kind] = found
    return PiiModel(trees, thresholds)


def chosen(spans: DataFrame, model: PiiModel) -> DataFrame:
    """(row, kind_no, base, start, stop): base spans, and those the trees add.

    An added span touches no base span, has a value of its kind and reaches its kind's
    threshold.
    """
    least = F.lit(2.0)
    for no, kind in enumerate(KINDS):
        # the same sum in another order of additions may differ in the last digits
        limit = model.thresholds.get(kind, 2.0) - 1e-9
        least = F.when(F.col("kind_no") == no, F.lit(limit)).otherwise(least)
    added = F.col("worth") & ~F.col("touches") & (model.trees.column(FEATURES) >= least)
    return spans.where(F.col("base") | added).select(
        "row", "kind_no", "base", "start", "stop"
    )


def find_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered `docs` (row, doc_id) and all spans of their texts, by row.

    `docs` is a stored table with doc_id and text; a null text is empty and has no
    span, nor has an empty one. Repeated rows are searched each; an empty table gives
    empty results. Starts and stops count code points, stops are exclusive.
    """
    rows = numbered(docs.select("doc_id", "text"), "row")
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4, F.lit(0))
    texts = rows.where(F.col("text").isNotNull()).select("row", fold.alias("fold"), "text")
    spans = stored(proposed(texts), "proposals")
    return rows.select("row", "doc_id"), chosen(spans, train(spans))


def _listed(spans: Column) -> Column:
    """kind:start:end, by kind as listed, then start, comma-joined."""
    names = F.array(*map(F.lit, KINDS))

    def written(s: Column) -> Column:
        kind = F.element_at(names, s["kind_no"] + 1)
        return F.concat_ws(":", kind, s["start"].cast("string"), s["stop"].cast("string"))

    return F.array_join(F.transform(F.array_sort(spans), written), ",")


def summarised(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, base counts per kind, base_sha256, and all spans listed."""
    rows, spans = find_spans(docs)
    one = F.struct("kind_no", "start", "stop")
    per_row = spans.groupBy("row").agg(
        *(
            F.sum((F.col("base") & (F.col("kind_no") == no)).cast("long")).alias(f"n_{kind}")
            for no, kind in enumerate(KINDS)
        ),
        F.collect_list(F.when(F.col("base"), one)).alias("base_spans"),
        F.collect_list(one).alias("all_spans"),
    )
    per_row = stored(
        per_row.select(
            "row",
            *(f"n_{kind}" for kind in KINDS),
            F.sha2(_listed(F.col("base_spans")), 256).alias("base_sha256"),
            _listed(F.col("all_spans")).alias("spans"),
        ),
        "found",
    )
    return rows.join(per_row, "row", "left").select(
        "doc_id",
        *(F.coalesce(f"n_{kind}", F.lit(0).cast("long")).alias(f"n_{kind}") for kind in KINDS),
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with every span replaced by its kind in brackets; all its columns stay.

    Spans that share characters are replaced together, by the kind that starts first.
    Other texts, null and empty ones too, stay as they are; n_chars, where there is
    such a column, follows the text.
    """
    row, spans_col = fresh(docs, "row"), fresh(docs, "spans")
    _, spans = find_spans(docs)
    order = Window.partitionBy("row").orderBy("start", "stop", "kind_no")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col("start") >= F.col("reach"), F.lit(True))
    merged = (
        spans.withColumn("reach", reach)
        .withColumn("part", F.sum(new.cast("int")).over(order))
        .groupBy("row", "part")
        .agg(
            F.min("start").alias("start"),
            F.max("stop").alias("stop"),
            F.min_by("kind_no", F.struct("start", "stop", "kind_no")).alias("kind_no"),
        )
    )
    last = Window.partitionBy("row").orderBy("start")
    merged = stored(
        merged.withColumn("from", F.coalesce(F.lag("stop").over(last), F.lit(0)))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("from", "start", "stop", "kind_no"))).alias(spans_col))
        .withColumnRenamed("row", row),
        "redactions",
    )
    total = merged.agg(F.sum(F.size(spans_col))).first()[0] or 0
    if total <= BROADCAST_ROWS:
        merged = F.broadcast(merged)
    text = F.col("text")
    tags = F.array(*(F.lit(f"[{kind.upper()}]") for kind in KINDS))

    def piece(s: Column) -> Column:
        clear = F.substring(text, (s["from"] + 1).cast("int"), (s["start"] - s["from"]).cast("int"))
        return F.concat(clear, F.element_at(tags, s["kind_no"] + 1))

    spans_ = F.col(spans_col)
    tail = F.substring(
        text, (F.element_at(spans_, -1)["stop"] + 1).cast("int"), F.length(text)
    )
    clean = F.concat(F.array_join(F.transform(spans_, piece), ""), tail)
    made = {"text": F.when(spans_.isNotNull(), clean).otherwise(text)}
    result = numbered(docs, row).join(merged, row, "left").withColumns(made)
    if "n_chars" in docs.columns:
        n = F.when(spans_.isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))
        result = result.withColumn("n_chars", n.otherwise(F.col("n_chars")))
    return result.select(*docs.columns)
