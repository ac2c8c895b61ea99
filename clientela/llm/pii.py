"""Personal data: pattern spans, and further ones that boosted trees pick from overlapping candidates.

The whole path is DataFrame and SQL functions and Spark ML.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clientela.llm.spans import blocks, joined, let, match_columns, meeting, of_kind, spans
from clientela.session import materialise

KINDS = ["email", "ip", "card", "phone"]
# The agreed patterns, written without backtracking over repeated parts. An address starts where no character of its
# local part stands before it, or right behind the address before.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# High-recall generators of candidates, by the kind they propose. The mark that a base pattern insists on ("@", "+",
# dots, plain separators) is loosened here, so trees judge by the rest of the format and by context.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?@ ?| ?[(\[]at[)\]] ?| at )[A-Za-z0-9-]++(?: ?\. ?| ?[(\[]dot[)\]] ?| dot )[A-Za-z]{2,}+",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?: ?[.,:_-] ?[0-9]{1,3}+(?![0-9])){3}",
    "card": r"(?<![0-9])[0-9](?:[ ._/-]{0,2}[0-9])++",
    "phone": r"(?<![0-9])\(?[0-9](?:[ ()./-]{0,3}[0-9])++",
}
CUES = {
    "email": "mail|contact|write|address",
    "ip": "ip|host|server|address|port|ping",
    "card": "card|visa|credit|pay|account|iban",
    "phone": "phone|tel|call|fax|mobile|cell|dial",
}
# Candidates of each label that the trees are fitted on, at most, in equal parts by kind, each in the order of a hash.
FIT_ROWS = 20_000
TREES, DEPTH = 20, 4
# Shorter candidates hold fewer than the 7 digits or letters that any kind has.
LEAST_LENGTH = 7
# Share of a base span that a candidate must cover to stand for it.
COVER = 0.8


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    return F.coalesce(F.call_function("luhn_check", digits), F.lit(False))


def octets(text: Column, split: str = r"\.") -> Column:
    """Every number of the text is at most 255, leading zeros aside."""
    numbers = F.transform(F.split(text, split), lambda p: F.regexp_replace(p, "^0+", ""))
    # Text order equals number order between texts of three digits.
    return F.forall(numbers, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def holds(kind: str, found: Column) -> Column:
    """What a match of the base pattern must fulfil besides."""
    size = F.length(digits_of(found))
    if kind == "ip":
        return octets(found)
    if kind == "card":
        return size.between(12, 19) & luhn(digits_of(found))
    if kind == "phone":
        return size.between(9, 15)
    return F.lit(True)


def format_features(kind: int, span: Column) -> Column:
    """Numbers for the trees: format of the span, then its context."""
    found, after = span["found"], span["after"]
    # The plus sign of the base pattern tells base spans from others, which the trees must not see.
    before = F.regexp_replace(span["before"], r"\+$", "")
    digits = digits_of(found)
    groups = F.filter(F.split(found, "[^0-9]+"), lambda g: F.length(g) > 0)
    longest = F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0))
    first = F.coalesce(F.length(F.try_element_at(groups, F.lit(1))), F.lit(0))
    last = F.coalesce(F.length(F.try_element_at(groups, F.lit(-1))), F.lit(0))

    def ends(text: Column, pattern: str) -> Column:
        return text.rlike(pattern)

    values = [
        F.lit(kind),
        F.length(found),
        F.length(digits),
        F.length(F.regexp_replace(found, "[^A-Za-z]", "")),
        F.length(F.regexp_replace(found, "[^ ()._/,:-]", "")),
        F.size(groups),
        longest,
        first,
        last,
        luhn(digits),
        octets(found, "[^0-9]+"),
        found.contains("("),
        F.length(F.regexp_replace(found, "[^ ]", "")),
        ends(before, "[A-Za-z]$"),
        ends(before, "[0-9.,:/+=_-]$"),
        ends(before, "[\"'(]$"),
        ends(after, "^[A-Za-z]"),
        ends(after, "^[0-9.,:/+=_-][0-9A-Za-z]"),
        F.lower(before).rlike("(?:" + CUES[KINDS[kind]] + ")[^A-Za-z]*$"),
        F.length(F.regexp_replace(before, "[^0-9]", "")),
    ]
    return F.array(*[F.coalesce(v.cast("double"), F.lit(0.0)) for v in values])


def base_spans(number: int) -> Column:
    kind = KINDS[number]
    return of_kind(F.filter(spans("t", f"_{kind}", BASE[kind]), lambda s: holds(kind, s["found"])), number)


def proposed_spans(number: int) -> Column:
    kind = KINDS[number]
    wide = F.filter(spans("t", f"_loose_{kind}", LOOSE[kind]), lambda s: F.length(s["found"]) >= LEAST_LENGTH)

    def candidate(s: Column) -> Column:
        features = format_features(number, s).alias("features")
        return F.struct(F.lit(number).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), features)

    return F.transform(wide, candidate)


def scan(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``row, id, base, candidates`` of every row, written once: later steps do not touch the texts."""
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    loose = {f"loose_{k}": p for k, p in LOOSE.items()}
    matched = rows.select("id", "t", *match_columns("t", BASE), *match_columns("t", loose))
    base = [base_spans(number) for number in range(len(KINDS))]
    proposed = [proposed_spans(number) for number in range(len(KINDS))]
    found = matched.select("id", F.concat(*base).alias("base"), F.concat(*proposed).alias("candidates"))
    return materialise(found.withColumn("row", F.monotonically_increasing_id()), "pii")


def candidates_of(scanned: DataFrame) -> DataFrame:
    """One row per candidate: ``label`` 1 if it stands for a base span of its kind, 0 if it touches none, else null.

    Labels are found inside the row, so the exploded rows do not carry the base spans.
    """

    def labelled(blocked: Column, c: Column) -> Column:
        common = lambda b: F.least(b["end"], c["end"]) - F.greatest(b["start"], c["start"])
        stands = lambda b: (b["kind"] == c["kind"]) & (common(b) >= COVER * (b["end"] - b["start"]))
        near = meeting(blocked, c["start"], c["end"])
        known = let(near, lambda n: F.when(F.exists(n, stands), 1).when(~F.exists(n, lambda b: common(b) > 0), 0))
        return F.struct(*[c[name].alias(name) for name in ("kind", "start", "end", "features")], known.alias("label"))

    all_labelled = let(blocks(F.col("base")), lambda blocked: F.transform("candidates", lambda c: labelled(blocked, c)))
    return scanned.select("row", F.explode(all_labelled).alias("c")).select("row", "c.*")


@dataclass
class SpanModel:
    """Trees and, by kind, the score from which a candidate is taken."""

    trees: GBTClassificationModel
    thresholds: dict[int, float]


def fit(candidates: DataFrame) -> SpanModel | None:
    """Boosted trees on weak labels, with thresholds calibrated for labels that are positive or unknown.

    Base spans are the known positives. Other candidates may be personal data too, so a score estimates the chance of
    being *known*; the chance of being positive is that divided by the mean score of known positives (Elkan and Noto
    2008). A kind's threshold is half of that mean, over all known positives that the trees have not seen: one in four
    of the sample, the first of each kind included, and all outside it. So every kind with a known positive has one.
    Without known positives and negatives that the trees may see there is nothing to learn, and no model.
    """
    order = F.xxhash64("row", "start", "end", "kind")
    labelled = candidates.where("label is not null").withColumn("o", order)
    most = FIT_ROWS // len(KINDS)

    def part(label: int, kind: int) -> DataFrame:
        rows = labelled.where((F.col("label") == label) & (F.col("kind") == kind))
        return rows.orderBy("o", "row", "start", "end").limit(most)

    # At most 2 * FIT_ROWS rows.
    sample = reduce(DataFrame.unionByName, [part(label, kind) for label in (0, 1) for kind in range(len(KINDS))])
    place = F.row_number().over(Window.partitionBy("label", "kind").orderBy("o", "row", "start", "end"))
    sample = materialise(sample.withColumn("place", place), "pii-sample")
    unseen = F.col("place") % 4 == 1
    if sample.where(~unseen).select("label").distinct().count() < 2:
        return None
    vector = array_to_vector("features").alias("vector")
    rows = sample.where(~unseen).select(F.col("label").cast("double").alias("label"), vector)
    trees = GBTClassifier(featuresCol="vector", maxIter=TREES, maxDepth=DEPTH, seed=7).fit(rows)
    known = F.col("label") == 1
    # One row per kind: where the sample ends, if the kind fills its part of it.
    ends = sample.where(known).groupBy("kind").agg(F.max("o").alias("o"), F.max("place").alias("n")).collect()
    outside = F.lit(False)
    for end in ends:
        if end["n"] == most:
            outside = outside | ((F.col("kind") == end["kind"]) & (F.col("o") > end["o"]))
    others = labelled.where(known & outside).select("kind", vector)
    scored = trees.transform(sample.where(known & unseen).select("kind", vector).unionByName(others))
    means = scored.groupBy("kind").agg(F.avg(chance()).alias("mean")).collect()  # one row per kind
    return SpanModel(trees, {r["kind"]: r["mean"] / 2 for r in means})


def chance() -> Column:
    return vector_to_array("probability")[1]


def further_spans(candidates: DataFrame, model: SpanModel) -> DataFrame:
    """``row, added``: candidates over their kind's threshold, best first, each that overlaps none kept so far."""
    rows = candidates.where(F.col("label") == 0).withColumn("vector", array_to_vector("features"))
    limit = F.lit(None).cast("double")
    for kind, value in model.thresholds.items():
        limit = F.when(F.col("kind") == kind, value).otherwise(limit)
    taken = model.trees.transform(rows).select("row", "kind", "start", "end", chance().alias("score")).where(F.col("score") >= limit)
    # Best first: score, length, earlier start, kind.
    rank = F.struct(F.col("score"), F.col("end") - F.col("start"), -F.col("start"), -F.col("kind"))
    # Only candidates of one chain, each overlapping the next, can stand against each other.
    along = Window.partitionBy("row").orderBy("start", "end", "kind")
    reached = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") >= reached, F.lit(True)).cast("int")
    chain = F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    chained = taken.withColumn("opens", opens).withColumn("chain", chain)
    ranked = F.sort_array(F.collect_list(F.struct(rank.alias("rank"), "kind", "start", "end")), False)
    grouped = chained.groupBy("row", "chain").agg(ranked.alias("all"))

    def keep(kept: Column, s: Column) -> Column:
        overlaps = F.exists(kept, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]))
        return F.when(overlaps, kept).otherwise(F.concat(kept, F.array(s)))

    best = F.aggregate("all", F.filter("all", lambda s: F.lit(False)), keep)
    chosen = grouped.select("row", of_any(best).alias("some"))
    return chosen.groupBy("row").agg(F.flatten(F.collect_list("some")).alias("added"))


def of_any(found: Column) -> Column:
    return F.transform(found, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key, base, added``, arrays of ``struct<kind, start, end>`` (kind: place in ``KINDS``).

    ``base`` holds all spans of the agreed patterns, ``added`` those that the trees take from the candidates that
    touch no base span. Places are code points, end exclusive. Null counts as empty; an empty text has no spans;
    repeated rows each get their row; tables without candidates that stand for base spans, or without others, teach the
    trees nothing and add nothing. A text may be of any length and hold any number of spans. Other columns are ignored.
    """
    scanned = scan(docs, key, text)
    candidates = candidates_of(scanned)
    model = fit(candidates)
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    rows = scanned.select("row", "id", "base")
    rows = rows.join(further_spans(candidates, model), "row", "left") if model else rows.withColumn("added", none)
    return rows.select(F.col("id").alias(key), "base", F.coalesce("added", none).alias("added"))


def count_kind(found: str, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def span_list(found: Column) -> Column:
    return joined(found, KINDS)
