"""Secrets: pattern spans, and weak parts of credentials that an interval join links within a document.

The whole path is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientela.llm.spans import blocks, joined, let, match_columns, meeting, of_kind, spans
from clientela.session import materialise

KINDS = ["assign", "access", "hex", "weak_id", "weak_secret", "endpoint"]
# The agreed patterns without backtracking over repeated parts; lengths that the rules ask for are part of the pattern
# where a maximal run decides them.
BASE = {
    "assign": r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*+[:=]\x20*+[\"']?[A-Za-z0-9+/_.=-]++",
    "access": r"AKIA[A-Z0-9]{16,}+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
}
VALUE = r"^[A-Za-z_]+[\"']?\x20*+[:=]\x20*+[\"']?"
LEAST_VALUE = 6
# Weak parts: each says little alone.
WEAK = {
    "weak_id": r"(?<![A-Za-z0-9_])[A-Z][A-Z0-9]{15,}+(?![A-Za-z0-9_])",
    "weak_secret": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/_=-])",
    "endpoint": r"[Hh][Tt][Tt][Pp][Ss]?://[A-Za-z0-9.-]++(?::[0-9]{1,5}+)?",
}
# Characters that a weak part must hold besides.
MARKS = {"weak_id": ["[0-9]"], "weak_secret": ["[0-9]", "[A-Z]", "[a-z]"]}
# What part of a credential a kind is, and which parts must stand near a weak one before it is reported.
ROLE = {"assign": "secret", "hex": "secret", "access": "id", "weak_id": "id", "weak_secret": "secret", "endpoint": "endpoint"}
NEEDS = {"weak_id": ["secret"], "weak_secret": ["id"], "endpoint": ["id", "secret"]}
ROLES = ["id", "secret", "endpoint"]
# Two parts belong together when their starts are at most so many code points apart.
SCOPE = 240


def holding(mark: str):
    return lambda s: s["found"].rlike(mark)


def scan(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``row, id, base, weak`` of every row, written once: the join does not touch the texts."""
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    matched = rows.select("id", "t", *match_columns("t", {**BASE, **WEAK}))
    found = {k: spans("t", f"_{k}", p) for k, p in {**BASE, **WEAK}.items()}
    found["assign"] = F.filter(
        found["assign"], lambda s: F.length(F.regexp_replace(s["found"], VALUE, "")) >= LEAST_VALUE
    )
    for kind, marks in MARKS.items():
        for mark in marks:
            found[kind] = F.filter(found[kind], holding(mark))
    numbered = {k: of_kind(v, KINDS.index(k)) for k, v in found.items()}
    out = matched.select(
        "id", F.concat(*[numbered[k] for k in BASE]).alias("base"), F.concat(*[numbered[k] for k in WEAK]).alias("weak")
    )
    return materialise(out.withColumn("row", F.monotonically_increasing_id()), "secrets")


def role_of(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(ROLE[k]) for k in KINDS]), kind + 1)


def linked(scanned: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``row, added``: weak parts with all complementary parts within ``scope``.

    Interval join: every part falls into a bucket of ``scope`` code points of its row, and a bucket is summed up by the
    first and last start of each role. A weak part meets its own bucket and both neighbours; first and last start tell
    exactly whether a part stands near enough, so a crowd of parts never makes pairs.
    """
    parts = scanned.select("row", F.explode(F.concat("base", "weak")).alias("p")).select("row", "p.*")
    parts = parts.withColumn("role", role_of(F.col("kind"))).withColumn("bucket", F.floor(F.col("start") / scope))
    edges = [
        aggregate(F.when(F.col("role") == role, F.col("start"))).alias(f"{role}_{name}")
        for role in ROLES
        for name, aggregate in (("first", F.min), ("last", F.max))
    ]
    summed = parts.groupBy("row", "bucket").agg(*edges)
    first_weak = len(BASE)
    probes = parts.where(F.col("kind") >= first_weak).select(
        "row", "kind", "start", "end", F.explode(F.array(*[F.col("bucket") + d for d in (-1, 0, 1)])).alias("bucket")
    )
    near = [
        F.coalesce(
            (F.abs(F.col(f"{role}_first") - F.col("start")) <= scope) | (F.abs(F.col(f"{role}_last") - F.col("start")) <= scope),
            F.lit(False),
        )
        for role in ROLES
    ]
    met = probes.join(summed, ["row", "bucket"]).groupBy("row", "kind", "start", "end")
    met = met.agg(*[F.max(n).alias(f"near_{role}") for n, role in zip(near, ROLES, strict=True)])
    complete = F.lit(False)
    for kind, needs in NEEDS.items():
        both = F.lit(True)
        for role in needs:
            both = both & F.col(f"near_{role}")
        complete = F.when(F.col("kind") == KINDS.index(kind), both).otherwise(complete)
    return met.where(complete).groupBy("row").agg(F.collect_set(F.struct("kind", "start", "end")).alias("added"))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per input row: ``key, base, added``, arrays of ``struct<kind, start, end>`` (kind: place in ``KINDS``).

    ``base`` holds all spans of the agreed patterns. ``added`` holds weak parts that complete a credential: an access
    identifier near a secret, a secret near an identifier, an endpoint near both. Weak parts that overlap a base span
    are left to it. A weak identifier is a whole run of 16 or more capitals and digits, a weak secret one of 20 or more
    characters besides padding with a digit and both cases; neither has an upper length. Places are code points, end
    exclusive. Null counts as empty; an empty text has no spans; repeated rows each get their row. A text may be of any
    length and hold any number of spans. Other columns are ignored.
    """
    scanned = scan(docs, key, text)

    def alone(blocked: Column, w: Column) -> Column:
        return ~F.exists(meeting(blocked, w["start"], w["end"]), lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"]))

    free = let(blocks(F.col("base")), lambda blocked: F.filter("weak", lambda w: alone(blocked, w)))
    scanned = scanned.select("row", "id", "base", free.alias("weak"))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    rows = scanned.select("row", "id", "base").join(linked(scanned, scope), "row", "left")
    return rows.select(F.col("id").alias(key), "base", F.coalesce("added", none).alias("added"))


def count_kind(found: str, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def span_list(found: Column) -> Column:
    return joined(found, KINDS)
