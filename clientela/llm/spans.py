"""Pattern matches with their places, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CONTEXT = 24
# Arrays are walked in blocks of so many, as a text may hold any number of matches: an array that grows by one
# element is copied at every step, blocks are appended whole.
BLOCK = 256
SPAN = "struct<start:bigint,end:bigint,found:string,before:string,after:string>"


def match_columns(text: str, patterns: dict[str, str]) -> list[Column]:
    """One column ``_<name>`` of all matches of each pattern; project these before :func:`spans`."""
    return [F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(f"_{name}") for name, p in patterns.items()]


def spans(text: str, matches: str, pattern: str) -> Column:
    """``array<struct<start, end, found, before, after>>`` of the matches in a column of :func:`match_columns`.

    The text between matches gives the places: the pieces before match i, and the matches before it, add up to its
    start (code points, end exclusive). ``before`` and ``after`` are the neighbouring characters up to the next match.
    """
    count = F.size(matches)
    pieces = F.split(text, pattern, -1)
    parts = F.zip_with(
        F.zip_with(matches, F.slice(pieces, 1, count), lambda m, g: F.struct(m.alias("m"), g.alias("g"))),
        F.slice(pieces, 2, count),
        lambda x, after: F.struct(x["m"].alias("m"), x["g"].alias("g"), F.left(after, F.lit(CONTEXT)).alias("after")),
    )
    none = F.array().cast(f"array<{SPAN}>")
    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["g"])
        end = begin + F.length(x["m"])
        span = F.struct(
            begin.cast("long").alias("start"),
            end.cast("long").alias("end"),
            x["m"].alias("found"),
            F.right(x["g"], F.lit(CONTEXT)).alias("before"),
            x["after"].alias("after"),
        )
        return F.struct(end.cast("long").alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def block(acc: Column, items: Column) -> Column:
        walked = F.aggregate(items, F.struct(acc["at"].alias("at"), none.alias("out")), step)
        return let(walked, lambda w: F.struct(w["at"].alias("at"), F.concat(acc["out"], F.array(w["out"])).alias("out")))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<array<{SPAN}>>").alias("out"))
    walk = let(parts, lambda ps: F.aggregate(cut(ps), start, block, lambda acc: F.flatten(acc["out"])))
    return F.when(count > 0, walk).otherwise(none)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, where a lambda would compute it for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def cut(items: Column) -> Column:
    """A non-empty array (a lambda's variable or a stored column) in blocks."""
    last = F.floor((F.size(items) - 1) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(items, b * BLOCK + 1, BLOCK))


def blocks(found: Column) -> Column:
    """Spans by start, in blocks with the lowest start and the highest end of each, for :func:`meeting`."""

    def summed(items: Column) -> Column:
        low, high = F.array_min(F.transform(items, lambda s: s["start"])), F.array_max(F.transform(items, lambda s: s["end"]))
        return F.struct(low.alias("low"), high.alias("high"), items.alias("items"))

    ordered = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    none = F.array().cast("array<struct<low:bigint,high:bigint,items:array<struct<start:bigint,end:bigint,kind:int>>>>")
    return F.when(F.size(found) > 0, let(ordered, lambda o: F.transform(cut(o), summed))).otherwise(none)


def meeting(blocked: Column, start: Column, end: Column) -> Column:
    """The spans of those blocks that reach into ``start`` to ``end``: few, so that they can be tested one by one."""
    near = F.filter(blocked, lambda b: (b["low"] < end) & (start < b["high"]))
    return F.flatten(F.transform(near, lambda b: b["items"]))


def joined(found: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of an array of structs with ``kind`` numbers, by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    ordered = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    texts = F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(texts, ",")


def of_kind(found: Column, kind: int) -> Column:
    """Spans as ``struct<kind, start, end>``."""
    return F.transform(found, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
