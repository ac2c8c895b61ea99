"""Small document tables with the awkward cases: nulls, empty and long texts, repeated rows, clashing columns."""

from pyspark.sql import types as T

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliett kilo lima mike november oscar papa".split()
LONG_LINE = "This long line stands in many of the documents at hand, word for word."
PASSAGE = "one two three four five six seven eight nine ten eleven twelve"


def prose(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * i + i * seed) % len(WORDS)] + str((i * seed) % 9) for i in range(n))


DOCS = [
    (1, prose(1, 80) + "\n" + LONG_LINE),
    (2, prose(2, 60) + "\n  " + LONG_LINE.upper() + "\t\n" + LONG_LINE),
    (3, LONG_LINE + "\n" + prose(3, 90)),
    (4, LONG_LINE),
    (5, prose(5, 50) + "\n" + LONG_LINE + "\n\nend"),
    (6, None),
    (7, ""),
    (8, " \t \n "),
    (9, prose(1, 80) + "\n" + LONG_LINE),
    (10, "Öl é ß " + prose(10, 40) + " " + PASSAGE + " " + prose(11, 3)),
    (11, PASSAGE.upper().replace(" ", ", ") + "! short one"),
    (12, "a"),
    (12, "a"),
    (13, prose(13, 4000)),
    (13, prose(14, 30)),
    (None, prose(15, 30) + "\n" + LONG_LINE),
    (14, "x" * 30_000 + " " + " " * 5_000 + "y"),
    (15, "日本語 テスト 😀 " + prose(2, 60)),
]


def docs_table(spark, rows=None, clash=True):
    """The table with extra columns named like the operators' own."""
    rows = DOCS if rows is None else rows
    names = ["id", "row", "fp", "copy", "n_lines", "ids", "score", "features", "base", "spans", "label", "hash"] if clash else []
    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), *[T.StructField(n, T.StringType()) for n in names]])
    return spark.createDataFrame([(*r, *["extra"] * len(names)) for r in rows], kind)
