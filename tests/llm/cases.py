"""Small tables for the training-data operators, and plain versions to hold them against."""

from pyspark.sql import types as T

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards brew a potion in the old tower by the sea".split()


def prose(k: int, n: int = 60) -> str:
    """Words that differ from document to document."""
    return " ".join(f"{PROSE[(i * 7 + k * 3) % len(PROSE)]}{(i * k) % 11 or ''}" for i in range(n))


LINE = "This line of more than forty characters stands in many documents."

#: Null and empty texts, null ids and sources, repeated rows, one text in several sources, white space of all kinds, a long text.
DOCS = [
    (1, None, "a"),
    (2, "", "a"),
    (3, "   \t\n \x0b\x0c\r", None),
    (4, "one", "b"),
    (5, prose(5), "b"),
    (6, prose(5), "a"),
    (6, prose(5), "a"),
    (7, f"{LINE}\n{prose(7)}\n  {LINE.upper()}\t", "c"),
    (8, f"{prose(8)}\n{LINE}", "c"),
    (9, f"{LINE}\n{prose(9)}", None),
    (10, f"{LINE}\n{LINE}", "c"),
    (11, f"{prose(11)}\n{LINE}\n{prose(12)}", "a"),
    (None, f"{LINE}\n{prose(13)}", "a"),
    (12, prose(14, 30_000), "b"),
    (13, "Ünïcode « ça » 你好 é \U0001f600 <|endoftext|> İ ẞ", "a"),
    (14, prose(5) + " changed", "a"),
    (15, "### $$$ %%% " * 40, "c"),
    (16, "word " * 300, "c"),
]

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())])
#: Names that operators use inside.
CLASHING = ["id", "n", "hash", "fp", "ids", "part", "size", "place", "chunk", "n_lines", "label", "cls", "component", "v",
            "__plan", "__of", "__copy", "__score", "__stats", "__fp", "__drop", "__n_lines", "__n_dropped", "kept__score"]


def documents(spark, rows=DOCS):
    return spark.createDataFrame(rows, SCHEMA)


def with_more_columns(docs):
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit(f"more {c}") for c in CLASHING})


def rows(frame) -> list[tuple]:
    return sorted(map(tuple, frame.collect()), key=repr)
