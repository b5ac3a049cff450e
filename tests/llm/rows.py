"""Awkward rows that every operator has to take."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG = " ".join(f"word{i % 977} of{i % 31}" for i in range(15_000))
SAME = "\n".join(" ".join(f"line{k} token{k * 7 + i}" for i in range(30)) for k in range(4))

ROWS = [
    (1, None, "s"), (2, "", "s"), (3, " \n\t\n ", None), (4, LONG, "s"), (None, "an id is not there " * 8, None),
    (5, SAME, "t"), (5, SAME, "t"), (6, SAME, "u"), (7, SAME + "\nand one more line of its own here", "t"),
    (8, "short text", ""), (9, "Ünïcode Wörter, ÀÉÎ 漢字 🙂 " * 12, "é"),
]
#: Names that results of the operators bear, and names used on the way.
CLASHING = ["size", "Kept", "score", "n_words", "failures", "detections", "removed_lines", "target", "placed", "block",
            "fingerprint", "component_id", "a", "b", "_id", "_hash", "_removed", "_url", "_found", "_m", "_text_hash", "_source",
            "found", "found_id", "found_hash", "found_lines", "bad_id", "bad_hash", "keeper_id", "keeper_hash", "own_hash",
            "address", "row", "source_no", "blocks", "passes", "rest", "h1", "h2", "number", "times", "chunk", "copies", "ranks",
            "result", "value", "grp", "part", "digest", "lines", "least", "content", "at", "len", "windows", "shingle", "own",
            "other", "shift", "item_id", "item_hash", "n_shingles", "set_key", "root", "first", "keeper", "sketch", "base_places",
            "w", "l", "removed", "text_", "found_", "key", "node", "text_hash", "shard", "Predicted", "hash", "words"]


def documents(spark, rows=None, extra=True):
    schema = "doc_id long, text string, source string"
    df = spark.createDataFrame(ROWS if rows is None else rows, schema)
    df = df.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.length("text").cast("long").alias("n_chars"))
    if extra:
        df = df.select("*", *[F.lit("x").alias(c) for c in CLASHING])
    return df


def nothing(spark, schema="doc_id long, text string, lang string, source string, n_chars long"):
    return spark.createDataFrame([], T._parse_datatype_string(schema))
