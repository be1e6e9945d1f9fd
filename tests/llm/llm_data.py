"""Small documents for the tests of this folder."""

import random

from pyspark.sql import types as T

WORDS = "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one".split()
#: names that the operators use for their own results or inside
CLASHES = ("n_words", "kept", "score", "fp", "d", "th", "line", "at", "block", "rank", "piece", "start", "length", "fingerprint",
           "component_id", "copies", "n", "id", "t", "h1", "raw", "predicted", "verdict", "host", "row", "v", "reason")


def prose(seed: int, n: int, per_line: int = 12) -> str:
    r = random.Random(seed)
    words = [r.choice(WORDS) + r.choice(["", "", "", "ly", "s", "er"]) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + per_line]).capitalize() + "." for i in range(0, n, per_line))


DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def documents(spark, rows):
    """rows of (doc_id, text) or (doc_id, text, lang, source)"""
    full = [(*r, "en", "a") if len(r) == 2 else r for r in rows]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in full], DOCS)


EDGES = [
    (1, prose(1, 200)), (2, prose(1, 200)), (2, prose(1, 200)), (3, None), (4, ""), (5, " \n\t \n"), (None, prose(2, 80)), (None, None),
    (6, "one"), (7, prose(3, 60_000)), (8, "é ü ß 日本 \U0001f600\n" * 30), (9, prose(4, 120)), (-5, prose(1, 200) + " more"), (10, "x" * 5000),
]
