"""Documents with everything that can be odd about a row, and helpers of these tests."""

from __future__ import annotations

import os
import random
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHING = ("a", "b", "n", "df", "row", "node", "root", "value", "start", "part", "score", "scores", "kept", "spans", "hash", "shard", "_id", "_row", "_hash", "_loss")


def sentence(seed: int, words: int) -> str:
    chosen = random.Random(seed)
    stems = ["lorem", "ipsum", "Dolor", "sit", "amet,", "consec", "adipi", "elit.", "tempor", "magna", "aliqua", "veniam", "quis", "nostrud"]
    return " ".join(chosen.choice(stems) + str(chosen.randint(0, 60)) * (chosen.random() < 0.3) for _ in range(words))


BODY = sentence(1, 120)
NEAR = " ".join([*BODY.split()[:119], "changed"])
LONG = "\n".join(sentence(i, 400) for i in range(100)) + " " + "x" * 50_000

ODD = [
    (1, BODY, "en", "s1", 1), (2, NEAR, "en", "s2", 1), (3, BODY, "en", "s3", 1), (3, BODY, "en", "s3", 1), (4, None, None, None, None),
    (5, "", "en", "s1", 0), (6, " \t\n ", "en", "s1", 4), (7, "word", "en", "s1", 4), (8, "word", "de", "s1", 4), (None, BODY, "en", None, None),
    (None, None, None, None, None), (9, LONG, "en", "s1", 1), (10, sentence(5, 60), "en", "s1", 1), (10, sentence(6, 60), "fr", "s1", 1),
    (11, "a <|endoftext|>  b\r\n  ¡漢字 😀 é x  ", "es", "s1", 9), (12, "password=abcdef123456 and a@b.example.com", "en", "s1", 3),
    (13, "password=abcdef123456 +1 (555) 010-9999", "en", "s2", 3), (14, "password=abcdef123456 10.1.2.3", "en", "s4", 3),
    (15, "😀 token: 'Zq81LmPq90XyZ' 4111 1111 1111 1111", "en", "s1", 3), (16, "spam $$$ " * 40, "en", "s1", 3),
    (17, f"{sentence(8, 30)} {sentence(70, 14)} {sentence(9, 30)}", "en", "s1", 3), (-5, sentence(10, 40).upper(), "en", "s1", 3),
]


def documents(spark, rows=None, extra=True):
    """``rows`` (all odd ones if None) as documents, with further columns under clashing names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD if rows is None else rows, SCHEMA)
    return df.select("*", *(F.lit("x").alias(name) for name in CLASHING)) if extra else df


def split_over(df, parts: int = 5):
    return df.repartition(parts)


def tuples(df, *names):
    return [tuple(row[name] for name in names) for row in df.select(*names).collect()]
