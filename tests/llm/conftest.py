"""Small document tables with every awkward case, and a session to run them in."""

import os
import random
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that the operators use inside.
    T.StructField("rid", T.StringType()), T.StructField("score", T.StringType()), T.StructField("kept", T.StringType()),
    T.StructField("spans", T.StringType()), T.StructField("shard", T.StringType()),
    T.StructField("n_words", T.StringType()),
])

SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()


def prose(draw: random.Random, n: int) -> str:
    words = []
    for _ in range(n):
        words.append(draw.choice(["the", "of", "and", "in"]) if draw.random() < 0.3
                     else "".join(draw.choices(SYLLABLES, k=draw.randint(1, 4))))
    return " ".join(w + ("." if draw.random() < 0.1 else "") for w in words)


def awkward_rows() -> list[tuple]:
    """Nulls in any column, empty and very long texts, ties, repeated rows, copies, junk, odd characters."""
    draw = random.Random(4)
    texts = [prose(draw, draw.randint(30, 200)) for _ in range(40)]
    texts += [None, "", " \n\t", "one", "x" * 3000, prose(draw, 6000), texts[0], texts[0], texts[1]]
    texts += ["The " * 300, "line one here\n" * 60, "de&&& von### ist%%% " * 30, "ß é 日本 ▁ \u0085 \x1c <|endoftext|> ﷐",
              texts[2] + " " + texts[3], texts[3] + " tail"]
    words = texts[4].split()
    words[7] = words[40 % len(words)] = "changed"
    texts.append(" ".join(words))
    rows = [(i, t, ["en", "de", None][i % 3], f"s{i % 2}" if i % 5 else None, len(t or ""), "r", "s", "k", "p", "h", "w")
            for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, texts[6], None, None, None, None, None, None, None, None, None),
             (2, "other text with an id that is there already " * 4, "en", "s1", 0, *[None] * 6)]
    return rows


@pytest.fixture(scope="session")
def awkward(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("awkward") / "docs")
    spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("nothing") / "docs")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(i, 0 if i in (49, 50, 51) else 1, 0) for i in range(0, 56)] + [(None, 1, 0), (3, None, 0), (4, 7, 0)],
        "doc_id long, quality int, toxic int")
