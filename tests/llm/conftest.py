from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

# a schema with columns whose names clash with those that the operators use inside
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("id", T.StringType()),
    T.StructField("row", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType()),
    T.StructField("fp", T.LongType()), T.StructField("ids", T.StringType()), T.StructField("word", T.StringType()),
    T.StructField("stratum", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("component_id", T.StringType()),
    T.StructField("a.b `c`", T.StringType()),
])
EN = "the house and river of many small towns where people walk under old trees while rain falls slowly on their gardens".split()
DE = "der hund und die katze sitzen im großen garten während kinder über grüne wiesen laufen und vögel schön singen".split()


def words(rng: random.Random, of: list[str], n: int) -> str:
    return " ".join(rng.choice(of) + rng.choice(["", "", ".", ","]) for _ in range(n))


def sample_rows() -> list[tuple]:
    """Prose in two languages, exact and near copies, and every odd case."""
    rng = random.Random(5)
    texts: list[tuple] = []
    for i in range(60):
        texts.append((words(rng, EN, 60 + i), "en") if i % 2 else (words(rng, DE, 60 + i), "de"))
    base = words(rng, EN, 4000)
    texts += [(base, "en"), (base + " end", "en"), (base, "en"), ("start " + base, "en")]
    cut = base.split(" ")
    for i in range(12):                                     # a few words changed each
        texts.append((" ".join(cut[:300 * i] + [f"changed{i}"] * 3 + cut[300 * i + 3:]), "en"))
    texts += [(texts[3][0], "en"), (texts[3][0].upper(), "en"), (None, "en"), ("", None), ("   \n\t ", "de"), ("12345 !!", None),
              ("word " * 300, "en"), ("x" * 20000, None), ("日本語のテキスト " * 40, None), ("<|endoftext|> a<|endoftext|>", "en"),
              ("line one here\nline one here\n\nline one here", "en"), ("Released under the MIT License. CC BY-NC 4.0", "en"),
              ("a  b   c \n d\x1c e f ", "de"), ("It's we'll THEY'VE don't", "en"), ("# * $ % & | < > " * 40, "en")]
    rows = [(i, t, lang, f"s{i % 3}", len(t or ""), "x", i % 4, 0.5, True, 7, "y", "z", "w", "v", "u", "t") for i, (t, lang) in enumerate(texts)]
    rows.append(rows[5])                                   # a row twice
    rows.append((5, "another text under the same id", *rows[5][2:]))
    rows.append((None, "a text without an id", "en", *[None] * 13))
    rows.append((None, None, None, *[None] * 13))
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(sample_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def odd_rows(odd):
    return odd.collect()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
