"""Small corpora for the tests: ordinary texts, and one table with everything that is unusual."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    ]
)

#: Columns that clash with names the operators use, and one of a type that cannot be hashed.
CLASHING = ["score", "shard", "slot", "held_out", "size", "block", "class", "mark", "row", "words", "shuffle_key", "same"]


def documents(spark, rows):
    """Rows of (doc_id, text), with a language and a source that are sometimes null."""
    langs, sources = ["en", "de", None], ["a", "b", "é", None]
    full = [(d, t, langs[i % 3], sources[i % 4], None if t is None else len(t)) for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCUMENT)


def clashing(df):
    from pyspark.sql import functions as F

    for name in CLASHING:
        df = df.withColumn(name, F.lit("x"))
    return df.withColumn("a map", F.create_map(F.lit("k"), F.col("doc_id")))


def sentence(rng: random.Random, words: int, vocabulary: int) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def odd_rows() -> list[tuple[int | None, str | None]]:
    """Null and empty texts, blanks only, null and repeated ids, repeated rows, one very long text, odd characters."""
    rng = random.Random(3)
    long = sentence(rng, 60_000, 5000)
    shared = sentence(rng, 80, 500)
    return [
        (1, None), (2, ""), (3, " \t\n\r\x0b\x0c "), (4, "one"), (5, "one two"), (6, "one"), (7, long), (8, long[: len(long) // 2]),
        (9, shared), (9, shared), (10, shared + " end"), (11, "start " + shared), (None, shared), (None, "alone without id"),
        (None, None), (12, "naïve Ünïcode space ⁂ 漢字"), (12, "another text with the id of another one"), (13, "#" * 300),
        (14, "a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a"),
        (-5, "line\nline\nline\n\nother line\nline"), (0, "UPPER lower UPPER"),
    ]


def similar_rows(seed: int, groups: int, copies: int, words: int, vocabulary: int) -> list[tuple[int, str]]:
    """Groups of edited copies in random order of ids."""
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = sentence(rng, rng.randrange(1, words), vocabulary).split()
        for _ in range(rng.randrange(1, copies)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(own))
    ids = rng.sample(range(10 * len(texts)), len(texts))
    return list(zip(ids, texts, strict=True))
