"""Small documents that hold every awkward case."""

from __future__ import annotations

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Names that the operators use inside.
CLASHING = ["fp", "component_id", "root", "key", "h", "n", "m", "k", "words", "w", "w0", "lines", "rank", "pos", "dk", "gone"]
CLASHING += ["node", "shard", "slot", "size", "bin", "kept", "own", "norm", "score", "chosen", "n_items", "first_item", "ids"]


def sentence(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def texts(seed: int = 1) -> list[str | None]:
    rng = random.Random(seed)
    base = sentence(rng, 120)
    passage = sentence(rng, 60)
    near = base.split(" ")
    near[50] = "changed"
    out = [
        None, "", " \t\n\x0b", "one", "two words", " no-break ", "Ünïcödé ß 漢字 🙂 é", "<|endoftext|> in a text<|endoftext|>",
        base, base, base + " ", base.upper(), " ".join(near), "same " * 100, "line\n" * 12, "\n\n\n", "a\nb\nc\nd", "x\na\nb\nc\ny", "1 2 3",
        "z" * 5_000, sentence(rng, 6_000),
    ]
    out += [sentence(rng, rng.randrange(1, 90)) for _ in range(40)]
    out += [f"{sentence(rng, 10 + i)} {passage} {sentence(rng, 5)}" for i in range(6)]
    return out


def documents(spark, seed: int = 1, clashing: bool = False):
    """One row for each text, two rows that are the same, and rows without an id."""
    rows = [(i, t, ["en", "de", None][i % 3], "s", None) for i, t in enumerate(texts(seed))]
    rows += [rows[8], rows[25], (None, rows[30][1], None, None, None), (None, None, None, None, None), (None, "alone without an id", "en", None, 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.select("*", *[F.lit(7).alias(c) for c in CLASHING]) if clashing else df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
