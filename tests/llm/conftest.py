import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use themselves.
        *[T.StructField(n, T.StringType()) for n in ("key", "keep", "row", "id", "bucket", "block", "copy", "rank", "epoch", "h1", "label")],
    ]
)


def document(doc_id, text, lang="en", source="src1"):
    return (doc_id, text, lang, source, None if text is None else len(text), *["x"] * 11)


def make_words(n, seed):
    rng = random.Random(seed)
    return [rng.choice("abcdefgh") + rng.choice("aeiou") + str(rng.randrange(40)) for _ in range(n)]


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and very long texts, ties, repeated rows, odd white space and characters."""
    words = make_words(400, 1)
    passage = " ".join(make_words(60, 2))
    shared_line = "This Line is Shared by Many documents"
    long_text = "\n".join(" ".join(make_words(50, 100 + i)) for i in range(1200))
    rows = [
        document(1, None),
        document(2, ""),
        document(3, "   \n\t \n"),
        document(4, "one"),
        document(5, "é" * 7 + " ü\x0bö \U0001f600\U0001f600 ﬁ"),
        document(6, " ".join(words[:120])),
        document(7, " ".join(words[:120])),  # exact copy
        document(8, "  ".join([*words[:118], "changed", "words"])),  # near copy
        document(9, f"{shared_line}\n" + " ".join(words[120:200])),
        document(10, f"  {shared_line.upper()} \n" + " ".join(words[200:280])),
        document(11, f"{shared_line}\n{shared_line}\n" + " ".join(words[280:360])),
        document(12, " ".join(words[300:340]) + " " + passage + " " + " ".join(words[10:40])),
        document(13, passage + "\n" + passage),
        document(14, long_text),
        document(15, long_text[:90000]),
        document(16, "spam " * 300),
        document(17, "***".join(words[:100])),
        document(18, " ".join(words[100:190]), None, None),
        document(None, " ".join(words[50:150])),
        document(None, None),
        document(20, " ".join(words[220:330])),
        document(20, " ".join(words[220:330])),  # repeated row
        document(21, "line\n" * 30),
        document(-3, "negative id " + " ".join(words[330:400])),
        document(23, "a <|endoftext|> b"),
    ]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
