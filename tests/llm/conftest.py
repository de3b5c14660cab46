import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = (
    "the quick brown fox jumps over the lazy dog and then the dog sleeps all day long in the warm sun while the fox runs away\n"
    "a second line of some plain words follows here so that the text has more than one line to look at\nand a third line ends it now"
)


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty, blank and very long texts, copies, repeated rows, odd characters."""
    rows = [
        (1, PROSE, "en", "a", 10),
        (2, PROSE, "en", "a", 10),
        (3, PROSE + " with a small change at the end", "en", "b", 10),
        (4, None, "en", "a", None),
        (5, "", "en", None, 0),
        (6, " \t\n\r\n ", None, "a", 5),
        (None, PROSE, "en", "b", 10),
        (None, None, None, None, None),
        (7, "word", "en", "c", 4),
        (8, "uno dos tres cuatro cinco", "es", "c", 4),
        (8, "uno dos tres cuatro cinco", "es", "c", 4),
        (9, "der die das und\nnicht mit den <|endoftext|> ßöü   İstanbul é ﬁ 漢字 🙂 \x1c\x85\xa0", "de", "b", 3),
        (10, " ".join(f"word{i % 5000}" for i in range(40_000)), "en", "a", 9),
        (11, "\n".join(["the same line again and again in one text"] * 30), "en", "", 9),
        (12, "12 34 !! ?? ## && || <>", None, "a", 3),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="session")
def wide_docs(edge_docs):
    """The same with columns whose names the operators might use themselves."""
    from pyspark.sql import functions as F

    names = ("id", "row", "words", "size", "digest", "key", "block", "host", "n_words", "start", "sid", "index", "label", "items", "a", "b", "n", "count", "rep", "flat", "lines", "kept", "bucket", "tokens")
    return edge_docs.select("*", *[F.lit(n).alias(n) for n in names])


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
