import os
import sys

import public_tokenizers
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

EXTRA = "doc_id long, text string, lang string, node long, key string, component string, size int, words string, start int"


@pytest.fixture(scope="session")
def bpe():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        return file.read()


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (id, text) with columns whose names the operators use inside."""
    def make(rows):
        return spark.createDataFrame([(i, t, None, 1, "k", "c", 0, "w", 5) for i, t in rows], EXTRA)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank, short, very long and repeated texts, and other scripts."""
    long = " ".join(f"word{i % 977} thing{i % 31}." for i in range(30_000))
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "one two"), (5, "ONE  two"), (6, long), (7, long + " tail"), (8, "x" * 50_000),
        (9, "a b c d e"), (9, "a b c d e"), (10, "A b c d\ne"), (None, "a b c d e f"), (11, "日本語 テキスト 😀 naïve café x"),
        (12, "don't stop <|endoftext|> now\r\n\r\nplease  wait"), (13, "a b c d e f g h i j k l m n o"), (14, "a b c d e f g h i j k l m n o p")]
