import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(ROOT / "tests" / "llm")]

LONG = "alpha beta gamma delta " * 3000 + "the end"
PASSAGE = " ".join(f"word{i}" for i in range(60))


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text): nulls in both columns, empty and very long texts,
    repeated rows, ties, odd white space, special strings, other scripts."""
    return [
        (1, "Hello world, this is a plain text of a few ordinary words for testing."),
        (2, None), (3, ""), (4, " \t\n\r\x0b\x0c "), (5, LONG), (6, LONG),
        (7, "start " + PASSAGE + " tail one"), (8, "other " + PASSAGE + " tail two"), (9, PASSAGE), (9, PASSAGE),
        (None, "no id at all but some words in here that are ten"), (None, None), (None, None),
        (10, "a<|endoftext|> b <|endoftext|>"), (11, "x\x1cy z   日本語 \U0001F600 é"),
        (12, "mail me: a.b@c.de or 4111 1111 1111 1111, +1 (456) 555-2186 at 10.0.0.300 or 10.0.0.3"),
        (13, "line one here\nline one here\nline two ### $$$ %%% here\nline one here"),
        (14, "Licensed under the Apache License, Version 2.0."), (15, "a a a a a a a a a a a a a a a " * 4),
        (-16, "negative id " * 12), (17, "ONE two"), (18, "one TWO"),
    ]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with extra columns whose names operators use themselves."""
    data = [(i, t, "x", 1, 2, "f", 3, None) for i, t in rows]
    return spark.createDataFrame(
        data, "doc_id bigint, text string, th string, n_words int, part int, ids string, fp int, key string").repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.filter("false")
