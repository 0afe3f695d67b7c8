"""Small tables with the cases that every operator must take."""

from __future__ import annotations

import pytest

from tremorlane.llm.queries import importable

DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " fingerprint string, component_id long, ids binary, row long, start long, score double"
)

PASSAGE = " ".join(f"word{i} shared passage" for i in range(30))
LONG = " ".join(f"t{i * 7919 % 1009}x{i % 13}" for i in range(40_000))


@pytest.fixture(scope="session")
def shipped(spark):
    importable(spark)
    return spark


@pytest.fixture(scope="session")
def docs_of(shipped):
    """Rows (doc_id, text) as a table whose other columns are null and clash in name."""

    def make(rows):
        return shipped.createDataFrame([(*row, *[None] * 9) for row in rows], DOCS).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, a very long one, ties and repeated rows."""
    return [
        (1, "The quick brown fox jumps over the lazy dog."),
        (2, "the QUICK brown fox\tjumps  over the lazy dog."),
        (3, None),
        (4, ""),
        (5, " \n "),
        (6, LONG),
        (7, f"Before that. {PASSAGE} And after."),
        (8, f"Something else first, {PASSAGE}"),
        (9, "ein Wort"),
        (10, "é́ 日本語 \x00 \x1c <|endoftext|> 😀"),
        (10, "é́ 日本語 \x00 \x1c <|endoftext|> 😀"),
        (11, LONG),
        (None, "no id at all, but a text of some words"),
        (None, None),
        (12, "ab" * 400),
    ]


@pytest.fixture(scope="session")
def odd_docs(docs_of, odd_rows):
    return docs_of(odd_rows).cache()


@pytest.fixture(scope="session")
def no_docs(docs_of):
    return docs_of([])
