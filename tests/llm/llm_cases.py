"""Shared cases; the session comes from the conftest above."""

import pytest

SF = "/root/testdata/sf0.001"

EDGES = [
    (1, None), (2, ""), (3, "one"), (4, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"),
    (6, "long " * 30_000), (7, "Ärger mit\tUmlauten, é <|endoftext|> \U0001f600 x"), (8, "   \n\t  "),
]


@pytest.fixture()
def edges(spark):
    """Edge-case documents, with extra columns whose names clash with the operators' own."""
    rows = [(d, t, "en", "s", len(t or ""), 1, 2, None, "x") for d, t in EDGES]
    schema = ("doc_id long, text string, lang string, source string, n_chars long, node int, cluster int, "
              "overlap string, quality string")
    return spark.createDataFrame(rows, schema)
