from __future__ import annotations

import pytest

from .awkward_rows import CLASH, ROWS

@pytest.fixture(scope="session")
def awkward(spark):
    kind = "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASH)
    rows = [(*r, *[None if i % 2 else "x"] * len(CLASH)) for i, r in enumerate(ROWS)]
    return spark.createDataFrame(rows, kind).repartition(3)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    """Whole texts of the small table by id."""
    return {r["doc_id"]: r["text"] for r in documents.collect()}
