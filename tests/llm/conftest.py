import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


@pytest.fixture
def documents(spark):
    """Documents with nulls, empty texts, copies, a long text and a column that clashes with results."""

    def make(texts, ids=None, **columns):
        ids = list(range(len(texts))) if ids is None else ids
        extra = [c for c in columns]
        rows = [(i, t, *[columns[c][n] for c in extra]) for n, (i, t) in enumerate(zip(ids, texts))]
        kinds = "".join(f", {c} string" for c in extra)
        return spark.createDataFrame([(*r, "x") for r in rows], f"doc_id long, text string{kinds}, score string")

    return make
