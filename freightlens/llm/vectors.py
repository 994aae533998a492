"""Embeddings as integer vectors, and the sums that both vector operators take per round."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 1 << 26  # of a component's magnitude: squared distances of 64 components then fit a long


def integer_vectors(embeddings: DataFrame, scale: int) -> DataFrame:
    """embeddings without unusable rows, `vector` = floor(scale * component) as array<long>.

    Dropped: null vectors, vectors with a null, NaN or infinite component. A component whose integer reaches LIMIT ends the
    job with an error, as distances would not fit a long.
    """
    at = F.col("embedding")
    usable = at.isNotNull() & F.forall(at, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))

    def whole(x: Column) -> Column:
        value = F.floor(x.cast("double") * F.lit(float(scale)))
        return F.when(F.abs(value) < LIMIT, value).otherwise(F.raise_error(F.lit(f"a component times {scale} is beyond {LIMIT}")).cast("long"))

    return embeddings.where(usable).withColumn("vector", F.transform(at, whole)).drop("embedding")


def matrix(column: pa.ListArray) -> np.ndarray:
    """The rows of a list column of equal lengths."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


SUMS = "cell long, at long, total long, n long"


def sum_rows(totals: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """A task's sums per cell (row of totals) and component, as rows of SUMS; a cell without members has none."""
    used = np.flatnonzero(counts)
    width = totals.shape[1]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(used, width).astype(np.int64)), pa.array(np.tile(np.arange(width, dtype=np.int64), len(used))),
            pa.array(totals[used].ravel().astype(np.int64)), pa.array(np.repeat(counts[used], width).astype(np.int64)),
        ],
        names=["cell", "at", "total", "n"],
    )


def moved(centres: np.ndarray, sums: DataFrame) -> np.ndarray:
    """centres with floor(sum / count) for every cell that has members. Collects a row per cell and component, whatever the input."""
    found = sums.groupBy("cell", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).toArrow()
    cell, at, total, n = (found.column(c).to_numpy() for c in ("cell", "at", "total", "n"))
    centres = centres.copy()
    centres[cell, at] = np.floor_divide(total, n)
    return centres


def decimal_sha256(numbers: Iterable[int]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in numbers).encode()).hexdigest()
