"""Vector code compression: product codes of integer vectors, the nearest codebook entry found by slice and intersect.

A vector is cut into equal consecutive parts, and each part gets the number of the nearest entry of its position's codebook. Per codebook
and dimension the entries' coordinates are sorted, and prefix mask r, a 64-bit word, has the bits of the r first entries. A part's initial
radius is its distance to the entry next to it in the dimension in which the codebook spreads most, so no entry within it can
be missed: an entry nearer or as near differs by no more than that in every dimension. The radius selects a range of the
sorted coordinates per dimension (two binary searches, prefix mask AND NOT prefix mask); the AND of the dimensions' words is the exact
candidate set, the entries in a box around the part. Full distances are taken for candidates only.

The integer vectors are written once. A round reads them and sends one row per entry and component and task through the shuffle;
entries x width sums come to the driver and go out again as codebooks, whatever the number of vectors.

Dropped: null vectors and vectors with a null, NaN or infinite component. Codebooks start as the parts of the smallest vec_ids; rows that
repeat an id follow in the order of their components, rows without an id come last; with fewer vectors than entries there are
as many entries. Nearest ties go to the lower entry, an unused entry stays. Vectors of another length than the most frequent
one divisible by the number of parts (the shorter of equally frequent ones) stay in the result with null code and error and take no part. An
empty table gives no rows. Components of 2^26 or more end the job. vec_id, embedding and label are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.llm.common import in_batches, steps, table
from freightlens.llm.vectors import SUMS, decimal_sha256, integer_vectors, matrix, moved, sum_rows
from freightlens.session import Workspace

SCALE = 4096
PARTS = 8
ENTRIES = 16  # at most 64, the bits of a mask
ROUNDS = 6


class Slices:
    """One position's codebook (entries, dimensions), sorted per dimension, with prefix masks."""

    def __init__(self, book: np.ndarray):
        self.book = book
        bits = np.left_shift(np.uint64(1), np.arange(len(book), dtype=np.uint64))
        order = book.argsort(axis=0, kind="stable")
        self.sorted = np.take_along_axis(book, order, axis=0)
        self.masks = np.zeros((len(book) + 1, book.shape[1]), np.uint64)
        self.masks[1:] = np.bitwise_or.accumulate(bits[order], axis=0)
        self.widest = int(np.ptp(book, axis=0).argmax())
        self.order = order[:, self.widest]

    def radius(self, x: np.ndarray) -> np.ndarray:
        """Per row the whole part of the distance to the entry next to it in the widest dimension."""
        along = self.sorted[:, self.widest]
        right = np.searchsorted(along, x[:, self.widest]).clip(0, len(along) - 1)
        left = (right - 1).clip(0)
        nearer = np.where(np.abs(along[left] - x[:, self.widest]) <= np.abs(along[right] - x[:, self.widest]), left, right)
        squared = ((x - self.book[self.order[nearer]]) ** 2).sum(axis=1)
        root = np.sqrt(squared.astype(np.float64)).astype(np.int64)
        root += (root + 1) ** 2 <= squared  # the square root of a long may be off by one
        return root

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Per row the mask of the entries that differ by at most radius in every dimension."""
        found = np.full(len(x), np.uint64(2**64 - 1))
        for d in range(x.shape[1]):
            low = np.searchsorted(self.sorted[:, d], x[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], x[:, d] + radius, "right")
            found &= self.masks[high, d] & ~self.masks[low, d]
        return found

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row the nearest entry, the first of equal ones, and the squared distance."""
        mask = self.candidates(x, self.radius(x))
        best, entry = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int64)
        for e in range(len(self.book)):
            rows = np.flatnonzero((mask >> np.uint64(e)) & np.uint64(1))
            squared = ((x[rows] - self.book[e]) ** 2).sum(axis=1)
            less = squared < best[rows]
            best[rows[less]], entry[rows[less]] = squared[less], e
        return entry, best


def coded(x: np.ndarray, slices: list[Slices]) -> tuple[np.ndarray, np.ndarray]:
    """(rows, parts) entries and squared distances."""
    found = [s.nearest(part) for s, part in zip(slices, np.split(x, len(slices), axis=1))]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _slices(books: np.ndarray, parts: int) -> list[Slices]:
    """Of books (parts * entries, dimensions), by position and entry."""
    return [Slices(book) for book in np.split(books, parts)]


def _round_sums(vectors: DataFrame, books: np.ndarray, parts: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices, totals, counts = _slices(books, parts), np.zeros_like(books), np.zeros(len(books), np.int64)
        entries = len(books) // parts
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("vector"))
                codes = coded(x, slices)[0]
                for p, piece in enumerate(np.split(x, parts, axis=1)):
                    cells = codes[:, p] + p * entries
                    counts += np.bincount(cells, minlength=len(books))
                    np.add.at(totals, cells, piece)
        yield sum_rows(totals, counts)

    return in_batches(vectors.select("vector"), work, SUMS)


def _codes(vectors: DataFrame, books: np.ndarray, parts: int) -> DataFrame:
    hexes = np.array([f"{e:02x}" for e in range(256)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = _slices(books, parts)
        for batch in batches:
            if batch.num_rows:
                codes, squared = coded(matrix(batch.column("vector")), slices)
                texts = ["".join(row) for row in hexes[codes]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("label"), pa.array(texts, pa.string()), pa.array(squared.sum(axis=1))],
                    names=["vec_id", "label", "code", "error"],
                )

    kind = vectors.schema["label"].dataType.simpleString()
    return in_batches(vectors.select("vec_id", "label", "vector"), work, f"vec_id long, label {kind}, code string, error long")


def slice_codes(ws: Workspace, embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, code, error) per kept vector, codebooks by position, entry and place)."""
    vectors = ws.write(integer_vectors(embeddings.select("vec_id", "embedding", "label"), SCALE), ws.fresh("vectors"))
    size = F.size("vector")
    lengths = vectors.where((size > 0) & (size % parts == 0)).groupBy(size.alias("size")).count()
    usual = lengths.orderBy(F.desc("count"), "size").first()
    if usual is None:
        odd = vectors.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        return odd, np.zeros((0, 0), np.int64)
    whole = vectors.where(size == usual["size"])
    starts = np.array([r.vector for r in whole.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()], np.int64)
    books = np.concatenate(np.split(starts, parts, axis=1))
    for _ in range(rounds):
        books = moved(books, _round_sums(whole, books, parts))
    other = vectors.where(size != usual["size"]).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")
    )
    return ws.write(_codes(whole, books, parts).unionByName(other), ws.fresh("codes")), books


def op12_slice_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = slice_codes(steps(spark), table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    totals = found.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return found.join(totals, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(decimal_sha256(books.ravel())).alias("codebooks_sha256")
    )


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same rounds by comparing every part with every entry, on lists of whole doubles, which hold these sums exactly."""
    distance = "list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, c.x) + list_inner_product(c.x, c.x)"
    sql = [f"""
WITH kept AS (
    SELECT vec_id, label, CAST(list_transform(embedding, lambda e: floor(4096 * CAST(e AS DOUBLE))) AS DOUBLE[]) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = len(embedding)
), rows_ AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, x) - 1 AS nr, vec_id, label, x, len(x) // {parts} AS width FROM kept
), vectors AS MATERIALIZED (
    SELECT nr, p, x[p * width + 1 : (p + 1) * width] AS x FROM rows_ CROSS JOIN range({parts}) AS places(p)
), books_0 AS MATERIALIZED (
    SELECT p, nr AS entry, x FROM vectors WHERE nr < {entries}
)"""]
    for r in range(rounds + 1):
        sql.append(f""", assigned_{r} AS MATERIALIZED (
    SELECT v.nr, v.p, arg_min(c.entry, ({distance}, c.entry)) AS entry, min({distance}) AS error
    FROM vectors v JOIN books_{r} c ON c.p = v.p GROUP BY v.nr, v.p
)""")
        if r < rounds:
            sql.append(f""", books_{r + 1} AS MATERIALIZED (
    SELECT c.p, c.entry, coalesce(s.x, c.x) AS x FROM books_{r} c LEFT JOIN (
        SELECT p, entry, list(total ORDER BY place) AS x FROM (
            SELECT p, entry, place, floor(sum(e) / count(*)) AS total
            FROM (SELECT a.p, a.entry, unnest(v.x) AS e, generate_subscripts(v.x, 1) AS place FROM assigned_{r} a JOIN vectors v USING (nr, p)) GROUP BY p, entry, place
        ) GROUP BY p, entry
    ) s ON s.p = c.p AND s.entry = c.entry
)""")
    sql.append(f""", codes AS (
    SELECT nr, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(error) AS BIGINT) AS error FROM assigned_{rounds} GROUP BY nr
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda e: CAST(CAST(e AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY p, entry)) FROM books_{rounds})
        AS codebooks_sha256
FROM codes JOIN rows_ USING (nr)
""")
    return "".join(sql)


OP12_SQL = _sql()
