"""Centroid clustering on bit planes: exact k-means of integer vectors by AND and popcount.

A component is an integer of B bits in two's complement, B wide enough for the table's largest. Bit plane i of a vector packs bit i of its
64 components into one 64-bit word, so a vector is B words. With plane weights w(i) = 2^i, and -2^i for the sign plane, the
dot product of x and c is the sum over i, j of w(i) w(j) popcount(x_i AND c_j), and |x - c|^2 = x.x - 2 x.c + c.c: all
exact. Sums of a cluster come from the planes too: w(i) times how many members have bit i of a component set.

The planes are written once. A round reads them, assigns in the tasks and sends one row per cluster and component and task
through the shuffle; only k * 64 sums come to the driver and go out again as centroids, whatever the number of vectors or
the size of a cluster.

Kept are vectors of exactly 64 components, none null, NaN or infinite; others are absent from the result. The first centroids are the kept
vectors with the smallest sha256 of "3:<vec_id>"; equal ids follow in the order of their components, rows without an id come
last. With fewer than k kept vectors there are as many centroids. Nearest ties go to the smaller number, an empty cluster keeps its
centroid. Rows that repeat an id or a vector count each. An empty table gives no rows. Components of 2^26 or more end the job.
Only vec_id and embedding are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freightlens.llm.common import in_batches, steps, table
from freightlens.llm.vectors import SUMS, decimal_sha256, integer_vectors, matrix, moved, sum_rows
from freightlens.session import Workspace

WIDTH = 64  # components, one bit each of a word
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = "3:"


def planes_of(x: np.ndarray, bits: int) -> np.ndarray:
    """(n, 64) integers as (n, bits) words; component c is bit c of each word."""
    out = np.empty((len(x), bits), np.uint64)
    for i in range(bits):
        set_ = ((x >> i) & 1).astype(np.uint8)
        out[:, i] = np.packbits(set_, axis=1, bitorder="little").view("<u8").reshape(-1)
    return out


def plane_weights(bits: int) -> np.ndarray:
    weights = np.left_shift(np.int64(1), np.arange(bits, dtype=np.int64))
    weights[-1] *= -1
    return weights


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact dot products of all vectors of a with all of b, both as planes."""
    weights = plane_weights(a.shape[1])
    total = np.zeros((len(a), len(b)), np.int64)
    for i, left in enumerate(weights):
        part = np.zeros_like(total)
        for j, right in enumerate(weights):
            part += right * np.bitwise_count(a[:, i, None] & b[None, :, j])
        total += left * part
    return total


def assigned(planes: np.ndarray, norms: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per vector the nearest centre, the first of equal ones, and the squared distance."""
    squared = norms[:, None] - 2 * dots(planes, planes_of(centres, planes.shape[1])) + (centres * centres).sum(axis=1)[None, :]
    nearest = squared.argmin(axis=1)
    return nearest, squared[np.arange(len(squared)), nearest]


def member_sums(planes: np.ndarray, nearest: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per cluster the sums of the components, by counting set bits per plane, and the number of members."""
    weights = plane_weights(planes.shape[1])
    totals = np.zeros((k, WIDTH), np.int64)
    for cluster in np.unique(nearest):
        of = planes[nearest == cluster]
        for i, weight in enumerate(weights):
            bits = np.unpackbits(np.ascontiguousarray(of[:, i]).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            totals[cluster] += weight * bits.sum(axis=0, dtype=np.int64)
    return totals, np.bincount(nearest, minlength=k)


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return matrix(batch.column("planes")).view(np.uint64), batch.column("norm").to_numpy(zero_copy_only=False)


def with_planes(vectors: DataFrame, bits: int) -> DataFrame:
    """(vec_id, planes, norm) of vectors (vec_id, vector)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("vector"))
                words = planes_of(x, bits).view(np.int64)
                planes = pa.ListArray.from_arrays(np.arange(0, words.size + 1, bits, dtype=np.int32), words.ravel())
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), planes, pa.array((x * x).sum(axis=1))], names=["vec_id", "planes", "norm"])

    return in_batches(vectors.select("vec_id", "vector"), pack, "vec_id long, planes array<long>, norm long")


def _round_sums(planes: DataFrame, centres: np.ndarray) -> DataFrame:
    k = len(centres)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros((k, WIDTH), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if batch.num_rows:
                words, norms = _read(batch)
                sums, n = member_sums(words, assigned(words, norms, centres)[0], k)
                totals, counts = totals + sums, counts + n
        yield sum_rows(totals, counts)

    return in_batches(planes, work, SUMS)


def _assignments(planes: DataFrame, centres: np.ndarray) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                nearest, squared = assigned(*_read(batch), centres)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(nearest.astype(np.int32)), pa.array(squared)], names=["vec_id", "cluster", "distance"]
                )

    return in_batches(planes, work, "vec_id long, cluster int, distance long")


def bit_plane_clusters(ws: Workspace, embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: str = SEED) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) per kept vector, final centroids)."""
    vectors = integer_vectors(embeddings.select("vec_id", "embedding"), SCALE).where(F.size("vector") == WIDTH)
    vectors = ws.write(vectors, ws.fresh("vectors"))
    first = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    starts = vectors.orderBy(first.asc_nulls_last(), "vector").limit(k).select("vector").collect()
    if not starts:
        return ws.spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, WIDTH), np.int64)
    centres = np.array([r.vector for r in starts], np.int64)
    reach = vectors.agg(F.max(F.array_max("vector")).alias("high"), F.min(F.array_min("vector")).alias("low")).first()
    bits = max(int(reach.high).bit_length(), (~int(reach.low)).bit_length() if reach.low < 0 else 0) + 1
    planes = ws.write(with_planes(vectors, bits), ws.fresh("planes"))
    for _ in range(rounds):
        centres = moved(centres, _round_sums(planes, centres))
    return ws.write(_assignments(planes, centres), ws.fresh("assigned")), centres


def op11_bit_plane_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centres = bit_plane_clusters(steps(spark), table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    shas = [(c, decimal_sha256(centre)) for c, centre in enumerate(centres)]
    shas = spark.createDataFrame(shas, "nr int, centroid_sha256 string")
    totals = found.groupBy(F.col("cluster").alias("nr")).agg(F.sum("distance").alias("cluster_inertia"))
    totals = totals.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy()))  # over a row per cluster
    return found.join(F.broadcast(totals.join(shas, "nr")), F.col("cluster") == F.col("nr")).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(k: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    """The same rounds, one after the other, on lists of whole doubles, which hold these sums exactly."""
    distance = "list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, c.x) + list_inner_product(c.x, c.x)"
    parts = [f"""
WITH kept AS (
    SELECT vec_id, CAST(list_transform(embedding, lambda e: floor(1024 * CAST(e AS DOUBLE))) AS DOUBLE[]) AS x FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64
), vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS nr, vec_id, x FROM kept
), centres_0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('{SEED}' || CAST(vec_id AS VARCHAR)) NULLS LAST, x) - 1 AS cluster, x FROM vectors
    QUALIFY cluster < {k}
)"""]
    for r in range(rounds + 1):
        parts.append(f""", assigned_{r} AS MATERIALIZED (
    SELECT v.nr, arg_min(c.cluster, ({distance}, c.cluster)) AS cluster, min({distance}) AS distance
    FROM vectors v CROSS JOIN centres_{r} c GROUP BY v.nr
)""")
        if r < rounds:
            parts.append(f""", centres_{r + 1} AS MATERIALIZED (
    SELECT c.cluster, coalesce(s.x, c.x) AS x FROM centres_{r} c LEFT JOIN (
        SELECT cluster, list(total ORDER BY place) AS x FROM (
            SELECT cluster, place, floor(sum(e) / count(*)) AS total
            FROM (SELECT a.cluster, unnest(v.x) AS e, generate_subscripts(v.x, 1) AS place FROM assigned_{r} a JOIN vectors v USING (nr)) GROUP BY cluster, place
        ) GROUP BY cluster
    ) s ON s.cluster = c.cluster
)""")
    parts.append(f"""
SELECT v.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance,
    CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(list_transform(c.x, lambda e: CAST(CAST(e AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM assigned_{rounds} a JOIN vectors v USING (nr) JOIN centres_{rounds} c ON c.cluster = a.cluster
""")
    return "".join(parts)


OP11_SQL = _sql()
