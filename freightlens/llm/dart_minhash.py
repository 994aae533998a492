"""Near-duplicate documents by DartMinHash over word shingles.

A text is a weighted set: its shingles of SHINGLE words (all words, if fewer), weighted by how often they occur. Each unit
of an element's weight is a strip of the (weight, rank) plane into which hashed darts fall as a Poisson process of
density 1: the same darts for the same strip in every text. Ranks are laid out in regions that double in height, and a
text throws regions from the lowest up until each of its K coordinates has a dart; every dart is dealt to a
coordinate by its hash, and the earliest of a coordinate is its signature entry. Two texts agree in an entry with
probability equal to their weighted Jaccard similarity.

Entries are banded. Texts that share a band are compared with one leader of that band, exactly, on their whole weighted
shingle sets; bands whose members are not in one component after that get other leaders, and in the end the members
left are joined on the rarest of their elements, at one of which two similar sets must meet. So no band emits all its pairs,
and no link of a band is missed. Components of links of similarity THRESHOLD or more are the classes.

Texts of equal word sequences are one text from the start. A text without words (null, empty) is a near duplicate of nothing:
its class is its own doc_id. Rows of one doc_id count as one document whose texts are linked. Only doc_id and
text are read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cache
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.llm.common import hashed_words, in_batches, mixed, paired, signed, some_at_a_time, steps, table, window_hashes
from freightlens.llm.similar import similar_components
from freightlens.session import Workspace

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 24
ROWS = 5  # a pair of similarity 0.8 shares none of 24 bands of 5 once in 14,000 times, one of 0.85 once in a million
LOWEST = 1 / 16  # height of the first rank region
EMPTY = np.iinfo(np.uint64).max
LOW_BITS = np.uint64(0xFFFFFFFF)


def elements(hashes: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """One 64-bit hash per unit of weight: the n-th occurrence of a shingle of the words hashed is (shingle, n)."""
    if not len(hashes):
        return hashes
    hashes = np.sort(window_hashes(hashes, min(shingle, len(hashes))))
    first = np.r_[True, hashes[1:] != hashes[:-1]]
    start = np.maximum.accumulate(np.where(first, np.arange(len(hashes)), 0))
    return paired(hashes, (np.arange(len(hashes)) - start).astype(np.uint64))


@cache
def _poisson_edges(mean: float) -> np.ndarray:
    """64-bit limits of the cumulative distribution: the number of limits up to a hash is a Poisson number."""
    p, total, out = np.exp(-mean), 0.0, []
    for n in range(1, 30):
        total += p
        out.append(min(int(total * 2.0**64), (1 << 64) - 1))
        p *= mean / n
    return np.array(out, np.uint64)


def signatures(sets: list[np.ndarray], k: int) -> np.ndarray:
    """A row of K entries per set: of the darts dealt to a coordinate, 32 bits of the one of least rank. No set is empty."""
    best = np.full(len(sets) * k, EMPTY, np.uint64)
    sizes = np.array([len(s) for s in sets])
    owner, strips = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
    wanted = k * (log(k) + 2)
    low, high, level = 0.0, LOWEST, 0
    while len(strips):
        cells = max(1, round(high - low))
        edges = _poisson_edges((high - low) / cells)
        for cell in range(cells):
            keys = mixed(strips + np.uint64((level << 40 | cell) * 0x2545F4914F6CDD1D & (1 << 64) - 1))
            hit = np.flatnonzero(keys >= edges[0])
            keys = keys[hit]
            numbers = np.searchsorted(edges, keys, "right")
            nth = np.arange(numbers.sum()) - np.repeat(np.cumsum(numbers) - numbers, numbers)
            darts = paired(np.repeat(keys, numbers), nth.astype(np.uint64))
            height = (high - low) / cells
            ranks = (low + height * (cell + (darts >> np.uint64(40)).astype(np.float64) / 2.0**24)).astype(np.float32)
            entries = (ranks.view(np.uint32).astype(np.uint64) << np.uint64(32)) | (mixed(darts) & LOW_BITS)
            coordinate = ((darts & LOW_BITS) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
            np.minimum.at(best, np.repeat(owner[hit], numbers) * k + coordinate, entries)
        low, high, level = high, high * 2, level + 1
        done = (sizes * low >= wanted) & (best.reshape(-1, k).max(axis=1) != EMPTY)
        left = ~done[owner]
        owner, strips = owner[left], strips[left]
    return best.reshape(-1, k) & LOW_BITS


def band_keys(entries: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per band of every row of entries."""
    split = entries.reshape(len(entries), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), split.shape[:2])
    for i in range(rows):
        key = paired(key, split[:, :, i])
    return key


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, h1, h2, n, bands) per row: 128-bit hash of the word sequence, weight, band keys; nulls without words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            hashed = hashed_words(texts)
            out: list[tuple] = [(None, None, 0, None)] * len(ids)
            for lo, hi in some_at_a_time(hashed):
                full = [i for i in range(lo, hi) if len(hashed[i])]
                if not full:
                    continue
                sets = [elements(hashed[i], shingle) for i in full]
                keys = signed(np.ascontiguousarray(band_keys(signatures(sets, bands * rows), bands, rows)))
                for i, strips, key in zip(full, sets, keys):
                    whole = xxhash.xxh3_128_digest(hashed[i].tobytes())
                    out[i] = (*struct.unpack("<qq", whole), len(strips), key)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            columns = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *columns], ["doc_id", "h1", "h2", "n", "bands"])

    return in_batches(docs.select(F.col("doc_id").cast("long"), "text"), work, "doc_id long, h1 long, h2 long, n long, bands array<long>")


def element_sets(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [signed(elements(h, shingle)) for h in hashed_words(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "e"])

    return in_batches(docs, work, "node long, e array<long>")


def near_duplicate_classes(
    ws: Workspace, docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE
) -> DataFrame:
    """(doc_id, class_id) per row of docs; class_id is the smallest doc_id of the class."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    sketched = ws.write(sketches(docs, bands, rows, shingle), ws.fresh("sketches"))
    texts = sketched.where("h1 is not null and doc_id is not null").groupBy("h1", "h2")
    nodes = ws.write(texts.agg(F.min(F.struct("doc_id", "n", "bands")).alias("s")).select("h1", "h2", "s.*"), ws.fresh("nodes"))
    banded = nodes.select(F.explode("bands").alias("band"), F.col("doc_id").alias("node"), "n")
    classes = similar_components(
        ws, banded, lambda wanted: element_sets(docs.join(wanted, docs.doc_id == wanted.node).select("node", "text"), shingle).distinct(), threshold
    )
    known = nodes.select("h1", "h2", F.col("doc_id").alias("node"))
    known = known.withColumn("component", F.col("node")) if classes is None else known.join(classes, "node", "left")
    return sketched.select("doc_id", "h1", "h2").join(known, ["h1", "h2"], "left").select(
        "doc_id", F.coalesce("component", "node", "doc_id").alias("class_id")
    )


def op2_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(steps(spark), table(spark, sf_dir, "documents", "doc_id", "text"))
