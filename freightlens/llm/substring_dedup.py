"""Substring deduplication by level-wise doubling of repeated windows.

Level 1 looks at windows of START words. Of every START + 1 consecutive windows the one of least hash is kept (winnowing),
so any two equal runs of 2 * START words have a kept window in the same place. Kept windows found in two documents alone
survive, and the windows of twice that length that contain them are compared next; from then on a window of twice
the length is compared if both of its halves survived. This goes on until LENGTH is reached or no candidate survives.

A word of a document is removed if a window of LENGTH words covers it whose words also start in a document with a smaller
doc_id; windows are judged on the input. Level 1 compares 64-bit hashes (a chance match only costs a comparison), later
levels and whole texts 128-bit ones. Of equal texts only the document of smallest id is compared, as the others go whole. Null
and empty texts have no words. Rows that repeat a doc_id are one document for the comparison; each of them is cut and returned.
Rows without doc_id come after all documents: they lose what a document holds, and nothing is removed because of them. Only
doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.llm.common import hashed_words, in_batches, mixed, signed, steps, table, window_hashes, words_of
from freightlens.session import Workspace

START = 25
LENGTH = 50
SECOND = np.uint64(0x5851F42D4C957F2D)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) of every `width` consecutive values."""
    run, at = values, 1
    while at * 2 <= width:
        run, at = pick(run[:-at], run[at:]), at * 2
    rest = width - at
    return pick(run[: len(run) - rest], run[rest:]) if rest else run


def kept_windows(hashes: np.ndarray, among: int) -> np.ndarray:
    """Places whose hash is the least of some `among` consecutive ones; equal hashes keep all their places."""
    if len(hashes) < among:
        return np.empty(0, np.int64)
    least = _sliding(hashes, among, np.minimum)
    edge = np.zeros(among - 1, np.uint64)
    return np.flatnonzero(_sliding(np.r_[edge, least, edge], among, np.maximum) == hashes)


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _two(hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    return window_hashes(hashes, length), window_hashes(mixed(hashes ^ SECOND), length)


def first_level(docs: DataFrame, start: int = START) -> DataFrame:
    """Per row its words, the digest and a 128-bit hash of all of them, and the distinct hashes of its kept windows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, kept, whole = [], [], [], []
            texts = batch.column(2).to_pylist()
            for text, hashes in zip(texts, hashed_words(texts)):
                windows = window_hashes(hashes, start)
                sizes.append(len(hashes))
                digests.append(_digest(words_of(text)))
                whole.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                kept.append(signed(np.unique(windows[kept_windows(windows, start + 1)])))
            columns = [*batch.columns[:2], pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(whole, pa.binary())]
            columns.append(pa.array(kept, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n_words", "digest", "whole", "a"])

    return in_batches(docs, work, "doc_id long, row long, n_words long, digest string, whole binary, a array<long>")


def next_level(survived: DataFrame, length: int, first: bool) -> DataFrame:
    """The windows of twice `length` words around the surviving windows (`alive`, hashes of `length` words) of each row."""

    def candidates(words: np.ndarray, alive: np.ndarray) -> np.ndarray:
        windows = window_hashes(words, length)
        there = np.isin(windows, alive)
        n = max(0, len(words) - 2 * length + 1)
        if not first:
            return np.flatnonzero(there[:n] & there[length : length + n])
        places = np.flatnonzero(there)
        change = np.zeros(len(words) + length + 2, np.int32)  # starts from place - length to place
        np.add.at(change, np.maximum(places - length, 0), 1)
        np.add.at(change, places + 1, -1)
        return np.flatnonzero(np.cumsum(change)[:n] > 0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *ids, texts, alive = batch.columns
            one, two = [], []
            for i, words in enumerate(hashed_words(texts.to_pylist())):
                at = candidates(words, alive[i].values.to_numpy().view(np.uint64))
                a, b = _two(words, 2 * length)
                a, place = np.unique(a[at], return_index=True)
                one.append(signed(a))
                two.append(signed(b[at][place]))
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*ids, texts, pa.array(one, kind), pa.array(two, kind)], ["doc_id", "row", "text", "a", "b"])

    return in_batches(survived.select("doc_id", "row", "text", "alive"), work, "doc_id long, row long, text string, a array<long>, b array<long>")


def cut(found: DataFrame, length: int) -> DataFrame:
    """Rows without the words that their `alive` windows of `length` words cover."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *ids, texts, alive = batch.columns
            sizes, removed, before, digests = [], [], [], []
            whole = texts.to_pylist()
            for i, hashes in enumerate(hashed_words(whole)):
                words = words_of(whole[i])
                places = np.flatnonzero(np.isin(window_hashes(hashes, length), alive[i].values.to_numpy().view(np.uint64)))
                change = np.zeros(len(words) + 1, np.int32)
                np.add.at(change, places, 1)
                np.add.at(change, places + length, -1)
                stay = np.cumsum(change)[:-1] == 0
                sizes.append(len(words))
                removed.append(int(len(words) - stay.sum()))
                before.append(_digest(words))
                digests.append(_digest([w for w, s in zip(words, stay.tolist()) if s]))
            columns = [*ids, pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(before, pa.string()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n_words", "n_removed", "digest", "kept_sha256"])

    schema = "doc_id long, row long, n_words long, n_removed long, digest string, kept_sha256 string"
    return in_batches(found.select("doc_id", "row", "text", "alive"), work, schema)


def _of_doc(rows: DataFrame, others: DataFrame, how: str = "inner") -> DataFrame:
    """rows joined with others of the same document; rows without doc_id are told apart by `row`."""
    others = others.withColumnsRenamed({"doc_id": "_doc_id", "row": "_row"})
    same = rows["doc_id"].eqNullSafe(others["_doc_id"]) & (rows["row"] == others["_row"])
    return rows.join(others, same, how).drop("_doc_id", "_row")


def _alive(windows: DataFrame, keys: list[str], later_only: bool) -> DataFrame:
    """(doc_id, row, alive): each document's windows that another document has too; with later_only, one of smaller doc_id."""
    ends = [F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.max(F.col("doc_id").isNull()).alias("open")]
    repeated = windows.groupBy(*keys).agg(*ends).where("first < last or first is not null and open")
    of_doc = windows.join(repeated, keys)
    if later_only:
        of_doc = of_doc.where("doc_id > first or doc_id is null")
    return of_doc.groupBy("doc_id", "row").agg(F.collect_set("a").alias("alive"))


def remove_repeats(ws: Workspace, docs: DataFrame, length: int = LENGTH, start: int = START) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per row of docs. `length` is `start` doubled once or more."""
    row = F.when(F.col("doc_id").isNull(), F.xxhash64("text").bitwiseOR(F.lit(1))).otherwise(F.lit(0).cast("long"))
    docs = docs.select(F.col("doc_id").cast("long"), "text").select("doc_id", row.alias("row"), "text")
    level = ws.write(first_level(docs, start), ws.fresh("level"))
    # of equal texts only the document of smallest id takes part: every window of the others also starts there
    member = F.struct("doc_id", "row", "a")
    original = F.coalesce(F.min(F.when(F.col("doc_id").isNotNull(), member)), F.min(member))
    originals = level.where(f"n_words >= {length}").groupBy("whole").agg(original.alias("o")).select("whole", "o.*")
    firsts = originals.select(F.col("whole").alias("text"), F.col("doc_id").alias("first"))
    known = level.select("doc_id", "row", "n_words", "digest", "whole").join(firsts, F.col("whole") == F.col("text"), "left")
    known = known.withColumn("copy", F.expr("first is not null and (doc_id is null or doc_id > first)"))
    results = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    gone, rest = known.where("copy"), known.where("not copy").drop("text")
    gone_results = gone.select("doc_id", "n_words", F.col("n_words").alias("n_removed"), F.lit(_digest([])).alias("kept_sha256"))
    rest = rest.select("doc_id", "row", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("digest").alias("kept_sha256"))
    windows, texts, at = originals.select("doc_id", "row", F.explode("a").alias("a")), docs, start
    while at < length:
        survived = _of_doc(texts, _alive(windows, ["a"] if at == start else ["a", "b"], False))
        level = ws.write(next_level(survived, at, at == start), ws.fresh("level"))
        at *= 2
        texts = level.select("doc_id", "row", "text")
        windows = level.select("doc_id", "row", F.explode(F.arrays_zip("a", "b")).alias("w")).select("doc_id", "row", "w.a", "w.b")
        if windows.isEmpty():
            return gone_results.unionByName(rest.select(*results))
    found = ws.write(_alive(windows, ["a", "b"], True), ws.fresh("found"))
    shortened = cut(_of_doc(texts, found), length)  # a document's rows that are whole copies are in `gone`
    copies = gone.select(F.col("doc_id").alias("_doc_id"), F.col("digest").alias("_digest")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("digest") == F.col("_digest"))
    shortened = shortened.join(copies, same, "left_anti")
    untouched = _of_doc(rest, found.select("doc_id", "row"), "left_anti")
    return gone_results.unionByName(untouched.select(*results)).unionByName(shortened.select(*results))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(steps(spark), table(spark, sf_dir, "documents", "doc_id", "text"))
