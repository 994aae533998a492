"""Tables, shared-folder steps and word helpers that the operators have in common."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.session import Workspace

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, once per application: they need not have the repository."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        target = os.path.join(tempfile.mkdtemp(prefix="freightlens-llm-"), "freightlens_package")
        spark.sparkContext.addPyFile(shutil.make_archive(target, "zip", root, "freightlens"))
        _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def steps(spark: SparkSession) -> Workspace:
    """A new folder below spark.checkpoint.dir; what is written there cuts lineage and survives lost executors."""
    ship(spark)
    return Workspace(spark)


def in_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow over batches of bounded bytes, so that very long texts do not pile up in a task."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return df.mapInArrow(work, schema)


def words_of(text: str | None) -> list[bytes]:
    """The runs of [^\\x20\\x09-\\x0D], which are what bytes.split cuts out of UTF-8; none for null."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


class Remembered(dict):
    """work(key) for the keys asked for last; emptied when `most` keys are held."""

    def __init__(self, work: Callable, most: int = 300_000):
        super().__init__()
        self.work, self.most = work, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.work(key)
        return value


PIECE = 1 << 18
BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = []


def _base_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64, for i < n."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE * 2)
        both = [np.full(size, b, np.uint64) for b in (BASE, pow(BASE, -1, 1 << 64))]
        for powers in both:
            powers[0] = 1
            np.cumprod(powers, out=powers)
        _powers[:] = both
    return _powers[0][:n], _powers[1][:n]


def _piece_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = _SPACE[data]
    edges = np.flatnonzero(np.diff(np.r_[True, space, True].astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    powers, inverses = _base_powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64)), starts


def to_bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


_PUNCTUATION = bytes(i if i >= 128 or chr(i).isalnum() else 32 for i in range(256))


def folded(text: str | None) -> bytes:
    """Lower case, with ASCII punctuation and controls as spaces."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_PUNCTUATION) if text else b""


def hashed_words(texts: list[str | None], form: Callable = to_bytes) -> list[np.ndarray]:
    """Per text the 64-bit hashes of its words, taken from the bytes of all texts in pieces that end between words."""
    parts = [form(t) for t in texts]
    data = np.frombuffer(b"\n".join(parts), np.uint8)
    ends = np.cumsum([len(p) + 1 for p in parts]) if parts else np.zeros(0, np.int64)
    hashes, starts, at = [], [], 0
    while at < len(data):
        to, step = min(at + PIECE, len(data)), PIECE
        while to < len(data):
            gaps = np.flatnonzero(_SPACE[data[to : to + step]])
            if len(gaps):
                to += int(gaps[0])
                break
            to, step = min(to + step, len(data)), step * 2
        h, s = _piece_hashes(data[at:to])
        hashes.append(h)
        starts.append(s + at)
        at = to
    if not hashes:
        return [np.empty(0, np.uint64) for _ in texts]
    counts = np.searchsorted(np.concatenate(starts), ends)
    return np.split(np.concatenate(hashes), counts[:-1])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers without visible structure (splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the sequence (a, b)."""
    return mixed(a * np.uint64(0x9E3779B97F4A7C15) + b)


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of `length` hashes, put together from runs of doubled length."""
    n = len(hashes) - length + 1
    if n <= 0:
        return hashes[:0]
    run, at, done, whole = hashes, 1, 0, None
    while True:
        if length & at:
            part = run[done : done + n]
            whole = part if whole is None else paired(whole, part)
            done += at
        if done == length:
            return whole
        run, at = paired(run[:-at], run[at:]), at * 2


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def unique_name(df: DataFrame, stem: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def text_column(df: DataFrame, name: str = "text") -> DataFrame:
    return df.select("doc_id", F.col(name).alias("text"))


def some_at_a_time(hashed: list[np.ndarray], most: int = 200_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about `most` words, or one longer text."""
    at, words = 0, 0
    for i, h in enumerate(hashed):
        if words and words + len(h) > most:
            yield at, i
            at, words = i, 0
        words += len(h)
    if hashed:
        yield at, len(hashed)
