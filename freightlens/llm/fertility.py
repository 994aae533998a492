"""Quality rules by tokeniser fertility: how well a public vocabulary fits a text, judged against the text's language.

A text is split into words [^\\x20\\x09-\\x0D]+ and every word is encoded with a SentencePiece vocabulary that falls
back to bytes. Three measures follow: characters per token, share of byte-fallback tokens, and the entropy of the
text's token distribution over the highest entropy that as many tokens could have. A language (or, where lang is null, the
script most letters are in) gets a band per measure and length class (floor of log2 of the tokens, as all three vary with
length) from the quartiles of its texts there that pass the base rules; a class of fewer than ENOUGH such texts takes the band of all lengths.
A band is [q1 - REACH * spread, q3 + REACH * spread], Tukey's fences, which leave 0.35 % of a normal distribution outside on
either side; spread = q3 - q1, but at least FLAT of the median, or LEAST_BYTES for byte-fallback shares. The quartiles come from
exact histograms, so they cover all texts and do not depend on the partitioning.

Null and empty texts have no words and fail the base rules. Rows are judged one by one: repeated rows and repeated
doc_ids come back as often as they came in. Columns other than doc_id, text and lang are not read.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freightlens.llm.common import Remembered, in_batches, steps, table, words_of
from freightlens.session import Workspace

VOCABULARY = "piece_bpe_32k.model"
SYMBOLS = "#*$%&|<>"
REACH = 1.5
FLAT = 0.01
LEAST_BYTES = 0.025
ENOUGH = 30
ANY_LENGTH = -1
BINS = 1024  # of a unit of a measure
MEASURES = ("chars_per_token", "byte_share", "entropy_ratio")
SCHEMA = (
    "doc_id long, band_key string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, chars_per_token double, byte_share double, entropy_ratio double"
)

class Encoder(Remembered):
    """Word -> its ids as little-endian uint16, byte-fallback ids as 0. A word's ids do not depend on its neighbours."""

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import sentencepiece

        super().__init__(self._ids, 400_000)
        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.begins = np.array([p.startswith("\u2581") for p in pieces])
        self.code = np.where([self.model.is_byte(i) for i in range(len(pieces))], 0, np.arange(len(pieces))).astype(np.uint16)

    def _ids(self, word: bytes) -> bytes:
        return self.code[self.model.encode(word.decode("utf-8", "replace"))].tobytes()

    def learn(self, words: set[bytes]) -> None:
        """Encode the words not yet known as one text, if its pieces can be told apart by word."""
        new = [w for w in words if w not in self]
        if len(self) + len(new) > self.most:
            self.clear()
            new = list(words)
        if new:
            ids = np.array(self.model.encode(b" ".join(new).decode("utf-8", "replace")), np.int64)
            starts = np.flatnonzero(self.begins[ids])
            if len(starts) == len(new):
                coded = self.code[ids].tobytes()
                bounds = [*(starts * 2).tolist(), len(coded)]
                self.update((w, coded[a:b]) for w, a, b in zip(new, bounds, bounds[1:]))


_encoders: dict[str, Encoder] = {}


def _encoder(vocabulary: str) -> Encoder:
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def script_of(text: str) -> str:
    """The first word of most letters' Unicode names, e.g. LATIN; ties by name, `none` without letters."""
    found: Counter = Counter()
    for letter, n in Counter(text).items():
        if letter.isalpha():
            found[unicodedata.name(letter, "UNNAMED").split(" ")[0]] += n
    return min(found, key=lambda s: (-found[s], s)) if found else "none"


def _measured(text: str | None, lang: str | None, encoder: Encoder) -> tuple:
    text = text or ""
    words = words_of(text)
    key = f"lang:{lang}" if lang is not None else f"script:{script_of(text)}"
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line.strip(" \t\r\x0b\x0c"):
            seen.add(line)
    chars = len(b"".join(words).decode("utf-8", "surrogatepass"))
    encoder.learn(set(words))
    ids = np.frombuffer(b"".join(map(encoder.__getitem__, words)), np.uint16)
    n = len(ids)
    counts = np.bincount(ids) if n else np.zeros(1, np.int64)
    fallback = int(counts[0])
    share = counts[counts > 0] / max(n, 1)
    entropy = float(-(share * np.log2(share)).sum()) if n > 1 else 0.0
    return (
        key, len(words), chars, sum(map(text.count, SYMBOLS)), dup, repeated_words(words),
        n, chars / n if n else 0.0, fallback / n if n else 0.0, entropy / np.log2(n) if n > 1 else 1.0,
    )


def measure(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        for batch in batches:
            ids, texts, langs = (c.to_pylist() for c in batch.columns)
            rows = [_measured(t, lang, encoder) for t, lang in zip(texts, langs)]
            columns = [pa.array(ids, pa.int64()), pa.array([r[0] for r in rows], pa.string())]
            columns += [pa.array([r[i] for r in rows], pa.int64()) for i in range(1, 7)]
            columns += [pa.array([float(r[i]) for r in rows], pa.float64()) for i in range(7, 10)]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")])

    return in_batches(docs.select(F.col("doc_id").cast("long"), "text", "lang"), work, SCHEMA)


def length_class() -> F.Column:
    return F.floor(F.log2(F.greatest("n_tokens", F.lit(1)))).cast("int")


def bands(measured: DataFrame, reach: float = REACH) -> DataFrame:
    """(band_key, length, <measure>_low, <measure>_high): fences around the quartiles of each key's texts, by length class and at any length."""
    cells = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.round(F.col(m) * BINS).cast("long").alias("bin")) for m in MEASURES]))
    counts = measured.select("band_key", length_class().alias("length"), cells.alias("c")).groupBy("band_key", "length", "c.m", "c.bin").agg(F.count("*").alias("n"))
    counts = counts.withColumn("length", F.explode(F.array("length", F.lit(ANY_LENGTH)))).groupBy("band_key", "length", "m", "bin").agg(F.sum("n").alias("n"))
    own = Window.partitionBy("band_key", "length", "m")  # distinct bins only
    placed = counts.withColumn("upto", F.sum("n").over(own.orderBy("bin"))).withColumn("total", F.sum("n").over(own))
    placed = placed.where((F.col("total") >= ENOUGH) | (F.col("length") == ANY_LENGTH))
    at = [F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * q), F.col("bin"))).alias(f"q{i}") for i, q in enumerate((0.25, 0.5, 0.75))]
    quartiles = placed.groupBy("band_key", "length", "m").agg(*at)
    least = F.when(F.col("m") == "byte_share", F.lit(BINS * LEAST_BYTES)).otherwise(F.col("q1") * FLAT)
    spread = F.greatest(F.col("q2") - F.col("q0"), least, F.lit(1.0))
    fences = quartiles.select(
        "band_key", "length", "m", ((F.col("q0") - reach * spread) / BINS).alias("low"), ((F.col("q2") + reach * spread) / BINS).alias("high")
    )
    picked = [F.max(F.when(F.col("m") == m, F.col(e))).alias(f"{m}_{e}") for m in MEASURES for e in ("low", "high")]
    return fences.groupBy("band_key", "length").agg(*picked)


def judge(ws: Workspace, docs: DataFrame, vocabulary: str = VOCABULARY, reach: float = REACH) -> DataFrame:
    """One row per row of docs with measures, bands' verdict and `kept`."""
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = ws.write(measure(docs, vocabulary).withColumn("base_failed", base_failed), ws.fresh("measured"))
    fences = ws.write(bands(measured.where("not base_failed"), reach), ws.fresh("bands"))
    edges = [f"{m}_{e}" for m in MEASURES for e in ("low", "high")]
    closer = fences.where(F.col("length") != ANY_LENGTH).select("band_key", "length", F.struct(*edges).alias("closer"))
    wide = fences.where(F.col("length") == ANY_LENGTH).select("band_key", F.struct(*edges).alias("wide"))
    inside = F.lit(True)
    for m in MEASURES:  # more entropy and fewer fallbacks than usual are no fault
        inside &= F.lit(m == "byte_share") | (F.col(m) >= F.col(f"band.{m}_low"))
        inside &= F.lit(m == "entropy_ratio") | (F.col(m) <= F.col(f"band.{m}_high"))
    judged = measured.withColumn("length", length_class()).join(closer, ["band_key", "length"], "left").join(wide, "band_key", "left")
    judged = judged.withColumn("band", F.coalesce("closer", "wide"))
    return judged.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))).drop("closer", "wide", "band")


def op1_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(steps(spark), table(spark, sf_dir, "documents", "doc_id", "text", "lang")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_tokens", *MEASURES,
    )
