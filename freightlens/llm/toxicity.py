"""Toxicity after noisy-channel deobfuscation.

A character language model (4-grams over 32 symbols, counted over all documents) and a channel that writes letters as look-alikes,
puts separators between them or repeats them give every suspicious token a lattice of readings; a Viterbi search finds the
likeliest. Every token of any length that holds a letter and a look-alike, separator or threefold letter is suspicious; at its
edges a look-alike may also be punctuation, and between letters written one by one a space may also end a word. Tokens without look-alikes, separators
or threefold letters have one reading, themselves. The restored words and their beginnings are the features of a logistic
regression.

The classifier is fitted on at most SAMPLE labelled documents whose crc32(doc_id) mod 3 is not 1, those of smallest hash;
features are chosen on that sample, too. Labels, lang, source and doc_id are no features. Null and empty texts get the score of a
text without any feature; without usable labels every score is 0. A doc_id labelled twice is toxic if one label says so.
Rows are scored one by one. Documents: doc_id and text are read; labels: doc_id and toxic.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain, groupby
from math import log1p

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.llm.common import Remembered, in_batches, steps, table, to_bytes
from freightlens.session import Workspace

SAMPLE = 20_000
FEATURE_BITS = 18
FEATURES = 4096
PREFIXES = range(3, 8)
THRESHOLD = 0.7
ORDER = 4
LOOK_ALIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "(": "c", "€": "e", "£": "l",
}
SEPARATORS = " .-_*~'"
SUBSTITUTED, SEPARATED, REPEATED, TRIPLED, KEPT = -1.0, -0.7, -2.5, -0.5, -7.0  # log weights of the channel
BOUNDARY = -2.0  # a space that ends a word
EDGES = ".,;:!?\"'()[]{}<>#$%&*|+-_=/\\~`"
NOT_OPENING, NOT_CLOSING = "!|+$", "$"  # look-alikes that are seldom punctuation before and after a word
SUSPICIOUS = re.compile(r"[013-9@$!|+(€£]|[^\W\d_][ .\-_*~']+[^\W\d_]|([^\W\d_])\1\1")
LETTER = re.compile(r"[^\W\d_]")
SPACED = re.compile(r"(?<!\S)\w(?:[ ._*\-]\w){3,}(?![^\s.,;:!?])")

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[128:] = 27 + np.arange(128) % 4


def symbols(data: bytes) -> np.ndarray:
    """0 for whatever ends a word, 1 to 26 for letters, 27 to 30 for bytes of other letters."""
    return _SYMBOL[np.frombuffer(data, np.uint8)]


def gram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of the 32^4 character 4-grams of all texts; so many numbers at most reach the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(32**ORDER, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                data = to_bytes(text)
                for at in range(0, len(data), 1 << 20):
                    s = symbols(b"   " + data[at : at + (1 << 20)].lower() + b" ")
                    np.add.at(total, ((s[:-3] * 32 + s[1:-2]) * 32 + s[2:-1]) * 32 + s[3:], 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])

    found = in_batches(docs.select("text"), work, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(32**ORDER)
    counts[found["gram"].to_numpy()] = found["n"].to_numpy()
    return counts


def language_model(counts: np.ndarray) -> np.ndarray:
    """log P(symbol | three before), interpolated with the shorter contexts by how often the context was seen."""
    p = np.full(32, 1 / 32)
    for order in range(1, ORDER + 1):
        own = counts.reshape(-1, *[32] * order).sum(axis=0)
        seen = own.sum(axis=-1, keepdims=True)
        p = (own + 5 * p) / (seen + 5)
    return np.log(p).astype(np.float32)


class Restorer:
    """The likeliest reading of a token under language model and channel."""

    def __init__(self, model: np.ndarray):
        self.model = model
        self.flat = memoryview(np.ascontiguousarray(model).reshape(-1))  # plain floats, without an array scalar for each
        self.spelled = Remembered(lambda letter: _SYMBOL[list(letter.encode("utf-8", "surrogatepass"))].tolist(), 50_000)

    def __reduce__(self):
        return Restorer, (self.model,)

    def _emit(self, state: tuple[int, int, int], letter: str) -> tuple[float, tuple[int, int, int]]:
        gain, (a, b, c), flat = 0.0, state, self.flat
        for s in self.spelled[letter]:
            gain += flat[((a * 32 + b) * 32 + c) * 32 + s]
            a, b, c = b, c, s
        return gain, (a, b, c)

    def viterbi(self, token: str) -> str:
        opens, closes = len(token) - len(token.lstrip(EDGES)), len(token.rstrip(EDGES))
        paths: dict = {((0, 0, 0), ""): (0.0, None)}  # context and last letter -> best score, letters read as (those before, letter)
        at = 0
        for c, run in groupby(token):
            for i in range(sum(1 for _ in run)):
                edge = None
                if not opens <= at < closes:
                    edge = KEPT if c in (NOT_OPENING if at < opens else NOT_CLOSING) else 0.0
                at += 1
                follows = token[at : at + 1]
                nxt: dict = {}
                for (state, last), (score, read) in paths.items():
                    options = [(letter, SUBSTITUTED) for letter in LOOK_ALIKE.get(c, "")]
                    if c.isalpha():
                        options.append((c, 0.0))
                        if c == last:
                            options.append(("", TRIPLED if i >= 2 else REPEATED))
                    else:
                        options.append((c, BOUNDARY if c == " " else KEPT))
                        if edge is not None:
                            options.append(("", edge))
                        elif c in SEPARATORS:
                            options.append(("", SEPARATED))
                    for letter, weight in options:
                        gain, after = self._emit(state, letter) if letter else (0.0, state)
                        now = letter or last
                        key = (after, "" if follows.isalpha() and follows != now else now)  # the last letter matters to its repetition only
                        if (value := score + weight + gain) > nxt.get(key, (-1e30,))[0]:
                            nxt[key] = (value, (read, letter) if letter else read)
                paths = nxt
        read, letters = max(paths.items(), key=lambda p: p[1][0] + self._emit(p[0][0], " ")[0])[1][1], []
        while read:
            read, letter = read
            letters.append(letter)
        return "".join(reversed(letters))

    def word(self, token: str) -> str:
        """A lower-case token without edge punctuation, restored if it looks tampered with; words are parted by spaces."""
        if SUSPICIOUS.search(token) and LETTER.search(token):
            return self.viterbi(token).strip(EDGES)
        return token.strip(EDGES)

    def text(self, text: str) -> str:
        """The whole text, lower case, every token restored."""
        return " ".join(w for t in self.tokens(text) if (w := self.word(t)))

    @staticmethod
    def tokens(text: str) -> list[str]:
        """Lower-case tokens; letters written one by one make one token."""
        low = text.lower()
        out, at = [], 0
        for m in SPACED.finditer(low):
            out += low[at : m.start()].split()
            out.append(m.group())
            at = m.end()
        return out + low[at:].split() if at else low.split()


def word_features(restored: str) -> list[int]:
    """Hash buckets of restored words and their beginnings."""
    names = []
    for word in restored.split():
        names.append(word + "$")
        names += [word[:n] for n in PREFIXES[: max(0, len(word) + 1 - PREFIXES[0])]]
    return [digest >> (64 - FEATURE_BITS) for digest in map(xxhash.xxh3_64_intdigest, names)]


def _counted(text: str | None, features: Remembered) -> Counter:
    return Counter(chain.from_iterable(map(features.__getitem__, Restorer.tokens(text or ""))))


def training_sample(ws: Workspace, docs: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """(text, toxic) of at most `size` labelled documents outside the held-out third."""
    usable = labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    picked = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    picked = ws.write(picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size), ws.fresh("picked"))
    sample = docs.join(F.broadcast(picked), "doc_id").select("text", "toxic")  # `size` rows of two numbers at most
    return ws.write(sample.repartition(12), ws.fresh("sample"))


def held_out(doc_id) -> F.Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1


def sample_features(ws: Workspace, sample: DataFrame, restorer: Restorer) -> DataFrame:
    """(at, n, toxic) per row of the sample: its feature buckets and how often each occurs. Written, as both steps of the training read it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Remembered(lambda token: word_features(restorer.word(token)))
        for batch in batches:
            texts, toxic = (c.to_pylist() for c in batch.columns)
            found = [_counted(t, features) for t in texts]
            at = pa.array([list(f) for f in found], pa.list_(pa.int32()))
            n = pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([at, n, pa.array([int(bool(t)) for t in toxic], pa.int32())], ["at", "n", "toxic"])

    return ws.write(in_batches(sample, work, "at array<int>, n array<int>, toxic int"), ws.fresh("features"))


def choose_features(rows: DataFrame, most: int = FEATURES) -> np.ndarray:
    """The buckets whose presence says most about the label (chi square), as bucket -> place or -1."""
    toxic = F.sum("toxic").alias("toxic")
    found = rows.select(F.explode("at").alias("f"), "toxic").groupBy("f").agg(F.count("*").alias("rows"), toxic).toArrow()  # 2^18 at most
    whole = rows.agg(F.count("*").alias("rows"), F.coalesce(toxic, F.lit(0)).alias("toxic")).first()
    n, totals = np.zeros((2, 1 << FEATURE_BITS)), np.array([[whole["rows"] - whole["toxic"]], [whole["toxic"]]], np.float64)
    at, held, bad = (found[c].to_numpy() for c in ("f", "rows", "toxic"))
    n[:, at] = held - bad, bad
    share = n.sum(axis=0) / max(totals.sum(), 1)
    expected = totals * share
    chi = ((n - expected) ** 2 / np.maximum(expected * (1 - share), 1e-9)).sum(axis=0) * (n.sum(axis=0) >= 3)
    place = np.full(1 << FEATURE_BITS, -1, np.int32)
    best = np.argsort(-chi, kind="stable")[:most]
    best = best[chi[best] > 4]
    place[best] = np.arange(len(best))
    return place


def fit(rows: DataFrame, place: np.ndarray, rounds: int = 300, decay: float = 2e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression over log(1 + count), by full-batch Adam on the features of the bounded sample."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("at")
            at, n = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("at", "n"))
            keep = place[at] >= 0
            ends = np.r_[0, np.cumsum(keep)][np.r_[0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]]
            made = [pa.ListArray.from_arrays(ends.astype(np.int32), v[keep].astype(np.int32)) for v in (place[at], n)]
            yield pa.RecordBatch.from_arrays([*made, batch.column("toxic")], ["at", "n", "toxic"])

    found = in_batches(rows, chosen, "at array<int>, n array<int>, toxic int").toArrow().combine_chunks()
    width = int(place.max()) + 1
    weights, bias = np.zeros(width), 0.0
    if not found.num_rows:
        return weights, -np.inf
    y = found["toxic"].to_numpy().astype(np.float64)
    at, n = (found[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "n"))
    owner = np.repeat(np.arange(len(y)), np.diff(found["at"].combine_chunks().offsets.to_numpy()))
    x = np.log1p(n.astype(np.float64))
    bias = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    theta, m, v = np.append(weights, bias), np.zeros(width + 1), np.zeros(width + 1)
    for i in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(owner, theta[at] * x, len(y)) + theta[-1], -30, 30)))
        slope = np.append(np.bincount(at, ((p - y)[owner] * x), width) / len(y) + decay * theta[:-1], (p - y).mean())
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta -= 0.1 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    return theta[:-1], float(theta[-1])


def score(docs: DataFrame, restorer: Restorer, place: np.ndarray, weights: np.ndarray, bias: float) -> DataFrame:
    worth = weights.tolist()
    chosen = {f: int(place[f]) for f in np.flatnonzero(place >= 0).tolist()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Remembered(lambda token: tuple([chosen[f] for f in word_features(restorer.word(token)) if f in chosen]))
        for batch in batches:
            scores = []
            for text in batch.column(1).to_pylist():
                found = _counted(text, features)
                total = bias + sum([worth[f] * log1p(n) for f, n in found.items()])
                scores.append(float(1 / (1 + np.exp(-np.clip(total, -700, 700)))) if total > -np.inf else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return in_batches(docs.select("doc_id", "text"), work, "doc_id long, score double")


def toxicity(ws: Workspace, docs: DataFrame, labels: DataFrame, sample_size: int = SAMPLE) -> DataFrame:
    """(doc_id, score) per row of docs."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    restorer = Restorer(language_model(gram_counts(docs)))
    sample = training_sample(ws, docs, labels.select("doc_id", "toxic"), sample_size)
    rows = sample_features(ws, sample, restorer)
    place = choose_features(rows)
    return score(docs, restorer, place, *fit(rows, place))


def op5_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(steps(spark), table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return scored.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
