"""Token files: Re-Pair compressed shards of token ids with random access.

Documents are dealt by ranges of doc_id, sorted, encoded with a public vocabulary, ended by END_ID and written as one shard per
task, in ascending order of (doc_id, text); a shard holds blocks of BLOCK_IDS ids, so memory does not grow with shard or text.
Within a block frequent adjacent pairs are replaced by new symbols, round by round, several pairs at a time, until
a round saves less than GAIN of the sequence or no 16-bit number is left for a symbol. Two neighbouring places are not
replaced at once; a rule used only once is not made. A block stores its rules, the length each expands to, and the sequence, so ids
[a, b) are decoded from the symbols that cover them.

Shard layout (little endian): MAGIC; per block: rules as pairs of uint16, their lengths as uint32, symbols as uint16, all three
deflated; index: (doc_id int64, start int64, n int64) per document; table: (offset, bytes, rules, symbols, ids) int64 per block; then the
place and size of both, MAGIC. A null doc_id is written as the smallest int64.

Texts are cut before every space that a visible character follows, where the vocabulary's
own splitter always cuts, so the ids are those of the whole text. Pieces of letters, signs and line ends are cut where it cuts, too; their
parts go to the library's model by the thousand, and both parts and other pieces are remembered.
Null texts are empty: the end id alone. Rows that repeat a doc_id are documents of their own. Only doc_id and text are read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Collection, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freightlens.llm.common import Remembered, in_batches, steps, table
from freightlens.llm.warc import opened
from freightlens.session import Workspace

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
MAGIC = b"RPTK0001"
BLOCK_IDS = 1 << 20
HASH_BITS = 20
LEAST_USES = 8
GAIN = 0.02
LIMIT = 1 << 16
NO_ID = -(1 << 63)
TOGETHER = 1 << 23  # characters of texts whose pieces are looked up together
CALL = 2000  # pieces handed to the tokenizer at once


class PieceIds(dict):
    """Piece of text -> its ids as little-endian uint16."""

    def __init__(self, vocabulary: str, most: int = 1_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.most = Tokenizer.from_file(public_tokenizers.path(vocabulary)), most
        if self.tokenizer.get_vocab_size() > LIMIT:
            raise ValueError("ids do not fit 16 bits")
        model = self.tokenizer.model
        self.words = Remembered(lambda word: array("H", [t.id for t in model.tokenize(_in_bytes(word))]).tobytes(), min(most, 200_000))

    def learn(self, pieces: Collection[str]) -> None:
        """Encode the pieces not known yet, words of letters one by one, the others some thousand in a call; of too many the half held longest goes first."""
        if len(self) + len(pieces) > self.most:
            for piece in list(islice(self, len(self) // 2)):
                del self[piece]
        words, other = self.words, []
        for piece in [p for p in pieces if p not in self]:
            if found := _WORD.fullmatch(piece):
                self[piece] = words[found[1]] + words[found[2]] if found[2] else words[found[1]]
            elif _WORDS.fullmatch(piece):
                self[piece] = b"".join(map(words.__getitem__, _PARTS.findall(piece)))
            else:
                other.append(piece)
        for at in range(0, len(other), CALL):
            some = other[at : at + CALL]
            for piece, encoded in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self[piece] = np.array(encoded.ids, "<u2").tobytes()


class PartIds:
    """The ids of parts of plain words, as arrays: parts the model has seen are not given to it again."""

    def __init__(self, pieces: PieceIds, most: int = 1_000_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.words, self.most = pieces.words, most
        self.model = Tokenizer(pieces.tokenizer.model)
        self.model.pre_tokenizer = CharDelimiterSplit(_ALPHABET[1])
        self.begins = np.zeros(LIMIT, bool)  # ids that begin with a space
        self.begins[[i for token, i in pieces.tokenizer.get_vocab().items() if token.startswith(_ALPHABET[32])]] = True
        self.forget()

    def forget(self) -> None:
        self.parts, self.ids, self.sizes = pa.array([], pa.string()), np.empty(0, np.uint16), np.empty(0, np.int64)

    def learn(self, parts: pa.Array) -> np.ndarray:
        """The places of `parts`, all different, among those known; new ones are encoded."""
        if len(self.parts) > self.most:
            self.forget()
        places = pc.fill_null(pc.index_in(parts, self.parts), -1).to_numpy().astype(np.int64)
        unknown = np.flatnonzero(places < 0)
        if len(unknown):
            new = parts.take(pa.array(unknown))
            spaced, ascii_only = (x.to_numpy(zero_copy_only=False) for x in (pc.starts_with(new, " "), pc.string_is_ascii(new)))
            kinds = [np.flatnonzero(x) for x in (spaced & ascii_only, spaced & ~ascii_only, ~spaced)]
            words, accented, rest = (new.take(pa.array(k)) for k in kinds)
            places[unknown[np.concatenate(kinds)]] = len(self.parts) + np.arange(len(new))
            ids, others = np.r_[self._of_words(words), self._of_words(accented)], [self.words[p] for p in rest.to_pylist()]
            sizes = np.diff(np.r_[np.flatnonzero(self.begins[ids]), len(ids)])
            self.ids = np.r_[self.ids, ids, np.frombuffer(b"".join(others), "<u2")]
            self.sizes = np.r_[self.sizes, sizes, np.fromiter(map(len, others), np.int64) // 2]
            self.parts = pa.concat_arrays([self.parts, words, accented, rest])
        return places

    def _of_words(self, words: pa.Array) -> np.ndarray:
        """The ids of words that begin with a space and have no other; the id a word begins with begins with it, too."""
        found = [np.empty(0, np.uint16)]
        for at in range(0, len(words), CALL):
            some = "\x01".join(words[at : at + CALL].to_numpy(zero_copy_only=False).tolist())
            found.append(np.array(self.model.encode_batch_fast([_in_bytes(some)], add_special_tokens=False)[0].ids, np.uint16))
        return np.concatenate(found)

    def of_plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words of _PLAIN, each after a space, and how many each word has."""
        parted = pc.replace_substring_regex(pc.binary_join_element_wise(" ", words, ""), _PLAIN_PARTS, r"\1" + "\x01")
        split = pc.split_pattern(parted, "\x01")
        ends = split.offsets.to_numpy()[1:] - split.offsets.to_numpy()[0]
        coded = split.flatten().dictionary_encode()
        at = np.delete(coded.indices.to_numpy().astype(np.int64), ends - 1)  # nothing follows a word's last mark
        places = self.learn(coded.dictionary)[at]
        ends = np.cumsum(self.sizes[places])[ends - np.arange(1, len(ends) + 1) - 1]
        return _gathered(self.ids, self.sizes, places), np.diff(ends, prepend=0)


def _gathered(ids: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """ids holds sequences of `sizes` one after the other: those of numbers `at`, one after the other."""
    if not len(at):
        return ids[:0]
    n, starts = sizes[at], np.cumsum(sizes) - sizes
    ends = np.cumsum(n)
    return ids[np.repeat(starts[at] - ends + n, n) + np.arange(ends[-1])]


# The splitter ends a part where letters meet other signs and around a lone line end between visible characters, so these parts are the model's own.
_LETTERS, _SIGNS = "[A-Za-zÀ-ÖØ-öø-ɏ]+", r"[!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]"
_WORD = re.compile(f"( ?{_LETTERS})({_SIGNS}*)")
_WORDS = re.compile(rf" ?{_LETTERS}{_SIGNS}*(?:\n{_LETTERS}{_SIGNS}*)+")
_PARTS = re.compile(rf" ?{_LETTERS}|{_SIGNS}+|\n")
_PLAIN = rf"\A{_LETTERS}{_SIGNS}*(?:\n{_LETTERS}{_SIGNS}*)*\z"
_PLAIN_PARTS = f"({_PARTS.pattern})"
_VISIBLE = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_ALPHABET = {b: chr(256 + n) for n, b in enumerate(sorted(set(range(256)) - set(_VISIBLE)))}  # how the vocabulary writes the other bytes


def _in_bytes(word: str) -> str:
    return word.replace(" ", _ALPHABET[32]).replace("\n", _ALPHABET[10]).replace("\x01", _ALPHABET[1]) if word.isascii() else word.encode().decode("latin-1").translate(_ALPHABET)


_known: dict[str, tuple[PieceIds, PartIds]] = {}
_CUT = re.compile(r"(?= \S)")


def encode(texts: list[str | None], vocabulary: str = VOCABULARY) -> Iterator[np.ndarray]:
    """The ids of each text, uint16, with the end id."""
    if vocabulary not in _known:
        pieces = PieceIds(vocabulary)
        _known[vocabulary] = pieces, PartIds(pieces)
    some, size = [], 0
    for n, text in enumerate(texts, 1):
        some.append(text.encode("utf-8", "replace").decode() if text else "")
        size += len(some[-1])
        if size >= TOGETHER or n == len(texts):
            yield from _encoded(some, *_known[vocabulary])
            some, size = [], 0


def _encoded(texts: list[str], known: PieceIds, parts: PartIds) -> list[np.ndarray]:
    """Every text as numbers of pieces, each piece looked up once."""
    split = pc.split_pattern(pa.array(texts, pa.string()), " ")
    bounds, coded = split.offsets.to_numpy(), split.flatten().dictionary_encode()
    words, at = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    plain = pc.match_substring_regex(words, _PLAIN)
    flat, sizes = parts.of_plain(words.filter(plain))
    pieces = [" " + w for w in words.filter(pc.invert(plain)).to_pylist()]
    unsure = pc.or_(pc.equal(words, ""), pc.not_equal(words, pc.utf8_ltrim_whitespace(words))).to_numpy(zero_copy_only=False)[at]
    unsure[bounds[:-1]] = False  # a text's first piece is not parted from anything
    is_plain = plain.to_numpy(zero_copy_only=False)
    at = np.where(is_plain, np.cumsum(is_plain) - 1, len(sizes) + np.cumsum(~is_plain) - 1)[at]  # the plain ones come first
    others = len(sizes) + len(pieces)
    more: dict[str, int] = {}
    first = [t.split(" ", 1)[0] for t in texts]
    at[bounds[:-1]] = [more.setdefault(p, others + len(more)) for p in first]
    each = np.split(at, bounds[1:-1])
    for i in set((np.searchsorted(bounds, np.flatnonzero(unsure), "right") - 1).tolist()):  # not every space of these parts pieces
        each[i] = np.array([more.setdefault(p, others + len(more)) for p in _CUT.split(texts[i])])
    pieces += more
    ids = [*map(known.get, pieces), np.array([END_ID], "<u2").tobytes()]
    new = [i for i, x in enumerate(ids) if x is None]
    known.learn({pieces[i] for i in new})
    for i in new:
        ids[i] = known[pieces[i]]
    sizes = np.r_[sizes, np.fromiter(map(len, ids), np.int64) // 2]
    counts = np.cumsum([len(e) for e in each])
    at = np.insert(np.concatenate(each), counts, len(sizes) - 1)
    whole, ends = _gathered(np.r_[flat, np.frombuffer(b"".join(ids), "<u2")], sizes, at), np.cumsum(sizes[at])
    return np.split(whole, ends[counts + np.arange(len(texts))][:-1])


def compress(ids: np.ndarray, first_symbol: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules, lengths, symbols): rule i replaces a pair of symbols by first_symbol + i and expands to lengths[i] ids."""
    sequence = ids.astype(np.uint32)
    rules, lengths = [np.empty((0, 2), np.uint32)], np.ones(first_symbol, np.int64)
    while len(sequence) > 1 and len(lengths) < LIMIT:
        keys = (sequence[:-1] << np.uint32(16)) | sequence[1:]
        cells = ((keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - HASH_BITS)).astype(np.intp)
        held = np.zeros(1 << HASH_BITS, np.uint32)
        held[cells] = keys  # one pair speaks for a cell
        own = held[cells] == keys
        counts = np.bincount(cells[own], minlength=1 << HASH_BITS)
        frequent = np.flatnonzero(counts >= LEAST_USES)
        room = min(LIMIT - len(lengths), max(64, (LIMIT - first_symbol) // 4))
        frequent = frequent[np.argsort(-counts[frequent], kind="stable")[:room]]
        chosen = np.zeros(1 << HASH_BITS, bool)
        chosen[frequent] = True

        at = np.flatnonzero(chosen[cells] & own)
        if not len(at):
            break
        begins = np.r_[True, np.diff(at) > 1]
        offset = np.arange(len(at)) - np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
        at = at[offset % 2 == 0]
        at = at[np.bincount(cells[at], minlength=1 << HASH_BITS)[cells[at]] > 1]
        if len(at) < GAIN * len(sequence):
            break
        used = np.flatnonzero(np.bincount(cells[at], minlength=1 << HASH_BITS))
        number = np.zeros(1 << HASH_BITS, np.uint32)
        number[used] = len(lengths) + np.arange(len(used), dtype=np.uint32)
        pairs = np.stack([held[used] >> np.uint32(16), held[used] & np.uint32(0xFFFF)], axis=1)
        rules.append(pairs)
        lengths = np.concatenate([lengths, lengths[pairs[:, 0]] + lengths[pairs[:, 1]]])
        sequence[at] = number[cells[at]]
        stay = np.ones(len(sequence), bool)
        stay[at + 1] = False
        sequence = sequence[stay]
    return np.concatenate(rules), lengths[first_symbol:], sequence


def expand(symbols: np.ndarray, rules: np.ndarray, first_symbol: int) -> np.ndarray:
    symbols = symbols.astype(np.int64)
    while (made := symbols >= first_symbol).any():
        at = np.arange(len(symbols)) + np.cumsum(made) - made
        out = np.empty(len(symbols) + int(made.sum()), np.int64)
        out[at] = np.where(made, rules[np.where(made, symbols - first_symbol, 0), 0] if len(rules) else symbols, symbols)
        out[at[made] + 1] = rules[symbols[made] - first_symbol, 1]
        symbols = out
    return symbols.astype(np.uint32)


def packed(ids: np.ndarray, first_symbol: int) -> tuple[bytes, tuple[int, int, int]]:
    rules, lengths, symbols = compress(ids, first_symbol)
    raw = rules.astype("<u2").tobytes() + lengths.astype("<u4").tobytes() + symbols.astype("<u2").tobytes()
    return zlib.compress(raw, 1), (len(rules), len(symbols), len(ids))


class Shard:
    """Random access to the ids of a shard."""

    def __init__(self, source, first_symbol: int):
        self.source, self.first = source, first_symbol
        size, tail = source.size(), 32 + len(MAGIC)
        index, documents, blocks_at, blocks = struct.unpack("<4q", source.read_at(32, size - tail))
        if source.read_at(len(MAGIC), size - len(MAGIC)) != MAGIC:
            raise ValueError("not a token file")
        self.documents = np.frombuffer(source.read_at(documents * 24, index), "<i8").reshape(-1, 3)
        self.table = np.frombuffer(source.read_at(blocks * 40, blocks_at), "<i8").reshape(-1, 5)
        self.starts = np.r_[0, np.cumsum(self.table[:, 4])]
        self.loaded: tuple[int, tuple] = (-1, ())

    def _block(self, b: int) -> tuple[np.ndarray, ...]:
        if self.loaded[0] != b:
            offset, size, n_rules, n_symbols, _ = self.table[b].tolist()
            raw = zlib.decompress(self.source.read_at(size, offset))
            rules = np.frombuffer(raw, "<u2", n_rules * 2).reshape(-1, 2).astype(np.int64)
            lengths = np.frombuffer(raw, "<u4", n_rules, n_rules * 4).astype(np.int64)
            symbols = np.frombuffer(raw, "<u2", n_symbols, n_rules * 8).astype(np.int64)
            sizes = np.concatenate([np.ones(self.first, np.int64), lengths])
            flat = np.concatenate([np.arange(self.first, dtype=np.uint32), expand(np.arange(self.first, self.first + n_rules), rules, self.first)])
            self.loaded = (b, (flat, np.cumsum(sizes) - sizes, symbols, np.r_[0, np.cumsum(sizes[symbols])]))
        return self.loaded[1]

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids [start, start + n) of the shard, as far as it goes; only the symbols that cover them are read, each rule of a block is expanded once."""
        out, end = [], min(start + n, int(self.starts[-1]))
        if end <= start:
            return np.empty(0, np.uint32)
        for b in range(int(np.searchsorted(self.starts, start, "right")) - 1, int(np.searchsorted(self.starts, end))):
            flat, starts, symbols, ends = self._block(b)
            lo, hi = max(start - self.starts[b], 0), min(end - self.starts[b], ends[-1])
            a, z = int(np.searchsorted(ends, lo, "right")) - 1, int(np.searchsorted(ends, hi))
            at = np.repeat(starts[symbols[a:z]] - ends[a:z], np.diff(ends[a : z + 1])) + np.arange(ends[a], ends[z])
            out.append(flat[at[lo - ends[a] : hi - ends[a]]])
        return np.concatenate(out)


    def checksums(self) -> Iterator[int]:
        """crc32 of every document's ids as uint32; documents of about a block are decoded at once."""
        starts, ends = self.documents[:, 1], self.documents[:, 1] + self.documents[:, 2]
        lo = 0
        while lo < len(starts):
            hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + BLOCK_IDS, "right")))
            ids = self.ids(int(starts[lo]), int(ends[hi - 1] - starts[lo])).astype("<u4")
            yield from (zlib.crc32(ids[a:z]) for a, z in zip((starts[lo:hi] - starts[lo]).tolist(), (ends[lo:hi] - starts[lo]).tolist()))
            lo = hi


def first_symbol_of(vocabulary: str) -> int:
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(vocabulary)).get_vocab_size()


def write_shards(ws: Workspace, docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Shards below `folder`; (path, part, n_ids) of each, part ascending with doc_id."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first()]
    sorted_docs = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(tasks, *order).sortWithinPartitions(*order, "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, first_symbol = TaskContext.get(), first_symbol_of(vocabulary)
        system, root = opened(folder)
        own, final = (f"{root}/{n}" for n in (f".try-{context.taskAttemptId()}", f"part-{context.partitionId():05d}.rptk"))
        out, index, blocks, waiting, held, total = None, [], [], [], 0, 0

        def flush(all_of_it: bool) -> None:
            nonlocal waiting, held
            ids = np.concatenate(waiting) if waiting else np.empty(0, np.uint16)
            while len(ids) >= block_ids or all_of_it and len(ids):
                data, counts = packed(ids[:block_ids], first_symbol)
                blocks.append((out.tell(), len(data), *counts))
                out.write(data)
                ids = ids[block_ids:]
            waiting, held = [ids], len(ids)

        for batch in batches:
            doc_ids, texts = (c.to_pylist() for c in batch.columns)
            if doc_ids and out is None:
                system.create_dir(root)
                out = system.open_output_stream(own)
                out.write(MAGIC)
            for doc_id, ids in zip(doc_ids, encode(texts, vocabulary)):
                index.append((NO_ID if doc_id is None else doc_id, total, len(ids)))
                waiting.append(ids)
                held, total = held + len(ids), total + len(ids)
                if held >= block_ids:
                    flush(False)
        if out is not None:
            flush(True)
            index_at = out.tell()
            out.write(np.array(index, "<i8").tobytes())
            table_at = out.tell()
            out.write(np.array(blocks, "<i8").tobytes())
            out.write(struct.pack("<4q", index_at, len(index), table_at, len(blocks)) + MAGIC)
            out.close()
            system.move(own, final)
            uri = folder.rstrip("/") + "/" + final.rsplit("/", 1)[1]
            yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([context.partitionId()], pa.int64()), pa.array([total])], ["path", "part", "n_ids"])

    return ws.write(in_batches(sorted_docs, work, "path string, part long, n_ids long"), ws.fresh("shards"))


def read_shards(shards: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, path) per document, decoded from the shards one by one."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    placed = shards.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    tasks = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_symbol = first_symbol_of(vocabulary)
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns)):
                system, name = opened(path)
                with system.open_input_file(name) as source:
                    shard = Shard(source, first_symbol)
                    starts, sizes = shard.documents[:, 1].tolist(), shard.documents[:, 2].tolist()
                    crc = list(shard.checksums())
                ids = [None if d == NO_ID else d for d in shard.documents[:, 0].tolist()]
                columns = [pa.array(ids, pa.int64()), pa.array([base + s for s in starts], pa.int64()), pa.array(sizes, pa.int64())]
                columns += [pa.array(crc, pa.int64()), pa.array([path] * len(ids), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "path"])

    return in_batches(placed.repartition(tasks, "path"), work, "doc_id long, start long, n_tokens long, ids_crc32 long, path string")


def op9_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = steps(spark)
    shards = write_shards(ws, table(spark, sf_dir, "documents", "doc_id", "text"), ws.path("tokens"))
    return read_shards(shards).select("doc_id", "start", "n_tokens", "ids_crc32")
