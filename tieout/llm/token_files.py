"""Token ids as files: tokenised once, in id order, entropy coded, read back in parallel.

``write_token_files`` makes a folder with the table of token frequencies, counted
over all documents, and one binary file per range of ids. The files come from
Spark's own writer (its text sink, fed raw bytes), so they land wherever the
session can write and a lost executor leaves no half file. Layout, little-endian:

    file    = record*                      in ascending doc_id order, over all files
    record  = length u32, body, "\\n"
    head    = "TOKRANS1", table crc32 u32, file number u32      (first record)
    block   = tokens u32, crc32 of the tokens as u32 numbers, words u32, documents u32,
              directory bytes u32, directory (zlib: doc_id i64*, null flag u8*, length i64*),
              checkpoints (states u64 * 32, place u32)*, words u32*

A directory lists the documents that begin in the block; a document may go on
through any number of blocks of its file.

Rows: a null text is empty and yields the end id alone. A null id sorts first.
Rows with one id are ordered by length, then checksum, then place in the input;
repeated rows are separate documents. No rows give a table and no records. Only
doc_id and text are read, so other columns may have any name.

Memory of a task: one document's ids, the words its worker remembers, and about
four million tokens of blocks under way; reading, one file (``file_tokens`` tokens at
about one byte and a half, more if one document is longer).
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage, forget
from . import rans

MAGIC = b"TOKRANS1"
HEAD = struct.Struct("<8sII")
BLOCK = struct.Struct("<IIIII")
#: Blocks that are coded or decoded at a time.
TOGETHER = 64
#: Words that a worker remembers; all are forgotten when there are more.
REMEMBERED = 600_000
#: Bytes of text that are looked up together.
TOGETHER_BYTES = 8_000_000
#: A sign that no word of simple characters holds, put between words that are encoded together.
BAR = "\ue000".encode()
# Classes of bytes by which byte-level vocabularies cut text (letters, digits, white space, others),
# and the endings that they cut off with their apostrophe. Bytes above 127 are those of Latin letters here.
LETTER, DIGIT, BLANK, OTHER = range(4)
KIND = np.full(256, OTHER, np.uint8)
KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = LETTER
KIND[48:58] = DIGIT
KIND[[9, 10, 11, 12, 13, 32]] = BLANK
SHORT, LONG = (b"s", b"t", b"m", b"d"), (b"re", b"ve", b"ll")
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def spelling() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in shown}
    for n, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + n)
    return out


def is_space(raw: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text belong to white space."""
    out = SPACE[raw]
    if len(raw) > 2 and (raw >= 0x80).any():
        a, b, c = raw[:-2], raw[1:-1], raw[2:]
        two = (raw[:-1] == 0xC2) & ((raw[1:] == 0x85) | (raw[1:] == 0xA0))
        three = (a == 0xE2) & (b == 0x80) & (((c >= 0x80) & (c <= 0x8A)) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
        three |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
        three |= ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
        for at in np.flatnonzero(two).tolist():
            out[at : at + 2] = True
        for at in np.flatnonzero(three).tolist():
            out[at : at + 3] = True
    return out


def not_simple(raw: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text begin something else than ASCII and the Latin letters U+00C0 to U+024F."""
    out = (raw == 0xC2) | (raw > 0xC9)
    if len(raw) > 1:
        out[:-1] |= (raw[:-1] == 0xC3) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7))
        out[:-1] |= (raw[:-1] == 0xC9) & (raw[1:] > 0x8F)
    return out


def word_starts(raw: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where words begin in texts of simple characters, as byte-level vocabularies cut them.

    Runs of letters, digits, white space and other signs are words. The last sign of
    white space before something else stands alone, or, if it is a space, belongs to
    what follows; an apostrophe that begins a word takes a short ending along.
    """
    kind, n = KIND[raw], len(raw)
    start = np.empty(n, bool)
    start[0], start[1:] = True, kind[1:] != kind[:-1]
    start[text_starts] = True
    first = np.zeros(n + 1, bool)  # a text begins here
    first[text_starts] = first[n] = True
    blank = kind == BLANK
    last = np.flatnonzero(blank[:-1] & ~blank[1:] & ~first[1:-1])
    start[last] = True
    joined_on = last[raw[last] == 32] + 1
    start[joined_on] = False
    mark = np.flatnonzero((raw[:-1] == 39) & start[:-1] & (kind[1:] == LETTER) & ~first[1:-1])
    if len(mark):
        one = np.isin(raw[mark + 1], [x[0] for x in SHORT])
        start[mark[one] + 1] = False
        ends = mark[one] + 2
        start[ends[ends < n]] = True
        mark = mark[~one & (mark + 2 < n)]
        mark = mark[~first[mark + 2]]
        two = np.zeros(len(mark), bool)
        for a, b in LONG:
            two |= (raw[mark + 1] == a) & (raw[mark + 2] == b)
        start[mark[two] + 1] = False
        ends = mark[two] + 3
        start[ends[ends < n]] = True
    return start


class Memo:
    """Ids of strings that were seen before: the ids of number i are flat[start[i] : start[i] + length[i]]."""

    def __init__(self, remembered: int):
        self.remembered = remembered
        self.known: dict[bytes, int] = {}
        self.start, self.length = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self.flat, self.used = np.empty(1 << 16, np.int32), 0

    def __call__(self, keys: list[bytes], encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The numbers of different strings; ``encode`` gives lengths and ids of those that are new."""
        if len(self.known) > self.remembered:
            self.known.clear()
            self.used = 0
        known, first = self.known, len(self.known)
        new = [k for k in keys if k not in known]
        known.update(zip(new, range(first, first + len(new))))
        out = np.fromiter(map(known.__getitem__, keys), np.int64, len(keys))
        if new:
            length, ids = encode(new)
            if len(self.known) > len(self.start):
                self.start, self.length = (np.concatenate((x, np.empty(len(self.known), np.int64))) for x in (self.start, self.length))
            if self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate((self.flat[: self.used], np.empty(self.used + len(ids), np.int32)))
            self.flat[self.used : self.used + len(ids)] = ids
            self.start[first : first + len(length)] = self.used + np.cumsum(length) - length
            self.length[first : first + len(length)] = length
            self.used += len(ids)
        return out

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, ids) of the strings with these numbers, one after the other."""
        return joined(self.flat, self.start[numbers], self.length[numbers])


def joined(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(length, stretches of ``flat`` one after the other)"""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 2**31 else np.int64
    at = np.repeat((start - ends + length).astype(kind), length)
    at += np.arange(total, dtype=kind)
    return length, flat[at]


class Words:
    """Ids of whole texts, looked up word by word.

    Words are cut as a byte-level vocabulary cuts them, in the bytes of many texts at
    once; each different one is encoded once, by the library, and remembered. A
    stretch between white space that holds other characters than ASCII and Latin
    letters, or an added token, is one word, and the library cuts it. (The vocabulary
    cuts before white space that follows something else, whatever stands further on.)
    Vocabularies of any other kind encode whole texts.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.memo = Memo(remembered)
        vocabulary, added = self.library.get_vocab(with_added_tokens=True), self.library.get_added_tokens_decoder()
        self.size = max(vocabulary.values(), default=0) + 1
        self.bytes = np.zeros(self.size, np.int64)
        for token, i in vocabulary.items():  # a character of a token stands for a byte
            self.bytes[i] = len(token)
        self.special = re.compile(b"|".join(re.escape(t.content.encode()) for t in added.values()) or b"(?!)").finditer
        front, options = repr(self.library.pre_tokenizer), added.values()
        plain = all(not (t.lstrip or t.rstrip or t.single_word or re.search(r"\s", t.content)) for t in options)
        byte_level = front.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in front
        self.cuts = plain and byte_level and self.library.normalizer is None
        # the same model, for words that are cut and spelled already
        self.model = Tokenizer(self.library.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.spelled = spelling()
        self.bar = "".join(self.spelled[b] for b in BAR)

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, ids) of texts."""
        made = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(map(len, made), np.int64, len(made)), np.array([i for ids in made for i in ids], np.int32)

    def simple(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, ids) of words that are cut already."""
        text = BAR.join(words).decode("latin-1").translate(self.spelled).replace(self.bar, " ")
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        reach = np.cumsum(self.bytes[ids])
        at = np.searchsorted(reach, ends)
        if len(at) and (at[-1] != len(ids) - 1 or not np.array_equal(reach[at], ends)):
            raise ValueError("the tokens do not spell the words")
        return np.diff(at, prepend=-1), ids

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, ids) of words of both kinds."""
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        hard = np.zeros(len(words), bool)
        hard[np.searchsorted(ends, self.odd(raw), "right")] = True
        if not hard.any():
            return self.simple(words)
        length = np.empty(len(words), np.int64)
        length[hard], odd = self.whole([w.decode() for w in compress(words, hard)])
        easy = list(compress(words, ~hard))
        length[~hard], plain = self.simple(easy) if easy else (0, np.empty(0, np.int32))
        ids, of_hard = np.empty(int(length.sum()), np.int32), np.repeat(hard, length)
        ids[of_hard], ids[~of_hard] = odd, plain
        return length, ids

    def odd(self, raw: np.ndarray) -> np.ndarray:
        """Places of bytes that are not simple, or begin an added token."""
        added = [m.start() for m in self.special(memoryview(np.ascontiguousarray(raw)))]
        return np.concatenate((np.flatnonzero(not_simple(raw)), np.array(added, np.int64)))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the ids of text i are those from bounds[i] to bounds[i + 1]; null is empty."""
        column = pc.fill_null(column.cast(pa.large_binary()), b"")
        if not self.cuts:
            length, ids = self.whole([t.decode() for t in column.to_pylist()])
            return ids, np.concatenate(([0], np.cumsum(length)))
        _, ends, data = column.buffers()
        at = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
        at = at - at[0]
        if not len(raw):
            return np.empty(0, np.int32), np.zeros(len(at), np.int64)
        texts = at[:-1][at[1:] > at[:-1]]
        start = word_starts(raw, texts)
        odd = self.odd(raw)
        if len(odd):
            space = is_space(raw)
            border = np.empty(len(raw), bool)  # a stretch begins here
            border[0], border[1:] = True, space[1:] & ~space[:-1]
            border[texts] = True
            stretch = np.flatnonzero(border)
            hard = np.zeros(len(stretch), bool)
            hard[np.searchsorted(stretch, odd, "right") - 1] = True
            inside = np.repeat(hard, np.diff(np.append(stretch, len(raw))))
            start = np.where(inside, border, start)
        bounds = np.append(np.flatnonzero(start), len(raw))
        cut = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(raw)])
        cut = cut.dictionary_encode()
        length, ids = self.memo.ids(self.memo(cut.dictionary.to_pylist(), self.words)[cut.indices.to_numpy()])
        return ids, np.concatenate(([0], np.cumsum(length)))[np.searchsorted(bounds, at)]


@lru_cache(2)
def words_of(vocabulary: str) -> Words:
    """One for all tasks of a worker: what it has learned is good for the next."""
    return Words(vocabulary)


def by_bytes(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Rows (from, to) that hold at most ``most`` bytes together, or one longer text."""
    start, held = 0, 0
    for at, n in enumerate(pc.binary_length(column).to_pylist()):
        if held and held + (n or 0) > most:
            yield start, at
            start, held = at, 0
        held += n or 0
    if len(column) > start:
        yield start, len(column)


def tokenised(docs: DataFrame, vocabulary: str, end: int) -> DataFrame:
    """(doc_id, n_tokens, crc, width, ids) of every whole text with the end id behind it; ids as 16 or 32-bit numbers.

    Beside them rows that hold only ``counts``: per task, how often each id occurs.
    """
    names = ["doc_id", "n_tokens", "crc", "width", "ids", "counts"]

    def made(batch: pa.RecordBatch, words: Words) -> tuple[pa.RecordBatch, np.ndarray]:
        kind = np.dtype("<u2" if max(words.size, end) < 2**16 else "<u4")
        ids, bounds = words.encode(batch.column("text"))
        n = batch.num_rows
        own = np.empty(len(ids) + n, np.int32)
        ends = bounds[1:] + np.arange(n)  # where the end ids stand
        inner = np.ones(len(own), bool)
        inner[ends] = False
        own[inner], own[ends] = ids, end
        bounds = np.concatenate(([0], ends + 1))
        wide, narrow = memoryview(own.astype("<u4").tobytes()), own.astype(kind).tobytes()
        crc = [zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        packed = pa.Array.from_buffers(
            pa.large_binary(), n, [None, pa.py_buffer(bounds * kind.itemsize), pa.py_buffer(narrow)]
        ).cast(pa.binary())
        columns = [
            batch.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), pa.array(crc, pa.int64()),
            pa.array(np.full(n, kind.itemsize), pa.int32()), packed, pa.nulls(n, pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names), np.bincount(own, minlength=max(words.size, end + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = words_of(vocabulary), 0
        for batch in batches:
            for a, b in by_bytes(batch.column("text"), TOGETHER_BYTES):
                out, seen = made(batch.slice(a, b - a), words)
                counts = counts + seen
                yield out
        if np.any(counts):
            gaps = [pa.nulls(1, k) for k in (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*gaps, pa.array([counts.astype("<i8").tobytes()], pa.binary())], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, crc long, width int, ids binary, counts binary")


def counted(tokens: DataFrame) -> rans.Table:
    """The shared table, from the counts of all tokens; its size is that of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for counts in batch.column("counts"):
                total = total + np.frombuffer(counts.as_buffer(), "<i8")
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(np.atleast_1d(total)[seen], pa.int64())], ["token", "n"])

    rows = tokens.filter("counts IS NOT NULL").select("counts").mapInArrow(run, "token long, n long")
    rows = rows.groupBy("token").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r.token for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        counts[r.token] = r.n
    return rans.Table.of_counts(counts)


def pack_table(table: rans.Table) -> bytes:
    return struct.pack("<I", table.bits) + zlib.compress(table.freq.astype("<u4").tobytes())


def unpack_table(raw: bytes) -> rans.Table:
    return rans.Table(struct.unpack_from("<I", raw)[0], np.frombuffer(zlib.decompress(raw[4:]), "<u4").astype(np.int64))


def framed(body: bytes) -> bytes:
    return struct.pack("<I", len(body)) + body


def pack_block(block: rans.Block, tokens: np.ndarray, entries: list[tuple[int | None, int]]) -> bytes:
    ids, sizes = np.array([i or 0 for i, _ in entries], "<i8"), np.array([n for _, n in entries], "<i8")
    null = np.array([i is None for i, _ in entries], np.uint8)
    directory = zlib.compress(ids.tobytes() + null.tobytes() + sizes.tobytes())
    head = BLOCK.pack(block.n, zlib.crc32(tokens.astype("<u4").tobytes()), len(block.words), len(entries), len(directory))
    marks = b"".join(s.astype("<u8").tobytes() + struct.pack("<I", p) for s, p in zip(block.states, block.places.tolist()))
    return framed(head + directory + marks + block.words.astype("<u4").tobytes())


def unpack_block(body: memoryview) -> tuple[rans.Block, int, list[tuple[int | None, int]]]:
    n, check, n_words, n_docs, n_directory = BLOCK.unpack_from(body)
    at = BLOCK.size
    raw = zlib.decompress(body[at : at + n_directory])
    ids, null, sizes = np.frombuffer(raw, "<i8", n_docs), raw[8 * n_docs : 9 * n_docs], np.frombuffer(raw, "<i8", n_docs, 9 * n_docs)
    entries = [(None if z else i, s) for i, z, s in zip(ids.tolist(), null, sizes.tolist())]
    at += n_directory
    marks = -(-rans.steps_of(n) // rans.STRIDE)
    each = np.dtype([("states", "<u8", rans.LANES), ("place", "<u4")])
    table = np.frombuffer(body, each, marks, at)
    words = np.frombuffer(body, "<u4", n_words, at + marks * each.itemsize)
    return rans.Block(n, words, table["states"], table["place"]), check, entries


def records(batches: Iterator[pa.RecordBatch], table: rans.Table, check: int) -> Iterator[bytes]:
    """The records of one file, from documents in order."""
    pending: list[np.ndarray] = []  # tokens not yet in a block
    held = 0
    begun: list[list[tuple[int | None, int]]] = [[]]  # documents by the block that they begin in
    blocks: list[np.ndarray] = []
    first = True

    def out() -> Iterator[bytes]:
        for tokens, coded, entries in zip(blocks, rans.encode(table, blocks), begun):
            yield pack_block(coded, tokens, entries)
        del begun[: len(blocks)]
        blocks.clear()

    for batch in batches:
        for doc_id, width, ids in zip(batch.column("doc_id").to_pylist(), batch.column("width").to_pylist(), batch.column("ids")):
            if first:
                yield framed(HEAD.pack(MAGIC, check, TaskContext.get().partitionId()))
                first = False
            tokens = np.frombuffer(ids.as_buffer(), f"<u{width}")
            begun[-1].append((doc_id, len(tokens)))
            while held + len(tokens) >= rans.BLOCK:
                cut = rans.BLOCK - held
                blocks.append(np.concatenate([*pending, tokens[:cut]]))
                pending, held, tokens = [], 0, tokens[cut:]
                begun.append([])
                if len(blocks) == TOGETHER:
                    yield from out()
            if len(tokens):
                pending.append(tokens)
                held += len(tokens)
    if held:
        blocks.append(np.concatenate(pending))
    if blocks:
        yield from out()


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end: int = 2, file_tokens: int = 8_000_000) -> None:
    """Tokenise ``docs`` and write the table and the files below ``folder``, which must not exist."""
    spark = docs.sparkSession
    made = cut_lineage(tokenised(docs, vocabulary, end), compression="zstd")
    table, tokens = counted(made), made.filter("counts IS NULL")
    packed = pack_table(table)
    check = zlib.crc32(packed)
    spark.createDataFrame([(bytearray(packed),)], "packed binary").coalesce(1).write.parquet(f"{folder}/table")
    shared = spark.sparkContext.broadcast(table)  # bounded by the vocabulary
    total = tokens.agg(F.sum("n_tokens").alias("n")).first().n or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in records(batches, shared.value, check):
            yield pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], ["record"])

    # the written rows keep their place, so equal keys are cut and ordered alike in every run of a task
    keys = [F.col("doc_id").asc_nulls_first(), F.col("n_tokens"), F.col("crc"), F.col("place")]
    rows = tokens.withColumn("place", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange(max(1, -(-total // file_tokens)), *keys).sortWithinPartitions(*keys)
    # a cast to string keeps the bytes; the sink writes them and a line feed
    lines = ranged.select("doc_id", "width", "ids").mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    lines.write.option("compression", "none").text(f"{folder}/tokens")
    forget(made)


def documents_of(content: memoryview, table: rans.Table, check: int) -> Iterator[tuple[int, int | None, int, np.ndarray]]:
    """(file number, doc_id, place of its first token in the file, tokens) of a file's documents."""
    at, file_no, place = 0, 0, 0
    waiting: list[tuple[int | None, int]] = []
    rest = np.empty(0, np.int32)
    group: list[tuple[rans.Block, int, list]] = []
    while at < len(content):
        size = struct.unpack_from("<I", content, at)[0]
        body = content[at + 4 : at + 4 + size]
        if at == 0:
            magic, wanted, file_no = HEAD.unpack(body)
            if magic != MAGIC or wanted != check:
                raise ValueError("not a token file of this table")
        else:
            group.append(unpack_block(body))
        if content[at + 4 + size] != 10:
            raise ValueError("a record does not end where it should")
        at += size + 5
        if group and (len(group) == TOGETHER or at >= len(content)):
            parts = [rest]
            for (_, crc, entries), tokens in zip(group, rans.decode(table, [b for b, _, _ in group])):
                if zlib.crc32(tokens.astype("<u4").tobytes()) != crc:
                    raise ValueError("the tokens of a block do not match their checksum")
                waiting += entries
                parts.append(tokens)
            group = []
            rest, used, done = np.concatenate(parts), 0, 0
            for doc_id, n in waiting:
                if used + n > len(rest):
                    break
                yield file_no, doc_id, place, rest[used : used + n]
                used, place, done = used + n, place + n, done + 1
            rest, waiting = rest[used:], waiting[done:]
    if waiting or len(rest):
        raise ValueError("a token file ends within a document")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, doc_id, place, n_tokens, ids) of every document; ids as little-endian 32-bit numbers.

    ``place`` counts tokens within the file; ``with_starts`` adds up the files.
    """
    packed = bytes(spark.read.parquet(f"{folder}/table").first().packed)
    check = zlib.crc32(packed)
    shared = spark.sparkContext.broadcast(unpack_table(packed))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "doc_id", "place", "n_tokens", "ids"]
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for file_no, doc_id, place, tokens in documents_of(memoryview(content.as_buffer()), shared.value, check):
                    rows.append((file_no, doc_id, place, len(tokens), tokens.astype("<u4").tobytes()))
                    size += len(tokens)
                    if size > 250_000:
                        yield made(rows)
                        rows, size = [], 0
                if rows:
                    yield made(rows)

    files = spark.read.format("binaryFile").load(f"{folder}/tokens").select("content")
    return files.mapInArrow(run, "file int, doc_id long, place long, n_tokens long, ids binary")


def with_starts(rows: DataFrame) -> DataFrame:
    """Add ``start``, the number of tokens of all documents before. ``rows`` should be a narrow, written table."""
    sizes = rows.groupBy("file").agg(F.sum("n_tokens").alias("size"))
    # one row per file, so the window holds a row for each ``file_tokens`` tokens
    before = sizes.select("file", (F.sum("size").over(W.orderBy("file")) - F.col("size")).alias("before"))
    return rows.join(before, "file").withColumn("start", F.col("before") + F.col("place"))
