"""Token ids in shard files that are wavelet matrices.

A shard holds the ids of consecutive documents, in order of doc_id, each document closed by the
end id. Its ids are stored bit by bit, highest bits first: every plane has one bit for each
id, and ids with bit 0 stand before ids with bit 1 on the next plane, otherwise in the same
order. Planes are cut into blocks that are compressed by themselves; a directory has the
number of ones before every block. So a reader fetches only the blocks that it needs to

* read the id at a position (``access``), one block a plane;
* count an id before a position (``rank``), two blocks a plane;
* find the k-th place of an id (``select``), the same way down and up again;
* read a shard whole (``tokens``), plane by plane.

``write`` deals the documents out by range of doc_id, so that one task meets its documents in order,
encodes them and closes a shard at the first end of a document after ``SHARD_TOKENS``
ids; a task holds one shard at a time. Files go to a shared folder under names that no two
attempts share, and the list of shards, written by Spark, names only those of attempts that succeeded. ``read``,
``token_at``, ``count`` and ``occurrences`` work from that list, one shard at a time.

Encoding gives what the library gives for the whole text. A pre-token's ids do not depend on its
neighbours, so texts are cut into units where pre-tokens end in any case, and the ids
of the units met last are kept. The strings of special tokens are ordinary text.

Defined cases: a null text counts as empty and is the end id alone; a null doc_id comes first;
rows of equal doc_id stand in the order of a hash of their text, equal rows in the order in which
they were read; a text of any length is one document of one shard; a table without rows has no
shards. Only the named columns are read, so others may be called anything.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator, Sequence
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaymill.llm.common import small_batches, stored, text_groups
from assaymill.runtime import new_scratch_path

MAGIC = b"AWM1"
BLOCK_BITS = 1 << 16
SHARD_TOKENS = 1 << 21
HELD_UNITS, HELD_LENGTH = 1_000_000, 32  # how many units a worker keeps the ids of, and how long they may be


# The file.


def matrix_bytes(ids: np.ndarray, doc_ids: Sequence[int | None], lengths: Sequence[int]) -> bytes:
    """The file of a shard: header, documents, and per plane the blocks and how many ones stand before each."""
    bits = max(1, int(ids.max(initial=0)).bit_length())
    parts, zeros, ranks, ends, at = [], [], [], [], 0
    values = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    pack = zstandard.ZstdCompressor(level=1).compress
    for shift in range(bits - 1, -1, -1):
        ones = (values & values.dtype.type(1 << shift)).astype(bool)
        plane = np.packbits(ones)
        starts = range(0, len(plane), BLOCK_BITS // 8)
        counts = np.add.reduceat(np.bitwise_count(plane), list(starts), dtype=np.int64) if len(plane) else np.zeros(0, np.int64)
        ranks.append(np.concatenate([[0], np.cumsum(counts)]))
        for i in starts:
            parts.append(pack(plane[i:i + BLOCK_BITS // 8].tobytes()))
            at += len(parts[-1])
            ends.append(at)
        low = values.take(np.flatnonzero(~ones))  # faster than a mask where bits are as good as random
        zeros.append(len(low))
        values = np.concatenate([low, values.take(np.flatnonzero(ones))])
    known = [d is not None for d in doc_ids]
    directory = pack(b"".join([
        np.packbits(known).tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array(lengths, "<i8").tobytes(),
        np.array(ranks, "<i8").tobytes(), np.array(ends, "<i8").tobytes()]))
    header = json.dumps({"tokens": len(ids), "docs": len(known), "bits": bits, "block_bits": BLOCK_BITS,
                         "zeros": zeros, "directory": len(directory)}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, directory, *parts])


class Shard:
    """A shard file, opened for reading. Positions count from 0 within the shard."""

    def __init__(self, file: BinaryIO):
        self.file = file
        magic, size = struct.unpack("<4sI", file.read(8))
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        head = json.loads(file.read(size))
        self.n, self.bits, self.block_bits, self.zeros = head["tokens"], head["bits"], head["block_bits"], head["zeros"]
        raw, docs = zstandard.decompress(file.read(head["directory"])), head["docs"]
        self.payload = 8 + size + head["directory"]
        self.blocks = -(-self.n // self.block_bits)
        known = np.unpackbits(np.frombuffer(raw, np.uint8, -(-docs // 8)), count=docs)
        rest = np.frombuffer(raw[-(-docs // 8):], "<i8")
        self.doc_ids = [int(d) if k else None for k, d in zip(known, rest[:docs])]
        self.lengths = rest[docs:2 * docs]
        self.ranks = rest[2 * docs:2 * docs + self.bits * (self.blocks + 1)].reshape(self.bits, self.blocks + 1)
        self.ends = np.concatenate([[0], rest[2 * docs + self.bits * (self.blocks + 1):]])
        self.kept: dict[int, np.ndarray] = {}

    def _fetched(self, first: int, last: int) -> bytes:
        self.file.seek(self.payload + int(self.ends[first]))
        return self.file.read(int(self.ends[last] - self.ends[first]))

    def _bits(self, plane: int, block: int) -> np.ndarray:
        """The bits of one block, kept for later calls."""
        at = plane * self.blocks + block
        if at not in self.kept:
            packed = np.frombuffer(zstandard.decompress(self._fetched(at, at + 1)), np.uint8)
            self.kept[at] = np.unpackbits(packed, count=min(self.block_bits, self.n - block * self.block_bits))
        return self.kept[at]

    def _ones_before(self, plane: int, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ones stand before each position, and the bit that stands there (0 behind the last)."""
        counts, bits = np.empty(len(positions), np.int64), np.zeros(len(positions), np.int64)
        blocks = positions // self.block_bits
        for block in np.unique(blocks):
            here = np.flatnonzero(blocks == block)
            if block >= self.blocks:
                counts[here] = self.ranks[plane, self.blocks]
                continue
            plain, inside = self._bits(plane, int(block)), positions[here] - block * self.block_bits
            before = np.concatenate([[0], np.cumsum(plain, dtype=np.int64)])
            counts[here] = self.ranks[plane, block] + before[inside]
            bits[here] = np.append(plain, 0)[inside]
        return counts, bits

    def _place_of(self, plane: int, bit: int, numbers: np.ndarray) -> np.ndarray:
        """Where the ``numbers``-th (from 0) zeros or ones of a plane stand."""
        edges = self.ranks[plane]
        if not bit:
            edges = np.minimum(np.arange(self.blocks + 1) * self.block_bits, self.n) - edges
        blocks, places = np.searchsorted(edges, numbers, "right") - 1, np.empty(len(numbers), np.int64)
        for block in np.unique(blocks):
            here = np.flatnonzero(blocks == block)
            found = np.flatnonzero(self._bits(plane, int(block)) == bit)
            places[here] = block * self.block_bits + found[numbers[here] - edges[block]]
        return places

    def access(self, positions: np.ndarray) -> np.ndarray:
        """The ids at ``positions``."""
        at, ids = np.asarray(positions, np.int64), np.zeros(len(positions), np.int64)
        for plane in range(self.bits):
            ones, bits = self._ones_before(plane, at)
            ids = ids << 1 | bits
            at = np.where(bits, self.zeros[plane] + ones, at - ones)
        return ids

    def _run(self, token: int, end: int) -> tuple[int, int]:
        """Where the run of ``token`` begins behind the last plane, and where the one of its places before ``end`` ends."""
        edges = np.array([0, end], np.int64)
        if token >> self.bits:
            return 0, 0
        for plane in range(self.bits):
            ones, _ = self._ones_before(plane, edges)
            edges = self.zeros[plane] + ones if token >> (self.bits - 1 - plane) & 1 else edges - ones
        return int(edges[0]), int(edges[1])

    def rank(self, token: int, end: int | None = None) -> int:
        """How often ``token`` stands before position ``end`` (null: in the whole shard)."""
        first, last = self._run(token, self.n if end is None else end)
        return last - first

    def select(self, token: int, numbers: np.ndarray) -> np.ndarray:
        """The positions of the ``numbers``-th (from 0) places of ``token``."""
        first, _ = self._run(token, self.n)
        at = first + np.asarray(numbers, np.int64)
        for plane in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - plane) & 1
            at = self._place_of(plane, bit, at - self.zeros[plane] if bit else at)
        return at

    def tokens(self) -> np.ndarray:
        """All ids, from the last plane to the first."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        unpack = zstandard.ZstdDecompressor().decompress
        values = np.zeros(self.n, kind)
        for plane in range(self.bits - 1, -1, -1):
            first = plane * self.blocks
            raw = self._fetched(first, first + self.blocks)
            base = int(self.ends[first])
            packed = b"".join(unpack(raw[self.ends[first + i] - base:self.ends[first + i + 1] - base]) for i in range(self.blocks))
            ones = np.unpackbits(np.frombuffer(packed, np.uint8), count=self.n).view(bool)
            above = np.empty(self.n, kind)
            above[np.flatnonzero(~ones)] = values[:self.zeros[plane]]
            above[np.flatnonzero(ones)] = values[self.zeros[plane]:] | kind(1 << (self.bits - 1 - plane))
            values = above
        return values

    def starts(self) -> np.ndarray:
        """Where each document begins."""
        return np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64) if len(self.lengths) else np.zeros(0, np.int64)


def _opened(folder: str):
    """The file system and path of a folder that all executors share."""
    from pyarrow import fs

    scheme, _, rest = folder.partition(":")
    if scheme == "file" or not rest:
        return fs.LocalFileSystem(), "/" + (rest or scheme).lstrip("/")
    return fs.FileSystem.from_uri(folder)


# Encoding.

# A unit ends where pre-tokens end whatever stands around: letters and digits before a mark or white
# space, and otherwise what stands between white space, with the space before it.
UNIT = re.compile(r" ?[A-Za-z0-9À-ÖØ-öø-ÿ]+(?=[\s.,;:!?])| ?\S+|\s+(?!\S)|\s+")
# Characters on which this module's and the library's notions of white space differ.
OTHER_SPACE = re.compile("[\x1c-\x1f]")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it prints, else the next free one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in prints)
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


LETTERS = _byte_letters()
SPACE = LETTERS[32]


class _Units(dict):
    """Unit -> the bytes of its ids; those met last are held."""

    def __init__(self, tokenizer, kind):
        super().__init__()
        self.tokenizer, self.kind, self.merged = tokenizer, np.dtype(kind), tokenizer.model.tokenize

    def encoded(self, text: str) -> bytes:
        body = text[1:] if text[:1] == " " else text
        if not body.isalpha() or not text.isascii() and max(body) > "ÿ":
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:  # one pre-token, so the merges alone decide
            letters = text.encode().decode("latin-1").translate(LETTERS) if not text.isascii() else text.replace(" ", SPACE)
            ids = [token.id for token in self.merged(letters)]
        return array(self.kind.char, ids).tobytes()

    def __missing__(self, unit: str) -> bytes:
        ids = self.encoded(unit)
        if len(unit) <= HELD_LENGTH:
            if len(self) >= HELD_UNITS:
                self.clear()
            self[unit] = ids
        return ids

    def of(self, text: str) -> bytes:
        if OTHER_SPACE.search(text):
            return self.encoded(text)
        return b"".join(map(self.__getitem__, UNIT.findall(text)))


@functools.cache
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


@functools.cache
def _units(path: str, kind: str) -> _Units:
    return _Units(_tokenizer(path), kind)


# Writing.


def write(docs: DataFrame, path: str, end_id: int = 0, folder: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the texts of ``docs`` (doc_id, text) as shards; returns the list of them:
    path, docs, tokens, bytes, and start, the number of ids before it."""
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or new_scratch_path(spark, "token-shards")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        units = _units(path, "<u2" if max(tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
        kind = units.kind
        closing = np.array([end_id], kind).tobytes()
        files, place = _opened(folder)
        files.create_dir(place, recursive=True)
        ids: list[bytes] = []
        names: list[int | None] = []
        lengths: list[int] = []
        held = number = 0

        def closed() -> pa.RecordBatch:
            nonlocal held, number
            content = matrix_bytes(np.frombuffer(b"".join(ids), kind), names, lengths)
            name = f"{uuid.uuid4().hex}.awm"
            with files.open_output_stream(f"{place}/{name}") as out:
                out.write(content)
            row = {"part": TaskContext.get().partitionId(), "number": number, "path": f"{folder}/{name}", "docs": len(names),
                   "tokens": held, "bytes": len(content)}
            ids.clear(), names.clear(), lengths.clear()
            held, number = 0, number + 1
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            keys = batch.column(0)
            for at, texts in text_groups(batch.column(1)):
                for k, text in enumerate(texts):
                    ids.append(units.of(text or "") + closing)
                    names.append(keys[at + k].as_py())
                    lengths.append(len(ids[-1]) // kind.itemsize)
                    held += lengths[-1]
                    if held >= shard_tokens:
                        yield closed()
        if names:
            yield closed()

    order = [F.col("doc_id").asc_nulls_first(), F.col("_tie"), F.col("_at")]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("_tie"),
                       F.monotonically_increasing_id().alias("_at"))
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    schema = "part bigint, number bigint, path string, docs bigint, tokens bigint, bytes bigint"
    return with_starts(stored(sorted_rows.mapInArrow(run, schema), "shards"))


def with_starts(shards: DataFrame) -> DataFrame:
    """The list of shards with ``start``; one row for each task meets in one place, shards only per task."""
    tasks = shards.groupBy("part").agg(F.sum("tokens").alias("_tokens"))
    before = tasks.select("part", (F.sum("_tokens").over(Window.orderBy("part")) - F.col("_tokens")).alias("_before"))
    inside = F.sum("tokens").over(Window.partitionBy("part").orderBy("number")) - F.col("tokens")
    return shards.withColumn("_inside", inside).join(before, "part").select(
        "path", "docs", "tokens", "bytes", (F.col("_before") + F.col("_inside")).alias("start"))


# Reading.


def _per_shard(shards: DataFrame, make, schema: str) -> DataFrame:
    """``make(shard, start)`` yields record batches; shards are dealt out evenly and opened one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folder, _, name = path.rpartition("/")
                files, place = _opened(folder)
                with files.open_input_file(f"{place}/{name}") as file:
                    yield from make(Shard(file), start)

    tasks = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shards.select("path", "start").repartition(tasks).mapInArrow(run, schema)


def read(shards: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document, from the files."""
    def make(shard: Shard, start: int) -> Iterator[pa.RecordBatch]:
        ids = shard.tokens().astype("<u4")
        edges = [*shard.starts().tolist(), shard.n]
        columns = [pa.array(shard.doc_ids, pa.int64()), pa.array([start + e for e in edges[:-1]], pa.int64()),
                   pa.array(shard.lengths.astype(np.int64)),
                   pa.array([zlib.crc32(ids[a:b]) for a, b in zip(edges, edges[1:])], pa.int64())]
        if with_ids:
            columns.append(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids.astype(np.int32))))
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(columns)])

    return _per_shard(shards, make, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids)


def count(shards: DataFrame, tokens: Sequence[int]) -> DataFrame:
    """(token, n) for the listed ids over all shards."""
    wanted = list(dict.fromkeys(tokens))

    def make(shard: Shard, start: int) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array([shard.rank(t) for t in wanted], pa.int64())], ["token", "n"])

    return _per_shard(shards, make, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def occurrences(shards: DataFrame, tokens: Sequence[int], at_once: int = 1 << 16) -> DataFrame:
    """(token, pos, doc_id) for every place of the listed ids; ``pos`` counts over all shards."""
    wanted = list(dict.fromkeys(tokens))

    def make(shard: Shard, start: int) -> Iterator[pa.RecordBatch]:
        starts = shard.starts()
        for token in wanted:
            n = shard.rank(token)
            for first in range(0, n, at_once):
                places = shard.select(token, np.arange(first, min(n, first + at_once)))
                docs = np.searchsorted(starts, places, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([token] * len(places), pa.int64()), pa.array(places + start),
                     pa.array([shard.doc_ids[d] for d in docs], pa.int64())], ["token", "pos", "doc_id"])

    return _per_shard(shards, make, "token bigint, pos bigint, doc_id bigint")


def token_at(shards: DataFrame, positions: DataFrame, pos: str = "pos", width: int = SHARD_TOKENS) -> DataFrame:
    """(pos, token) for every row of ``positions``; a position beyond the last id gives no row.

    Shards and positions meet in stretches of ``width`` ids; rows are then dealt out by shard and place, so
    the positions of one shard may go to several tasks.
    """
    def stretch(place: Column) -> Column:
        return F.floor(place / width).cast("bigint")

    spans = shards.where("tokens > 0").select("path", "start", (F.col("start") + F.col("tokens")).alias("end"), F.explode(F.sequence(
        stretch(F.col("start")), stretch(F.col("start") + F.col("tokens") - 1))).alias("stretch"))
    asked = positions.select(F.col(pos).cast("bigint").alias("pos")).withColumn("stretch", stretch(F.col("pos")))
    met = asked.join(spans, "stretch").where("pos >= start and pos < end").select("path", "start", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, opened = None, None
        for batch in batches:
            paths = batch.column(0).to_pylist()
            places = (batch.column(2).to_numpy() - batch.column(1).to_numpy())
            edges = [i for i in range(len(paths)) if i == 0 or paths[i] != paths[i - 1]] + [len(paths)]
            ids = []
            for a, b in zip(edges, edges[1:]):
                if paths[a] != opened:
                    folder, _, name = paths[a].rpartition("/")
                    files, place = _opened(folder)
                    shard, opened = Shard(files.open_input_file(f"{place}/{name}")), paths[a]
                ids.append(shard.access(places[a:b]))
                shard.kept.clear()
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(np.concatenate(ids) if ids else [], pa.int64())], ["pos", "token"])

    return met.repartitionByRange("path", "pos").sortWithinPartitions("path", "pos").mapInArrow(run, "pos bigint, token bigint")
