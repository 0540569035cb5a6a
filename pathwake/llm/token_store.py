"""Token ids of documents in directly addressable codes.

Ids are cut into chunks of ``CHUNK_BITS`` bits. Level 0 holds the lowest chunk of every id, level
1 the next chunk of those ids that have one, and so on; a bitmap of each level marks the ids
that go on, and a rank directory counts the marks before each block of ``RANK_BLOCK`` ids. The
chunk of any id is found by following ranks, without decoding its neighbours.

The store is a folder of Parquet files: one row per segment of whole documents, with the coded
ids as a binary value and the documents' ids and lengths beside it. Spark's commit protocol
makes the files appear once, whatever tasks are repeated. Segments of a shard are in order, and
shards are ranges of the document order.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pathwake.llm.arrays import span_hashes, text_slices
from pathwake.runtime import new_path

CHUNK_BITS = 8
RANK_BLOCK = 512
SEGMENT_IDS = 1 << 18
STRETCH = 1 << 16  # ids whose positions are looked up together
# Distinct pieces whose ids a Python worker remembers; beyond this it forgets all and goes on.
REMEMBERED = 1_000_000
END_ID = 2
_MAGIC = b"DAC1"
_HEAD = struct.Struct("<4sBBxxQ")
STORE = "shard int, segment int, first bigint, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, codes binary"


def encode_codes(ids: np.ndarray) -> bytes:
    """Bytes of one segment: a header, then for each level its chunks, bitmap and directory."""
    values, levels = ids.astype(np.uint64), []
    while True:
        rest = values >> np.uint64(CHUNK_BITS)
        more = rest > 0
        marks = np.packbits(more, bitorder="little")
        counts = np.add.reduceat(more, np.arange(0, max(len(more), 1), RANK_BLOCK)) if len(more) else np.zeros(0, int)
        ranks = np.concatenate([[0], np.cumsum(counts)]).astype("<u4")
        chunks = (values & np.uint64((1 << CHUNK_BITS) - 1)).astype(np.uint8)
        levels.append(struct.pack("<Q", len(values)) + chunks.tobytes() + marks.tobytes() + ranks.tobytes())
        values = rest[more]
        if not len(values):
            return _HEAD.pack(_MAGIC, CHUNK_BITS, len(levels), len(ids)) + b"".join(levels)


class Codes:
    """Reads one segment; arrays are views of its bytes."""

    def __init__(self, data: bytes):
        magic, bits, levels, self.size = _HEAD.unpack_from(data)
        if magic != _MAGIC or bits != CHUNK_BITS:
            raise ValueError("not a segment of this format")
        at, self.levels = _HEAD.size, []
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", data, at)
            at += 8
            chunks = np.frombuffer(data, np.uint8, n, at)
            at += n
            marks = np.frombuffer(data, np.uint8, -(-n // 8), at)
            at += len(marks)
            ranks = np.frombuffer(data, "<u4", -(-n // RANK_BLOCK) + 1, at)
            at += 4 * len(ranks)
            self.levels.append((chunks, marks, ranks))

    def at(self, index: int) -> int:
        """The id at one position."""
        if not 0 <= index < self.size:
            raise IndexError(index)
        value = 0
        for level, (chunks, marks, ranks) in enumerate(self.levels):
            value |= int(chunks[index]) << (CHUNK_BITS * level)
            if not marks[index >> 3] >> (index & 7) & 1:
                break
            start = index // RANK_BLOCK * RANK_BLOCK
            before = np.unpackbits(marks[start >> 3:(index >> 3) + 1], bitorder="little")[:index - start]
            index = int(ranks[index // RANK_BLOCK]) + int(before.sum())
        return value

    def all(self) -> np.ndarray:
        """All ids, as unsigned 32-bit integers."""
        values = np.zeros(self.size, dtype=np.uint32)
        members = np.arange(self.size)
        for level, (chunks, marks, _) in enumerate(self.levels):
            values[members] |= chunks.astype(np.uint32) << np.uint32(CHUNK_BITS * level)
            members = members[np.unpackbits(marks, count=len(chunks), bitorder="little").astype(bool)]
        return values


# Kinds of bytes for cutting texts into pieces that are tokenized independently.
_SPACE, _LETTER, _DIGIT, _SIGN, _OTHER = range(5)
_KINDS = np.full(256, _OTHER, dtype=np.uint8)
_KINDS[[*range(0x09, 0x0E), 0x20]] = _SPACE
_KINDS[[*range(65, 91), *range(97, 123)]] = _LETTER
_KINDS[48:58] = _DIGIT
_KINDS[[c for c in range(33, 127) if not chr(c).isalnum() and c != 0x27]] = _SIGN


def piece_starts(data: np.ndarray, bounds: np.ndarray, specials: list[bytes]) -> np.ndarray:
    """Places where the tokenizer's own pattern surely starts a new match, and text starts.

    These are: white space after anything else, and a change between ASCII letters, digits and
    signs other than the apostrophe. The pattern looks ahead only within white space and after
    apostrophes, so each piece has the tokens it has in the whole text. Texts with a special
    token's string stay whole.
    """
    n = len(data)
    cut = np.zeros(n + 1, dtype=bool)
    if n:
        kind = _KINDS[data]
        before, here = kind[:-1], kind[1:]
        # White space beyond ASCII may join a run; bytes that can end it are not cut after.
        wide = np.zeros(n, dtype=bool)
        wide[1:] = (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
        wide[2:] |= ((data[:-2] == 0xE2) & ((data[1:-1] == 0x80) | (data[1:-1] == 0x81))) | (
            (data[:-2] == 0xE1) & (data[1:-1] == 0x9A)) | ((data[:-2] == 0xE3) & (data[1:-1] == 0x80))
        solid = (before != _SPACE) & ~wide[:-1] & (data[:-1] >= 0x20)
        plain = (before >= _LETTER) & (before <= _SIGN) & (here >= _LETTER) & (here <= _SIGN) & (before != here)
        cut[1:n] = ((here == _SPACE) & solid) | plain
    blob = data.tobytes()
    for special in specials:
        found = blob.find(special)
        while found >= 0:
            text = int(np.searchsorted(bounds, found, side="right")) - 1
            cut[bounds[text]:bounds[text + 1]] = False
            found = blob.find(special, int(bounds[text + 1]))
    cut[bounds] = True
    return np.flatnonzero(cut[:n])


class PieceEncoder:
    """Token ids of many texts; each distinct piece is given to the tokenizer once."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted hashes of known pieces
        self.slots = np.zeros(0, np.int64)
        self.offsets = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        if len(self.keys) + len(keys) > REMEMBERED:
            self.forget()
        found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        ends = self.offsets[-1] + np.cumsum([len(x) for x in found])
        slots = len(self.offsets) - 1 + np.arange(len(found))
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in found for i in x), np.uint32)])
        self.offsets = np.concatenate([self.offsets, ends])
        places = np.searchsorted(self.keys, keys)
        self.keys, self.slots = np.insert(self.keys, places, keys), np.insert(self.slots, places, slots)

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, ends)``: text ``i`` has ``ids[ends[i]:ends[i + 1]]``."""
        starts = piece_starts(data, bounds, self.specials)
        stops = np.append(starts[1:], len(data))
        hashes = span_hashes(data, starts, stops)
        keys, example, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        known = np.searchsorted(self.keys, keys)
        fresh = np.ones(len(keys), bool)
        inside = known < len(self.keys)
        fresh[inside] = self.keys[known[inside]] != keys[inside]
        if fresh.any():
            if len(self.keys) + fresh.sum() > REMEMBERED:
                self.forget()
                fresh[:] = True
            pieces = [data[starts[i]:stops[i]].tobytes().decode("utf-8", "replace") for i in example[fresh]]
            self._learn(keys[fresh], pieces)
        slots = self.slots[np.searchsorted(self.keys, keys)][inverse]
        lengths = self.offsets[slots + 1] - self.offsets[slots]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.ids[np.repeat(self.offsets[slots] - ends[:-1], lengths) + np.arange(ends[-1])]
        return ids, ends[np.searchsorted(starts, bounds)]


_encoders: dict[str, PieceEncoder] = {}


def encoder_of(path: str) -> PieceEncoder:
    """One encoder per Python worker and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def _segment(shard: int, number: int, first: int, docs: list, lengths: list, parts: list[np.ndarray]) -> pa.RecordBatch:
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, pa.int64()))
    return pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([first], pa.int64()), pa.array([len(ids)], pa.int64()),
         one(docs), one(lengths), pa.array([encode_codes(ids)], pa.binary())],
        names=["shard", "segment", "first", "n_ids", "doc_ids", "lengths", "codes"],
    )


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, order: tuple[str, ...] = ("doc_id",)) -> None:
    """Encode the texts of ``docs`` in the order of the columns ``order`` into a store at ``path``.

    Every text, a null as empty, is followed by ``end_id``. Rows equal in ``order`` follow each
    other by text.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        shard, number, first = TaskContext.get().partitionId(), 0, 0
        ids_of, lengths, parts, held = [], [], [], 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            for at, to, data, bounds in text_slices(batch.column(1)):
                ids, ends = encoder.encode(data, bounds)
                for i in range(to - at):
                    if held and held + ends[i + 1] - ends[i] + 1 > SEGMENT_IDS:
                        yield _segment(shard, number, first, ids_of, lengths, parts)
                        number, first = number + 1, first + held
                        ids_of, lengths, parts, held = [], [], [], 0
                    parts += [ids[ends[i]:ends[i + 1]], np.array([end_id], np.uint32)]
                    ids_of.append(names[at + i])
                    lengths.append(int(ends[i + 1] - ends[i]) + 1)
                    held += lengths[-1]
        if lengths:
            yield _segment(shard, number, first, ids_of, lengths, parts)

    # The order of the range partitions is kept when small ones are joined.
    laid = docs.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    laid.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(encode, STORE).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a store, from its files: doc_id, start, n_tokens, ids_crc32."""
    store = spark.read.schema(STORE).parquet(path)
    # One row per shard, that is per writing task.
    totals = store.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    base = totals.select("shard", F.coalesce(before, F.lit(0)).alias("base"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                docs, lengths = batch.column(1)[i].values, batch.column(2)[i].values.to_numpy()
                ids = Codes(batch.column(3)[i].as_py()).all().astype("<u4")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                checks = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [docs, pa.array(starts + batch.column(0)[i].as_py(), pa.int64()), pa.array(lengths, pa.int64()), pa.array(checks, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    placed = store.join(F.broadcast(base), "shard").select((F.col("base") + F.col("first")).alias("start"), "doc_ids", "lengths", "codes")
    return placed.mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def tokens_at(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """``(doc_id, at, id)`` for each row of ``wanted(doc_id, at)``; only those codes are read.

    A position outside its document, and a document that is not stored, give no row. Positions
    of a stretch of ``STRETCH`` ids are looked up together, so its segment's codes travel once.
    """
    store = spark.read.schema(STORE).parquet(path)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                docs, lengths = batch.column(2)[i].values, batch.column(3)[i].values.to_numpy()
                begins = np.cumsum(lengths) - lengths
                one = [pa.array(np.full(len(docs), batch.column(c)[i].as_py())) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([*one, docs, pa.array(lengths, pa.int64()), pa.array(begins, pa.int64())], names=["shard", "segment", "doc_id", "length", "place"])

    index = store.select(F.col("shard").cast("long"), F.col("segment").cast("long"), "doc_ids", "lengths").mapInArrow(
        places, "shard bigint, segment bigint, doc_id bigint, length bigint, place bigint"
    )
    wanted = wanted.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("at").cast("long").alias("at"))
    asked = index.join(wanted, "doc_id").filter("at >= 0 and at < length").withColumn("place", F.col("place") + F.col("at"))
    together = asked.groupBy("shard", "segment", F.expr(f"place div {STRETCH}").alias("stretch")).agg(F.collect_list(F.struct("doc_id", "at", "place")).alias("asked"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                reader, rows = Codes(batch.column(1)[i].as_py()), batch.column(0)[i].values
                names, at, place = (rows.field(c) for c in ("doc_id", "at", "place"))
                found = [reader.at(x) for x in place.to_pylist()]
                yield pa.RecordBatch.from_arrays([names, at, pa.array(found, pa.int64())], names=["doc_id", "at", "id"])

    joined = together.join(store.select("shard", "segment", "codes"), ["shard", "segment"])
    return joined.select("asked", "codes").mapInArrow(look, "doc_id bigint, at bigint, id bigint")


def stored_tokens(docs: DataFrame, vocabulary: str, order: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Write ``docs`` into a new store in the shared folder and read it back.

    Defined for every input: a null or empty text has only the end id; null ids come first;
    repeated rows and repeated ids are each stored; an empty table gives an empty result;
    columns other than doc_id, text and those of ``order`` are not read.
    """
    path = new_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary, END_ID, order)
    return read_tokens(docs.sparkSession, path)
