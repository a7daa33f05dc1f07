"""Token ids in patched frame-of-reference files.

A shard file holds a header, blocks of ``BLOCK`` ids, an index of where each
block starts, and a table of the documents in it::

    header   magic, block length, number of ids, of documents and of blocks
    index    where each block starts, unsigned 64-bit
    ids      signed 64-bit document ids, then a byte each: 1 for an id that is null
    lengths  unsigned 64-bit number of ids of each document
    blocks   minimum, width, number of exceptions, packed offsets from the minimum, positions and values of the exceptions

The width of a block holds a given share of its offsets; larger ones are
exceptions and are stored whole. Files are written to the folder shared by the
executors, under a temporary name first, and are a function of their input, so
a task that runs twice leaves the same file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagloom.llm.common import arrow_schema, batch_of, identified, map_batches, strings
from tagloom.llm.tokens import END, token_ids
from tagloom.session import materialised, scratch_path

BLOCK = 512
TOGETHER = 256  # blocks that are encoded at once
WIDTH_SHARE = 0.95
SHARD_IDS = 4_000_000  # a file is closed when it has that many ids
MAGIC = b"PFORIDS1"
_HEADER = struct.Struct("<8sIQQQ")
_BLOCK_HEAD = struct.Struct("<IBH")

MANIFEST = "shard long, path string, n_ids long, n_docs long"
READ_SCHEMA = "doc_id long, shard long, local_start long, n_tokens long, ids_crc32 long"


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """Low ``width`` bits of each value, least significant bit first."""
    if width == 0:
        return b""
    if width in (8, 16, 32):
        return values.astype(f"<u{width // 8}").tobytes()
    bits = (values[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


@lru_cache(maxsize=64)
def _places(width: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The byte in which each value starts, and the bits before it in that byte."""
    at = np.arange(count) * width
    return at >> 3, (at & 7).astype(np.uint32)


def unpack_bits(data: memoryview, width: int, count: int) -> np.ndarray:
    if width == 0:
        return np.zeros(count, np.uint32)
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count).astype(np.uint32)
    if width <= 25:  # with the bits before it in its first byte, a value lies within four bytes
        first, shift = _places(width, count)
        size = packed_bytes(width, count)
        words = np.ndarray(size, "<u4", bytes(data[:size]) + bytes(3), strides=(1,))
        return (words[first] >> shift) & np.uint32((1 << width) - 1)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=count * width, bitorder="little").reshape(count, width)
    return bits.astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


def pack_rows(rows: np.ndarray, width: int) -> list[bytes]:
    """``pack_bits`` of each row."""
    if width in (0, 8, 16, 32):
        return [pack_bits(row, width) for row in rows]
    bits = np.empty((*rows.shape, width), np.uint8)
    for k in range(width):
        bits[:, :, k] = (rows >> np.uint32(k)) & 1
    return [row.tobytes() for row in np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")]


def packed_bytes(width: int, count: int) -> int:
    return (width * count + 7) // 8


def encode_block(ids: np.ndarray, share: float = WIDTH_SHARE) -> bytes:
    low = int(ids.min())
    offsets = ids - np.uint32(low)
    rank = max(0, int(np.ceil(share * len(ids))) - 1)
    width = int(np.partition(offsets, rank)[rank]).bit_length()
    over = np.flatnonzero(offsets >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    kept = offsets.copy()
    kept[over] = 0
    return b"".join([_BLOCK_HEAD.pack(low, width, len(over)), pack_bits(kept, width), over.astype("<u2").tobytes(),
                     offsets[over].astype("<u4").tobytes()])


def encode_blocks(ids: np.ndarray, block: int, share: float = WIDTH_SHARE) -> list[bytes]:
    """``encode_block`` of each ``block`` ids; whole blocks are dealt with ``TOGETHER`` at a time, those of one width at once."""
    whole = len(ids) // block
    done = []
    for first in range(0, whole, TOGETHER):
        grid = ids[first * block:min(first + TOGETHER, whole) * block].reshape(-1, block)
        low = grid.min(axis=1)
        offsets = grid - low[:, None]
        rank = max(0, int(np.ceil(share * block)) - 1)
        width = np.frexp(np.partition(offsets, rank, axis=1)[:, rank].astype(np.float64))[1]
        limit = np.uint64(1) << width.astype(np.uint64)
        row, position = np.nonzero(offsets >= limit[:, None])
        values, position = offsets[row, position].astype("<u4"), position.astype("<u2")
        ends = np.searchsorted(row, np.arange(len(grid) + 1)).tolist()
        kept = offsets.copy()
        kept[row, position] = 0
        packed = [b""] * len(grid)
        for w in np.unique(width).tolist():
            rows = np.flatnonzero(width == w)
            for k, data in zip(rows.tolist(), pack_rows(kept[rows], w)):
                packed[k] = data
        for k, (lowest, w) in enumerate(zip(low.tolist(), width.tolist())):
            a, b = ends[k], ends[k + 1]
            done.append(b"".join([_BLOCK_HEAD.pack(lowest, w, b - a), packed[k], position[a:b].tobytes(), values[a:b].tobytes()]))
    if whole * block < len(ids):
        done.append(encode_block(ids[whole * block:], share))
    return done


def decode_block(data: memoryview, count: int) -> np.ndarray:
    low, width, n_over = _BLOCK_HEAD.unpack_from(data)
    at = _BLOCK_HEAD.size
    offsets = unpack_bits(data[at:at + packed_bytes(width, count)], width, count)
    at += packed_bytes(width, count)
    if n_over:
        positions = np.frombuffer(data[at:at + 2 * n_over], "<u2")
        offsets[positions] = np.frombuffer(data[at + 2 * n_over:at + 6 * n_over], "<u4")
    return offsets + np.uint32(low)


def encode_shard(doc_ids: list[int | None], pieces: list[bytes], block: int = BLOCK, share: float = WIDTH_SHARE) -> bytes:
    """A whole file: ``pieces`` are the ids of the documents as little-endian unsigned 32-bit integers."""
    ids = np.frombuffer(b"".join(pieces), "<u4")
    blocks = encode_blocks(ids, block, share)
    tables = [np.array([d or 0 for d in doc_ids], "<i8").tobytes(), bytes(d is None for d in doc_ids),
              np.array([len(p) // 4 for p in pieces], "<u8").tobytes()]
    first = _HEADER.size + 8 * len(blocks) + sum(map(len, tables))
    index = first + np.cumsum([0, *map(len, blocks)], dtype=np.int64)[:-1]
    header = _HEADER.pack(MAGIC, block, len(ids), len(doc_ids), len(blocks))
    return b"".join([header, index.astype("<u8").tobytes(), *tables, *blocks])


class Shard:
    """A file that was read back; any block can be decoded by itself."""

    def __init__(self, data: bytes):
        self.data = memoryview(data)
        magic, self.block, self.n_ids, self.n_docs, self.n_blocks = _HEADER.unpack_from(self.data)
        if magic != MAGIC:
            raise ValueError("not a token-id file")
        at = _HEADER.size
        self.index = np.frombuffer(self.data[at:at + 8 * self.n_blocks], "<u8")
        at += 8 * self.n_blocks
        ids = np.frombuffer(self.data[at:at + 8 * self.n_docs], "<i8")
        at += 8 * self.n_docs
        null = np.frombuffer(self.data[at:at + self.n_docs], np.uint8)
        self.doc_ids = [None if n else int(d) for d, n in zip(ids, null)]
        at += self.n_docs
        self.lengths = np.frombuffer(self.data[at:at + 8 * self.n_docs], "<u8").astype(np.int64)

    def decode(self, k: int) -> np.ndarray:
        """The ids of block ``k``."""
        end = int(self.index[k + 1]) if k + 1 < self.n_blocks else len(self.data)
        return decode_block(self.data[int(self.index[k]):end], min(self.block, self.n_ids - k * self.block))

    def ids(self) -> np.ndarray:
        return np.concatenate([self.decode(k) for k in range(self.n_blocks)] or [np.zeros(0, np.uint32)])


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the file system that Spark reads it from, so that every task writes to the same one."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def write_ids(docs: DataFrame, folder: str, tokenizer: str = "word_bpe_49k.json", block: int = BLOCK, share: float = WIDTH_SHARE,
              shard_ids: int = SHARD_IDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token ids of all whole texts, each with the end id 1, in ascending id order; return the list of the files.

    ``folder`` must be reachable by all executors. Null ids come first, rows of one id are ordered by text, a null or empty text
    is the end id alone, repeated rows are all written, an empty table writes no file. Further columns are ignored.
    """
    folder = qualified(docs.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, schema = token_ids(tokenizer), arrow_schema(MANIFEST)
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        task = TaskContext.get()
        written, doc_ids, pieces, held = 0, [], [], 0

        def close():
            shard = (task.partitionId() << 20) + written
            path = f"{root}/shard-{shard:015d}.pfor"
            own = f"{path}.{task.taskAttemptId()}-{uuid.uuid4().hex}.tmp"
            with files.open_output_stream(own) as out:
                out.write(encode_shard(doc_ids, pieces, block, share))
            files.move(own, path)
            return batch_of(schema, [[shard], [path], [held], [len(doc_ids)]])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), strings(batch)):
                ids = encode(text) + END
                doc_ids.append(doc_id)
                pieces.append(ids)
                held += len(ids) // 4
                if held >= shard_ids:
                    yield close()
                    written, doc_ids, pieces, held = written + 1, [], [], 0
        if doc_ids:
            yield close()

    rows = identified(docs, id_col, text_col)
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return materialised(map_batches(ordered, run, MANIFEST), "id-files")


def read_ids(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per document from the files: its id, where it starts in the whole order, its ids' number and checksum."""
    if not manifest.take(1):
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(READ_SCHEMA)
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                shard = Shard(content.as_buffer())
                number = int(path.rpartition("/shard-")[2].split(".")[0])
                data = shard.ids().astype("<u4").tobytes()
                ends = np.cumsum(shard.lengths)
                starts = ends - shard.lengths
                crcs = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield batch_of(schema, [shard.doc_ids, [number] * shard.n_docs, starts, shard.lengths, crcs])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pfor").load(folder)
    read = map_batches(files.select("path", "content"), run, READ_SCHEMA)
    # One row per file, so a window over all of them is small.
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = manifest.select("shard", before.alias("first"))
    return read.join(offsets, "shard").select("doc_id", (F.col("first") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """Write the ids to a new folder below the shared one and read the files back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-ids")
    return read_ids(spark, folder, write_ids(docs, folder, tokenizer))
