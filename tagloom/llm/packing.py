"""Hierarchical multi-length packing of token sequences.

Documents are routed to context-size tiers (powers of two). A document longer
than the longest tier fills whole windows of it, and what is left is routed to
the smallest tier that holds it. Windows are filled from the longest tier down:
the gap behind a document takes the longest documents of shorter tiers that
fit, and at last a piece cut from the shortest one, so that windows are full.
The last windows of a partition are cut into powers of two, so nothing is padded.
Sequences of one tier are dealt into step groups of the same number of tokens.

Every task packs the documents of its own partition in blocks of bounded size
and carries what a block leaves over to the next one: no shuffle, and memory
depends on neither the table nor the partition.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tagloom.llm.common import arrow_schema, batch_of, identified, map_batches, strings
from tagloom.llm.tokens import END, token_ids

TIERS = (256, 512, 1024, 2048)
STEP_TOKENS = 16_384
BLOCK_TOKENS = 1_000_000
SEQUENCES_PER_PARTITION_BITS = 40

PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
                "tier int, step long")

Part = tuple[int, int, int]  # length, key of the document, start in it


def pack_block(parts: Sequence[Part], tiers: Sequence[int] = TIERS) -> tuple[list[tuple[int, list[Part]]], list[Part]]:
    """Full windows ``(tier, parts in order)`` of these document parts, and the parts left over."""
    longest = tiers[-1]
    windows: list[tuple[int, list[Part]]] = []
    pool: list[Part] = []
    for length, key, start in parts:
        while length >= longest:
            windows.append((longest, [(longest, key, start)]))
            start, length = start + longest, length - longest
        if length:
            pool.append((length, key, start))
    pool.sort()
    left: list[Part] = []
    while pool:
        window = [pool.pop()]
        tier = next(t for t in tiers if t >= window[0][0])
        gap = tier - window[0][0]
        while gap and pool:
            at = bisect_right(pool, gap, key=lambda p: p[0])
            if at:
                window.append(pool.pop(at - 1))
                gap -= window[-1][0]
            else:
                length, key, start = pool.pop(0)
                window.append((gap, key, start))
                insort(pool, (length - gap, key, start + gap))
                gap = 0
        if gap:
            left = window
        else:
            windows.append((tier, window))
    return windows, left


def pack_tail(parts: Sequence[Part], longest: int = TIERS[-1]) -> list[tuple[int, list[Part]]]:
    """Windows whose sizes are powers of two, the largest first, that hold exactly these parts."""
    queue, windows = list(parts)[::-1], []
    total = sum(p[0] for p in parts)
    while total:
        size = min(longest, 1 << (total.bit_length() - 1))
        window, gap = [], size
        while gap:
            length, key, start = queue.pop()
            taken = min(length, gap)
            window.append((taken, key, start))
            if taken < length:
                queue.append((length - taken, key, start + taken))
            gap -= taken
        windows.append((size, window))
        total -= size
    return windows


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", tiers: Sequence[int] = TIERS, step_tokens: int = STEP_TOKENS,
         with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack the tokens of all whole texts, each followed by the end id 1; one row per piece of a document.

    ``start`` and ``length`` place the piece in its document, ``sequence_id`` and ``offset`` in the packed output; ``tier`` is
    the length of the sequence and ``step`` its step group. With ``with_ids`` a column ``ids`` holds the ids as little-endian
    unsigned 32-bit integers. A null or empty text is the end id alone; every row is packed, repeated rows and null ids
    included; an empty table gives no rows; further columns are ignored.
    """
    tiers = sorted(tiers)
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")
    ddl = PIECE_SCHEMA + (", ids binary" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, schema = token_ids(tokenizer), arrow_schema(ddl)
        first = TaskContext.get().partitionId() << SEQUENCES_PER_PARTITION_BITS
        held: dict[int, tuple[int | None, bytes]] = {}  # document key -> id and token bytes
        in_tier = dict.fromkeys([1 << i for i in range(tiers[-1].bit_length())], 0)
        parts: list[Part] = []
        sequences = keys = tokens = 0

        def rows(windows):
            nonlocal sequences
            out = [[] for _ in schema]
            for tier, window in windows:
                offset, step = 0, first + (tier << 24) + in_tier[tier] * tier // step_tokens
                in_tier[tier] += 1
                for length, key, start in window:
                    doc_id, ids = held[key]
                    piece = ids[4 * start:4 * (start + length)]
                    values = [doc_id, start, length, zlib.crc32(piece), len(ids) // 4, first + sequences, offset, tier, step]
                    for column, value in zip(out, [*values, piece]):
                        column.append(value)
                    offset += length
                sequences += 1
            return batch_of(schema, out)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), strings(batch)):
                ids = encode(text) + END
                held[keys] = (doc_id, ids)
                parts.append((len(ids) // 4, keys, 0))
                keys, tokens = keys + 1, tokens + len(ids) // 4
                if tokens >= BLOCK_TOKENS:
                    windows, parts = pack_block(parts, tiers)
                    yield rows(windows)
                    held = {key: held[key] for _, key, _ in parts}
                    tokens = sum(p[0] for p in parts)
        windows, parts = pack_block(parts, tiers)
        yield rows(windows + pack_tail(parts, tiers[-1]))

    return map_batches(identified(docs, id_col, text_col), run, ddl)
