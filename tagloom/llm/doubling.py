"""Removal of passages that stand in the corpus more than once, found by level-wise doubling.

A window of words is its two halves, which may share a word. Windows of the
shortest level are looked up in the whole corpus; only where both halves are
repeated is a window of the next level, twice as long, a candidate, and so on
up to the wanted length or until no candidate survives.

Texts are dealt into chunks of bounded size. A chunk sends the distinct hashes of
its candidates to buckets of bounded size, packed, and each bucket answers with
one bit for every hash: whether another chunk has it too. So a passage in a third
of all texts is sent once a chunk. The texts are shuffled once; every level reads
that shuffle again and finds its place from the answers so far.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import arrow_schema, batch_of, identified

WINDOW = 35  # words
SHORTEST = 10  # words of the first level at most
CHUNK_BYTES = 8_000_000  # text of a chunk, about
BUCKET_BYTES = 12_000_000  # text whose windows share a bucket, about
PIECE_BYTES = 1_000_000  # text that is split into words at once

# n is the number of hashes in ``data``: packed hashes on the way to a bucket, bits on the way back.
ASKED = "bucket long, chunk long, level int, n long, data binary, answered boolean"
KEPT = "doc_id long, text string, n_words long, n_removed long, removed array<long>"

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_LOW = np.uint64(0xFFFFFFFF)


def lengths(window: int = WINDOW, shortest: int = SHORTEST) -> list[int]:
    """Window lengths of the levels: each at most twice the one before."""
    out = [window]
    while out[0] > max(shortest, 1):
        out.insert(0, (out[0] + 1) // 2)
    return out


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """The text, cut between words."""
    at = 0
    while len(text) - at > size:
        found = _SPACE.search(text, at + size)
        if found is None:
            break
        yield text[at:found.start()]
        at = found.end()
    yield text[at:] if at else text


def word_hashes(text: bytes) -> np.ndarray:
    import xxhash

    parts = [np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)) for words in (p.split() for p in pieces(text))]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def joined(a: np.ndarray, b: np.ndarray, other: bool = False) -> np.ndarray:
    """Hash of windows from the hashes of their halves; ``other`` gives an independent one."""
    k, m = (_MIX[2], _MIX[3]) if other else (_MIX[0], _MIX[1])
    x = (a ^ (a >> np.uint64(29))) * k + (b ^ (b >> np.uint64(32))) * m
    x ^= x >> np.uint64(31)
    x *= _MIX[1] if other else _MIX[2]
    return x ^ (x >> np.uint64(30))


def windows_of(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the windows at all places, those over the end of a text included."""
    if length == 1 or len(words) < length:
        return words if length == 1 else words[:0]
    half = (length + 1) // 2
    h, n = windows_of(words, half), len(words) - length + 1
    return joined(h[:n], h[length - half:length - half + n])


def low_bytes(n: int) -> int:
    """Bytes of each of ``n`` packed hashes that are stored as they are."""
    return 2 if n > 4096 else 3 if n > 64 else 4


def pack_hashes(values: np.ndarray) -> bytes:
    """Sorted distinct 32-bit hashes: low bytes as they are, the rest as a list of gaps in unary."""
    low = low_bytes(len(values))
    if low == 4:
        return values.astype("<u4").tobytes()
    high = (values >> np.uint64(8 * low)).astype(np.int64)
    bits = np.zeros(len(values) + (1 << (32 - 8 * low)), np.uint8)
    bits[high + np.arange(len(values))] = 1
    lows = values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :low]
    return lows.tobytes() + np.packbits(bits).tobytes()


def unpack_hashes(data: bytes, n: int) -> np.ndarray:
    low = low_bytes(n)
    if low == 4:
        return np.frombuffer(data, "<u4").astype(np.uint64)
    lows = np.zeros((n, 4), np.uint8)
    lows[:, :low] = np.frombuffer(data, np.uint8, n * low).reshape(n, low)
    high = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=n * low), count=n + (1 << (32 - 8 * low)))) - np.arange(n)
    return lows.view("<u4").ravel().astype(np.uint64) | (high.astype(np.uint64) << np.uint64(8 * low))


class Level:
    """The candidates of one level in a chunk: places, hashes, and the distinct ones in the order of bucket and hash.

    Below the last level 32 bits tell the hashes of a bucket apart: a wrong match only makes a candidate more. In the last one
    it is 64 bits beside the bucket, which comes from an independent hash.
    """

    def __init__(self, places: np.ndarray, hashes: np.ndarray, others: np.ndarray | None, buckets: int):
        self.places, self.hashes, self.last = places, hashes, others is not None
        if self.last:
            values, first, self.number, self.times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
            bucket = (others[first] % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((values, bucket))
            back = np.empty_like(order)
            back[order] = np.arange(len(order))
            self.values, self.bucket, self.times, self.number = values[order], bucket[order], self.times[order], back[self.number]
        else:
            keys = ((hashes >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (hashes & _LOW)
            keys, self.number, self.times = np.unique(keys, return_inverse=True, return_counts=True)
            self.values, self.bucket = keys & _LOW, (keys >> np.uint64(32)).astype(np.int64)

    def asked(self) -> Iterator[tuple[int, int, bytes]]:
        """Bucket, number of hashes and packed hashes."""
        start = np.flatnonzero(np.concatenate([[True], self.bucket[1:] != self.bucket[:-1]])) if len(self.bucket) else []
        for a, b in zip(start, [*start[1:], len(self.bucket)]):
            values = self.values[a:b]
            yield int(self.bucket[a]), int(b - a), values.astype("<u8").tobytes() if self.last else pack_hashes(values)

    def repeated(self, elsewhere: np.ndarray) -> np.ndarray:
        """Whether the window of each candidate stands in another chunk or twice in this one."""
        if len(elsewhere) != len(self.values):
            raise ValueError("the texts of a chunk changed between two levels")
        return ((self.times > 1) | elsewhere)[self.number]


class Chunk:
    """The texts of a chunk and its levels, as far as the answers reach."""

    def __init__(self, table: pa.Table, answers: pa.Table | None, steps: Sequence[int], buckets: int):
        self.ids = table.column("doc_id").to_pylist()
        self.texts = [t or b"" for t in table.column("text").cast(pa.binary()).to_pylist()]
        hashed = [word_hashes(t) for t in self.texts]
        self.sizes = np.fromiter(map(len, hashed), np.int64, len(hashed))
        words = np.concatenate(hashed or [np.zeros(0, np.uint64)])
        del hashed
        left = np.repeat(np.cumsum(self.sizes), self.sizes) - np.arange(len(words))  # words from here to the end of the text
        bits = self._bits(answers)
        self.level = self._first(words, left, steps, buckets)
        self.number, self.found = 0, np.zeros(0, np.int64)  # of the level that is open; places of repeated windows of the last one
        for k in range(len(bits)):
            alike = self.level.repeated(bits[k])
            places = self.level.places[alike]
            if k + 1 == len(steps):
                self.found, self.level = places, None
                break
            self.level = self._next(places, self.level.hashes[alike], left, steps, k + 1, buckets)
            self.number = k + 1

    @staticmethod
    def _bits(answers: pa.Table | None) -> list[np.ndarray]:
        if answers is None or not answers.num_rows:
            return []
        rows = answers.sort_by([("level", "ascending"), ("bucket", "ascending")])
        bits: dict[int, list[np.ndarray]] = {}
        for level, n, data in zip(rows.column("level").to_pylist(), rows.column("n").to_pylist(), rows.column("data").to_pylist()):
            bits.setdefault(level, []).append(np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool))
        return [np.concatenate(bits[k]) for k in sorted(bits)]

    @staticmethod
    def _level(places, hashes, halves, steps, k, buckets) -> Level:
        return Level(places, hashes, joined(*halves, other=True) if k + 1 == len(steps) else None, buckets)

    def _first(self, words, left, steps, buckets) -> Level:
        places = np.flatnonzero(left >= steps[0])
        hashes = windows_of(words, steps[0])
        hashes = hashes[places] if len(places) else words[:0]
        return self._level(places, hashes, (hashes, hashes), steps, 0, buckets)

    def _next(self, places, hashes, left, steps, k, buckets) -> Level:
        shift = steps[k] - steps[k - 1]
        # Places are in order, so the other half is looked up among them.
        at = np.searchsorted(places, places + shift)
        both = (left[places] >= steps[k]) & (at < len(places))
        both[both] = places[at[both]] == places[both] + shift
        halves = hashes[both], hashes[at[both]]
        return self._level(places[both], joined(*halves), halves, steps, k, buckets)


def _ask(steps: Sequence[int], buckets: int):
    """The questions of a chunk's next level; the answers it stands on come back with those to these."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table | None = None) -> pa.Table:
        pa.default_memory_pool().release_unused()
        number, out = key[0].as_py(), []
        chunk = Chunk(table, answers, steps, buckets)
        if chunk.level is not None:
            out = [(bucket, number, chunk.number, n, data, False) for bucket, n, data in chunk.level.asked()]
        if out and answers is not None:
            out += [(number % buckets, number, r["level"], r["n"], r["data"], True, r["bucket"]) for r in answers.to_pylist()]
        rows = [(*r, r[0])[:7] for r in out]
        schema = arrow_schema(ASKED + ", of long")
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return run


ANSWERS = "chunk long, level int, bucket long, n long, data binary"


def _answer(last: bool):
    return lambda table: _answered(table, last)


def _answered(table: pa.Table, last: bool) -> pa.Table:
    """One bit for every hash that a chunk asked for: whether another chunk asked for it too."""
    open_, schema = table.filter(pc.invert(table.column("answered"))), arrow_schema(ANSWERS)
    done = table.filter(table.column("answered"))
    n, data = open_.column("n").to_pylist(), open_.column("data").to_pylist()
    values = np.concatenate([np.frombuffer(d, "<u8") if last else unpack_hashes(d, c) for c, d in zip(n, data)] or [np.zeros(0, np.uint64)])
    order = np.argsort(values, kind="stable")
    same = values[order][1:] == values[order][:-1]
    alike = np.zeros(len(values), bool)
    alike[order[1:][same]] = True
    alike[order[:-1][same]] = True
    ends = np.cumsum([0, *n])
    bits = [np.packbits(alike[a:b]).tobytes() for a, b in zip(ends, ends[1:])]
    new = pa.Table.from_arrays([open_.column(c) for c in ("chunk", "level", "of", "n")] + [pa.array(bits, pa.binary())], schema=schema)
    old = pa.Table.from_arrays([done.column(c) for c in ("chunk", "level", "of", "n", "data")], schema=schema)
    return pa.concat_tables([new, old])


def runs(places: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Runs of words that the windows at these places cover."""
    if not len(places):
        return []
    first = np.flatnonzero(np.concatenate([[True], places[1:] > places[:-1] + window]))
    last = np.concatenate([first[1:] - 1, [len(places) - 1]])
    return list(zip(places[first].tolist(), (places[last] + window).tolist()))


def without(text: bytes, spans: Sequence[tuple[int, int]]) -> bytes:
    """The words outside the spans, which are in order, joined by one space."""
    out, at, k = [], 0, 0
    for piece in pieces(text):
        words = piece.split()
        keep = np.ones(len(words), bool)
        while k < len(spans) and spans[k][0] < at + len(words):
            keep[max(spans[k][0] - at, 0):spans[k][1] - at] = False
            if spans[k][1] > at + len(words):
                break
            k += 1
        out += words if keep.all() else [w for w, ok in zip(words, keep.tolist()) if ok]
        at += len(words)
    return b" ".join(out)


def _cut(steps: Sequence[int], buckets: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        chunk = Chunk(table, answers, steps, buckets)
        ends = np.cumsum(chunk.sizes)
        of = np.searchsorted(chunk.found, np.concatenate([[0], ends]))
        texts, removed = [], []
        for i, text in enumerate(chunk.texts):
            spans = runs(chunk.found[of[i]:of[i + 1]] - (ends[i] - chunk.sizes[i]), steps[-1])
            texts.append(without(text, spans))
            removed.append([x for span in spans for x in span])
        cut = [sum(r[1::2]) - sum(r[::2]) for r in removed]
        columns = [chunk.ids, pa.array(texts, pa.binary()).cast(pa.string()), chunk.sizes, cut, removed]
        return pa.Table.from_batches([batch_of(arrow_schema(KEPT), columns)])

    return run


def without_repeats(docs: DataFrame, window: int = WINDOW, shortest: int = SHORTEST, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's text without the words of windows that stand anywhere else as well, and the runs removed.

    ``text`` is the kept words joined by one space, ``removed`` the runs of removed words, each its first place and the one
    behind its last. All occurrences go, the first included, and windows are judged on the texts as they came. Null and empty
    texts have no words and give an empty text; a text shorter than the window stays whole; repeated rows repeat each other's
    windows; a null id is kept; an empty table gives no rows; further columns are ignored.
    """
    rows, steps = identified(docs, id_col, text_col), lengths(window, shortest)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = size // bucket_bytes + 1
    # Rows of one id and text are told apart by the part of the table they are in.
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(size // chunk_bytes + 1)))
    ask, asked_schema = _ask(steps, buckets), ASKED + ", of long"
    asked = dealt.groupBy("chunk").applyInArrow(lambda key, table: ask(key, table), asked_schema)
    for k in range(len(steps)):
        answers = asked.groupBy("bucket").applyInArrow(_answer(k + 1 == len(steps)), ANSWERS)
        if k + 1 < len(steps):
            asked = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(lambda key, table, told: ask(key, table, told), asked_schema)
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_cut(steps, buckets), KEPT)


def digests(docs: DataFrame) -> DataFrame:
    """The registered query: counts and a digest of the kept text."""
    found = without_repeats(docs)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = rf"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
  starts AS (SELECT r, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM docs WHERE len(words) >= {WINDOW}),
  windows AS MATERIALIZED (SELECT r, i, md5(array_to_string(words[i:i + {WINDOW - 1}], ' ')) AS h FROM starts),
  twice AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
  gone AS (SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS i FROM windows WHERE h IN (SELECT h FROM twice)),
  cut AS (SELECT r, list(i) AS gone FROM gone GROUP BY r),
  every AS (SELECT r, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM docs),
  kept AS (SELECT r, string_agg(w, ' ' ORDER BY i) AS text FROM every ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(len(c.gone), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN cut c USING (r) LEFT JOIN kept k USING (r)"""
