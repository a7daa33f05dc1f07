"""Benchmark decontamination with Wu-Manber multi-pattern search over words.

The test strings are windows of 13 consecutive words of a benchmark item, or
the whole item if it is shorter. Strings of one length are searched together:
a table gives, for the block of words that ends at the current position, how
far the search may move without passing the end of any string. Where it may not
move, buckets by the last and the first block select the test strings that can
end there, and comparing their words confirms an occurrence.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import arrow_schema, batch_of, byte_strings, identified, map_batches, unused_name
from tagloom.session import materialised

WINDOW = 13
BLOCK_WORDS = 2
# Benchmark text that is searched for at once; a larger benchmark is searched for in several passes.
PASS_BYTES = 16 * 1024 * 1024

SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"

_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words of digits, letters (A-Z in lower case) and characters beyond ASCII."""
    return text.translate(_TO_WORDS).split()


class WuManber:
    """Search for word sequences of one length."""

    def __init__(self, strings: Iterable[tuple[bytes, ...]], length: int):
        self.length, self.block = length, min(BLOCK_WORDS, length)
        self.far = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list[tuple]]] = defaultdict(lambda: defaultdict(list))
        for string in set(strings):
            for end in range(self.block, length + 1):
                block = string[end - self.block:end]
                self.shift[block] = min(self.shift.get(block, self.far), length - end)
            self.buckets[string[-self.block:]][string[:self.block]].append(string)
        self.buckets = {k: dict(v) for k, v in self.buckets.items()}

    def find(self, words: Sequence[bytes]) -> Iterator[tuple[int, tuple]]:
        """Where a string begins, and the string, for every occurrence."""
        shift, far, length, block = self.shift.get, self.far, self.length, self.block
        end, n = length, len(words)
        while end <= n:
            step = shift(tuple(words[end - block:end]), far)
            if step:
                end += step
                continue
            begin = end - length
            bucket = self.buckets.get(tuple(words[end - block:end]), {})
            here = tuple(words[begin:end])
            for string in bucket.get(here[:block], ()):
                if string == here:
                    yield begin, string
            end += 1


class Benchmark:
    """The test strings of some benchmark items, and the items each one belongs to."""

    def __init__(self, items: Iterable[tuple[int | str | None, bytes]], window: int = WINDOW):
        self.items: dict[tuple, set] = defaultdict(set)
        by_length: dict[int, set] = defaultdict(set)
        for item_id, text in items:
            words = words_of(text)
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                string = tuple(words[i:i + size])
                by_length[size].add(string)
                if item_id is not None:
                    self.items[string].add(str(item_id))
        self.searches = [WuManber(strings, size) for size, strings in sorted(by_length.items())]
        self.items = dict(self.items)

    def search(self, words: Sequence[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of words inside an occurrence, and the items that occur."""
        spans, items = [], set()
        for search in self.searches:
            for begin, string in search.find(words):
                spans.append((begin, begin + search.length))
                items |= self.items.get(string, set())
        return spans, items


def covered(spans: Iterable[tuple[int, int]]) -> int:
    total, reached = 0, 0
    for begin, end in sorted(spans):
        total += max(0, end - max(begin, reached))
        reached = max(reached, end)
    return total


def verdict(n_words: int, spans, items) -> tuple[int, int, int, str, bool]:
    n_hit = covered(spans)
    digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return n_words, n_hit, len(items), digest, n_hit > 0 and 20 * n_hit >= n_words


def passes(benchmark: DataFrame, pass_bytes: int = PASS_BYTES) -> list[DataFrame]:
    """The benchmark items (``item_id``, ``text``) in parts of about ``pass_bytes`` at most."""
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = size // pass_bytes + 1
    return [items if n == 1 else items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k) for k in range(n)]


def _load(part: DataFrame, window: int) -> Benchmark:
    return Benchmark(((r["item_id"], r["text"].encode()) for r in part.collect()), window)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, pass_bytes: int = PASS_BYTES,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words of each whole text that lie inside an occurrence of a test string; one row per row of ``docs``.

    Null and empty texts have no words. A benchmark row without words has no test string; one without an id marks words but
    is not counted as an item; rows of one item count once. Repeated document rows give repeated results; empty tables give
    no rows or no hits. Further columns are ignored. A benchmark beyond ``pass_bytes`` is searched for in several passes,
    whose few hits are put together by document.
    """
    rows, parts = identified(docs, id_col, text_col), passes(benchmark, pass_bytes)
    if len(parts) > 1:
        return _in_passes(rows, parts, window)
    tests = docs.sparkSession.sparkContext.broadcast(_load(parts[0], window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(SCHEMA)
        for batch in batches:
            found = [verdict(len(words), *tests.value.search(words)) for words in map(words_of, byte_strings(batch))]
            yield batch_of(schema, [batch.column("doc_id"), *([row[k] for row in found] for k in range(5))])

    return map_batches(rows, run, SCHEMA)


def _in_passes(rows: DataFrame, parts: Sequence[DataFrame], window: int) -> DataFrame:
    spark = rows.sparkSession
    keyed = rows.withColumn("key", F.sha2(F.coalesce("text", F.lit("")), 256))
    found = None
    for part in parts:
        tests = spark.sparkContext.broadcast(_load(part, window))

        def run(batches: Iterator[pa.RecordBatch], tests=tests) -> Iterator[pa.RecordBatch]:
            schema = arrow_schema("doc_id long, key string, spans array<long>, items array<string>")
            for batch in batches:
                out = []
                for doc_id, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), byte_strings(batch)):
                    spans, items = tests.value.search(words_of(text))
                    if spans:
                        out.append((doc_id, key, [x for span in spans for x in span], sorted(items)))
                yield batch_of(schema, [list(c) for c in zip(*out)] or [[]] * 4)

        hits = materialised(map_batches(keyed, run, "doc_id long, key string, spans array<long>, items array<string>"), "hits")
        tests.unpersist()
        found = hits if found is None else found.unionByName(hits)
    # Repeated rows of one document find the same spans, so a set of them loses nothing.
    found = found.groupBy("doc_id", "key").agg(F.flatten(F.collect_set("spans")).alias("spans"),
                                               F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    joined = keyed.join(found.withColumnsRenamed({"doc_id": "_id", "key": "_key"}),
                        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(SCHEMA)
        for batch in batches:
            out = []
            for text, spans, items in zip(byte_strings(batch), batch.column("spans").to_pylist(), batch.column("items").to_pylist()):
                spans = spans or []
                out.append(verdict(len(words_of(text)), zip(spans[::2], spans[1::2]), set(items or [])))
            yield batch_of(schema, [batch.column("doc_id"), *([row[k] for row in out] for k in range(5))])

    return map_batches(joined.select("doc_id", "text", "spans", "items"), merge, SCHEMA)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, pass_bytes: int = PASS_BYTES,
                  text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that no part of the benchmark contaminates.

    With several passes each one removes what its part contaminates by itself, after the hits of all parts were put together.
    Null and empty texts have no words and stay, repeated rows stay or go together, an empty table gives no rows, an empty
    benchmark removes nothing; columns may have any names.
    """
    parts = passes(benchmark, pass_bytes)
    if len(parts) > 1:
        return _without(docs, benchmark, window, pass_bytes, text_col)
    tests = docs.sparkSession.sparkContext.broadcast(_load(parts[0], window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [not verdict(len(words), *tests.value.search(words))[-1] for words in map(words_of, byte_strings(batch, text_col))]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return map_batches(docs, run, docs.schema)


def _without(docs, benchmark, window, pass_bytes, text_col):
    """Texts are judged by their digest, as the verdict depends on the text alone."""
    digest = F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256)
    texts = docs.select(F.lit(0).alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    keyed = texts.groupBy(F.sha2(F.coalesce("text", F.lit("")), 256).alias("key")).agg(F.first("text").alias("text"))
    keyed = materialised(keyed.select(F.monotonically_increasing_id().alias("doc_id"), "key", "text"), "texts")
    bad = contamination(keyed, benchmark, window, pass_bytes).where("contaminated").join(keyed, "doc_id").select("key")
    own = unused_name(docs, "_digest")
    return docs.join(bad.select(F.col("key").alias(own)), digest == F.col(own), "left_anti")
