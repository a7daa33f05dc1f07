"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions, each with a context tree of its own over the
bytes before it. Every tree node estimates its decision by the Krichevsky-
Trofimov rule and mixes that with what its children say, by how well either
would have coded the training texts. The tree is a table: one level is the
counts of a context length, grouped to the next shorter one on the way up, and
the mixture is carried down from the root with one join a level. No group has
more than 256 rows, and no part of the model is sent to all tasks.

Texts are dealt into chunks by a hash. A chunk first lists its distinct words and
contexts once, with their training counts; the corpus' answers for these come
back to the chunk, where its texts are scored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import arrow_schema, batch_of, identified, map_batches
from tagloom.session import materialised

DEPTH = 4  # bytes of the longest context
CHUNK_BYTES = 8_000_000  # text of a chunk, about
SLICE_BYTES = 1_000_000  # text whose contexts are sorted at once
EDGE = 0xFF  # stands before and behind a text; never a byte of UTF-8
END = b""  # the end token among the words

ITEMS = "chunk long, gram long, word binary, n_train long"
ANSWERS = "chunk long, gram long, word binary, log_p double, n long"
LEVEL = "key long, n long, kt binary, beta binary, " + ", ".join(f"w{i} double" for i in range(8))
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
          "n_bytes long, bits_per_byte double")


def is_held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def lower(text: bytes) -> bytes:
    return text.lower()  # of bytes: A-Z only


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive numbers, by Stirling's series after a shift of eight."""
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - shift


def log_estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov probability of a sequence of ``a`` zeros and ``b`` ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - math.log(math.pi)


def grams(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the context and the byte at every place of the texts and at their ends, and where each text's begin."""
    edge = bytes([EDGE])
    stream = np.frombuffer(b"".join(x for t in texts for x in (edge * DEPTH, t, edge)), np.uint8)
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    windows = len(stream) - DEPTH
    code = np.zeros(windows, np.int64)
    for i in range(DEPTH + 1):
        code = (code << 8) | stream[i:windows + i]
    valid = np.ones(windows + DEPTH, bool)
    behind = np.cumsum(lengths + DEPTH) - DEPTH
    valid[(behind[:, None] + np.arange(DEPTH)).ravel()] = False
    return code[valid[:windows]], np.cumsum(lengths) - lengths


def slices(texts: Sequence[bytes], size: int = SLICE_BYTES) -> Iterator[list[int]]:
    """Numbers of texts, in runs of about ``size`` bytes."""
    run, held = [], 0
    for i, t in enumerate(texts):
        run.append(i)
        held += len(t)
        if held >= size:
            yield run
            run, held = [], 0
    if run:
        yield run


def _merged(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes, counts = (np.concatenate(c) for c in zip(*found))
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(counts, first)


def _table_bytes(table: pa.Table) -> tuple[list, list[bytes]]:
    return table.column("doc_id").to_pylist(), [lower(t or b"") for t in table.column("text").cast(pa.binary()).to_pylist()]


def _list_items(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The distinct words and grams of a chunk, each with how often it is in training texts."""
    ids, texts = _table_bytes(table)
    train = [not is_held_out(i) for i in ids]
    found, words = [], Counter()
    for run in slices(texts):
        for wanted in (True, False):
            part = [texts[i] for i in run if train[i] == wanted]
            if not part:
                continue
            codes, counts = np.unique(grams(part)[0], return_counts=True)
            found.append((codes, counts if wanted else np.zeros_like(counts)))
            if len(found) > 16:
                found = [_merged(found)]
            for text in part:
                tokens = text.split()
                if wanted:
                    words.update(tokens)
                else:
                    words.update(dict.fromkeys(tokens, 0))
    words[END] = sum(train)
    codes, counts = _merged(found)
    none, schema = len(words), arrow_schema(ITEMS)
    chunk = key[0].as_py()
    pa.default_memory_pool().release_unused()  # what earlier chunks took
    columns = [pa.array(np.full(len(codes) + none, chunk)), pa.concat_arrays([pa.array(codes), pa.nulls(none, pa.int64())]),
               pa.concat_arrays([pa.nulls(len(codes), pa.binary()), pa.array(list(words), pa.binary())]),
               pa.concat_arrays([pa.array(counts.astype(np.int64)), pa.array(list(words.values()), pa.int64())])]
    return pa.Table.from_arrays(columns, schema=schema)


def level_up(keys: np.ndarray, n: np.ndarray, below: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One level of the trees, from rows in the order of ``keys`` (context and byte) that hold whole contexts.

    ``n`` are training counts and ``below`` the children's logarithms, a column for each of the eight decisions, None at the
    longest context. Returns for each row and decision the estimate for the row's bit, the share of this node against its
    children, and the node's weighted logarithm, which stands in the first row of the node only.
    """
    rows = len(keys)
    kt, beta, weighted = (np.zeros((rows, 8)) for _ in range(3))
    for i in range(8):
        node = keys >> (8 - i)
        first = np.concatenate([[True], node[1:] != node[:-1]])
        start, number = np.flatnonzero(first), np.cumsum(first) - 1
        bit = (keys >> (7 - i)) & 1
        ones = np.add.reduceat(n * bit, start).astype(float)
        zeros = np.add.reduceat(n, start) - ones
        estimate = log_estimate(zeros, ones)
        here = np.where(bit == 1, ones[number], zeros[number])
        kt[:, i] = (here + 0.5) / (zeros + ones + 1.0)[number]
        if below is None:
            share, total = np.ones(len(start)), estimate
        else:
            children = np.add.reduceat(below[:, i], start)
            share = 1.0 / (1.0 + np.exp(np.clip(children - estimate, -700, 700)))
            total = np.logaddexp(estimate, children) - math.log(2)
        beta[:, i] = share[number]
        weighted[start, i] = total
    return kt, beta, weighted


def _level(deepest: bool):
    columns = [f"w{i}" for i in range(8)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(LEVEL)
        held: list[np.ndarray] | None = None

        def rows(part):
            keys, n, *below = part
            kt, beta, weighted = level_up(keys, n, None if deepest else np.stack(below, 1))
            as_bytes = lambda m: [r.tobytes() for r in m]
            return batch_of(schema, [keys, n, as_bytes(kt), as_bytes(beta), *(weighted[:, i].copy() for i in range(8))])

        for batch in batches:
            part = [batch.column(c).to_numpy() for c in ("key", "n", *([] if deepest else columns))]
            if held is not None:
                part = [np.concatenate(pair) for pair in zip(held, part)]
            if not len(part[0]):
                continue
            # The last context may go on in the next batch.
            cut = int(np.searchsorted(part[0], part[0][-1] >> 8 << 8))
            held = [c[cut:] for c in part]
            if cut:
                yield rows([c[:cut] for c in part])
        if held is not None and len(held[0]):
            yield rows(held)

    return run


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Carry the mixture one level down: what is settled, and the weight that is left to longer contexts."""
    schema = arrow_schema("key long, settled binary, left binary")
    for batch in batches:
        kt, beta, settled, left = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.float64).reshape(-1, 8)
                                   for c in ("kt", "beta", "settled", "left"))
        now, rest = settled + left * beta * kt, left * (1 - beta)
        yield batch_of(schema, [batch.column("key"), [r.tobytes() for r in now], [r.tobytes() for r in rest]])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema("key long, log_p double")
    for batch in batches:
        settled = np.frombuffer(b"".join(batch.column("settled").to_pylist()), np.float64).reshape(-1, 8)
        yield batch_of(schema, [batch.column("key"), np.log10(settled).sum(1)])


def probabilities(counts: DataFrame) -> DataFrame:
    """``(key, log_p)``: the decimal logarithm of a byte's probability behind its context, for every gram in ``counts``.

    ``counts`` has distinct grams (``key``) with their training counts (``n``), 0 for those that are only looked up.
    """
    levels, below = {}, counts
    for depth in range(DEPTH, -1, -1):
        context = F.shiftright("key", 8)
        ordered = below.repartition(context).sortWithinPartitions("key")
        levels[depth] = materialised(map_batches(ordered, _level(depth == DEPTH), LEVEL), f"level-{depth}", "zstd")
        if depth:
            shorter = F.col("key").bitwiseAND((1 << 8 * depth) - 1)
            below = levels[depth].groupBy(shorter.alias("key")).agg(F.sum("n").alias("n"), *(F.sum(f"w{i}").alias(f"w{i}") for i in range(8)))
    zeros, ones = (np.full(8, v).tobytes() for v in (0.0, 1.0))
    state = levels[0].select("key", "kt", "beta", F.lit(zeros).alias("settled"), F.lit(ones).alias("left"))
    state = map_batches(state, _descend, "key long, settled binary, left binary")
    for depth in range(1, DEPTH + 1):
        here = levels[depth].select("key", "kt", "beta", F.col("key").bitwiseAND((1 << 8 * depth) - 1).alias("parent"))
        above = state.withColumnRenamed("key", "_key")
        joined = here.join(above, F.col("parent") == F.col("_key")).select("key", "kt", "beta", "settled", "left")
        state = map_batches(joined, _descend, "key long, settled binary, left binary")
    return map_batches(state, _finish, "key long, log_p double")


def _score_chunk(n_train: int, n_words: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        schema = arrow_schema(SCORES)
        pa.default_memory_pool().release_unused()
        ids, texts = _table_bytes(docs)
        is_gram = answers.column("gram").is_valid()
        gram = answers.filter(is_gram)
        codes = gram.column("gram").to_numpy()
        order = np.argsort(codes)
        codes, log_p = codes[order], gram.column("log_p").to_numpy()[order]
        words = answers.filter(answers.column("word").is_valid())
        counts = dict(zip(words.column("word").to_pylist(), words.column("n").to_pylist()))
        norm, out = n_train + n_words + 1, [None] * len(texts)
        for run_ in slices(texts):
            part = [texts[i] for i in run_]
            code, starts = grams(part)
            sums = np.add.reduceat(log_p[np.searchsorted(codes, code)], starts)
            for i, total in zip(run_, sums.tolist()):
                tokens = texts[i].split()
                tokens.append(END)
                c = np.fromiter(map(counts.__getitem__, tokens), np.int64, len(tokens))
                base = float(np.log10((c + 1) / norm).sum())
                size = len(texts[i])
                out[i] = (ids[i], is_held_out(ids[i]), len(tokens), int((c > 0).sum()), n_train, base, total, size,
                          -total * math.log2(10) / (size + 1))
        return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def scores(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text; one row per row of ``docs``.

    The model learns from the texts whose id is not held out. ``score`` is the decimal logarithm of the text's probability, the
    end included, and ``bits_per_byte`` its code length per byte, the end counted as one; ``base_score`` is that of the smoothed
    word frequencies. A null or empty text is the end alone; a null id belongs to the training texts; repeated rows count as
    often as they occur; an empty table gives no rows; without training texts every decision is even. Further columns are
    ignored.
    """
    rows = identified(docs, id_col, text_col)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(size // chunk_bytes + 1)))
    items = materialised(dealt.groupBy("chunk").applyInArrow(_list_items, ITEMS), "items", "zstd")
    of_words = materialised(items.where("word is not null").groupBy("word").agg(F.sum("n_train").alias("n")), "words")
    n_train, n_words = of_words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    of_grams = items.where("gram is not null").groupBy(F.col("gram").alias("key")).agg(F.sum("n_train").alias("n"))
    log_p = materialised(probabilities(of_grams), "log-p", "zstd")
    words = items.where("word is not null").select("chunk", "word").join(of_words, "word").select(
        "chunk", F.lit(None).cast("long").alias("gram"), "word", F.lit(None).cast("double").alias("log_p"), "n")
    found = items.where("gram is not null").select("chunk", "gram").join(log_p, F.col("gram") == F.col("key")).select(
        "chunk", "gram", F.lit(None).cast("binary").alias("word"), "log_p", F.lit(None).cast("long").alias("n"))
    answers = words.unionByName(found)
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _score_chunk(n_train, n_words), SCORES)
