"""Word2Vec over a vocabulary of any size: skip-gram with hierarchical softmax, the words and their vectors in shards.

Nothing on the driver grows with the vocabulary: the Huffman tree is kept as runs of nodes of one weight, of which
there are a few for each different word count, and a task climbs it for the words of its own part only.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.operators.ordering import number_rows
from tagloom.session import materialised, spread

# Words of a training part: what one task holds. Larger corpora are trained in more parts than asked for.
PART_WORDS = 4_000_000
# Words of a stored piece of a part.
PIECE_WORDS = 250_000
# A part is trained in about so many blocks, of so many words at least and at most.
BLOCKS = 1000
BLOCK_WORDS = (64, 4096)
# A vector that more pairs of a block pull at moves by so many times the mean pull.
MOST_PULLS = 64
# Scores beyond it are left alone, and the learning rate falls to this share, as in Spark's Word2Vec.
MAX_SCORE = 6.0
LEAST_RATE = 1e-4

PIECES = "part int, piece int, docs array<long>, lengths array<int>, places binary, words array<long>, counts array<int>"
TRAINED = "part int, place int, word long, moved boolean, vector array<float>"
MEANS = "doc long, mean array<double>"


class HuffmanRuns:
    """The Huffman tree over leaves ``0..leaves - 1`` of rising weight; inner nodes follow in the order they are made.

    Nodes of one weight are paired in one go, so a run holds them all: child ``start + i`` has the parent
    ``parent + (i + first) // 2`` and the code ``(i + first) % 2``. Of a leaf and an inner node of one weight the inner
    node is taken first, as Spark does.
    """

    def __init__(self, classes: Iterable[tuple[int, int]]):
        """``classes``: ``(weight, leaves of that weight)``, by rising weight."""
        leaves, inner, runs, at = deque(), deque(), [], 0
        for weight, number in classes:
            leaves.append([weight, at, number])
            at += number
        self.leaves, made, left = at, at, at

        def lightest() -> deque:
            return leaves if leaves and (not inner or leaves[0][0] < inner[0][0]) else inner

        def make(weight: int, number: int) -> None:
            if inner and inner[-1][0] == weight:
                inner[-1][2] += number
            else:
                inner.append([weight, made, number])

        def take(queue: deque, number: int, first: int) -> int:
            run = queue[0]
            runs.append((run[1], made, first))
            run[1] += number
            run[2] -= number
            if not run[2]:
                queue.popleft()
            return run[0]

        while left > 1:
            queue = lightest()
            pairs = queue[0][2] // 2
            if pairs:
                weight = 2 * take(queue, 2 * pairs, 0)
            else:
                pairs = 1
                weight = take(queue, 1, 0)
                weight += take(lightest(), 1, 1)
            make(weight, pairs)
            made += pairs
            left -= pairs
        table = np.array(sorted(runs), np.int64).reshape(-1, 3)
        self.start, self.parent, self.first = table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()

    def climb(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parent and code of each node, none of which may be the root."""
        run = np.searchsorted(self.start, nodes, "right") - 1
        place = nodes - self.start[run] + self.first[run]
        return self.parent[run] + place // 2, place % 2

    def paths(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """``(first, node, code, nodes)``: leaf i has ``node[first[i]:first[i + 1]]`` above it, numbered ``0..nodes - 1``."""
        root, at, steps = 2 * self.leaves - 2, leaves.astype(np.int64), []
        active = np.arange(len(leaves))
        while self.leaves > 1 and len(active):
            at, code = self.climb(at)
            steps.append((active, at, code.astype(np.int8)))
            below = at != root
            active, at = active[below], at[below]
        lengths = np.zeros(len(leaves), np.int64)
        for active, _, _ in steps:
            lengths[active] += 1
        first = np.concatenate([[0], np.cumsum(lengths)])
        met = np.unique(np.concatenate([np.unique(at) for _, at, _ in steps])) if steps else np.empty(0, np.int64)
        node, codes = np.empty(first[-1], np.int32), np.empty(first[-1], np.int8)
        for k, (active, at, code) in enumerate(steps):
            node[first[active] + k] = np.searchsorted(met, at)
            codes[first[active] + k] = code
        return first, node, codes, len(met)


def first_vectors(words: np.ndarray, size: int, seed: int) -> np.ndarray:
    """``(size, words)`` start values in ``[-0.5, 0.5) / size``, a function of word and seed (SplitMix64)."""
    steps = np.arange(1, size + 1, dtype=np.uint64)[:, None] + np.uint64(seed % 2**32) * np.uint64(size)
    x = words.view(np.uint64)[None, :] + steps * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (((x ^ (x >> np.uint64(31))) >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24) - np.float32(0.5)) / np.float32(size)


def train(words: np.ndarray, sentences: np.ndarray, vectors: np.ndarray, paths: tuple, window: int, rate: float, seed: int) -> None:
    """Skip-gram over one part, ``vectors`` in place.

    ``words`` are columns of ``vectors``, ``sentences`` the sentence of each. The pairs of a block of words see the
    vectors as they were before the block; a vector pulled at by more than ``MOST_PULLS`` of them moves by so many
    times their mean pull.
    """
    first, node, code, nodes = paths
    size, length = len(vectors), np.diff(first)
    inner = np.zeros((size, nodes), np.float32)
    pulls, inner_pulls = np.zeros(vectors.shape[1], np.float32), np.zeros(nodes, np.float32)
    block = min(max(len(words) // BLOCKS, BLOCK_WORDS[0]), BLOCK_WORDS[1])
    random = np.random.default_rng(seed)
    edge = np.zeros(window, np.int64)
    near, owner = np.concatenate([edge, words, edge]), np.concatenate([edge - 1, sentences, edge - 1])
    offsets = np.array([o for o in range(-window, window + 1) if o])[:, None]

    def move(table: np.ndarray, at: np.ndarray, pull: list[np.ndarray], share: np.ndarray) -> None:
        for row, values in zip(table, pull):
            np.add.at(row, at, (values * share).ravel())

    for begin in range(0, len(words), block):
        centre = words[begin:begin + block]
        # By falling code length, so that the words that have a k-th node are the first ones.
        order = np.argsort(-length[centre], kind="stable")
        centre, place = centre[order], order + (begin + window)
        deep, up = length[centre], first[centre]
        reach = window - random.integers(0, window, len(order))
        step = np.float32(max(rate * (1 - begin / len(words)), rate * LEAST_RATE))
        there = place + offsets
        pairs = ((np.abs(offsets) <= reach) & (owner[there] == owner[place])).astype(np.float32)
        context = near[there]
        x = [row[context] for row in vectors]
        gain = [np.zeros_like(pairs) for _ in x]
        moves, met = [], pairs.sum(axis=0)
        for k in range(deep[0]):
            m = int(np.searchsorted(-deep, -k))
            at = node[up[:m] + k]
            above = [row[at] for row in inner]
            score = x[0][:, :m] * above[0]
            for a, b in zip(x[1:], above[1:]):
                score += a[:, :m] * b
            far = np.abs(score) >= MAX_SCORE if max(score.max(), -score.min()) >= MAX_SCORE else None
            np.negative(score, out=score)
            np.exp(np.minimum(score, np.float32(80), out=score), out=score)
            score += 1
            # 1 - code - sigmoid
            pull = np.subtract((1 - code[up[:m] + k]).astype(np.float32), np.reciprocal(score, out=score), out=score)
            pull *= pairs[:, :m]
            if far is not None:
                pull[far] = 0
            for g, b in zip(gain, above):
                g[:, :m] += pull * b
            moves.append((at, [np.einsum("op,op->p", pull, a[:, :m]) for a in x]))
            np.add.at(inner_pulls, at, met[:m])
        for at, pull in moves:
            share = step * np.minimum(1, MOST_PULLS / np.maximum(inner_pulls[at], 1)).astype(np.float32)
            move(inner, at, pull, share)
        for at, _ in moves:
            inner_pulls[at] = 0
        flat = context.ravel()
        np.add.at(pulls, flat, pairs.ravel())
        move(vectors, flat, gain, step * np.minimum(1, MOST_PULLS / np.maximum(pulls[context], 1)).astype(np.float32))
        pulls[flat] = 0


def word_hashes(tokens: Column) -> Column:
    """The words of a document as 64-bit hashes, which stand for them from here on."""
    return F.transform(tokens, lambda word: F.xxhash64(word))


def document_means(df: DataFrame, tokens_column: str, size: int, min_count: int, seed: int, partitions: int,
                   sentence_length: int, window: int = 5, rate: float = 0.025) -> DataFrame:
    """``(doc, mean)`` for each different document with words; ``doc`` is ``xxhash64(word_hashes(tokens))``.

    The documents are dealt to training parts by place and stored there with the words of the part. Each part is
    trained on its own, then each word takes the mean of the parts that moved it, as in Spark's Word2Vec.
    """
    words = df.select(word_hashes(F.col(tokens_column)).alias("words"))
    total = df.agg(F.sum(F.greatest(F.size(tokens_column), F.lit(0)))).first()[0] or 0
    parts = max(partitions, -(-total // PART_WORDS))
    dealt = spread(words).select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int").alias("part"),
                                 F.xxhash64("words").alias("doc"), "words")
    pieces = materialised(dealt.groupBy("part").applyInArrow(_pack, PIECES), "parts", "zstd", last=True)
    texts = pieces.where(F.size("docs") > 0).select("part", "piece", "docs", "lengths", "places")

    own = pieces.select("part", "piece", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")).select(
        F.col("part").alias("of"), (F.col("piece") * PIECE_WORDS + F.col("at")).alias("place"), F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    totals = materialised(own.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count), "words", last=True)
    # A row for each different count: about the root of the number of words at most.
    tree = HuffmanRuns([(r["n"], r["count"]) for r in totals.groupBy("n").count().orderBy("n").collect()])
    leaves = number_rows(totals, ["n", "word"], "leaf").select("word", F.col("leaf") - 1)
    # Spark takes the exploded words for as few as the pieces, so it is told not to broadcast them.
    own = own.select("of", "place", "word").join(leaves.toDF("word", "leaf").hint("merge"), "word")

    fitted = (texts.drop("docs").groupBy("part").cogroup(own.groupBy("of"))
              .applyInArrow(_fit(tree, size, seed, sentence_length, window, rate), TRAINED))
    trained = materialised(fitted, "trained", last=True)
    vector = F.col("vector")
    mean = F.array(*[F.coalesce(F.avg(F.when(F.col("moved"), vector[i])).over(W.partitionBy("word")), vector[i])
                     for i in range(size)])
    given = materialised(trained.select("part", "place", mean.cast("array<float>").alias("vector")), "vectors", last=True)
    means = texts.groupBy("part").cogroup(given.groupBy("part")).applyInArrow(_means(size), MEANS)
    return materialised(means.groupBy("doc").agg(F.first("mean").alias("mean")), "means", last=True)


def _ints(column: pa.ChunkedArray, flat: bool = False) -> np.ndarray:
    """A whole column, or the items of its lists."""
    return (column.combine_chunks().flatten() if flat else column.combine_chunks()).to_numpy(zero_copy_only=False)


def _lists(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values))


def _planes(values: np.ndarray) -> bytes:
    """Small numbers, byte by byte of all, so that the high bytes take next to nothing."""
    return pa.compress(np.ascontiguousarray(values.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)


def _numbers(planes: bytes, number: int) -> np.ndarray:
    flat = np.frombuffer(pa.decompress(planes, 4 * int(number), codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(4, -1).T).view("<i4").ravel()


def _pack(key: tuple, table: pa.Table) -> pa.Table:
    """The documents of a part in pieces, in the order of their hashes, words as places in the part's list by falling count."""
    table = table.filter(pc.greater(pc.list_value_length(table["words"]), 0)).sort_by("doc")  # not those without words, or null
    if not len(table):
        return pa.table({c.split()[0]: [] for c in PIECES.split(", ")})
    docs, lengths = _ints(table["doc"]), _ints(pc.list_value_length(table["words"]))
    words, places, counts = np.unique(_ints(table["words"], flat=True), return_inverse=True, return_counts=True)
    places = places.ravel()
    order = np.argsort(-counts, kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    # A document goes to the piece its first word falls into.
    number = max(-(-len(words) // PIECE_WORDS), ends[-2] // PIECE_WORDS + 1)
    by_doc = np.searchsorted(ends[:-1], np.arange(number + 1) * PIECE_WORDS)
    by_word = np.minimum(np.arange(number + 1) * PIECE_WORDS, len(words))
    columns = [np.full(number, table["part"][0].as_py(), np.int32), np.arange(number, dtype=np.int32),
               _lists(docs, by_doc), _lists(lengths.astype(np.int32), by_doc), pa.array([_planes(place[places[i:j]]) for i, j in zip(ends[by_doc], ends[by_doc[1:]])]),
               _lists(words[order], by_word), _lists(counts[order].astype(np.int32), by_word)]
    return pa.Table.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns],
                                names=[c.split()[0] for c in PIECES.split(", ")])


def _fit(tree: HuffmanRuns, size: int, seed: int, sentence_length: int, window: int, rate: float) -> Callable:
    def fit(key: tuple, texts: pa.Table, own: pa.Table) -> pa.Table:
        part, texts, own = key[0].as_py(), texts.sort_by("piece"), own.sort_by("place")
        kept, words = _ints(own["place"]), _ints(own["word"])
        first = first_vectors(words, size, seed)
        vectors = first.copy()
        lengths = _ints(texts["lengths"], flat=True)
        places = np.concatenate([_numbers(p.as_py(), sum(n.as_py())) for p, n in zip(texts["places"], texts["lengths"])])
        column = np.full(max(places.max(initial=-1), kept.max(initial=-1)) + 1, -1, np.int32)
        column[kept] = np.arange(len(kept), dtype=np.int32)
        text = column[places]
        del places
        if len(text) and text.min() < 0:  # rare words are left out, and their neighbours move together
            docs = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)[text >= 0]
            lengths, text = np.bincount(docs, minlength=len(lengths)), text[text >= 0]
            del docs
        begins = np.cumsum(lengths) - lengths
        begin = np.zeros(len(text), bool)
        for at, n in zip(begins.tolist(), lengths.tolist()):
            begin[at:at + n:sentence_length] = True
        sentences = np.cumsum(begin, dtype=np.int32)
        del begin
        train(text, sentences, vectors, tree.paths(_ints(own["leaf"])), window, rate, seed * 1_000_003 + part)
        items = pa.ListArray.from_arrays(pa.array(np.arange(0, vectors.size + 1, size, dtype=np.int32)), pa.array(vectors.T.ravel()))
        return pa.table({"part": pa.array(np.full(len(words), part, np.int32)), "place": own["place"], "word": own["word"],
                         "moved": pa.array((vectors != first).any(axis=0)), "vector": items})
    return fit


def _means(size: int) -> Callable:
    def means(key: tuple, texts: pa.Table, given: pa.Table) -> pa.Table:
        places, found = _ints(given["place"]), []
        # Words that are left out count as zero.
        vectors = np.zeros((places.max(initial=-1) + 2, size))
        vectors[places] = _ints(given["vector"], flat=True).reshape(-1, size)
        for batch in texts.to_batches():
            for i in range(len(batch)):
                docs, lengths = (batch[c][i].values.to_numpy() for c in ("docs", "lengths"))
                words = _numbers(batch["places"][i].as_py(), lengths.sum())
                sums = np.add.reduceat(vectors[np.minimum(words, len(vectors) - 1)], np.cumsum(lengths) - lengths, axis=0) / lengths[:, None]
                cuts = np.arange(0, sums.size + 1, size, dtype=np.int32)
                found.append(pa.table({"doc": pa.array(docs), "mean": pa.ListArray.from_arrays(pa.array(cuts), pa.array(sums.ravel()))}))
        return pa.concat_tables(found) if found else pa.table({"doc": pa.array([], pa.int64()), "mean": pa.array([], pa.list_(pa.float64()))})
    return means
