"""Toxic passages by maximum-scoring segment search.

Every token has a log-odds of toxic against clean text, smoothed by Dirichlet
priors: the prior of a word is the odds of its first five letters, theirs that
of the first three. Words and beginnings are counted in hashed tables of fixed
size. A linear scan finds all maximal-scoring segments of a text (Ruzzo and
Tompa); their scores are turned into expected numbers of chance segments by the
extreme-value law of Karlin and Altschul, and the evidence of all significant
segments together into a probability by a logistic fit on labelled rows that
the counts have not seen.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import arrow_schema, batch_of, byte_strings, identified, map_batches
from tagloom.llm.tokens import Generations

# At most so many labelled rows of each class are learned from; the counts and the calibration share them.
TRAIN_ROWS = 20_000
SLOTS = 1 << 20
PRIOR = 10.0
DRIFT = 1.0  # taken from every token's log-odds, so that ordinary text scores below zero
EXPECTED = 0.05  # a segment is significant if so many as good are expected by chance in its text
BEGINNING, START = 5, 3

_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

SCHEMA = "doc_id long, held_out boolean, score double, predicted int, n_tokens long, n_segments long, segments string"


def tokens_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def features(word: bytes) -> tuple[int, int, int]:
    """Slots of the word, of its first five and of its first three letters, each in a table of its own."""
    letters = word.decode("utf-8", "replace")
    return (zlib.crc32(word) % SLOTS, SLOTS + zlib.crc32(letters[:BEGINNING].encode()) % SLOTS,
            2 * SLOTS + zlib.crc32(letters[:START].encode()) % SLOTS)


def segments_of(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(begin, end, score)`` of a sequence, in one pass over its positive runs."""
    above = np.flatnonzero(scores > 0)
    if not len(above):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple[int, int, float, float]] = []  # begin, end, sum before, sum after
    for i in above.tolist():
        begin, left, right = i, total[i], total[i + 1]
        # Join with earlier segments while one begins lower and ends lower than this one.
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j -= 1
            if j < 0 or stack[j][3] >= right:
                stack.append((begin, i + 1, left, right))
                break
            begin, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [(b, e, float(r - l)) for b, e, l, r in stack]


@dataclass
class Toxicity:
    """Counts by slot, the extreme-value law of clean text and the logistic calibration."""

    counts: np.ndarray  # tokens of toxic and of clean documents by slot, each once per document
    words: tuple[float, float]  # both in all
    rate: float = 1.0  # lambda
    scale: float = 1.0  # K
    slope: float = 1.0
    level: float = 0.0
    _cache: Generations | None = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_cache": None}

    @property
    def known(self) -> bool:
        return min(self.words) > 0

    def token(self, word: bytes) -> float:
        """Log-odds less the drift; each level is smoothed by pseudo-counts at the odds of the level above."""
        share, odds = self.words[0] / self.words[1], 1.0
        for slot in reversed(features(word)):
            toxic, clean = self.counts[slot]
            odds = (toxic + PRIOR * odds * share) / (clean + PRIOR) / share
        return math.log(odds) - DRIFT

    def scores(self, text: bytes) -> np.ndarray:
        if self._cache is None:
            self._cache = Generations(self.token, 400_000)
        words = tokens_of(text)
        return np.fromiter(map(self._cache.__getitem__, words), np.float64, len(words))

    def significant(self, n: int, segments) -> list[tuple[int, int, float]]:
        """Segments with few as good by chance in a clean text of ``n`` tokens, each with that expected number."""
        rated = [(b, e, self.scale * n * math.exp(-min(self.rate * s, 500.0))) for b, e, s in segments]
        return [x for x in rated if x[2] <= EXPECTED]

    def evidence(self, n: int, scores) -> float:
        """Segment scores in units of the law, summed over the significant ones; the best one alone if there is none."""
        chance = math.log(max(self.scale * max(n, 1), 1e-9))
        units = sorted((self.rate * s - chance for s in scores), reverse=True) or [-chance]
        good = [u for u in units if u >= -math.log(EXPECTED)]
        return max(-50.0, min(50.0, sum(good) if good else units[0]))

    def probability(self, evidence: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, self.slope * evidence + self.level))))

    def judge(self, text: bytes) -> tuple[float, int, list[tuple[int, int, float]]]:
        """Probability of being toxic, the number of tokens, and the significant segments."""
        if not self.known:
            return 0.0, len(tokens_of(text)), []
        scores = self.scores(text)
        found = segments_of(scores)
        return (self.probability(self.evidence(len(scores), [s for _, _, s in found])), len(scores),
                self.significant(len(scores), found))


def karlin_rate(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of the mean of ``exp(rate * score)`` = 1 under the weights."""
    if not weights.sum() or not (scores[weights > 0] > 0).any() or (scores * weights).sum() >= 0:
        return 1.0
    share, low, high = weights / weights.sum(), 1e-6, 1.0
    mean = lambda r: float((share * np.exp(np.minimum(r * scores, 600.0))).sum())
    while mean(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if mean(mid) < 1 else (low, mid)
    return low


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and level of a logistic curve, lightly regularised, by Newton steps; classes weigh the same."""
    if len(x) == 0 or y.min() == y.max():
        return 1.0, 0.0
    mean, spread = x.mean(), x.std() + 1e-9
    design = np.stack([(x - mean) / spread, np.ones_like(x)], 1)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (weight * (p - y)) / len(x) + 1e-4 * w
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design / len(x) + 1e-4 * np.eye(2)
        w -= np.linalg.solve(hessian, gradient)
    return float(w[0] / spread), float(w[1] - w[0] * mean / spread)


def held_out(column: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``(text, toxic, part)`` of at most ``rows`` labelled rows of each class; part 4 is for the calibration."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = None
    for toxic in (0, 1):
        part = known.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 2 * rows ids, so they can be sent to every task.
    return (identified(docs).join(F.broadcast(chosen), "doc_id")
            .select("text", "toxic", (F.crc32(F.col("doc_id").cast("string")) % 5).cast("int").alias("part")))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema("slot long, toxic long, clean long")
    toxic, clean = np.zeros(3 * SLOTS, np.int64), np.zeros(3 * SLOTS, np.int64)
    slots = Generations(features, 500_000)
    for batch in batches:
        for text, label in zip(byte_strings(batch), batch.column("toxic").to_pylist()):
            counts = toxic if label else clean
            # Once per document: a word repeated over and over in one document says no more about its class.
            for slot, n in Counter(slot for word in set(tokens_of(text)) for slot in slots[word]).items():
                counts[slot] += n
    used = np.flatnonzero(toxic + clean)
    for i in range(0, len(used), 100_000):
        at = used[i:i + 100_000]
        yield batch_of(schema, [at, toxic[at], clean[at]])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Toxicity:
    """Learn from labelled rows outside the held-out fifth; without rows of both classes every score is 0."""
    train = training_rows(docs, labels, rows)
    # Tables of fixed size: at most 3 * SLOTS counts come to the driver.
    counted = map_batches(train.where("part <> 4"), _count, "slot long, toxic long, clean long").groupBy("slot").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toArrow()
    counts = np.zeros((3 * SLOTS, 2), np.float32)
    slot = counted.column("slot").to_numpy()
    counts[slot, 0], counts[slot, 1] = counted.column("toxic").to_numpy(), counted.column("clean").to_numpy()
    toxic, clean = counts[:SLOTS].astype(np.float64).sum(0)
    model = Toxicity(counts, (float(toxic), float(clean)))
    return _calibrate(train.where("part = 4"), model) if model.known else model


# Token scores of clean text are counted in bins of this width between the two limits.
_BINS = np.arange(-16.0, 16.0, 0.05)


def _calibrate(rows: DataFrame, model: Toxicity) -> Toxicity:
    """The law and the curve from labelled rows that were not counted: at most the bounded sample comes to the driver."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("toxic int, n long, scores binary")
        bins = np.zeros(len(_BINS), np.int64)
        for batch in batches:
            out = [[] for _ in schema]
            for text, label in zip(byte_strings(batch), batch.column("toxic").to_pylist()):
                scores = sent.value.scores(text)
                if not label:
                    at = np.clip(((scores - _BINS[0]) / 0.05).round().astype(np.int64), 0, len(_BINS) - 1)
                    bins += np.bincount(at, minlength=len(_BINS))
                best = sorted((s for _, _, s in segments_of(scores)), reverse=True)
                for column, value in zip(out, [label, len(scores), np.array(best, np.float64).tobytes()]):
                    column.append(value)
            yield batch_of(schema, out)
        yield batch_of(schema, [[2], [0], [bins.astype(np.float64).tobytes()]])

    bins, found = np.zeros(len(_BINS)), []
    for row in map_batches(rows, judged, "toxic int, n long, scores binary").toLocalIterator():
        values = np.frombuffer(row["scores"], np.float64)
        if row["toxic"] == 2:
            bins += values
        else:
            found.append((row["toxic"], row["n"], values))
    sent.unpersist()
    model.rate = karlin_rate(_BINS, bins)
    clean = [(n, s) for toxic, n, s in found if not toxic]
    # Segments of at least one unit are Poisson with mean K * n / e in clean text.
    model.scale = max((sum(int((model.rate * s >= 1).sum()) for _, s in clean) + 0.5) / (sum(n for n, _ in clean) / math.e + 1.0), 1e-6)
    evidence = np.array([model.evidence(n, s.tolist()) for _, n, s in found])
    model.slope, model.level = logistic(evidence, np.array([toxic for toxic, _, _ in found], float))
    return model


def score(docs: DataFrame, model: Toxicity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Judge every whole text; one row per row of ``docs``, with the significant segments as ``begin:end:expected``.

    Null and empty texts have no tokens and get the score of a text without evidence; repeated rows get equal scores; a null
    id is held out; an empty table gives no rows; further columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(SCHEMA)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            held = [zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 0 for i in ids]
            found = [sent.value.judge(text) for text in byte_strings(batch)]
            probability = [p for p, _, _ in found]
            yield batch_of(schema, [ids, held, probability, [int(p >= 0.5) for p in probability], [n for _, n, _ in found],
                                    [len(s) for _, _, s in found], [",".join(f"{b}:{e}:{x:.3g}" for b, e, x in s) for _, _, s in found]])

    return map_batches(identified(docs, id_col, text_col), run, SCHEMA)


def without_toxic(docs: DataFrame, model: Toxicity, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is below one half.

    A null text is judged like an empty one, whole texts of any length as one, repeated rows alike; a null id stays or goes by
    its text; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([sent.value.judge(t)[0] < 0.5 for t in byte_strings(batch, text_col)], pa.bool_()))

    return map_batches(docs, run, docs.schema)
