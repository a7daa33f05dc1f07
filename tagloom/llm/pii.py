"""Personal data with a semi-Markov conditional random field.

Patterns find the plain cases exactly. A field over segments finds more: the
neighbourhood of digits and at-signs is cut into tokens, every span of up to
``MAX_TOKENS`` tokens is a candidate for each kind, features of the whole span
(its shape, digit groups, check digits, the words around it) give it a score,
and dynamic programming chooses boundaries and kinds together. A span of a kind
needs a digit or an at-sign, so text without them is outside by definition and
only islands around them are decoded.

The field is fitted by gradient ascent on the likelihood of island labellings:
islands of a bounded sample of documents, labelled by the patterns, each also
in disguised spellings that the patterns miss.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import arrow_schema, batch_of, identified, map_batches, strings

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 18
MARGIN = 3  # tokens of an island on either side of a digit or at-sign
SLOTS = 1 << 15
TRAIN_DOCS = 600  # documents with a pattern match that the field is fitted on, and as many without one
EPOCHS = 4
BLOCK_ENDS = 512  # tokens of an island whose candidate spans are held at a time
THRESHOLD = 2.0  # a span is added if its score exceeds that of leaving it outside by so much

SCHEMA = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")

# Fixed patterns of the plain cases.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile("[0-9]")

Span = tuple[int, int, int]  # start, number of the kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their at-signs."""
    reached = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > reached and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            reached = domain.end()
            yield start, reached
        at = text.find("@", max(at + 1, reached))


def base_spans(text: str) -> list[Span]:
    """The plain cases, by start and kind."""
    spans = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        spans += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = _digits(m[0]) if m.end() - m.start() >= 12 else ""
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
        if "+" in text:
            spans += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(spans)


def written(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


# The field ------------------------------------------------------------------

_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]")


def islands(text: str) -> Iterator[list[tuple[int, int, str]]]:
    """Runs of tokens near a digit or at-sign, within a line; each token with its place."""
    if "@" not in text and not _DIGIT.search(text):
        return
    begin = 0
    for line in text.split("\n"):
        if "@" in line or _DIGIT.search(line):
            tokens = [(begin + m.start(), begin + m.end(), m[0]) for m in _TOKEN.finditer(line)]
            marks = [i for i, t in enumerate(tokens) if t[2] == "@" or "0" <= t[2][0] <= "9"]
            run = None
            for i in marks:
                # Marks whose spans could touch belong to one island.
                low, high = max(0, i - MARGIN - 4), min(len(tokens), i + MARGIN + 5)
                if run and low <= run[1]:
                    run = (run[0], high)
                else:
                    if run:
                        yield tokens[run[0]:run[1]]
                    run = (low, high)
            if run:
                yield tokens[run[0]:run[1]]
        begin += len(line) + 1


def slot(name: str) -> int:
    return zlib.crc32(name.encode()) % SLOTS


def shape(text: str) -> str:
    """Digits as their number, runs of letters as one letter, runs of spaces as one, the rest as it is."""
    return re.sub(r"[0-9]+", lambda m: f"<{len(m[0])}>", re.sub(r"\s+", "_", re.sub(r"[A-Za-z]+", "a", text)))


def span_features(tokens: Sequence[tuple[int, int, str]], i: int, j: int, text: str, begin: int) -> list[str]:
    """Names of the features of tokens ``i`` to ``j``; ``text`` starts at position ``begin``."""
    span = text[tokens[i][0] - begin:tokens[j - 1][1] - begin]
    digits = _digits(span)
    groups = re.findall("[0-9]+", span)
    form = shape(span)
    before = text[tokens[i][0] - begin - 1:tokens[i][0] - begin] if tokens[i][0] > begin else ""
    after = text[tokens[j - 1][1] - begin:tokens[j - 1][1] - begin + 1]
    names = [f"shape {form[:60]}", f"loose {re.sub('<[0-9]+>', '9', form)[:60]}", f"digits {min(len(digits), 24)}", f"groups {min(len(groups), 8)}",
             f"first {shape(tokens[i][2])[:1]}", f"last {shape(tokens[j - 1][2])[:1]}", f"at {span.count('@')}",
             f"dots {min(span.count('.'), 6)}", f"letters {any(c.isalpha() for c in span)}",
             f"glued {before.isalnum()} {after.isalnum()}", f"spaces {min(span.count(' '), 6)}",
             f"marks {''.join(sorted(set(re.sub('[A-Za-z0-9 ]', '', span))))[:12]}"]
    if len(groups) == 4 and all(len(g) <= 3 and int(g) < 256 for g in groups):
        names.append(f"four bytes {re.sub('[0-9]+', '9', span)[:24]}")
    if 12 <= len(digits) <= 19:
        names.append(f"check {luhn(digits)} {any(c.isalpha() for c in span)}")
    if "@" in span:
        names.append(f"domain {bool(re.search(r'@ ?[A-Za-z0-9-]+( ?[.] ?[A-Za-z0-9-]+)+$', span))} {bool(re.match(r'[A-Za-z0-9._%+-]+ ?@', span))}")
    if i:
        names.append(f"word before {tokens[i - 1][2].lower()[:12]}")
    return names


def outside_features(token: str) -> list[str]:
    kind = "letters" if token.isalpha() else f"digits {min(len(token), 20)}" if token.isdigit() else token
    return [f"out {kind}", "out"]


class Lattice:
    """Candidate spans of an island, with their feature slots; with ``ends`` only those that end in that range of tokens."""

    def __init__(self, tokens, text: str, begin: int, ends: tuple[int, int] | None = None):
        self.n = len(tokens)
        low, high = ends or (1, self.n + 1)
        first = max(0, low - MAX_TOKENS)
        mark = [t[2] == "@" or "0" <= t[2][0] <= "9" for t in tokens[first:high]]
        self.spans: list[tuple[int, int]] = []
        rows: list[list[int]] = []
        for i in range(first, min(self.n, high - 1)):
            # A span begins with a letter, a digit, "+" or "(", and ends with a letter or a digit.
            if not (tokens[i][2][0].isalnum() or tokens[i][2] in "+("):
                continue
            seen = False
            for j in range(i + 1, min(high - 1, i + MAX_TOKENS) + 1):
                seen = seen or mark[j - 1 - first]
                if j >= low and seen and tokens[j - 1][2][0].isascii() and tokens[j - 1][2][0].isalnum():
                    self.spans.append((i, j))
                    rows.append([slot(name) for name in span_features(tokens, i, j, text, begin)])
        width = max(map(len, rows), default=0)
        # Unused places point at a slot whose weight stays 0.
        self.slots = np.full((len(rows), width), SLOTS, np.int32)
        for row, slots in zip(self.slots, rows):
            row[:len(slots)] = slots
        self.outside = [np.array([slot(f) for f in outside_features(t[2])], np.int32) for t in tokens[low - 1:high - 1]]
        # By end of the span, counted from ``low - 1``.
        self.by_end: list[list[int]] = [[] for _ in range(high - low + 1)]
        for k, (_, j) in enumerate(self.spans):
            self.by_end[j - low + 1].append(k)

    def scores(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every span for every kind, and of every token for being outside."""
        outside = np.array([weights[0, s].sum() for s in self.outside])
        if not self.spans:
            return np.zeros((0, len(KINDS))), outside
        return weights[1:, self.slots].sum(2).T, outside

    def gradient(self, weights: np.ndarray, gold: dict[tuple[int, int], int], grad: np.ndarray) -> float:
        """Add the gradient of the log-likelihood of the gold spans; return that likelihood."""
        spans, outside = self.scores(weights)
        n = self.n
        alpha, beta = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        alpha[0] = beta[n] = 0.0
        whole = np.logaddexp.reduce(spans, 1) if len(spans) else np.zeros(0)
        for j in range(1, n + 1):
            ways = [alpha[j - 1] + outside[j - 1], *(alpha[self.spans[k][0]] + whole[k] for k in self.by_end[j])]
            alpha[j] = np.logaddexp.reduce(ways)
        for j in range(n, 0, -1):
            beta[j - 1] = np.logaddexp(beta[j - 1], beta[j] + outside[j - 1])
            for k in self.by_end[j]:
                i = self.spans[k][0]
                beta[i] = np.logaddexp(beta[i], beta[j] + whole[k])
        total, score, taken = alpha[n], 0.0, np.zeros(n, bool)
        for k, (i, j) in enumerate(self.spans):
            share = np.exp(alpha[i] + spans[k] + beta[j] - total)
            kind = gold.get((i, j))
            for y in range(len(KINDS)):
                delta = (y == kind) - share[y]
                if abs(delta) > 1e-4:
                    np.add.at(grad[1 + y], self.slots[k], delta)
            if kind is not None:
                score += spans[k, kind]
                taken[i:j] = True
        for i in range(n):
            delta = (not taken[i]) - np.exp(alpha[i] + outside[i] + beta[i + 1] - total)
            np.add.at(grad[0], self.outside[i], delta)
            score += 0.0 if taken[i] else outside[i]
        grad[:, SLOTS] = 0.0
        return float(score - total)


def best(tokens, text: str, begin: int, weights: np.ndarray, block: int = BLOCK_ENDS) -> list[tuple[int, int, int, float]]:
    """The best segmentation of an island: spans with their kinds, and how far each beats leaving its tokens outside.

    Spans are made and scored for ``block`` ends at a time, so an island of any length holds one block of candidates, and for
    each token a value and the span that ends there in the best segmentation up to it.
    """
    value, back, before = [0.0], [None], [0.0]
    for low in range(1, len(tokens) + 1, block):
        part = Lattice(tokens, text, begin, (low, min(len(tokens) + 1, low + block)))
        # In double precision, so that the length of an island does not blur its sums.
        spans, outside = (scores.astype(float) for scores in part.scores(weights))
        for at, alone in enumerate(outside.tolist()):
            before.append(before[-1] + alone)
            top, how = value[-1] + alone, None
            for k in part.by_end[at + 1]:
                i, kind = part.spans[k][0], int(spans[k].argmax())
                total = value[i] + spans[k, kind]
                if total > top:
                    top, how = total, (i, kind, float(spans[k, kind] - (before[-1] - before[i])))
            value.append(top)
            back.append(how)
    found, j = [], len(tokens)
    while j:
        if back[j] is None:
            j -= 1
            continue
        i, kind, margin = back[j]
        found.append((i, j, kind, margin))
        j = i
    return found[::-1]


def disguises(kind: int, span: str, number: int) -> list[str]:
    """Spellings of a match that the patterns do not find."""
    if kind == 0:
        local, _, domain = span.partition("@")
        return [f"{local} @ {domain}", f"{local}@ {domain}", f"{local}@{domain.replace('.', ' . ')}"][number % 3:][:1]
    if kind == 1:
        return [span.replace(".", " . "), span.replace(".", "[.]"), span.replace(".", ". ")][number % 3:][:1]
    if kind == 2:
        digits = _digits(span)
        parts = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        return [".".join(parts), "/".join(parts), " - ".join(parts), "_".join(parts)][number % 4:][:1]
    digits = _digits(span)
    local = digits[-10:]
    return [f"({local[:3]}) {local[3:6]}-{local[6:]}", f"{local[:3]}-{local[3:6]}-{local[6:]}", f"{local[:3]}.{local[3:6]}.{local[6:]}",
            f"00{digits[:-10] or '1'} {local[:3]} {local[3:6]} {local[6:]}"][number % 4:][:1] if len(digits) >= 10 else []


def examples(texts: Sequence[str]) -> list[tuple[Lattice, dict[tuple[int, int], int]]]:
    """Islands with their gold spans: as they are, and once more with every match in disguise."""
    out = []
    for number, text in enumerate(texts):
        versions = [(text, base_spans(text))]
        plain = [s for i, s in enumerate(versions[0][1]) if all(s[0] >= t[2] for t in versions[0][1][:i])]
        if plain:
            parts, spans, at, length = [], [], 0, 0
            for k, (s, kind, e) in enumerate(plain):
                new = (disguises(kind, text[s:e], number + k) or [text[s:e]])[0]
                parts += [text[at:s], new]
                length += s - at
                spans.append((length, kind, length + len(new)))
                length, at = length + len(new), e
            versions.append(("".join([*parts, text[at:]]), spans))
        for version, spans in versions:
            for tokens in islands(version):
                begin, end = tokens[0][0], tokens[-1][1]
                starts, ends = {t[0]: i for i, t in enumerate(tokens)}, {t[1]: i + 1 for i, t in enumerate(tokens)}
                gold, reached = {}, 0
                for s, kind, e in spans:
                    if s >= max(begin, reached) and e <= end and s in starts and e in ends and ends[e] - starts[s] <= MAX_TOKENS:
                        gold[starts[s], ends[e]] = kind
                        reached = e
                low = max(0, begin - 1)
                out.append((Lattice(tokens, version[low:end + 1], low), gold))
    return out


@dataclass
class Field:
    """Weights of the field by label (outside first, then the kinds) and feature slot."""

    weights: np.ndarray
    threshold: float = THRESHOLD

    def added(self, text: str, base: Sequence[Span]) -> list[Span]:
        """Spans of the best segmentation that overlap no plain one."""
        found: list[Span] = []
        if not self.weights.any():
            return found
        plain = sorted((s, e) for s, _, e in base)
        starts, reached = [s for s, _ in plain], [0, *accumulate((e for _, e in plain), max)]
        for tokens in islands(text):
            low = max(0, tokens[0][0] - 1)
            for i, j, kind, margin in best(tokens, text[low:tokens[-1][1] + 1], low, self.weights):
                start, end = tokens[i][0], tokens[j - 1][1]
                # None of the plain spans that start before the end goes beyond the start.
                if margin >= self.threshold and reached[bisect_left(starts, end)] <= start:
                    found.append((start, kind, end))
        return found


def train(texts: Sequence[str], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-4) -> Field:
    """Fit by adaptive gradient steps, one per island."""
    data = examples(texts)
    weights, squares = np.zeros((1 + len(KINDS), SLOTS + 1)), np.full((1 + len(KINDS), SLOTS + 1), 1e-2)
    grad = np.zeros_like(weights)
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for at in order.permutation(len(data)):
            lattice, gold = data[at]
            used = np.unique(np.concatenate([lattice.slots.ravel(), *lattice.outside]))
            lattice.gradient(weights, gold, grad)
            step = grad[:, used] - decay * weights[:, used]
            squares[:, used] += step ** 2
            weights[:, used] += rate * step / np.sqrt(squares[:, used])
            grad[:, used] = 0.0
    return Field(weights.astype(np.float32))


def fit(docs: DataFrame, rows: int = TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Fit on the lines with digits or at-signs of a bounded sample of documents, taken in the order of a hash."""
    texts = identified(docs, id_col, text_col).where(F.col("text").rlike("[0-9@]"))
    marked = F.col("text").rlike(r"@[A-Za-z0-9-]+\.|[0-9]\.[0-9]+\.[0-9]+\.[0-9]|\+[0-9]|[0-9]{12}")
    rough = texts.select(marked.alias("marked"), F.xxhash64("doc_id", "text").alias("h"),
                         # Only the lines that can hold an island; the sample's size is bounded by these.
                         F.array_join(F.filter(F.split("text", "\n"), lambda line: line.rlike("[0-9@]")), "\n").alias("text"))
    chosen = []
    for wanted in (True, False):
        part = rough.where(F.col("marked") == wanted).where(F.length("text") <= 20_000).orderBy("h", "text").limit(rows)
        chosen += [r["text"] for r in part.select("text").collect()]
    return train(chosen)


def find(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans in every whole text; one row per row of ``docs``.

    The counts and the digest are of the plain cases, ``spans`` has those and what the field adds. Null and empty texts have
    none; repeated rows get equal results; an empty table gives no rows; further columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(SCHEMA)
        for batch in batches:
            out = []
            for text in strings(batch):
                base = base_spans(text)
                added = sent.value.added(text, base)
                counts = [sum(k == kind for _, k, _ in base) for kind in range(len(KINDS))]
                out.append([*counts, hashlib.sha256(written(base).encode()).hexdigest(), written(base + added), len(added)])
            yield batch_of(schema, [batch.column("doc_id"), *([row[k] for row in out] for k in range(7))])

    return map_batches(identified(docs, id_col, text_col), run, SCHEMA)


def redacted(text: str, spans: Sequence[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans are replaced together, named by the first."""
    out, at, open_kind, open_end = [], 0, None, 0
    for start, kind, end in sorted(spans):
        if open_kind is not None and start < open_end:
            open_end = max(open_end, end)
            continue
        if open_kind is not None:
            out.append(f"[{KINDS[open_kind].upper()}]")
            at = open_end
        out.append(text[at:start])
        open_kind, open_end = kind, end
    if open_kind is not None:
        out.append(f"[{KINDS[open_kind].upper()}]")
        at = open_end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, field: Field, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with all columns and rows, personal data replaced in the text and its length brought up to date.

    A null text stays null and an empty one empty, whole texts of any length are searched, repeated rows come out alike; a table
    without the length column keeps its columns; an empty table gives no rows.
    """
    sent, schema = docs.sparkSession.sparkContext.broadcast(field), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, changed = batch.column(text_col).to_pylist(), {}
            for row, text in enumerate(texts):
                if text:
                    base = base_spans(text)
                    spans = base + sent.value.added(text, base)
                    if spans:
                        changed[row] = texts[row] = redacted(text, spans)
            if changed:
                at = batch.schema.get_field_index(text_col)
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
                at = batch.schema.get_field_index(length_col)
                if at >= 0:
                    lengths = batch.column(at).to_pylist()
                    for row, text in changed.items():
                        lengths[row] = len(text)
                    batch = batch.set_column(at, batch.schema.field(at), pa.array(lengths, batch.schema.field(at).type))
            yield batch

    return map_batches(docs, run, schema)
