"""Quality rules from tokeniser fertility.

Two public vocabularies encode the words of every text: one of pieces with byte
fallback and one of bytes. For each, characters per token, the share of tokens
that fall back to bytes (or hold a broken character) and the entropy of the
tokens, as a share of what as many tokens could have, are measured. A text is
rejected if a measure lies outside the band of its language, or of its script
where no language is given. Bands are medians of the corpus, widened by a
multiple of the median deviation, which grows for texts of few words.
"""

from __future__ import annotations

import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import arrow_schema, batch_of, byte_strings, map_batches, vocabulary
from tagloom.operators.joins import lookup_join
from tagloom.session import materialised

VOCABULARIES = ("piece_bpe_32k.model", "byte_bpe_50k.json")
MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
DEVIATIONS = 8.0  # width of a band, in median deviations of a text of LONG_WORDS words or more
LONG_WORDS = 400
SLACK = {"chars": 0.2, "fallback": 0.05, "entropy": 0.05}  # least width of a band
CACHE_WORDS = 1_200_000  # words known at once; forgotten between batches

MEASURES = [f"{name}_{i}" for i in range(len(VOCABULARIES)) for name in ("chars", "fallback", "entropy")]
SCHEMA = ("doc_id long, lang string, script string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, " + ", ".join(f"{m} double" for m in MEASURES))

_SYMBOLS = b"#*$%&|<>"


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more; ``ids`` are equal where the words are."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    keys = np.zeros(n, np.uint64)
    for j in range(window):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + ids[j:j + n].astype(np.uint64)
    ordered = np.sort(keys)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    # Equal keys are only a hint: number the windows exactly, by pairs of halves.
    exact, size = np.unique(ids, return_inverse=True)[1].astype(np.int64), 1
    while size < window:
        step = min(size, window - size)
        pairs = exact[:len(exact) - step] * (len(ids) + 1) + exact[step:]
        exact, size = np.unique(pairs, return_inverse=True)[1].astype(np.int64), size + step
    again = np.bincount(exact)[exact] > 1
    edges = np.zeros(len(ids) + 1, np.int64)
    edges[:n] += again
    edges[window:] -= again
    return int((np.cumsum(edges[:-1]) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    lines = [line for line in text.split(b"\n") if line.split()]
    return len(lines) - len(set(lines))


@lru_cache(10_000)
def script_of_letter(letter: str) -> str:
    return unicodedata.name(letter, "OTHER").split(" ")[0].split("-")[0]


def script_of(word: str) -> str:
    """First word of the Unicode name of the first letter, such as LATIN or CYRILLIC."""
    if word[0].isalpha():
        return script_of_letter(word[0])
    letter = next((c for c in word if c.isalpha()), None)
    return script_of_letter(letter) if letter else ""


class Words:
    """What is known about each distinct word: characters, script, and its tokens in every vocabulary."""

    def __init__(self, names=VOCABULARIES, limit: int = CACHE_WORDS):
        import sentencepiece

        from tagloom.llm.tokens import TokenIds

        self.names, self.limit = names, limit
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=vocabulary(names[0]))
        self.bytes = TokenIds(names[1], 50_000)
        self.broken = self._broken(names[1])
        self.scripts: dict[str, int] = {"": 0}
        self.forget()

    def _broken(self, name: str) -> np.ndarray:
        """Which tokens of the byte vocabulary hold a part of a character only."""
        back = {c: b for b, c in self.bytes.letters.items()}
        broken = np.zeros(self.bytes.tokenizer.get_vocab_size(), bool)
        for token, i in self.bytes.tokenizer.get_vocab().items():
            try:
                bytes(back[c] for c in token).decode()
            except (UnicodeDecodeError, KeyError):
                broken[i] = True
        return broken

    def forget(self):
        self.index: dict[bytes, int] = {}
        self.chars, self.script = array("q"), array("q")
        # Of every vocabulary: tokens of each word, all tokens in a row, and odd tokens of each word.
        self.sizes, self.flat, self.odd = ([array(t) for _ in self.names] for t in "qiq")

    def number(self, words: list[bytes]) -> np.ndarray:
        """Numbers of the words; new words get the next ones."""
        index = self.index
        return np.array([index.setdefault(w, len(index)) for w in words], np.int64)

    def learn(self):
        """Measure the words that are new since the last call and bring the tables up to date."""
        texts = [w.decode() for w in islice(self.index, len(self.chars), None)]
        if texts:
            self.chars.extend(map(len, texts))
            self.script.extend([self.scripts.setdefault(script_of(t), len(self.scripts)) for t in texts])
            pieces = [np.array(i, np.int32) for i in self.pieces.encode(texts, num_threads=1)]
            byte_tokens = [np.frombuffer(self.bytes.piece(t), "<i4") for t in texts]
            # The first ids of the piece vocabulary are its special ones, then come the 256 bytes.
            is_odd = (lambda t: (t >= 3) & (t < 259), lambda t: self.broken[t])
            for k, tokens in enumerate((pieces, byte_tokens)):
                sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
                flat = np.concatenate(tokens).astype(np.int32)
                before = np.concatenate([[0], np.cumsum(is_odd[k](flat))]).astype(np.int64)
                ends = np.cumsum(sizes)
                self.sizes[k].frombytes(sizes.tobytes())
                self.flat[k].frombytes(flat.tobytes())
                self.odd[k].frombytes((before[ends] - before[ends - sizes]).tobytes())
        self.tables = []
        for k in range(len(self.names)):
            # Copies: an array that numpy looks into could not grow.
            sizes = np.array(self.sizes[k], np.int64)
            self.tables.append((sizes, np.cumsum(sizes) - sizes, np.array(self.flat[k], np.int32), np.array(self.odd[k], np.int64)))
        self.columns = [np.array(self.chars, np.int64), np.array(self.script, np.int64)]


def entropy_share(flat: np.ndarray, weights: np.ndarray) -> float:
    """Entropy of the tokens, as a share of the largest that as many tokens can have; 1 for fewer than two."""
    total = int(weights.sum())
    if total < 2:
        return 1.0
    order = np.argsort(flat, kind="stable")
    flat, weights = flat[order], weights[order]
    counts = np.add.reduceat(weights, np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])))
    return float((np.log(total) - (counts * np.log(counts)).sum() / total) / np.log(total))


def measure(known: Words, ids: np.ndarray) -> list:
    """Script, words, characters, and for every vocabulary the three measures; null where there are no words."""
    if not len(ids):
        return ["", 0, 0, *[None] * len(MEASURES)]
    words, times = np.unique(ids, return_counts=True)
    chars = int((known.columns[0][words] * times).sum())
    scripts = np.bincount(known.columns[1][words], weights=known.columns[0][words] * times, minlength=2)
    scripts[0] = 0
    script = list(known.scripts)[int(scripts.argmax())] if scripts.any() else ""
    out = [script, len(ids), chars]
    for sizes, starts, flat, odd in known.tables:
        n = int((sizes[words] * times).sum())
        size = sizes[words]
        ends = np.cumsum(size)
        at = np.repeat(starts[words] - (ends - size), size) + np.arange(int(ends[-1]))
        out += [chars / n, float((odd[words] * times).sum()) / n, entropy_share(flat[at], np.repeat(times, size))] if n else [None] * 3
    return out


_KNOWN: dict[tuple, Words] = {}


def measures(docs: DataFrame, names=VOCABULARIES, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The measures and the base counts of every whole text."""
    lang = F.col(f"`{lang_col}`").cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), lang.alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(SCHEMA)
        if tuple(names) not in _KNOWN:
            _KNOWN[tuple(names)] = Words(names)
        known = _KNOWN[tuple(names)]
        for batch in batches:
            if len(known.index) > known.limit:
                known.forget()
            texts = byte_strings(batch)
            numbered = [known.number(text.split()) for text in texts]
            known.learn()
            out = []
            for text, ids in zip(texts, numbered):
                script, n_words, chars, *values = measure(known, ids)
                symbols = len(text) - len(text.translate(None, _SYMBOLS))
                out.append([script, n_words, chars, symbols, duplicate_lines(text), repeated_words(ids), *values])
            yield batch_of(schema, [batch.column("doc_id"), batch.column("lang"), *([row[k] for row in out] for k in range(6 + len(MEASURES)))])

    return map_batches(rows, run, SCHEMA)


def bands(measured: DataFrame) -> DataFrame:
    """Median and median deviation of each measure by group, over all texts with words."""
    usable = measured.where(f"n_words >= {MIN_WORDS}")
    middle = usable.groupBy("grp").agg(*[F.percentile_approx(m, 0.5, 1000).alias(f"mid_{m}") for m in MEASURES])
    away = lookup_join(usable, middle.withColumnRenamed("grp", "_grp"), "grp", "_grp", spread_by=["doc_id", "n_words"])
    spread = away.groupBy("grp").agg(*[F.percentile_approx(F.abs(F.col(m) - F.col(f"mid_{m}")), 0.5, 1000).alias(f"dev_{m}") for m in MEASURES])
    return middle.join(spread, "grp")


def judge(docs: DataFrame, names=VOCABULARIES, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts, fertility measures and the verdict for every whole text; one row per row of ``docs``.

    ``base_failed`` holds for fewer than 20 words or more than 30 % of words in repeated windows; ``rejected_by`` names the
    measures outside the band. Null and empty texts have no words and fail the base rule; repeated rows get equal results; a
    null or empty language is replaced by the script of most letters; an empty table gives no rows.
    """
    measured = materialised(measures(docs, names, id_col, text_col, lang_col), "fertility")
    group = F.when(F.coalesce("lang", F.lit("")) != "", F.col("lang")).otherwise(F.concat(F.lit("script "), "script"))
    measured = measured.withColumn("grp", group)
    limits = materialised(bands(measured), "bands").withColumnRenamed("grp", "_grp")
    judged = lookup_join(measured, limits, "grp", "_grp", "left", spread_by=["doc_id", "n_words"])
    wide = F.sqrt(F.greatest(F.lit(1.0), F.lit(float(LONG_WORDS)) / F.greatest(F.col("n_words"), F.lit(1))))
    tests = []
    for m in MEASURES:
        room = F.greatest(F.col(f"dev_{m}") * DEVIATIONS, F.lit(SLACK[m.rpartition("_")[0]])) * wide
        outside = (F.col(m) > F.col(f"mid_{m}") + room) if m.startswith("fallback") else (F.col(m) < F.col(f"mid_{m}") - room)
        tests.append(F.when(outside, F.lit(m)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    rejected = F.concat_ws(",", *tests)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                         (~failed & (rejected == "")).alias("kept"), F.col("grp").alias("band"), rejected.alias("rejected_by"), *MEASURES)
