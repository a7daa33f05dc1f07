"""Edge cases and brute-force versions of the text operators."""

import hashlib
import itertools
import math
import random
import re
import struct
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from oracle import connect, difference
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagloom.llm import components, ctw, fertility, licences, lshforest, packing, pfor, pii, sharding, tokens, toxicity, wumanber
from tagloom.llm.common import vocabulary
from tagloom.llm.queries import ORACLES, QUERIES

LONG = "one two three four five six seven eight nine ten " * 3000
ROWS = [(1, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a"), (2, None, "en", "a"), (3, "", None, None),
        (4, LONG, "en", "b"), (5, "word", "", "b"), (6, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a"),
        (6, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a"), (None, "no id at all", "fr", None),
        (8, "  two spaces \n\n\tand\x0btabs  <|endoftext|> ÀÉ ĳ 世界 \U0001f600 don't 12 3.4 ", "de", "c"), (9, "Released under the MIT License.\nmail me@example.org", "en", "c")]
SCHEMA = "doc_id long, text string, lang string, source string, n_words long, key string, node long"


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, 0, "x", 0) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark)


@pytest.fixture(scope="module")
def given(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_ids_are_the_librarys(name, given):
    plain = Tokenizer.from_file(vocabulary(name))
    encode = tokens.TokenIds(name, 500)
    odd = ["", " ", "  a", "a  ", "\n b", "a\n\n b\n", "x\x1cy \x85z", "İstanbul ΣΑΣ ς é ́x", "don't 'S 12 ½ a1b2",
           "a <|endoftext|> b", "<|endoftext|>", "a<|startoftext|><|endoftext|>  \n<|ENDOFTEXT|> é<|endoftext|>\u0301x <|endoftext| > \n", " <|startoftext|> a"]
    for text in odd + [r[1] or "" for r in ROWS[:3] + ROWS[4:]] + [r.text for r in given.limit(40).collect()]:
        ids = plain.encode(text, add_special_tokens=False).ids
        assert encode(text) == struct.pack(f"<{len(ids)}I", *ids), text


def test_words_are_looked_up_without_what_stands_beside_them():
    """Marks and line ends beside a word make no new entry, and odd characters leave the other lines on the short way."""
    plain, encode = Tokenizer.from_file(vocabulary("word_bpe_49k.json")), tokens.TokenIds("word_bpe_49k.json")
    names = ["river", "Stone", "über", "don't", "a1b22"]
    texts = [f"{a}{mark}{b}" for a in names for b in names for mark in (" ", ", ", "*** ", ".\n", "!\n\n", "&&& ")]
    caches = [c for c in vars(encode).values() if isinstance(c, tokens.Generations)]
    for text in texts:
        ids = plain.encode(text, add_special_tokens=False).ids
        assert encode(text) == struct.pack(f"<{len(ids)}I", *ids), text
    distinct = {"river", "stone", "über", "don", "'t", "a", "1", "b", "2", ",", "***", ".", "!", "&&&"}
    assert sum(map(len, caches)) == len(distinct)
    odd = "river\u2014stone\nRiver, \u212aelvin e\u0301\r\n" + "\n".join(texts) + " \x85\x1c\u1e9e\u0178'S\u2019s"
    ids = plain.encode(odd, add_special_tokens=False).ids
    assert encode(odd) == struct.pack(f"<{len(ids)}I", *ids)
    assert sum(map(len, caches)) < len(distinct) + 25


@pytest.mark.parametrize("source", ["docs", "given"])
def test_packing(request, source):
    table = request.getfixturevalue(source)
    rows = packing.pack(table, with_ids=True).collect()
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)
    encode = tokens.token_ids("byte_bpe_50k.json")
    expected = Counter((d.doc_id, encode(d.text or "") + tokens.END) for d in table.select("doc_id", "text").collect())
    pieces = {}
    for r in rows:
        assert r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids)
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids))
    for doc_id, found in pieces.items():
        copies = sum(n for (i, _), n in expected.items() if i == doc_id)
        whole = b"".join(ids for _, ids in sorted(found, key=lambda p: p[0]))
        assert copies > 1 or (doc_id, whole) in expected
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    sizes = []
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == list(itertools.accumulate([0, *(n for _, n in parts)]))[:-1]
        sizes.append(sum(n for _, n in parts))
    assert all(s <= 2048 and s & (s - 1) == 0 for s in sizes)


def test_pack_block_keeps_every_token():
    rng = np.random.default_rng(3)
    parts = [(int(n), k, 0) for k, n in enumerate(rng.integers(1, 5000, 300))]
    windows, left = packing.pack_block(parts)
    tail = packing.pack_tail(left)
    covered = Counter()
    for tier, window in windows + tail:
        assert sum(p[0] for p in window) == tier
        for length, key, start in window:
            covered.update((key, i) for i in range(start, start + length))
    assert covered == Counter((k, i) for n, k, _ in parts for i in range(n))


@pytest.mark.parametrize("ids", [[], [7], [5] * 700, list(range(2000)), [0, 2 ** 32 - 1] * 300, [1] * 600 + [49407] * 5])
def test_frame_of_reference(ids):
    data = pfor.encode_shard([1, None], [np.array(ids, "<u4").tobytes(), b""], block=128)
    shard = pfor.Shard(data)
    assert shard.ids().tolist() == ids and shard.doc_ids == [1, None] and shard.lengths.tolist() == [len(ids), 0]
    if ids:
        assert shard.decode(shard.n_blocks - 1).tolist() == ids[(shard.n_blocks - 1) * 128:]


def test_random_blocks_survive():
    rng = np.random.default_rng(5)
    for width in range(33):
        ids = (rng.integers(0, 1 << 32, 513, dtype=np.uint64) >> np.uint64(32 - width)).astype(np.uint32)
        assert (pfor.decode_block(memoryview(pfor.encode_block(ids)), len(ids)) == ids).all()


def test_blocks_encoded_together_are_those_encoded_alone():
    rng = np.random.default_rng(6)
    for count in (0, 5, 128, 128 * pfor.TOGETHER, 128 * (pfor.TOGETHER + 3) + 77):
        ids = (rng.integers(0, 1 << 32, count, dtype=np.uint64) >> rng.integers(0, 33, count, dtype=np.uint64).repeat(128)[:count]).astype("<u4")
        for share in (0.5, 0.95, 1.0):
            assert pfor.encode_blocks(ids, 128, share) == [pfor.encode_block(ids[i:i + 128], share) for i in range(0, count, 128)]
        assert (pfor.Shard(pfor.encode_shard([1], [ids.tobytes()], 128)).ids() == ids).all()


def test_id_files(spark, docs, given):
    for table in (docs, given, docs.limit(0)):
        encode = tokens.token_ids("word_bpe_49k.json")
        expected, at = [], 0
        for doc_id, text in sorted(((r.doc_id, r.text or "") for r in table.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
            ids = encode(text) + tokens.END
            expected.append((doc_id, at, len(ids) // 4, zlib.crc32(ids)))
            at += len(ids) // 4
        got = sorted(map(tuple, pfor.round_trip(table).collect()), key=lambda r: r[1])
        assert got == expected


def brute_contamination(text, items):
    pattern = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    own, hit, found = pattern.findall(lower(text)), set(), set()
    for item_id, item in items:
        other = pattern.findall(lower(item))
        size = min(13, len(other))
        for i in range(len(other) - size + 1 if size else 0):
            for j in range(len(own) - size + 1):
                if own[j:j + size] == other[i:i + size]:
                    hit.update(range(j, j + size))
                    if item_id is not None:
                        found.add(str(item_id))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(own), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(own)


def test_contamination(spark):
    items = [(1, "Quick brown FOX"), (2, None), (3, "..."), (4, "lazy"), (None, "river bank today"), (10, "the lazy dog near the old river bank today a b c d e f"),
             (5, "one two three four five six seven eight nine ten one two three four"), (5, "one two three four five six seven eight nine ten one two three four")]
    rows = [*ROWS[:3], (4, LONG[:2000], "en", "b"), *ROWS[4:], (11, "x the lazy dog near the old river bank today a b c d e f y", "en", "a")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = sorted((str(r[0]), *brute_contamination(r[1], items)) for r in rows)
    for size in (1 << 20, 40):
        got = sorted((str(r[0]), *r[1:]) for r in map(tuple, wumanber.contamination(frame(spark, rows), benchmark, pass_bytes=size).collect()))
        assert got == expected
        kept = wumanber.decontaminate(frame(spark, rows), benchmark, pass_bytes=size)
        assert kept.columns == frame(spark, rows).columns and kept.count() == sum(not e[-1] for e in expected)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert wumanber.contamination(frame(spark, rows), empty).where("n_hit > 0").count() == 0


def test_contamination_of_odd_item_ids(spark):
    items = [("a,b", "quick brown fox"), ("", "the lazy dog"), ("b", "river bank today"), (None, "old river")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    expected = sorted((str(r[0]), *brute_contamination(r[1], items)) for r in ROWS[:3])
    for size in (1 << 20, 20):
        got = sorted((str(r[0]), *r[1:]) for r in map(tuple, wumanber.contamination(frame(spark, ROWS[:3]), benchmark, pass_bytes=size).collect()))
        assert got == expected


def test_fertility_counts(spark, docs):
    repeated = "a b c d e f g h " * 3 + "\nx y\nx y\n \n"
    rows = [*ROWS, (20, repeated, "en", "a"), (21, "% # " * 30, "en", "a")]
    got = {}
    for r in fertility.judge(frame(spark, rows)).collect():
        got.setdefault(r.doc_id, r)
    for doc_id, text, *_ in rows:
        w = words_of(text)
        windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        covered = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in (text or "").split("\n") if words_of(x)]
        r = got[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w)) and not (r.base_failed and r.kept)
    assert fertility.judge(docs.limit(0)).count() == 0


def test_fertility_measures_equal_whole_encoding():
    import sentencepiece

    known, text = fertility.Words(), "größer words, más 世界 \U00013000 and words"
    ids = known.number(text.encode().split())
    known.learn()
    script, n, chars, *values = fertility.measure(known, ids)
    pieces = [i for w in text.split() for i in sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model")).encode(w)]
    counts = Counter(pieces)
    entropy = -sum(c / len(pieces) * math.log(c / len(pieces)) for c in counts.values()) / math.log(len(pieces))
    assert (script, n, chars) == ("LATIN", 7, sum(map(len, text.split())))
    assert values[0] == pytest.approx(chars / len(pieces)) and values[2] == pytest.approx(entropy)
    assert values[1] == pytest.approx(sum(3 <= i < 259 for i in pieces) / len(pieces)) and values[1] > 0


def brute_tree(texts, depth=ctw.DEPTH):
    """Log10 probability of a byte behind a context, straight from the recursion."""
    nodes, children = {}, {}
    for text in texts:
        s = b"\xff" * depth + text + b"\xff"
        for i in range(depth, len(s)):
            for d in range(depth + 1):
                context, node = s[i - d:i], 1
                for k in range(8):
                    bit = s[i] >> (7 - k) & 1
                    nodes.setdefault((context, node), [0, 0])[bit] += 1
                    if d:
                        children.setdefault((context[1:], node), set()).add(context)
                    node = 2 * node + bit

    def estimate(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def below(context, node):
        return sum(weighted(c, node) for c in children.get((context, node), ()))

    def weighted(context, node):
        own = estimate(*nodes[context, node])
        return own if len(context) == depth else np.logaddexp(own, below(context, node)) - math.log(2)

    def bit_probability(context, node, bit, d=0):
        here = context[depth - d:]
        counts = nodes.get((here, node), (0, 0))
        kt = (counts[bit] + 0.5) / (sum(counts) + 1)
        if d == depth:
            return kt
        share = 1 / (1 + math.exp(below(here, node) - estimate(*counts)))
        return share * kt + (1 - share) * bit_probability(context, node, bit, d + 1)

    def log_p(context, byte):
        total, node = 0.0, 1
        for k in range(8):
            bit = byte >> (7 - k) & 1
            total += math.log10(bit_probability(context, node, bit))
            node = 2 * node + bit
        return total

    return log_p


def test_context_tree(spark):
    rows = [(i, t, "en", "a") for i, t in enumerate(["abra cadabra", "Abra", None, "", "cadabra abra é", "abra cadabra"] * 3)] + [(None, "abra", None, None)]
    got = Counter()
    expected = Counter()
    train = [lower(t).encode() for i, t, *_ in rows if not ctw.is_held_out(i)]
    log_p = brute_tree(train)
    counts = Counter(w for t in train for w in [*t.split(), b""])
    n, v = sum(counts.values()), len(counts)
    for i, text, *_ in rows:
        data = lower(text).encode()
        s = b"\xff" * ctw.DEPTH + data + b"\xff"
        score = sum(log_p(s[k - ctw.DEPTH:k], s[k]) for k in range(ctw.DEPTH, len(s)))
        own = [*data.split(), b""]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        expected[i, ctw.is_held_out(i), len(own), sum(counts[w] > 0 for w in own), n, round(base, 8), round(score, 6)] += 1
    for size in (10, 1 << 20):
        got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 8), round(r.score, 6))
                      for r in ctw.scores(frame(spark, rows), chunk_bytes=size).collect())
        assert got == expected
    assert ctw.scores(frame(spark, rows).limit(0)).count() == 0
    # All bytes behind a context are as likely as one of them.
    assert sum(10 ** log_p(b"abra", b) for b in range(256)) == pytest.approx(1.0)


def base_pii(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


@pytest.mark.parametrize("text", ["", "a@b", "x@y.z@w.q", "a@b.c.d@e.f, .@-.-", "1.2.3.4.5.6.7.8", "256.1.1.1 01.002.3.4", "4111 1111 1111 1111-1", "+1 (2) 3-4.567890",
                                  "+1 2+3456789012", "é4111111111111111", "9" * 3000, "a" * 3000 + "@", "a@@b.c"])
def test_plain_personal_data(text):
    assert pii.base_spans(text) == base_pii(text)


def segmentations(n, spans, at=0):
    """All ways to cut n tokens into single ones left outside and candidate spans of a kind."""
    if at == n:
        yield []
        return
    yield from segmentations(n, spans, at + 1)
    for (i, j), kind in itertools.product([s for s in spans if s[0] == at], range(len(pii.KINDS))):
        for rest in segmentations(n, spans, j):
            yield [(i, j, kind), *rest]


@pytest.mark.parametrize("text", ["a@b.c", "1-2", "x 7", "@", "+1 (2"])
def test_personal_data_decoding_against_enumeration(text):
    weights = np.random.default_rng(3).normal(size=(1 + len(pii.KINDS), pii.SLOTS + 1))
    weights[:, pii.SLOTS] = 0.0
    tokens, = pii.islands(text)
    lattice = pii.Lattice(tokens, text, 0)
    spans, outside = lattice.scores(weights)
    place = {s: k for k, s in enumerate(lattice.spans)}

    def score(cut):
        taken = {t for i, j, _ in cut for t in range(i, j)}
        return sum(spans[place[i, j], kind] for i, j, kind in cut) + sum(outside[t] for t in range(len(tokens)) if t not in taken)

    ways = list(segmentations(len(tokens), lattice.spans))
    for block in (1, 2, 512):
        found = pii.best(tokens, text, 0, weights, block)
        assert score([f[:3] for f in found]) == pytest.approx(max(map(score, ways)))
        for i, j, kind, margin in found:
            assert margin == pytest.approx(spans[place[i, j], kind] - outside[i:j].sum())
    # The likelihood of a labelling is its share of all of them.
    gold = max(ways, key=len)
    likelihood = lattice.gradient(weights, {(i, j): kind for i, j, kind in gold}, np.zeros_like(weights))
    assert likelihood == pytest.approx(score(gold) - np.logaddexp.reduce([score(w) for w in ways]))


def test_personal_data_of_a_very_long_line():
    random = np.random.default_rng(5)
    weights = random.normal(size=(1 + len(pii.KINDS), pii.SLOTS + 1)).astype(np.float32)
    weights[:, pii.SLOTS] = 0.0
    line = " ".join(map(str, random.integers(0, 300, 3000)))
    tokens, = pii.islands(line)
    whole = pii.best(tokens, line, 0, weights, len(tokens))
    assert [f[:3] for f in pii.best(tokens, line, 0, weights, 64)] == [f[:3] for f in whole]
    tracemalloc.start()
    try:
        pii.best(tokens, line, 0, weights, 64)
        assert tracemalloc.get_traced_memory()[1] < 6_000_000
    finally:
        tracemalloc.stop()


def test_personal_data_field(spark, given):
    field = pii.fit(given, rows=150)
    for r in given.collect():
        base = base_pii(r.text)
        assert pii.base_spans(r.text) == base
        assert all(e <= s or a >= z for a, _, e in field.added(r.text, base) for s, _, z in base)
    found = pii.find(frame(spark), field).collect()
    assert len(found) == len(ROWS) and {r.n_email for r in found if r.doc_id == 9} == {1}
    assert [pii.KINDS[k] for _, k, _ in field.added("call 988-555-2485 now", [])] == ["phone"]
    clean = pii.redact(frame(spark), field)
    assert clean.columns == frame(spark).columns and clean.count() == len(ROWS)
    assert clean.where("doc_id = 9").first().text == "Released under the MIT License.\nmail [EMAIL]"
    assert pii.find(frame(spark).limit(0), pii.fit(frame(spark).limit(0))).count() == 0


def test_segments_against_all_splits():
    def brute(x):
        """Maximal segments by their definition, by taking the best one and going on to either side."""
        if not len(x) or x.max() <= 0:
            return []
        total = np.concatenate([[0], np.cumsum(x)])
        score, length, i, j = max((total[j] - total[i], -(j - i), i, j) for i in range(len(x)) for j in range(i + 1, len(x) + 1))
        return brute(x[:i]) + [(i, j, score)] + [(i + j + a - i, i + j + b - i, s) for a, b, s in brute(x[j:])]

    rng = np.random.default_rng(11)
    for _ in range(200):
        x = rng.normal(-0.3, 1, rng.integers(1, 15))
        got = [(a, b, pytest.approx(s)) for a, b, s in toxicity.segments_of(x)]
        assert got == brute(x)


def test_toxicity(spark, given, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(given, labels)
    judged = toxicity.score(given, model).join(labels, "doc_id").where("held_out and toxic is not null").collect()
    assert sum(r.predicted == r.toxic for r in judged) >= 0.85 * len(judged)
    rows = toxicity.score(frame(spark), model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert {r.held_out for r in rows if r.doc_id is None} == {True}
    nothing = toxicity.fit(frame(spark), labels.limit(0))
    assert toxicity.without_toxic(frame(spark), nothing).count() == len(ROWS)
    assert toxicity.score(given.limit(0), model).count() == 0


def test_lookup_table():
    shards = {"a": 1, "b": 2, "c": 1}
    size, names = 101, sorted(shards)
    table = [None] * size
    orders = {n: [(sharding.preference(n, size)[0] + i * sharding.preference(n, size)[1]) % size for i in range(size)] for n in names}
    while None in table:
        for n in names:
            for _ in range(shards[n]):
                slot = next((s for s in orders[n] if table[s] is None), None)
                if slot is not None:
                    table[slot] = names.index(n)
    assert sharding.fill(shards, size) == table
    big = sharding.fill(sharding.SHARDS)
    counts = Counter(big)
    assert max(counts.values()) - min(counts.values()) <= 1
    without = {n: w for n, w in sharding.SHARDS.items() if n != "shard-07"}
    moved = sum(a != b for a, b in zip([sorted(sharding.SHARDS)[n] for n in big], [sorted(without)[n] for n in sharding.fill(without)]))
    assert moved < 0.1 * sharding.TABLE_SIZE
    with pytest.raises(ValueError):
        sharding.fill(shards, 100)


def test_sharding(spark, docs, sf_dir):
    assert difference(QUERIES["op7_sharding"](spark, sf_dir), connect(sf_dir), ORACLES["op7_sharding"]) is None
    assert sharding.place(docs).count() == len(ROWS) and sharding.place(docs.limit(0)).count() == 0


def brute_groups(rows):
    sets = {}
    for doc_id, text, *_ in rows:
        w = words_of(lower(text))
        sets[doc_id] = {tuple(w[i:i + 2]) for i in range(len(w) - 1)} or ({tuple(w)} if w else set())
    root = {d: d for d in sets}
    for _ in sets:
        for a, b in itertools.combinations([d for d in sets if d is not None and sets[d]], 2):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[a] = root[b] = min(root[a], root[b])
    return {d: (len(sets[d]), root[d], d is None or root[d] == d) for d in sets}


def test_near_duplicates(spark, given):
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in rng.integers(0, 400, 60)]
    near = [(100 + k, " ".join(["X" if i == k else w for i, w in enumerate(base)]), "en", "a") for k in range(60)]
    drift = list(base)
    for k in range(40):
        drift[k] = f"d{k}"
        near.append((300 + k, " ".join(drift), "en", "a"))
    for rows in (ROWS + near, [tuple(r)[:2] + ("", "") for r in given.select("doc_id", "text").collect()]):
        expected = brute_groups(rows)
        for r in lshforest.groups(frame(spark, rows)).collect():
            assert (r.n_shingles, r.component_id, r.kept) == expected[r.doc_id], r.doc_id
        kept = lshforest.deduplicated(frame(spark, rows))
        ids = [r.doc_id for r in kept.collect()]
        assert kept.columns == frame(spark, rows).columns and len(ids) == len(set(ids)) == sum(e[2] for e in expected.values())
    assert lshforest.groups(frame(spark, ROWS[:0])).count() == 0


def test_own_column_names_do_not_clash(spark):
    names = ["_gone", "_again", "_digest", "_GONE_"]
    docs = spark.createDataFrame([(*r[:2], *"abcd") for r in ROWS], ["doc_id", "text", *names])
    kept = lshforest.deduplicated(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 2, 3, 4, 5, 8, 9]
    benchmark = spark.createDataFrame([(1, "lazy dog near the old river bank"), (2, "x y z")], "item_id long, text string")
    for size in (1 << 20, 10):
        clean = wumanber.decontaminate(docs, benchmark, pass_bytes=size)
        assert clean.columns == docs.columns and {tuple(r)[2:] for r in clean.collect()} == {("a", "b", "c", "d")}


def test_long_runs_are_reported_whole():
    rng = np.random.default_rng(14)
    number = np.repeat(np.arange(60), rng.integers(1, 14, 60))
    for reach in (1, 3, 5):
        expected, lengths = set(), np.bincount(number)
        expected = set(np.flatnonzero(lengths[number] > reach).tolist())
        for step in (1, 2, 7, 1000):
            got, begin = set(), 0
            for start in range(0, len(number), step):
                held = number[begin:start + step]
                got |= {int(i) + begin for i in lshforest.long_runs(held, start - begin, reach)}
                begin = max(0, min(start + step, len(number)) - reach - 1)
            assert got == expected


def test_near_duplicates_in_a_crowd(spark):
    """Noisy copies of one text, unlike each other but for a few less noisy ones far apart in the order of ids."""
    rng, base, rows, less = np.random.default_rng(8), [f"w{i}" for i in range(401)], [], {0, 750, 1500, 2250}
    for k in range(3000):
        words = list(base)
        for i in rng.choice(401, 10 if k in less else 20, replace=False):
            words[i] = f"n{k}x{i}"
        rows.append((k, " ".join(words), "en", "a"))
    sets = [{a + " " + b for a, b in zip(t.split(), t.split()[1:])} for _, t, *_ in rows]
    times = Counter(x for s in sets for x in s)
    shared = {x: i for i, x in enumerate(x for x, n in times.items() if n > 1)}
    table = np.zeros((len(sets), len(shared)), np.float32)
    for k, s in enumerate(sets):
        table[k, [shared[x] for x in s if x in shared]] = 1
    common, size = table @ table.T, np.array([len(s) for s in sets])
    linked = np.argwhere(np.triu(100 * common >= 80 * (size[:, None] + size[None, :] - common), 1)).tolist()
    assert {tuple(p) for p in linked} == set(itertools.combinations(sorted(less), 2))
    expected = {x: r for r, x in components.contracted([tuple(p) for p in linked])}
    got = {r.doc_id: r.component_id for r in lshforest.groups(frame(spark, rows)).collect()}
    assert got == {k: expected.get(k, k) for k in range(len(rows))}


def test_blocks_cover_all_pairs(spark):
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 1 << 62, 40)) for _ in range(10)] + [np.arange(100 + k % 3, 200 + k % 3) for k in range(40)]
    sets += [np.unique(np.concatenate([np.arange(1000, 1100), rng.integers(2000, 4000, 30)])) for _ in range(60)]
    expected = [[len(np.intersect1d(a, b)) for b in sets[20:]] for a in sets[:70]]
    assert lshforest.common_shingles(sets[:70], sets[20:]).tolist() == expected
    links = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2)
             if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
    roots = spark.createDataFrame([(k, 10) for k in range(10, 30)], "node long, root long")
    regions = spark.createDataFrame([(k, 0) for k in range(len(sets))], "node long, region long")
    table = spark.createDataFrame([(k, s.tolist()) for k, s in enumerate(sets)], "node long, shingles array<long>")
    expected = dict((x, r) for r, x in components.contracted(links))
    for size in (7, 1000):
        found = [tuple(r) for r in lshforest.links_within(regions, table, roots, size).collect()]
        assert dict((x, r) for r, x in components.contracted(found + [(10, k) for k in range(11, 30)])) == expected


def test_components(spark):
    rng = np.random.default_rng(4)
    links = [(i, i + 1) for i in range(200)] + [(int(a), int(b)) for a, b in rng.integers(1000, 1200, (90, 2))] + [(7, 7), (None, 3)]
    expected = {x: r for r, x in components.contracted([(a, b) for a, b in links if a is not None])}
    frame_ = spark.createDataFrame(links, "a long, b long").repartition(7)
    got = {r.node: r.root for r in components.components(frame_).collect() if r.node != r.root}
    assert got == expected


def test_licences(spark, given):
    model = licences.fit(given)
    texts = [(1, "some prose here\nReleased under the MIT License.\n\nmore prose", "en", "a"), (2, "Licensed under the Apache License, Version 2.0.", "en", "a"),
             (3, "This work is licensed under the GNU General Public License, version 3.", "en", "a"), (4, "the terms of the old river", "en", "a")]
    found = licences.find(frame(spark, ROWS + texts), model).where("confirmed").collect()
    assert {(r.doc_id, r.paragraph, r.family) for r in found} == {(1, 1, "mit"), (2, 0, "apache"), (3, 0, "gpl"), (9, 0, "mit")}
    assert licences.find(frame(spark, ROWS[:0]), model).count() == 0


def test_licence_lines_of_the_documents(spark, sf_dir):
    """Each family's notice as it stands in ``documents``."""
    given = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    lines = {"All rights reserved.": "proprietary", "Licensed under CC BY-NC 4.0.": "cc-by-nc", "Released under the MIT License.": "mit",
             "Licensed under the Apache License, Version 2.0.": "apache", "This work is licensed under the GNU General Public License, version 3.": "gpl"}
    expected = Counter()
    for r in given.select("doc_id", "text").collect():
        expected.update((r.doc_id, k, lines[x.strip()]) for k, x in enumerate((r.text or "").split("\n")) if x.strip() in lines)
    assert {family for _, _, family in expected} == set(lines.values())
    found = Counter((r.doc_id, r.paragraph, r.family) for r in licences.find(given, licences.fit(given)).where("confirmed").collect())
    assert not expected - found


def test_wrapped_licences(spark, given):
    gpl = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
    bsd = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:"""
    narrow = "\n".join("# " + w for w in bsd.split())
    texts = [(1, gpl, "en", "a"), (2, "some prose here\n\n" + bsd + "\n\nmore", "en", "a"), (3, narrow, "en", "a"),
             (4, "prose\nReleased under the MIT License.\nprose", "en", "a"), (5, bsd.replace("\n", "\n\n"), "en", "a")]
    found = licences.find(frame(spark, texts), licences.fit(given)).where("confirmed").collect()
    assert sorted((r.doc_id, r.paragraph, r.family) for r in found) == [(1, 0, "gpl"), (2, 2, "bsd"), (3, 0, "bsd"), (4, 1, "mit")]
    assert licences.blocks(frame(spark, ROWS[:3])).where("head is not null").count() == 0


def shares(tokens, family=None):
    """The largest share of a template's two-grams in the words, by the definition."""
    own = set(zip(tokens, tokens[1:]))
    parts = [set(zip(w, w[1:])) for name, texts in licences.TEMPLATES.items() if family in (None, name)
             for w in map(licences._plain_words, texts)]
    return max(len(p & own) / len(p) for p in parts)


def every_line_and_line_end(text):
    """``(paragraph, before, head, tail, words)`` of all lines and all line ends, without any selection."""
    lines, span = [licences._plain_words(x) for x in text.split("\n")], licences.SPAN
    for k, here in enumerate(lines):
        if here:
            yield k, None, None, None, here
        if here and k + 1 < len(lines) and lines[k + 1]:
            stop = next((j for j in range(k + 1, len(lines)) if not lines[j]), len(lines))
            tail = [w for x in lines[k + 1:stop] for w in x][:span]
            yield k, lines[k - 1][-span:] if k else [], here[-span:], tail, here[-span:] + tail


def test_licences_against_every_line_and_line_end(spark, given):
    """All lines and line ends go through the classifier and the template comparison in plain Python."""
    rng = random.Random(5)
    notices = [t for texts in licences.TEMPLATES.values() for t in texts]
    prose = "the old river bank of the free software in this work under the terms and reserved rights all public house".split()
    texts = []
    for doc in range(150):
        pieces = [" ".join(rng.choices(prose, k=rng.randrange(1, 12))) if rng.random() < 0.6 else rng.choice(notices)
                  for _ in range(rng.randrange(1, 6))]
        tokens = rng.choice([" ", "\n", " \n\n "]).join(pieces).split(" ")
        texts.append((doc, "".join(t + rng.choice([" ", " ", " ", "\n"]) for t in tokens), "en", "a"))
    model = licences.fit(given)
    rows = [(doc, *row) for doc, text, _, _ in texts for row in every_line_and_line_end(text)]
    all_rows = spark.createDataFrame([(r[0], k, r[5] + [f"{a} {b}" for a, b in zip(r[5], r[5][1:])]) for k, r in enumerate(rows)],
                                     "doc_id long, row long, grams array<string>")
    expected = Counter()
    for r in model.classifier.transform(licences._features(all_rows)).select("row", "probability").collect():
        doc, paragraph, before, head, tail, tokens = rows[r.row]
        p = list(r.probability)
        best = max(range(1, len(p)), key=lambda i: p[i])
        family, likeness = licences.FAMILIES[best], shares(tokens, licences.FAMILIES[best])
        if p[best] < model.threshold:
            continue
        if head is not None and (likeness < licences.CONFIRMED or likeness <= max(shares(head, family), shares(tail, family))
                                 or likeness < shares(before + tokens, family)):
            continue
        expected[doc, paragraph, family, round(likeness, 9), likeness >= licences.CONFIRMED] += 1
    found = Counter((r.doc_id, r.paragraph, r.family, round(r.likeness, 9), r.confirmed) for r in licences.find(frame(spark, texts), model).collect())
    assert found == expected and len(expected) > 100 and any(k[4] for k in expected)


def test_licences_learn_from_every_document(spark):
    """Prose that looks like a notice is known as such wherever it stands in the table, not in the first ones by a hash only."""
    prose, notice = "the house is licensed under old rules", "Released under the MIT License."
    order = spark.range(1200).orderBy(F.xxhash64("id"), "id").collect()
    texts = [(r.id, "a quiet river\nand a hill" if k < 400 else f"{prose}\na quiet river", "en", "a") for k, r in enumerate(order)]
    given = frame(spark, [*texts, (1200, f"a hill\n{notice}", "en", "a")])
    model = licences.fit(given)
    rated = model.classifier.transform(licences._features(licences.paragraphs(frame(spark, [(1, prose, "en", "a")])))).first()
    assert rated.probability[0] > 0.9
    assert [(r.doc_id, r.paragraph, r.family, r.confirmed) for r in licences.find(given, model).collect()] == [(1200, 1, "mit", True)]


def test_licences_count_every_paragraph(spark, given):
    lines = [w for r in given.select("text").collect() for w in map(licences._plain_words, (r.text or "").split("\n")) if w]
    openings = [" ".join(licences._plain_words(t)[:licences.OPENING]) for texts in licences.TEMPLATES.values() for t in texts]
    plain = [w for w in lines if shares(w) < licences.CONFIRMED / 2 and not any(f" {o} " in f" {' '.join(w)} " for o in openings)]
    rows = licences.searched(given)
    assert rows.where("head is null").count() == len(lines)
    counted = licences._counted(rows)
    n = {bool(r.held): r.n for r in counted.groupBy((F.col("part") == 0).alias("held")).agg(F.sum("n").alias("n")).collect()}
    assert sum(n.values()) == len(plain)
    weights = {bool(r.named): r.weight for r in licences._examples(counted).groupBy((F.col("label") > 0).alias("named")).agg(F.sum("weight").alias("weight")).collect()}
    assert weights == {False: n[False], True: n[False] + len(licences._variants())}


def test_native_plans(spark, sf_dir, given):
    for df in (QUERIES["op7_sharding"](spark, sf_dir), licences.paragraphs(given), licences.blocks(given)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
