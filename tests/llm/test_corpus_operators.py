"""Substring removal, source divergence and centroid clustering against brute force, and their edge cases."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from oracle import connect, difference

from tagloom.llm import divergence, doubling, simplex
from tagloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ["op11_substrings", "op12_divergence", "op13_centroids"])
def test_queries_equal_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None


# --- substrings -------------------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, chunk long, n_words long, removed string, level int"


def texts(spark, rows):
    return spark.createDataFrame([(i, t, "en", "a", 7, 7, "x", 7) for i, t in rows], DOCS)


def brute_removal(rows, window):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = Counter()
    for (doc_id, _), w in zip(rows, split):
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        out[doc_id, " ".join(x for i, x in enumerate(w) if i not in gone), len(w), len(gone)] += 1
    return out


def many_texts():
    rng = np.random.default_rng(21)
    words = lambda n, k=5000: " ".join(f"w{x}" for x in rng.integers(0, k, n))
    passage, long_ = words(60), words(9000)
    rows = [(i, f"{words(30)} {passage} {words(int(rng.integers(0, 50)))}") for i in range(40)]
    rows += [(100 + i, words(50)) for i in range(20)] + [(200 + i, words(300, 3)) for i in range(5)]
    rows += [(300, long_), (301, long_.replace(" ", "\n\t ")), (302, words(20) + " " + " ".join(long_.split()[500:534])), (303, " ".join(long_.split()[500:535]))]
    rows += [(None, passage), (None, passage), (5, rows[5][1]), (5, rows[5][1]), (400, None), (401, ""), (402, " \n "), (403, "a"), (404, "a b " * 200),
             (405, "É " * 34), (406, "É " * 35), (407, "É " * 35 + "x"), (408, "\x1c\x85 " * 40)]
    return rows


@pytest.mark.parametrize("window", [1, 2, 3, 10, 35, 41])
def test_removal_against_brute_force(spark, window):
    rows = many_texts()
    expected = brute_removal(rows, window)
    for size in (1 << 30, 20_000):
        found = doubling.without_repeats(texts(spark, rows), window, chunk_bytes=size, bucket_bytes=size).collect()
        assert Counter((r.doc_id, r.text, r.n_words, r.n_removed) for r in found) == expected
        assert all(sum(b - a for a, b in zip(r.removed[::2], r.removed[1::2])) == r.n_removed for r in found)
    assert doubling.without_repeats(texts(spark, []), window).count() == 0


def test_one_word_many_times(spark):
    """A text longer than a piece, and a run of windows that overlap themselves."""
    rows = [(1, "same " * 300_000 + " ".join(f"w{i}" for i in range(60)))]
    (found,) = doubling.without_repeats(texts(spark, rows)).collect()
    assert (found.n_words, found.n_removed, found.removed) == (300_060, 300_000, [0, 300_000]) and found.text.startswith("w0 w1")


def test_levels_and_packing():
    assert doubling.lengths(35) == [9, 18, 35] and doubling.lengths(1) == [1] and doubling.lengths(20, 4) == [3, 5, 10, 20]
    rng = np.random.default_rng(4)
    for n in (0, 1, 64, 65, 4096, 4097, 30_000):
        values = np.unique(rng.integers(0, 1 << 32, n, dtype=np.uint64))
        assert (doubling.unpack_hashes(doubling.pack_hashes(values), len(values)) == values).all()
    words = rng.integers(0, 3, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for length in (1, 2, 7, 35):
        seen = defaultdict(set)
        for i, h in enumerate(doubling.windows_of(words, length).tolist()):
            seen[tuple(words[i:i + length].tolist())].add(h)
        assert all(len(h) == 1 for h in seen.values()) and len(set().union(*seen.values())) == len(seen)
    text = b"ab \n cd  e\tf" * 50
    assert b" ".join(p for piece in doubling.pieces(text, 10) for p in piece.split()).split() == text.split()


def test_texts_are_shuffled_once(spark, sf_dir):
    found = QUERIES["op11_substrings"](spark, sf_dir)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 2


# --- divergence -------------------------------------------------------------------------------------------------

def brute_divergence(rows, least, top):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
            for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        within = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in within.items() if n >= least)
        counts = {s: Counter() for s in {d[1] for d in own}}
        for _, source, terms in own:
            counts[source].update(t for t in terms if t in within and within[t] >= least)

        def shares(c, v=len(kept), kept=kept):
            return {t: 1 + 10 ** 9 * (c[t] + 5) // (sum(c.values()) + 5 * v) for t in kept}

        q, p = shares(sum(counts.values(), Counter())), {s: shares(c) for s, c in counts.items()}
        for s in counts:
            pair = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in counts if o != s)
            term = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if counts[s][t] and p[s][t] > q[t])[:top]
            for part, listed in (("pair", pair), ("term", term)):
                out += [(lang, s, part, item, -value, k + 1) for k, (value, _, item) in enumerate(listed)]
    return Counter(out)


@pytest.mark.parametrize("cells,block", [(divergence.SHARD_CELLS, divergence.BLOCK_SOURCES), (40, 3)])
def test_divergence_against_brute_force(spark, monkeypatch, cells, block):
    rng = np.random.default_rng(6)
    terms = ["a", "Bc", "É", "é", "ÀÀ", "世界", "x1y", "don't", "\U0001f600", *(f"t{chr(97 + i)}" for i in range(20))]
    rows = [(" ".join(rng.choice(terms, 12)), str(rng.choice(["en", "de", ""])), str(rng.choice(["s1", "s2", "S", "é", "z", "￿", "\U00010000"]))) for _ in range(300)]
    rows += [(None, None, None), ("", "en", ""), ("a a", None, "s1"), ("lonely words", "xx", "one"), ("other", "yy", "one"), ("other words", "yy", "two"), rows[0], rows[0]]
    docs = spark.createDataFrame([(*r, 0, "x", 0) for r in rows], "text string, lang string, source string, n long, term string, value int")
    monkeypatch.setattr(divergence, "PARTIAL_ROWS", 50)
    monkeypatch.setattr(divergence, "SHARD_CELLS", cells)
    for top in (50, 3):
        found = divergence.audit(docs, 30, top)
        assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert Counter(map(tuple, found.collect())) == brute_divergence(rows, 30, top)
    assert divergence.audit(docs.limit(0)).count() == 0
    shares = spark.createDataFrame([("l", f"s{i}", f"t{j}", 10 + i * j % 7) for i in range(12) for j in range(i % 5, 30)], "lang string, source string, term string, p long")
    groups = spark.createDataFrame([("l", f"s{i}", 12, 30, i % 3) for i in range(12)], "lang string, source string, sources long, v long, absent long")
    p = {(r.source, r.term): r.p for r in shares.collect()}
    expected = {("l", f"s{a}", f"s{b}", sum(abs(p.get((f"s{a}", f"t{j}"), a % 3) - p.get((f"s{b}", f"t{j}"), b % 3)) for j in range(30)))
                for a in range(12) for b in range(12) if a != b}
    assert set(map(tuple, divergence.source_pairs(shares, groups, cells, block).collect())) == expected


def test_large_counts_stay_exact(spark):
    row = spark.createDataFrame([(10 ** 15 + 7, 3 * 10 ** 16 + 1, 10 ** 7)], "n long, total long, v long").select(
        divergence.share(*(divergence.F.col(c) for c in ("n", "total", "v"))).alias("p")).first()
    assert row.p == 1 + 10 ** 9 * (10 ** 15 + 12) // (3 * 10 ** 16 + 1 + 5 * 10 ** 7)


# --- centroids --------------------------------------------------------------------------------------------------

def brute_clusters(rows, centroids, rounds, dimensions, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    centres = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:centroids]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(own[k]) for x in zip(*own[k])] if k in own else c for k, c in enumerate(centres)]
    placed = [(i, *nearest(v)[::-1]) for i, v in kept]
    totals = Counter()
    for _, k, d in placed:
        totals[k] += d
    fits = lambda x: x if x < 1 << 63 else None
    return Counter((i, k, fits(d), None if any(fits(e) is None for _, j, e in placed if j == k) else fits(totals[k]),
                    None if any(fits(e) is None for *_, e in placed) else fits(sum(totals.values())),
                    hashlib.sha256(",".join(map(str, centres[k])).encode()).hexdigest()) for i, k, d in placed)


@pytest.mark.parametrize("kind", ["spread", "equal", "few", "line", "large", "huge", "ties"])
def test_clusters_against_brute_force(spark, kind):
    rng = np.random.default_rng(12)
    make = {"spread": lambda: rng.normal(0, 1, (400, 6)) + rng.integers(0, 4, (400, 1)), "equal": lambda: np.ones((30, 6)), "few": lambda: rng.normal(0, 1, (3, 6)),
            "line": lambda: rng.normal(0, 1, (200, 1)) * np.arange(6), "large": lambda: rng.normal(0, 1e6, (150, 6)), "huge": lambda: rng.normal(0, 1e30, (60, 6)),
            "ties": lambda: rng.integers(-1, 2, (300, 6)) / 64.0}[kind]
    rows = [(i, v.tolist()) for i, v in enumerate(make())]
    rows += [rows[0], rows[0], (None, rows[1][1]), (None, None), (900, None), (901, []), (902, [0.0] * 5), (903, [0.0] * 7), (904, [0.0] * 5 + [None]),
             (905, [math.nan] * 6), (906, [math.inf] + [0.0] * 5), (907, [-math.inf] + [0.0] * 5)]
    vectors = spark.createDataFrame([(*r, 3, 4) for r in rows], "vec_id long, embedding array<double>, cluster int, apex int")
    found = simplex.cluster(vectors, 8, 3, 6)
    assert Counter(map(tuple, found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect())) == brute_clusters(rows, 8, 3, 6)


def test_no_vectors(spark):
    empty = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")
    assert simplex.cluster(empty).count() == 0 and simplex.cluster(empty.limit(0)).columns[-1] == "centroid_sha256"


def test_bounds_hold_and_leave_few_out_of_doubt():
    rng = np.random.default_rng(13)
    v = simplex.stepped(rng.normal(0, 0.3, (500, 64)) + rng.integers(0, 2, (500, 1)) * 2, 64)
    pivots = simplex.pick_pivots(v[:100])
    assert len(pivots) == simplex.PIVOTS
    apexes = simplex.apex(simplex.pivot_distances(v, pivots), simplex.base(pivots))
    low, high = simplex.bounds(apexes[:400], apexes[400:])
    exact = np.sqrt(((v[:400, None] - v[None, 400:]) ** 2).sum(2))
    assert (low <= exact + 1e-6).all() and (exact <= high + 1e-6).all()
    assert simplex.Assigner([[int(x) for x in c] for c in v[400:416]], pivots).candidates(apexes[:400]).mean() < 0.9
    assert len(simplex.pick_pivots(np.ones((5, 3)))) == 0
