"""Near-duplicate groups with an LSH forest.

The set of a text is its distinct two-word shingles. Texts of equal sets form a
class, and one document stands for it. Every class has one signature for each
tree: a row of min-hash values. Each tree is the classes in the order of their
signatures; classes that share the longest beginnings lie next to each other, so
a scan over the order finds candidates, and how many values they must share
follows from how crowded the region is. A sketch of all values drops pairs that
cannot be similar; every link is confirmed on the full sets. Where more classes
share a beginning than the scan looks back on, their full sets are compared pair
by pair, in blocks of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import arrow_schema, batch_of, byte_strings, identified, map_batches, unused_name
from tagloom.llm.components import components, contracted
from tagloom.operators.joins import fits_broadcast, lookup_join, skew_join
from tagloom.session import materialised

TREES = 24
DEPTH = 8  # values of a signature
LEAST = 4  # values that candidates share at least
REACH = 32  # places of the order that are looked at
FAR_REACH = 64  # places among classes that have neighbours, for pairs of different groups
SIMILAR_PERCENT = 80
# Values of four bits in the sketches that drop unlike pairs, and how many must agree: fewer do in about one of a million pairs
# of similarity 0.8. The long sketch is for pairs of different groups, where nothing else keeps the pairs few; only classes
# that have neighbours get one.
SKETCH, SKETCH_LEAST = 64, 37
LONG_SKETCH, LONG_LEAST = 1024, 771
# Rows and shingles of a side of a block of full comparisons, and the rows a shingle must be in to be a column of its matrix.
BLOCK_ROWS, BLOCK_SHINGLES, COLUMN_ROWS = 1000, 500_000, 16
COLUMNS = 2048  # columns multiplied at once

SIGNATURES = "doc_id long, n_shingles long, digest binary, keys binary, sketch binary"
SETS = "node long, shingles array<long>, long_sketch binary"
PAIRS = "a long, b long, agree int"
SCANNED = PAIRS + ", run long"
LINKS = "a long, b long"

_RANDOM = np.random.default_rng(20240229)
_FACTORS = (_RANDOM.integers(0, 1 << 31, LONG_SKETCH, dtype=np.uint32) * 2 + 1).astype(np.uint32)
_TERMS = _RANDOM.integers(0, 1 << 32, LONG_SKETCH, dtype=np.uint32)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_set(text: bytes) -> np.ndarray:
    """Hashes of the distinct two-word shingles, in order; a single word is its own shingle."""
    import xxhash

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    if len(words) > 1:
        h = h[:-1] * _MIX + (h[1:] ^ (h[1:] >> np.uint64(29))) * _MIX2
    h ^= h >> np.uint64(32)
    return np.unique(h * _MIX)


def minima(shingles: np.ndarray, functions: int) -> np.ndarray:
    """The smallest value of each hash function over a set that is not empty, mixed."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(functions, 0xFFFFFFFF, np.uint32)
    # Blocks keep the table of values within the cache.
    for i in range(0, len(x), 512):
        np.minimum(low, (x[i:i + 512, None] * _FACTORS[:functions] + _TERMS[:functions]).min(0), low)
    return (low ^ (low >> np.uint32(15))) * np.uint32(0x85EBCA6B)


def packed(values: np.ndarray) -> bytes:
    """Four bits of every value, two values a byte."""
    nibbles = ((values >> np.uint32(12)) & 15).astype(np.uint8)
    return (nibbles[::2] << 4 | nibbles[1::2]).tobytes()


def signature(shingles: np.ndarray) -> tuple[bytes, bytes]:
    """Sort keys of all trees, 16 bits a value, and the short sketch."""
    values = minima(shingles, TREES * DEPTH + SKETCH)
    return (values[:TREES * DEPTH] >> np.uint32(16)).astype(">u2").tobytes(), packed(values[TREES * DEPTH:])


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Size, digest and signature of the set of every whole text; without words the last two are empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(SIGNATURES)
        for batch in batches:
            out = []
            for text in byte_strings(batch):
                shingles = shingle_set(text)
                signed = signature(shingles) if len(shingles) else (b"", b"")
                out.append((len(shingles), hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), *signed))
            yield batch_of(schema, [batch.column("doc_id"), *([row[k] for row in out] for k in range(4))])

    return map_batches(identified(docs, id_col, text_col), run, SIGNATURES)


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many four-bit values of two arrays of sketches agree."""
    x = a ^ b
    return ((x & 0xF0) == 0).sum(1) + ((x & 0x0F) == 0).sum(1)


def run_hashes(tree: np.ndarray, key: np.ndarray) -> np.ndarray:
    """One number for each run, the classes that share a tree's least beginning; two runs of one number only make a region larger."""
    beginning = np.ascontiguousarray(key[:, :LEAST]).view(">u8").ravel().astype(np.uint64)
    mixed = (beginning ^ (beginning >> np.uint64(29))) * _MIX + tree.astype(np.uint64) * _MIX2
    return (mixed ^ (mixed >> np.uint64(31))).view(np.int64)


def _in_order(batches: Iterator[pa.RecordBatch], reach: int, least: int, columns: tuple[str, ...] = ()):
    """Per batch of a tree's order: first new row, node and further columns, similar pairs of rows by distance, tree and key.

    A pair is ``(i, j, agree)`` with ``i`` in this batch and ``j`` up to ``reach`` places before it, perhaps in an earlier batch.
    One row more than these is held.
    """
    held = None
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        key = np.frombuffer(b"".join(batch.column("key").to_pylist()), ">u2").reshape(rows, DEPTH)
        sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(rows, -1)
        now = [batch.column("tree").to_numpy(), key, sketch, *(batch.column(c).to_numpy() for c in ("node", *columns))]
        before = 0 if held is None else len(held[0])
        if held is not None:
            now = [np.concatenate(pair) for pair in zip(held, now)]
        tree, key, sketch, *values = now
        at, pairs = np.arange(before, len(tree)), []
        for distance in range(1, reach + 1):
            i = at[at >= distance]
            j = i - distance
            same = (tree[i] == tree[j]) & (key[i, :LEAST] == key[j, :LEAST]).all(1)
            i, j = i[same], j[same]
            if not len(i):
                break
            agree = agreement(sketch[i], sketch[j])
            good = agree >= least
            pairs.append((i[good], j[good], agree[good]))
        yield before, values, pairs, tree, key
        held = [x[-reach - 1:] for x in now]


def long_runs(number: np.ndarray, before: int, reach: int) -> np.ndarray:
    """Rows to report as members of runs longer than ``reach``, from the runs' numbers in order, of which ``before`` are old.

    A row that is ``reach`` places behind the run's first one reports all rows so far, later ones report themselves.
    """
    at = np.arange(before, len(number))
    far = at[at >= reach]
    far = far[number[far] == number[far - reach]]
    opening = far[(far == reach) | (number[far - reach - 1] != number[far])] if len(far) else far
    return np.union1d(far, (opening[:, None] - np.arange(reach + 1)).ravel())


def _pairs_batch(a: np.ndarray, b: np.ndarray, agree: np.ndarray) -> pa.RecordBatch:
    return batch_of(arrow_schema(PAIRS), [np.minimum(a, b), np.maximum(a, b), agree.astype(np.int32)])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with its nearest and with its most similar earlier neighbour; other rows with neighbours by themselves.

    Rows of runs that the scan does not see whole are reported as well, with the run's number and no pair.
    """
    schema, opening, last, last_node = arrow_schema(SCANNED), None, None, None
    for before, (node,), pairs, tree, key in _in_order(batches, REACH, SKETCH_LEAST):
        nearest, best, agreed = (np.full(len(node), v, np.int64) for v in (-1, -1, 0))
        near_agreed = agreed.copy()
        for i, j, agree in pairs:
            first = nearest[i] < 0
            nearest[i[first]], near_agreed[i[first]] = j[first], agree[first]
            better = agree > agreed[i]
            best[i[better]], agreed[i[better]] = j[better], agree[better]
        near, other = np.flatnonzero(nearest >= 0), np.flatnonzero(best != nearest)
        touched = np.unique(np.concatenate([np.zeros(0, np.int64), *(np.concatenate(p[:2]) for p in pairs)])).astype(np.int64)
        alone = np.setdiff1d(touched, np.concatenate([near, nearest[near], other, best[other]]))
        a, b = node[np.concatenate([near, other, alone])], node[np.concatenate([nearest[near], best[other], alone])]
        agree = np.concatenate([near_agreed[near], agreed[other], np.zeros(len(alone), np.int64)]).astype(np.int32)
        yield batch_of(schema, [np.minimum(a, b), np.maximum(a, b), agree, pa.nulls(len(a), pa.int64())])
        number = run_hashes(tree, key)
        # The run that a part of the order begins with may go on from the part before, and the one it ends with into the next.
        opening = number[0] if opening is None else opening
        seen = np.union1d(long_runs(number, before, REACH), before + np.flatnonzero(number[before:] == opening))
        yield batch_of(schema, [node[seen], pa.nulls(len(seen), pa.int64()), pa.nulls(len(seen), pa.int32()), number[seen]])
        last, last_node = number, node
    if last is not None:
        # Members further back than the rows held are in a run that was reported as long.
        seen = np.flatnonzero(last == last[-1])
        yield batch_of(schema, [last_node[seen], pa.nulls(len(seen), pa.int64()), pa.nulls(len(seen), pa.int32()), last[seen]])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of rows in reach whose groups differ."""
    for _, (node, root), pairs, *_ in _in_order(batches, FAR_REACH, LONG_LEAST, ("root",)):
        found = [(i[apart], j[apart], agree[apart]) for i, j, agree in pairs for apart in [root[i] != root[j]]]
        empty = np.zeros(0, np.int64)
        i, j, agree = (np.concatenate(c) for c in zip((empty,) * 3, *found))
        yield _pairs_batch(node[i], node[j], agree)


def _trees(classes: DataFrame, *columns: str) -> DataFrame:
    """A row of every class for every tree."""
    width = 2 * DEPTH
    trees = classes.select("node", "keys", *columns, F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    return trees.select("tree", F.substring("keys", F.col("tree") * width + 1, F.lit(width)).alias("key"), "node", *columns)


def _ordered(rows: DataFrame) -> DataFrame:
    """The rows in the order of their trees' signatures."""
    return rows.repartitionByRange("tree", "key", "node").sortWithinPartitions("tree", "key", "node")


def scanned(classes: DataFrame) -> DataFrame:
    """One scan of all trees of the classes (``node``, ``keys``, ``sketch``): pairs that lie next to each other in some tree, and
    the members (``a``) of runs that are longer than the scan's reach, or perhaps are, with the run's number."""
    return map_batches(_ordered(_trees(classes, "sketch")), _neighbours, SCANNED)


def candidates(scan: DataFrame) -> DataFrame:
    """Pairs of classes from a scan. A class that has similar neighbours, but is in no such pair, comes as a pair with itself."""
    return scan.where("run is null").groupBy("a", "b").agg(F.max("agree").alias("agree"))


def candidates_across(classes: DataFrame, sketches: DataFrame) -> DataFrame:
    """All pairs of near classes (``node``, ``keys``, ``root``) whose groups so far differ.

    Only runs with two groups are scanned, so few sketches are moved.
    """
    rows = _trees(classes, "root").withColumn("run", F.xxhash64("tree", F.substring("key", 1, 2 * LEAST)))
    runs = rows.groupBy("run").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    mixed = lookup_join(rows, materialised(runs.select(F.col("run").alias("_run")), "runs"), "run", "_run", spread_by=["node"])
    mixed = mixed.join(sketches.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"))
    return map_batches(_ordered(mixed.select("tree", "key", "node", "sketch", "root")), _across, PAIRS).select("a", "b").distinct()


def crowded(scan: DataFrame, roots: DataFrame, reach: int = REACH) -> DataFrame:
    """``(node, region)`` of the classes in a run longer than ``reach`` that is not one group (``roots``) already.

    A run is the classes that share the least beginning in one tree; runs with a class in common are of one region, so two
    classes of one run are compared once, however many runs they share.
    """
    members = scan.where("run is not null").select(F.col("a").alias("node"), "run").distinct()
    rows = members.join(roots.select(F.col("node").alias("_node"), "root"), F.col("node") == F.col("_node"), "left").select(
        "node", "run", F.coalesce("root", "node").alias("root"))
    rows = materialised(rows, "runs")
    runs = rows.groupBy("run").agg(F.count("*").alias("n"), F.min("node").alias("head"), F.min("root").alias("low"), F.max("root").alias("high"))
    runs = materialised(runs.where((F.col("n") > reach) & (F.col("low") < F.col("high"))).select(F.col("run").alias("_run"), "head"), "runs")
    members = lookup_join(rows, runs, "run", "_run", spread_by=["node"])
    return components(members.select(F.col("head").alias("a"), F.col("node").alias("b"))).withColumnRenamed("root", "region")


def common_shingles(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of ``left`` shares with each of ``right``."""
    sizes = np.fromiter(map(len, left + right), np.int64)
    row, n = np.repeat(np.arange(len(sizes)), sizes), len(left)
    _, code, times = np.unique(np.concatenate(left + right), return_inverse=True, return_counts=True)
    counts = np.zeros((n, len(right)), np.float32)
    # Shingles of few rows: the entries of one shingle lie together, and every two of them meet at some distance.
    rare = np.flatnonzero((times[code] > 1) & (times[code] < COLUMN_ROWS))
    rare = rare[np.argsort(code[rare], kind="stable")]
    for distance in range(1, COLUMN_ROWS - 1):
        a, b = rare[:-distance], rare[distance:]
        pair = (code[a] == code[b]) & (row[a] < n) & (row[b] >= n)
        np.add.at(counts, (row[a[pair]], row[b[pair]] - n), 1)
    # The others: products of slices of the table of rows by shingles.
    column = np.cumsum(times >= COLUMN_ROWS) - 1
    often = times[code] >= COLUMN_ROWS
    row, column = row[often], column[code[often]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        i, j = np.searchsorted(column, [start, start + COLUMNS])
        held = np.zeros((len(sizes), min(COLUMNS, int(column[-1]) + 1 - start)), np.float32)
        held[row[i:j], column[i:j] - start] = 1
        counts += held[:n] @ held[n:].T
    return counts.astype(np.int64)


def _block(block: pa.Table) -> pa.Table:
    """Links that join all groups with a similar pair in a block; every two rows of different sides are compared."""
    block = block.sort_by("node")
    root, chunk = block.column("root").to_numpy(), block.column("chunk").to_numpy()
    flat = block.column("shingles").combine_chunks()
    ends = flat.offsets.to_numpy()
    values = flat.values.to_numpy()
    sets = [values[i:j] for i, j in zip(ends, ends[1:])]
    x, y = block.column("x")[0].as_py(), block.column("y")[0].as_py()
    left, right = np.flatnonzero(chunk == x), np.flatnonzero(chunk == y)
    out = []
    if len(left) and len(right):
        common = common_shingles([sets[i] for i in left], [sets[i] for i in right])
        sizes = np.fromiter(map(len, sets), np.int64)
        total = sizes[left][:, None] + sizes[right][None, :]
        similar = (100 * common >= SIMILAR_PERCENT * (total - common)) & (root[left][:, None] != root[right][None, :])
        i, j = np.nonzero(similar)
        out = contracted(list(set(zip(root[left[i]].tolist(), root[right[j]].tolist()))))
    return pa.Table.from_batches([batch_of(arrow_schema(LINKS), [[a for a, _ in out], [b for _, b in out]])])


def links_within(regions: DataFrame, sets: DataFrame, roots: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links between the groups (``roots``) of each region, from all pairs of its full sets whose groups differ.

    The rows of a region are dealt to chunks, and every two chunks are a block; rows of the region's largest group are in
    chunks of their own, which do not meet each other.
    """
    rows = regions.join(sets.select(F.col("node").alias("_set"), "shingles"), F.col("node") == F.col("_set")).join(
        roots.select(F.col("node").alias("_node"), "root"), F.col("node") == F.col("_node"), "left")
    rows = materialised(rows.select("region", "node", F.coalesce("root", "node").alias("root"), "shingles"), "regions")
    share = F.sum(F.size("shingles") / F.lit(float(BLOCK_SHINGLES)) + F.lit(1.0 / block_rows))
    of_root = rows.groupBy("region", "root").agg(share.alias("share"), F.count("*").alias("n"))
    sides = of_root.groupBy("region").agg(F.max(F.struct("n", "root", "share")).alias("main"), F.sum("share").alias("share"))
    chunks = materialised(sides.select(F.col("region").alias("_region"), F.col("main.root").alias("main"), F.ceil("main.share").alias("n_main"),
                                       F.ceil(F.col("share") - F.col("main.share") + F.lit(1e-6)).alias("n_other")), "chunks")
    dealt = lookup_join(rows, chunks, "region", "_region", spread_by=["node"])
    in_main, at = F.col("root") == F.col("main"), F.xxhash64("node")
    chunk = F.when(in_main, F.pmod(at, "n_main")).otherwise(F.col("n_main") + F.pmod(at, "n_other"))
    others = F.sequence(F.when(in_main, F.col("n_main")).otherwise(F.lit(0)), F.col("n_main") + F.col("n_other") - 1)
    dealt = dealt.withColumn("chunk", chunk).withColumn("other", F.explode(others)).select(
        "region", "node", "root", "shingles", "chunk", F.least("chunk", "other").alias("x"), F.greatest("chunk", "other").alias("y"))
    return dealt.groupBy("region", "x", "y").applyInArrow(_block, LINKS)


def sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Sets and long sketches of the documents whose id is in ``nodes``, which have words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(SETS)
        for batch in batches:
            found = [shingle_set(t) for t in byte_strings(batch)]
            sketches = [packed(minima(x, LONG_SKETCH)) for x in found]
            yield batch_of(schema, [batch.column("doc_id"), [x.view(np.int64) for x in found], sketches])

    wanted = docs.join(nodes.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return map_batches(wanted.select("doc_id", "text"), run, SETS)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    left, right = (sets.select(F.col("node").alias(f"_{x}"), F.col("shingles").alias(f"s{x}")) for x in "ab")
    both = pairs.join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b"))
    common = F.size(F.array_intersect("sa", "sb"))
    counted = both.select("a", "b", common.alias("common"), (F.size("sa") + F.size("sb")).alias("total"))
    return counted.where(100 * F.col("common") >= SIMILAR_PERCENT * (F.col("total") - F.col("common"))).select("a", "b")


def _classes(signed: DataFrame) -> DataFrame:
    grouped = signed.where("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(
        F.min(F.struct("doc_id", "keys", "sketch")).alias("first"), F.count("*").alias("n_docs"))
    return grouped.select("digest", F.col("first.doc_id").alias("node"), "first.keys", "first.sketch", "n_docs")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The groups with further links; the groups so far stand for their links."""
    if not links.take(1):
        return roots
    stars = roots.where("root < node").select(F.col("root").alias("a"), F.col("node").alias("b"))
    return components(stars.unionByName(links.select("a", "b")))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: size of its set, the smallest id of its group, and whether it is that document.

    Texts are linked if their sets share 80 % of their union. Null and empty texts have no set and are alone; a single word
    is a set of one; rows of one id are one document; a null id is alone, with a null group, and kept. Equal texts cost one
    signature in the forest however many there are. An empty table gives no rows; further columns are ignored.
    """
    rows = identified(docs, id_col, text_col)
    signed = materialised(signatures(rows), "signatures")
    classes = materialised(_classes(signed), "classes")
    scan = materialised(scanned(classes.select("node", "keys", "sketch")), "scan")
    pairs = materialised(candidates(scan), "candidates")
    nodes = materialised(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    sets = materialised(sets_of(rows, nodes), "sets")
    links = materialised(confirmed(pairs.where("a < b"), sets), "confirmed")
    roots = components(links)
    # Where the neighbours in reach are not all, the groups they have not joined are compared in full.
    regions = materialised(crowded(scan, roots), "regions")
    if regions.take(1):
        further = materialised(sets_of(rows, regions.select("node").join(nodes, "node", "left_anti")), "sets")
        roots = _joined(roots, materialised(links_within(regions, sets.unionByName(further), roots), "within"))
    # What the neighbours have not joined is looked at once more, pair by pair, among the classes that have neighbours.
    sketched = sets.select("node", F.col("long_sketch").alias("sketch"))
    near = classes.select("node", "keys").join(nodes, "node").join(roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select(
        "node", "keys", F.coalesce("root", "node").alias("root"))
    more = candidates_across(near, sketched).join(pairs, ["a", "b"], "left_anti")
    # Classes of one region have been compared.
    ends = [regions.select(F.col("node").alias(x), F.col("region").alias(f"region_{x}")) for x in "ab"]
    more = more.join(ends[0], "a", "left").join(ends[1], "b", "left").where("not coalesce(region_a = region_b, false)").select("a", "b")
    more = materialised(more, "across")
    roots = _joined(roots, materialised(confirmed(more, sets), "confirmed")).withColumnRenamed("node", "_node")
    # Only classes of several documents or with links say anything beyond the document itself.
    joined = classes.select("digest", "node", "n_docs").join(roots, F.col("node") == F.col("_node"), "left")
    telling = joined.where("n_docs > 1 or root is not null").groupBy(F.col("digest").alias("_digest")).agg(
        F.min(F.coalesce("root", "node")).alias("root"))
    found = skew_join(signed.select("doc_id", "n_shingles", "digest"), telling, "digest", "_digest", "left", spread_by=["doc_id"])
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, of which one document of each group stays; one row of each id.

    Texts without words are like no others and stay, and so do all rows with a null id; an empty table gives no rows; columns
    may have any names.
    """
    own = unused_name(docs, "_gone")
    found = materialised(groups(docs, id_col, text_col), "groups").where("doc_id is not null")
    gone = found.where("not kept").select(F.col("doc_id").alias(own)).distinct()
    # Sent to the tasks below a measured bound, as else all texts are shuffled to lose a few of them.
    gone = F.broadcast(gone) if fits_broadcast(gone) else gone
    repeated = F.col(f"`{id_col}`").cast("long") == F.col(own)
    kept = docs.join(gone, repeated, "left_anti")
    again = materialised(found.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(own)), "again")
    if not again.take(1):
        return kept
    once = kept.join(again, repeated, "left_semi").dropDuplicates([id_col])
    return kept.join(again, repeated, "left_anti").unionByName(once)
