"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import arrow_schema, batch_of, map_batches
from tagloom.session import materialised

LINKS = "a long, b long"
MOST_ROUNDS = 60  # far beyond the logarithmic number of rounds that is needed


def contracted(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Links from the smallest node of each component to all its others."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent.setdefault(a, a)
        parent.setdefault(b, b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return [(root(x), x) for x in parent if root(x) != x]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(LINKS)
    for batch in batches:
        out = contracted(list(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())))
        yield batch_of(schema, [[x for x, _ in out], [y for _, y in out]])


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step; links go from the smaller to the larger node."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "_a")
    large = both.where("b > a").join(least, F.col("a") == F.col("_a")).select(F.col("m").alias("a"), "b").distinct()
    # Every larger node hangs on its smallest neighbour, and so do its other smaller neighbours.
    small = large.groupBy("b").agg(F.min("a").alias("m")).withColumnRenamed("b", "_b")
    moved = large.join(small, F.col("b") == F.col("_b")).select("m", "a", "b")
    pairs = moved.select(F.explode(F.array(F.struct(F.col("m").alias("a"), "b"), F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("p"))
    return pairs.select("p.a", "p.b").where("a < b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (``a``, ``b``): the smallest node it is connected with.

    Links are first contracted batch by batch, then stars are merged until nothing changes. Each round is a written table,
    so a lost executor costs no earlier round. Null ends and loops are ignored.
    """
    clean = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    current = materialised(map_batches(clean, _contract, LINKS), "links")
    last = None
    for _ in range(MOST_ROUNDS):
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
        current = materialised(_stars(current), "links")
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
