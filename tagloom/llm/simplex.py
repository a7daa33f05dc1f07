"""Centroid clustering with exact integer distances behind an n-simplex projection.

A few vectors are pivots. The distances of any vector to them place it as the
apex of a simplex over the pivots, a point with one coordinate for each pivot.
The distance of two such points is never more than that of the vectors, and with
the last coordinate turned over it is never less. Pivot distances are measured
once and kept with the vectors; in every round the bounds leave a few centroids
for each vector, and exact integer arithmetic decides among these.

A round is one pass over the vectors: every task sums up its own vectors, so a
cluster has one row a task however many vectors it holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import arrow_schema, batch_of, map_batches
from tagloom.session import local_frame, materialised

DIMENSIONS, SCALE = 64, 64
CENTROIDS, ROUNDS = 16, 3
PIVOTS = 8
PIVOT_SAMPLE = 128  # vectors, first by hash, that pivots are picked from
FLAT = 1e-2  # a pivot closer than this share of its distance to the span of those before it is not taken
SLACK = 1e-6  # relative error that the bounds allow for
EXACT = 1 << 22  # components below it have squared distances that a double holds exactly
LONG = (1 << 63) - 1

VECTORS = "vec_id long, v array<double>, apex array<double>"
SUMS = "cluster int, n long, sums array<string>"
PLACED = "vec_id long, cluster int, distance long"


def kept_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, v)``: vectors with all components, none null or not finite, as doubles."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x))
    return rows.where((F.size("v") == dimensions) & finite)


def stepped(v: np.ndarray, scale: int) -> np.ndarray:
    """Components as integers, in doubles, which hold any floor of a double exactly."""
    return np.floor(v * float(scale))


def unbounded(v: np.ndarray) -> np.ndarray:
    """As Python's integers, which have any size."""
    out = np.empty(v.shape, object)
    out[...] = [[int(x) for x in row] for row in v.tolist()]
    return out


def whole(v: np.ndarray) -> np.ndarray:
    """Integers whose sums and squares stay exact."""
    return v if not v.size or np.abs(v).max() < EXACT else unbounded(v)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of two arrays, exact."""
    a, b = whole(a), whole(b)
    if object in (a.dtype, b.dtype):
        a, b = unbounded(a), unbounded(b)
    difference = a - b
    return (difference * difference).sum(1)


def pivot_distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        return np.stack([((v - p) ** 2).sum(1) for p in pivots], 1) if len(pivots) else np.zeros((len(v), 0))


def base(pivots: np.ndarray) -> np.ndarray:
    """Coordinates of the pivots after the first, which is the origin, from their mutual distances: a lower triangle."""
    d = pivot_distances(pivots, pivots)
    gram = (d[1:, :1] + d[:1, 1:] - d[1:, 1:]) / 2
    return np.linalg.cholesky(gram)


def apex(distances: np.ndarray, corners: np.ndarray) -> np.ndarray:
    """Apex coordinates of the vectors with these squared distances to the pivots; the last one is the height over them all."""
    if not distances.shape[1]:
        return np.zeros((len(distances), 1))
    with np.errstate(all="ignore"):
        flat = np.zeros((len(distances), len(corners)))
        sides = (distances[:, :1] - distances[:, 1:] + (corners ** 2).sum(1)) / 2
        for i in range(len(corners)):
            flat[:, i] = (sides[:, i] - flat[:, :i] @ corners[i, :i]) / corners[i, i]
        height = np.sqrt(np.maximum(distances[:, 0] - (flat ** 2).sum(1), 0))
    return np.column_stack([flat, height])


def bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances between the vectors of two sets of apexes."""
    with np.errstate(all="ignore"):
        flat = sum(((a[:, None, i] - b[None, :, i]) ** 2 for i in range(a.shape[1] - 1)), np.zeros((len(a), len(b))))
        near, far = a[:, None, -1] - b[None, :, -1], a[:, None, -1] + b[None, :, -1]
        return np.sqrt(flat + near ** 2), np.sqrt(flat + far ** 2)


def pick_pivots(sample: np.ndarray, most: int = PIVOTS) -> np.ndarray:
    """Far apart vectors that span a simplex which is nowhere nearly flat; none if all are equal."""
    if not len(sample):
        return sample[:0]
    with np.errstate(all="ignore"):
        taken, residue, total = [0], sample - sample[0], ((sample - sample[0]) ** 2).sum(1)
        while len(taken) < min(most, sample.shape[1] + 1):
            height = (residue ** 2).sum(1)
            height[~np.isfinite(height)] = 0
            i = int(np.argmax(height))
            if height[i] <= FLAT ** 2 * total[i] or not height[i] > 0:
                break
            axis = residue[i] / np.sqrt(height[i])
            residue = residue - (residue @ axis)[:, None] * axis
            taken.append(i)
    return sample[taken] if len(taken) > 1 else sample[:0]


class Assigner:
    """The nearest centroid of vectors, the smaller number on a tie, and the exact squared distance."""

    def __init__(self, centroids: list[list[int]], pivots: np.ndarray):
        self.centroids = np.empty((len(centroids), len(centroids[0])), object)
        self.centroids[...] = centroids
        near = self.centroids.astype(float)
        self.centroids = near if np.abs(near).max() < EXACT else self.centroids
        self.apexes = apex(pivot_distances(near, pivots), base(pivots) if len(pivots) else np.zeros((0, 0)))

    def candidates(self, apexes: np.ndarray) -> np.ndarray:
        """Which centroids the bounds leave for each vector."""
        low, high = bounds(apexes, self.apexes)
        scale = np.abs(apexes).max(1) + np.abs(self.apexes).max()
        with np.errstate(all="ignore"):
            return ~(low > (high.min(1) + SLACK * (1 + scale))[:, None])

    def __call__(self, v: np.ndarray, apexes: np.ndarray) -> tuple[np.ndarray, list[int]]:
        i, j = np.nonzero(self.candidates(apexes))
        exact = squared(v[i], self.centroids[j])
        order = np.lexsort((j, exact, i)) if exact.dtype != object else np.array(sorted(range(len(i)), key=lambda x: (i[x], exact[x], j[x])), np.int64)
        first = order[np.concatenate([[True], i[order][1:] != i[order][:-1]])] if len(order) else order
        return j[first].astype(np.int32), [int(x) for x in exact[first]]


def _array(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _placed(assign: Assigner):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(PLACED)
        for batch in batches:
            if batch.num_rows:
                cluster, distance = assign(_array(batch, "v"), _array(batch, "apex"))
                yield batch_of(schema, [batch.column("vec_id"), cluster, [d if d <= LONG else None for d in distance]])

    return run


def _summed(assign: Assigner):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = {}, {}
        for batch in batches:
            if batch.num_rows:
                v = _array(batch, "v")
                cluster, _ = assign(v, _array(batch, "apex"))
                for c in np.unique(cluster).tolist():
                    own = whole(v[cluster == c])
                    n[c] = n.get(c, 0) + len(own)
                    sums[c] = [a + int(b) for a, b in zip(sums.get(c, [0] * v.shape[1]), own.sum(0))]
        yield batch_of(arrow_schema(SUMS), [list(n), list(n.values()), [list(map(str, sums[c])) for c in n]])

    return run


def _total(sums: pa.Table) -> pa.Table:
    """One cluster's sums of all tasks."""
    total = [sum(map(int, column)) for column in zip(*sums.column("sums").to_pylist())]
    row = [[sums.column("cluster")[0].as_py()], [sum(sums.column("n").to_pylist())], [list(map(str, total))]]
    return pa.Table.from_batches([batch_of(arrow_schema(SUMS), row)])


def cluster(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE,
            pivots: int = PIVOTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per kept vector: its cluster, squared distance, the sums of these, and a digest of its centroid.

    Components become ``floor(scale * x)``. The first centroids are the vectors with the smallest digests of their ids (of one
    id, the smaller components first; a null id is an empty one), fewer if there are fewer vectors. Vectors of another length or
    with a null or not finite component are left out; repeated rows all count; an empty table gives no rows; an empty cluster
    keeps its centroid; further columns are ignored. Integers of any size stay exact; a distance or sum beyond 64 bits is null.
    """
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, dimensions, id_col, vector_col)
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    # A bounded number of rows: the first centroids, and the sample that pivots are picked from.
    first = [r["v"] for r in kept.orderBy(digest, "v").limit(max(centroids, PIVOT_SAMPLE)).collect()]
    sample = stepped(np.array(first, float).reshape(len(first), dimensions), scale)
    centres, picked = [[int(x) for x in v] for v in sample[:centroids]], pick_pivots(sample, pivots)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, corners = arrow_schema(VECTORS), base(picked) if len(picked) else np.zeros((0, 0))
        for batch in batches:
            if batch.num_rows:
                v = stepped(_array(batch, "v"), scale)
                yield batch_of(schema, [batch.column("vec_id"), list(v), list(apex(pivot_distances(v, picked), corners))])

    table = materialised(map_batches(kept, measured, VECTORS), "vectors")
    if not len(centres):
        return local_frame(spark, [], PLACED + ", cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        sums = map_batches(table, _summed(Assigner(centres, picked)), SUMS)
        # One row per centroid.
        for row in sums.groupBy("cluster").applyInArrow(_total, SUMS).collect():
            centres[row["cluster"]] = [int(s) // row["n"] for s in row["sums"]]
    placed = materialised(map_batches(table, _placed(Assigner(centres, picked)), PLACED), "placed")
    # One row per centroid again; a sum with a distance that has no place in 64 bits is null.
    totals = {r["cluster"]: None if r["lost"] else int(r["total"]) for r in placed.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"), F.count_if(F.col("distance").isNull()).alias("lost")).collect()}
    whole_sum = None if None in totals.values() else sum(totals.values())
    rows = [(c, *(x if x is not None and x <= LONG else None for x in (total, whole_sum)),
             hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()) for c, total in sorted(totals.items())]
    told = local_frame(spark, rows, "_cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(told), F.col("cluster") == F.col("_cluster")).drop("_cluster")


def oracle(centroids: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE) -> str:
    """The same in SQL: one step for each round."""
    steps = [f"""kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimensions}),
      c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) AS INTEGER) - 1 AS cluster, v
          FROM kept QUALIFY cluster < {centroids})"""]
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS MATERIALIZED (SELECT k.vec_id, k.v, c.cluster, CAST(list_sum(list_transform(list_zip(k.v, c.v),
                lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS BIGINT) AS distance FROM kept k CROSS JOIN c{r} c
            QUALIFY row_number() OVER (PARTITION BY k.vec_id, k.v ORDER BY distance, c.cluster) = 1)""")
        if r < rounds:
            steps.append(f"""s{r} AS (SELECT cluster, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM
                (SELECT cluster, unnest(v) AS x, unnest(range({dimensions})) AS i FROM d{r}) GROUP BY cluster, i),
              m{r} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{r} GROUP BY cluster),
              c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m USING (cluster))""")
    return f"""WITH {", ".join(steps)}
      SELECT d.vec_id, d.cluster, d.distance, CAST(sum(d.distance) OVER (PARTITION BY d.cluster) AS BIGINT) AS cluster_inertia,
             CAST(sum(d.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
      FROM d{rounds} d JOIN c{rounds} c USING (cluster)"""
