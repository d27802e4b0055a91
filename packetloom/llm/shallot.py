"""Exact k-means of whole-number vectors by Shallot search.

Every vector carries its centroid, its second-nearest centroid, an upper bound of its distance to the first and a lower
bound of its distance to all others. Bounds move with the centroids; a vector whose bounds still part keeps its centroid
without a look at it. Otherwise the search starts from the closer of the two remembered centroids and walks through that
one's neighbours, nearest first, inside a ball that shrinks whenever something closer turns up. Bounds are floats with a
margin and only leave out what cannot win; what is left is compared in integers, so ties go to the smaller number and the
result is that of the plain method.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.session import delete, settle

CLUSTERS, DIMENSIONS, ROUNDS, SCALE, SEED = 8, 64, 10, 1024, 3
#: Relative margin of the bounds, far above the error of a float distance.
MARGIN = 1e-9
#: Rows that are compared at a time.
SLICE = 4096
STATE = "vector binary, cluster int, second int, upper double, lower double"


def limit(dims: int) -> int:
    """Components stay below this, so that a squared distance fits a long."""
    return 1 << ((61 - max(dims - 1, 1).bit_length()) // 2)


@dataclass(frozen=True)
class Centroids:
    """Centroids of a round, how far each moved in it, and the neighbours of each by distance."""

    points: np.ndarray
    moved: np.ndarray
    neighbours: np.ndarray
    apart: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray, before: np.ndarray | None = None) -> Centroids:
        apart = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2).astype(np.float64))
        order = np.argsort(apart, axis=1, kind="stable")
        # a centroid at the same place may come before the centroid itself
        order = np.asarray([[j for j in row if j != i] for i, row in enumerate(order)], np.int64).reshape(len(points), -1)
        moved = np.zeros(len(points)) if before is None else np.sqrt(((points - before) ** 2).sum(axis=1).astype(np.float64))
        return cls(points, moved * (1 + MARGIN), order, np.take_along_axis(apart, order, axis=1))


def squared(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    return ((vectors - points) ** 2).sum(axis=1)


def search(vectors: np.ndarray, cluster: np.ndarray, second: np.ndarray, now: Centroids) -> tuple[np.ndarray, ...]:
    """Nearest and second-nearest centroid of every vector and both squared distances (ties: the smaller number first)."""
    near, far = cluster.copy(), second.copy()
    d_near, d_far = squared(vectors, now.points[near]), squared(vectors, now.points[far])

    def order(rows: np.ndarray) -> None:
        swap = rows[(d_far[rows] < d_near[rows]) | ((d_far[rows] == d_near[rows]) & (far[rows] < near[rows]))]
        near[swap], far[swap] = far[swap], near[swap]
        d_near[swap], d_far[swap] = d_far[swap], d_near[swap]

    everyone = np.arange(len(vectors))
    order(everyone)
    start, radius = near.copy(), np.sqrt(d_near.astype(np.float64))
    other = far.copy()
    active = everyone
    for place in range(now.neighbours.shape[1]):
        # nothing nearer than the second lies beyond the ball of both distances around the start
        reach = (radius[active] + np.sqrt(d_far[active].astype(np.float64))) * (1 + MARGIN)
        active = active[now.apart[start[active], place] <= reach]
        if not len(active):
            break
        candidate = now.neighbours[start[active], place]
        fresh = candidate != other[active]
        rows, candidate = active[fresh], candidate[fresh]
        distance = squared(vectors[rows], now.points[candidate])
        closer = (distance < d_far[rows]) | ((distance == d_far[rows]) & (candidate < far[rows]))
        rows = rows[closer]
        far[rows], d_far[rows] = candidate[closer], distance[closer]
        order(rows)
    return near, far, d_near, d_far


def advance(
    vectors: np.ndarray, cluster: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray, now: Centroids
) -> tuple[np.ndarray, ...]:
    """The state of the vectors for the centroids of this round."""
    cluster, second = cluster.copy(), second.copy()
    upper = upper + now.moved[cluster]
    # all others moved at most as far as the one that moved farthest among them
    farthest = np.asarray([np.delete(now.moved, i).max(initial=0.0) for i in range(len(now.points))])
    lower = lower - farthest[cluster]
    alone = now.apart[:, 0] / 2 * (1 - MARGIN) if now.apart.shape[1] else np.full(len(now.points), np.inf)
    for low in range(0, len(vectors), SLICE):
        part = slice(low, low + SLICE)
        rows = np.flatnonzero(~(upper[part] < np.maximum(lower[part], alone[cluster[part]]))) + low
        if len(rows):
            found = search(vectors[rows], cluster[rows], second[rows], now)
            cluster[rows], second[rows] = found[0], found[1]
            upper[rows] = np.sqrt(found[2].astype(np.float64)) * (1 + MARGIN)
            lower[rows] = np.sqrt(found[3].astype(np.float64)) * (1 - MARGIN) if len(now.points) > 1 else np.inf
    return cluster, second, upper, lower


def unpacked(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dims).astype(np.int64)


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """id and vector (packed whole numbers) of the rows that can be compared."""
    most = limit(dims) / scale
    bad = f"exists(v, x -> x IS NULL OR isnan(x) OR x >= {most}D OR x < -{most}D)"
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.expr(f"v IS NOT NULL AND size(v) = {dims} AND NOT {bad}"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dims)
            packed = np.floor(values * scale).astype("<i4")
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([v.tobytes() for v in packed], pa.binary())], names=["id", "vector"])

    kind = vectors.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(pack, f"id {kind}, vector binary")


def _round(state: DataFrame, now: Centroids, dims: int) -> DataFrame:
    """The next state, and at the end of each task one row per cluster (id null, moves set) with what it won and lost.

    A vector that keeps its cluster adds nothing: only moves change the sums.
    """
    kind = state.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(now.points)
        change, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        schema = None
        for batch in batches:
            vectors = unpacked(batch.column("vector"), dims)
            names = ("cluster", "second", "upper", "lower")
            old = [batch.column(c).to_numpy() for c in names]
            first = old[0] < 0  # no centroid yet: any two will do to start from
            begun = [np.where(first, 0, old[0]), np.where(first, min(1, k - 1), old[1]), np.where(first, np.inf, old[2]), np.where(first, 0.0, old[3])]
            new = advance(vectors, *begun, now)
            moved = np.flatnonzero(new[0] != old[0])
            np.add.at(change, new[0][moved], vectors[moved])
            np.add.at(count, new[0][moved], 1)
            left = moved[~first[moved]]
            np.subtract.at(change, old[0][left], vectors[left])
            np.subtract.at(count, old[0][left], 1)
            out = pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vector"), pa.array(new[0], pa.int32()), pa.array(new[1], pa.int32()),
                 pa.array(new[2]), pa.array(new[3]), pa.nulls(batch.num_rows, pa.list_(pa.int64()))],
                names=["id", "vector", *names, "moves"],
            )
            schema = out.schema
            yield out
        if schema is not None:
            rows = np.flatnonzero(count.astype(bool) | change.any(axis=1))
            moves = [[int(count[c]), *change[c].tolist()] for c in rows]
            nothing = [pa.nulls(len(rows), schema.field(n).type) for n in ("id", "vector", "second", "upper", "lower")]
            columns = [*nothing[:2], pa.array(rows, pa.int32()), *nothing[2:], pa.array(moves, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return state.mapInArrow(run, f"id {kind}, {STATE}, moves array<long>")


def _apply(moves: DataFrame, sums: list[list[int]]) -> None:
    """Add up the moves of all tasks: one number per cluster and component."""
    added = moves.select("cluster", F.posexplode("moves").alias("place", "amount"))
    added = added.groupBy("cluster", "place").agg(F.sum(F.col("amount").cast("decimal(38,0)")).alias("amount"))
    for row in added.collect():  # clusters times components
        sums[row["cluster"]][row["place"]] += int(row["amount"])


def shallot_kmeans(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    clusters: int = CLUSTERS,
    dims: int = DIMENSIONS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that can be compared.

    Components become floor(scale * x). Vectors that are null, of another size, or hold a component that is null, not
    finite or so large that a squared distance exceeds a long (see ``limit``) are left out. The first centroids are the
    vectors with the smallest SHA-256 of ``seed:id`` (a null id as ``null``; equal ids by their packed components). With fewer
    vectors than clusters each is a centroid. Ties go to the smaller centroid, empty centroids stay; repeated rows count
    each. An empty table gives no rows.

    A round reads and writes the vectors with their state, without a shuffle; what the driver gets of it are sums per
    cluster and component. Each round is a written table, so lost executors cost one round; older ones are deleted.
    """
    spark = vectors.sparkSession
    kept = whole_numbers(vectors, id_col, vector_col, dims, scale)
    start = {"cluster": F.lit(-1), "second": F.lit(-1), "upper": F.lit(0.0), "lower": F.lit(0.0)}
    state = settle(kept.withColumns(start).withColumn("moves", F.lit(None).cast("array<long>")), "vectors")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    drawn = state.orderBy(F.sha2(name, 256), F.hex("vector")).select("vector").limit(clusters).collect()
    kind = vectors.schema[id_col].dataType.simpleString()
    result = f"`{id_col}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not drawn:
        return spark.createDataFrame([], result)
    points = unpacked(pa.array([bytes(r["vector"]) for r in drawn], pa.binary()), dims)
    sums = [[0] * (dims + 1) for _ in points]  # count, then components

    now = Centroids.of(points)
    for step in range(rounds + 1):
        before = state
        state = settle(_round(state.filter("moves IS NULL").drop("moves"), now, dims), "assigned")
        for path in {f.rsplit("/", 1)[0] for f in before.inputFiles()}:
            delete(spark, path)
        if step < rounds:
            _apply(state.filter("moves IS NOT NULL"), sums)
            means = [[x // s[0] for x in s[1:]] if s[0] else p.tolist() for s, p in zip(sums, now.points)]
            now = Centroids.of(np.asarray(means, np.int64).reshape(len(points), dims), now.points)

    last = now.points

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster = batch.column("cluster").to_numpy()
            distance = squared(unpacked(batch.column("vector"), dims), last[cluster])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("cluster"), pa.array(distance)], names=[id_col, "cluster", "distance"])

    placed = state.filter("moves IS NULL").select("id", "vector", "cluster").mapInArrow(measure, f"`{id_col}` {kind}, cluster int, distance long")
    per_cluster = {r["cluster"]: int(r["s"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    facts = [
        (c, per_cluster[c], sum(per_cluster.values()), hashlib.sha256(",".join(map(str, last[c].tolist())).encode()).hexdigest())
        for c in sorted(per_cluster)
    ]
    known = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row per cluster
    return placed.join(F.broadcast(known), "cluster").select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
