"""Near copies of embeddings by lattice hashing.

Each table projects vectors onto orthonormal random directions, eight at a time, and decodes every group of eight to the
nearest point of the E8 lattice; the points together are the cell. A vector is kept in its own cell and looks into the
neighbouring cells whose borders are closest. Vectors that meet are verified by their cosine.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import extend, runs
from packetloom.llm.graph import components
from packetloom.llm.jaccard import constants, mixed, roots
from packetloom.session import settle

COSINE = 0.98
#: Vectors of one side of a comparison block.
BLOCK = 64


@dataclass(frozen=True)
class Lattice:
    """Shape of the hash: tables, groups of eight projections, length of a lattice step, looked-into neighbours."""

    tables: int = 14
    groups: int = 3
    scale: float = 0.3
    probes: int = 4
    seed: int = 41


@lru_cache(maxsize=64)
def shape_for(dim: int, cosine: float = COSINE) -> Lattice:
    """The shape for unit vectors of ``dim`` components.

    A projection of the difference of two vectors shrinks with the root of the dimension, and so does the step: a pair at
    the cosine meets in a table with probability 0.62 whatever the dimension, in 14 tables all but 1e-6. Unrelated
    vectors of 24 components and more meet in less than one table of a thousand. With fewer components there are fewer
    groups and shorter steps; below eight many unrelated vectors are near each other anyway. At a lower cosine steps are longer and unrelated
    vectors meet more often.
    """
    groups = 3 if dim >= 24 else 2 if dim >= 16 else 1
    step = 2.4 if dim >= 24 else 1.8 if dim >= 16 else 1.2 if dim >= 8 else 0.8
    return Lattice(groups=groups, scale=step / np.sqrt(dim) * np.sqrt((2 - 2 * cosine) / 0.04))


@lru_cache(maxsize=1)
def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of one, or eight halves with an even number of minus signs."""
    found = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            found.append(v)
    found += [np.asarray(v) for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.asarray(found)


def nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest point with whole entries of an even sum."""
    whole = np.rint(x)
    rest = x - whole
    odd = np.flatnonzero(whole.sum(axis=1) % 2)
    worst = np.abs(rest[odd]).argmax(axis=1)
    whole[odd, worst] += np.where(rest[odd, worst] >= 0, 1.0, -1.0)
    return whole


def nearest_point(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8: of the even whole points or of those moved by a half."""
    a, b = nearest_even(x), nearest_even(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], a, b)


@lru_cache(maxsize=64)
def directions(dim: int, table: int, shape: Lattice) -> np.ndarray:
    """Orthonormal columns where the dimension has that many, else unit columns."""
    drawn = np.random.default_rng([shape.seed, table, dim]).normal(size=(dim, 8 * shape.groups))
    return np.linalg.qr(drawn)[0] if dim >= 8 * shape.groups else drawn / np.linalg.norm(drawn, axis=0) / np.sqrt(8 * shape.groups / dim)


def cell_hash(points: np.ndarray) -> np.ndarray:
    """64-bit hashes of cells; lattice points have whole entries when doubled."""
    doubled = np.rint(points * 2).astype(np.int64).astype(np.uint64)
    return mixed((doubled * constants(43, points.shape[1])).sum(axis=1, dtype=np.uint64))


def cells(unit: np.ndarray, table: int, shape: Lattice) -> np.ndarray:
    """Per unit vector the hash of its own cell and of the cells behind its nearest borders."""
    y = unit @ directions(unit.shape[1], table, shape) / shape.scale
    points = np.concatenate([nearest_point(y[:, 8 * g : 8 * g + 8]) for g in range(shape.groups)], axis=1)
    steps = minimal_vectors()
    # a border to the neighbour in direction s lies where the product with s is one
    gap = np.concatenate([1 - (y - points)[:, 8 * g : 8 * g + 8] @ steps.T for g in range(shape.groups)], axis=1)
    near = np.argsort(gap, axis=1, kind="stable")[:, : shape.probes]
    out = [cell_hash(points)]
    for k in range(shape.probes):
        moved = points.reshape(len(points), shape.groups, 8).copy()
        group, step = np.divmod(near[:, k], len(steps))
        moved[np.arange(len(points)), group] += steps[step]
        out.append(cell_hash(moved.reshape(len(points), -1)))
    return np.column_stack(out).view(np.int64)


def unit_vectors(batch: pa.RecordBatch) -> np.ndarray:
    values = np.asarray(batch.column("vector").to_pylist(), np.float64).reshape(batch.num_rows, -1)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def usable(vector: str) -> Column:
    """False for vectors that are null, empty, zero or hold a component that is null or not finite."""
    bad = f"exists({vector}, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))"
    return F.expr(f"{vector} IS NOT NULL AND NOT {bad} AND exists({vector}, x -> x != 0)")


def with_cells(classes: DataFrame, cosine: float, shape: Lattice | None) -> DataFrame:
    """``classes`` with dim and cells: the packed hashes of all tables, one row of own cell and looked-into cells each."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray([len(v) for v in batch.column("vector").to_pylist()], np.int32)
            found = np.empty(batch.num_rows, object)
            for dim in np.unique(sizes):
                mine = np.flatnonzero(sizes == dim)
                unit = unit_vectors(batch.take(pa.array(mine)))
                use = shape or shape_for(int(dim), cosine)
                every = np.stack([cells(unit, t, use) for t in range(use.tables)], axis=1)
                found[mine] = [x.tobytes() for x in every]
            yield extend(batch, dim=pa.array(sizes), cells=pa.array(found.tolist(), pa.binary()))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema.fields)
    return classes.mapInArrow(hashed, f"{kinds}, dim int, cells binary")


def unpacked(column: pa.ChunkedArray | pa.Array, probes: int) -> np.ndarray:
    """Cells as an array: vector, table, own cell and looked-into ones."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.int64).reshape(len(values), -1, probes + 1)


def keys_of(classes: DataFrame, probes: int) -> DataFrame:
    """node, label, dim, table, key, home of every vector: its own cell of each table and the cells it looks into."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray([len(c) for c in batch.column("cells").to_pylist()])
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                every = unpacked(part.column("cells"), probes)
                rows, tables, width = every.shape
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(np.repeat(part.column(c).to_numpy(zero_copy_only=False), tables * width)) for c in ("node", "label", "dim")),
                        pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), width), rows)),
                        pa.array(every.ravel()),
                        pa.array(np.tile(np.arange(width) == 0, rows * tables)),
                    ],
                    names=["node", "label", "dim", "table", "key", "home"],
                )

    return classes.select("node", "label", "dim", "cells").mapInArrow(spread, "node long, label long, dim int, table int, key long, home boolean")


def meets(cell: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Pairs (i, j) with node i below node j of which j looks into the cell of i."""
    hit = (cell[None, :, :] == cell[:, :1][:, None, :]).any(axis=2)
    return hit & (node[:, None] < node[None, :])


def compare_cell(group: pa.Table, cosine: float, probes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Nodes, links and roots of one block of one cell: homes against lookers, without those that met in an earlier table."""
    if group.num_rows < 2:
        return None
    values = group.column("vector").combine_chunks()
    values = values.flatten().to_numpy().reshape(group.num_rows, -1)
    norm = np.linalg.norm(values, axis=1)
    linked = values @ values.T / (norm[:, None] * norm[None, :]) >= cosine
    node = group.column("node").to_numpy()
    home, looks = (group.column(k).to_numpy() for k in ("home", "looks"))
    linked &= (node[:, None] < node[None, :]) & home[:, None] & looks[None, :]
    if not linked.any():
        return None
    every = unpacked(group.column("cells"), probes)
    for earlier in range(group.column("table")[0].as_py()):
        linked &= ~meets(every[:, earlier], node)
    linked |= linked.T
    has = linked.any(axis=1)
    return node[has], (linked @ group.column("copies").to_numpy())[has], node[roots(linked)][has]


def lattice_near_copies(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = COSINE,
    shape: Lattice | None = None,
) -> DataFrame:
    """id, n_links, component_id, kept of every vector.

    Vectors of one label (not null) and one dimension are linked from ``cosine`` on, computed in double precision.
    n_links counts the other rows linked directly, component_id is the smallest id reachable, kept marks the rows whose
    id is that. Vectors that cannot be compared (see ``usable``) and rows without a label are linked with nothing. Rows
    of equal vector and label are one class and hashed once; a null id is never the smallest unless all are null. An
    empty table gives no rows.

    The shape of the hash follows from the dimension and the cosine (``shape_for``) unless ``shape`` gives it.

    Keys travel without vectors first. Only cells in which a vector meets another one's look are kept, and those are
    compared in square blocks of bounded size, so a crowded cell is spread over many tasks; links are counted, never
    listed.
    """
    label = F.col(label_col).cast("long")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), label.alias("label"))
    rows = rows.withColumn("ready", usable("vector") & F.col("label").isNotNull())
    # -0.0 and 0.0 are one value; the hash of a class is only a name, equality of the vectors decides
    rows = rows.withColumn("vector", F.expr("transform(vector, x -> x + 0D)")).withColumn("vector_key", F.xxhash64("vector"))
    rows = settle(rows, "vectors")
    person = F.struct(F.col("id").isNull().alias("none"), "id")
    classes = rows.filter("ready").groupBy("label", "vector_key", "vector").agg(F.count(F.lit(1)).alias("copies"), F.min(person).alias("first"))
    # numbers of written rows, so no two classes share one
    classes = settle(with_cells(classes, cosine, shape).withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    probes = (shape or Lattice()).probes

    keys = settle(keys_of(classes, probes), "cells")
    place = ["label", "dim", "table", "key"]
    # a cell matters where some vector at home meets the look of a vector with a larger node
    crowd = keys.groupBy(*place).agg(
        F.min(F.when(F.col("home"), F.col("node"))).alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("n")
    )
    crowd = crowd.filter("low < high").select(*place, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    members = keys.join(crowd, place).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # homes of block i face lookers of every block j: a vector at home goes out once per looking block and once as a looker
    members = members.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    as_home = members.filter("home").select("node", *place, F.col("block").alias("i"), F.col("other").alias("j"), F.lit(True).alias("home"))
    as_look = members.select("node", *place, F.col("other").alias("i"), F.col("block").alias("j"), F.lit(False).alias("home"))
    faced = as_home.unionByName(as_look).groupBy("node", *place, "i", "j").agg(
        F.max("home").alias("home"), F.min("home").alias("only_home")
    )
    faced = faced.withColumn("looks", ~F.col("only_home")).drop("only_home")
    loaded = faced.join(classes.select("node", "vector", "cells", "copies"), "node")

    keys_of_block = [*place, "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, keys_of_block):
            links = compare_cell(group, cosine, probes)
            if links is not None:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in links], names=["node", "links", "root"])

    # a block has at most some hundred rows
    blocks = loaded.repartition(*keys_of_block).sortWithinPartitions(*keys_of_block)
    found = settle(blocks.mapInArrow(compare, "node long, links long, root long"), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select("node", "root").withColumnRenamed("node", "a").withColumnRenamed("root", "b"))

    summary = classes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    heads = summary.groupBy("component").agg(F.min("first").alias("head"))
    summary = summary.join(heads, "component").join(links, "node", "left")
    summary = summary.select("label", "vector_key", "vector", "copies", "head", F.coalesce("links", F.lit(0)).alias("links"))
    ready = rows.filter("ready").join(summary, ["label", "vector_key", "vector"])
    ready = ready.select("id", (F.col("copies") - 1 + F.col("links")).alias("n_links"), F.col("head.id").alias("component_id"))
    alone = rows.filter("NOT ready").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return ready.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("n_links").cast("long"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
