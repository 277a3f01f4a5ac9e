"""Near duplicates among vectors by E8 lattice hashing.

In each of several tables a vector is projected to eight random directions and decoded to the
nearest point of the E8 lattice, its home cell. It also stands in the cells of the neighbouring
lattice points whose borders are nearest. Vectors meet in a cell that is home to one of them, and
the cosine of all that meet is checked on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import vectors
from tidemark.llm.shared import connected_components
from tidemark.llm.words import mixed
from tidemark.session import materialise

#: Rows of a cell that are compared in one task; fuller cells are split into pairs of blocks.
BLOCK_ROWS = 1024


def shortest_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled so that they are whole numbers."""
    two = [
        [a if k == i else b if k == j else 0 for k in range(8)]
        for i in range(8)
        for j in range(i + 1, 8)
        for a in (2, -2)
        for b in (2, -2)
    ]
    signs = [[-1 if m >> k & 1 else 1 for k in range(8)] for m in range(256)]
    return np.array(two + [s for s in signs if s.count(-1) % 2 == 0])


def _nearest_even(points: np.ndarray) -> np.ndarray:
    """Nearest whole points with an even sum (the lattice D8)."""
    found = np.rint(points)
    off = points - found
    odd = np.flatnonzero(found.sum(axis=1).astype(np.int64) & 1)
    worst = np.abs(off[odd]).argmax(axis=1)
    found[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
    return found


def nearest_points(points: np.ndarray) -> np.ndarray:
    """Nearest E8 points, doubled: E8 is D8 and D8 moved by one half in all directions."""
    whole, half = _nearest_even(points), _nearest_even(points - 0.5) + 0.5
    nearer = ((points - whole) ** 2).sum(axis=1) <= ((points - half) ** 2).sum(axis=1)
    return np.rint(2 * np.where(nearer[:, None], whole, half)).astype(np.int64)


def cells(rows: np.ndarray, tables: int, probes: int, cell: float, seed: int = 17) -> np.ndarray:
    """Keys of the cells of each row: (row, table, 1 + probes), the home cell first."""
    scaled, near = vectors.unit(rows), shortest_vectors()
    out = np.empty((len(rows), tables, 1 + probes), dtype=np.uint64)
    weights = mixed(np.arange(1, 9, dtype=np.uint64)) | np.uint64(1)
    for t in range(tables):
        rng = np.random.default_rng((seed, t, rows.shape[1]))
        at = scaled @ rng.normal(size=(rows.shape[1], 8)) / cell
        home = nearest_points(at)
        side = (at - home / 2) @ near.T
        first = np.argpartition(-side, probes - 1, axis=1)[:, :probes]
        every = np.concatenate([home[:, None, :], home[:, None, :] + near[first]], axis=1)
        out[:, t] = mixed((every.astype(np.uint64) * weights).sum(axis=2, dtype=np.uint64) + mixed(np.array([t + 1], np.uint64))[0])
    return out


def _first_meeting(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Key of the first cell in which each pair of rows of cells() meets, so it is counted once."""
    first = np.zeros(len(one), dtype=np.uint64)
    open_ = np.ones(len(one), dtype=bool)
    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    for t in range(one.shape[1]):
        a, b = one[:, t], two[:, t]
        there = np.where((b == a[:, :1]).any(axis=1), a[:, 0], most)
        here = np.where((a == b[:, :1]).any(axis=1), b[:, 0], most)
        key = np.minimum(there, here)
        found = open_ & (key != most)
        first[found] = key[found]
        open_ &= ~found
    return first


def _groups(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row that each of n rows reaches over the links (a, b)."""
    label = np.arange(n)
    while True:
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if np.array_equal(label, before):
            return label


def _links_in_task(least: float, tables: int):
    """Rows sorted by (cell, part) to one row for each linked vector: its links there and a root."""

    def compare(run: pa.Table) -> dict[str, np.ndarray] | None:
        rows = vectors.unit(vectors.matrix(run.column("vector")))
        keys = vectors.matrix_of_keys(run.column("cells")).reshape(len(rows), tables, -1)
        home, block = run.column("home").to_numpy(), run.column("block").to_numpy()
        linked = np.triu(rows @ rows.T >= least - 1e-9, 1) & (home[:, None] | home[None, :])
        if run.column("halves")[0].as_py():
            linked &= block[:, None] != block[None, :]
        a, b = np.nonzero(linked)
        if not len(a):
            return None
        here = np.uint64(run.column("cell").to_numpy()[0].astype(np.int64).view(np.uint64))
        label = run.column("label").to_numpy()
        true = (np.einsum("ij,ij->i", rows[a], rows[b]) >= least) & (label[a] == label[b])
        a, b = a[true], b[true]
        roots = _groups(len(rows), a, b)
        once = _first_meeting(keys[a], keys[b]) == here
        copies, links = run.column("copies").to_numpy(), np.zeros(len(rows), dtype=np.int64)
        np.add.at(links, a[once], copies[b[once]])
        np.add.at(links, b[once], copies[a[once]])
        row = run.column("row").to_numpy()
        told = np.flatnonzero((links > 0) | (roots != np.arange(len(rows))))
        return {"row": row[told], "links": links[told], "root": row[roots[told]]}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def runs(part: pa.Table, last: bool) -> Iterator[tuple[int, int]]:
            cell, pair = part.column("cell").to_numpy(), part.column("part").to_numpy()
            cuts = [0, *(np.flatnonzero((cell[1:] != cell[:-1]) | (pair[1:] != pair[:-1])) + 1).tolist(), len(cell)]
            yield from zip(cuts[: -1 if last else -2], cuts[1:], strict=False)

        def told(part: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
            for x, y in runs(part, last):
                if y - x > 1 and (found := compare(part.slice(x, y - x).combine_chunks())):
                    yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in found.items()})

        for batch in batches:
            part = pa.Table.from_batches([batch])
            rest = part if rest is None else pa.concat_tables([rest, part])
            if rest.num_rows < BLOCK_ROWS:
                continue
            yield from told(rest, last=False)
            cuts = list(runs(rest, last=True))
            rest = rest.slice(cuts[-1][0])
        if rest is not None and rest.num_rows:
            yield from told(rest, last=True)

    return rows


def near_vectors(
    df: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    least: float = 0.98,
    tables: int = 4,
    probes: int = 8,
    cell: float = 1.0,
) -> DataFrame:
    """The id with n_links, component_id and kept of every row.

    Rows are compared if their labels are equal and not null and their vectors are of one length.
    n_links counts the other rows linked directly, component_id is the least id in reach, kept
    says whether that is the row's own. Vectors that are null, empty, zero or hold null or
    non-finite components, and rows without a label, are alone. Equal vectors of a label are one
    node with a number of copies from the start. Rows that repeat an id are rows of their own.

    Of pairs at a cosine of 0.98 these defaults miss fewer than one in ten thousand. ``cell`` is
    the size of the cells for cosines from 0.98 on; it is smaller for larger tables, with more tables.
    """
    named = df.select(F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(vector_column).alias("vector"))
    usable = F.col("label").isNotNull() & vectors.comparable(F.col("vector"))
    valid = named.where(usable)
    distinct = materialise(
        valid.groupBy("label", "vector")
        .agg(F.min("id").alias("first"), F.count("*").alias("copies"))
        .withColumn("row", F.monotonically_increasing_id()),
        "vectors",
    )
    numbered = distinct.withColumn("label_number", F.xxhash64("label", F.size("vector")))

    def standing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, label = vectors.lengths(batch.column(2)), batch.column(1).to_numpy(zero_copy_only=False)
            for length in np.unique(size):
                at = np.flatnonzero(size == length)
                keys = cells(vectors.matrix(batch.column(2).take(pa.array(at))), tables, probes, cell)
                keys = mixed(keys ^ mixed(label[at].astype(np.int64).view(np.uint64))[:, None, None])
                flat = pa.array(keys.reshape(len(at), -1).view(np.int64).ravel(), pa.int64())
                offsets = pa.array(np.arange(len(at) + 1) * (tables * (1 + probes)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.ListArray.from_arrays(offsets, flat)], names=["row", "cells"]
                )

    stand = materialise(numbered.select("row", "label_number", "vector").mapInArrow(standing, "row long, cells array<long>"), "cells")
    placed = stand.select("row", F.posexplode("cells").alias("place", "cell")).select(
        "row", "cell", (F.col("place") % (1 + probes) == 0).alias("home")
    )
    shared = materialise(
        placed.groupBy("cell")
        .agg(F.count("*").alias("n"), F.max("home").alias("lived_in"))
        .where("n > 1 AND lived_in")
        .select("cell", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks")),
        "shared-cells",
    )
    # A cell of b blocks becomes b * (b + 1) / 2 pairs of blocks, each a run of its own.
    block = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    met = (
        placed.join(shared, "cell")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "cell",
            "row",
            "home",
            "block",
            (F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")).alias("part"),
        )
    )
    # Within a pair of two different blocks only pairs across them count.
    pairs = met.join(shared, "cell").withColumn("halves", F.expr("part div blocks <> part % blocks")).drop("blocks")
    full = numbered.select("row", "copies", F.col("label_number").alias("label"), "vector").join(stand, "row")
    told = materialise(
        pairs.join(full, "row")
        .select("cell", "part", "halves", "block", "home", "row", "copies", "label", "vector", "cells")
        .repartition("cell", "part")
        .sortWithinPartitions("cell", "part", "row")
        .mapInArrow(_links_in_task(least, tables), "row long, links long, root long"),
        "links",
    )
    reached = connected_components(told.select(F.col("row").alias("a"), F.col("root").alias("b")))
    counts = told.groupBy(F.col("row").alias("node_row")).agg(F.sum("links").alias("links"))
    rooted = materialise(
        distinct.join(reached, F.col("row") == F.col("node"), "left")
        .join(counts, F.col("row") == F.col("node_row"), "left")
        .select(
            "label",
            "vector",
            "first",
            F.coalesce("root", "row").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "rooted",
    )
    least_id = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = materialise(rooted.join(least_id, "root").select("label", "vector", "n_links", "component_id"), "classes")
    together = valid.join(classes, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = named.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return together.unionByName(alone).select(
        F.col("id").alias(id_column), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
