"""Nearest neighbours by shifted space-filling curves.

Vectors are projected to a few random directions, brought to quantile cells, moved by a random
shift and ordered along a Hilbert curve, several times over with other directions and shifts. Near
vectors come near each other on some of the curves, so a query is compared with the rows in a
window around its place on each of them, and the best of all windows are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm import vectors
from tidemark.llm.hilbert import hilbert_index
from tidemark.session import materialise

BITS = 4
#: Rows of a curve that are compared in one task, at most.
BLOCK_ROWS = 4096
#: Blocks of a curve at least, so that a window is a part of the curve also for few rows, unless
#: they would be smaller than LEAST_ROWS: a few rows are all compared.
LEAST_BLOCKS = 20
LEAST_ROWS = 64
CUTS = 255


def directions(length: int, curve: int, width: int, seed: int = 23) -> tuple[np.ndarray, np.ndarray]:
    """Orthogonal random directions of a curve, and its shifts between 0 and 1."""
    rng = np.random.default_rng((seed, length, curve))
    turned, _ = np.linalg.qr(rng.normal(size=(length, min(width, length))))
    return turned, rng.random(turned.shape[1])


def fit_cuts(rows: np.ndarray, curves: int, width: int) -> np.ndarray:
    """Quantiles of the projections of a sample: (curve, direction, cut)."""
    steps = (np.arange(CUTS) + 1) / (CUTS + 1)
    scaled = vectors.unit(rows)
    return np.stack([np.quantile(scaled @ directions(rows.shape[1], c, width)[0], steps, axis=0).T for c in range(curves)])


def curve_positions(rows: np.ndarray, cuts: np.ndarray, width: int) -> np.ndarray:
    """Places of rows on each curve: (row, curve)."""
    scaled, out = vectors.unit(rows), []
    for curve, own in enumerate(cuts):
        turned, shift = directions(rows.shape[1], curve, width)
        at = scaled @ turned
        share = np.stack([np.searchsorted(own[d], at[:, d]) for d in range(at.shape[1])], axis=1) / (CUTS + 1)
        cell = np.minimum(((share + shift) / 2 * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
        out.append(hilbert_index(cell, BITS))
    return np.stack(out, axis=1)


def _best(scores: np.ndarray, ids: np.ndarray, keep: int) -> np.ndarray:
    """Places of the ``keep`` best, ties to smaller ids; null ids (held as the largest) last."""
    return np.lexsort((ids, -scores))[:keep]


def _search_block(keep: int):
    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query": [], "row": [], "vec": [], "score": []}
        if candidates.num_rows and queries.num_rows:
            rows, asked = vectors.matrix(candidates.column("vector")), vectors.matrix(queries.column("asked_vector"))
            scaled = vectors.unit(rows)
            row, ids = candidates.column("row").to_numpy(), candidates.column("vec").fill_null(np.iinfo(np.int64).max).to_numpy()
            own = queries.column("asked_row").to_numpy()
            for at in range(0, len(asked), 256):
                near = vectors.unit(asked[at : at + 256]) @ scaled.T
                edge = np.partition(near, -min(keep, near.shape[1]), axis=1)[:, -min(keep, near.shape[1])]
                for i, (line, bound) in enumerate(zip(near, edge, strict=True)):
                    # All that may tie with the last one are measured again, the same way for each.
                    close = np.flatnonzero(line >= bound - 1e-9)
                    exact = vectors.cosines(np.broadcast_to(asked[at + i], rows[close].shape), rows[close])
                    best = _best(exact, ids[close], keep)
                    out["query"] += [int(own[at + i])] * len(best)
                    out["row"] += row[close[best]].tolist()
                    out["vec"] += ids[close[best]].tolist()
                    out["score"] += exact[best].tolist()
        return pa.table(out, schema=pa.schema([("query", pa.int64()), ("row", pa.int64()), ("vec", pa.int64()), ("score", pa.float64())]))

    return lambda key, candidates, queries: search(candidates, queries)


def nearest(
    df: DataFrame,
    query_every: int = 50,
    keep: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    curves: int = 10,
    width: int = 8,
    share: float = 0.2,
    sample: int = 20_000,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``keep`` nearest found of each query, by cosine.

    Queries are the rows whose id is divisible by ``query_every``; candidates are all other rows
    whose vectors have the query's length. Vectors that are null, empty, zero or hold null or
    non-finite components take no part. Ties go to smaller ids, null ids last. With fewer
    candidates all of them are returned; an empty table gives no rows. Of equal vectors only the
    ``keep`` + 1 of least id can be among any nearest, so only these stand on the curves. The
    search is made once for each vector that is asked for, with one neighbour more, and every
    query of that vector takes the result without its own row.

    ``share`` is the part of each curve that a window covers, rounded up to whole blocks. Vectors
    without any structure (independent directions) need a share like the default for nine
    neighbours in ten; where near vectors stand close together a far smaller one does. The cuts
    between cells come from at most ``sample`` rows, chosen by hash; every row is indexed. A query
    of a length that is not among these rows is compared with all rows of its length.
    """
    named = df.select(F.col(id_column).cast("long").alias("vec"), F.col(vector_column).alias("vector"))
    copies = W.partitionBy("vector").orderBy(F.col("vec").asc_nulls_last(), "row")
    asks = F.coalesce(F.col("vec") % query_every == 0, F.lit(False))
    stored = materialise(
        named.where(vectors.comparable(F.col("vector"))).withColumn("row", F.monotonically_increasing_id()).withColumn("asks", asks),
        "vectors",
    )
    rows = materialise(stored.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= keep + 1), "indexed")
    # Every query, also one beyond the cap, with the row that is searched for all of its vector.
    heads = rows.where("copy = 1").select("vector", F.col("row").alias("head"))
    asking = materialise(
        stored.where("asks").join(heads, "vector").select("head", F.col("row").alias("own"), F.col("vec").alias("query_id")), "asking"
    )

    picked = rows.orderBy(F.xxhash64("vector"), "row").limit(sample).select("vector").toArrow().column(0).combine_chunks()
    held = vectors.lengths(picked) if len(picked) else np.zeros(0, dtype=np.int64)
    cuts = {int(n): fit_cuts(vectors.matrix(picked.take(pa.array(np.flatnonzero(held == n)))), curves, width) for n in np.unique(held)}

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = vectors.lengths(batch.column(1))
            for length in np.unique(size):
                at = np.flatnonzero(size == length)
                part = vectors.matrix(batch.column(1).take(pa.array(at)))
                # A length that the sample missed has no cuts; its rows share one place, and windows reach all its blocks.
                found = curve_positions(part, cuts[int(length)], width) if int(length) in cuts else np.zeros((len(at), 1), np.int64)
                n = found.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(length, n * len(at)), pa.int32()),
                        pa.array(np.tile(np.arange(n), len(at)), pa.int32()),
                        pa.array(found.ravel(), pa.int64()),
                        batch.column(0).take(pa.array(np.repeat(at, n))),
                    ],
                    names=["length", "curve", "key", "row"],
                )

    order = ["length", "curve", "key", "row"]
    ranked = _ranked(
        rows.select("row", "vector").mapInArrow(places, "length int, curve int, key long, row long").repartitionByRange(*order), order
    )
    few = F.least(F.lit(LEAST_BLOCKS), F.ceil(F.col("all") / LEAST_ROWS))
    blocks = F.greatest(F.ceil(F.col("all") / BLOCK_ROWS), few).cast("long")
    placed = materialise(
        ranked.select("row", "length", "curve", "rank", "all", blocks.alias("blocks"), F.expr("rank * blocks div all").alias("block")),
        "placed",
    )
    candidates = placed.select("row", "length", "curve", "block").join(rows.select("row", "vec", "vector"), "row")
    reach = F.when(F.col("length").isin(list(cuts)), F.ceil(F.col("blocks") * share / 2)).otherwise(F.col("blocks")).cast("long")
    asked = (
        placed.join(asking.select(F.col("head").alias("row")).distinct(), "row")
        .join(rows.select("row", "vector"), "row")
        .withColumn(
            "block",
            F.explode(F.sequence(F.greatest(F.col("block") - reach, F.lit(0)), F.least(F.col("block") + reach, F.col("blocks") - 1))),
        )
        .select(*[F.col(c).alias(f"asked_{c}") for c in ("row", "length", "curve", "block", "vector")])
    )
    by = ["length", "curve", "block"]
    found = (
        candidates.groupBy(*by)
        .cogroup(asked.groupBy(*[f"asked_{c}" for c in by]))
        .applyInArrow(_search_block(keep + 1), "query long, row long, vec long, score double")
        .groupBy("query", "row")
        .agg(F.first("vec").alias("vec"), F.first("score").alias("score"))
    )
    best = W.partitionBy("query").orderBy(F.desc("score"), "vec", "row")
    top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep + 1)
    near = top.groupBy(F.col("query").alias("head")).agg(F.array_sort(F.collect_list(F.struct("rank", "row", "vec", "score"))).alias("near"))
    others = F.slice(F.filter("near", lambda x: x["row"] != F.col("own")), 1, keep)
    return (
        asking.join(near, "head")
        .select("query_id", F.posexplode(others).alias("at", "found"))
        .select(
            "query_id",
            (F.col("at") + 1).alias("rank"),
            F.nullif("found.vec", F.lit(np.iinfo(np.int64).max)).alias("vec_id"),
            "found.score",
        )
    )


def _ranked(ordered: DataFrame, order: list[str]) -> DataFrame:
    """Range-partitioned rows with their rank in (length, curve) and the number of rows there."""
    placed = materialise(
        ordered.sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "curve"
    ).withColumn("part", F.shiftright("at", 33))
    # One row for each partition and curve.
    running = W.partitionBy("length", "curve").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = materialise(
        placed.groupBy("length", "curve", "part")
        .agg(F.count("*").alias("n"), F.min("at").alias("first"))
        .select(
            "length",
            "curve",
            "part",
            "first",
            F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"),
            F.sum("n").over(W.partitionBy("length", "curve")).alias("all"),
        ),
        "starts",
    )
    return placed.join(starts, ["length", "curve", "part"]).withColumn("rank", F.col("before") + F.col("at") - F.col("first"))
