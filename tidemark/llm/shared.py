"""Rows kept in the shared folder, and connected components over edges kept there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure, discard, materialise

#: Shuffle files go as soon as the query that wrote them is over; kept frames do not need them.
LLM_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Whole texts travel in these batches; rows may be very long.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def prepare(spark: SparkSession) -> SparkSession:
    """The session settings that these operators rely on."""
    configure(spark)
    for key, value in LLM_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def hash_of(*columns) -> F.Column:
    """A 64-bit hash of columns that tells null from empty text."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One half-step of the alternating star contraction over edges (a > b).

    Large: every larger neighbour of a node is linked to the node's least neighbour (itself
    included). Small: a node and its smaller neighbours are linked to the least of them.
    """
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = materialise(
        both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least"
    )
    joined = both.join(least, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    found = materialise(moved.where("a <> b").distinct(), "edges")
    discard(least, edges)
    return found


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the component's least node.

    Alternating large-star and small-star steps until nothing changes, each a group-by and a join
    written to the shared folder. Hub nodes: minima combine before the shuffle, and adaptive
    execution splits the join on a hub. The driver sees one count and one checksum a round.
    """
    now = materialise(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    seen = None
    while True:
        state = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if state == seen or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = state
        now = _star(_star(now, large=True), large=False)
