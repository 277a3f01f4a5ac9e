"""Near duplicates by SimHash, linked with the pigeonring principle.

A 64-bit fingerprint is a ring of eight segments. If two fingerprints differ in two bits or fewer,
then from some segment on every chain of l consecutive segments differs in l * 2 / 8 bits or fewer
(Qin and Xiao, 2018). So the first three segments of that chain are equal, the first seven differ
in one bit at most, and only pairs that pass these tests meet the full Hamming check.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.shared import connected_components
from tidemark.llm.words import as_bytes
from tidemark.session import materialise

SEGMENTS = 8
SEGMENT_BITS = 64 // SEGMENTS
DISTANCE = 2
#: Segments of a chain that must be equal, as their budget is below one bit.
EQUAL = (SEGMENTS - 1) // DISTANCE
#: Fingerprints of one bucket that are compared within a task; fuller buckets take another exact way.
COMPARED = 4096
SEED = 42


def simhash(text: bytes, shingle: int = 3) -> int:
    """The fingerprint of a text, as unsigned number.

    A-Z is lower-cased, words are joined by single spaces, and a bit is set if over half of the
    shingles' XXH64 values, repeats included, have it. Fewer words make one shingle, none give 0.
    """
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - shingle + 1].tolist()
    values = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(values), 1 << 16):
        part = values[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text_column: str, carried: Sequence[str]) -> DataFrame:
    """The carried columns and fingerprint (a signed 64-bit number); null texts count as empty."""
    schema = T.StructType([*[docs.schema[c] for c in carried], T.StructField("__fingerprint", T.LongType())])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([simhash(text) for text in as_bytes(batch.column(batch.num_columns - 1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found.view(np.int64), pa.int64())], names=schema.fieldNames()
            )

    return docs.select(*carried, F.col(text_column).alias("__text")).mapInArrow(compute, schema)


def _rotated(start: Column) -> Column:
    """The fingerprint with segment ``start`` in its lowest bits."""
    places = [
        F.col("__fingerprint")
        if k == 0
        else F.shiftrightunsigned("__fingerprint", k * SEGMENT_BITS).bitwiseOR(F.shiftleft("__fingerprint", 64 - k * SEGMENT_BITS))
        for k in range(SEGMENTS)
    ]
    return F.element_at(F.array(*places), start + 1)


def _linked(run: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by bucket, as (row, least row of its group) for rows in groups."""
    chain = np.uint64((1 << (SEGMENT_BITS * (SEGMENTS - 1))) - 1)
    budget = (SEGMENTS - 1) * DISTANCE // SEGMENTS
    label = np.arange(len(run))
    left, right = [], []
    for lag in range(1, len(run)):
        at = np.flatnonzero(run[:-lag] == run[lag:])
        if not len(at):
            break
        differ = turned[at] ^ turned[at + lag]
        at = at[(np.bitwise_count(differ & chain) <= budget) & (np.bitwise_count(differ) <= DISTANCE)]
        left.append(at)
        right.append(at + lag)
    if not left:
        return label[:0], label[:0]
    a, b = np.concatenate(left), np.concatenate(right)
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if np.array_equal(label, before):
            moved = np.flatnonzero(label != np.arange(len(label)))
            return moved, label[moved]


def _links_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (start, bucket, turned, fingerprint) sorted by bucket to links (a, b), at most one a row."""
    waiting: list[list[np.ndarray]] = []
    held = 0

    def flush(columns: list[np.ndarray], whole: bool) -> tuple[pa.RecordBatch, list[np.ndarray]]:
        run = columns[0].astype(np.int64) << np.int64(SEGMENT_BITS * EQUAL) | columns[1]
        cut = len(run) if whole else int(np.searchsorted(run, run[-1]))
        row, least = _linked(run[:cut], columns[2][:cut].view(np.uint64))
        links = [pa.array(columns[3][x], pa.int64()) for x in (row, least)]
        return pa.RecordBatch.from_arrays(links, names=["a", "b"]), [c[cut:] for c in columns]

    for batch in batches:
        waiting.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        held += batch.num_rows
        if held >= 4 * COMPARED:
            found, rest = flush([np.concatenate(c) for c in zip(*waiting, strict=True)], whole=False)
            waiting, held = [rest], len(rest[0])
            yield found
    if held:
        yield flush([np.concatenate(c) for c in zip(*waiting, strict=True)], whole=True)[0]


def hamming_links(fingerprints: DataFrame) -> DataFrame:
    """(a, b): links that join all distinct fingerprints (column __fingerprint) in reach of each other.

    Every fingerprint goes to eight buckets, one for each start of a chain, keyed by the three
    segments that must be equal. Buckets of one are dropped; those of up to COMPARED are compared
    in a task, which returns the groups it finds, not all pairs. In a fuller bucket each
    fingerprint stands at every point that is at most one of its free bits away: two of them meet
    at a point exactly if they differ by two bits or fewer, and at no point do more than 41 meet.
    """
    key = F.col("__turned").bitwiseAND(F.lit((1 << (SEGMENT_BITS * EQUAL)) - 1))
    rows = (
        fingerprints.select("__fingerprint", F.explode(F.array(*[F.lit(i) for i in range(SEGMENTS)])).alias("__start"))
        .withColumn("__turned", _rotated(F.col("__start")))
        .withColumn("__bucket", key)
    )
    shared = materialise(
        rows.groupBy("__start", "__bucket").agg(F.count("*").alias("__n")).where("__n > 1"), "buckets"
    )
    met = materialise(rows.join(shared, ["__start", "__bucket"]), "bucketed")
    near = (
        met.where(F.col("__n") <= COMPARED)
        .select("__start", "__bucket", "__turned", "__fingerprint")
        .repartition("__start", "__bucket")
        .sortWithinPartitions("__start", "__bucket", "__turned")
        .mapInArrow(_links_in_task, "a long, b long")
    )
    free = range(SEGMENT_BITS * EQUAL, 64)
    points = F.array(F.col("__turned"), *[F.col("__turned").bitwiseXOR(F.lit((1 << b) - ((1 << 64) if b == 63 else 0))) for b in free])
    crowded = (
        met.where(F.col("__n") > COMPARED)
        .select("__start", "__fingerprint", F.explode(points).alias("__point"))
        .groupBy("__start", "__point")
        .agg(F.collect_list("__fingerprint").alias("__met"))
        .where(F.size("__met") > 1)
        .select(F.explode("__met").alias("a"), F.array_min("__met").alias("b"))
    )
    return near.unionByName(crowded.where("a <> b"))


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", carried: Sequence[str] | None = None
) -> DataFrame:
    """The carried columns (default: all) with fingerprint, component_id and kept.

    Documents whose fingerprints differ in two bits or fewer are linked; component_id is the least
    id in reach. ``kept`` is true for one row of each component: one with that id, and among rows
    that repeat it the first stored. Ids that are null come after all others. Texts that are null,
    empty or blank have fingerprint 0 and so form one component. An empty table gives no rows.
    Equal fingerprints are one node from the start, so copies cost nothing but their own rows.
    """
    carried = [c for c in (carried or docs.columns) if c not in ("fingerprint", "component_id", "kept")]
    marked = materialise(
        with_fingerprints(docs, text_column, list(dict.fromkeys([*carried, id_column]))).withColumn(
            "__row", F.monotonically_increasing_id()
        ),
        "fingerprints",
    )
    first = F.min(F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), F.col("__row").alias("row")))
    nodes = materialise(marked.groupBy("__fingerprint").agg(first.alias("__first")), "nodes")
    reached = connected_components(hamming_links(nodes.select("__fingerprint")))
    rooted = materialise(
        nodes.join(reached, F.col("__fingerprint") == F.col("node"), "left").select(
            "__fingerprint", "__first", F.coalesce("root", "__fingerprint").alias("__root")
        ),
        "rooted",
    )
    least = rooted.groupBy("__root").agg(F.min("__first").alias("__least"))
    classes = materialise(rooted.join(least, "__root").select(F.col("__fingerprint").alias("__print"), "__least"), "classes")
    return marked.join(classes, F.col("__fingerprint") == F.col("__print")).select(
        *carried,
        F.lower(F.lpad(F.hex("__fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("__least.id").alias("component_id"),
        (F.col("__row") == F.col("__least.row")).alias("kept"),
    )
