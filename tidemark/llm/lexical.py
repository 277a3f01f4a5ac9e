"""Ranked lexical search of a set of items over all documents, scoring equal bags once.

Documents are reduced to the items' words: term numbers and counts. Documents with the same
numbers, counts and length class m must have the same score for every item, so they form a class,
found by hash and held together by comparing the bags themselves. Each class is scored once, and
only the best classes are expanded into their members, by ascending id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import as_bytes
from tidemark.session import materialise

#: Term characters: ASCII letters and digits, and everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of item text searched for in one pass over the documents, on average.
BLOCK_BYTES = 2 << 20
#: Cells of the matrix that is summed up at a time.
CELLS = 1 << 21

_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in order; only A to Z are lower-cased."""
    return text.translate(_FOLD).split()


def _bags(vocabulary: dict[bytes, int]):
    """(id, text) to (id, n, terms, tfs): numbers of the vocabulary's terms, ascending, with their counts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms(text) for text in as_bytes(batch.column(1))]
            sizes = np.array([len(x) for x in found], dtype=np.int64)
            numbers = np.fromiter(map(vocabulary.get, chain.from_iterable(found), repeat(-1)), dtype=np.int64, count=int(sizes.sum()))
            del found
            keys = (np.repeat(np.arange(len(sizes)), sizes) * max(1, len(vocabulary)) + numbers)[numbers >= 0]
            keys, tfs = np.unique(keys, return_counts=True)
            owner, number = np.divmod(keys, max(1, len(vocabulary)))
            offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(sizes)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(number.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(tfs.astype(np.int64))),
                ],
                names=["id", "n", "terms", "tfs"],
            )

    return rows


def _scores(batch: pa.RecordBatch, weights: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """(class, item) scores. ``asked`` has a row for each term: 1 at the items that hold it."""
    bags, tfs = batch.column("terms"), batch.column("tfs").flatten().to_numpy()
    number, ends = bags.flatten().to_numpy(), bags.offsets.to_numpy()[1:] - bags.offsets[0].as_py()
    starts = np.concatenate([[0], ends[:-1]])
    m = np.repeat(batch.column("m").to_numpy(), ends - starts)
    worth = weights[number] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m))
    out = np.empty((len(starts), asked.shape[1]), dtype=np.int64)
    row = 0
    while row < len(starts):
        to = max(row + 1, int(np.searchsorted(ends, starts[row] + CELLS // asked.shape[1], side="right")))
        part = slice(starts[row], ends[to - 1])
        out[row:to] = np.add.reduceat(asked[number[part]] * worth[part, None], starts[row:to] - starts[row], axis=0)
        row = to
    return out


def _best(weights: np.ndarray, asked: np.ndarray, keep: int):
    """Of each batch of classes those that may be among an item's best: (item, score, members).

    A class below the ``keep`` best scores that the task has met for an item is left out; of equal
    scores those with the least first members stay.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.zeros((keep, asked.shape[1]), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = _scores(batch, weights, asked)
            first = batch.column("first").fill_null(np.iinfo(np.int64).max).to_numpy()
            may = (scores > 0) & (scores >= least.min(axis=0))
            items, classes = [], []
            for item in np.flatnonzero(may.any(axis=0)):
                at = np.flatnonzero(may[:, item])
                at = at[np.lexsort((first[at], -scores[at, item]))[:keep]]
                items.append(np.full(len(at), item))
                classes.append(at)
            if not items:
                continue
            least = -np.sort(-np.concatenate([least, scores]), axis=0)[:keep]
            item, at = np.concatenate(items), np.concatenate(classes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item.astype(np.int32)), pa.array(scores[at, item]), batch.column("first").take(pa.array(at)), batch.column("members").take(pa.array(at))],
                names=["item", "score", "first", "members"],
            )

    return rows


def _search_block(docs: DataFrame, ids: list, texts: list[bytes], keep: int) -> DataFrame:
    """(item, rank, id, score) for the items of one block."""
    spark = docs.sparkSession
    held = [set(terms(text)) for text in texts]
    vocabulary = {term: i for i, term in enumerate(sorted(set().union(*held)))}
    kind = docs.schema["id"].dataType
    bag_schema = T.StructType(
        [
            T.StructField("id", kind),
            T.StructField("n", T.LongType()),
            T.StructField("terms", T.ArrayType(T.IntegerType())),
            T.StructField("tfs", T.ArrayType(T.LongType())),
        ]
    )
    bags = materialise(docs.select("id", "text").mapInArrow(_bags(vocabulary), bag_schema), "bags")
    n_docs, n_terms = bags.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # At most as many rows as the block has terms.
    frequency = np.zeros(len(vocabulary))
    for row in bags.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequency[row["term"]] = row["count"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in frequency], dtype=np.int64)
    asked = np.zeros((len(vocabulary), len(ids)), dtype=np.int64)
    for item, words in enumerate(held):
        asked[[vocabulary[w] for w in words], item] = 1

    spread = F.expr(f"{100 - 90} + (90 * n * {n_docs}L) div {max(1, n_terms)}L")
    classed = bags.where(F.size("terms") > 0).select("id", "terms", "tfs", spread.alias("m")).withColumn("bag", F.xxhash64("terms", "tfs", "m"))
    same = ["bag", "m", "terms", "tfs"]
    members = (
        classed.withColumn("place", F.row_number().over(Window.partitionBy(*same).orderBy(F.col("id").asc_nulls_last())))
        .where(F.col("place") <= keep)
        .groupBy(*same)
        .agg(F.sort_array(F.collect_list(F.struct("place", "id"))).alias("members"))
        .select("m", "terms", "tfs", F.col("members.id").alias("members"), F.col("members")[0]["id"].alias("first"))
    )
    best_schema = T.StructType(
        [
            T.StructField("item", T.IntegerType()),
            T.StructField("score", T.LongType()),
            T.StructField("first", kind),
            T.StructField("members", T.ArrayType(kind)),
        ]
    )
    by_class = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("first").asc_nulls_last())
    by_member = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = (
        members.mapInArrow(_best(weights, asked, keep), best_schema)
        .withColumn("place", F.row_number().over(by_class))
        .where(F.col("place") <= keep)
        .select("item", "score", F.explode("members").alias("id"))
        .withColumn("rank", F.row_number().over(by_member))
        .where(F.col("rank") <= keep)
    )
    named = spark.createDataFrame(list(enumerate(ids)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", T.LongType())]))
    return ranked.join(F.broadcast(named), "item").select("item_id", "rank", "id", "score")


def search(
    docs: DataFrame, items: DataFrame, keep: int = 10, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id"
) -> DataFrame:
    """Each item's ``keep`` best documents: item_column, rank, id_column, score.

    A document scores the sum, over an item's terms, of weight times saturated count (see
    ``_scores``); scores of 0 are left out, equal ones go by ascending id, rows without an id
    last. Null texts hold no term. Every row is a document of its own, also rows that repeat;
    every row of the items is asked, also repeated ones, and an item without terms finds nothing.
    Long texts are read whole; other columns are left out. Empty tables give no rows.

    Items are dealt by hash into blocks of about BLOCK_BYTES of text, and all documents are read
    once for each block; what goes to the tasks (words, weights, items by words) is a block's.
    """
    size = items.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    named = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    asked = items.select(F.col(item_column).cast("long").alias("item"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    found = []
    for i in range(blocks):
        part = asked.where(block == i).orderBy("item", "text").toArrow()
        if part.num_rows:
            found.append(_search_block(named, part.column(0).to_pylist(), as_bytes(part.column(1)), keep))
    if not found:
        found = [named.limit(0).select(F.lit(0).cast("long").alias("item_id"), F.lit(0).alias("rank"), "id", F.lit(0).cast("long").alias("score"))]
    result = reduce(DataFrame.unionByName, found)
    return result.select(F.col("item_id").alias(item_column), "rank", F.col("id").alias(id_column), "score")
