"""Held-out rows and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.session import materialise


def held_out(key: Column) -> Column:
    """Whether crc32 of the key as text leaves 1 when divided by 3; null counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def text_hash(text: str) -> Column:
    """Tells the texts of rows with one key and label apart; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def balanced_sample(rows: DataFrame, label: str, key: str, each: int, total: int, text: str | None = None) -> DataFrame:
    """(key, label): up to ``each`` rows of every label and ``total`` in all, by hash of the key.

    With a ``text`` column, its hash comes along as __text. Rows that repeat count as rows. Labels
    are counted first, and of each only the share of hashes that is expected to hold twice the
    rows wanted goes on to be ranked, so the label of most rows is no burden; a rare label goes on
    whole.
    """
    more = [] if text is None else [text_hash(text).alias("__text")]
    narrow = rows.where(F.col(label).isNotNull()).select(key, label, *more)
    wanted = narrow.columns
    counts = materialise(narrow.groupBy(F.col(label).alias("__label")).agg(F.count("*").alias("__n")), "labels")
    unit = F.pmod(F.xxhash64(key), F.lit(1 << 30))
    order = ["__unit", key, *wanted[2:]]
    ranked = (
        narrow.join(counts, F.col(label) == F.col("__label"))
        .withColumn("__unit", unit)
        .where(F.col("__unit").cast("double") * F.col("__n") < float(2 * each) * (1 << 30))
        .withColumn("__rank", F.row_number().over(W.partitionBy(label).orderBy(*order)))
        .where(F.col("__rank") <= each)
    )
    return ranked.orderBy("__rank", *order, label).limit(total).select(*wanted)


def with_text(docs: DataFrame, sample: DataFrame, key: str, label: str, text: str) -> DataFrame:
    """(key, text, label, __times): the sampled rows with their own whole texts, each once.

    The sample, whose size is bounded, is broadcast. A row is known by key, label and text, so
    siblings under one key keep their labels; copies are put together before anything travels,
    and ``__times`` is how often the sample holds the row.
    """
    drawn = sample.groupBy(*sample.columns).agg(F.count("*").alias("__times")).toDF("__k", "__l", "__t", "__times")
    same = F.col(key).eqNullSafe(F.col("__k")) & (F.col(label) == F.col("__l")) & (text_hash(text) == F.col("__t"))
    found = docs.select(key, text, label).join(F.broadcast(drawn), same)
    return found.groupBy(key, label, "__t").agg(F.first(text).alias(text), F.first("__times").alias("__times")).select(key, text, label, "__times")
