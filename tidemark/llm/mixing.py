"""Mixing sources to target weights with hash-threshold histograms.

Sizes are summed by source and hash bucket, the bucket in which the budget falls is refined by the
next bits of the hash, and rows are then taken by comparing their hash with one threshold for each
source. Nothing is sorted, and a larger budget only ever adds documents (nested thresholds).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.words import WORD
from tidemark.session import materialise

#: Bits of the hash that each round of the histogram resolves: 4096, then 1024 and 1024 buckets.
ROUNDS = (12, 10, 10)


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def unit_hash(key: Column) -> Column:
    """32 bits of a document's key, the same in every run and in any SQL engine."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], repeats: int) -> DataFrame:
    """(source, source_size, target, whole, budget) of every source in (source, size).

    Sources by code point, null last, get the weights in turn and share the total of all sizes.
    A target stops at ``repeats`` times its source's size; what is over is shared again by weight
    until no target is above. That is solved at once: by rising size per weight, a source is
    capped if its share of what earlier capped sources leave would exceed its cap. ``whole`` is
    how often every document is taken, ``budget`` what is still to be taken after that.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row for each source from here on, so the windows without a key see sources, not documents.
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), (turn + 1).cast("int"))
    by_room = W.orderBy((F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    shared = (
        totals.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * repeats)
        .withColumn("size_left", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("capped", F.col("cap") * F.col("weight_left") <= F.col("weight") * F.col("size_left"))
    )
    # What is left for the first source that is not capped holds for all that follow.
    free = [
        F.min(F.when(~F.col("capped"), F.struct("source_size", "size_left"))),
        F.max(F.when(~F.col("capped"), F.col("weight_left"))),
        F.max(F.when(~F.col("capped"), F.col("size_left"))),
    ]
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        F.col("weight").cast("double") * free[2].over(everything) / free[1].over(everything)
    )
    whole = F.when(F.col("capped"), F.lit(repeats)).when(F.col("source_size") == 0, F.lit(0)).otherwise(
        F.floor(F.col("target") / F.col("source_size"))
    )
    return (
        shared.withColumn("target", target)
        .withColumn("whole", whole.cast("long"))
        .select("source", "source_size", "target", "whole", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget"))
    )


def thresholds(sizes: DataFrame, weights: Sequence[int], repeats: int) -> DataFrame:
    """(source, source_size, target, whole, threshold) from (source, size, unit).

    A document is taken once more than ``whole`` times if its unit lies below the threshold. The
    last round of the histogram ends at one value of the hash; the documents of that value are
    taken too if that brings the source nearer to its target.
    """
    targets = materialise(source_targets(sizes, weights, repeats), "targets")
    spent = targets.select(F.col("source").alias("s"), "budget", F.lit(0).cast("long").alias("low"), F.lit(0.0).alias("below"))
    shift = sum(ROUNDS)
    for bits in ROUNDS:
        shift -= bits
        inside = (F.col("unit") >= F.col("low")) & (F.col("unit") < F.col("low") + F.lit(1 << (shift + bits)))
        histogram = (
            sizes.join(spent, F.col("source").eqNullSafe(F.col("s")) & inside)
            .groupBy("s", "budget", "below", F.shiftright("unit", shift).alias("bucket"))
            .agg(F.sum("size").alias("held"))
        )
        # At most 2 ** bits rows for each source.
        running = W.partitionBy("s").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
        spent = materialise(
            histogram.withColumn("below", F.col("below") + F.coalesce(F.sum("held").over(running), F.lit(0)))
            .where((F.col("below") < F.col("budget")) & (F.col("budget") <= F.col("below") + F.col("held")))
            .select("s", "budget", F.shiftleft("bucket", shift).alias("low"), "below", "held"),
            "thresholds",
        )
    nearer = (F.col("below") + F.col("held") - F.col("budget")) < (F.col("budget") - F.col("below"))
    cut = spent.select("s", (F.col("low") + F.when(nearer, 1).otherwise(0)).alias("threshold"))
    return targets.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "whole", F.coalesce("threshold", F.lit(0)).alias("threshold")
    )


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    size_column: str | None = None,
    weights: Sequence[int] = (5, 2, 1),
    repeats: int = 3,
) -> DataFrame:
    """Documents with size, source_size, target, copies (how often it is taken) and taken words.

    ``size_column`` names sizes that are known already; otherwise words are counted. Null sizes and
    null or empty texts have size 0; a null source is a source of its own. Documents of one key
    share one hash, so repeated rows are taken together. An empty table gives an empty result.
    Input columns named like an output column are replaced; all others are kept.
    """
    size = word_count(F.col(text_column)) if size_column is None else F.coalesce(F.col(size_column).cast("long"), F.lit(0))
    narrow = materialise(
        docs.select(F.col(source_column).alias("source"), size.alias("size"), unit_hash(F.col(id_column)).alias("unit")),
        "sizes",
    )
    cuts = materialise(thresholds(narrow, weights, repeats), "cuts")
    cuts = cuts.select(*[F.col(c).alias(f"__mix_{c}") for c in cuts.columns])
    joined = docs.withColumn("__mix_size", size).join(cuts, F.col(source_column).eqNullSafe(F.col("__mix_source")))
    copies = F.col("__mix_whole") + F.when(unit_hash(F.col(id_column)) < F.col("__mix_threshold"), 1).otherwise(0)
    new = {
        "size": F.col("__mix_size"),
        "source_size": F.col("__mix_source_size"),
        "target": F.col("__mix_target"),
        "copies": copies,
        "taken": F.col("__mix_size") * copies,
    }
    return joined.select(*[docs[c] for c in docs.columns if c not in new], *[v.alias(k) for k, v in new.items()])


def take(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: each document as many times as it is taken, with the given columns."""
    return mixed.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*columns)
