"""From raw documents to packed token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read
again as the docs of the next one. All but the last return the columns of their docs: those that
they read (``READ``) and any others, also ones named like a result of an operator. Every row is a
document of its own, also rows that repeat; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, mixing, packing, simhash, substrings
from tidemark.llm.labelled import held_out
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.shared import prepare
from tidemark.session import materialise


#: Columns that the stages read. All others are only carried.
READ = ("doc_id", "text", "lang", "source", "n_chars")


def set_aside(docs: DataFrame) -> DataFrame:
    """The carried columns under names that no operator gives to its results."""
    return docs.toDF(*[c if c in READ else f"__carried_{i}" for i, c in enumerate(docs.columns)])


def restored(found: DataFrame, aside: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, in order and under their names."""
    return found.select(*[F.col(a).alias(c) for a, c in zip(aside.columns, docs.columns, strict=True)])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is recognised; the others go, as do texts without letters."""
    prepare(spark)
    aside = set_aside(docs)
    model = langid.fit_languages(aside, training=~held_out(F.col("doc_id")))
    return restored(langid.identify(aside, model).where(~F.col("rejected")), aside, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the least id. Texts without words are alike."""
    prepare(spark)
    aside = set_aside(docs)
    return restored(simhash.near_duplicates(aside).where("kept"), aside, docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the passages of 35 words or more that occur more than once.

    A text that loses words is its other words joined by single spaces, with n_chars counted anew;
    all other texts stay as they are. A document that loses all its words stays, empty.
    """
    prepare(spark)
    aside = set_aside(docs)
    cleaned = substrings.remove_repeats(aside)
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept")).otherwise(F.col("text"))
    new = {"text": text, "n_chars": F.when(changed, F.length("kept").cast("long")).otherwise(F.col("n_chars"))}
    return restored(cleaned.withColumns(new), aside, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; null texts have size 0, and a null source is a source."""
    prepare(spark)
    aside = set_aside(docs)
    return restored(mixing.take(mixing.mix(aside), aside.columns), aside, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths with their token ids; a null text is an empty one, of one id."""
    prepare(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", remove_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Fingerprints, training and tokenizing are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each on all that the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
