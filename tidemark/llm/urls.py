"""URL filter: rules first, then host word segmentation and multinomial naive Bayes.

Names written together in hosts and paths are split into words by the unigram Viterbi path, with
word counts from the text of all pages. Naive Bayes over the words of host and path is trained by
distant supervision: a page is an example to block if its host holds a seed word, else to allow.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import as_bytes
from tidemark.session import materialise

#: Host words that mark a page as an example to block.
SEED_WORDS = (
    "adult", "bet", "bets", "betting", "casino", "gambling", "jackpot", "loan", "loans", "lottery",
    "pills", "poker", "porn", "sex", "slots", "spam", "viagra", "warez", "xxx",
)
LONGEST_WORD = 20
#: Words of text are counted as often as they come; a seed word counts this much more.
SEED_COUNT = 1000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both are empty where it is null or has no ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits as a struct (text, verdict), null if none does."""
    found = None
    for rule in sorted(rules, key=lambda r: -len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found if found is not None else F.lit(None).cast("struct<text:string,verdict:string>")


def chunks(host: Column, path: Column) -> Column:
    """Runs of letters a to z of host and path as array<struct<field, chunk>>."""

    def letters(field: str, text: Column) -> Column:
        runs = F.regexp_extract_all(text, F.lit("[a-z]+"), 0)
        return F.transform(runs, lambda c: F.struct(F.lit(field).alias("field"), c.alias("chunk")))

    return F.concat(letters("host", host), letters("path", F.translate(path, _UPPER, _LOWER)))


_TAGS = re.compile(rb"<(?:script|style)\b.*?</(?:script|style)\s*>|<[^>]*>", re.DOTALL)
_TEXT_WORDS = re.compile(rb"(?<![a-z\x80-\xff])[a-z]{1,20}(?![a-z\x80-\xff])")


def page_words(pages: DataFrame, html_column: str) -> DataFrame:
    """(word, n): lower-case ASCII words of the pages' text outside tags, counted in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[bytes] = Counter()
            for html in as_bytes(batch.column(0)):
                found.update(_TEXT_WORDS.findall(_TAGS.sub(b" ", html.lower())))
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.decode() for w in found], pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"]
            )

    return pages.select(html_column).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def best_split(chunk: str, known: dict[str, int], total: int) -> list[str]:
    """The most likely split of a chunk into words; an unknown word costs the more the longer it is.

    The state of every end is the best split up to there. Letters that no known word covers end
    up in unknown words of LONGEST_WORD letters at most.
    """
    best, back = [0.0] + [-math.inf] * len(chunk), [0] * (len(chunk) + 1)
    floor = math.log(10.0 / max(total, 1))
    for end in range(1, len(chunk) + 1):
        for start in range(max(0, end - LONGEST_WORD), end):
            count = known.get(chunk[start:end])
            cost = math.log(count / total) if count else floor - (end - start) * math.log(10.0)
            if best[start] + cost > best[end]:
                best[end], back[end] = best[start] + cost, start
    words, end = [], len(chunk)
    while end:
        words.append(chunk[back[end] : end])
        end = back[end]
    return words[::-1]


def segmented(names: DataFrame, words: DataFrame) -> DataFrame:
    """(chunk, words) of distinct chunks, given (word, n).

    The word counts stay distributed: every substring of a chunk meets its count by a join, and
    only the counts of its own substrings, at most LONGEST_WORD times its letters, meet in a row.
    """
    total = words.agg(F.sum("n")).first()[0] or 1
    starts = F.sequence(F.lit(1), F.length("chunk"))
    parts = (
        names.select("chunk", F.explode(starts).alias("start"))
        .select("chunk", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("chunk") - F.col("start") + 1))).alias("size"))
        .select("chunk", F.substring("chunk", F.col("start"), F.col("size")).alias("word"))
        .distinct()
    )
    known = parts.join(words, "word").groupBy("chunk").agg(F.collect_list("word").alias("known"), F.collect_list("n").alias("counts"))

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split(chunk: pd.Series, known: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series(
            [
                best_split(c, {} if k is None else dict(zip(k, n, strict=True)), total)
                for c, k, n in zip(chunk, known, counts, strict=True)
            ]
        )

    return names.join(known, "chunk", "left").select("chunk", split("chunk", "known", "counts").alias("words"))


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    seeds: Sequence[str] = SEED_WORDS,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    smoothing: float = 1.0,
) -> DataFrame:
    """The id with host, path, rule, verdict, block_score (chance to block) of every row.

    A URL that is null or has no :// has an empty host and path, no rule and no words; its score
    is the share of pages to block. Rows that repeat are judged alike. Pages without text leave
    the seed words as the only known ones. An empty table gives no rows.
    """
    host, path = url_parts(F.col(url_column))
    parsed = materialise(
        pages.select(F.col(id_column).alias("id"), host.alias("host"), path.alias("path"))
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("chunks", chunks(F.col("host"), F.col("path"))),
        "urls",
    )
    spread = parsed.select("row", F.explode("chunks").alias("c")).select("row", "c.field", "c.chunk")
    names = materialise(spread.select("chunk").distinct(), "chunks")

    # Parts of hyphenated names are words by the writer's own hand.
    hyphenated = (
        parsed.select(F.explode(F.split("host", r"\.")).alias("label"))
        .where(F.col("label").contains("-"))
        .select(F.explode(F.regexp_extract_all("label", F.lit("[a-z]+"), 0)).alias("word"))
        .where(F.length("word") <= LONGEST_WORD)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )
    sown = pages.sparkSession.createDataFrame([(word, SEED_COUNT) for word in seeds], "word string, n long")
    words = materialise(
        page_words(pages, html_column).unionByName(hyphenated).unionByName(sown).groupBy("word").agg(F.sum("n").alias("n")), "words"
    )
    split = materialise(segmented(names, words), "segments")

    # Distant supervision: pages whose host holds a seed word.
    marked = split.where(F.arrays_overlap("words", F.array(*[F.lit(s) for s in seeds]))).select("chunk")
    to_block = materialise(spread.where("field = 'host'").join(marked, "chunk", "left_semi").select("row").distinct(), "examples")
    # One number for each (field, chunk) and class, however many pages hold it.
    seen = materialise(
        spread.join(to_block.withColumn("blocked", F.lit(1)), "row", "left")
        .groupBy("field", "chunk")
        .agg(F.count("*").alias("n"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("blocked")),
        "tokens",
    )
    tokens = seen.join(split, "chunk").select("field", "chunk", "n", "blocked", F.explode("words").alias("word"))
    counts = materialise(
        tokens.groupBy("field", "word").agg(F.sum("blocked").alias("bad"), F.sum(F.col("n") - F.col("blocked")).alias("good")), "counts"
    )
    size, bad, good = counts.agg(F.count("*"), F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))).first()
    n_rows, n_bad = parsed.count(), to_block.count()
    chance = lambda n, of: F.log((n + smoothing) / F.lit(of + smoothing * max(size, 1)))
    weights = counts.select("field", "word", (chance(F.col("bad"), bad) - chance(F.col("good"), good)).alias("weight"))
    scores = materialise(
        seen.join(split, "chunk")
        .select("field", "chunk", F.explode("words").alias("word"))
        .join(weights, ["field", "word"])
        .groupBy("field", "chunk")
        .agg(F.sum("weight").alias("weight")),
        "weights",
    )
    prior = math.log((n_bad + smoothing) / (n_rows - n_bad + smoothing))
    summed = (
        parsed.select("row", "id", "host", "path", F.explode_outer("chunks").alias("c"))
        .select("row", "id", "host", "path", F.col("c.field").alias("field"), F.col("c.chunk").alias("chunk"))
        .join(scores, ["field", "chunk"], "left")
        .groupBy("row", "id", "host", "path")
        .agg(F.coalesce(F.sum("weight"), F.lit(0.0)).alias("weight"))
    )
    odds = F.round(F.col("weight") + prior, 9)
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    return summed.withColumn("rule", rule).select(
        F.col("id").alias(id_column),
        "host",
        "path",
        F.col("rule.text").alias("rule"),
        F.coalesce("rule.verdict", F.when(odds > 0, "block").otherwise("allow")).alias("verdict"),
        (1 / (1 + F.exp(-odds))).alias("block_score"),
    )
