"""Language identification: averaged hashed subword embeddings and a linear softmax.

The byte 2-, 3- and 4-grams of a text's words are hashed to buckets, their embeddings are averaged
over the whole text, and a linear layer gives a score for each language. Embeddings and layer are
trained together by stochastic gradient descent in numpy on a bounded sample; a part of it that is
kept apart sets the temperature of the softmax and the bounds of the rejection.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.labelled import balanced_sample, with_text
from tidemark.llm.words import as_bytes

UNDETERMINED = "und"
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
ORDERS = (2, 3, 4)
#: Bytes that are worked on at a time.
CHUNK = 1 << 20

_GAP = 0x20
_FOLD = np.full(256, _GAP, dtype=np.uint8)
_FOLD[0x80:] = np.arange(0x80, 256)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def has_letter(text: bytes) -> bool:
    """Whether any character is a letter of any script."""
    return any(b"a"[0] <= b <= b"z"[0] for b in text.lower()[:64]) or any(c.isalpha() for c in text.decode("utf-8"))


def subwords(text: bytes) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text, piece by piece; a gap stands at the first or last byte only."""
    folded = np.concatenate([[_GAP], _FOLD[np.frombuffer(text, dtype=np.uint8)], [_GAP]]).astype(np.uint32)
    for at in range(0, len(folded), CHUNK):
        part = folded[at : at + CHUNK + max(ORDERS) - 1]
        gap = part == _GAP
        for order in ORDERS:
            size = min(len(part) - order + 1, CHUNK)
            if size <= 0:
                continue
            code = part[:size].copy()
            broken = gap[:size] & gap[1 : 1 + size] if order == 2 else gap[1 : 1 + size].copy()
            for k in range(1, order):
                code |= part[k : k + size] << np.uint32(8 * k)
                if 1 < k < order - 1:
                    broken |= gap[k : k + size]
            code = (code + np.uint32(order)) * np.uint32(0x9E3779B1)
            code ^= code >> np.uint32(15)
            yield ((code * np.uint32(0x85EBCA77)) >> np.uint32(32 - BUCKET_BITS))[~broken]


@dataclass
class LanguageModel:
    languages: list[str]
    #: A row for each bucket: the languages' scores, and whether training texts held the bucket.
    table: np.ndarray
    bias: np.ndarray
    least_score: float
    least_seen: float

    def logits(self, text: bytes) -> tuple[np.ndarray, float]:
        total, count = np.zeros(self.table.shape[1]), 0
        for buckets in subwords(text):
            total += self.table[buckets].sum(axis=0, dtype=np.float64)
            count += len(buckets)
        total /= max(count, 1)
        return total[:-1] + self.bias, float(total[-1])

    def judge(self, text: bytes) -> tuple[str, float, bool]:
        """(language, score, rejected)."""
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0, True
        logits, seen = self.logits(text)
        odds = np.exp(logits - logits.max())
        best = int(np.argmax(odds))
        score = float(odds[best] / odds.sum())
        return self.languages[best], score, bool(score < self.least_score or seen < self.least_seen)


def counted(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for buckets in subwords(text):
        counts += np.bincount(buckets, minlength=BUCKETS)
    held = np.flatnonzero(counts)
    return held, counts[held]


def train(
    examples: list[tuple[np.ndarray, np.ndarray, str]], width: int = 16, epochs: int = 12, rate: float = 0.5, seed: int = 7
) -> LanguageModel:
    """A model of (buckets, counts, language) examples; a fifth of them calibrates it."""
    languages = sorted({language for _, _, language in examples})
    place = {language: i for i, language in enumerate(languages)}
    rows = [(held, counts / counts.sum(), place[language]) for held, counts, language in examples if len(held)]
    if not rows:
        # Nothing to learn from: every text is without a language.
        return LanguageModel([], np.zeros((BUCKETS, 1), np.float32), np.zeros(0), 0.0, 0.0)
    rng = np.random.default_rng(seed)
    kept, fitted = rows[::5], [row for i, row in enumerate(rows) if i % 5] or rows
    inner = rng.uniform(-1 / width, 1 / width, (BUCKETS, width))
    outer, bias = rng.normal(0, 1 / width**0.5, (width, len(languages))), np.zeros(len(languages))
    # A mean over n subwords moves each of them by 1/n of the step; the rate of the embeddings makes up for it.
    steps, done = epochs * len(fitted), 0
    for _ in range(epochs):
        for i in rng.permutation(len(fitted)):
            held, share, truth = fitted[i]
            now = rate * (1 - done / steps)
            done += 1
            mean = share @ inner[held]
            odds = mean @ outer + bias
            odds = np.exp(odds - odds.max())
            wrong = odds / odds.sum()
            wrong[truth] -= 1
            pull = outer @ wrong
            outer -= now * np.outer(mean, wrong)
            bias -= now * 0.1 * wrong
            inner[held] -= now * np.outer(share / np.sqrt(share @ share), pull)
    seen = np.zeros((BUCKETS, 1))
    for held, _, _ in rows:
        seen[held] = 1
    table, known = inner @ outer, np.zeros((BUCKETS, 1))
    for held, _, _ in fitted:
        known[held] = 1
    logits = np.array([share @ table[held] + bias for held, share, _ in kept])
    truth = np.array([t for _, _, t in kept])
    scaled = lambda t: np.exp(logits / t - (logits / t).max(axis=1, keepdims=True))
    chance = lambda t: scaled(t) / scaled(t).sum(axis=1, keepdims=True)
    heat = min(np.geomspace(0.05, 5, 60), key=lambda t: -np.log(np.maximum(chance(t)[np.arange(len(truth)), truth], 1e-6)).mean())
    final = chance(heat)
    right = final.argmax(axis=1) == truth
    # Few right answers (one in a thousand) may be rejected, and none whose chance lies past the middle
    # between blind chance and an even one, so that a text in two languages is kept.
    middle = (1 / len(languages) + 0.5) / 2
    least = min(middle, float(np.quantile(final.max(axis=1)[right], 0.001))) if right.any() else middle
    familiar = min((float(share @ known[held, 0]) for held, share, _ in kept), default=0.0)
    return LanguageModel(
        languages, np.hstack([table / heat, seen]).astype(np.float32), bias / heat, least, 0.5 * familiar
    )


def fit_languages(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    each: int = 600,
    total: int = 6000,
    training: Column | None = None,
) -> LanguageModel:
    """Train on at most ``each`` rows of every language, ``total`` in all, with their whole texts.

    ``training`` marks the rows that may be learned from. Texts are turned into bucket counts in
    the tasks (at most 2 ** 15 numbers a text); only those reach the driver. Rows without a
    language are left out; of rows that share an id, each text keeps its own language, and rows
    that repeat count as often as they are drawn. Without any labelled text that has an n-gram no
    language is learned.
    """
    allowed = docs if training is None else docs.where(training)
    sample = balanced_sample(allowed, language_column, id_column, each, total, text_column)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counted(text) for text in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.string()),
                    batch.column(2),
                    pa.array([h.astype("<u2").tobytes() for h, _ in found], pa.binary()),
                    pa.array([c.astype("<u4").tobytes() for _, c in found], pa.binary()),
                    batch.column(3),
                ],
                names=["key", "language", "held", "counts", "times"],
            )

    rows = (
        with_text(allowed, sample, id_column, language_column, text_column)
        .mapInArrow(counts, "key string, language string, held binary, counts binary, times long")
        .toArrow()
        .to_pylist()
    )
    rows = [row for row in rows for _ in range(row["times"])]
    rows.sort(key=lambda r: (r["key"] or "", r["language"], r["held"]))
    order = np.random.default_rng(1).permutation(len(rows))
    return train(
        [
            (np.frombuffer(r["held"], "<u2").astype(np.int64), np.frombuffer(r["counts"], "<u4").astype(float), r["language"])
            for r in (rows[i] for i in order)
        ]
    )


def identify(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """The rows with lang_pred, score and rejected.

    A null text and one without any letter are ``und`` with score 0, rejected; so is every text if
    no language was learned. Very long texts are read in pieces, whole. Input columns named like
    an output column are replaced.
    """
    new = ("lang_pred", "score", "rejected")
    kept = [c for c in docs.columns if c not in new]
    schema = T.StructType(
        [docs.schema[c] for c in kept]
        + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    )
    place = kept.index(text_column)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [held.value.judge(text) for text in as_bytes(batch.column(place))]
            languages, scores, rejected = (list(x) for x in zip(*found, strict=True)) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(languages, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                names=schema.fieldNames(),
            )

    return docs.select(*kept).mapInArrow(judge, schema)
