"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text has a lookup table over quantile bins, learned by boosting shallow trees
for one feature after the other in turn (cyclic boosting). Pairs of features whose joint table
explains most of what is left get a small two-dimensional table each. A score is the sum of table
entries, found by vectorised bin look-ups.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import as_bytes
from tidemark.session import materialise

FEATURES = (
    "log_bytes",
    "log_words",
    "word_length",
    "word_length_spread",
    "letters",
    "capitals",
    "digits",
    "punctuation",
    "symbols",
    "exclamations",
    "bars",
    "wide",
    "spaces",
    "words_per_line",
    "distinct_words",
    "most_frequent_word",
    "distinct_pairs",
    "repeated_lines",
    "sentence_ends",
    "words_ending_in_marks",
    "capital_words",
    "letterless_words",
)

_CLASSES = {
    "upper": range(ord("A"), ord("Z") + 1),
    "lower": range(ord("a"), ord("z") + 1),
    "digit": range(ord("0"), ord("9") + 1),
    "mark": b".,;:'\"()-?!",
    "symbol": b"#$%&*+/<=>@[\\]^_`{|}~",
    "exclaim": b"!",
    "bar": b"|",
    "wide": range(0x80, 0x100),
    "space": b" \t\n\r\x0b\x0c",
}
_MEMBER = np.array([[float(b in members) for members in map(set, _CLASSES.values())] for b in range(256)])
_ENDS = tuple(b".!?")
_MARKS = b"#$%&*+/<=>@\\^_`{|}~!"


def features(text: bytes) -> list[float]:
    """The features of one whole text; an empty text has zeros throughout."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    upper, lower, digit, mark, symbol, exclaim, bar, wide, space = (
        np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256) @ _MEMBER
    ).tolist()
    size, n = len(text), len(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    counts = Counter(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    last = [w[-1] for w in words]
    black = max(size - space, 1)
    return [
        float(np.log1p(size)),
        float(np.log1p(n)),
        float(lengths.mean()),
        float(lengths.std()),
        (upper + lower + wide) / black,
        upper / max(upper + lower, 1),
        digit / black,
        mark / black,
        symbol / black,
        exclaim / n,
        bar / n,
        wide / black,
        space / size,
        n / max(len(lines), 1),
        len(counts) / n,
        max(counts.values()) / n,
        len(set(zip(words, words[1:], strict=False))) / max(n - 1, 1),
        1 - len(set(lines)) / max(len(lines), 1),
        sum(map(last.count, _ENDS)) / n,
        sum(map(last.count, _MARKS)) / n,
        sum(map(bytes.isupper, words)) / n,
        sum(1 for w in words if not w.upper() != w.lower() and max(w) < 0x80) / n,
    ]


@dataclass
class AdditiveModel:
    intercept: float
    #: For each feature the inner borders of its bins and the table of the bins.
    borders: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    #: (first, second, borders of first, borders of second, table)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def scores(self, values: np.ndarray) -> np.ndarray:
        """Chances of label 1 for rows of features."""
        total = np.full(len(values), self.intercept)
        for i, (borders, table) in enumerate(zip(self.borders, self.tables, strict=True)):
            total += table[np.searchsorted(borders, values[:, i], side="right")]
        for i, j, rows, columns, table in self.pairs:
            total += table[np.searchsorted(rows, values[:, i], side="right"), np.searchsorted(columns, values[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _borders(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return gradient / (weight + 1.0)


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int) -> np.ndarray:
    """A shallow tree over ordered bins: the greedy best cuts, one value for each leaf."""
    spans = [(0, len(gradient))]
    sums = np.concatenate([[0.0], np.cumsum(gradient)]), np.concatenate([[0.0], np.cumsum(weight)])
    worth = lambda a, b: (sums[0][b] - sums[0][a]) ** 2 / (sums[1][b] - sums[1][a] + 1.0)
    while len(spans) < leaves:
        best = None
        for a, b in spans:
            cuts = np.arange(a + 1, b)
            if len(cuts):
                gains = worth(a, cuts) + worth(cuts, b) - worth(a, b)
                k = int(np.argmax(gains))
                if gains[k] > 1e-9 and (best is None or gains[k] > best[0]):
                    best = float(gains[k]), (a, b), int(cuts[k])
        if best is None:
            break
        _, (a, b), cut = best
        spans.remove((a, b))
        spans += [(a, cut), (cut, b)]
    out = np.zeros(len(gradient))
    for a, b in spans:
        out[a:b] = (sums[0][b] - sums[0][a]) / (sums[1][b] - sums[1][a] + 1.0)
    return out


def _cross(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree with one cut in each of two directions: its gain and the table of four leaves."""
    total = [np.pad(x, ((1, 0), (1, 0))).cumsum(axis=0).cumsum(axis=1) for x in (gradient, weight)]
    if min(gradient.shape) < 2:
        return 0.0, np.zeros_like(gradient)
    g, h = (x[1:-1, 1:-1] for x in total)
    down = [(x[1:-1, -1:], x[-1:, 1:-1], x[-1, -1]) for x in total]
    quarters = [(a, r - a, c - a, n - r - c + a) for a, (r, c, n) in zip((g, h), down, strict=True)]
    gains = sum(x**2 / (w + 1.0) for x, w in zip(*quarters, strict=True))
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    out = np.empty_like(gradient)
    leaves = [float(_leaf(x[i, j], w[i, j])) for x, w in zip(*quarters, strict=True)]
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = leaves
    return float(gains[i, j] - gradient.sum() ** 2 / (weight.sum() + 1.0)), out


def train(
    values: np.ndarray,
    labels: np.ndarray,
    rounds: int = 150,
    rate: float = 0.1,
    leaves: int = 3,
    bins: int = 48,
    pairs: int = 10,
    pair_bins: int = 12,
    pair_rounds: int = 50,
) -> AdditiveModel:
    """Boost the features in turn, choose the pairs by what is left, boost these in turn."""
    n = len(labels)
    share = (labels.sum() + 1) / (n + 2)
    model = AdditiveModel(float(np.log(share / (1 - share))))
    if n == 0:
        return model
    total = np.full(n, model.intercept)

    def pulls() -> tuple[np.ndarray, np.ndarray]:
        chance = 1 / (1 + np.exp(-total))
        return labels - chance, chance * (1 - chance)

    places = []
    for i in range(values.shape[1]):
        borders = _borders(values[:, i], bins)
        model.borders.append(borders)
        model.tables.append(np.zeros(len(borders) + 1))
        places.append(np.searchsorted(borders, values[:, i], side="right"))
    for _ in range(rounds):
        for place, table in zip(places, model.tables, strict=True):
            gradient, weight = pulls()
            step = rate * _tree(
                np.bincount(place, gradient, len(table)), np.bincount(place, weight, len(table)), leaves
            )
            table += step
            total += step[place]

    coarse = [_borders(values[:, i], pair_bins) for i in range(values.shape[1])]
    cells = [np.searchsorted(b, values[:, i], side="right") for i, b in enumerate(coarse)]

    def joint(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        place = cells[i] * shape[1] + cells[j]
        gradient, weight = pulls()
        return place, *[np.bincount(place, x, shape[0] * shape[1]).reshape(shape) for x in (gradient, weight)]

    gains = [
        (_cross(*joint(i, j)[1:])[0], i, j) for i in range(values.shape[1]) for j in range(i + 1, values.shape[1])
    ]
    for _, i, j in sorted(gains, reverse=True)[:pairs]:
        model.pairs.append((i, j, coarse[i], coarse[j], np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))))
    for _ in range(pair_rounds):
        for i, j, _, _, table in model.pairs:
            place, gradient, weight = joint(i, j)
            step = rate * _cross(gradient, weight)[1]
            table += step
            total += step.ravel()[place]
    return model


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    limit: int = 20_000,
    training: Column | None = None,
) -> AdditiveModel:
    """Train on at most ``limit`` labelled rows, chosen by hash of the id, with their whole texts.

    ``training`` is a condition on the label rows. Labels other than 0 and 1 are left out; rows
    that repeat count as often as they come, up to ``limit`` pairs of a label and a text in all:
    first one text of every id, then other texts, then copies. Texts become features in the
    tasks, and at most ``limit`` rows of these reach the driver. Without any labelled row every
    score is 0.5.
    """
    wanted = labels if training is None else labels.where(training)
    sample = (
        wanted.where(F.col(label_column).isin(0, 1))
        .select(id_column, F.col(label_column).cast("int").alias("__label"))
        .orderBy(F.xxhash64(id_column), id_column, "__label")
        .limit(limit)
        .groupBy(id_column, "__label")
        .agg(F.count("*").alias("__times"))
    )
    rows = docs.select(id_column, text_column).join(F.broadcast(sample), id_column)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(text) for text in as_bytes(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(found, pa.list_(pa.float64()))], names=["id", "label", "times", "features"]
            )

    measured = rows.select(text_column, F.xxhash64(id_column), "__label", "__times").mapInArrow(
        measure, "id long, label int, times long, features array<double>"
    )
    # Equal rows combine in the tasks; of each id and label one row goes before all others.
    by = ["id", "label"]
    distinct = materialise(measured.groupBy(*by, "features").agg(F.sum("times").alias("times")), "measured")
    first = distinct.groupBy(*by).agg(F.min(F.xxhash64("features")).alias("first"))
    found = (
        distinct.join(F.broadcast(first), by)
        .orderBy(F.xxhash64("features") != F.col("first"), F.xxhash64(*by, "features"), *by, "features")
        .limit(limit)
        .select("label", "times", "features")
        .toArrow()
    )
    if not found.num_rows:
        return AdditiveModel(0.0)
    more = np.minimum(np.cumsum(found.column("times").to_numpy() - 1), limit - found.num_rows)
    times = 1 + np.diff(more, prepend=0)
    values = np.repeat(np.array(found.column("features").to_pylist(), dtype=float), times, axis=0)
    truth = np.repeat(np.array(found.column("label").to_pylist(), dtype=float), times)
    order = np.lexsort((*values.T, truth))  # the order of rows in a scan is open; the model is not
    return train(values[order], truth[order])


def score_quality(docs: DataFrame, model: AdditiveModel, text_column: str = "text") -> DataFrame:
    """The rows with score (chance of label 1) and predicted (1 from 0.5 on).

    Null texts count as empty, and empty ones have features of zero. Input columns named like an
    output column are replaced.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    place = kept.index(text_column)
    schema = T.StructType(
        [docs.schema[c] for c in kept] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([features(text) for text in as_bytes(batch.column(place))], dtype=float)
            scores = held.value.scores(values.reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype("int32"), pa.int32())],
                names=schema.fieldNames(),
            )

    return docs.select(*kept).mapInArrow(score, schema)
