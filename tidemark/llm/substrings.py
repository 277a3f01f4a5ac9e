"""Removal of passages that occur more than once, with sharded Aho-Corasick automata.

Three passes over the texts. (1) Every text gives its anchors: phrases chosen by the words of the
windows that hold them, so windows that recur share anchors that recur. Anchors are counted over
all texts. (2) Windows whose anchor recurs are hashed to 128 bits and counted: those met twice or
more are confirmed. (3) The confirmed windows of each document shard make up passages; these are
compiled into the shard's automaton over words, and the shard's documents run through it, which
locates every occurrence and so every word to remove.

Documents are dealt into shards of a few megabytes by hash, and only hashes travel between
documents: one row for each hash and shard, however often it occurs there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import anchors, as_bytes, least_phrases, sequence_hashes, word_hashes
from tidemark.session import discard, materialise

#: Bytes of text in a shard, on average.
SHARD_BYTES = 4 << 20
#: Words of an anchor. A shorter one recurs by chance, a longer one leaves fewer places to choose from.
ANCHOR_WORDS = 12


def _distinct(*columns: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of equally long columns and how often each occurs."""
    if not len(columns[0]):
        return list(columns), np.zeros(0, dtype=np.int64)
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    first = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns], axis=0)])
    starts = np.flatnonzero(first)
    return [c[starts] for c in columns], np.diff(np.append(starts, len(first)))


def _recurring(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Of rows (keys, shard, n) those whose keys sum up to two or more: one for each keys and shard.

    Sums combine in the tasks first. The join with the recurring keys is a plain one of stored
    tables, which adaptive execution splits where a key stands in most shards.
    """
    stored = materialise(rows, f"{label}-seen")
    twice = materialise(stored.groupBy(*keys).agg(F.sum("n").alias("n")).where("n > 1").select(*keys), f"{label}-twice")
    found = materialise(stored.join(twice, keys, "left_semi").select("shard", *keys).distinct(), label)
    discard(stored, twice)
    return found


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64), pa.int64())


def _unsigned(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64, copy=False).view(np.uint64)


def _anchor_rows(window: int, phrase: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards = batch.column(0).to_numpy(zero_copy_only=False)
            found = [anchors(word_hashes(text), phrase, window)[1] for text in as_bytes(batch.column(1))]
            (hashes, at), n = _distinct(np.concatenate(found), np.repeat(shards, [len(x) for x in found]))
            yield pa.RecordBatch.from_arrays(
                [_signed(hashes), pa.array(at, pa.int32()), pa.array(n, pa.int32())], names=["anchor", "shard", "n"]
            )

    return rows


class HashSet:
    """Distinct 64-bit hashes in order, with a table of their low bits that rules most others out."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.ordered = np.unique(hashes)
        self.mask = np.uint64((1 << max(10, (8 * len(self.ordered)).bit_length())) - 1)
        self.table = np.zeros(int(self.mask) + 1, dtype=bool)
        self.table[(self.ordered & self.mask).astype(np.int64)] = True

    def places(self, values: np.ndarray) -> np.ndarray:
        """Places of the values that are in the set."""
        may = np.flatnonzero(self.table[(values & self.mask).astype(np.int64)])
        at = np.searchsorted(self.ordered, values[may])
        at[at == len(self.ordered)] = 0
        return may[self.ordered[at] == values[may]] if len(self.ordered) else may[:0]


def _window_rows(window: int, phrase: int):
    def rows(key: tuple, texts: pa.Table, routed: pa.Table) -> pa.Table:
        known = HashSet(_unsigned(routed.column("anchor")))
        first, second = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for text in as_bytes(texts.column("text")) if len(known.ordered) else ():
            hashes = word_hashes(text)
            candidates = known.places(least_phrases(hashes, phrase, window))
            if len(candidates):
                first.append(sequence_hashes(hashes, window)[candidates])
                second.append(sequence_hashes(word_hashes(text, 1), window, 1)[candidates])
        (one, two), n = _distinct(np.concatenate(first), np.concatenate(second))
        return pa.table(
            {"h1": _signed(one), "h2": _signed(two), "shard": pa.array([key[0].as_py()] * len(n), pa.int32()), "n": pa.array(n, pa.int32())}
        )

    return rows


def _starts(text: bytes, window: int, known: HashSet, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Starts of the confirmed windows of a text; (one, two) are their hashes in order."""
    grams = sequence_hashes(word_hashes(text), window)
    places = known.places(grams)
    if not len(places):
        return places
    first, other = grams[places], sequence_hashes(word_hashes(text, 1), window, 1)[places]
    at, found = np.searchsorted(one, first), np.zeros(len(places), dtype=bool)
    while True:
        same = (at < len(one)) & (one[np.minimum(at, len(one) - 1)] == first)
        if not same.any():
            return places[found]
        found |= same & (two[np.minimum(at, len(two) - 1)] == other)
        at = at + 1


def _tiles(starts: np.ndarray, window: int) -> Iterator[int]:
    """Starts of windows that cover the passages of consecutive confirmed windows and no other word."""
    breaks = np.flatnonzero(np.diff(starts) > 1) + 1
    for run in np.split(starts, breaks):
        yield from range(int(run[0]), int(run[-1]), window)
        yield int(run[-1])


def locate(texts: list[bytes], window: int, one: np.ndarray, two: np.ndarray) -> list[np.ndarray | None]:
    """Which words of each text lie in an occurrence of a passage (None: none does).

    Passages are tiled with windows, so that all patterns have one length: at most one of them
    ends at any word, whatever the texts repeat.
    """
    import ahocorasick

    known, numbers = HashSet(one), dict[bytes, int]()
    streams: list[tuple[int, ...] | None] = []
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for text in texts:
        starts = _starts(text, window, known, one, two) if len(one) else ()
        if not len(starts):
            streams.append(None)
            continue
        stream = tuple([numbers.setdefault(word, len(numbers)) for word in text.split()])
        for start in _tiles(starts, window):
            automaton.add_word(stream[start : start + window], 1)
        streams.append(stream)
    if not len(automaton):
        return [None] * len(texts)
    automaton.make_automaton()
    out: list[np.ndarray | None] = []
    for stream in streams:
        if stream is None:
            out.append(None)
            continue
        ends = np.fromiter((end for end, _ in automaton.iter(stream)), dtype=np.int64)
        depth = np.zeros(len(stream) + 1, dtype=np.int64)
        np.add.at(depth, ends - window + 1, 1)
        np.add.at(depth, ends + 1, -1)
        out.append(np.cumsum(depth[:-1]) > 0)
    return out


def _removal(window: int, carried: Sequence[str], text_column: str, schema: pa.Schema):
    def rows(key: tuple, docs: pa.Table, confirmed: pa.Table) -> pa.Table:
        one, two = (_unsigned(confirmed.column(c)) for c in ("h1", "h2"))
        order = np.lexsort((two, one))
        texts = as_bytes(docs.column(text_column))
        kept, total, removed, spans = [], [], [], []
        for text, covered in zip(texts, locate(texts, window, one[order], two[order]), strict=True):
            words = text.split()
            if covered is None:
                covered = np.zeros(len(words), dtype=bool)
            edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
            kept.append(b" ".join(compress(words, (~covered).tolist()) if len(edges) else words))
            total.append(len(words))
            removed.append(int(covered.sum()))
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)])
        new = [kept, total, removed, spans]
        columns = [docs.column(c) for c in carried] + [pa.array(x, schema.field(len(carried) + i).type) for i, x in enumerate(new)]
        return pa.Table.from_arrays(columns, schema=schema)

    return rows


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = 35, carried: Sequence[str] | None = None
) -> DataFrame:
    """The carried columns (default: all) with kept, n_words, n_removed and spans.

    A word goes if it lies in a window of ``window`` consecutive words of one document whose words
    also start anywhere else, in the same document or another; all occurrences go, also the first.
    ``kept`` holds the other words joined by single spaces, ``spans`` the removed ranges of words
    (end exclusive). Null texts count as empty; texts of fewer words are kept whole. Every row is
    a document of its own, also rows that repeat: their passages then occur twice. An empty table
    gives no rows. Input columns named like an output column are replaced.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    carried = [c for c in (carried or docs.columns) if c not in ("kept", "n_words", "n_removed", "spans")]
    text = F.coalesce(F.col(text_column), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shard = F.pmod(F.xxhash64(id_column, text_column), F.lit(max(1, -(-size // SHARD_BYTES)))).cast("int")
    texts = docs.select(shard.alias("shard"), text.alias("text"))
    phrase = min(ANCHOR_WORDS, window)

    seen = texts.mapInArrow(_anchor_rows(window, phrase), "anchor long, shard int, n int")
    routed = _recurring(seen, ["anchor"], "anchors")
    windows = (
        texts.groupBy("shard")
        .cogroup(routed.groupBy("shard"))
        .applyInArrow(_window_rows(window, phrase), "h1 long, h2 long, shard int, n int")
    )
    confirmed = _recurring(windows, ["h1", "h2"], "windows")
    discard(routed)

    schema = T.StructType(
        [
            *[docs.schema[c] for c in carried],
            T.StructField("kept", T.StringType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        ]
    )
    # The text travels once, also where it is among the carried columns.
    own = text_column if text_column in carried else "__text"
    keyed = docs.select(*carried, shard.alias("__shard"), *([] if own == text_column else [text.alias(own)]))
    return (
        keyed.groupBy("__shard")
        .cogroup(confirmed.groupBy("shard"))
        .applyInArrow(_removal(window, carried, own, to_arrow_schema(schema)), schema)
    )
