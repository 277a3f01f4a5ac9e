"""Alignment of two tokenizers over the same texts, group by group, and how often ids meet.

Both tokenizers cut the bytes of space + text. Where tokens of both end at the same byte, a group
ends: the ends of one side are keys of a dictionary (end -> index), the intersection of both key
sets in order slices both id lists, and links are expanded slice by slice.

Neither tokenizer looks across a place where a character other than white space is followed by a
space. Such places are ends of tokens of both, so no group and no link reaches across, and a text
is the sequence of its chunks between them. Chunks repeat; each is aligned once and kept.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import discard, materialise

#: Bytes of text whose links are counted together and share one set of corpus counts.
SHARD_BYTES = 4 << 20
#: Chunks in each of the two generations of a worker's cache, and the longest chunk kept there.
CACHED_CHUNKS = 200_000
CACHED_LENGTH = 64
#: Ids are below 2 ** ID_BITS; a link is the number a * 2 ** ID_BITS + b.
ID_BITS = 20

_TWO_SPACES = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?= )")
_WHOLE = re.compile(r"<0x([0-9A-F]{2})>")

#: A chunk: its groups as text, tokens of A and B, groups, links (64-bit numbers as bytes).
Entry = tuple[bytes, int, int, int, bytes]
NOTHING: Entry = (b"", 0, 0, 0, b"")

_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def byte_alphabet() -> dict[str, int]:
    """The byte for each character of a byte-level vocabulary: printable Latin-1 stands for itself."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def sliced(ends_a: Sequence[int], ends_b: Sequence[int]) -> Iterator[tuple[int, int, int, int]]:
    """(from, to) of A's and of B's tokens for each group; both cut the same bytes."""
    index_a = {end: i for i, end in enumerate(ends_a, 1)}
    index_b = {end: i for i, end in enumerate(ends_b, 1)}
    a = b = 0
    for end in sorted(index_a.keys() & index_b.keys()):
        yield a, index_a[end], b, index_b[end]
        a, b = index_a[end], index_b[end]


def overlaps(ends_a: Sequence[int], ends_b: Sequence[int]) -> Iterator[tuple[int, int]]:
    """Places of the tokens of one group whose byte ranges overlap."""
    i = j = 0
    while i < len(ends_a) and j < len(ends_b):
        yield i, j
        a, b = ends_a[i], ends_b[j]
        i, j = i + (a <= b), j + (b <= a)


def entries_of(ids_a: Sequence[int], ids_b: Sequence[int], ends_a: Sequence[int], ends_b: Sequence[int], ends: Sequence[int]) -> list[Entry]:
    """Entries of consecutive chunks that end at ``ends``; a chunk is left out where no group ends with it."""
    out, cut = [], iter(ends)
    upto, n_a, n_b = next(cut), 0, 0
    groups: list[str] = []
    links = array("q")
    for a, to_a, b, to_b in sliced(ends_a, ends_b):
        if to_a - a == 1 == to_b - b:
            one, two = ids_a[a], ids_b[b]
            groups.append(f"{one}|{two}")
            links.append((one << ID_BITS) + two)
        else:
            one, two = ids_a[a:to_a], ids_b[b:to_b]
            groups.append(",".join(map(str, one)) + "|" + ",".join(map(str, two)))
            links.extend([(one[i] << ID_BITS) + two[j] for i, j in overlaps(ends_a[a:to_a], ends_b[b:to_b])])
        if ends_a[to_a - 1] == upto:
            out.append((";".join(groups).encode(), to_a - n_a, to_b - n_b, len(groups), links.tobytes()))
            upto, n_a, n_b = next(cut, -1), to_a, to_b
            groups, links = [], array("q")
    return out


class Aligner:
    """Two tokenizers and the chunks that they have met; one for each worker process."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        # The tasks of an executor already use its cores; threads of the tokenizer would only wait.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        if max(self.a.get_vocab_size(), self.b.get_piece_size()) > 1 << ID_BITS:
            raise ValueError(f"token ids do not fit {ID_BITS} bits")
        alphabet = byte_alphabet()
        names = (self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size()))
        self.bytes_a = [bytes(alphabet[c] for c in x) if all(c in alphabet for c in x) else x.encode() for x in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(_WHOLE.fullmatch(x)[1], 16)]) if self.b.is_byte(i) else x.replace("▁", " ").encode()
            for i, x in enumerate(pieces)
        ]
        self.blank = self.b.piece_to_id("▁")
        # Chunks are independent only if no token reaches across a cut.
        settings = json.loads(self.a.to_str())
        splits = settings["pre_tokenizer"] or {}
        self.in_chunks = (
            settings["normalizer"] is None
            and splits.get("type") == "ByteLevel"
            and splits.get("use_regex", True)
            and not splits.get("add_prefix_space")
            and not any("▁" in x.lstrip("▁") or ("\n" in x and len(x) > 1) for x in pieces)
        )
        self.young: dict[str, Entry | None] = {}
        self.older: dict[str, Entry | None] = {}

    def _ids_a(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.a.encode_batch(texts, add_special_tokens=False)]

    def _ids_b(self, texts: list[str]) -> list[list[int]]:
        """B adds the space in front that the texts have already; a lone one is its own piece."""
        found = self.b.encode([x[1:] for x in texts], num_threads=1)
        return [[self.blank] if x == " " else ids for x, ids in zip(texts, found, strict=True)]

    def _entries(self, text: bytes, ids_a: list[int], ids_b: list[int], ends: Sequence[int]) -> list[Entry]:
        """Entries of the chunks of a text; none where the bytes of a side differ from it."""
        one = list(map(self.bytes_a.__getitem__, ids_a))
        two = list(map(self.bytes_b.__getitem__, ids_b))
        if b"".join(one) != text or b"".join(two) != text:
            return []
        return entries_of(ids_a, ids_b, list(accumulate(map(len, one))), list(accumulate(map(len, two))), ends)

    def learn(self, texts: list[str]) -> Iterator[Entry | None]:
        """Entries of chunks. Those that end in a visible character are encoded many at a time."""
        for at in range(0, len(texts), 512):
            group = texts[at : at + 512]
            found: list[Entry] = []
            if all(x[0] == " " or x[0] == "\n" for x in group) and not any(x[-1].isspace() or _TWO_SPACES.search(x) for x in group):
                # A chunk that starts with a line break has no blank of its own: a word goes first.
                whole = " x" + "".join(group)
                ends = list(accumulate((len(x.encode()) for x in group), initial=2))
                found = self._entries(whole.encode(), *self._ids_a([whole]), *self._ids_b([whole]), ends)[1:]
            if len(found) == len(group):
                yield from found
                continue
            for text, ids_a, ids_b in zip(group, self._ids_a(group), self._after_word(group), strict=True):
                raw = text.encode()
                yield (self._entries(raw, ids_a, ids_b, [len(raw)]) or [None])[0]

    def _after_word(self, texts: list[str]) -> list[list[int]]:
        blank = self._ids_b([x if x[0] == " " else " " + x for x in texts])
        return [ids if x[0] == " " else ids[1:] for x, ids in zip(texts, blank, strict=True)]

    def whole(self, text: str) -> Entry:
        """A text encoded as one, without cuts."""
        text = " " + text
        raw = text.encode()
        return (self._entries(raw, *self._ids_a([text]), *self._ids_b([text]), [len(raw)]) or [NOTHING])[0]

    def entries(self, keys: Iterable[str]) -> dict[str, Entry | None]:
        """Entries of chunk keys (see ``chunks``)."""
        if len(self.young) > CACHED_CHUNKS:
            self.young, self.older = {}, self.young
        out, new = {}, []
        for key in keys:
            if key in self.young:
                out[key] = self.young[key]
            elif key in self.older:
                out[key] = self.young[key] = self.older[key]
            else:
                new.append(key)
        for key, entry in zip(new, self.learn([chunk_of(key) for key in new]), strict=True):
            out[key] = entry
            if len(key) <= CACHED_LENGTH:
                self.young[key] = entry
        return out


def chunk_of(key: str) -> str:
    return key if key[:1] in ("\n", " ") else " " + key


def chunks(text: str) -> list[str]:
    """Keys of the chunks of space + text: a chunk, or one without its leading space.

    Without runs of white space, a line break ends a token of both sides as well.
    """
    if not text[0].isspace() and not text[-1].isspace() and not _TWO_SPACES.search(text):
        return text.replace("\n", " \n").split(" ")
    return _CUT.split(" " + text)


def aligner(byte_path: str, piece_path: str) -> Aligner:
    key = (byte_path, piece_path)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(byte_path, piece_path)
    return _ALIGNERS[key]


def _spans(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each length, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums over consecutive runs of values, also over empty ones."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def align_texts(texts: Sequence[str | None], known: Aligner) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """n_a, n_b, n_groups, n_links, groups and links of each text; all pairs of ids in order, and their numbers of links.

    A text's links are places in the pairs, as 16-bit numbers where there are few enough.
    """
    keyed: list[list] = [chunks(x) if x and known.in_chunks else [] for x in texts]
    entries = known.entries(dict.fromkeys(chain.from_iterable(keyed)))
    broken = {key for key, entry in entries.items() if entry is None}
    for i, text in enumerate(texts):
        if text and (not known.in_chunks or (broken and not broken.isdisjoint(keyed[i]))):
            # Bytes differ somewhere, or chunks say nothing: the whole text decides.
            keyed[i] = [(i,)]
            entries[(i,)] = known.whole(text)
    for key in broken:
        del entries[key]
    found = list(entries.values())
    number = dict(zip(entries, range(len(found)), strict=True))
    groups = [x[0] for x in found]
    places = [list(map(number.__getitem__, keys)) for keys in keyed]
    text_of_groups = [b";".join(map(groups.__getitem__, at)) for at in places]

    counts = np.array([x[1:4] for x in found], dtype=np.int64).reshape(-1, 3)
    n_links = np.array([len(x[4]) // 8 for x in found], dtype=np.int64)
    first = np.cumsum(n_links) - n_links
    pairs, of_link = np.unique(np.frombuffer(b"".join(x[4] for x in found), dtype=np.int64), return_inverse=True)
    flat = np.fromiter(chain.from_iterable(places), dtype=np.int64)
    sizes = np.array([len(at) for at in places], dtype=np.int64)
    met = of_link.astype(link_type(len(pairs)))[_spans(n_links[flat], first[flat])]
    held = _sums(n_links[flat], sizes)
    ends = (met.itemsize * np.concatenate([[0], np.cumsum(held)])).astype(np.int64)
    links = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(met))])
    columns = {name: pa.array(_sums(counts[flat, i], sizes)) for i, name in enumerate(("n_a", "n_b", "n_groups"))}
    table = pa.table(
        columns
        | {"n_links": pa.array(held), "groups": pa.array(text_of_groups, pa.binary()).cast(pa.string()), "links": links.cast(pa.binary())}
    )
    return table, pairs, np.bincount(met, minlength=len(pairs))


def link_type(pairs: int) -> str:
    return "<u2" if pairs <= 1 << 16 else "<u4"


PAIRS = T.ArrayType(T.StructType([T.StructField("pair", T.LongType()), T.StructField("n", T.LongType())]))
NEW_COLUMNS = T.StructType(
    [
        *[T.StructField(x, T.LongType()) for x in ("n_a", "n_b", "n_groups", "n_links")],
        T.StructField("groups", T.StringType()),
        T.StructField("links", T.BinaryType()),
        T.StructField("shard", T.LongType()),
        T.StructField("pairs", PAIRS),
    ]
)


def align(docs: DataFrame, byte_path: str, piece_path: str, carried: Sequence[str] = ("doc_id",), text_column: str = "text") -> DataFrame:
    """The carried columns with n_a, n_b, n_groups, n_links, groups, links, shard and pairs.

    ``groups`` reads ``a1,a2|b1;a3|b2,b3``. ``shard`` numbers the few megabytes of text that were
    aligned together; its first row has in ``pairs`` all pairs of ids (a * 2 ** 20 + b, ascending)
    whose tokens share bytes in the shard, with their number of meetings; ``links`` are a text's
    meetings, in order, as places in that list. Texts that are null or empty, or whose bytes one
    side does not give back, have no tokens: zeros, an empty text and no links. Control strings of
    a vocabulary are plain text. Every row is a document of its own, also rows that repeat; long
    texts are aligned whole. An empty table gives no rows. Carried columns named like a new one
    are left out. One pass, no shuffle.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    carried = [c for c in carried if c not in NEW_COLUMNS.fieldNames()]
    schema = T.StructType([*[docs.schema[c] for c in carried], *NEW_COLUMNS])
    pairs_type = to_arrow_schema(NEW_COLUMNS).field("pairs").type

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, task = aligner(byte_path, piece_path), TaskContext.get()
        base = (task.partitionId() if task else 0) << 32
        held: list[pa.RecordBatch] = []
        size = shards = 0
        for batch in chain(batches, [None]):
            if batch is not None and batch.num_rows:
                held.append(batch)
                size += batch.column(len(carried)).nbytes
            if held and (batch is None or size >= SHARD_BYTES):
                table = pa.Table.from_batches(held)
                new, pairs, times = align_texts(table.column(len(carried)).to_pylist(), known)
                listed = pa.StructArray.from_arrays([pa.array(pairs), pa.array(times)], names=["pair", "n"])
                ends = pa.array(np.minimum(np.arange(len(table) + 1), 1) * len(pairs), pa.int32())
                columns = [*table.columns[:-1], *new.columns, pa.array(np.full(len(table), base + shards))]
                table = pa.Table.from_arrays([*columns, pa.ListArray.from_arrays(ends, listed).cast(pairs_type)], names=schema.fieldNames())
                # A few rows at a time: the groups of a shard are several times its text.
                yield from table.combine_chunks().to_batches(max_chunksize=1024)
                held, size, shards = [], 0, shards + 1

    return docs.select(*carried, F.col(text_column).cast("string").alias("__text")).mapInArrow(rows, schema)


def _judged(n_carried: int, names: list[str]):
    def rows(key: tuple, docs: pa.Table, counts: pa.Table) -> pa.Table:
        pair, count, best = (counts.column(c).to_numpy() for c in ("pair", "count", "best"))
        order = np.argsort(pair)
        links = docs.column("links").to_pylist()
        kind = np.dtype(link_type(len(pair)))
        lengths = np.array([len(x) // kind.itemsize for x in links], dtype=np.int64)
        places = order[np.frombuffer(b"".join(links), dtype=kind)]
        new = [_sums(best[places], lengths), _sums(count[places], lengths)]
        return pa.Table.from_arrays([*[docs.column(i) for i in range(n_carried)], *map(pa.array, new)], names=names)

    return rows


def add_link_counts(stored: DataFrame) -> DataFrame:
    """Rows of ``align``, kept in the shared folder, with n_best and count_sum in place of links, shard and pairs.

    A pair's count is the number of its meetings in all rows. ``n_best`` are the links whose count
    is the highest of their B id, ties included; ``count_sum`` adds up the counts of the links.
    Only the pairs of each shard travel: to be counted, and with the corpus counts back to it.
    """
    carried = [c for c in stored.columns if c not in ("links", "shard", "pairs")]
    met = stored.where(F.size("pairs") > 0).select("shard", F.inline("pairs"))
    counts = materialise(met.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair") % (1 << ID_BITS)), "link-counts")
    highest = counts.groupBy("b").agg(F.max("count").alias("top"))
    judged = counts.join(highest, "b").select("pair", "count", (F.col("count") == F.col("top")).cast("long").alias("best"))
    routed = met.select(F.col("shard").alias("at"), "pair").join(judged, "pair").select("at", "pair", "count", "best")
    schema = T.StructType([*[stored.schema[c] for c in carried], *[T.StructField(x, T.LongType()) for x in ("n_best", "count_sum")]])
    return (
        stored.select(*carried, "links", "shard")
        .groupBy("shard")
        .cogroup(routed.groupBy("at"))
        .applyInArrow(_judged(len(carried), schema.fieldNames()), schema)
    )


def align_documents(docs: DataFrame, byte_path: str, piece_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum.

    The digest is '' for documents without tokens. See ``align`` for null, empty, long and
    repeated texts; other columns are left out.
    """
    found = align(docs, byte_path, piece_path, (id_column,), text_column)
    digest = F.when(F.col("n_a") == 0, F.lit("")).otherwise(F.sha2("groups", 256))
    stored = materialise(found.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    result = materialise(add_link_counts(stored), "link-statistics")
    discard(stored)
    return result
