"""Packing by power-of-two decomposition: no sequence crosses a document, none has padding.

Each tokenised document is cut into pieces of binary lengths (as many of the full length as fit,
then the powers of two that sum up to the rest), and pieces of equal length form a bucket. A batch
is drawn from one bucket, so its sequences have one length.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain, pairwise
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.words import as_bytes

#: Words in each of the two generations of a worker's cache. When the young one is full it becomes
#: the old one, so words that are in use stay; losing the others costs time and changes nothing.
CACHED_WORDS = 250_000
#: Bytes of text that are encoded at a time.
SLICE_BYTES = 1 << 20

# Words whose lower-casing, normal form or pieces need the tokenizer's own rules.
_UNUSUAL = re.compile("[\x1c-\x1f\x85\xa0\xb2\xb3\xb9\xbc-\xbeİ̀-\U0010ffff]|<\\|")
# Texts with these stay as they are: small letters may join marks that capitals don't (J and a caron),
# and special tokens have a case. Lead bytes from U+0300 on.
_CASED = re.compile(b"[\xcc-\xff]")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")

_ENCODERS: dict[str, WordEncoder] = {}


class WordEncoder:
    """Token ids of texts under a lower-casing word-level BPE tokenizer, word by word.

    Such a tokenizer drops white space, and neither its normaliser nor its pieces reach across it,
    so a text's ids are those of its words in turn. Words repeat, so each is encoded once and kept.
    Latin words are cut here into the pieces of the tokenizer's pattern and encoded many at a time;
    all others go through the tokenizer as they are.
    """

    def __init__(self, path: str) -> None:
        # The tasks of an executor already use its cores; threads of the tokenizer would only wait.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.pieces = Tokenizer.from_file(path)
        self.pieces.normalizer = None
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        # The last token of a piece is marked, where the tokenizer marks ends of words.
        suffix = getattr(self.pieces.model, "end_of_word_suffix", None)
        vocabulary = self.pieces.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.by_word: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.by_piece: dict[str, bytes] = {}

    def _learn_pieces(self, pieces: list[str]) -> None:
        chunks = [pieces[i : i + 512] for i in range(0, len(pieces), 512)]
        lines = [" ".join(c) for c in chunks]
        encoded = self.pieces.encode_batch_fast(lines, add_special_tokens=False)
        for chunk, line, found in zip(chunks, lines, encoded, strict=True):
            ids = np.asarray(found.ids, dtype="<u4")
            cuts = [0, *(4 * np.flatnonzero(self.ends[ids]) + 4).tolist()]
            if len(cuts) != len(chunk) + 1 or cuts[-1] != 4 * len(ids):
                found = self.pieces.encode(line, add_special_tokens=False)
                ids = np.asarray(found.ids, dtype="<u4")
                cuts = (4 * np.searchsorted(np.asarray(found.word_ids), np.arange(len(chunk) + 1))).tolist()
            packed = ids.tobytes()
            self.by_piece.update(zip(chunk, [packed[x:y] for x, y in pairwise(cuts)], strict=True))

    def _learn(self, words: set[bytes]) -> None:
        # Most words are one piece, many are one and a mark or digit; the others are kept with their pieces.
        plain: list[bytes] = []
        lowered: list[str] = []
        cut: list[tuple[bytes, list[str]]] = []
        marked: list[bytes] = []
        stems: list[str] = []
        marks: list[str] = []
        listed = list(words)
        # No word holds a space, and lower-casing makes none.
        line = b" ".join(listed).decode("utf-8")
        for word, text, low in zip(listed, line.split(" "), line.lower().split(" "), strict=True) if listed else ():
            if text.isalpha() and (word.isascii() or not _UNUSUAL.search(text)):
                plain.append(word)
                lowered.append(low)
            elif text[:-1].isalpha() and (word.isascii() or not _UNUSUAL.search(text)):
                marked.append(word)
                stems.append(low[:-1])
                marks.append(low[-1])
            elif _UNUSUAL.search(text):
                ids = self.whole.encode(text, add_special_tokens=False).ids
                self.by_word[word] = np.asarray(ids, dtype="<u4").tobytes()
            else:
                cut.append((word, _PIECE.findall(low)))
        if len(self.by_piece) > CACHED_WORDS:
            self.by_piece.clear()
        pieces = set(lowered).union(stems, marks)
        pieces.update(chain.from_iterable(found for _, found in cut))
        self._learn_pieces(list(pieces.difference(self.by_piece)))
        known = self.by_piece.__getitem__
        self.by_word.update(zip(plain, map(known, lowered), strict=True))
        self.by_word.update(zip(marked, map(add, map(known, stems), map(known, marks)), strict=True))
        for word, found in cut:
            self.by_word[word] = b"".join(map(known, found))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        words = [_folded(text).split() for text in texts]
        new = set(chain.from_iterable(words))
        if len(self.by_word) > CACHED_WORDS:
            self.by_word, self.older = {}, self.by_word
        new = new.difference(self.by_word)
        self.by_word.update((word, self.older[word]) for word in new if word in self.older)
        self._learn(new.difference(self.by_word))
        known = self.by_word.__getitem__
        return [b"".join(map(known, found)) for found in words]


def _folded(text: bytes) -> bytes:
    """The text with A-Z in lower case, where that changes no token; so fewer words differ."""
    if b"<|" in text or not text.isascii() and _CASED.search(text):
        return text
    return text.lower()


def slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in turn, in groups of about SLICE_BYTES."""
    group: list[bytes] = []
    held = 0
    for text in texts:
        group.append(text)
        held += len(text)
        if held >= SLICE_BYTES:
            yield group
            group, held = [], 0
    if group:
        yield group


def encoder(path: str) -> WordEncoder:
    """One encoder, and so one cache, for each worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def binary_lengths(tokens: int, longest: int) -> list[int]:
    """Piece lengths of a document: full ones first, then the powers of two of what is left."""
    out = [longest] * (tokens // longest)
    rest = tokens % longest
    return out + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 1,
    longest: int = 2048,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: id_column, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers; each document's
    end with ``end_id``. A null text counts as empty, and an empty one is that single id. Every
    row of the input is a document of its own, also rows that repeat or have no id. ``longest`` is
    a power of two. A sequence holds one piece, so offset is 0; sequence_id is unique and its last
    four bits are the bucket, log2 of the length. The number before them is the place in the scan,
    which a repeated task finds again. One pass, no shuffle; other columns are left out.
    """
    if longest & (longest - 1) or not 0 < longest <= 1 << 15:
        raise ValueError("the longest sequence is a power of two up to 32768")
    end = int(end_id).to_bytes(4, "little")
    schema = T.StructType(
        [
            T.StructField(id_column, docs.schema[id_column].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
        ]
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        for batch in batches:
            row, start, length, ids, tokens = [], [], [], [], []
            encoded = chain.from_iterable(map(encode, slices(as_bytes(batch.column(1)))))
            for i, found in enumerate(encoded):
                found += end
                total, at = len(found) // 4, 0
                for size in binary_lengths(total, longest):
                    row.append(i)
                    start.append(at)
                    length.append(size)
                    ids.append(found[4 * at : 4 * (at + size)])
                    tokens.append(total)
                    at += size
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    *[pa.array(x, pa.int64()) for x in (start, length)],
                    pa.array(ids, pa.binary()),
                    pa.array(tokens, pa.int64()),
                ],
                names=schema.fieldNames(),
            )

    bucket = F.log2("length").cast("long")
    return docs.select(id_column, text_column).mapInArrow(pieces, schema).withColumns(
        {"sequence_id": F.monotonically_increasing_id() * 16 + bucket, "offset": F.lit(0).cast("long")}
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """One folder for each length; every batch read from one has sequences of one length."""
    packed.write.partitionBy("length").parquet(path)
