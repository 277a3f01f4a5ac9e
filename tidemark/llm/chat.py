"""Chat formatting by token-level assembly, and reading it back.

Roles and texts are encoded each on their own and joined by reserved ids, which no text can give:
start, role, separator, text, end. Masks of the tokens to learn from are prefix sums of +1 where a
learned text starts and -1 where it ends. A control string that occurs in a role or text gets a
backslash after its ``<``, one more if it has some already, so that the output as text is free of
false marks too, and reading takes exactly one away.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
MARKS = (START, SEPARATOR, END)
#: Control strings are the marks and what the vocabulary's own models treat as one.
CONTROL = r"\|(?:im_start|im_sep|im_end|endoftext)\|>"
_BARE = re.compile(rf"<(?=\\*{CONTROL})")
_ESCAPED = re.compile(rf"<\\(?=\\*{CONTROL})")

_TEMPLATES: dict[tuple[str, str], Template] = {}


def escape(text: str) -> str:
    """One backslash more in every control string."""
    return _BARE.sub(r"<\\", text)


def unescape(text: str) -> str:
    """One backslash less in every control string that has any."""
    return _ESCAPED.sub("<", text)


class Template:
    """A byte-level vocabulary with three reserved ids above it; one for each worker process."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # The id after the last rank belongs to the vocabulary's end of text.
        self.first_mark = max(ranks.values()) + 2
        self.start, self.separator, self.end = range(self.first_mark, self.first_mark + 3)
        self.bytes = [b""] * (self.first_mark + 3)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.bytes[self.first_mark :] = [x.encode() for x in MARKS]

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(escape(x)) for x in texts]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8")

    def assemble(self, roles: list[str], texts: list[str], learned: Sequence[bool]) -> tuple[list[bytes], list[bytes]]:
        """Ids (little-endian unsigned 32-bit) and mask (a byte for each id) of every turn."""
        heads, bodies = self.encode(roles), self.encode(texts)
        n_head = np.array([len(x) for x in heads], dtype=np.int64)
        n_body = np.array([len(x) for x in bodies], dtype=np.int64)
        ends = np.cumsum(n_head + n_body + 3)
        starts = ends - (n_head + n_body + 3)
        total = int(ends[-1]) if len(ends) else 0
        ids, free = np.empty(total, dtype="<u4"), np.ones(total, dtype=bool)
        for places, mark in ((starts, self.start), (starts + 1 + n_head, self.separator), (ends - 1, self.end)):
            ids[places] = mark
            free[places] = False
        own = chain.from_iterable(chain.from_iterable(zip(heads, bodies, strict=True)))
        ids[free] = np.fromiter(own, dtype="<u4", count=int(free.sum()))
        steps = np.zeros(total + 1, dtype=np.int64)
        on = np.asarray(learned, dtype=bool)
        np.add.at(steps, (starts + 2 + n_head)[on], 1)
        np.add.at(steps, (ends - 1)[on], -1)
        mask = (np.cumsum(steps[:-1]) > 0).astype(np.uint8)
        spans = list(zip(starts.tolist(), ends.tolist(), strict=True))
        return [ids[x:y].tobytes() for x, y in spans], [mask[x:y].tobytes() for x, y in spans]

    def read(self, ids: bytes, mask: bytes) -> tuple[str, str, str, int]:
        """Role, text, learned text and length in characters of one formatted turn."""
        found, on = np.frombuffer(ids, dtype="<u4"), np.frombuffer(mask, dtype=np.uint8).astype(bool)
        marks = np.flatnonzero(found >= self.first_mark)
        if found[marks].tolist() != [self.start, self.separator, self.end] or marks[0] or marks[2] != len(found) - 1:
            raise ValueError("not a formatted turn")
        role, text = self.decode(found[1 : marks[1]]), self.decode(found[marks[1] + 1 : -1])
        learned = text if on[marks[1] + 1 : -1].all() and on.sum() == len(found) - marks[1] - 2 else self.decode(found[on & (found < self.first_mark)])
        return unescape(role), unescape(text), unescape(learned), len(role) + len(text) + sum(map(len, MARKS))


def template(ranks_path: str, pattern: str) -> Template:
    key = (ranks_path, pattern)
    if key not in _TEMPLATES:
        _TEMPLATES[key] = Template(ranks_path, pattern)
    return _TEMPLATES[key]


def format_turns(
    turns: DataFrame,
    ranks_path: str,
    pattern: str,
    keys: Sequence[str] = ("conv_id", "turn"),
    role_column: str = "role",
    text_column: str = "text",
    learned_roles: Sequence[str] = ("assistant",),
) -> DataFrame:
    """One row per turn: the keys, ids and mask.

    A conversation's sequence is that of its turns in order, so one with any number of turns is
    never held as a whole. ``ids`` are little-endian unsigned 32-bit numbers, ``mask`` has a byte
    for each id: 1 at the text of learned roles. Null roles and texts count as empty; an empty
    text is learned as nothing. Rows that repeat are turns of their own; other columns are left
    out; long texts are encoded whole; an empty table gives no rows. One pass, no shuffle.
    """
    keys, learned = list(keys), frozenset(learned_roles)
    schema = T.StructType([*[turns.schema[c] for c in keys], T.StructField("ids", T.BinaryType()), T.StructField("mask", T.BinaryType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assemble = template(ranks_path, pattern).assemble
        for batch in batches:
            roles, texts = ([x or "" for x in batch.column(len(keys) + i).to_pylist()] for i in range(2))
            ids, mask = assemble(roles, texts, [x in learned for x in roles])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(keys))], pa.array(ids, pa.binary()), pa.array(mask, pa.binary())], names=schema.fieldNames()
            )

    return turns.select(*keys, F.col(role_column).alias("__role"), F.col(text_column).alias("__text")).mapInArrow(rows, schema)


class _Digest:
    """What has been read of one conversation."""

    def __init__(self, key: object) -> None:
        self.key, self.n, self.loss_chars, self.chars = key, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, role: str, text: str, learned: str, chars: int) -> None:
        self.n += 1
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss.update(learned.encode())
        self.loss_chars += len(learned)
        self.chars += chars

    def row(self) -> tuple:
        return self.key, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def digests(formatted: DataFrame, ranks_path: str, pattern: str, conversation: str = "conv_id", order: str = "turn") -> DataFrame:
    """Per conversation what its formatted turns read back as: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Turns go by ``order``, null first, equal ones by their ids; rows without a conversation make up
    one of their own. A digest needs its turns one after the other, so sorted partitions are
    streamed with one open digest: memory does not depend on the length of a conversation.
    """
    schema = T.StructType(
        [
            formatted.schema[conversation],
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
        ]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, read = to_arrow_schema(schema), template(ranks_path, pattern).read
        now: _Digest | None = None
        for batch in batches:
            done = []
            for key, ids, mask in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if now is None or now.key != key:
                    done += [now.row()] if now else []
                    now = _Digest(key)
                now.add(*read(ids, mask))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done, strict=True), arrow, strict=True)], schema=arrow)
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(now.row(), arrow, strict=True)], schema=arrow)

    return (
        formatted.repartition(conversation)
        .sortWithinPartitions(conversation, order, "ids", "mask")
        .select(conversation, "ids", "mask")
        .mapInArrow(rows, schema)
    )
