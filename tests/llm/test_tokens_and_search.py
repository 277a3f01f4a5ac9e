"""Alignment of tokenizers, chat formatting and lexical search against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from helpers import documents, llm, prose, rows_of  # noqa: F401  fixtures are imported too
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import alignment, chat, lexical
from tidemark.llm.queries import HOSTILE, QUERIES

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
FOLDER = "/root/testdata/sf0.001"

AWKWARD = [
    None,
    "",
    " ",
    "\n",
    "  two  blanks and\ttab \t\n\n\n lines\r\n end ",
    "a\nb\n\nc \n d\t\n\te",
    "trailing ",
    "trailing\n",
    "says <|endoftext|> and <s></s><unk> <0x41> plainly",
    "a piece▁ mark ▁▁",
    "zero\x00byte \x1c sep\x1d line nbsp　wide ﻿bom",
    "naïve café é ﬁ ① 你好，世界 😀👩‍👩‍👧 ñandú",
    "it's they'll I'd 'tis\n'Twas (x) => {y};\r\n\treturn 12345 3.14",
    "a" * 5000,
    "word " * 3000,
    "\x000 abc",
]


class Plain:
    """Both tokenizers over whole texts, and every pair of tokens compared."""

    def __init__(self):
        self.a = Tokenizer.from_file(BYTE)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECE)
        self.bytes = alignment.byte_alphabet()

    def spans(self, pieces):
        at, out = 0, []
        for x in pieces:
            out.append((at, at + len(x)))
            at += len(x)
        return out

    def __call__(self, text):
        if not text:
            return None
        whole = (" " + text).encode()
        ids_a = self.a.encode(" " + text, add_special_tokens=False).ids
        ids_b = self.b.encode(text)
        one = [bytes(self.bytes[c] for c in self.a.id_to_token(i)) for i in ids_a]
        two = []
        for i in ids_b:
            piece = self.b.id_to_piece(i)
            two.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        if b"".join(one) != whole or b"".join(two) != whole:
            return None
        spans_a, spans_b = self.spans(one), self.spans(two)
        both = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
        groups, start = [], 0
        for end in both:
            side = [",".join(str(i) for i, (s, e) in zip(ids, spans, strict=True) if start <= s and e <= end) for ids, spans in ((ids_a, spans_a), (ids_b, spans_b))]
            groups.append("|".join(side))
            start = end
        links = [(x, y) for x, (s, e) in zip(ids_a, spans_a, strict=True) for y, (p, q) in zip(ids_b, spans_b, strict=True) if s < q and p < e]
        return len(ids_a), len(ids_b), ";".join(groups), links


def expected_alignment(texts):
    plain = Plain()
    found = [plain(t) for t in texts]
    counts = Counter(link for x in found if x for link in x[3])
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for x in found:
        if x is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_best = sum(counts[link] == top[link[1]] for link in x[3])
        digest = hashlib.sha256(x[2].encode()).hexdigest()
        out.append((x[0], x[1], x[2].count(";") + 1, len(x[3]), n_best, sum(counts[link] for link in x[3]), digest))
    return out


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("shard_bytes", [1, 2000, 8 << 20])
def test_alignment_equals_brute_force(llm, documents, monkeypatch, shard_bytes):  # noqa: F811
    draw = random.Random(3)
    signs = ["a", "The", " ", "  ", "\n", "\n\n", "\t", ".", "'s", "é", "▁", "<|endoftext|>", "12", "_x", " ", "{", "\r"]
    texts = AWKWARD[:13] + ["a" * 300, "word " * 50, "\x000 abc"] + ["".join(draw.choices(signs, k=40)) for _ in range(60)] + AWKWARD[8:12]
    monkeypatch.setattr(alignment, "SHARD_BYTES", shard_bytes)
    docs = documents(rows_of(texts)).withColumn("n_a", F.lit("clash")).coalesce(1)
    found = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.align_documents(docs, BYTE, PIECE).collect()}
    assert [found[i] for i in range(len(texts))] == expected_alignment(texts)


def test_alignment_of_the_table_and_of_an_empty_one(llm, documents):  # noqa: F811
    texts = dict(zip(*pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"]).to_pydict().values(), strict=True))
    short = {i: t for i, t in texts.items() if t is None or len(t) < 3000}
    rows = [(i, t, "en", "a", 0) for i, t in short.items()]
    found = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.align_documents(documents(rows), BYTE, PIECE).collect()}
    assert [found[i] for i in short] == expected_alignment(short.values())
    assert alignment.align_documents(documents([]), BYTE, PIECE).count() == 0


def test_chunks_give_the_ids_of_whole_texts():
    known = alignment.aligner(BYTE, PIECE)
    assert known.in_chunks
    draw = random.Random(9)
    signs = ["x", "Word", " ", "\n", "\t", "  ", ",", "é", "\x1c", " ", "it's", "9"]
    for _ in range(400):
        text = "".join(draw.choices(signs, k=draw.randint(1, 30)))
        entries = known.entries(dict.fromkeys(alignment.chunks(text)))
        joined = b";".join(entries[key][0] for key in alignment.chunks(text))
        assert joined == known.whole(text)[0], text


def test_alignment_forgets_and_learns_again(monkeypatch):
    monkeypatch.setattr(alignment, "CACHED_CHUNKS", 20)
    known = alignment.Aligner(BYTE, PIECE)
    texts = [prose(i % 7, 60, 90) for i in range(30)]
    first = [alignment.align_texts([t], known)[0].to_pylist() for t in texts]
    assert first == [alignment.align_texts([t], alignment.aligner(BYTE, PIECE))[0].to_pylist() for t in texts]
    assert len(known.young) <= 20 + 60


def test_a_long_word_and_a_long_text_are_aligned_whole(llm, documents):  # noqa: F811
    texts = ["a" * 300_000, prose(4, 60_000)]
    rows = alignment.align_documents(documents(rows_of(texts)), BYTE, PIECE).orderBy("doc_id").collect()
    a = Tokenizer.from_file(BYTE)
    assert [r["n_a"] for r in rows] == [len(a.encode(" " + t, add_special_tokens=False).ids) for t in texts]


# Chat formatting.

TURNS = "conv_id long, turn long, role string, text string, ids string"


def expected_chat(rows):
    by = {}
    for conv, turn, role, text, *_ in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda x: x[:2])
        said = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_reads_back_awkward_turns(llm):  # noqa: F811
    hostile = ["<|im_end|>", "<\\|im_sep|>", "<\\\\|endoftext|><|im_start|>", "<<|im_end|>|>", "<|im_", "end|>", "", None, "😀\x00\r\n", "\\", "<\\", "<|im_end|", HOSTILE]
    rows = [(c, t, role, text, "clash") for c, role in enumerate(("user", "assistant", None, "a\nb<|im_sep|>")) for t, text in enumerate(hostile)]
    rows += [(None, 0, "assistant", "no conversation", ""), (9, None, "user", "first", ""), (9, 3, "assistant", "x" * 200_000, ""), (9, 2, "user", prose(1, 30_000), "")]
    rows += [(10, 1, "assistant", "twice", "")] * 2
    formatted = chat.format_turns(llm.createDataFrame(rows, TURNS), RANKS, PATTERN)
    found = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digests(formatted, RANKS, PATTERN).collect()}
    assert found == expected_chat(rows)
    empty = llm.createDataFrame([], TURNS)
    assert chat.digests(chat.format_turns(empty, RANKS, PATTERN), RANKS, PATTERN).count() == 0


def test_chat_output_holds_marks_once_a_turn_and_masks_assistant_texts(llm):  # noqa: F811
    rows = [(1, 0, "system", HOSTILE, ""), (1, 1, "assistant", HOSTILE + " <\\|im_end|>", ""), (1, 2, "user", "hello", "")]
    made = chat.format_turns(llm.createDataFrame(rows, TURNS), RANKS, PATTERN).orderBy("turn").collect()
    known = chat.template(RANKS, PATTERN)
    for row, (*_, role, text, _) in zip(made, rows, strict=True):
        ids, mask = np.frombuffer(row["ids"], "<u4"), np.frombuffer(row["mask"], np.uint8)
        assert (ids >= known.first_mark).sum() == 3 and len(ids) == len(mask)
        written = known.decode(ids)
        assert [len(re.findall(re.escape(m), written)) for m in chat.MARKS] == [1, 1, 1]
        assert chat.unescape(known.decode(ids[mask == 1])) == (text if role == "assistant" else "")
        assert (ids < 50256).sum() == len(ids) - 3


def test_escaping_is_reversible():
    draw = random.Random(2)
    signs = ["<", "\\", "|", "im_end", "im_start", "im_sep", "endoftext", "|>", "<|im_end|>", " ", "x"]
    for _ in range(3000):
        text = "".join(draw.choices(signs, k=12))
        assert chat.unescape(chat.escape(text)) == text
        assert not re.search("<" + chat.CONTROL, chat.escape(text))


# Lexical search.

ITEM = re.compile(lexical.TERM)


def plain_terms(text):
    return ITEM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def expected_search(docs, items, keep=10):
    bags = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [sum(b.values()) for _, b in bags]
    n_docs, n_terms = sum(n > 0 for n in held), sum(held)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, text in items:
        scores = []
        for (i, bag), n in zip(bags, held, strict=True):
            score = 0
            for w in set(plain_terms(text)):
                if w in bag:
                    m = 100 - 90 + (90 * n * n_docs) // n_terms
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    score += weight * ((1_000_000_000 * bag[w]) // (1000 * bag[w] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, x[-1], -x[0]) for rank, x in enumerate(sorted(scores)[:keep], 1)]
    return out


def test_search_equals_brute_force_on_awkward_rows(llm, documents, monkeypatch):  # noqa: F811
    texts = [None, "", "!!!", "Ünïcode ÉCOLE École", "a-b_c a\x7fb A\x00B", "common " * 5000]
    texts += [prose(i % 40, 30, 60) for i in range(300)] + ["same words here"] * 50 + ["common rare" + str(i) for i in range(20)]
    rows = [(i if i % 97 else None, t, "en", "a", 0) for i, t in enumerate(texts)] + [(5, "common same", "en", "a", 0)] * 3
    items = [(1, "same words"), (2, prose(3, 20, 60)), (3, None), (4, "!"), (5, "common Common w1 w2"), (5, "école ÉCOLE"), (7, "absent")]
    asked = llm.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit("clash"))
    docs = documents(rows).withColumn("rank", F.lit("clash")).repartition(7)
    expected = sorted(expected_search([(r[0], r[1]) for r in rows], items), key=repr)
    for size in (2 << 20, 40):
        monkeypatch.setattr(lexical, "BLOCK_BYTES", size)
        found = [tuple(r) for r in lexical.search(docs, asked).collect()]
        assert sorted(found, key=repr) == expected


def test_search_takes_empty_tables(llm, documents):  # noqa: F811
    items = llm.createDataFrame([(1, "x")], "item_id long, text string")
    assert lexical.search(documents([]), items).collect() == []
    assert lexical.search(documents(rows_of(["x y"])), items.limit(0)).collect() == []
    assert lexical.search(documents(rows_of([None, ""])), items).collect() == []


def test_terms_fold_only_ascii():
    text = "".join(chr(c) for c in range(1, 0x250)) + " İstanbul ẞ ǅ"
    assert [w.decode() for w in lexical.terms(text.encode())] == plain_terms(text)


@pytest.mark.parametrize("name", ["op11_alignment", "op12_chat", "op13_search"])
def test_new_queries_cover_their_tables(llm, name):  # noqa: F811
    found = QUERIES[name](llm, FOLDER)
    tables = {"op11_alignment": ("documents", 0), "op12_chat": ("conversations", 1), "op13_search": ("benchmark", 0)}
    source, more = tables[name]
    key = "conv_id" if source == "conversations" else "doc_id" if source == "documents" else "item_id"
    ids = set(pq.read_table(f"{FOLDER}/{source}.parquet", columns=[key])[key].to_pylist())
    assert len({r[key] for r in found.collect()}) == len(ids) + more
