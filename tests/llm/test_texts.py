"""Substring dedup, SimHash, language identification and quality against brute force or held-out rows."""

from __future__ import annotations

import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from helpers import (  # noqa: F401  fixtures are imported too
    components,
    documents,
    fingerprint,
    hamming_components,
    llm,
    prose,
    removed_words,
    rows_of,
    sha256,
    words,
)
from pyspark.sql import functions as F

from tidemark.llm import langid, quality, simhash, substrings
from tidemark.llm.labelled import balanced_sample, held_out
from tidemark.llm.words import anchors, sequence_hashes, word_hashes

FOLDER = "/root/testdata/sf0.01"


def test_words_are_the_runs_between_ascii_spaces():
    text = "a\x0bb\x0c c\u00a0d \u2003e\x1cf\r\ng " + "é" * 5
    assert len(word_hashes(text.encode())) == len(words(text)) == len(text.encode().split())
    one, two = word_hashes(b"x yy x\tzz yy"), word_hashes(b"yy", 0)
    assert one[0] == one[2] and one[1] == one[4] == two[0] and len(set(one.tolist())) == 3


def test_every_window_holds_an_anchor_chosen_by_its_own_words():
    text = (prose(1, 400, 30) + " a" * 100).encode()
    hashes = word_hashes(text)
    places, _ = anchors(hashes, 12, 35)
    held = set(places.tolist())
    assert all(held & set(range(i, i + 24)) for i in range(len(hashes) - 34))
    inner, _ = anchors(hashes[50:85], 12, 35)
    assert set((inner + 50).tolist()) <= held
    grams = sequence_hashes(hashes, 35)
    assert len(set(grams.tolist())) == len({tuple(text.split()[i : i + 35]) for i in range(len(hashes) - 34)})


def awkward_texts():
    shared, other = prose(5, 60), prose(6, 35)
    return [
        None,
        "",
        " \t\n ",
        "short text",
        prose(1, 300) + " " + shared,
        shared + " " + prose(2, 300),
        prose(3, 20) + "\n" + shared[: len(shared) // 2] + " " + prose(4, 50),
        other,
        other,
        "same " * 90,
        "same " * 34,
        other + " " + prose(8, 5) + " " + other,
        prose(9, 5000) + " " + other,
        prose(10, 34),
        prose(10, 34),
    ]


def test_repeats_equal_brute_force(documents):
    texts = awkward_texts()
    rows = substrings.remove_repeats(documents(rows_of(texts))).collect()
    expected = removed_words(texts, 35)
    assert len(rows) == len(texts)
    for row in rows:
        kept = expected[row.doc_id]
        assert words(row.kept) == kept and row.text == texts[row.doc_id]
        assert row.n_words == len(words(row.text)) and row.n_removed == row.n_words - len(kept)
        assert sum(s.end - s.start for s in row.spans) == row.n_removed
    assert sha256([]) == sha256(expected[7])


def test_repeats_at_random_windows(documents, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_BYTES", 400)
    draw = random.Random(3)
    stock = [prose(s, 12, 6) for s in range(8)]
    texts = [" ".join(draw.choices(stock, k=draw.randrange(6))) for _ in range(40)]
    for window in (5, 13):
        got = {r.doc_id: words(r.kept) for r in substrings.remove_repeats(documents(rows_of(texts)), window=window).collect()}
        assert [got[i] for i in range(len(texts))] == removed_words(texts, window)


def test_repeated_rows_and_clashing_names(documents):
    text = prose(1, 40)
    docs = documents([(1, text, "en", "a", 0), (1, text, "en", "a", 0), (None, prose(2, 50), None, None, None)])
    docs = docs.withColumn("kept", F.lit(1)).withColumn("shard", F.lit("x"))
    rows = substrings.remove_repeats(docs).collect()
    assert sorted((r.n_words, r.n_removed, r.shard) for r in rows) == [(40, 40, "x"), (40, 40, "x"), (50, 0, "x")]


def test_simhash_equals_brute_force(documents):
    base = prose(20, 400)
    texts = awkward_texts() + [base, base.upper(), base + " tail", base.replace("w1", "v1", 1), "One two", "one TWO", "x", prose(21, 3)]
    rows = simhash.near_duplicates(documents(rows_of(texts))).collect()
    prints = [fingerprint(t) for t in texts]
    roots = hamming_components(prints)
    got = {r.doc_id: r for r in rows}
    assert [got[i].fingerprint for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [got[i].component_id for i in range(len(texts))] == roots
    assert [got[i].kept for i in range(len(texts))] == [r == i for i, r in enumerate(roots)]


def test_kept_is_one_row_of_each_group_also_for_repeated_and_null_ids(documents):
    docs = documents([(7, "a b c d", "en", "a", 1), (7, "a b c d", "en", "a", 1), (None, "a b c d", "en", "a", 1), (None, "e f g h i", None, None, None)])
    rows = simhash.near_duplicates(docs.withColumn("fingerprint", F.lit(0))).collect()
    assert sum(r.kept for r in rows if r.component_id == 7) == 1 and sum(r.component_id == 7 for r in rows) == 3
    assert [r.kept for r in rows if r.component_id is None] == [True]


def clustered_prints(draw, n):
    out = set()
    while len(out) < n:
        centre = draw.getrandbits(64)
        for _ in range(draw.randrange(1, 40)):
            value = centre
            for _ in range(draw.randrange(4)):
                value ^= 1 << draw.randrange(64)
            out.add(value)
            centre = value if draw.random() < 0.3 else centre
    return sorted(out)


@pytest.mark.parametrize("compared", [4096, 2])
def test_pigeonring_finds_all_components(llm, monkeypatch, compared):
    """Both ways through a bucket: compared within a task, and met at points one bit away."""
    monkeypatch.setattr(simhash, "COMPARED", compared)
    prints = clustered_prints(random.Random(compared), 600)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    place = {s: i for i, s in enumerate(signed)}
    found = simhash.hamming_links(llm.createDataFrame([(s,) for s in signed], "__fingerprint long")).collect()
    assert all(bin(prints[place[r.a]] ^ prints[place[r.b]]).count("1") <= 2 or compared == 4096 for r in found)
    assert components(len(prints), [(place[r.a], place[r.b]) for r in found]) == hamming_components(prints)


def test_samples_are_balanced_and_repeatable(llm):
    rows = llm.range(20_000).select("id", F.when(F.col("id") % 100 == 0, "rare").when(F.col("id") % 7 != 0, "hot").alias("label"))
    first, again = (sorted(map(tuple, balanced_sample(rows, "label", "id", 150, 260).collect())) for _ in range(2))
    counts = {label: sum(r[1] == label for r in first) for label in ("rare", "hot")}
    assert first == again and len(first) == 260 and max(counts.values()) <= 150 and min(counts.values()) >= 110
    assert balanced_sample(rows.limit(0), "label", "id", 5, 5).count() == 0


def test_language_held_out_accuracy_and_rejection(llm):
    docs = llm.read.parquet(f"{FOLDER}/documents.parquet")
    model = langid.fit_languages(docs, training=~held_out(F.col("doc_id")))
    rows = langid.identify(docs, model).collect()
    tested = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([r.lang_pred == r.lang for r in tested]) > 0.97
    assert np.mean([r.rejected for r in rows]) < 0.01 and all(0 <= r.score <= 1 for r in rows)


def test_language_of_awkward_texts(documents):
    rows = [(i, prose(i, 40) if i % 2 else "der die das und nicht ein " * 5, "xx" if i % 2 else "yy", "s", 0) for i in range(60)]
    docs = documents(rows).withColumn("score", F.lit("clash"))
    model = langid.fit_languages(docs)
    texts = [None, "", "123 !? 45", "漢字", "der das nicht", prose(1, 200_000)]
    got = {r.doc_id: r for r in langid.identify(documents(rows_of(texts)), model).collect()}
    assert [got[i].lang_pred for i in range(3)] == ["und"] * 3 and all(got[i].rejected and got[i].score == 0 for i in range(3))
    assert got[3].lang_pred in ("xx", "yy") and got[4].lang_pred == "yy" and got[5].lang_pred == "xx"
    none = langid.fit_languages(documents([]))
    assert [r.lang_pred for r in langid.identify(documents(rows_of(["some text"])), none).collect()] == ["und"]
    assert langid.identify(docs, model).count() == 60 and langid.identify(documents([]), model).count() == 0


def test_long_texts_are_read_whole(monkeypatch):
    text = prose(3, 4000).encode()
    whole = langid.counted(text)
    monkeypatch.setattr(langid, "CHUNK", 100)
    pieces = langid.counted(text)
    assert all(np.array_equal(a, b) for a, b in zip(whole, pieces, strict=True))


def test_quality_held_out_accuracy(llm):
    docs, labels = (llm.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit_quality(docs, labels, training=~held_out(F.col("doc_id")))
    scored = quality.score_quality(docs, model).join(labels, "doc_id").where(held_out(F.col("doc_id"))).collect()
    assert np.mean([r.predicted == r.quality for r in scored]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored) and model.pairs


def test_quality_of_awkward_texts(documents, llm):
    docs = documents(rows_of([None, "", "  ", "$$$ ###", prose(1, 100_000)]) + [(None, "a b", None, None, None)]).withColumn("score", F.lit(3))
    empty = quality.fit_quality(docs, llm.createDataFrame([], "doc_id long, quality int"))
    assert [r.score for r in quality.score_quality(docs, empty).collect()] == [0.5] * 6
    labels = llm.createDataFrame([(0, 0), (1, 0), (3, 1), (3, 1), (4, None), (9, 1)], "doc_id long, quality int")
    rows = quality.score_quality(docs, quality.fit_quality(docs, labels)).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)


def test_tables_of_the_additive_model_learn_steps_and_pairs():
    rng = np.random.default_rng(0)
    values = rng.random((3000, 4))
    truth = ((values[:, 0] > 0.5) ^ (values[:, 1] > 0.3)).astype(float)
    model = quality.train(values[:2000], truth[:2000])
    assert ((model.scores(values[2000:]) >= 0.5) == truth[2000:]).mean() > 0.93
    assert (0, 1) in {(i, j) for i, j, *_ in model.pairs}


def test_substring_sql_twin_equals_brute_force():
    from tidemark.llm.queries import SQL

    texts = awkward_texts()
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    got = {r[0]: r[1:] for r in duck.execute(re.sub(r"\s+$", "", SQL["op1_substrings"])).fetchall()}
    for i, kept in enumerate(removed_words(texts, 35)):
        n = len(words(texts[i]))
        assert got[i] == (n, n - len(kept), sha256(kept))


def test_quality_trains_on_limited_rows_also_for_repeated_ids(llm, documents, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "train", lambda values, truth: seen.append(truth.tolist()) or quality.AdditiveModel(0.0))
    docs = documents([(1, prose(i, 20), None, None, None) for i in range(40)] + [(i, prose(i, 9), None, None, None) for i in (2, 3)])
    labels = llm.createDataFrame([(1, 1)] * 20 + [(2, 0), (3, 0)], "doc_id long, quality int")
    quality.fit_quality(docs, labels, limit=50)
    quality.fit_quality(docs.where("doc_id > 1"), labels, limit=50)
    assert seen == [[0.0] * 2 + [1.0] * 48, [0.0] * 2]
