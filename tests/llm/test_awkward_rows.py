"""Rows that once went wrong: colliding words, ids that repeat, long common beginnings, clashing columns."""

from __future__ import annotations

import random

import pytest
from helpers import documents, llm, prose, rows_of  # noqa: F401  fixtures are imported too
from pyspark.sql import functions as F

from tidemark.llm import langid, sharding, substrings
from tidemark.llm.labelled import balanced_sample, with_text


def thue_morse(length, zero="a", one="b"):
    return "".join(one if i.bit_count() % 2 else zero for i in range(length))


@pytest.mark.parametrize("length", [32, 64, 128, 512, 1024, 4096])
def test_words_that_collide_under_polynomials_are_told_apart(llm, documents, length):  # noqa: F811
    common = prose(1, 34)
    texts = [f"{common} {thue_morse(length)}", f"{common} {thue_morse(length, 'b', 'a')}"]
    found = substrings.remove_repeats(documents(rows_of(texts)), carried=["doc_id"]).collect()
    assert [r["n_removed"] for r in found] == [0, 0] and {r["kept"] for r in found} == set(texts)


def test_sampled_rows_keep_their_own_languages_under_one_id(llm, documents):  # noqa: F811
    rows = [(1, "das ist deutsch", "de", "a", 0), (1, "this is english", "en", "a", 0), (1, "nobody knows", None, "a", 0)]
    rows += [(None, "sin número", "es", "a", 0), (None, "sin número", "es", "a", 0)]
    docs = documents(rows)
    sample = balanced_sample(docs, "lang", "doc_id", 10, 10, "text")
    assert sample.count() == 4
    found = sorted((r["text"], r["lang"], r["__times"]) for r in with_text(docs, sample, "doc_id", "lang", "text").collect())
    assert found == [("das ist deutsch", "de", 1), ("sin número", "es", 2), ("this is english", "en", 1)]


def test_copies_of_an_id_do_not_exceed_the_sample(llm, documents):  # noqa: F811
    rows = [(7, f"copy {i % 5} of a text", "en", "a", 0) for i in range(40)] + [(i, prose(i, 20), "de", "a", 0) for i in range(30)]
    docs = documents(rows)
    sample = balanced_sample(docs, "lang", "doc_id", 12, 20, "text")
    found = with_text(docs, sample, "doc_id", "lang", "text").collect()
    assert sample.count() == 20 and sum(r["__times"] for r in found) == 20
    assert len({(r["doc_id"], r["text"]) for r in found}) == len(found)


@pytest.mark.parametrize("texts", [[None, "", None], [], ["1 2 3", "", None]])
def test_language_id_without_anything_to_learn_says_und(llm, documents, texts):  # noqa: F811
    model = langid.fit_languages(documents(rows_of(texts)))
    found = langid.identify(documents(rows_of(["plain words", None, ""])), model).collect()
    assert [r["lang_pred"] for r in found] == ["und"] * 3 and all(r["rejected"] for r in found)


def test_values_with_a_common_beginning_get_cells_of_their_own(llm, documents):  # noqa: F811
    names = [f"common_crawl_of_the_year_{2000 + i}" for i in range(12)] + ["zebra", "äther", "Upper", None]
    rows = [(i, "x", "en", names[i % 16], 0) for i in range(1600)]
    docs = documents(rows)
    cells = {r["source"]: r["cell"] for r in docs.withColumn("cell", sharding.value_cells(docs, "source")).collect()}
    assert len(set(cells.values())) == 16 and cells[None] == -1
    ordered = sorted((n for n in names if n), key=str.encode)
    assert [cells[n] for n in ordered] == sorted(cells[n] for n in ordered)
    dimensions = {"source": sharding.value_cells(docs, "source"), "id": F.col("doc_id")}
    placed = sharding.shard_along_curve(docs, dimensions, ("doc_id",)).collect()
    kinds = [{r["source"] for r in placed if r["shard"] == s} for s in range(24)]
    assert max(map(len, kinds)) <= 8


def test_cells_hold_like_shares_of_many_values(llm, documents):  # noqa: F811
    draw = random.Random(4)
    rows = [(i, "x", "en", "hot" if i % 3 == 0 else f"{draw.randrange(10**9):09d}", 0) for i in range(9000)]
    docs = documents(rows)
    held = [r["count"] for r in docs.groupBy(sharding.value_cells(docs, "source", 30).alias("cell")).count().collect()]
    assert max(held) <= 3000 + 301 and sorted(held)[-2] <= 330 and len(held) <= 31


CLASHES = ("score", "rejected", "lang_pred", "kept", "fingerprint", "component_id", "n_words", "n_removed", "spans", "size", "copies", "taken", "target", "__copy", "KEPT2")


def test_pipeline_stages_carry_clashing_columns_and_awkward_rows(llm, documents, tmp_path):  # noqa: F811
    import corpus_pipeline

    passage = prose(9, 60)
    texts = [None, "", " ", "same words here"] + ["the same text of some words again"] * 4
    texts += [f"{prose(i, 40)} {passage} {prose(100 + i, 40)}" for i in range(5)] + [prose(50 + i, 80) for i in range(30)]
    rows = rows_of(texts) + rows_of(["repeated row of a few words"])[:1] * 3
    docs = documents(rows).withColumns({c: F.concat(F.lit(f"{c}-"), F.coalesce(F.col("text"), F.lit(""))) for c in CLASHES})
    docs.write.parquet(str(tmp_path / "start"))
    now = llm.read.parquet(str(tmp_path / "start"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(llm, now, "").write.parquet(str(tmp_path / name))
        then = llm.read.parquet(str(tmp_path / name))
        assert then.columns == docs.columns and then.count() > 0
        assert all(r[c].startswith(f"{c}-") for r in then.select(*CLASHES).collect() for c in CLASHES)
        now = then
    assert corpus_pipeline.STAGES[-1][1](llm, now, "").count() > 0


def test_pipeline_stages_take_an_empty_table(llm, documents):  # noqa: F811
    import corpus_pipeline

    for _, stage in corpus_pipeline.STAGES:
        assert stage(llm, documents([]), "").count() == 0
