"""Mixing, packing, sharding, URLs, vectors and the pipeline against brute force."""

from __future__ import annotations

import itertools
import math
import random
import zlib

import numpy as np
import pytest
from helpers import (  # noqa: F401  fixtures are imported too
    components,
    documents,
    fingerprint,
    hamming_components,
    llm,
    mix,
    prose,
    removed_words,
    rows_of,
    words,
)
from pyspark.sql import functions as F

from tidemark.llm import curves, lattice, mixing, packing, sharding, urls
from tidemark.llm.hilbert import hilbert_index
from tidemark.llm.queries import tokenizer_path

SMALL = "/root/testdata/sf0.001"


def mixed_rows():
    draw = random.Random(2)
    rows = [(i, prose(i, draw.randrange(60)), None, draw.choice(["a", "b", "c", "d", None, "é"]), 0) for i in range(300)]
    rows += [(1000 + i, prose(i, 3), None, "tiny", 0) for i in range(2)] + [(7, "x y", None, "a", 0)] * 5
    return rows + [(None, "one two", None, "a", 0), (2000, None, None, "void", 0), (2001, "", None, "void", 0)]


def test_mix_equals_sorting(documents):
    rows = mixed_rows()
    docs = documents(rows).withColumn("size", F.lit("clash"))
    got = mixing.mix(docs).select("doc_id", "source", "text", "size", "source_size", "target", "taken")
    expected = mix([(key, source, len(words(text))) for key, text, _, source, _ in rows])
    left = sorted((r.doc_id or -1, r.source or "", r.size, r.source_size, round(r.target, 6), r.taken) for r in got.collect())
    right = sorted((row[0] or -1, row[3] or "", e[0], e[1], round(e[2], 6), e[3]) for row, e in zip(rows, expected, strict=True))
    assert left == right
    taken = sum(r[5] for r in left)
    assert abs(taken - sum(r[2] for r in left)) < 300


def test_mix_repeats_whole_documents_and_takes_nothing_from_nothing(documents):
    docs = documents([(1, "a b c", "en", "s", 5), (2, "d", "en", "t", 1)])
    mixed = mixing.mix(docs)
    copies = {r.doc_id: r.copies for r in mixed.collect()}
    assert mixing.take(mixed, docs.columns).count() == sum(copies.values())
    assert mixing.mix(documents([])).count() == 0
    assert [r.taken for r in mixing.mix(documents([(1, None, None, None, None)])).collect()] == [0]


def test_packing_round_trip(documents):
    from tokenizers import Tokenizer

    texts = [None, "", "  ", "It's DON'T 'the <|endoftext|>x", "ΑΣ İ a\x1cb a\u00a0b x_-y 12½² 漢字🙂", prose(1, 9000), prose(2, 30)]
    docs = documents(rows_of(texts) + [(3, "again", None, None, None), (None, "no id", None, None, None)])
    rows = packing.pack(docs.withColumn("length", F.lit("clash")), tokenizer_path()).collect()
    whole = Tokenizer.from_file(tokenizer_path())
    expected = sorted([*whole.encode(t or "", add_special_tokens=False).ids, 1] for t in [*texts, "again", "no id"])
    for r in rows:
        assert r.length & (r.length - 1) == 0 and 0 < r.length <= 2048 and len(r.ids) == 4 * r.length and r.offset == 0
        assert 1 << (r.sequence_id % 16) == r.length
    assert len({r.sequence_id for r in rows}) == len(rows)
    found = []
    for _, group in itertools.groupby(rows, key=lambda r: (r.doc_id, r.doc_tokens)):
        group = sorted(group, key=lambda r: r.start)
        assert [r.start for r in group] == [0, *itertools.accumulate(r.length for r in group)][:-1]
        found.append(np.frombuffer(b"".join(r.ids for r in group), "<u4").tolist())
    assert sorted(found) == expected
    assert packing.pack(documents([]), tokenizer_path()).count() == 0


def test_cache_generations_change_nothing(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 20)
    encoder = packing.WordEncoder(tokenizer_path())
    texts = [prose(s, 30, 50).encode() for s in range(20)]
    small = [encoder.encode([t])[0] for t in texts]
    monkeypatch.undo()
    assert small == packing.WordEncoder(tokenizer_path()).encode(texts)


def test_words_that_differ_in_case_are_learned_once():
    encoder = packing.WordEncoder(tokenizer_path())
    small, mixed = encoder.encode([b"the cat, naive cat", b"The CAT, Naive cat"])
    assert small == mixed and set(encoder.by_word) == {b"the", b"cat,", b"naive", b"cat"}


@pytest.mark.parametrize(
    "text",
    [
        "J\u030c j\u030c \u01f0 H\u0331 W\u030a T\u0308",  # small letters that join a mark, capitals that do not
        "I\u0307 \u0130 \u01c4 \u03a3A\u03a3 A\u03a3. \u212aK \u017fS",
        "<|endoftext|> <|ENDOFTEXT|> a<|EndOfText|>B",
        "Don't DON'T We'Re x'S 'S' abc1 Ab12, c_ _C \u00c9t\u00c9! \u00df\u1e9e A\u00b2 B\u0085C",
    ],
)
def test_lower_casing_first_changes_no_token(text):
    from tokenizers import Tokenizer

    found = packing.WordEncoder(tokenizer_path()).encode([text.encode()])[0]
    assert np.frombuffer(found, "<u4").tolist() == Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        grid = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = hilbert_index(grid, bits)
        order = np.argsort(keys)
        assert np.array_equal(np.sort(keys), np.arange(len(grid)))
        assert (np.abs(np.diff(grid[order], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("n", [0, 5, 100, 1003])
def test_shards_are_even_runs_of_the_curve(documents, n):
    draw = random.Random(n)
    rows = [(i if i % 9 else None, prose(i % 40, i % 30), draw.choice(["en", None]), draw.choice(["s", "s", None]), None) for i in range(n)]
    docs = documents(rows).withColumn("shard", F.lit("clash"))
    dimensions = {"source": sharding.value_cells(docs, "source"), "chars": F.length("text"), "id": F.col("doc_id")}
    got = sharding.shard_along_curve(docs, dimensions, ("text", "doc_id")).collect()
    assert len(got) == n
    counts = [[r.slot for r in got if r.shard == s] for s in range(24)]
    assert max(map(len, counts)) - min(map(len, counts)) <= 1
    assert all(sorted(c) == list(range(len(c))) for c in counts)
    keys = [r.curve_key for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert keys == sorted(keys)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host, tail = (rest[: min(ends)], rest[min(ends) :]) if ends else (rest, "")
    cut = [tail.find(c) for c in "?#" if c in tail]
    return "".join(c.lower() if c.isascii() else c for c in host), tail[: min(cut)] if cut else tail


URLS = [
    None, "", "no-scheme.org/x", "http://Example.ORG/es/1", "https://a.example.org/en/12?q#f", "x://org", "x://org/", "http://myorg/",
    "http://b.com/fr/1", "http://com/de/", "http://c.com/DE/", "http://a.net?x=/de/", "http://É.com/fr/\nnew", "http://h#://x/y", "://a.com/de/x",
    "http://casino-win.net/en/1", "http://bestcasino.net/win", "http://news.site.net/en/2",
]


def test_urls_and_rules_equal_plain_python(llm):
    html = "<html><script>var casinox</script><p>best news site win the casino and best win of news</p></html>"
    pages = llm.createDataFrame([(i, u, html) for i, u in enumerate(URLS)] + [(None, None, None), (3, URLS[3], "")], "page_id long, url string, html string")
    rows = urls.filter_urls(pages.withColumn("host", F.lit("clash"))).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        host, path = parts(URLS[r.page_id] if r.page_id is not None else None)
        assert (r.host, r.path) == (host, path)
        fits = [x for x in urls.RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        rule = max(fits, key=lambda x: len(x.text), default=None)
        assert r.rule == (rule and rule.text)
        assert r.verdict == (rule.verdict if rule else "block" if r.block_score > 0.5 else "allow")
    by = {r.page_id: r for r in rows}
    assert by[15].verdict == by[16].verdict == "block" and by[17].verdict == "allow"
    assert urls.filter_urls(pages.limit(0)).count() == 0


def test_best_split_is_the_best_of_all():
    known = {"the": 90, "then": 20, "hen": 5, "n": 1, "he": 40, "cat": 7, "t": 1}
    total = sum(known.values())

    def cost(word):
        return math.log(known[word] / total) if word in known else math.log(10 / total) - len(word) * math.log(10)

    for chunk in ("thenthe", "thencat", "xthe", "hencatt", "zzz"):
        splits = [
            [chunk[a:b] for a, b in itertools.pairwise((0, *cuts, len(chunk)))]
            for k in range(len(chunk))
            for cuts in itertools.combinations(range(1, len(chunk)), k)
        ]
        best = max(sum(map(cost, s)) for s in splits)
        assert math.isclose(sum(map(cost, urls.best_split(chunk, known, total))), best)


def vector_rows(seed=4):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1):
        for _ in range(12):
            centre = rng.normal(size=24)
            for _ in range(rng.integers(1, 9)):
                rows.append((centre + rng.normal(size=24) * rng.choice([0.0, 0.02, 0.08]), label))
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, (v, label) in enumerate(rows)]
    n = len(rows)
    odd = [None, [], [0.0] * 24, [math.nan] + [1.0] * 23, [math.inf] + [1.0] * 23, [None] + [1.0] * 23]
    rows += [(n + i, v, 0) for i, v in enumerate(odd)] + [(n + 9, rows[0][1], None), (n + 10, rows[0][1], 0), (n + 10, rows[0][1], 0)]
    return rows + [(n + 11, [1.0, 2.0], 0), (n + 12, [2.0, 4.0], 0), (None, [5.0, 5.0], 1)]


def valid(vector):
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector) and any(vector)


def cosine(a, b):
    return float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)))


@pytest.mark.parametrize("block", [1024, 3])
def test_lattice_links_equal_all_pairs(llm, monkeypatch, block):
    monkeypatch.setattr(lattice, "BLOCK_ROWS", block)
    rows = vector_rows()
    df = llm.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("links", F.lit(1))
    got = sorted((r.vec_id if r.vec_id is not None else 9999, r.n_links, r.component_id, r.kept) for r in lattice.near_vectors(df).collect())
    links = [
        (i, j)
        for (i, a), (j, b) in itertools.combinations(enumerate(rows), 2)
        if a[2] is not None and a[2] == b[2] and valid(a[1]) and valid(b[1]) and len(a[1]) == len(b[1]) and cosine(a[1], b[1]) >= 0.98
    ]
    degree = [sum(i in pair for pair in links) for i in range(len(rows))]
    roots = components(len(rows), links)
    expected = sorted(
        (i if i is not None else 9999, degree[k], rows[roots[k]][0], i == rows[roots[k]][0]) for k, (i, _, _) in enumerate(rows)
    )
    assert got == expected


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(1)
    near = np.vstack([lattice.shortest_vectors(), np.zeros((1, 8), int)])
    assert len(near) == 241 and len({tuple(v) for v in near}) == 241 and set((near[:240] ** 2).sum(axis=1)) == {8}
    points = rng.normal(size=(500, 8)) * 3
    home = lattice.nearest_points(points)
    assert all((len(set(v % 2)) == 1) and v.sum() % 4 == 0 for v in home)
    own = ((points - home / 2) ** 2).sum(axis=1)
    others = ((points[:, None, :] - (home[:, None, :] + near[None]) / 2) ** 2).sum(axis=2)
    assert (own <= others.min(axis=1) + 1e-9).all() and (own <= 1 + 1e-9).all()


def test_curves_recall_and_exact_scores(llm):
    df = llm.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = {r.vec_id: np.array(r.embedding, dtype=float) for r in df.collect()}
    ids = np.array(sorted(rows))
    unit = np.stack([rows[i] / np.linalg.norm(rows[i]) for i in ids])
    found = curves.nearest(df).collect()
    hits = total = 0
    for place, query in ((p, i) for p, i in enumerate(ids) if i % 50 == 0):
        own = sorted((r for r in found if r.query_id == query), key=lambda r: r.rank)
        scores = unit @ unit[place]
        scores[place] = -2
        best = np.lexsort((ids, -scores))[:5]
        assert [r.rank for r in own] == [1, 2, 3, 4, 5]
        assert all(math.isclose(r.score, scores[np.searchsorted(ids, r.vec_id)], abs_tol=1e-12) for r in own)
        hits, total = hits + len({r.vec_id for r in own} & set(ids[best].tolist())), total + 5
    assert hits / total >= 0.9


def test_curves_on_awkward_rows(llm):
    rows = [(i, [1.0, 0.5], 0) for i in range(0, 40)] + [(50, [0.0, 1.0], 0), (100, [2.0, 1.0], 0), (150, [1.0], 0), (200, None, 0), (250, [0.0, 0.0], 0)]
    rows += [(None, [1.0, 0.4], 0), (300, [math.nan, 1.0], 0)]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rank", F.lit(0))
    got = {}
    for r in curves.nearest(df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert sorted(got) == [0, 50, 100]
    assert sorted(got[0]) == [(i, i) for i in range(1, 6)] and sorted(got[100]) == [(i + 1, i) for i in range(5)]
    assert curves.nearest(df.limit(0)).count() == 0
    few = llm.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0)], "vec_id long, embedding array<float>, label int")
    assert [(r.query_id, r.vec_id) for r in curves.nearest(few).collect()] == [(0, 1)]


def test_curves_answer_every_query_among_equal_vectors(llm):
    rows = [(i, [1.0, 0.5], 0) for i in range(1000)] + [(1000, [1.0, 0.6], 0), (1000, [1.0, 0.6], 0)]
    df = llm.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {}
    for r in curves.nearest(df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert sorted(got) == list(range(0, 1001, 50))
    assert sorted(got[0]) == [(i, i) for i in range(1, 6)]
    assert all(sorted(got[i]) == [(k + 1, k) for k in range(5)] for i in range(50, 1000, 50))
    assert sorted(got[1000]) == sorted(2 * [(1, 1000), *((k + 2, k) for k in range(4))])


def test_curves_compare_all_rows_of_a_length_without_cuts(llm):
    rng = np.random.default_rng(5)
    vectors = np.float32(rng.normal(size=(1000, 12))).astype(float)
    df = llm.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int")
    got = {}
    for r in sorted(curves.nearest(df, sample=0).collect(), key=lambda r: r.rank):
        got.setdefault(r.query_id, []).append(r.vec_id)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for query in range(0, 1000, 50):
        scores = unit @ unit[query]
        scores[query] = -2
        assert got[query] == np.argsort(-scores)[:5].tolist()


def test_pipeline_stages_equal_brute_force(llm, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer

    docs = llm.read.parquet(f"{SMALL}/documents.parquet")
    columns, outputs = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        stage(llm, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = llm.read.parquet(str(tmp_path / name))
        outputs.append(docs)
    assert all(o.columns == columns for o in outputs[:-1])
    language, near, passages, mixed, packed = [[r.asDict() for r in o.collect()] for o in outputs]
    source = {r.doc_id: r.asDict() for r in llm.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert all(r == source[r["doc_id"]] for r in language) and len(language) > 0.97 * len(source)

    language.sort(key=lambda r: r["doc_id"])
    roots = hamming_components([fingerprint(r["text"]) for r in language])
    kept = [r for i, r in enumerate(language) if roots[i] == i]
    assert sorted(r["doc_id"] for r in near) == [r["doc_id"] for r in kept] and all(r == source[r["doc_id"]] for r in near)

    left = {r["doc_id"]: w for r, w in zip(kept, removed_words([r["text"] for r in kept], 35), strict=True)}
    for r in passages:
        old = source[r["doc_id"]]["text"]
        assert words(r["text"]) == left[r["doc_id"]] and (r["text"] == old or r["n_chars"] == len(r["text"]))
        assert (r["text"] == old) == (len(left[r["doc_id"]]) == len(words(old)))
    assert len(passages) == len(near)

    sizes = [(r["doc_id"], r["source"], len(words(r["text"]))) for r in passages]
    taken = {key: (size, t[3]) for (key, _, size), t in zip(sizes, mix(sizes), strict=True)}
    for key, (size, words_taken) in taken.items():
        assert size * sum(r["doc_id"] == key for r in mixed) == words_taken

    encode = Tokenizer.from_file(tokenizer_path())
    expected = sorted(zlib.crc32(np.array([*encode.encode(r["text"], add_special_tokens=False).ids, 1], "<u4").tobytes()) for r in mixed)
    packed.sort(key=lambda r: r["sequence_id"])
    got, run = [], b""
    for r in packed:
        run = r["ids"] if r["start"] == 0 else run + r["ids"]
        if r["start"] + r["length"] == r["doc_tokens"]:
            got.append(zlib.crc32(run))
    assert sorted(got) == expected


def test_queries_take_empty_tables(llm, tmp_path):
    from tidemark.llm.queries import QUERIES

    for name in ("documents", "labels", "embeddings", "pages"):
        llm.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name, build in QUERIES.items():
        assert build(llm, str(tmp_path)).count() == 0, name
