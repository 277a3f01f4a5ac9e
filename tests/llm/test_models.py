"""The two trained models against plain-Python twins: scorers on awkward texts, trainers on small samples."""

from __future__ import annotations

import math
from bisect import bisect_right

import numpy as np
import pytest
from helpers import documents, llm, prose, rows_of  # noqa: F401  fixtures are imported too

from tidemark.llm import langid, quality

AWKWARD = [None, "", " ", "a", "!?", "12 34", "漢字 und mehr", "Ünïcode ÄÖÜ", "a\x00b\x0bc", "tab\there", "x" * 5000, prose(4, 3000)]


def plain_subwords(text):
    """Buckets of the 2-, 3- and 4-grams of bytes; a gap may stand at an end only."""
    folded = [0x20] + [b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 97 <= b <= 122 else 0x20 for b in text] + [0x20]
    for order in (2, 3, 4):
        for i in range(len(folded) - order + 1):
            gram = folded[i : i + order]
            if 0x20 in gram[1:-1] or gram == [0x20, 0x20]:
                continue
            code = (int.from_bytes(bytes(gram), "little") + order) * 0x9E3779B1 % 2**32
            code ^= code >> 15
            yield (code * 0x85EBCA77 % 2**32) >> (32 - langid.BUCKET_BITS)


def plain_judgement(model, text):
    if not any(c.isalpha() for c in text):
        return "und", 0.0, True
    sums, count = [0.0] * (len(model.languages) + 1), 0
    for bucket in plain_subwords(text.encode()):
        count += 1
        sums = [s + float(x) for s, x in zip(sums, model.table[bucket], strict=True)]
    means = [s / max(count, 1) for s in sums]
    odds = [math.exp(m + b) for m, b in zip(means, model.bias, strict=False)]
    best = max(range(len(odds)), key=lambda i: odds[i])
    score = odds[best] / sum(odds)
    return model.languages[best], score, score < model.least_score or means[-1] < model.least_seen


def test_language_scores_equal_plain_python(documents):  # noqa: F811
    texts = ["der die das und nicht " * 4, "the of and not a to " * 4, "le la et ne pas un " * 4]
    rows = [(i, texts[i % 3] + prose(i, 5), ("de", "en", "fr")[i % 3], "s", 0) for i in range(60)]
    model = langid.fit_languages(documents(rows))
    got = {r.doc_id: r for r in langid.identify(documents(rows_of(AWKWARD + texts)), model).collect()}
    for i, text in enumerate(AWKWARD + texts):
        language, score, rejected = plain_judgement(model, text or "")
        assert (got[i].lang_pred, got[i].rejected) == (language, rejected)
        assert got[i].score == pytest.approx(score, abs=1e-6)


def test_language_training_equals_plain_steps():
    """Table and bias of two epochs, up to the temperature that both are divided by."""
    examples = [(*langid.counted(t.encode()), name) for t, name in (("ab ba", "x"), ("cd dc d", "y"), ("abc", "x"), ("dd", "y"))]
    width, epochs, rate = 4, 2, 0.5
    model = langid.train(examples, width=width, epochs=epochs, rate=rate, seed=3)
    rng = np.random.default_rng(3)
    inner = rng.uniform(-1 / width, 1 / width, (langid.BUCKETS, width)).tolist()
    outer, bias = rng.normal(0, 1 / width**0.5, (width, 2)).tolist(), [0.0, 0.0]
    fitted, done = examples[1:], 0
    for _ in range(epochs):
        for i in rng.permutation(len(fitted)):
            held, counts, name = fitted[i]
            now = rate * (1 - done / (epochs * len(fitted)))
            done += 1
            share = [c / sum(counts) for c in counts]
            mean = [sum(s * inner[h][d] for s, h in zip(share, held, strict=True)) for d in range(width)]
            logits = [sum(mean[d] * outer[d][k] for d in range(width)) + bias[k] for k in range(2)]
            odds = [math.exp(x - max(logits)) for x in logits]
            wrong = [o / sum(odds) - (k == "xy".index(name)) for k, o in enumerate(odds)]
            pull = [sum(outer[d][k] * wrong[k] for k in range(2)) for d in range(width)]
            norm = math.sqrt(sum(s * s for s in share))
            for d in range(width):
                for k in range(2):
                    outer[d][k] -= now * mean[d] * wrong[k]
                for s, h in zip(share, held, strict=True):
                    inner[h][d] -= now * s / norm * pull[d]
            bias = [b - now * 0.1 * w for b, w in zip(bias, wrong, strict=True)]
    heat = bias[0] / model.bias[0]
    assert any(heat == pytest.approx(t) for t in np.geomspace(0.05, 5, 60))
    for held, _, _ in examples:
        for h in held:
            plain = [sum(inner[h][d] * outer[d][k] for d in range(width)) / heat for k in range(2)]
            assert model.table[h][:2].tolist() == pytest.approx(plain, rel=1e-4, abs=1e-5)
            assert model.table[h][2] == 1
    assert model.bias.tolist() == pytest.approx([b / heat for b in bias])


def plain_score(model, row):
    total = model.intercept
    for value, borders, table in zip(row, model.borders, model.tables, strict=True):
        total += table[bisect_right(borders.tolist(), value)]
    for i, j, down, across, table in model.pairs:
        total += table[bisect_right(down.tolist(), row[i])][bisect_right(across.tolist(), row[j])]
    return 1 / (1 + math.exp(-total))


def test_quality_scores_equal_plain_sums_of_table_entries(documents, llm):  # noqa: F811
    good, bad = [prose(i, 60) for i in range(30)], ["$$$ BUY now !!! " * (i % 7 + 1) for i in range(30)]
    labels = llm.createDataFrame([(i, int(i < 30)) for i in range(60)], "doc_id long, quality int")
    model = quality.fit_quality(documents(rows_of(good + bad)), labels)
    assert len(model.tables) == len(quality.FEATURES) and model.pairs
    for r in quality.score_quality(documents(rows_of(AWKWARD + good[:2] + bad[:2])), model).collect():
        row = [float(x) for x in quality.features((r.text or "").encode())]
        assert r.score == pytest.approx(plain_score(model, row), abs=1e-9)
        assert r.predicted == int(r.score >= 0.5)


def plain_tree(gradient, weight, leaves):
    def worth(a, b):
        return sum(gradient[a:b]) ** 2 / (sum(weight[a:b]) + 1.0)

    spans = [(0, len(gradient))]
    while len(spans) < leaves:
        tries = [
            (worth(a, c) + worth(c, b) - worth(a, b), (a, b), c) for a, b in spans for c in range(a + 1, b)
        ]
        tries = [t for t in tries if t[0] > 1e-9]
        if not tries:
            break
        _, (a, b), c = max(tries, key=lambda t: t[0])
        spans = [s for s in spans if s != (a, b)] + [(a, c), (c, b)]
    value = {s: sum(gradient[s[0] : s[1]]) / (sum(weight[s[0] : s[1]]) + 1.0) for s in spans}
    return [value[s] for k in range(len(gradient)) for s in spans if s[0] <= k < s[1]]


def test_feature_tables_equal_a_plain_cyclic_trainer():
    rng = np.random.default_rng(5)
    values = rng.random((60, 3))
    truth = (values[:, 0] + 0.3 * rng.random(60) > 0.6).astype(float)
    model = quality.train(values, truth, rounds=5, rate=0.2, leaves=3, bins=6, pairs=0)
    share = (truth.sum() + 1) / 62
    assert model.intercept == pytest.approx(math.log(share / (1 - share)))
    tables = [[0.0] * (len(b) + 1) for b in model.borders]
    place = [[bisect_right(b.tolist(), v) for v in values[:, i]] for i, b in enumerate(model.borders)]
    for _ in range(5):
        for i, table in enumerate(tables):
            gradient, weight = [0.0] * len(table), [0.0] * len(table)
            for n in range(60):
                total = model.intercept + sum(t[p[n]] for t, p in zip(tables, place, strict=True))
                chance = 1 / (1 + math.exp(-total))
                gradient[place[i][n]] += truth[n] - chance
                weight[place[i][n]] += chance * (1 - chance)
            for k, step in enumerate(plain_tree(gradient, weight, 3)):
                table[k] += 0.2 * step
    for ours, plain in zip(model.tables, tables, strict=True):
        assert ours.tolist() == pytest.approx(plain, abs=1e-9)
