"""Brute-force versions of the operators, and small tables of awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tidemark.llm.shared import prepare

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def documents(llm):
    return lambda rows: llm.createDataFrame(rows, DOCUMENTS)


def words(text):
    return WORD.findall(text or "")


def prose(seed, n, stock=4000):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(stock)}" for _ in range(n))


def rows_of(texts, lang="en", source="a"):
    return [(i, t, lang, source, len(t or "")) for i, t in enumerate(texts)]


def removed_words(texts, window):
    """For each text the words that are kept, judged on windows of all texts."""
    split = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append([x for i, x in enumerate(w) if i not in gone])
    return out


def sha256(kept):
    return hashlib.sha256(" ".join(kept).encode()).hexdigest()


def fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def hamming_components(prints):
    values = np.array(prints, dtype=np.uint64)
    links = [
        (i, i + 1 + int(j)) for i in range(len(values)) for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[i + 1 :]) <= 2)
    ]
    return components(len(values), links)


def unit_hash(key):
    return int(hashlib.md5(("" if key is None else str(key)).encode()).hexdigest()[:8], 16)


def targets(sizes, weights=(5, 2, 1), repeats=3):
    """Target of each source by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = sum(sizes.values()), set(names), dict.fromkeys(names, 0.0)
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total >= repeats * sizes[s]]
        if not over:
            for s in open_:
                target[s] = left * weight[s] / total
            break
        for s in over:
            target[s] = float(repeats * sizes[s])
        left -= sum(repeats * sizes[s] for s in over)
        open_ -= set(over)
    return target


def mix(rows, repeats=3):
    """(size, source_size, target, taken) for rows of (key, source, size), by sorting."""
    sizes = Counter()
    for _, source, size in rows:
        sizes[source] += size
    target, cut = targets(sizes, repeats=repeats), {}
    for source in sizes:
        whole = repeats if target[source] >= repeats * sizes[source] else int(target[source] // sizes[source])
        budget, below, limit = target[source] - whole * sizes[source], 0, 0
        held = Counter()
        for key, own, size in rows:
            if own == source:
                held[unit_hash(key)] += size
        for unit in sorted(held):
            if below < budget <= below + held[unit]:
                limit = unit + 1 if below + held[unit] - budget < budget - below else unit
            below += held[unit]
        cut[source] = whole, limit
    return [
        (size, sizes[source], target[source], size * (cut[source][0] + (unit_hash(key) < cut[source][1])))
        for key, source, size in rows
    ]
