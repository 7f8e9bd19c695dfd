"""Phrases against counting them one by one."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from gameflow.llm import collocations

SCHEMA = "lang string, text string, phrase string, n int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, longest=3, least=10, subsumed=50, top=2000):
    counts = {}
    for lang, text in rows:
        c = counts.setdefault(lang or "und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            for k in range(1, longest + 1):
                c.update(words[i:i + k] for i in range(len(words) - k + 1))
    result = []
    for lang, c in counts.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        most = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    most[p[i:i + k]] = max(most[p[i:i + k]], a)
        scored = []
        for p, a in candidates.items():
            if most[p] and 100 * most[p] >= subsumed * a:
                continue
            score, _, l, r = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            result.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(result)


def got(spark, rows, **options):
    frame = spark.createDataFrame([(a, b, "clash", 1) for a, b in rows], SCHEMA)
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations.collocations(frame, **options).collect())


def texts(rng, n, words):
    fixed = [rng.sample(words, k) for k in (2, 3, 3, 4, 5)]
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(1, 30)):
            parts += rng.choice(fixed) if rng.random() < 0.3 else [rng.choice(words)]
            parts.append(rng.choice(["", "", "", "", ".", ",\t", " ;", "\n", "?!"]))
        yield " ".join(parts)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = ["the", "The", "é", "É", "of", "a", "b", "x-y", "#", "ß"] + [f"w{k}" for k in range(30)]
    found = [(rng.choice(["en", "en", "en", "de", None, "und"]), t) for t in texts(rng, 400, words)]
    return found + [("en", None), ("fr", None), ("fr", ""), (None, " \t\n"), ("de", "solo"), *found[:20]]


def test_counts_and_ranks(spark, rows):
    expected = brute(rows)
    assert len(expected) > 30
    assert got(spark, rows) == expected


@pytest.mark.parametrize("options", [
    {"longest": 2, "least": 3}, {"longest": 4, "least": 5}, {"least": 2, "subsumed_percent": 100}, {"top": 5},
])
def test_other_settings(spark, rows, options):
    names = {"subsumed_percent": "subsumed"}
    assert got(spark, rows, **options) == brute(rows, **{names.get(k, k): v for k, v in options.items()})


def test_small_chunks_merges_and_segments(spark, rows, monkeypatch):
    """The same result when blocks are tiny, stripes are merged in many steps and hot prefixes are cut."""
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 100)
    monkeypatch.setattr(collocations, "MERGED", 50)
    monkeypatch.setattr(collocations, "SHARES", 64)
    assert got(spark, rows) == brute(rows)


def test_a_full_filter_changes_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(collocations, "_passes", lambda bits, hashes: np.ones(len(hashes), bool))
    assert got(spark, rows) == brute(rows)


def test_long_texts(spark):
    long = [("en", "a b " * 150_000), ("en", "x" * 1_000_000), ("en", ". " * 500_000), ("en", "w " * 11 + "\n" * 1_000_000)]
    assert got(spark, long) == brute(long)


def test_empty(spark):
    assert got(spark, []) == [] == got(spark, [("en", None), (None, "a b c")])
