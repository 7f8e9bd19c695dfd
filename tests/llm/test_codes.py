"""Codes against whole-number arithmetic done entry by entry."""

import hashlib
import math
import random

import numpy as np
import pytest

from gameflow.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string"


def brute(rows, parts=8, entries=16, rounds=6):
    """Result rows by Python's own integers."""
    kept = [(i, [math.floor(4096 * x) for x in v], y) for i, v, y in rows
            if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    first = {}
    for (i, _, _), c in sorted(zip(kept, cut, strict=True), key=lambda x: (x[0][0] is None, x[0][0] or 0, x[1])):
        if i is not None:
            first.setdefault(i, c)
    books = [[list(c[p]) for c in list(first.values())[:entries]] for p in range(parts)]

    def nearest(x, book):
        far = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            got = {}
            for c in cut:
                got.setdefault(nearest(c[p], books[p])[0], []).append(c[p])
            for e, members in got.items():
                books[p][e] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for _, d in f) for f in found]
    by_label = {}
    for (_, _, y), e in zip(kept, errors, strict=True):
        by_label[y] = by_label.get(y, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((str(i), "".join(f"{c:02x}" for c, _ in f), e, by_label[y], digest)
                  for (i, _, y), f, e in zip(kept, found, errors, strict=True))


def got(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, y, "clash", None) for i, v, y in rows], SCHEMA)
    result = codes.vector_codes(frame, **options).collect()
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in result)


def floats(rng, n, scale=1.0):
    return [float(np.float32(rng.gauss(0, scale))) for _ in range(n)]


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for width, top in ((8, 1 << 27), (1, 1 << 27), (64, 1 << 25), (512, 1 << 20)):
        x, y = rng.integers(-top + 1, top, (50, width)), rng.integers(-top + 1, top, (16, width))
        x[0], y[0] = top - 1, 1 - top
        exact = x.astype(object) @ y.T.astype(object)
        assert (codes.dot_products(x, y) == exact).all()


def test_first_of_equal_entries_is_taken():
    book = np.array([[5, 0], [0, 5], [5, 0]])
    assert codes.nearest(np.array([[5, 0], [0, 0], [0, 9]]), book)[0].tolist() == [0, 0, 1]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_vectors(spark, seed):
    rng = random.Random(seed)
    centres = [floats(rng, 16) for _ in range(5)]
    rows = [(7 * k % 311, [a + b for a, b in zip(rng.choice(centres), floats(rng, 16, 0.2), strict=True)], k % 4 or None) for k in range(300)]
    rows = [(i, [float(np.float32(x)) for x in v], y) for i, v, y in rows]
    assert got(spark, rows) == brute(rows)


def test_large_components_and_other_shapes(spark):
    rng = random.Random(5)
    rows = [(k, floats(rng, 24, 9000.0), 1) for k in range(60)]
    rows = [(i, [max(-32767.0, min(32767.0, x)) for x in v], y) for i, v, y in rows]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows, parts=4, entries=5, rounds=2) == brute(rows, 4, 5, 2)
    with pytest.raises(Exception, match="too large"):
        got(spark, [*rows, (99, [40000.0] * 24, 1)])


def test_odd_rows(spark):
    rng = random.Random(9)
    good = [(k, floats(rng, 8), [None, 3][k % 2]) for k in range(40)]
    nan, inf = float("nan"), float("inf")
    odd = [(50, None, 1), (51, [1.0] * 7 + [None], 1), (52, [1.0] * 7 + [nan], 1), (53, [inf] + [1.0] * 7, 1), (54, [], 1),
           (55, [1.0] * 9, 1), (None, floats(rng, 8), 3), (3, good[3][1], 3), (3, good[3][1], 3), (-5, [-inf] * 8, 1)]
    assert got(spark, good + odd) == brute(good + odd)
    copies = [(k, [0.25] * 8, 1) for k in range(30)]  # ties everywhere
    assert got(spark, copies) == brute(copies)
    few = good[:3]
    assert got(spark, few) == brute(few)
    assert got(spark, []) == [] == got(spark, odd[:4])
    assert len(got(spark, [(None, [1.0] * 8, 1)])) == 1
