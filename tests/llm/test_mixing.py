"""Targets against resharing step by step, and what is taken against the targets."""

from fractions import Fraction

import pytest

from gameflow.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def reshared(sizes):
    """The target of each source, as exact fractions; null comes last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[k % len(mixing.WEIGHTS)] for k, s in enumerate(names)}
    full: set = set()
    while True:
        left = Fraction(3, 2) * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        rest = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = {s for s in rest if share[s] > 2 * sizes[s]}
        if not above:
            return {s: share.get(s, Fraction(2 * sizes[s])) for s in names}
        full |= above


def checked(rows):
    """Holds a result against its contract; every source comes within 2 % or a block of its target."""
    sizes, taken, target = {}, {}, {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert {r.source: r.source_size for r in rows} == sizes
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    due = reshared(sizes)
    for s in sizes:
        assert target[s] >= 0
        assert target[s] == pytest.approx(float(due[s]))
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s], 1), s
    return target, taken


@pytest.mark.parametrize("words", [
    {f"s{k:02}": 1000 + 37 * (k * k % 20) for k in range(20)},
    {f"s{k:02}": 100 for k in range(4)},
    {f"s{k:02}": 500 for k in range(20)},
    {f"s{k:02}": 3 ** (k % 8) for k in range(20)} | {None: 7000},
    {"a": 1, "b": 100_000, "c": 1, "d": 50, None: 0},
], ids=["twenty", "equal", "twenty equal", "uneven", "one large"])
def test_targets_and_what_is_taken(spark, words):
    rows = []
    for s, n in words.items():
        for part in (n // 3, n - n // 3):
            rows.append((len(rows), "w " * part, s))
    checked(mixing.mix_sources(spark.createDataFrame(rows, SCHEMA)).collect())


def test_equal_sources_with_all_weights(spark):
    rows = [(k, "w " * 100, f"s{k}") for k in range(4)]
    target, _ = checked(mixing.mix_sources(spark.createDataFrame(rows, SCHEMA)).collect())
    assert target == {"s0": 200.0, "s1": pytest.approx(200 / 3), "s2": pytest.approx(400 / 3), "s3": 200.0}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_given_tables(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    checked(mixing.mix_sources(docs).collect())


def test_no_words_at_all(spark):
    rows = [(1, None, "a"), (2, "", None), (2, "", None), (None, " \n ", "a")]
    got = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.size, r.target, r.taken) for r in got) == [(0, 0, 0.0, 0), (1, 0, 0.0, 0), (2, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_long_text_and_clashing_columns(spark):
    rows = [(1, "w " * 300_000, "a", 5, "x"), (2, "v " * 30, "b", 6, "y"), (3, "u", None, 7, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, target string")
    checked(mixing.mix_sources(frame).collect())
