"""The pipeline against the same five stages by brute force, on a small fixture."""

import random

import pytest

import corpus_pipeline
from gameflow.llm import mixing, quality, suffixes
from tests.llm import test_decontam, test_simhash, test_suffixes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(8)
    items = [(k, words(rng, 30)) for k in range(4)]
    passage = words(rng, 90)
    texts = [words(rng, rng.randint(60, 200)) for _ in range(30)]
    texts += [texts[0], texts[1] + " x", texts[2].upper()]  # copies
    texts += [words(rng, 60) + " " + passage + " " + words(rng, 60) for _ in range(3)]  # repeated strings
    texts += [words(rng, 40) + " " + items[k][1] + " " + words(rng, 40) for k in range(3)]  # leaks
    texts += ["short", None, "", "again and again " * 60, "# $ % & " * 40 + words(rng, 60)]  # rejects
    docs = [(k, t, ["en", "de", None][k % 3], ["s0", "s1", "s2", None][k % 4], len(t or "")) for k, t in enumerate(texts)]
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), docs, items


def test_stages(spark, tables):
    folder, docs, items = tables
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]

    kept = stages[0](spark, frame, folder)
    verdict = {r.doc_id for r in quality.quality_rules(frame).where("kept").collect()}
    rows = sorted(map(tuple, kept.collect()))
    assert rows == [d for d in docs if d[0] in verdict]
    assert set(range(39)) == verdict  # all that is clean, nothing of the rest

    single = stages[1](spark, kept, folder)
    prints = [test_simhash.brute_fingerprint(r[1]) for r in rows]
    firsts = {rows[c][0] for c in test_simhash.brute_components(prints)}
    rows = [r for r in rows if r[0] in firsts]
    assert sorted(map(tuple, single.collect())) == rows
    assert not {30, 31, 32} & firsts

    cleaned = stages[2](spark, single, folder)
    sizes = [b - g for b, g, *_ in test_suffixes.brute([r[1] for r in rows])]
    got = sorted(map(tuple, cleaned.collect()))
    assert [len(r[1]) for r in got] == sizes == [r[4] for r in got]
    assert [r[:1] + r[2:4] for r in got] == [r[:1] + r[2:4] for r in rows]
    assert sum(len(r[1]) < len(w[1]) for r, w in zip(got, rows, strict=True)) == 3

    clean = stages[3](spark, cleaned, folder)
    bad = {d for (d, _), (*_, leaked) in test_decontam.brute(got, items).items() if leaked}
    assert bad == {36, 37, 38}
    got = [r for r in got if r[0] not in bad]
    assert sorted(map(tuple, clean.collect())) == got

    mixed = sorted(map(tuple, stages[4](spark, clean, folder).select("doc_id", "source", "size").collect()))
    assert mixed == [(r[0], r[3], len(r[1].split())) for r in got]
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(whole.collect()) == sorted(stages[4](spark, clean, folder).collect())


def test_mix_is_near_its_targets(spark):
    rows = [(k, "w " * (k % 700), ["a", "b", "c", None][k * k % 4 if k % 5 else 2]) for k in range(600)]
    rows += [(600, None, "a"), (601, "", None), (5, rows[5][1], rows[5][2]), (602, "w " * 40_000, "b")]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == len(rows)
    sizes, taken, targets = {}, {}, {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        targets[r.source] = r.target
    assert {r.source: r.source_size for r in got} == sizes
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
    level, weights = None, dict(zip(["a", "b", "c", None], [3, 1, 2, 3], strict=True))
    capped: set = set()
    while True:  # reshare until none is above
        free = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        level = free / sum(w for s, w in weights.items() if s not in capped)
        above = {s for s, w in weights.items() if s not in capped and level * w > 2 * sizes[s]}
        if not above:
            break
        capped |= above
    for s, w in weights.items():
        assert targets[s] == pytest.approx(2 * sizes[s] if s in capped else level * w)
        assert abs(taken[s] - targets[s]) <= 0.02 * targets[s]
    again = mixing.mix_sources(spark.createDataFrame(rows[::-1], "doc_id long, text string, source string")).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_stage_serves_small_sources(spark):
    small = {f"t{n:04}": n for n in (1, 7, 40, 41, 90, 255, 256, 257, 260, 300, 520, 777, 1000)}
    rows = [(k, "w " * 500, "a" if k % 2 else "b") for k in range(200)]
    for s, n in small.items():
        rows += [(len(rows), "w " * (n // 3), s), (len(rows) + 1, "w " * (n - n // 3), s)]
    got = corpus_pipeline.mixing_stage(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), "").collect()
    taken, target = {}, {r.source: r.target for r in got}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in target:
        assert abs(taken[s] - target[s]) <= 0.02 * target[s], s
    assert all(target[s] == taken[s] == 2 * n for s, n in small.items())


def test_quality_of_odd_rows(spark):
    rows = [(1, None, None, None, "x"), (2, "", "en", None, "x"), (3, "a b " * 40, None, "s", "x"), (3, "a b " * 40, None, "s", "x"),
            (None, " ".join(f"w{k}" for k in range(80)), "en", "s", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string")
    got = {r.doc_id: r for r in quality.quality_rules(frame).collect()}
    assert (got[1].n_words, got[1].base_failed, got[1].kept) == (0, True, False)
    assert (got[3].n_words, got[3].n_repeat_words, got[3].base_failed) == (80, 80, True)
    assert got[None].kept and not got[None].base_failed
    assert [r.kept for r in quality.keep_good(frame).collect()] == ["x"]
    assert quality.quality_rules(frame.limit(0)).collect() == [] == quality.keep_good(frame.limit(0)).collect()
    assert mixing.mix_sources(frame.limit(0)).collect() == []


def test_suffix_length_column_is_optional(spark):
    frame = spark.createDataFrame([(1, "ab", 7)], "doc_id long, text string, n_chars int")
    assert suffixes.remove_repeats(frame).collect()[0].n_chars == 7


def test_repeat_stage_takes_passages_of_51_words(spark):
    rng = random.Random(13)
    passages = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(n)) for n in (51, 51, 50, 58)]
    rows = [(2 * k + j, f"{words(rng, 70)}{sep}{p}{sep}{words(rng, j * 30)}") for k, p in enumerate(passages) for j, sep in enumerate((" ", "\n"))]
    rows += [(8, "é " + " ".join(passages[0].split()[:50]) + " other"), (9, None), (10, passages[3].replace(" ", "  "))]
    rows = [(d, t, "en", "s", len(t or "")) for d, t in rows]
    got = {r.doc_id: r for r in corpus_pipeline.repeat_stage(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert len(got) == len(rows)
    for d, text, *_ in rows:
        p = passages[d // 2] if d < 8 and d // 2 != 2 else None
        left = text.replace(p, "") if p else text
        assert (got[d].text or "") == ("" if d == 10 else left or ""), d
        assert d == 9 or got[d].n_chars == len(got[d].text)
