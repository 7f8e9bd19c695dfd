import hashlib
import random

import numpy as np
import pytest

from gameflow.llm import catalog, suffixes

SCHEMA = "doc_id long, text string"


def brute(texts):
    """(n_bytes, n_removed, n_spans, sha256) of each text by counting all windows."""
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for t in raw:
        for p in range(len(t) - 399):
            seen[t[p:p + 400]] = seen.get(t[p:p + 400], 0) + 1
    result = []
    for t in raw:
        gone = bytearray(len(t))
        for p in range(len(t) - 399):
            if seen[t[p:p + 400]] > 1:
                gone[p:p + 400] = b"\1" * 400
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        result.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return result


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8))) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    base, passage = words(rng, 300), words(rng, 90)
    texts = [None, "", "short", base, base, "x" * 900, "ab" * 300, passage, words(rng, 200)]
    for _ in range(14):  # near copies: words changed here and there
        w = base.split()
        for k in rng.sample(range(len(w)), rng.randint(1, 6)):
            w[k] = "Z" * rng.randint(1, 9)
        texts.append(" ".join(w))
    for _ in range(8):  # one passage between other words, whole or cut
        cut = rng.randint(0, 60)
        texts.append(words(rng, rng.randint(0, 60)) + passage[cut:len(passage) - rng.randint(0, 60)] + words(rng, rng.randint(0, 60)))
    texts.append(passage + words(rng, 9) + passage)
    for n in (399, 400, 401):
        texts += [base[:n], "q" + base[100:100 + n] + "r"]
    return texts


@pytest.mark.parametrize(("seed", "group"), [(1, 256), (2, 3)])
def test_against_all_windows(spark, monkeypatch, seed, group):
    """Once by sorting alone, once with nearly every group split."""
    monkeypatch.setattr(suffixes, "MAX_GROUP", group)
    monkeypatch.setattr(suffixes, "SORT_ROWS", 5 if group == 3 else 3000)
    texts = corpus(seed)
    frame = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = {r[0]: tuple(r)[1:] for r in suffixes.suffix_dedup(frame).collect()}
    assert got == dict(enumerate(brute(texts)))


def test_hot_passage_and_large_groups_of_copies(spark):
    """A passage in a third of all texts, copies by the hundred, passages of 51 to 62 words, a long text."""
    rng = random.Random(17)
    hot = words(rng, 110)
    passages = [words(rng, n) for n in range(51, 63) for _ in range(2)]
    texts = [words(rng, 40) + " " + hot + " " + words(rng, 40) for _ in range(120)]
    texts += [words(rng, 150)] * 90 + [words(rng, 200)] * 2
    for p in passages:
        texts += [f"{words(rng, 30)} {p} {words(rng, 30)}" for _ in range(2)]
    texts += [words(rng, 6000) + hot[:420] + words(rng, 3000), None, ""]
    rng.shuffle(texts)
    got = {r[0]: tuple(r)[1:] for r in suffixes.suffix_dedup(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()}
    expected = brute(texts)
    assert got == dict(enumerate(expected))
    assert 200 < sum(e[1] > 0 for e in expected) < len(texts)


def test_query_returns_what_is_left(spark, tmp_path):
    """Passages of over 50 words, of 400 bytes and more and of less, in two texts each; the rest is clean."""
    rng = random.Random(29)
    passages = [words(rng, n) for n in (51, 58, 70, 90, 120) for _ in range(3)]
    texts, planted = [words(rng, rng.randint(30, 200)) for _ in range(40)] + [None, ""], {}
    for p in passages:
        for _ in range(2):
            planted[len(texts)] = p
            texts.append(f"{words(rng, 40)} {p} {words(rng, 40)}")
    spark.createDataFrame(list(enumerate(texts)), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in catalog.op6_suffix_dedup(spark, str(tmp_path)).collect()}
    assert {d: tuple(r)[1:5] for d, r in got.items()} == dict(enumerate(brute(texts)))
    sizes = {d: len(p.encode()) for d, p in planted.items()}
    assert min(sizes.values()) < 400 <= max(sizes.values())
    for d, r in got.items():
        text = texts[d] or ""
        if sizes.get(d, 0) < 398:  # a blank stands on either side of a passage, and may repeat with it
            assert (r.text, r.n_removed) == (text, 0)
        else:
            assert planted[d] not in r.text and r.n_removed >= 400
            cut = len(r.text.encode()) - (r.n_bytes - r.n_removed)  # of characters kept whole
            assert 0 <= cut <= 2
            assert cut or hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256


def test_very_long_texts(spark):
    rng = random.Random(23)
    unit = "".join(rng.choice("abcdefgh") for _ in range(1000))
    long = "".join(rng.choice("abcdefgh") for _ in range(1_000_000))
    texts = [long + unit, "\n" * 1_000_000, "x" * 399, unit + "y", "q" * 300_000 + unit[:399], None]
    got = {r[0]: tuple(r)[1:4] for r in suffixes.suffix_dedup(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).collect()}
    assert got == {0: (1_001_000, 1000, 1), 1: (1_000_000, 1_000_000, 1), 2: (399, 0, 0), 3: (1001, 1000, 1),
                   4: (300_399, 300_000, 1), 5: (0, 0, 0)}


def test_sort_is_confirmed_by_bytes(monkeypatch):
    """A hash that takes everything for equal is found out."""
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    start = rng.integers(0, 380, 60)
    length = np.minimum(rng.integers(1, 60, 60), 400 - start)
    group = np.sort(rng.integers(0, 4, 60))
    good = suffixes.Suffixes(data, start, length, group).sorted()
    raw = data.tobytes()
    expected = sorted(range(60), key=lambda i: (group[i], raw[start[i]:start[i] + length[i]], i))
    assert good[0].tolist() == expected
    monkeypatch.setattr(suffixes, "range_hashes", lambda prefix, a, b: np.zeros(len(a), np.uint64))
    bad = suffixes.Suffixes(data, start, length, group).sorted()
    assert bad[0].tolist() == expected and bad[1].tolist() == good[1].tolist()


def test_rows_with_one_id_and_other_columns(spark):
    long = "lorem ipsum " * 60
    rows = [(1, long, "a", 1), (1, long, "a", 1), (None, long + "é", None, 2), (1, "other", "b", 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, th string, spans int")
    got = sorted(((r.doc_id, r.n_removed) for r in suffixes.suffix_dedup(frame).collect()), key=str)
    assert got == [(1, 0), (1, 720), (1, 720), (None, 720)]
    texts = sorted((str(r.doc_id), r.text, r.spans) for r in suffixes.remove_repeats(frame).collect())
    assert texts == [("1", "", 1), ("1", "", 1), ("1", "other", 3), ("None", "é", 2)]


def test_characters_stay_whole(spark):
    passage = "é" * 300
    frame = spark.createDataFrame([(1, "à" + passage + "ê"), (2, "è" + passage + "ë")], SCHEMA)
    assert [r.text for r in suffixes.remove_repeats(frame).orderBy("doc_id").collect()] == ["àê", "èë"]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert suffixes.suffix_dedup(empty).collect() == [] == suffixes.remove_repeats(empty).collect()
