"""Folding, matching against plain search, and held-out accuracy on disguised words."""

import random
import zlib

import pytest

from gameflow.llm import toxicity
from gameflow.llm.toxicity import Lexicon, fold, matches

DOCS = "doc_id long, text string, score string, toxic string"
CLEAN = [f"w{a}{b}rd" for a in "aeiou" for b in "bcdfgkmnprst"]
BAD = ["grubling", "smeltor", "vaxhead"]


def fold_of(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4


def test_fold():
    assert fold("  Grúbling, SMELT0R!") == " grubiing smeitor "
    assert fold("ｇｒｕｂｌｉｎｇ ѕmеltоr v4xhe​ad") == " grubiing smeitor vaxhead "
    assert fold("sme1tor $meltor v@xhead cost$ 5 a_b") == " smeitor smeitor vaxhead cost s a b "
    assert fold(None) == fold("") == fold(" \n.") == " "


def plain(folded, lexicon):
    """The matches by looking at every word and phrase."""
    words, found, at = folded.split(), [], 0
    padded = [f" {w} " for w in words]
    for k, word in enumerate(padded):
        weight = max((w for t, w in lexicon.weights.items() if word.startswith(t)), default=0)
        pairs = {f" {' '.join(words[j:j + 2])} " for j in (k - 1, k) if 0 <= j and j + 2 <= len(words)}
        if weight and not pairs & lexicon.exceptions:
            found.append((at, weight))
        at += len(word) - 1
    return found


def test_matches_are_those_of_plain_search():
    rng = random.Random(3)
    lexicon = Lexicon({" ab": 1.0, " abba ": 3.0, " b ": 2.0, " bab": 0.5}, frozenset([" abba aa ", " b b ", " aa ab "]))
    automaton = lexicon.automaton()
    for _ in range(500):
        folded = fold(" ".join("".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(0, 12))))
        assert matches(folded, automaton) == plain(folded, lexicon)
    assert matches(" abba ", Lexicon({}).automaton()) == []


def disguised(rng, word):
    swaps = {"a": "а4@", "e": "е3", "o": "о0", "i": "1і", "l": "1ⅼ", "s": "$5ѕ"}
    return "".join(rng.choice(swaps[c]) if c in swaps and rng.random() < 0.4 else c for c in word)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    docs, labels = [], []
    for k in range(600):
        words = [rng.choice(CLEAN) for _ in range(rng.randint(30, 120))]
        toxic = k % 8 == 0
        if toxic:
            for _ in range(1 + len(words) // 25):
                words.insert(rng.randrange(len(words)), disguised(rng, rng.choice(BAD)) + rng.choice(["", ",", "!"]))
        elif k % 8 == 1:
            words[3:3] = ["vaxhead", "railway"]
        docs.append((k, " ".join(words), None, "x"))
        if k % 5:
            labels.append((k, int(toxic)))
    return docs, labels


def test_held_out_rows_are_told_apart(spark, rows):
    docs, labels = rows
    frame = spark.createDataFrame(docs, DOCS)
    got = toxicity.toxicity(frame, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert sorted(r.doc_id for r in got) == list(range(600))
    for r in got:
        assert r.held_out == (fold_of(r.doc_id) == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r for r in got if r.held_out]
    assert all(r.predicted == (r.doc_id % 8 == 0) for r in held)
    # Labels of held-out rows change nothing.
    turned = [(d, 1 - t if fold_of(d) == 2 else t) for d, t in labels]
    again = toxicity.toxicity(frame, spark.createDataFrame(turned, "doc_id long, toxic int")).collect()
    assert sorted((r.doc_id, r.score) for r in again) == sorted((r.doc_id, r.score) for r in got)


def test_exceptions_and_specific_terms_are_learned(spark, rows):
    docs, labels = rows
    lexicon = toxicity.learn(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert " vaxhead raiiway " in lexicon.exceptions
    assert {t.strip() for t in lexicon.weights} >= {"grubiing", "smeitor", "vaxhead"}
    for word in CLEAN:
        assert not matches(fold(word), lexicon.automaton())
    scored = toxicity.score_texts(spark.createDataFrame([(1, "the vaxhead railway", "", ""), (2, "VAXHЕАD", "", "")], DOCS), lexicon)
    assert {r.doc_id: r.found for r in scored.collect()} == {1: [], 2: ["vaxhead"]}


def test_odd_rows(spark, rows):
    docs, labels = rows
    odd = docs[:300] + [
        (None, "smeltor " * 20, "s", None), (1000, None, "s", None), (1001, "", None, None), (1002, " \n\t", None, None),
        (8, docs[8][1], "again", None), (8, docs[8][1], "again", None), (1003, "word " * 300_000 + "smeltor", None, None),
        (1004, "smeltor " * 100_000, None, None), (1005, "x" * 1_000_000, None, None),
    ]
    more = [*labels, *labels[:50], (None, 1), (8, None), (8, 0), (9, 1), (9, 0), (1000, 0)]
    got = toxicity.toxicity(spark.createDataFrame(odd, DOCS), spark.createDataFrame(more, "doc_id long, toxic int")).collect()
    assert len(got) == len(odd)
    scores = {}
    for r in got:
        scores.setdefault(r.doc_id, set()).add(r.score)
    assert all(len(s) == 1 for s in scores.values())  # repeated rows score alike
    assert scores[1000] == scores[1001] == scores[1002] == scores[1005]
    assert min(scores[None]) > 0.3 < min(scores[1004]) and max(scores[1003]) < 0.3
    assert {r.held_out for r in got if r.doc_id is None} == {False}


def test_without_labels_or_rows(spark, rows):
    docs = spark.createDataFrame(rows[0][:20], DOCS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.toxicity(docs.limit(0), none).collect() == []
    got = toxicity.toxicity(docs, none).collect()
    assert len(got) == 20 and {r.predicted for r in got} == {0}
    clean = spark.createDataFrame([(k, 0) for k in range(20)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity(docs, clean).collect()} == {0}
