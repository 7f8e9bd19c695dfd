import math
import random
import zlib
from collections import Counter

import pytest

from gameflow.llm import katz

SCHEMA = "doc_id long, text string, score string, n int"


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()
    return [*lowered.split(), None]


def held_out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 10 == 0


class Model:
    """The same model by plain counting."""

    def __init__(self, rows):
        train = [tokens(t) for d, t, *_ in rows if not held_out(d)]
        self.word = Counter(w for t in train for w in t)
        self.pair = Counter(p for t in train for p in zip(["<s>", *t], t, strict=False))
        self.history = Counter(h for t in train for h in ["<s>", *t[:-1]])
        self.n = sum(self.word.values())
        self.d1, self.d2 = (self.discount(c) for c in (self.word, self.pair))
        self.rest = 1 - sum(self.d1(c) for c in self.word.values()) / self.n if self.n else 1.0
        self.after = {}
        for h, w in self.pair:
            self.after.setdefault(h, []).append(w)

    @staticmethod
    def discount(counter):
        n = Counter(counter.values())
        half = lambda c: c - 0.5
        if not all(n[r] for r in range(1, 7)):
            return half
        cut = 6 * n[6] / n[1]
        d = {r: ((r + 1) * n[r + 1] / (n[r] * r) - cut) / (1 - cut) if cut < 1 else 0 for r in range(1, 6)}
        return (lambda c: c - 0.01 if c > 5 else c * d[c]) if all(0 < x < 1 for x in d.values()) else half

    def p1(self, w):
        return self.d1(self.word[w]) / self.n if self.word[w] else self.rest

    def weight(self, h):
        if not self.history[h]:
            return 1.0
        seen = self.after[h]
        return (1 - sum(self.d2(self.pair[h, w]) for w in seen) / self.history[h]) / (1 - sum(self.p1(w) for w in seen))

    def p(self, h, w):
        return self.d2(self.pair[h, w]) / self.history[h] if self.pair[h, w] else self.weight(h) * self.p1(w)

    def row(self, doc, text):
        t = tokens(text)
        v = len(self.word)
        base = sum(math.log10((self.word[w] + 0.1) / (self.n + 0.1 * (v + 1))) for w in t)
        score = sum(math.log10(self.p(h, w)) for h, w in zip(["<s>", *t], t, strict=False))
        return held_out(doc), len(t), sum(self.word[w] > 0 for w in t), self.n, base, score


def corpus(seed, docs, vocabulary):
    rng = random.Random(seed)
    words = [f"W{k}" if k % 3 else f"é{k}" for k in range(vocabulary)]
    text = lambda: " ".join(words[min(int(rng.paretovariate(0.7)) - 1, vocabulary - 1)] for _ in range(rng.randint(0, 80)))
    rows = [(i, text() + rng.choice(["", "\n", "\tx"]), "s", 1) for i in range(docs)]
    return rows + [(docs, None, "s", 1), (docs + 1, "", "s", 1), (None, "w1 W2", "s", 1), rows[3], rows[3], (10**9, "w1 " * 5000, None, None)]


@pytest.mark.parametrize(("docs", "vocabulary", "turing"), [(300, 3000, True), (12, 20, False)])
def test_against_plain_counting(spark, monkeypatch, docs, vocabulary, turing):
    monkeypatch.setattr(katz, "BATCH_BYTES", 2000)
    rows = corpus(1, docs, vocabulary)
    model = Model(rows)
    if turing:
        for h in ["<s>", b"w1", b"w2", *list(model.after)[:20]]:  # probabilities add up to one
            total = sum(model.p(h, w) for w in model.word) + model.p(h, "never seen")
            assert total == pytest.approx(1)
    frame = spark.createDataFrame(rows, SCHEMA)
    got = katz.score_texts(frame).collect()
    assert len(got) == len(rows)
    expected = {d: model.row(d, t) for d, t, *_ in rows}
    for r in got:
        assert tuple(r)[1:5] == expected[r.doc_id][:4]
        assert (r.base_score, r.score) == pytest.approx(expected[r.doc_id][4:])
    if turing:
        held = [r for r in got if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_no_training_rows(spark):
    doc = next(i for i in range(100) if held_out(i))
    got = katz.score_texts(spark.createDataFrame([(doc, "a b", "", 0)], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(doc, True, 3, 0, 0, 0.0, 0.0)]


def test_empty_table(spark):
    assert katz.score_texts(spark.createDataFrame([], SCHEMA)).collect() == []


def test_hashing_packs_exactly():
    import numpy as np

    values = np.sort(np.random.default_rng(0).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    assert (katz._unpack_sorted(katz._pack_sorted(values)) == values).all()
    assert (katz._unpack(katz._pack(values.astype(float)), float) == values.astype(float)).all()
    bound = katz._parts(values, 7)
    assert bound[0] == 0 and bound[-1] == 1000 and (np.diff(bound) > 80).all()
