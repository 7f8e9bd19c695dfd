"""Toxicity of texts by a weighted lexicon, matched by Aho-Corasick in folded texts.

Folding undoes the usual disguises: letters of other scripts that look like Latin ones, accents,
full-width and mathematical letters, digits and signs that stand for letters, invisible signs.
``i``, ``l`` and ``1`` become one letter, since they pass for each other.

The lexicon is learned from labelled documents: beginnings of words and whole words that toxic
documents hold far more often. Phrases around such words that clean documents use become
exceptions. A text's score is the weight of its matches outside exceptions, normalised by its
length and turned into a probability by a logistic curve that was fitted on other labelled rows.

Only the lexicon, of a bounded size, is broadcast. Every pass over texts runs in tasks.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gameflow.llm.store import stored

#: Rows by ``crc32(doc_id as text) % FOLDS``: one part is held out, one fits the curve, the others give the lexicon.
FOLDS, HELD_OUT, CURVE = 4, 2, 3
THRESHOLD = 0.3
#: Letters of word beginnings that may become terms; whole words may have up to ``LONGEST``.
BEGINNINGS = range(4, 9)
LONGEST = 32
#: A term is in so many toxic texts at least, and in such a share of them; so many are weighed and kept at most.
LEAST_TEXTS, LEAST_SHARE = 3, 0.003
CANDIDATES, LEXICON, EXCEPTIONS = 20_000, 5_000, 1_000
#: A term in such a share of the toxic texts is strong; a weaker one must be in enough toxic texts without a strong one.
STRONG_SHARE = 0.03
#: A beginning gives way to a longer one that is in such a share of its toxic texts and weighs as much.
SAME_TEXTS = 0.9
#: Texts that a weight is drawn to the mean by, the least weight of a term, and the weight from which
#: on exceptions are sought: they may be what keeps a term from the lexicon.
SHRINK, LEAST_WEIGHT, BROAD_WEIGHT = 5.0, 2.0, 0.7
#: Clean texts with a phrase, for each toxic text with it, that make it an exception; and how many at least.
EXCEPTION_ODDS, EXCEPTION_TEXTS = 9, 3
#: Words added to a text's length, so that a very short one does not outweigh others by one match.
LENGTH_PRIOR = 20
#: Where the curve starts from and how strongly (in rows) it is drawn there.
CURVE_PRIOR, CURVE_PULL = (-4.0, 3.0), 0.5

#: Letters that look like Latin ones, and signs that stand for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "e", "и": "u", "й": "u", "к": "k", "м": "m", "н": "h", "о": "o", "п": "n", "р": "p",
    "с": "c", "т": "t", "у": "y", "х": "x", "ь": "b", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l",
    "α": "a", "β": "b", "γ": "y", "δ": "d", "ε": "e", "ζ": "z", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "π": "n",
    "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ħ": "h", "ɑ": "a", "ɡ": "g",
    "ɩ": "i", "ʟ": "l", "ɴ": "n", "ʀ": "r", "օ": "o", "ս": "u", "հ": "h", "ց": "g", "ⅼ": "l", "ᴏ": "o", "ᴀ": "a", "ᴇ": "e",
}
SIGNS = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
ONE_LETTER = {"l": "i", "j": "i"}
_LOOSE_SIGN = re.compile(r"[@$](?![^\W_])")


class _Folding(dict):
    """What each character becomes; filled as characters are met."""

    def __missing__(self, code: int) -> str:
        folded = ""
        for c in unicodedata.normalize("NFKD", chr(code)).lower():
            c = LOOKALIKES.get(c, SIGNS.get(c, c))
            c = ONE_LETTER.get(c, c)
            kind = unicodedata.category(c)
            if kind[0] in "LN":
                folded += c
            elif kind not in ("Mn", "Me", "Cf"):
                folded += " "
        self[code] = folded
        return folded


_FOLDING = _Folding()


def fold(text: str | None) -> str:
    """The folded words of a text, each between single blanks; a blank for none."""
    if not text:
        return " "
    if "$" in text or "@" in text:
        text = _LOOSE_SIGN.sub(" ", text)
    words = text.translate(_FOLDING).split()
    return f" {' '.join(words)} " if words else " "


def _terms(folded: str) -> set[str]:
    """All that could be a term in a text: beginnings of its words and whole words."""
    found: set[str] = set()
    for word in set(folded.split()):
        found.update(" " + word[:n] for n in BEGINNINGS if n <= len(word))
        if len(word) <= LONGEST:
            found.add(f" {word} ")
    return found


@dataclass(frozen=True)
class Lexicon:
    """Weights of folded terms (a leading blank marks the beginning of a word, a blank at the end its
    end), folded phrases within which terms do not count, and the curve from density to score."""

    weights: dict[str, float]
    exceptions: frozenset[str] = frozenset()
    curve: tuple[float, float] = field(default=CURVE_PRIOR)

    def automaton(self) -> ahocorasick.Automaton | None:
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), None))
        if not len(found):
            return None
        found.make_automaton()
        return found


def matches(folded: str, automaton: ahocorasick.Automaton | None) -> list[tuple[int, float]]:
    """Where words begin that hold a term outside exceptions, with the weight of the heaviest."""
    if automaton is None:
        return []
    weights: dict[int, float] = {}
    for start, weight in _outside(folded, automaton):
        if weight > weights.get(start, 0.0):
            weights[start] = weight
    return list(weights.items())


def _outside(folded: str, automaton: ahocorasick.Automaton) -> Iterator[tuple[int, object]]:
    """Start and value of what is found, ascending, without what begins inside a found phrase (value None)."""
    hits, excepted = [], []
    for last, (length, value) in automaton.iter(folded):
        if value is None:
            excepted.append((last - length + 1, last))
        else:
            hits.append((last - length + 1, value))
    hits.sort(key=lambda hit: hit[0])
    excepted.sort()
    taken, covered = 0, -1
    for start, value in hits:
        while taken < len(excepted) and excepted[taken][0] <= start:
            covered = max(covered, excepted[taken][1])
            taken += 1
        if start >= covered:
            yield start, value


def density(folded: str, found: list[tuple[int, float]]) -> float:
    """Weight per hundred words."""
    return 100.0 * sum(w for _, w in found) / (folded.count(" ") - 1 + LENGTH_PRIOR)


def score(per_hundred: float, curve: tuple[float, float]) -> float:
    return 1.0 / (1.0 + math.exp(-(curve[0] + curve[1] * math.log1p(per_hundred))))


def fold_of(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text``, ``toxic`` and ``curve`` of the labelled rows that are not held out, each text once.

    Of equal texts the one with the smallest doc_id stands for all and is toxic if one is; a doc_id
    with several labels is toxic if one is. Texts move once, and only those that are learned from.
    """
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    known = labels.where("doc_id is not null and toxic is not null").where(fold_of(F.col("doc_id")) != HELD_OUT)
    known = known.groupBy(F.col("doc_id").alias("__id")).agg(F.max(F.col("toxic").cast("int")).alias("__toxic"))
    rows = docs.where("doc_id is not null").where(fold_of(F.col("doc_id")) != HELD_OUT).select("doc_id", "text", key.alias("key"))
    marks = rows.select("doc_id", "key").join(known, F.col("doc_id") == F.col("__id"))
    marks = marks.groupBy("key").agg(F.min("doc_id").alias("__id"), F.max("__toxic").alias("toxic")).withColumnRenamed("key", "__key")
    chosen = rows.join(marks, (F.col("doc_id") == F.col("__id")) & (F.col("key") == F.col("__key")))
    return chosen.select(F.col("text").cast("string").alias("text"), "toxic", (fold_of(F.col("doc_id")) == CURVE).alias("curve"))


def _counted(texts: DataFrame, per_text) -> DataFrame:
    """``term`` and ``n``, the texts that hold it; ``per_text(folded)`` gives the terms of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0):
                held.update(per_text(fold(text.as_py())))
                if len(held) > 500_000:
                    yield _rows(held)
                    held = Counter()
        yield _rows(held)

    return texts.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def _rows(held: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], names=["term", "n"]
    )


def _collected(counts: DataFrame, most: int) -> dict[str, int]:
    """The ``most`` frequent terms."""
    return {r["term"]: r["n"] for r in counts.orderBy(F.col("n").desc(), "term").limit(most).collect()}


def _found_terms(terms: Iterable[str], exceptions: Iterable[str]):
    """Function that gives those of the terms that a folded text holds outside exceptions."""
    automaton = ahocorasick.Automaton()
    for term in terms:
        automaton.add_word(term, (len(term), term))
    for phrase in exceptions:
        automaton.add_word(phrase, (len(phrase), None))
    if not len(automaton):
        return lambda folded: set()
    automaton.make_automaton()
    return lambda folded: {term for _, term in _outside(folded, automaton)}


def _phrases(automaton: ahocorasick.Automaton):
    """Function that gives the phrases of two words around the matches of a folded text."""

    def around(folded: str) -> set[str]:
        found = set()
        for start, _ in matches(folded, automaton):
            end = folded.index(" ", start + 1)
            before = folded.rfind(" ", 0, start) if start else -1
            after = folded.find(" ", end + 1)
            if before >= 0:
                found.add(folded[before:end + 1])
            if after >= 0:
                found.add(folded[start:after + 1])
        return found

    return around


def _fit(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """The logistic curve over ``(log density, rows, toxic rows)``, drawn to ``CURVE_PRIOR``."""
    prior = np.array(CURVE_PRIOR)
    if not bins:
        return CURVE_PRIOR
    z, n, t = (np.array(c, float) for c in zip(*bins, strict=True))
    x = np.stack([np.ones_like(z), z])
    curve = prior.copy()
    for _ in range(50):  # damped Newton steps
        p = 1 / (1 + np.exp(-np.clip(curve @ x, -30, 30)))
        gradient = x @ (t - n * p) - CURVE_PULL * (curve - prior)
        step = np.linalg.solve((x * (n * p * (1 - p))) @ x.T + CURVE_PULL * np.eye(2), gradient)
        curve = curve + np.clip(step, -1, 1)
    return float(curve[0]), float(max(curve[1], 0.0))


def learn(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """A lexicon from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``; held-out rows are not looked at."""
    spark = docs.sparkSession
    known = stored(spark, labelled(docs, labels), "toxicity-labelled")
    rows = known.where("not curve")
    toxic, clean = rows.where("toxic = 1"), rows.where("toxic = 0")
    n_toxic, n_clean = toxic.count(), clean.count()
    least = max(LEAST_TEXTS, LEAST_SHARE * n_toxic)
    in_toxic = _collected(_counted(toxic, _terms).where(F.col("n") >= least), CANDIDATES)
    in_clean = _counts(_counted_in(clean, in_toxic))
    exceptions: frozenset[str] = frozenset()
    broad = {t: w for t, w in _weights(in_toxic, in_clean, n_toxic, n_clean).items() if w >= BROAD_WEIGHT}
    if broad:
        exceptions = _exceptions(toxic, clean, Lexicon(broad))
    if exceptions:  # what stands in them no longer tells against a term
        in_toxic, in_clean = (_counts(_counted_in(texts, broad, exceptions)) for texts in (toxic, clean))
    weights = {t: w for t, w in _weights(in_toxic, in_clean, n_toxic, n_clean).items() if w >= LEAST_WEIGHT and in_toxic[t] >= least}
    weights = _specific(weights, in_toxic)
    strong = [t for t in weights if in_toxic[t] >= STRONG_SHARE * n_toxic]
    if len(strong) < len(weights):
        alone = _counts(_counted_in(toxic, weights, exceptions, strong))
        weights = {t: w for t, w in weights.items() if in_toxic[t] >= STRONG_SHARE * n_toxic or alone.get(t, 0) >= least}
    kept = sorted(weights, key=lambda t: (-weights[t] * in_toxic[t], t))[:LEXICON]
    lexicon = Lexicon({t: weights[t] for t in kept}, exceptions)
    scored = _measured(known.where("curve"), lexicon, "toxic", "toxic int").where("toxic is not null")
    bins = scored.groupBy(F.round(F.log1p("per_hundred"), 2).alias("z")).agg(F.count("*").alias("n"), F.sum("toxic").alias("t"))
    return Lexicon(lexicon.weights, lexicon.exceptions, _fit([(r["z"], r["n"], r["t"]) for r in bins.collect()]))


def _specific(weights: dict[str, float], texts: dict[str, int]) -> dict[str, float]:
    """The terms without those that say no more than another one: beginnings of a longer beginning
    that is in nearly the same texts, and whole words whose beginning weighs as much."""
    drop = set()
    for term, weight in weights.items():
        shorter = term[:-1]
        if term.endswith(" "):
            longest = shorter[:1 + BEGINNINGS[-1]]
            if weights.get(longest, 0.0) >= weight - 0.1:
                drop.add(term)
        elif shorter in weights and texts[term] >= SAME_TEXTS * texts[shorter] and weight >= weights[shorter] - 0.1:
            drop.add(shorter)
    return {t: w for t, w in weights.items() if t not in drop}


def _weights(in_toxic: dict[str, int], in_clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Log odds of a text with the term being toxic, against those of any text."""
    if not n_toxic or not n_clean:
        return {}
    base = n_toxic / (n_toxic + n_clean)
    shares = {term: (t + SHRINK * base) / (t + in_clean.get(term, 0) + SHRINK) for term, t in in_toxic.items()}
    return {term: math.log(s / (1 - s)) - math.log(base / (1 - base)) for term, s in shares.items()}


def _counts(counted: DataFrame) -> dict[str, int]:
    """All counts; there are as many as terms that were sought."""
    return {r["term"]: r["n"] for r in counted.collect()}


def _counted_in(
    texts: DataFrame, terms: Iterable[str], exceptions: Iterable[str] = (), without: Iterable[str] = ()
) -> DataFrame:
    """In how many texts each of the terms is found outside exceptions, of those in which none of ``without`` is."""
    shared = texts.sparkSession.sparkContext.broadcast((list(terms), list(exceptions), frozenset(without)))
    kept = []

    def per_text(folded: str):
        terms, exceptions, without = shared.value
        if not kept:
            kept.append(_found_terms(terms, exceptions))
        found = kept[0](folded)
        return () if without and without & found else found

    return _counted(texts, per_text)


def _exceptions(toxic: DataFrame, clean: DataFrame, lexicon: Lexicon) -> frozenset[str]:
    """Phrases of two words with a term that clean texts hold far more often than toxic ones."""
    shared = clean.sparkSession.sparkContext.broadcast(lexicon)
    kept = []

    def per_text(folded: str):
        if not kept:
            kept.append(_phrases(shared.value.automaton()))
        return kept[0](folded)

    in_clean = _collected(_counted(clean, per_text).where(F.col("n") >= EXCEPTION_TEXTS), 10 * EXCEPTIONS)
    in_toxic = _counts(_counted(toxic, per_text).where(F.col("term").isin(list(in_clean)))) if in_clean else {}
    good = [p for p, n in in_clean.items() if n >= EXCEPTION_ODDS * in_toxic.get(p, 0)]
    return frozenset(sorted(good, key=lambda p: (-in_clean[p], p))[:EXCEPTIONS])


def _measured(rows: DataFrame, lexicon: Lexicon, keep: str, schema: str) -> DataFrame:
    """The column ``keep`` of ``rows``, ``per_hundred`` (weight per hundred words) and ``found``, the words with a term."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value.automaton()
        for batch in batches:
            values, words = [], []
            for text in batch.column(1):
                folded = fold(text.as_py())
                found = matches(folded, automaton)
                values.append(density(folded, found))
                words.append([folded[s + 1:folded.index(" ", s + 1)] for s, _ in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, pa.float64()), pa.array(words, pa.list_(pa.string()))], names=[keep, "per_hundred", "found"]
            )

    rows = rows.select(keep, F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"{schema}, per_hundred double, found array<string>")


def score_texts(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id``, ``score`` from 0 to 1, ``found`` (folded words that
    hold a term). Null and empty texts have no words and get the score of a text without matches."""
    measured = _measured(docs, lexicon, "doc_id", f"doc_id {dict(docs.dtypes)['doc_id']}")
    a, b = lexicon.curve
    return measured.select("doc_id", (1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.log1p("per_hundred"))))).alias("score"), "found")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id``, ``held_out``, ``score``, ``predicted``, ``found``.

    Learned from ``labels(doc_id, toxic)`` outside the held-out part; without usable labels all
    scores are that of the curve's prior. A null doc_id is scored, is not held out and is never
    learned from; repeated rows are scored each and learned from once; an empty table gives an empty
    result; other columns are not used.
    """
    scored = score_texts(docs, learn(docs, labels))
    held_out = F.coalesce(fold_of(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "found"
    )
