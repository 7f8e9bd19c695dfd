import base64

import pytest
import tiktoken

from gameflow.llm import tokens

TEXTS = [None, "", " ", "one", "one", "Ünï cödé 漢字 🙂", "a b  c\n\n d", "word " * 3000, "x" * 20_000, "it's 12,345!"]


@pytest.fixture(scope="module")
def rows():
    sources = ["a", None, "b", "a", "", None, "b", "a", "a", "b"]
    return [(t, s, i) for i, (t, s) in enumerate(zip(TEXTS, sources, strict=True))]


def test_against_single_documents(spark, rows):
    frame = spark.createDataFrame(rows, "text string, source string, n int")
    with open(tokens.VOCABULARY, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    lengths = [(s, len(encoding.encode_ordinary(t or ""))) for t, s, _ in rows]
    assert encoding.decode(encoding.encode_ordinary(TEXTS[5])) == TEXTS[5]
    sums = tokens.token_counts(frame)
    got = {(r.scope, r.source, r.length): tuple(r)[3:] for r in sums.collect()}
    expected = {}
    for scope, source in [("all", None), *(("source", s) for s in {s for s, _ in lengths})]:
        own = [n for s, n in lengths if scope == "all" or s == source]
        for limit in set(own):
            within = sum(n <= limit for n in own)
            expected[scope, source, limit] = (
                own.count(limit), within, len(own) - within, sum(own), sum(min(n, limit) for n in own), within / len(own))
    assert got == expected
    limits = [0, 1, 2, 5, 100, 10**6]
    cut = {(r.scope, r.source, r.limit): r.truncated for r in tokens.at_limits(sums, limits).collect()}
    for (scope, source, limit), value in cut.items():
        assert value == sum(min(n, limit) for s, n in lengths if scope == "all" or s == source)
    assert len(cut) == len(limits) * 5


def test_empty_table(spark):
    assert tokens.token_counts(spark.createDataFrame([], "text string, source string")).collect() == []


def test_very_many_blanks(spark, monkeypatch):
    with open(tokens.VOCABULARY, "rb") as file:
        encoding = tokens._encoding(file.read(), tokens.PATTERN)
    monkeypatch.setattr(tokens, "MANY_BLANKS", 50)
    monkeypatch.setattr(tokens, "_MANY", tokens.re.compile(f"(?<![{tokens.BLANK}])[{tokens.BLANK}]{{50,}}"))
    for blank in (" ", "\n", "\t", "\u3000", " \n", "\x1c"):
        run = blank * 90
        for text in (run, run + "word", "word" + run, f"one{run}two{run[:40]}three{run}", f"a {run}1{run}.", f"it's{run}'s", f"\x1c{run}\x1cx"):
            assert tokens.encoded_length(encoding, text) == len(encoding.encode_ordinary(text)), repr(text[:20])
    monkeypatch.undo()
    long = " " * 1_000_000
    rows = [(t, "a") for t in (long, "\n" * 1_000_000, long + "word", f"one{long}two", "y" * 1_000_000, "x " * 500_000)]
    got = tokens.length_histogram(spark.createDataFrame(rows, "text string, source string")).collect()
    assert sum(r.n for r in got) == len(rows)
