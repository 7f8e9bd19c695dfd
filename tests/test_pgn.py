import random

import pytest
import zstandard
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gameflow.functions import pgn
from gameflow.operators.numbering import number_and_count, number_games
from gameflow.plans.ingest import first_games_of, games_between, numbered_games
from gameflow.schema import ROSTER_DEFAULTS
from gameflow.sources.pgn import files_between, read_corpus, read_games, read_records


def game(white, moves="1. e4 e5 1-0", **tags):
    lines = ['[Event "x"]', f'[White "{white}"]', *[f'[{k} "{v}"]' for k, v in tags.items()]]
    return "\n".join(lines) + f"\n\n{moves}\n\n"


def rows(frame):
    return {r["White"]: r for r in frame.collect()}


EDGE = (
    game("full", "1. e4 { [%clk 0:03:00] } e5 2. Nf3! Nc6?! 1-0", Date="2024.09.01", UTCTime="00:00:07", Variant="Chess960")
    + game("repeated", White="repeated-last")
    + game("empty", Round="")
    + game(r"quote \"q\" back\\slash")
    + game("nomoves", "*")
    + "\n\n"
    + game("variations", "1. e4 (1. d4 (1. c4 {deep ) note} (1. b4)) d5) 1... e5 ( 1... c5 ) $2 2. f4 ; rest ( of line\nexf4 1/2-1/2")
    + game("tight", "1.e4 e5 2.Nf3$1 Nc6!? 3.O-O-O 0-1")
    + game("tagcomment", 'e4 { see\n[White "inner"] } e5 *')
    + game("stray", "1. e4 ) e5 1-0")
    + game("unclosed", "1. e4 e5 { never ends")
    + game("percent", "1. e4\n%escape d4\ne5 0-0 1-0")
    + game("line\u2028sep", "1. e4 *")
    + game("rare", "1.e4 -- 2.0-0-0+ ( 2. 0-0 ) 2... O-O 3. 0-0! bxa8=Q# @e4 12. e8=Q+?? $6 0-1")
    + game("words", "1. e4 e.p. 1... exd6 e.p.+ resigns 2. Z0 0000 3. e7e8q Nbd2 R1xa3 N@f3 Qh4e1 12e5 e2-e4 1-0 w0 e9")
)
for blanks in (0, 1, 8, 9, 40):
    EDGE += game("plain", "1. e4 *").replace("[White \"plain", " " * blanks + f'[White "indent{blanks}')
MOVES = {
    "full": "e4 e5 Nf3 Nc6", "repeated-last": "e4 e5", "empty": "e4 e5", 'quote "q" back\\slash': "e4 e5",
    "nomoves": "", "variations": "e4 e5 f4 exf4", "tight": "e4 e5 Nf3 Nc6 O-O-O", "tagcomment": "e4 e5",
    "stray": "e4 e5", "unclosed": "e4 e5", "percent": "e4 e5 0-0", "line\u2028sep": "e4",
    "rare": "e4 -- 0-0-0+ O-O 0-0 bxa8=Q# @e4 e8=Q+",
    "words": "e4 exd6 Z0 0000 e7e8q Nbd2 R1xa3 N@f3 Qh4e1 e5 e2-e4",
    **{f"indent{blanks}": "e4" for blanks in (0, 1, 8, 9, 40)},
}


@pytest.mark.parametrize("crlf", [False, True])
def test_edge_records(spark, tmp_path, crlf):
    text = "\ufeff" + EDGE
    (tmp_path / "a.pgn").write_bytes((text.replace("\n", "\r\n") if crlf else text).encode())
    (tmp_path / "b.pgn").write_text("")
    (tmp_path / "c.pgn").write_text("; notes before the first game\n\n" + game("second file"))
    got = rows(read_games(spark, str(tmp_path)))
    assert {w: " ".join(r["Moves"]) for w, r in got.items()} == MOVES | {"second file": "e4 e5"}
    full = got["full"]
    assert (full["Date"], full["Time"], full["Variant"], full["Round"]) == ("2024.09.01", "00:00:07", "Chess960", "")


def test_record_is_made_once(spark, tmp_path):
    """The check of a record does not make its text again for every mention of it."""
    (tmp_path / "a.pgn").write_text(game("a") + game("b"))
    for opening in ("Event", None):
        records = read_records(spark, str(tmp_path), opening)
        for frame in (records, records.groupBy("source_path").count()):
            plan = frame._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("regexp_instr(") == plan.count("replace(value") == 1
        assert records.count() == 2


def test_roster_defaults(spark, tmp_path):
    (tmp_path / "a.pgn").write_text(game("w"))
    row = read_games(spark, str(tmp_path), ROSTER_DEFAULTS).first()
    assert (row["Date"], row["Round"], row["Result"], row["Variant"]) == ("????.??.??", "?", "*", "")


def nested_main_line(text):
    """Character by character: keep what is outside parentheses."""
    depth, kept = 0, []
    for char in text:
        if char == "(":
            depth += 1
        elif char == ")":
            depth = max(depth - 1, 0)
        elif depth == 0:
            kept.append(char)
        if char in "()":
            kept.append(" ")
    return [w for w in "".join(kept).split() if w]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["(", ")", " e4 ", " Nf3 ", " "]), max_size=40), min_size=1, max_size=8))
def test_variations_match_brute_force(spark, texts):
    texts = ["".join(t) for t in texts]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    want = {i: nested_main_line(t) for i, t in enumerate(texts)}
    for text in (F.col("t"), pgn.without_shallow_variations(F.col("t"))):
        assert dict(frame.select("i", pgn.main_moves(pgn.main_text(text))).collect()) == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sizes=st.lists(st.integers(0, 25), min_size=1, max_size=4), seed=st.integers(0, 999))
def test_numbers_follow_file_order(spark, small_splits, tmp_path_factory, sizes, seed):
    folder, rng, names = tmp_path_factory.mktemp("order"), random.Random(seed), []
    for f, size in enumerate(sizes):
        mine = [f"f{f}g{g}" for g in range(size)]
        text = "".join(game(n, " ".join(["e4"] * rng.randint(0, 120)) + " *") for n in mine)
        (folder / f"part-{f}.pgn").write_text(text)
        names += mine
    numbered, total = number_and_count(read_games(spark, str(folder)))
    got = {r["White"]: r["GameID"] for r in numbered.select("White", "GameID").collect()}
    assert got == {name: i + 1 for i, name in enumerate(names)}
    assert total == len(names)


def test_numbers_per_file(spark, small_splits, tmp_path):
    for f in "ab":
        (tmp_path / f"{f}.pgn").write_text("".join(game(f"{f}{g}") for g in range(9)))
    got = {r["White"]: r["GameID"] for r in number_games(read_games(spark, str(tmp_path)), scope="file").collect()}
    assert got == {f"{f}{g}": g + 1 for f in "ab" for g in range(9)}


def test_numbers_survive_union_and_coalesce(spark, small_splits, tmp_path):
    (tmp_path / "a.pgn").write_text("".join(game(f"w{g}") for g in range(40)))
    numbered = number_games(read_games(spark, str(tmp_path))).select("White", "GameID")
    got = numbered.unionAll(numbered.coalesce(2)).collect()
    assert sorted(map(tuple, got)) == sorted([(f"w{g}", g + 1) for g in range(40)] * 2)


def test_changed_split_layout_is_refused(spark, small_splits, tmp_path):
    (tmp_path / "a.pgn").write_text("".join(game(f"w{g}") for g in range(40)))
    numbered = number_games(read_games(spark, str(tmp_path)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    with pytest.raises(Exception, match="split layout changed"):
        numbered.write.format("noop").mode("overwrite").save()


def test_shuffled_join_above_the_broadcast_limit(spark, small_splits, tmp_path, monkeypatch):
    monkeypatch.setattr("gameflow.operators.numbering.MAX_BROADCAST_SPLITS", 0)
    (tmp_path / "a.pgn").write_text("".join(game(f"w{g}") for g in range(40)))
    got = {r["White"]: r["GameID"] for r in number_games(read_games(spark, str(tmp_path))).collect()}
    assert got == {f"w{g}": g + 1 for g in range(40)}


def test_first_games_leave_later_files_unread(spark, tmp_path):
    for f in range(8):
        (tmp_path / f"{f}.pgn").write_text("".join(game(f"{f}-{g}") for g in range(10)))
    def names(start, end):
        files, before = files_between(spark, str(tmp_path), start, end)
        return [p[-5] for p in files], before

    assert names(0, 10) == (["0"], 0)
    assert names(0, 25) == (["0", "1", "2"], 0)
    assert names(0, 1000) == (list("01234567"), 0)
    assert names(30, 40) == (["3"], 30)
    assert names(39, 41) == (["3", "4"], 30)
    assert names(500, 600) == (["0"], 0)
    first = first_games_of(spark, str(tmp_path), 25)
    assert sorted(r["White"] for r in first.collect()) == sorted(f"{g // 10}-{g % 10}" for g in range(25))
    assert first_games_of(spark, str(tmp_path), 0).count() == 0
    cut = games_between(spark, str(tmp_path), 15, 22)
    assert sorted((r["GameID"], r["White"]) for r in cut.collect()) == [(g + 1, f"{g // 10}-{g % 10}") for g in range(15, 22)]
    assert sorted(p[-5] for p in cut.inputFiles() if p.endswith(".pgn")) == ["1", "2"]
    assert games_between(spark, str(tmp_path), 500, 600).count() == 0


def test_corpus_reads_archives_and_picks_periods(spark, tmp_path):
    packed = zstandard.ZstdCompressor().compress(game("packed").encode() * 3)
    (tmp_path / "games_2024-08.pgn.zst").write_bytes(packed)
    (tmp_path / "games_2024-09.pgn").write_text(game("plain"))
    everything = read_corpus(spark, str(tmp_path))
    assert sorted((r["period"], r["White"]) for r in everything.collect()) == [("2024-08", "packed")] * 3 + [("2024-09", "plain")]
    picked = read_corpus(spark, str(tmp_path), periods=["2024-09"])
    assert [r["White"] for r in picked.collect()] == ["plain"]
    # The other archive is not opened at all: destroying it changes nothing.
    (tmp_path / "games_2024-08.pgn.zst").write_bytes(b"not an archive")
    assert read_corpus(spark, str(tmp_path), periods=["2024-09"]).count() == 1


def test_archives_are_numbered_and_spread(spark, tmp_path):
    text = "".join(game(f"w{g}", "1. e4 ( 1. d4 ) e5 *") for g in range(50))
    (tmp_path / "a.pgn.zst").write_bytes(zstandard.ZstdCompressor().compress(text.encode()))
    (tmp_path / "b.pgn").write_text(game("last"))
    games, total = numbered_games(spark, str(tmp_path))
    assert {r["White"]: r["GameID"] for r in games.collect()} == {f"w{g}": g + 1 for g in range(50)} | {"last": 51}
    assert total == 51
    assert "rebalance" in games._jdf.queryExecution().toString().lower()
    plain, _ = numbered_games(spark, str(tmp_path / "b.pgn"))
    assert "rebalance" not in plain._jdf.queryExecution().toString().lower()


def test_archives_are_spread_in_every_reader(spark, tmp_path):
    (tmp_path / "games_2024-08.pgn.zst").write_bytes(zstandard.ZstdCompressor().compress(game("packed").encode() * 40))
    (tmp_path / "games_2024-09.pgn").write_text(game("plain") * 30)
    corpus = read_corpus(spark, str(tmp_path))
    plan = corpus._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RebalancePartitions") == 1 and plan.count("Union") == 1
    assert "RebalancePartitions" in plan.split("Union")[1].split("\n", 2)[2]  # in one branch
    assert corpus.groupBy("period").count().orderBy("period").collect() == [("2024-08", 40), ("2024-09", 30)]


ANY_ORDER = [
    f'[White "w{k}"]\n[Event "x"]\n\n1. e4 {{ a\n[Event "in"] }} e5 *\n' if k % 2
    else f'[Result "*"]\n[White "w{k}"]\n\n1. e4\ne5 *\n' for k in range(40)
]


def test_games_that_open_with_any_tag(spark, small_splits, tmp_path):
    (tmp_path / "a.pgn").write_text("; notes\n\n" + "\n".join(ANY_ORDER))
    (tmp_path / "b.pgn").write_text("\n\n".join(ANY_ORDER[:3]).replace("w", "v"))
    got = read_games(spark, str(tmp_path), opening=None).collect()
    assert sorted((r["White"], " ".join(r["Moves"])) for r in got) == sorted(
        [(f"w{k}", "e4 e5") for k in range(40)] + [(f"v{k}", "e4 e5") for k in range(3)])
    games, total = numbered_games(spark, str(tmp_path), opening=None)
    assert total == 43
    assert {r["White"]: r["GameID"] for r in games.collect()} == {f"w{k}": k + 1 for k in range(40)} | {f"v{k}": k + 41 for k in range(3)}
    (tmp_path / "a.pgn").unlink()
    (tmp_path / "b.pgn").write_bytes("\n".join(ANY_ORDER).replace("\n", "\r\n").encode())
    assert read_games(spark, str(tmp_path), opening=None, newline="\r\n").count() == 40


@pytest.mark.parametrize("text", [
    "".join(f'[White "w{k}"]\n\n1. e4 *\n\n' for k in range(5)),  # no Event at all
    "".join(f'[White "w{k}"]\n[Event "x"]\n\n1. e4 *\n\n' for k in range(5)),  # Event not first
    '[Event "x"]\n[White "w"]\n\n1. e4 { see\n[Event "inner"]\n} e5 *\n',  # a comment cut in two
])
def test_wrong_boundaries_stop_with_an_error(spark, tmp_path, text):
    (tmp_path / "a.pgn").write_text(text)
    with pytest.raises(Exception, match="not one game per record"):
        read_games(spark, str(tmp_path)).collect()


def test_merged_games_stop_every_reader(spark, tmp_path):
    text = "".join(f'[White "w{g}"]\n\n1. e4 *\n\n' for g in range(5))
    for name in "abc":
        (tmp_path / f"{name}.pgn").write_text(text)
    path = str(tmp_path)
    for use in (
        lambda: read_games(spark, path).count(),
        lambda: first_games_of(spark, path, 7).select("GameID").collect(),
        lambda: numbered_games(spark, path)[0].select("GameID").collect(),
    ):
        with pytest.raises(Exception, match="not one game per record"):
            use()
    assert read_games(spark, path, opening=None).count() == 15
    assert [r["GameID"] for r in first_games_of(spark, path, 7, opening=None).select("GameID").orderBy("GameID").collect()] == list(range(1, 8))
    got = games_between(spark, path, 4, 9, opening=None).orderBy("GameID").select("GameID", "White").collect()
    assert [tuple(r) for r in got] == [(5, "w4"), (6, "w0"), (7, "w1"), (8, "w2"), (9, "w3")]
