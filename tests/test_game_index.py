import os

import pytest

from gameflow.operators import numbering
from gameflow.plans.ingest import first_games_of, games_between, numbered_games
from gameflow.sources import pgn
from tests.test_archives import dumps
from tests.test_pgn import game


@pytest.fixture
def opened(monkeypatch):
    """Names of the files that counting jobs open."""
    names, whole = [], pgn.read_records

    def noted(spark, paths, *rest):
        names.extend(os.path.basename(p) for p in ([paths] if isinstance(paths, str) else paths))
        return whole(spark, paths, *rest)

    monkeypatch.setattr(pgn, "read_records", noted)
    return names


def whites(frame):
    return [(r["GameID"], r["White"]) for r in frame.orderBy("GameID").collect()]


def test_counts_are_kept_and_checked(spark, tmp_path, opened):
    files, index = tmp_path / "files", str(tmp_path / "index")
    os.makedirs(files)
    for f in range(6):
        (files / f"{f}.pgn").write_text("".join(game(f"{f}-{g}") for g in range(f + 1)))
    expected = [(1 + k, name) for k, name in enumerate(f"{f}-{g}" for f in range(6) for g in range(f + 1))]

    def between(start, end):
        opened.clear()
        found = pgn.files_between(spark, str(files), start, end, index=index)
        return found, sorted(opened)

    first, counted = between(4, 9)
    assert counted == [f"{f}.pgn" for f in range(6)]
    assert between(4, 9) == (first, [])  # nothing is counted a second time
    assert between(0, 100)[1] == []
    assert whites(games_between(spark, str(files), 4, 9, index=index)) == expected[4:9]
    # A file of another length, a file of another time, a new file and a file that is gone.
    (files / "1.pgn").write_text("".join(game(f"x-{g}") for g in range(5)))
    os.utime(files / "4.pgn", (1, 1))
    (files / "6.pgn").write_text(game("new"))
    (files / "0.pgn").unlink()
    assert between(0, 100)[1] == ["1.pgn", "4.pgn", "6.pgn"]
    assert whites(games_between(spark, str(files), 3, 7, index=index)) == [(4, "x-3"), (5, "x-4"), (6, "2-0"), (7, "2-1")]
    assert between(0, 100)[1] == []
    # Another rule for where games begin has counts of its own.
    pgn.files_between(spark, str(files), 0, 3, opening=None, index=index)
    assert opened == ["1.pgn"]


def test_numbers_from_kept_splits(spark, small_splits, tmp_path, monkeypatch):
    files, index = tmp_path / "files", str(tmp_path / "index")
    os.makedirs(files)
    for f in "ab":
        (files / f"{f}.pgn").write_text("".join(game(f"{f}{g}", "1. " + "e4 " * g) for g in range(30)))
    expected = [(k + 1, f"{f}{g}") for k, (f, g) in enumerate((f, g) for f in "ab" for g in range(30))]
    for _ in range(2):
        games, total = numbered_games(spark, str(files), index=index)
        assert (whites(games), total) == (expected, 60)
    written = [p for p in os.listdir(index) if p != "counts"]
    assert len(written) == 1
    # Another layout of splits has an index of its own.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    assert whites(numbered_games(spark, str(files), index=index)[0]) == expected
    (files / "b.pgn").write_text(game("changed"))
    games, total = numbered_games(spark, str(files), index=index)
    assert total == 31 and whites(games)[30:] == [(31, "changed")]
    assert len([p for p in os.listdir(index) if p != "counts"]) == 3


def test_index_of_frames_is_kept(spark, tmp_path, monkeypatch):
    dumps(tmp_path)
    index = str(tmp_path / "index")
    expected = [(1 + k, f"w{k % 120}") for k in range(480)]
    assert whites(numbered_games(spark, f"{tmp_path}/a b", frame_bytes=8000, index=index)[0]) == expected
    before = sorted(os.path.join(d, f) for d, _, fs in os.walk(index) for f in fs)
    games, total = numbered_games(spark, f"{tmp_path}/a b", frame_bytes=8000, index=index)
    assert (whites(games), total) == (expected, 480)
    assert sorted(os.path.join(d, f) for d, _, fs in os.walk(index) for f in fs) == before


def test_no_files_with_games(spark, tmp_path):
    (tmp_path / "files").mkdir()
    (tmp_path / "files" / "a.pgn").write_text("; nothing\n")
    for _ in range(2):
        assert first_games_of(spark, str(tmp_path / "files"), 3, index=str(tmp_path / "index")).count() == 0
    assert numbering.number_and_count(pgn.read_games(spark, str(tmp_path / "files")))[1] == 0
