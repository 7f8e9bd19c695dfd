import gzip
import io
import os
import random

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from gameflow.plans.ingest import numbered_games
from gameflow.sources import archives
from gameflow.sources.pgn import read_by_frame, read_corpus

PACK = {".gz": gzip.compress, ".zst": zstandard.ZstdCompressor(write_checksum=True).compress}


def game(name, length=1, noise=""):
    return f'[Event "x"]\n[White "{name}"]\n\n1. e4 {{ {noise} }} {"e5 " * length}*\n\n'


def text_of(count, seed=0):
    """Games whose comments do not compress, so that frames are of some size."""
    rng = random.Random(seed)
    return "".join(game(f"w{k}", k % 40, rng.randbytes(rng.randint(0, 400)).hex()) for k in range(count)).encode()


def packed(data, suffix, cuts):
    """The data in frames that end at ``cuts``, wherever that is in a game."""
    ends = sorted({0, len(data), *cuts})
    return b"".join(PACK[suffix](data[a:b]) for a, b in zip(ends, ends[1:]))


def pieces(blob, suffix, separator, starts):
    found = []
    for start, end in zip(starts, [*starts[1:], len(blob)]):
        found += archives.cut(archives.unpack(io.BytesIO(blob), start, end, suffix), separator, start == 0)
    return found


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_ranges_of_frames_give_the_pieces_of_the_whole(data):
    separator = data.draw(st.sampled_from([b"\n[E ", b"\n\n["]))
    words = [separator, separator[:2], separator[2:], b"a", b"\n", b"["]
    text = b"".join(data.draw(st.lists(st.sampled_from(words), min_size=1, max_size=60)))
    cuts = data.draw(st.lists(st.integers(0, len(text)), max_size=12))
    suffix = data.draw(st.sampled_from(sorted(PACK)))
    ends = sorted({0, len(text), *cuts})
    frames = [PACK[suffix](text[a:b]) for a, b in zip(ends, ends[1:])]
    places = [sum(map(len, frames[:k])) for k in range(len(frames))]
    starts = sorted({0, *data.draw(st.lists(st.sampled_from(places), max_size=6))})
    assert pieces(b"".join(frames), suffix, separator, starts) == text.split(separator)


@pytest.mark.parametrize("suffix", sorted(PACK))
def test_skipped_parts_and_padding(suffix):
    parts = [b"one\n[E two", b" more\n[E three"]
    between = b"\0" * 300_000 if suffix == ".gz" else b"\x5a\x2a\x4d\x18" + (300_000).to_bytes(4, "little") + b"\0" * 300_000
    blob = PACK[suffix](parts[0]) + between + PACK[suffix](parts[1]) + between
    assert pieces(blob, suffix, b"\n[E ", [0]) == [b"one", b"two more", b"three"]
    second = len(PACK[suffix](parts[0])) + len(between)
    assert archives.first_frame(io.BytesIO(blob), 1, len(blob), len(blob), suffix) == second
    assert pieces(blob, suffix, b"\n[E ", [0, second]) == [b"one", b"two more", b"three"]
    with pytest.raises(EOFError):
        pieces(PACK[suffix](parts[0])[:-3], suffix, b"\n[E ", [0])


@pytest.mark.parametrize("suffix", sorted(PACK))
def test_bytes_that_look_like_a_frame_are_none(suffix):
    rng = random.Random(3)
    magic = archives.MAGICS[suffix]
    # Noise is stored as it is, so the first bytes of frames stand in the archive many times.
    noise = b"".join(rng.randbytes(500) + magic + rng.randbytes(40) for _ in range(300))
    pack = zstandard.ZstdCompressor(level=1).compress if suffix == ".zst" else (lambda b: gzip.compress(b, 0))
    blob = pack(noise) + PACK[suffix](b"tail")
    assert blob.count(magic) > 200
    tail = len(blob) - len(PACK[suffix](b"tail"))
    assert archives.first_frame(io.BytesIO(blob), 1, len(blob), len(blob), suffix) == tail
    assert archives.first_frame(io.BytesIO(blob), 1, tail, len(blob), suffix) is None


def test_first_bytes_over_the_edge_of_a_read(monkeypatch):
    monkeypatch.setattr(archives, "READ_BYTES", 64)
    blob = PACK[".gz"](random.Random(1).randbytes(62 + 64 * 4)) + PACK[".gz"](b"second") + PACK[".gz"](b"third")
    second = blob.rindex(archives.GZIP_MAGIC, 0, blob.rindex(archives.GZIP_MAGIC))
    for start in range(1, second + 1, 7):
        assert archives.first_frame(io.BytesIO(blob), start, len(blob), len(blob), ".gz") == second
        assert archives.first_frame(io.BytesIO(blob), start, second + 1, len(blob), ".gz") == second
        assert archives.first_frame(io.BytesIO(blob), start, second, len(blob), ".gz") is None


def dumps(folder):
    os.makedirs(folder / "a b")
    texts = {k: text_of(120, k) for k in range(4)}
    rng = random.Random(9)

    def cuts(data):
        return [rng.randrange(len(data)) for _ in range(30)]

    (folder / "a b" / "g_2024-01.pgn.zst").write_bytes(packed(texts[0], ".zst", cuts(texts[0])))
    (folder / "a b" / "g_2024-02.pgn.gz").write_bytes(packed(texts[1], ".gz", cuts(texts[1])))
    (folder / "a b" / "g_2024-03.pgn.zst").write_bytes(packed(texts[2], ".zst", []))  # one frame
    (folder / "a b" / "g_2024-04.pgn").write_bytes(texts[3])
    return texts


def test_archives_of_several_frames_have_several_tasks(spark, tmp_path):
    dumps(tmp_path)
    scanned, framed = read_by_frame(spark, f"{tmp_path}/a b", frame_bytes=4000)
    assert {os.path.basename(r[0]) for r in framed.select("source_path").distinct().collect()} == {"g_2024-01.pgn.zst", "g_2024-02.pgn.gz"}
    assert framed.rdd.getNumPartitions() > 8
    assert sorted(os.path.basename(p) for p in scanned.inputFiles()) == ["g_2024-03.pgn.zst", "g_2024-04.pgn"]
    corpus = read_corpus(spark, f"{tmp_path}/a b", frame_bytes=4000)
    got = sorted((r["period"], r["White"], len(r["Moves"])) for r in corpus.collect())
    assert got == sorted((f"2024-0{d}", f"w{k}", 1 + k % 40) for d in range(1, 5) for k in range(120))
    plan = corpus._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RebalancePartitions") == 1
    assert read_by_frame(spark, f"{tmp_path}/a b", frame_bytes=1 << 30)[1] is None


def test_other_periods_are_not_opened(spark, tmp_path):
    dumps(tmp_path)
    (tmp_path / "a b" / "g_2024-02.pgn.gz").write_bytes(b"not an archive" * 5000)
    for periods, count in ((["2024-01"], 120), (["2024-01", "2024-04"], 240), (["2024-09"], 0)):
        assert read_corpus(spark, f"{tmp_path}/a b", periods=periods, frame_bytes=4000).count() == count


def test_numbers_run_through_frames(spark, tmp_path):
    dumps(tmp_path)
    games, total = numbered_games(spark, f"{tmp_path}/a b", before=7, frame_bytes=4000)
    got = sorted((r["GameID"], r["White"]) for r in games.select("GameID", "White").collect())
    assert total == 480 and got == [(8 + k, f"w{k % 120}") for k in range(480)]
    alone, total = numbered_games(spark, f"{tmp_path}/a b/g_2024-01.pgn.zst", frame_bytes=4000)
    assert total == 120 and "rebalance" not in alone._jdf.queryExecution().toString().lower()
    assert sorted(r["GameID"] for r in alone.collect()) == list(range(1, 121))


def test_long_game_over_many_frames(spark, tmp_path):
    data = game("before").encode() + game("long", 3, random.Random(5).randbytes(200_000).hex()).encode() + game("after").encode()
    (tmp_path / "x.pgn.zst").write_bytes(packed(data, ".zst", range(0, len(data), 10_000)))
    scanned, framed = read_by_frame(spark, str(tmp_path), frame_bytes=9000)
    assert scanned is None and framed.rdd.getNumPartitions() > 5
    assert sorted(len(r["record"].rstrip("\n")) for r in framed.collect()) == sorted(
        len(g.rstrip("\n")) for g in (game("before"), game("after"), data.decode()[len(game("before")):-len(game("after"))]))


def test_small_ranges_share_tasks(spark, tmp_path):
    """Tasks grow with the cores and the packed bytes, not with the number of small ranges."""
    data = text_of(3000)
    (tmp_path / "x_2024-01.pgn.zst").write_bytes(packed(data, ".zst", range(0, len(data), 1000)))
    (tmp_path / "y_2024-02.pgn.gz").write_bytes(packed(data, ".gz", range(0, len(data), 1000)))
    index, _ = archives.index_frames(spark, str(tmp_path), 2000)
    assert spark.read.json(index).count() > 200
    _, framed = read_by_frame(spark, str(tmp_path), frame_bytes=2000)
    assert 8 < framed.rdd.getNumPartitions() <= 8 * spark.sparkContext.defaultParallelism
    got = sorted((r["period"], r["White"], len(r["Moves"])) for r in read_corpus(spark, str(tmp_path), frame_bytes=2000).collect())
    assert got == sorted((f"2024-0{d}", f"w{k}", 1 + k % 40) for d in (1, 2) for k in range(3000))
    games, total = numbered_games(spark, str(tmp_path), frame_bytes=2000)
    assert total == 6000 and sorted((r["GameID"], r["White"]) for r in games.collect()) == [(1 + k, f"w{k % 3000}") for k in range(6000)]


def test_ranges_dealt_to_tasks(monkeypatch):
    ranges = [("a", k, k + 10) for k in range(0, 100, 10)] + [("b", 0, 500), ("c", 0, 10), ("c", 10, 15)]
    assert archives.dealt(ranges, 1000) == [[r] for r in ranges]
    assert archives.dealt(ranges, 12) == [[("a", 0, 50)], [("a", 50, 100)], [("b", 0, 500)], [("c", 0, 15)]]
    assert archives.dealt(ranges, 1) == [[("a", 0, 100), ("b", 0, 500), ("c", 0, 15)]]
    monkeypatch.setattr(archives, "FRAME_BYTES", 20)
    assert [len(own) for own in archives.dealt(ranges, 1)] == [1] * 7
    assert archives.dealt([], 4) == []
