import gzip
import hashlib
import random

from gameflow.llm import warc

SCHEMA = "page_id long, url string, html string, record_type string"


def page(k, size):
    return f"<p>é{k} " + "x" * size


ROWS = [
    (1, "http://a/", page(1, 2000), "a"), (2, "http://b/", page(1, 2000), "a"), (3, None, page(1, 2000), "a"),
    (4, "http://bad\r\nX: y/", "small", "b"), (5, "u", "small", "b"), (6, "u", None, "c"), (7, "u", "", "c"),
    (8, "u", "x" * 1000, "d"), (9, "u", "x" * 1000, "d"), (9, "u", "x" * 1000, "d"), (10, "u", "x" * 999, "e"), (11, "u", "x" * 999, "e"),
    (None, "u", page(1, 2000), "f"), (12, "u", "WARC/1.1\r\n\r\n" * 200, "g"), (13, "u", page(13, 3_000_000), "h"),
]


def expected():
    rows = []
    for page_id, _, html, _ in ROWS:
        raw = (html or "").encode()
        twins = [p for p, _, h, _ in ROWS if h == html and p is not None] if len(raw) >= 1000 else []
        original = max(twins) if twins and max(twins) != page_id else None
        rows.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if original is not None else "response", original))
    return sorted(rows, key=str)


def test_round_trip(spark):
    got = warc.archive_round_trip(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == expected()


def test_payloads_come_back(spark, tmp_path):
    warc.write_archives(spark.createDataFrame(ROWS, SCHEMA), f"{tmp_path}/w")
    rows = warc.read_archives(spark, f"{tmp_path}/w").collect()
    assert {r.kind for r in rows} == {"record"}
    payloads = {r.record_id: bytes(r.payload) for r in rows if r.record_type == "response"}
    assert payloads["<urn:page:13>"] == page(13, 3_000_000).encode() and payloads["<urn:page:6>"] == b""


def test_empty_table(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def records(n=8):
    made = []
    for k in range(n):
        payload = f"payload {k} ".encode() * (50 + k)
        made.append(warc._record(k, "http://x/", payload, hashlib.sha1(payload).hexdigest(), None))
    return made


def ids(found):
    return [int(r["record_id"][10:-1]) for r in found if r["kind"] == "record"]


def check_cover(data, found, padding=b"\r\n"):
    """Records and gaps cover every byte once, apart from line ends."""
    at = 0
    for r in found:
        assert not data[at:r["offset"]].strip(padding)
        at = r["offset"] + r["length"]
    assert not data[at:].strip(padding)


def test_undamaged_plain_and_packed():
    plain = b"".join(records())
    packed = b"".join(map(warc._member, records())) + b"\n"
    mixed = plain + packed + gzip.compress(plain)
    for data, n in ((plain, 8), (packed, 8), (mixed, 24)):
        found = list(warc.salvage(data))
        assert len(ids(found)) == n and all(r["kind"] == "record" for r in found)
    assert list(warc.salvage(b"")) == []


def test_damage_is_bounded():
    for packed in (False, True):
        parts = [warc._member(r) for r in records()] if packed else records()
        for bad in range(8):
            for how in ("flip", "cut", "drop", "garbage"):
                damaged = list(parts)
                x = damaged[bad]
                middle = len(x) // 2
                if how == "flip":
                    damaged[bad] = x[:middle] + bytes([x[middle] ^ 0x55]) + x[middle + 1:]
                elif how == "cut":
                    damaged[bad] = x[:middle]
                elif how == "drop":
                    damaged[bad] = x[middle:]
                else:
                    damaged[bad] = b"\x1f\x8b\x08 nonsense WARC/1.0\r\nfoo" + x
                data = b"".join(damaged)
                found = list(warc.salvage(data))
                lost = set(range(8)) - set(ids(found))
                assert lost <= ({bad} if how != "garbage" else set()), (packed, bad, how)
                gaps = [r for r in found if r["kind"] == "gap"]
                assert len(gaps) == 1 and gaps[0]["reason"]
                check_cover(data, found)


def test_wrong_length_and_digest():
    parts = records(3)
    longer = parts[1].replace(b"Content-Length: ", b"Content-Length: 9", 2)
    found = list(warc.salvage(parts[0] + longer + parts[2]))
    assert ids(found) == [0, 2] and [r["reason"] for r in found if r["kind"] == "gap"] == ["truncated"]
    changed = parts[1].replace(b"payload 1", b"payload 7")
    found = list(warc.salvage(parts[0] + changed + parts[2]))
    assert ids(found) == [0, 2] and [r["reason"] for r in found if r["kind"] == "gap"] == ["digest"]


def test_failed_record_costs_its_member_nothing_else():
    parts = records()
    for bad in range(8):
        for how, reason in (("digest", "digest"), ("version", "header"), ("length", None)):
            broken = list(parts)
            broken[bad] = {
                "digest": parts[bad].replace(b"payload", b"payloaD", 1) if b"payload" in parts[bad] else parts[bad],
                "version": parts[bad].replace(b"WARC/1.1", b"WARX/1.1", 1),
                "length": parts[bad].replace(b"\r\nContent-Length: ", b"\r\nContent-Length: 9"),
            }[how]
            data = parts[0] + gzip.compress(b"".join(broken)) + parts[7]
            found = list(warc.salvage(data))
            assert ids(found) == [0, *(k for k in range(8) if k != bad), 7], (bad, how)
            gap, = (r for r in found if r["kind"] == "gap")
            assert reason in (None, gap["reason"])
            start = len(b"".join(broken[:bad]))
            assert (gap["inner_offset"], gap["inner_length"]) == (start, len(broken[bad]))
            assert gap["offset"] == len(parts[0]) and gap["offset"] + gap["length"] == len(data) - len(parts[7])


def test_cut_and_flipped_members_of_many_records():
    parts = records()
    plain = b"".join(parts)
    number = {f"payload {k} ".encode() * (50 + k): k for k in range(8)}
    for level in (0, 6):
        packed = gzip.compress(plain, level)
        rng = random.Random(level)
        damaged = [(packed[:n], n) for n in (len(packed) - 1, len(packed) - 9, len(packed) // 2, 20, 3)]
        for _ in range(60):
            n = rng.randrange(10, len(packed))
            damaged.append((packed[:n] + bytes([packed[n] ^ 1 << rng.randrange(8)]) + packed[n + 1:], n))
        for x, n in damaged:
            data = parts[7] + x + warc._member(parts[0])
            found = list(warc.salvage(data))
            got = [number[r["payload"]] for r in found if r["kind"] == "record"]  # none is altered
            assert got[0] == 7 and got[-1] == 0
            assert len(set(got[1:-1])) == len(got) - 2  # none twice
            # Where a damaged length shows uncompressed records, they part the gap.
            gaps = [(r["offset"], r["offset"] + r["length"]) for r in found if r["kind"] == "gap"]
            assert gaps[0][0] == len(parts[7]) and gaps[-1][1] == len(parts[7]) + len(x)
            assert level == 0 or len(gaps) == 1
            if n >= len(packed) - 8:  # only the checksum is hurt
                assert got == [7, *range(8), 0]
    half = list(warc.salvage(gzip.compress(plain, 0)[:len(plain) // 2]))
    assert ids(half) == [0, 1, 2, 3]


def test_random_bytes_never_stop_the_reader(spark, tmp_path):
    rng = random.Random(6)
    (tmp_path / "a").mkdir()
    for k in range(4):
        noise = bytes(rng.choices(b"\x1f\x8b\x08WARC/1.0\r\n :", k=3000))
        (tmp_path / "a" / f"{k}.warc").write_bytes(noise + records(2)[1] + noise)
    rows = warc.read_archives(spark, f"{tmp_path}/a", payloads=False).collect()
    assert sum(r.kind == "record" for r in rows) == 4
    assert sum(r.kind == "gap" for r in rows) == 8
