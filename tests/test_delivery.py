"""Streams, dead letters and the keyed table, with faults."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from gameflow.plans.ingest import deliver, ingest, load_table, replay
from gameflow.plans.standins import RefusingTopic
from gameflow.functions.codec import decode_payload
from gameflow.schema import MESSAGE_FIELDS, message_schema
from gameflow.sinks.table import ConnectorTable, ParquetTable
from gameflow.sources.csv_chunks import stream_chunks, write_chunks
from gameflow.sources.dead_letters import list_letters, read_letters, write_letter
from gameflow.sources.messages import encode_messages, file_topic, kafka_topic
from gameflow.streaming import jobs


def games(spark, first, last, result="1-0"):
    frame = spark.range(first, last + 1).select(F.col("id").alias("GameID"), F.lit(result).alias("Result"))
    rest = [F.array(F.lit("e4")).alias("Moves") if f == "Moves" else F.lit("1").alias(f)
            for f in MESSAGE_FIELDS if f not in ("GameID", "Result")]
    return frame.select("*", *rest).select(*MESSAGE_FIELDS)


@pytest.fixture
def place(tmp_path):
    class Place:
        topic = file_topic(str(tmp_path / "topic"))
        letters = str(tmp_path / "letters")
        table = ParquetTable(str(tmp_path / "table"))
        checkpoint = str(tmp_path / "checkpoint")
        landing = str(tmp_path / "landing")
    return Place


def stored(spark, table):
    return {r["gameid"]: r["result"] for r in table.latest(spark).collect()}


def test_stop_after_ingest_and_resume(spark, place):
    place.topic.write(encode_messages(games(spark, 1, 20)))
    load_table(spark, place.topic, place.table, place.checkpoint)
    place.topic.write(encode_messages(games(spark, 21, 30)))
    load_table(spark, place.topic, place.table, place.checkpoint)
    assert sorted(stored(spark, place.table)) == list(range(1, 31))
    assert place.table.versions(spark).count() == 30


def test_sink_fails_in_the_middle(spark, place):
    chunked = games(spark, 1, 30).withColumn("chunk", F.col("GameID") % 3)
    write_chunks(chunked.repartition(1), place.landing)
    source = stream_chunks(spark, place.landing, maxFilesPerTrigger="1")
    refusing = RefusingTopic(place.topic, {1})
    jobs.start_delivery(source, refusing, place.letters, place.checkpoint, jobs.AVAILABLE_NOW).awaitTermination()
    assert place.topic.read(spark).count() == 20
    [letter] = list_letters(spark, place.letters)
    assert os.path.basename(letter).startswith("failed_batch_1_") and letter.endswith(".json")
    # Another query's batch 1 fails too: its letter stands beside the first.
    jobs.start_delivery(
        source, refusing, place.letters, place.checkpoint + "-other", jobs.AVAILABLE_NOW
    ).awaitTermination()
    assert len(list_letters(spark, place.letters)) == 2
    assert replay(spark, place.letters, place.topic) == (2, [])
    assert list_letters(spark, place.letters) == []
    assert replay(spark, place.letters, place.topic) == (0, [])
    load_table(spark, place.topic, place.table, place.checkpoint + "-table")
    assert sorted(stored(spark, place.table)) == list(range(1, 31))


def test_sink_fails_from_the_start(spark, place):
    frame = games(spark, 1, 10)
    refusing = RefusingTopic(place.topic, {None})
    assert not deliver(frame, refusing, place.letters, "day")
    assert not deliver(frame, refusing, place.letters, "day")
    names = [os.path.basename(p) for p in list_letters(spark, place.letters)]
    assert len(names) == 2 and all(n.startswith("failed_df_day_") for n in names)
    replay(spark, place.letters, place.topic)
    load_table(spark, place.topic, place.table, place.checkpoint)
    assert sorted(stored(spark, place.table)) == list(range(1, 11))


def test_rows_sent_twice_are_stored_once_and_the_later_write_wins(spark, place):
    for result in ("1-0", "0-1"):
        place.topic.write(encode_messages(games(spark, 1, 10, result)))
        load_table(spark, place.topic, place.table, place.checkpoint)
    assert stored(spark, place.table) == dict.fromkeys(range(1, 11), "0-1")
    compact = place.table.compact(spark, place.table.path + "-compact")
    assert stored(spark, compact) == dict.fromkeys(range(1, 11), "0-1")
    assert compact.versions(spark).count() == 10
    place.topic.write(encode_messages(games(spark, 5, 5, "*")))
    load_table(spark, place.topic, compact, place.checkpoint)
    assert stored(spark, compact)[5] == "*" and len(stored(spark, compact)) == 10


def test_fresh_checkpoint_leaves_earlier_batches_alone(spark, place):
    place.topic.write(encode_messages(games(spark, 1, 5)))
    load_table(spark, place.topic, place.table, place.checkpoint)
    other = file_topic(place.topic.read_options["path"] + "-other")
    other.write(encode_messages(games(spark, 6, 9)))
    load_table(spark, other, place.table, place.checkpoint + "-fresh")
    assert sorted(stored(spark, place.table)) == list(range(1, 10))


def test_crash_after_the_write_repeats_the_batch_in_place(spark, place):
    class Crashing(ParquetTable):
        def write_batch(self, rows, run, batch_id):
            super().write_batch(rows, run, batch_id)
            raise RuntimeError("lost after the write")

    place.topic.write(encode_messages(games(spark, 1, 10)))
    with pytest.raises(Exception, match="lost after the write"):
        load_table(spark, place.topic, Crashing(place.table.path), place.checkpoint)
    before = place.table.versions(spark).collect()
    place.topic.write(encode_messages(games(spark, 11, 12)))
    load_table(spark, place.topic, place.table, place.checkpoint)
    after = place.table.versions(spark)
    assert after.count() == 12 and len(before) == 10
    assert sorted(r["gameid"] for r in after.filter("batch_id = 0").collect()) == list(range(1, 11))
    # The repeated batch carries the same write time as before.
    assert {r["written_at"] for r in before} == {r["written_at"] for r in after.filter("batch_id = 0").collect()}


def test_keys_that_are_no_numbers_are_reported_not_stored(spark, place):
    place.topic.write(encode_messages(games(spark, 1, 5).withColumn("GameID", F.concat(F.lit("x"), "GameID"))
                                      .unionByName(games(spark, 6, 8).withColumn("GameID", F.col("GameID").cast("string")))))
    query = jobs.start_upsert(place.topic.read_stream(spark), place.table, place.checkpoint, trigger=jobs.AVAILABLE_NOW)
    query.awaitTermination()
    assert sorted(stored(spark, place.table)) == [6, 7, 8]
    seen = [p["observedMetrics"]["upsert"] for p in map(lambda p: json.loads(p.json), query.recentProgress) if p["observedMetrics"]]
    assert seen[0]["n_rows"] == 8 and seen[0]["n_rejected"] == 5


def test_hot_key(spark, place):
    hot = games(spark, 1, 3000).withColumn("Variant", F.col("GameID").cast("string")).withColumn(
        "GameID", F.when(F.col("GameID") % 3 == 0, 7).otherwise(F.col("GameID")))
    place.topic.write(encode_messages(hot, offset="Variant"))
    load_table(spark, place.topic, place.table, place.checkpoint)
    latest = {r["gameid"]: r["variant"] for r in place.table.latest(spark).collect()}
    assert len(latest) == 2000 and latest[7] == "3000"


def test_letters_of_other_writers(spark, place):
    os.makedirs(place.letters)
    record = {f: "1" for f in MESSAGE_FIELDS} | {"Moves": ["e4"], "Variant": None}
    def put(name, text):
        with open(os.path.join(place.letters, name), "w") as out:
            out.write(text)
    put("failed_batch_1.5.json", json.dumps([record | {"GameID": 1}, record | {"GameID": 2}]))
    put("failed_df_2.5.json", json.dumps([record | {"GameID": 2}]))
    put("failed_df_3.json", "[]")
    put("other_failed_batch.json", json.dumps([record | {"GameID": 9}]))
    put("failed_batch_4.txt", json.dumps([record | {"GameID": 9}]))
    assert replay(spark, place.letters, place.topic) == (3, [])
    load_table(spark, place.topic, place.table, place.checkpoint)
    assert sorted(stored(spark, place.table)) == [1, 2]
    assert sorted(os.listdir(place.letters)) == ["failed_batch_4.txt", "other_failed_batch.json"]


def test_damaged_letters_stay_and_hold_nothing_up(spark, place):
    os.makedirs(place.letters)
    record = {f: "1" for f in MESSAGE_FIELDS} | {"Moves": ["e4"]}
    texts = {
        "failed_df_1.json": json.dumps([{"GameID": 1, "Moves": ["e4"]}, {"GameID": 2}], indent=2),
        "failed_df_2.json": json.dumps([record | {"GameID": 3, "Moves": "['e4', 'e5']"}]),
        "failed_batch_3.json": json.dumps(record | {"GameID": 4}) + "\n" + json.dumps(record)[:20],
    }
    for name, text in texts.items():
        with open(os.path.join(place.letters, name), "w") as out:
            out.write(text)
    write_letter(games(spark, 5, 6), place.letters, "df", "good")
    write_letter(games(spark, 7, 8), place.letters, "df", "uncommitted")
    os.remove(os.path.join(place.letters, "failed_df_uncommitted.json", "_SUCCESS"))
    sent, damaged = replay(spark, place.letters, place.topic)
    assert (sent, [os.path.basename(p) for p in damaged]) == (2, ["failed_batch_3.json", "failed_df_1.json"])
    moves = {r["GameID"]: r["Moves"] for r in decode_payload(place.topic.read(spark)).collect()}
    assert moves == {"3": ["e4", "e5"], "5": ["e4"], "6": ["e4"]}
    assert sorted(os.listdir(place.letters)) == ["failed_batch_3.json", "failed_df_1.json", "failed_df_uncommitted.json"]
    assert replay(spark, place.letters, place.topic, multi_line=True).sent == 1
    assert sorted(os.listdir(place.letters)) == ["failed_batch_3.json", "failed_df_uncommitted.json"]


def test_later_write_wins_inside_one_batch(spark, place):
    for result in ("1-0", "0-1"):
        place.topic.write(encode_messages(games(spark, 1, 500, result)))
    load_table(spark, place.topic, place.table, place.checkpoint)
    assert stored(spark, place.table) == dict.fromkeys(range(1, 501), "0-1")


def kafka_shaped(spark):
    """Two versions of five games in two partitions, whose offsets run against the times."""
    parts = []
    for partition, offset, second, result in ((0, 900, 1, "old"), (1, 3, 2, "new")):
        rows = encode_messages(games(spark, 1, 5, result)).withColumn("offset", F.col("offset") + offset)
        parts.append(rows.select("value", F.lit(partition).alias("partition"), "offset",
                                 F.lit(f"2024-01-01 00:00:0{second}").cast("timestamp").alias("timestamp")))
    return parts[0].unionByName(parts[1])


def test_offsets_of_different_partitions_do_not_decide(spark, place):
    kafka_shaped(spark).write.parquet(place.topic.write_options["path"])
    load_table(spark, place.topic, place.table, place.checkpoint)
    assert stored(spark, place.table) == dict.fromkeys(range(1, 6), "new")


def test_connector_gets_one_version_of_each_key(spark, place):
    kafka_shaped(spark).write.parquet(place.topic.write_options["path"])
    store = ConnectorTable("parquet", {"path": place.table.path})
    load_table(spark, place.topic, store, place.checkpoint)
    assert {r["gameid"]: r["result"] for r in store.latest(spark).collect()} == dict.fromkeys(range(1, 6), "new")
    assert store.count(spark).first()["n"] == 5


def test_topic_options():
    topic = kafka_topic("a:1,b:2", "games", {"kafka.retries": "9"}, maxOffsetsPerTrigger="5", **{"kafka.security.protocol": "SSL"})
    assert topic.read_options["maxOffsetsPerTrigger"] == "5" and "maxOffsetsPerTrigger" not in topic.write_options
    for options in (topic.read_options, topic.write_options):
        assert options["kafka.security.protocol"] == "SSL" and options["kafka.bootstrap.servers"] == "a:1,b:2"
    assert topic.write_options["kafka.retries"] == "9" and topic.write_options["kafka.acks"] == "all"


def test_source_errors_are_no_refusals(spark, place):
    games(spark, 1, 5).withColumn("GameID", F.col("GameID").cast("string")).write.parquet(place.landing)
    source = spark.readStream.schema(message_schema()).parquet(place.landing)
    bad = source.withColumn("White", F.raise_error(F.lit("bad row")).cast("string"))
    with pytest.raises(Exception, match="bad row"):
        jobs.start_delivery(bad, place.topic, place.letters, place.checkpoint, jobs.AVAILABLE_NOW).awaitTermination()
    assert not os.path.exists(place.letters)


def test_ingest_sends_chunk_by_chunk(spark, place, tmp_path):
    text = "".join(f'[Event "x"]\n[White "w{g}"]\n\n1. e4 *\n\n' for g in range(10))
    (tmp_path / "a.pgn").write_text(text)
    result = ingest(spark, str(tmp_path / "a.pgn"), RefusingTopic(place.topic, {1}), place.letters, chunks=3)
    assert result == (10, ["ingest_games_4_7"])
    [letter] = list_letters(spark, place.letters)
    assert os.path.basename(letter).startswith("failed_df_ingest_games_4_7_")
    assert place.topic.read(spark).count() == 7
    replay(spark, place.letters, place.topic)
    batched = ingest(spark, str(tmp_path / "a.pgn"), RefusingTopic(place.topic, {1}), place.letters, chunks=2, start_at=10, batch_size=2)
    assert batched == (10, ["ingest_games_10_15_1", "ingest_games_15_20_1"])
    assert [r["GameID"] for r in read_letters(spark, list_letters(spark, place.letters)).orderBy(F.col("GameID").cast("int")).collect()] == ["13", "14", "18", "19"]
    replay(spark, place.letters, place.topic)
    load_table(spark, place.topic, place.table, place.checkpoint)
    assert {r["gameid"]: r["white"] for r in place.table.latest(spark).collect()} == {g + 1: f"w{g % 10}" for g in range(20)}
    # A bad source ends the job, sends nothing and leaves no letter.
    (tmp_path / "bad.pgn").write_text('[White "w"]\n\n1. e4 *\n\n' * 3)
    with pytest.raises(Exception, match="not one game"):
        ingest(spark, str(tmp_path / "bad.pgn"), place.topic, place.letters)
    assert list_letters(spark, place.letters) == []
    write_chunks(games(spark, 1, 2).withColumn("chunk", F.lit(0)), place.landing)
    with pytest.raises(Exception, match="already exists"):
        ingest(spark, str(tmp_path / "a.pgn"), place.topic, place.letters, landing=place.landing)


def test_key_ranges_are_pruned(spark, place, monkeypatch):
    monkeypatch.setattr("gameflow.sinks.table.KEYS_PER_RANGE", 10)
    place.table.create(spark)
    assert place.table.count(spark).first()["n"] == 0
    place.topic.write(encode_messages(games(spark, 1, 45)))
    load_table(spark, place.topic, place.table, place.checkpoint)
    place.table.create(spark)
    some = place.table.latest(spark, 20, 29)
    assert sorted(r["gameid"] for r in some.collect()) == list(range(20, 30))
    assert {p.split("key_range=")[1].split("/")[0] for p in some.inputFiles()} >= {"2"}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "key_range" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert place.table.last_key(spark) == 45 and ParquetTable(place.table.path + "-none").last_key(spark) == 0


def test_rejected_keys_are_kept(spark, place):
    place.topic.write(encode_messages(games(spark, 1, 3).withColumn("GameID", F.concat(F.lit("x"), "GameID"))))
    rejects = place.landing
    jobs.start_upsert(place.topic.read_stream(spark), place.table, place.checkpoint, jobs.AVAILABLE_NOW, rejects).awaitTermination()
    assert sorted(r["key_text"] for r in spark.read.json(rejects).collect()) == ["x1", "x2", "x3"]


def test_batch_and_stream_decode_alike(spark, place):
    from gameflow.operators.decode import select_games, to_table_types

    place.topic.write(encode_messages(games(spark, 1, 50)))
    out = place.landing
    jobs.start_selection(place.topic.read_stream(spark), out, place.checkpoint, jobs.AVAILABLE_NOW).awaitTermination()
    batch = to_table_types(select_games(place.topic.read(spark)))
    stream = spark.read.parquet(out)
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect())) and stream.count() == 50


def test_ingest_with_landing_and_short_corpus(spark, place, tmp_path):
    text = "".join(f'[Event "x"]\n[White "w{g}"]\n\n1. e4 *\n\n' for g in range(10))
    (tmp_path / "a.pgn").write_text(text)
    assert ingest(spark, str(tmp_path / "a.pgn"), place.topic, place.letters, count=50, chunks=4, landing=place.landing) == (10, [])
    assert len(glob.glob(place.landing + "/chunk=*")) == 4
    load_table(spark, place.topic, place.table, place.checkpoint)
    assert {r["gameid"]: r["white"] for r in place.table.latest(spark).collect()} == {g + 1: f"w{g}" for g in range(10)}


@pytest.mark.parametrize("landed", [False, True])
def test_a_later_dump_gets_keys_of_its_own(spark, place, tmp_path, landed):
    for month in "ab":
        text = "".join(f'[Event "x"]\n[White "{month}{g}"]\n\n1. e4 *\n\n' for g in range(4))
        (tmp_path / f"{month}.pgn").write_text(text)
        landing = f"{place.landing}-{month}" if landed else None
        ingest(spark, str(tmp_path / f"{month}.pgn"), place.topic, place.letters, landing=landing, chunks=2,
               start_at=4 * (month == "b"))
    load_table(spark, place.topic, place.table, place.checkpoint)
    got = {r["gameid"]: r["white"] for r in place.table.latest(spark).collect()}
    assert got == {4 * m + g + 1: f"{month}{g}" for m, month in enumerate("ab") for g in range(4)}


def test_chunks_are_sent_side_by_side(spark, place, tmp_path):
    import threading

    (tmp_path / "a.pgn").write_text("".join(f'[Event "x"]\n[White "w{g}"]\n\n1. e4 *\n\n' for g in range(12)))
    met, seen = threading.Barrier(3, timeout=120), []

    class Meeting:
        """Each send waits for two others."""

        def __init__(self, name):
            self.name = name

        def write(self, messages, batch_id=None):
            met.wait()
            seen.append((self.name, batch_id))
            place.topic.write(messages, batch_id)

    ways = [Meeting("a"), Meeting("b")]
    assert ingest(spark, str(tmp_path / "a.pgn"), ways, place.letters, chunks=3, senders=3) == (12, [])
    assert sorted(seen) == [("a", 0), ("a", 2), ("b", 1)]
    assert sorted(int(r["GameID"]) for r in decode_payload(place.topic.read(spark)).collect()) == list(range(1, 13))

    class Broken:
        def write(self, messages, batch_id=None):
            raise ConnectionError("refused")

    # A letter that cannot be written is an error, raised after the other chunks were tried.
    (tmp_path / "blocked").write_text("")
    with pytest.raises(Exception):
        ingest(spark, str(tmp_path / "a.pgn"), Broken(), str(tmp_path / "blocked" / "x"), chunks=2)


def test_a_batch_reads_its_own_rows(spark, place, tmp_path):
    (tmp_path / "a.pgn").write_text("".join(f'[Event "x"]\n[White "w{g}"]\n\n1. e4 *\n\n' for g in range(60)))
    read = []

    class Watching:
        def write(self, messages, batch_id=None):
            read.append((len(messages.inputFiles()), messages.count()))

    ingest(spark, str(tmp_path / "a.pgn"), Watching(), place.letters, chunks=2, batch_size=10, landing=place.landing)
    assert sorted(n for _, n in read) == [10] * 6
    folders = glob.glob(place.landing + "/chunk=*/batch=*")
    assert len(folders) == 6
    batch = folders[0].rsplit("=", 1)[1]
    from gameflow.sources.csv_chunks import read_chunks

    one = read_chunks(spark, place.landing, batches=True).filter(f"chunk = 0 and batch = {batch}")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "batch" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_rows_say_where_they_go(spark, place):
    from gameflow.operators.ranges import round_robin_target
    from gameflow.sources.messages import Topic

    routed = round_robin_target(games(spark, 1, 9).withColumn("chunk", F.col("GameID") % 5), 3).withColumnRenamed("target", "partition")
    place.topic.write(encode_messages(routed))
    got = {int(r["offset"]): r["partition"] for r in place.topic.read(spark).collect()}
    assert got == {g: g % 5 % 3 for g in range(1, 10)}
    kafka = Topic("kafka", {}, {"topic": "games"})
    frame = kafka._frame(encode_messages(routed.withColumn("topic", F.when(F.col("partition") == 0, "first"))))
    assert frame.columns == ["value", "topic", "partition"]
    assert {(r["topic"], r["partition"]) for r in frame.collect()} == {("first", 0), ("games", 1), ("games", 2)}
    assert kafka._frame(encode_messages(games(spark, 1, 2))).columns == ["value"]


def test_messages_written_once(spark, place, monkeypatch):
    from gameflow.sources import messages

    topic, frame = place.topic, encode_messages(games(spark, 1, 40).repartition(4))
    moves = []

    def crash(spark, source, target, move=messages.move_path):
        if len(moves) == 2:
            raise RuntimeError("lost while moving")
        moves.append(target)
        move(spark, source, target)

    monkeypatch.setattr(messages, "move_path", crash)
    with pytest.raises(RuntimeError):
        topic.write_once(frame, "r1")
    monkeypatch.undo()
    for _ in range(2):
        topic.write_once(frame, "r1")
    assert sorted(r["offset"] for r in topic.read(spark).collect()) == list(range(1, 41))
    topic.write_once(frame, "r2")
    assert topic.read(spark).count() == 80


@pytest.mark.parametrize("after", ["send", "reject"])
def test_stream_replay_sends_nothing_twice(spark, place, monkeypatch, after):
    write_letter(games(spark, 1, 20).repartition(3), place.letters, "df", "a")
    os.makedirs(place.letters, exist_ok=True)
    with open(os.path.join(place.letters, "failed_batch_7.json"), "w") as out:
        out.write(json.dumps([{"GameID": 21, "Moves": "['e4']"}, {"GameID": 22}]) + '\n{"GameID": 23, "Mo')
    rest = [place.checkpoint + "-replay", place.landing + "-archive", place.landing + "-rejects"]

    class Crashing:
        def write_once(self, messages, name):
            place.topic.write_once(messages, name)
            raise RuntimeError("lost after the send")

    if after == "send":
        with pytest.raises(Exception, match="lost after the send"):
            jobs.start_replay(spark, place.letters, Crashing(), *rest, jobs.AVAILABLE_NOW).awaitTermination()
    for _ in range(2):
        jobs.start_replay(spark, place.letters, place.topic, *rest, jobs.AVAILABLE_NOW).awaitTermination()
    sent = sorted(int(r["GameID"]) for r in decode_payload(place.topic.read(spark)).collect())
    assert sent == list(range(1, 23))
    assert [r["value"] for r in spark.read.option("recursiveFileLookup", "true").text(rest[2]).collect()] == ['{"GameID": 23, "Mo']
    # A later letter is sent by the next run, which also puts the earlier ones away.
    write_letter(games(spark, 30, 31), place.letters, "batch", "b")
    jobs.start_replay(spark, place.letters, place.topic, *rest, jobs.AVAILABLE_NOW).awaitTermination()
    assert place.topic.read(spark).count() == 24
    assert glob.glob(rest[1] + "/**/failed_batch_7.json", recursive=True)
    assert not os.path.exists(os.path.join(place.letters, "failed_batch_7.json"))


def test_only_changes_are_written(spark, place):
    def load():
        jobs.start_changes(place.topic.read_stream(spark), place.table, place.checkpoint, jobs.AVAILABLE_NOW).awaitTermination()
        return place.table.versions(spark).count()

    place.table.create(spark)
    first = kafka_shaped(spark)
    first.write.parquet(place.topic.write_options["path"])
    assert load() == 5
    assert stored(spark, place.table) == dict.fromkeys(range(1, 6), "new")
    assert load() == 5
    first.write.mode("append").parquet(place.topic.write_options["path"])  # all again: the same and older versions
    assert load() == 5
    place.topic.write(encode_messages(games(spark, 5, 7, "newest")))
    assert load() == 8
    assert stored(spark, place.table) == dict.fromkeys(range(1, 5), "new") | dict.fromkeys(range(5, 8), "newest")


def test_bucketed_table(spark, place):
    from gameflow.sinks.table import BucketedTable

    table = BucketedTable(place.table.path, 3)
    table.create(spark)
    assert table.count(spark).first()["n"] == 0 == table.last_key(spark)
    place.topic.write(encode_messages(games(spark, 1, 500)))
    load_table(spark, place.topic, table, place.checkpoint)
    place.topic.write(encode_messages(games(spark, 400, 600, "0-1")))
    load_table(spark, place.topic, table, place.checkpoint)
    table.create(spark)
    expected = {g: "1-0" if g < 400 else "0-1" for g in range(1, 601)}
    assert stored(spark, table) == expected
    assert table.count(spark).first()["n"] == 600 == table.last_key(spark)
    assert sorted(r["gameid"] for r in table.latest(spark, 90, 99).collect()) == list(range(90, 100))
    # A batch has a file for each bucket, and a read of the table moves no version.
    assert len(glob.glob(table.path + "/buckets-3/run=*/batch_id=0/part-*")) == 3
    assert "Exchange" not in table.latest(spark)._jdf.queryExecution().executedPlan().toString()
    # A repeated batch replaces itself; another number of buckets is not taken.
    versions = table.versions(spark)
    last = versions.filter("batch_id = 1").collect()
    again = spark.createDataFrame(last, versions.schema)
    BucketedTable(table.path, 8).write_batch(again, last[0]["run"], 1)
    assert table.versions(spark).count() == 701 and stored(spark, BucketedTable(table.path, 8)) == expected
    compact = table.compact(spark, table.path + "-compact")
    assert compact.versions(spark).count() == 600 and stored(spark, compact) == expected
    assert "Exchange" not in compact.latest(spark)._jdf.queryExecution().executedPlan().toString()
    # Another session finds the batches that are there.
    other = spark.newSession()
    spark.sql(f"DROP TABLE {table._name(spark)}")
    assert stored(other, BucketedTable(table.path)) == expected


def test_dumps_are_numbered_on(spark, place, tmp_path, monkeypatch):
    from gameflow.plans import ingest as plans

    dumps, ledger = tmp_path / "dumps", str(tmp_path / "ledger")
    dumps.mkdir()

    def drop(name, n):
        (dumps / name).write_text("".join(f'[Event "x"]\n[White "{name}{g}"]\n\n1. e4 *\n\n' for g in range(n)))

    def run(checkpoint=place.checkpoint + "-dumps"):
        plans.start_dumps(spark, str(dumps), place.topic, place.letters, ledger, checkpoint, jobs.AVAILABLE_NOW, chunks=2).awaitTermination()

    drop("b", 5)
    run()
    drop("a", 4)  # later, though its name comes first
    run()
    run()
    run(checkpoint=place.checkpoint + "-fresh")  # the ledger knows all of them
    sent = [(int(r["GameID"]), r["White"]) for r in decode_payload(place.topic.read(spark)).collect()]
    assert sorted(sent) == [(g + 1, f"b{g}") for g in range(5)] + [(g + 6, f"a{g}") for g in range(4)]

    def crash(*args, real=plans.ingest, **options):
        real(*args, **options)
        raise RuntimeError("lost before the ledger")

    drop("c", 3)
    monkeypatch.setattr(plans, "ingest", crash)
    with pytest.raises(Exception, match="lost before the ledger"):
        run()
    monkeypatch.undo()
    drop("d", 2)
    run()
    load_table(spark, place.topic, place.table, place.checkpoint)
    got = {r["gameid"]: r["white"] for r in place.table.latest(spark).collect()}
    assert sorted(got) == list(range(1, 15)) and {got[g] for g in (10, 11, 12)} == {"c0", "c1", "c2"}


def test_progress_is_reported(spark, place):
    from gameflow.streaming.progress import ProgressLog

    place.topic.write(encode_messages(games(spark, 1, 5).withColumn("GameID", F.concat(F.lit("x"), "GameID"))))
    place.topic.write(encode_messages(games(spark, 6, 8)))
    progress = ProgressLog()
    spark.streams.addListener(progress)
    try:
        topic = file_topic(place.topic.read_options["path"], maxFilesPerTrigger="1")
        jobs.start_upsert(topic.read_stream(spark), place.table, place.checkpoint, jobs.AVAILABLE_NOW).awaitTermination()
        import time

        for _ in range(100):
            if sum(p.rows for p in progress.seen) == 8:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(progress)
    assert sum(p.rows for p in progress.seen) == 8 and sum(p.rejected for p in progress.seen) == 5
    assert len({p.batch_id for p in progress.seen if p.rows}) >= 2 and {p.lag for p in progress.seen} == {None}
