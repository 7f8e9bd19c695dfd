import datetime

from pyspark.sql import functions as F

from gameflow.operators.decode import select_games, to_table_types
from gameflow.sources.csv_chunks import read_chunk_files, read_chunks, write_chunks
from gameflow.sources.messages import encode_messages, kafka_topic
from gameflow.schema import MESSAGE_FIELDS

PAYLOADS = [
    '{"GameID":1,"Date":"2024.09.01","Moves":["e2e4","e7e5"]}',
    '{"GameID":2,"WhiteElo":1500.0,"Round":NaN,"Moves":"[\'e2e4\']"}',
    '{"GameID":3,"Date":"????.??.??","Moves":[]}',
    '{"GameID":"x7","Extra":1}',
    '{"gameid":4}', '{"Date":"2024.09.01"}', "not json", "", None,
    '{"GameID":5,"Date":"2024.09.31"}',
]


def messages(spark, payloads=PAYLOADS):
    return spark.createDataFrame([(p,) for p in payloads], "value string").select(F.col("value").cast("binary"))


def test_fixture_payloads(spark):
    games = {r["gameid"]: r for r in select_games(messages(spark)).collect()}
    assert sorted(games) == ["1", "2", "3", "5", "x7"]
    assert games["1"]["date"] == datetime.date(2024, 9, 1) and len(games["1"]["moves"]) == 2
    assert games["2"]["moves"] is None and games["2"]["round"] is None and games["2"]["whiteelo"] == "1500.0"
    assert games["3"]["date"] is None and games["3"]["moves"] == []
    assert games["5"]["date"] is None
    typed = {r["gameid"]: r for r in to_table_types(select_games(messages(spark))).collect()}
    assert set(typed) == {1, 2, 3, 5, None}
    assert typed[2]["whiteelo"] == 1500 and typed[1]["moves"] == "e2e4 e7e5" and typed[2]["moves"] is None


def test_each_payload_is_parsed_once(spark):
    plan = select_games(messages(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_messages_keep_null_fields(spark):
    game = spark.createDataFrame([(1, None, ["e4"])], "GameID long, Variant string, Moves array<string>")
    for field in MESSAGE_FIELDS:
        if field not in game.columns:
            game = game.withColumn(field, F.lit(""))
    text = encode_messages(game).select(F.col("value").cast("string")).first()[0]
    assert '"Variant":null' in text and '"Moves":["e4"]' in text and text.startswith('{"GameID":1,')


def test_csv_keeps_empty_missing_quotes_and_lists(spark, tmp_path):
    base = {f: "" for f in MESSAGE_FIELDS}
    records = [
        base | {"GameID": "1", "White": 'a "q", b', "Round": None, "Moves": ["e4", 'x"y', "é"], "chunk": 0},
        base | {"GameID": "2", "White": "back\\slash", "Moves": [], "chunk": 0},
        base | {"GameID": "3", "White": " spaces ", "Moves": None, "chunk": 3},
    ]
    schema = ", ".join(f"{f} array<string>" if f == "Moves" else f"{f} string" for f in MESSAGE_FIELDS)
    frame = spark.createDataFrame(records, schema + ", chunk long")
    write_chunks(frame, str(tmp_path / "c"))
    back = read_chunks(spark, str(tmp_path / "c")).select(*frame.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, frame.collect()))


def test_csv_of_other_writers(spark, tmp_path):
    header = ",".join(MESSAGE_FIELDS)
    (tmp_path / "games_0_2.csv").write_text(
        f"{header}\n1,2024.09.01,00:00:07,-,\"a \"\"q\"\"\",b,180+0,1-0,1500,1400,\"['e2e4', 'e7e5']\",\n"
    )
    row = read_chunk_files(spark, str(tmp_path / "games_0_2.csv")).first()
    assert row["White"] == 'a "q"' and row["Moves"] == ["e2e4", "e7e5"] and row["Variant"] is None


def test_kafka_settings():
    topic = kafka_topic("b1:9092,b2:9092", "games", maxOffsetsPerTrigger="500")
    assert topic.read_options["subscribe"] == "games" and topic.read_options["startingOffsets"] == "earliest"
    assert topic.write_options["kafka.acks"] == "all" and topic.write_options["topic"] == "games"
    assert topic.read_options["kafka.bootstrap.servers"] == "b1:9092,b2:9092"
