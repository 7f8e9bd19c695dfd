from gameflow.__main__ import main
from gameflow.sources.csv_chunks import write_chunks
from tests.test_delivery import games
from pyspark.sql import functions as F


def test_commands_from_pgn_to_table(spark, tmp_path, capfd):
    text = "".join(f'[Event "x"]\n[White "w{g}"]\n\n1. e4 *\n\n' for g in range(10))
    (tmp_path / "a.pgn").write_text(text)
    place = {name: str(tmp_path / name) for name in ("topic", "letters", "table", "ckpt", "landing", "counts")}
    topic = ["--topic", place["topic"]]
    letters = ["--dead-letters", place["letters"]]
    assert main(["ingest", str(tmp_path / "a.pgn"), *topic, *letters, "--games", "8", "--landing", place["landing"]]) == 0
    assert main(["load", *topic, "--table", place["table"], "--checkpoint", place["ckpt"], "--once"]) == 0
    assert main(["listen", *topic, "--counts", place["counts"], "--checkpoint", place["ckpt"] + "-n", "--once"]) == 0
    assert main(["replay", *topic, *letters]) == 0
    assert main(["count", "--table", place["table"]]) == 0
    assert main(["show", "--table", place["table"], "--rows", "2"]) == 0
    out = capfd.readouterr().out
    assert "|  8|" in out and "gameid" in out

    write_chunks(games(spark, 100, 104).withColumn("chunk", F.lit(0).cast("bigint")), place["landing"] + "2")
    assert main(["send", place["landing"] + "2", *topic, *letters, "--checkpoint", place["ckpt"] + "-s", "--once"]) == 0
    assert main(["load", *topic, "--table", place["table"], "--checkpoint", place["ckpt"], "--once"]) == 0
    assert main(["count", "--table", place["table"]]) == 0
    assert "| 13|" in capfd.readouterr().out
    assert main(["create", "--table", place["table"]]) == 0
    assert main(["compact", "--table", place["table"], place["table"] + "-compact"]) == 0
    assert main(["create", "--table", place["table"] + "-new"]) == 0
    assert main(["count", "--table", place["table"] + "-compact"]) == 0
    assert main(["count", "--table", place["table"] + "-new"]) == 0
    out = capfd.readouterr().out
    assert "| 13|" in out and "|  0|" in out

    # A second dump is numbered on from what the table holds.
    assert main(["ingest", str(tmp_path / "a.pgn"), *topic, *letters, "--after-table", place["table"], "--batch-size", "4", "--index", place["landing"] + "-index"]) == 0
    assert main(["load", *topic, "--table", place["table"], "--checkpoint", place["ckpt"], "--once"]) == 0
    assert main(["count", "--table", place["table"]]) == 0
    assert "| 23|" in capfd.readouterr().out
