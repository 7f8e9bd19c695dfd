"""Command line: ``python -m gameflow <command>``, also usable through spark-submit.

    ingest   PGN files to messages, optionally landed as CSV chunks
    send     landed CSV chunks to messages, batch by batch
    load     messages into the table; runs until stopped unless --once
    replay   dead letters to messages again
    listen   running count of messages; runs until stopped unless --once
    create   the table, if it does not exist
    compact  the newest version of each game as a table of its own
    count    number of games in the table
    show     games in the table
"""

from __future__ import annotations

import argparse

from gameflow.plans.ingest import ingest, replay
from gameflow.session import build_session
from gameflow.sinks.table import ConnectorTable, ParquetTable, create_store_sql
from gameflow.sources.csv_chunks import stream_chunks
from gameflow.sources.messages import file_topic, kafka_topic
from gameflow.streaming import jobs


def _pairs(items: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="gameflow", description=__doc__,
                                     formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--master", help="Spark master; leave out under spark-submit")
    commands = parser.add_subparsers(dest="command", required=True)

    topic = argparse.ArgumentParser(add_help=False)
    topic.add_argument("--servers", help="Kafka bootstrap servers; without it --topic is a folder")
    topic.add_argument("--topic", required=True)
    topic.add_argument("--topic-option", action="append", default=[], metavar="NAME=VALUE",
                       help="kafka.* options go to reader and writer, others to the reader")
    topic.add_argument("--producer-option", action="append", default=[], metavar="NAME=VALUE",
                       help="delivery setting of the writer")
    table = argparse.ArgumentParser(add_help=False)
    table.add_argument("--table", default="", help="folder of the table")
    table.add_argument("--table-format", help="connector format instead of a folder")
    table.add_argument("--table-option", action="append", default=[], metavar="NAME=VALUE")
    letters = argparse.ArgumentParser(add_help=False)
    letters.add_argument("--dead-letters", required=True)
    stream = argparse.ArgumentParser(add_help=False)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--once", action="store_true", help="stop when everything there is done")
    stream.add_argument("--interval", help="pause between batches, such as '5 seconds'")

    command = commands.add_parser("ingest", parents=[topic, letters])
    command.add_argument("pgn", nargs="+")
    command.add_argument("--games", type=int, help="only the first games")
    command.add_argument("--chunks", type=int, default=4)
    command.add_argument("--landing", help="folder for CSV chunks")
    command.add_argument("--label", default="ingest")
    command.add_argument("--start-at", type=int, default=0, help="games sent before, for new keys")
    command.add_argument("--after-table", help="number on from the largest key in the table of this folder")
    command.add_argument("--batch-size", type=int, help="send each chunk in batches of so many games")
    command.add_argument("--index", help="folder that keeps counts of games for later runs")
    command.add_argument("--opening", default="Event", help="tag that opens every game; 'any' cuts at empty lines")
    command = commands.add_parser("send", parents=[topic, letters, stream])
    command.add_argument("landing")
    command.add_argument("--files-per-batch")
    command = commands.add_parser("load", parents=[topic, table, stream])
    command.add_argument("--rejects", help="folder for rows whose key is no number")
    commands.add_parser("replay", parents=[topic, letters]).add_argument("--multi-line", action="store_true")
    commands.add_parser("listen", parents=[topic, stream]).add_argument("--counts", required=True)
    command = commands.add_parser("create", parents=[table])
    command.add_argument("--database", help="with --table-format: database, with its catalog prefix")
    command.add_argument("--name", default="game", help="with --table-format: name of the table")
    commands.add_parser("compact", parents=[table]).add_argument("target", help="new folder")
    commands.add_parser("count", parents=[table])
    commands.add_parser("show", parents=[table]).add_argument("--rows", type=int, default=20)
    return parser


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(master=args.master)
    if hasattr(args, "topic"):
        make = (lambda *a, **o: kafka_topic(args.servers, *a, **o)) if args.servers else file_topic
        producer = {"producer": _pairs(args.producer_option)} if args.servers else {}
        topic = make(args.topic, **producer, **_pairs(args.topic_option))
    if hasattr(args, "table"):
        options = _pairs(args.table_option)
        table = ConnectorTable(args.table_format, options) if args.table_format else ParquetTable(args.table)
    trigger = None
    if hasattr(args, "checkpoint"):
        trigger = jobs.AVAILABLE_NOW if args.once else args.interval and {"processingTime": args.interval}

    if args.command == "ingest":
        start_at = ParquetTable(args.after_table).last_key(spark) if args.after_table else args.start_at
        done = ingest(spark, args.pgn, topic, args.dead_letters, args.games, args.chunks, args.landing, args.label,
                      start_at, args.batch_size, None if args.opening == "any" else args.opening, index=args.index)
        return 1 if done.refused else 0
    if args.command == "send":
        options = {"maxFilesPerTrigger": args.files_per_batch} if args.files_per_batch else {}
        source = stream_chunks(spark, args.landing, **options)
        jobs.start_delivery(source, topic, args.dead_letters, args.checkpoint, trigger).awaitTermination()
    elif args.command == "load":
        jobs.start_upsert(topic.read_stream(spark), table, args.checkpoint, trigger, args.rejects).awaitTermination()
    elif args.command == "replay":
        done = replay(spark, args.dead_letters, topic, args.multi_line)
        print("\n".join([f"{done.sent} sent", *(f"damaged: {letter}" for letter in done.damaged)]))
        return 1 if done.damaged else 0
    elif args.command == "listen":
        jobs.start_count(topic.read_stream(spark), args.counts, args.checkpoint, trigger).awaitTermination()
        spark.read.parquet(args.counts).show()
    elif args.command == "create":
        if args.table_format:
            for statement in create_store_sql(args.database, args.name, args.table_format):
                spark.sql(statement)
        else:
            table.create(spark)
    elif args.command == "compact":
        table.compact(spark, args.target)
    elif args.command == "count":
        table.count(spark).show()
    elif args.command == "show":
        table.latest(spark).show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
