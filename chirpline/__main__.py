"""Command line: ``spark-submit run.py <job>`` or ``python -m chirpline <job>``.

land      CSV files -> tweet records in Parquet
publish   tweet records -> messages in a topic or a folder
batch     tweet records -> batch tables and a metric row
stream    messages -> running counts, raw tweets and a metric row
cards     messages -> one readable card per tweet, as JSON lines
compare   stored tables -> streaming and batch side by side, and the run metrics
compact   stored tables -> a copy with fewer, larger files
query     a SQL statement over the tweet records, known as ``tweets``
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from chirpline.operators.records import register, shape_records
from chirpline.plans.batch import run_batch
from chirpline.plans.comparison import comparisons, never_written
from chirpline.plans.live import run_live
from chirpline.plans.upkeep import compact
from chirpline.schema import ENDINGS
from chirpline.session import build_session, scratch
from chirpline.sources import csv, messages
from chirpline.sources.tables import JdbcTables, ParquetTables
from chirpline.streaming.queries import finish, start_cards


def parse(arguments: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(
        prog="chirpline", description=__doc__, formatter_class=argparse.RawTextHelpFormatter
    )
    jobs = parser.add_subparsers(dest="job", required=True)

    land = jobs.add_parser("land")
    land.add_argument("csv", help="file or folder of CSV files")
    land.add_argument("records", help="folder to write")
    land.add_argument("--large", action="store_true", help="read single files by many tasks")

    publish = jobs.add_parser("publish")
    publish.add_argument("records", help="folder of landed records")
    _topic(publish)

    batch = jobs.add_parser("batch")
    batch.add_argument("records", help="folder of landed records")
    batch.add_argument("--show", action="store_true", help="print the tables as well")
    _store(batch)

    stream = jobs.add_parser("stream")
    _topic(stream)
    _intake(stream)
    _store(stream)
    stream.add_argument("--shared", action="store_true", help="all outputs from one reading of the topic")
    stream.add_argument("--stored-as", choices=["current", "history", "changes"], default="current")
    stream.add_argument("--console", action="store_true", help="print the running counts as well")

    cards = jobs.add_parser("cards")
    _topic(cards)
    _intake(cards)
    cards.add_argument("out", help="folder of JSON lines to write")

    compare = jobs.add_parser("compare")
    _store(compare)
    _stored(compare)
    _result(compare, "a folder for each comparison")

    compaction = jobs.add_parser("compact")
    compaction.add_argument("--tables", required=True, help="folder of Parquet tables of a stopped stream")
    compaction.add_argument("into", help="new folder to write; the stream may go on with it")
    compaction.add_argument("--with-tweets", action="store_true", help="copy the raw tweets too")
    _stored(compaction)

    query = jobs.add_parser("query")
    query.add_argument("records", help="folder of landed records")
    query.add_argument("statement")
    _result(query, "the whole result")

    options = parser.parse_args(arguments)
    if options.job == "stream" and options.shared and (options.console or options.stored_as != "current"):
        stream.error("--shared stores increments and prints nothing; leave out --console and --stored-as")
    return options


def _topic(parser: argparse.ArgumentParser) -> None:
    where = parser.add_mutually_exclusive_group(required=True)
    where.add_argument("--servers", help="Kafka bootstrap servers")
    where.add_argument("--folder", help="folder of text files used as the topic")
    parser.add_argument("--topic", default="tweets", help="Kafka topic")
    parser.add_argument(
        "--option", action="append", default=[], type=_pair, metavar="NAME=VALUE", help="further option of the topic"
    )


def _pair(text: str) -> tuple[str, str]:
    name, equals, value = text.partition("=")
    if not name or not equals:
        raise argparse.ArgumentTypeError(f"{text!r} is not NAME=VALUE")
    return name, value


def _result(parser: argparse.ArgumentParser, what: str) -> None:
    parser.add_argument("--out", help=f"folder to write as Parquet: {what}")
    parser.add_argument("--rows", type=int, default=20, help="rows to print; it is said if there are more")


def _intake(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--checkpoint", required=True, help="folder that all executors reach")
    parser.add_argument("--per-trigger", type=int, help="offsets, or files of a folder, per batch")
    parser.add_argument("--min-partitions", type=int, help="tasks that share the offsets of a batch")
    parser.add_argument("--starting", default="earliest", help="offsets to start at without a checkpoint")
    parser.add_argument("--fail-on-data-loss", action="store_true", help="end with an error if offsets are lost")
    parser.add_argument("--until-done", action="store_true", help="work off what is there, then end")


def _store(parser: argparse.ArgumentParser) -> None:
    where = parser.add_mutually_exclusive_group(required=True)
    where.add_argument("--tables", help="folder of Parquet tables")
    where.add_argument("--jdbc", help="JDBC URL; the password is taken from JDBC_PASSWORD")
    parser.add_argument("--user", default="postgres", help="database user")
    parser.add_argument("--driver", default="org.postgresql.Driver", help="JDBC driver class")
    parser.add_argument("--connections", type=int, default=16, help="tasks that write at a time")


def _stored(parser: argparse.ArgumentParser) -> None:
    parser.add_argument(
        "--stored-as",
        choices=list(ENDINGS),
        default="current",
        help="how the stream has stored its counts; a shared one stores increments",
    )


def store_of(spark: SparkSession, options: argparse.Namespace) -> ParquetTables | JdbcTables:
    if options.tables:
        return ParquetTables(spark, options.tables)
    return JdbcTables(
        spark, options.jdbc, user=options.user, driver=options.driver, connections=options.connections
    )


def stream_of(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    if options.folder:
        return messages.stream_files(spark, options.folder, options.per_trigger)
    bounds = {"per_trigger": options.per_trigger} if options.per_trigger else {}
    return messages.stream_topic(
        spark,
        options.servers,
        options.topic,
        min_partitions=options.min_partitions,
        starting=options.starting,
        fail_on_data_loss=options.fail_on_data_loss,
        more=dict(options.option),
        **bounds,
    )


def give(df: DataFrame, options: argparse.Namespace, part: str = "") -> None:
    """Store a whole result if asked to, and print its first rows: of what is stored then, so it is made once."""
    if options.out:
        path = f"{options.out.rstrip('/')}/{part}".rstrip("/")
        df.write.parquet(path)
        stored = df.sparkSession.read.schema(df.schema).parquet(path)
        # the order in which the rows were written
        df = stored.orderBy("_metadata.file_name", "_metadata.row_index").select(df.columns)
    df.show(options.rows, truncate=False)


def run(spark: SparkSession, options: argparse.Namespace) -> None:
    if options.job == "land":
        if options.large:
            with scratch(spark, "csv") as work:
                csv.land(shape_records(csv.read_large_csv(spark, options.csv, work)), options.records)
        else:
            csv.land(shape_records(csv.read_csv(spark, options.csv)), options.records)
    elif options.job == "publish":
        records = spark.read.parquet(options.records)
        if options.folder:
            messages.publish_files(records, options.folder)
        else:
            messages.publish_topic(records, options.servers, options.topic, **dict(options.option))
    elif options.job == "batch":
        run_batch(spark.read.parquet(options.records), store_of(spark, options), show=options.show)
    elif options.job == "stream":
        choices = {} if options.shared else {"stored_as": options.stored_as, "console": options.console}
        if options.until_done:
            choices |= {"interval": None} | ({} if options.shared else {"console_interval": None})
        stream, store = stream_of(spark, options), store_of(spark, options)
        run_live(spark, stream, store, options.checkpoint, shared=options.shared, **choices)
    elif options.job == "cards":
        interval = {"interval": None} if options.until_done else {}
        finish([start_cards(stream_of(spark, options), options.out, options.checkpoint, **interval)])
    elif options.job == "compare":
        store = store_of(spark, options)
        for table in never_written(store, options.stored_as):
            print(f"never written, so counted as 0: {table}")
        for name, compared in comparisons(store, options.stored_as).items():
            print(name)
            give(compared.orderBy(compared["streaming_count"].desc(), compared.columns[0]), options, name)
        print("runs")
        give(store.read("performance_metrics"), options, "runs")
    elif options.job == "compact":
        source, target = ParquetTables(spark, options.tables), ParquetTables(spark, options.into)
        compact(source, target, options.stored_as, tweets=options.with_tweets)
    elif options.job == "query":
        register(spark.read.parquet(options.records))
        give(spark.sql(options.statement), options)


def main(arguments: list[str] | None = None) -> None:
    options = parse(arguments)
    spark = build_session(f"chirpline-{options.job}")
    try:
        run(spark, options)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
