"""The jobs: ``python -m playledger {ingest,dispatch,recap,report} ...``, or with spark-submit."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from playledger.functions import moment
from playledger.operators.report import final_report
from playledger.plans import recap_table, report_bodies
from playledger.session import build_session
from playledger.schemas import FACT_TABLE, TABLES
from playledger.sources import (
    REJECTS_TABLE,
    FolderTopics,
    FolderWarehouse,
    JdbcWarehouse,
    KafkaTopics,
)
from playledger.sources import stream_history, stream_pages
from playledger.streaming import BatchMetrics, Redelivery, dispatch, ingest, run_until_stopped


def _options(pairs: Sequence[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _warehouse(args: argparse.Namespace) -> FolderWarehouse | JdbcWarehouse:
    if args.jdbc:
        reads = {table: _options(pairs) for table, *pairs in args.jdbc_read or ()}
        return JdbcWarehouse(_options(args.jdbc), reads, args.idempotent)
    return FolderWarehouse(args.warehouse, args.idempotent, keep_counts=args.counts)


def _topics(args: argparse.Namespace) -> FolderTopics | KafkaTopics:
    if args.servers:
        return KafkaTopics(args.servers, starting_offsets=args.starting_offsets,
                           extra=_options(args.kafka or ()), max_offsets=args.max_offsets)
    return FolderTopics(args.topics, args.max_files, args.max_bytes)


def _trigger(args: argparse.Namespace) -> dict[str, object]:
    return {"availableNow": True} if args.once else {"processingTime": f"{args.every} seconds"}


def _ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.history:
        pages = stream_history(spark, args.history, args.after)
    else:
        pages = stream_pages(spark, args.pages, args.max_files, args.max_bytes, args.archive)
    run_until_stopped(
        ingest(pages, _warehouse(args), args.entities, _topics(args), args.checkpoint,
               _trigger(args))
    )


def _redelivery(args: argparse.Namespace) -> Redelivery | None:
    return Redelivery(args.staged, args.redelivery) if args.staged else None


def _dispatch(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.metrics:
        spark.streams.addListener(BatchMetrics(spark, args.metrics))
    run_until_stopped(
        dispatch(_topics(args).read_stream(spark), _warehouse(args), args.checkpoint,
                 _trigger(args), unique_dims=not args.as_is, keep_rejects=not args.as_is,
                 compact_every=args.compact_every, redelivery=_redelivery(args))
    )


def _settle(spark: SparkSession, args: argparse.Namespace) -> None:
    again = Redelivery(args.staged, args.redelivery)
    run_until_stopped(again.settle(spark, _warehouse(args), args.checkpoint, _trigger(args), args.max_files))


def _compact(spark: SparkSession, args: argparse.Namespace) -> None:
    for table in (*TABLES, REJECTS_TABLE):
        _warehouse(args).compact(spark, table)


def _recap(spark: SparkSession, args: argparse.Namespace) -> None:
    warehouse = _warehouse(args)
    counted = isinstance(warehouse, FolderWarehouse) and args.counts
    table = recap_table(warehouse.counted_star(spark) if counted else warehouse.star(spark), args.as_of)
    table.write.mode("overwrite").parquet(args.out)


def _report(spark: SparkSession, args: argparse.Namespace) -> None:
    bodies = report_bodies(_warehouse(args).star(spark), [args.as_of])
    if args.replies:
        replies = spark.read.schema("reply STRING").text(args.replies, wholetext=True)
        replies = replies.withColumn("as_of", moment(args.as_of).cast("date"))
        bodies = final_report(bodies, replies)
    bodies.write.mode("overwrite").parquet(args.out)


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="playledger", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    store = argparse.ArgumentParser(add_help=False)
    store.add_argument("--warehouse", help="root folder of the warehouse tables")
    store.add_argument("--jdbc", nargs="+", metavar="KEY=VALUE",
                       help="options of the JDBC source, for a warehouse in a database")
    store.add_argument("--jdbc-read", nargs="+", action="append", metavar=("TABLE", "KEY=VALUE"),
                       help="options for a parallel read of one table of the database")
    store.add_argument("--idempotent", action="store_true",
                       help="append a play only if no equal one is stored")

    store.add_argument("--counts", action="store_true",
                       help="keep counts of plays per batch in the folder; recaps read them")

    again = argparse.ArgumentParser(add_help=False)
    again.add_argument("--redelivery", default="2 hours", help="how late a play may come")
    stream = argparse.ArgumentParser(add_help=False)
    stream.add_argument("--servers", help="broker addresses")
    stream.add_argument("--starting-offsets", default="latest")
    stream.add_argument("--kafka", nargs="+", metavar="KEY=VALUE", help="broker client settings")
    stream.add_argument("--max-offsets", type=int, help="records per batch, from a broker")
    stream.add_argument("--topics", help="folder of topic records, in place of a broker")
    stream.add_argument("--max-files", type=int, help="files per batch")
    stream.add_argument("--max-bytes", type=int, help="bytes of files per batch")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--every", type=int, default=60, help="seconds between batches")
    stream.add_argument("--once", action="store_true", help="take what is there, then end")

    job = jobs.add_parser("ingest", parents=[store, stream], help="history pages to topics")
    pages = job.add_mutually_exclusive_group(required=True)
    pages.add_argument("--pages", help="folder of history pages")
    pages.add_argument("--history", help="plays of the history service, read by their time")
    job.add_argument("--after", type=int, help="where a new query begins, in epoch milliseconds; default: now")
    job.add_argument("--entities", required=True, help="root folder of entity details")
    job.add_argument("--archive", help="folder to which pages move once they are published")
    job.set_defaults(run=_ingest)

    job = jobs.add_parser("dispatch", parents=[store, stream, again], help="topics to warehouse")
    job.add_argument("--staged", help="folder where plays are staged, for settle to append each once")
    job.add_argument("--metrics", help="folder of a table of counts per batch")
    job.add_argument("--as-is", action="store_true",
                     help="append every row: keep copies of dimension keys and rows without key")
    job.add_argument("--compact-every", type=int, default=0, metavar="N",
                     help="merge the stored batches before every Nth batch")
    job.set_defaults(run=_dispatch)

    job = jobs.add_parser("settle", parents=[store, again], help="staged plays to warehouse, each once")
    job.add_argument("--staged", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--max-files", type=int, help="files per batch")
    job.add_argument("--every", type=int, default=60, help="seconds between batches")
    job.add_argument("--once", action="store_true", help="take what is there, then end")
    job.set_defaults(run=_settle)

    job = jobs.add_parser("compact", parents=[store],
                          help="merge the stored batches, while no dispatch runs")
    job.set_defaults(run=_compact)

    for name, run in (("recap", _recap), ("report", _report)):
        job = jobs.add_parser(name, parents=[store], help=f"write the {name} of one week")
        job.add_argument("--as-of", help="date in the week; default: today, UTC")
        job.add_argument("--out", required=True)
        job.set_defaults(run=run)
    job.add_argument("--replies", help="file with the reply of the text service")

    args = parser.parse_args(argv)
    if not (args.warehouse or args.jdbc):
        parser.error("give --warehouse or --jdbc")
    if "servers" in args and not (args.servers or args.topics):
        parser.error("give --servers or --topics")
    reads = {table for table, *_ in args.jdbc_read or ()}
    if args.jdbc and args.job in ("recap", "report") and FACT_TABLE not in reads:
        parser.error(f"give --jdbc-read {FACT_TABLE} with a partitionColumn, bounds and numPartitions")
    args.run(build_session(f"playledger {args.job}"), args)


if __name__ == "__main__":
    main()
