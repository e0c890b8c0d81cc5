"""Run a program from the command line, as ``spark-submit`` or ``python -m hitscope``.

    report  --format current --log PATH [--out DIR] [--one-read DIR | --separately]
    alerts  --source kafka --option subscribe=access-log ... --checkpoint DIR [--one-read]
    status  --source kafka --option subscribe=access-log ... --checkpoint DIR --out DIR
    compact --path DIR --keys status --schema "status INT, requests BIGINT"
"""

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from hitscope.functions import two_decimals
from hitscope.operators import (
    parse_access_log,
    parse_basic_log,
    parse_extended_log,
    parse_stream_regex,
    parse_stream_tokens,
    status_counts,
)
from hitscope.plans import basic_program, current_program, extended_program, one_read_program, report_at_once, shared_path
from hitscope.sources import read_log_lines, read_log_stream
from hitscope.streaming import (
    append_batch,
    await_all,
    compact_changelog,
    print_batch,
    start_alerts,
    start_all_alerts,
    start_query,
    stream_session,
)

_PROGRAMS = {"current": current_program, "extended": extended_program, "basic": basic_program}
_PARSERS = {"current": parse_access_log, "extended": parse_extended_log, "basic": parse_basic_log}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="hitscope", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)

    report = commands.add_parser("report", help="all analyses of a log")
    report.add_argument("--log", required=True, nargs="+", help="files, folders or globs")
    report.add_argument("--format", choices=_PROGRAMS, default="current")
    report.add_argument("--out", help="write one parquet table per analysis here instead of printing all rows")
    report.add_argument("--overwrite", action="store_true", help="replace what --out and --one-read hold")
    report.add_argument("--one-read", metavar="DIR", help="counting analyses only, from one read; keep the counts here")
    report.add_argument("--separately", action="store_true", help="read the log once per analysis and keep no counts")

    for name, text in (("alerts", "the three alerts on a stream"), ("status", "running count per status")):
        stream = commands.add_parser(name, help=text)
        stream.add_argument("--source", default="kafka")
        stream.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
        stream.add_argument("--checkpoint", required=True)
        stream.add_argument("--out", help="folder for the changelog, else all rows are printed")
        stream.add_argument("--sink-format", default="parquet", help="format of --out, or of a store without a path")
        stream.add_argument("--sink-option", action="append", default=[], metavar="KEY=VALUE", help="of that format")
        stream.add_argument("--files", type=int, help="files for each micro-batch in --out")
        stream.add_argument("--trigger", metavar="INTERVAL", help="time between micro-batches, such as '1 minute'")
        stream.add_argument("--state-partitions", type=int)
        stream.add_argument("--until-caught-up", action="store_true", help="stop at the end of the input")
        stream.add_argument("--ledger", metavar="DIR", help="note batches here, so that a store without a path gets each once")
        if name == "alerts":
            stream.add_argument("--watermark", help="lateness to allow for, such as '10 minutes'")
            stream.add_argument("--one-read", action="store_true", help="one query for all three, with one read and one state")
            stream.add_argument("--once", action="store_true", help="tell each alert once, when its limit is crossed; one query for all three")

    compact = commands.add_parser("compact", help="fold the closed batches of a changelog")
    compact.add_argument("--path", required=True, help="folder of the changelog")
    compact.add_argument("--keys", required=True, help="columns that identify a row, with commas")
    compact.add_argument("--schema", required=True, help="columns of the changelog without batch_id, such as 'status INT, requests BIGINT'")
    compact.add_argument("--up-to", type=int, help="last batch to fold; the last but one if not given")
    compact.add_argument("--sink-format", default="parquet")
    return parser.parse_args(argv)


def _for_display(result: DataFrame) -> DataFrame:
    means = [f.name for f in result.schema if f.dataType.typeName() == "double"]
    return result.withColumns({name: two_decimals(F.col(name)) for name in means})


def _report(spark: SparkSession, args: argparse.Namespace) -> None:
    lines = read_log_lines(spark, args.log)
    mode = "overwrite" if args.overwrite else "errorifexists"
    if args.one_read:
        reports = one_read_program(_PARSERS[args.format](lines), args.one_read, mode)
    elif args.separately:
        reports = _PROGRAMS[args.format](lines)
    else:
        counts = f"{args.out.rstrip('/')}/_counts" if args.out else shared_path(spark, "report")
        reports = report_at_once(lines, args.format, counts, mode)
    for name, result in reports.items():
        if args.out:
            result.write.mode(mode).parquet(f"{args.out.rstrip('/')}/{name}")
        else:
            shown = _for_display(result)
            print(name, *shown.columns, sep="\t")
            for row in shown.toLocalIterator():
                print(*row, sep="\t")


def _stream(spark: SparkSession, args: argparse.Namespace) -> None:
    options, sink_options = (dict(o.split("=", 1) for o in given) for given in (args.option, args.sink_option))
    session = stream_session(spark, args.state_partitions)
    messages = read_log_stream(session, args.source, options)
    trigger = {"processingTime": args.trigger} if args.trigger else None
    if args.until_caught_up:
        trigger = {"availableNow": True}

    def sink(name: str):
        if args.out:
            return append_batch(args.sink_format, f"{args.out.rstrip('/')}/{name}", args.files, **sink_options)
        store = sink_options or args.ledger
        return append_batch(args.sink_format, files=args.files, ledger=args.ledger, **sink_options) if store else print_batch

    if args.command == "alerts" and args.once:
        from hitscope.streaming.crossings import alerts_once  # needs pandas

        alerts = alerts_once(parse_stream_tokens(messages), watermark=args.watermark or "10 minutes")
        checkpoint = f"{args.checkpoint.rstrip('/')}/alerts_once"
        queries = [start_query(alerts, "alerts_once", checkpoint, sink("alerts_once"), trigger=trigger)]
    elif args.command == "alerts" and args.one_read:
        logs = parse_stream_tokens(messages)
        queries = [start_all_alerts(logs, args.checkpoint, sink("all_alerts"), trigger=trigger, watermark=args.watermark)]
    elif args.command == "alerts":
        queries = start_alerts(
            parse_stream_tokens(messages), args.checkpoint, sink, trigger=trigger, watermark=args.watermark
        )
    else:
        counts = status_counts(parse_stream_regex(messages))
        checkpoint = f"{args.checkpoint.rstrip('/')}/status_counts"
        queries = [start_query(counts, "status_counts", checkpoint, sink("status_counts"), trigger=trigger)]
    await_all(queries)


def _compact(spark: SparkSession, args: argparse.Namespace) -> None:
    schema = spark.createDataFrame([], args.schema).schema
    print(compact_changelog(spark, args.path, args.keys.split(","), schema, args.up_to, args.sink_format))


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName("hitscope").getOrCreate()
    {"report": _report, "compact": _compact}.get(args.command, _stream)(spark, args)


if __name__ == "__main__":
    main()
