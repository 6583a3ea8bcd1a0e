"""Command line: ingest and administration."""

from __future__ import annotations

import argparse
import datetime as dt
import os
from collections.abc import Sequence


def utc_date(value: str) -> dt.datetime:
    """A date written exactly as YYYY-MM-DD."""
    try:
        day = dt.datetime.strptime(value, "%Y-%m-%d")
    except ValueError:
        day = None
    if day is None or f"{day:%Y-%m-%d}" != value:
        raise argparse.ArgumentTypeError(f"'{value}' is not a date like 2026-08-01")
    return day.replace(tzinfo=dt.UTC)


def _lake(args):
    from pyspark.sql import SparkSession

    from . import config
    from .sources.lake import open_store

    settings = config.from_file(config.config_path(args.config))
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    return settings, open_store(spark, settings.lake_dir, settings.data_lake.type, settings.data_lake.split_by)


def dump_reader(args) -> int:
    from .sources import dumps

    settings, lake = _lake(args)
    first = max(args.start_date.date(), settings.not_before.date()) if settings.not_before else args.start_date.date()
    dumps.ingest(lake, settings.ncep_dump.root_path, args.dump_id, first, args.end_date.date())
    return 0


def listener(args) -> int:
    from .streaming import notify

    settings, lake = _lake(args)
    under = lambda p: os.path.join(settings.root_dir, p)
    stream = notify.listen(lake.spark, lake, under(settings.wis2.landing_dir), under(settings.wis2.download_dir), under("listener-checkpoint"), settings.wis2.topic, seconds=settings.run_for_num_sec)
    if settings.run_for_num_sec is None:
        stream.awaitTermination()
    return 0


def admin(args) -> int:
    if args.list_ingestors:
        from .sources import decoders

        print(*decoders.directory(), sep="\n")
    if args.list_message_types:
        from . import config
        from .sources import decoders

        settings = config.from_file(config.config_path(args.config))
        for row in decoders.message_types(settings.bufr.catalogue) if settings.bufr else []:
            print(*row.values(), sep="\t")
    if args.list_data_types:
        print(*_lake(args)[1].list_data_types(), sep="\n")
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="aeroquarry", description="Spark-native observation lake.")
    top.add_argument("--config", help="path of the configuration file")
    commands = top.add_subparsers(dest="command", required=True)
    consumers = commands.add_parser("ingest", help="run an ingest").add_subparsers(dest="consumer", required=True)
    dump = consumers.add_parser("ncep_dump_reader", help="read dump files of a range of days")
    dump.add_argument("dump_id")
    dump.add_argument("start_date", type=utc_date)
    dump.add_argument("end_date", type=utc_date)
    dump.set_defaults(handler=dump_reader)
    consumers.add_parser("wis2_listener", help="listen for notifications").set_defaults(handler=listener)
    manage = commands.add_parser("admin", help="administration")
    manage.add_argument("--list-ingestors", action="store_true")
    manage.add_argument("--list-data-types", action="store_true")
    manage.add_argument("--list-message-types", action="store_true", help="of the catalogue that the settings name")
    manage.set_defaults(handler=admin)
    return top


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    return args.handler(args)


if __name__ == "__main__":
    raise SystemExit(main())
