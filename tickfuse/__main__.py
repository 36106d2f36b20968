"""Command line: queries of the catalogue, decoding of raw files, pairing of singles.

    python -m tickfuse list
    python -m tickfuse run QUERY TABLES OUT
    python -m tickfuse decode RAW_FOLDER OUT [--config FILE]
    python -m tickfuse pair SINGLES OUT [--config FILE]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import schemas
from .operators import filters, interval_join
from .plans import offline, sinks


def arguments(argv: list[str] | None) -> argparse.Namespace:
    top = argparse.ArgumentParser(prog="tickfuse", description="Time-stamped detector events on Spark")
    commands = top.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of all queries")
    run = commands.add_parser("run", help="write a query's rows as Parquet")
    run.add_argument("query")
    for name, what in (("run", "tables"), ("decode", "raw folder"), ("pair", "singles")):
        p = run if name == "run" else commands.add_parser(name)
        p.add_argument("source", help=what)
        p.add_argument("out")
        if name != "run":
            p.add_argument("--config", help="JSON file of its section")
    return top.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    if args.command == "list":
        from .plans.catalogue import QUERIES

        print(*sorted(QUERIES), sep="\n")
        return
    spark = SparkSession.builder.appName(f"tickfuse {args.command}").getOrCreate()
    if args.command == "run":
        from .plans.catalogue import QUERIES

        QUERIES[args.query](spark, args.source).write.parquet(args.out)
    elif args.command == "decode":
        config = schemas.load_config(schemas.R2SConfig, args.config or {})
        sinks.write_singles(offline.raw_files_to_singles(spark, args.source, config), args.out)
    else:
        config = schemas.load_config(schemas.AlignerConfig, args.config or {})
        protocol = config.protocol
        s = filters.energy_window(spark.read.parquet(args.source), protocol.energy_lower_ev, protocol.energy_upper_ev).withColumn("t", F.col("time_100fs"))
        if "id" not in s.columns:  # an order among singles of one time
            s = s.withColumn("id", F.xxhash64("channel", "crystal", "time_100fs", "energy"))
        sinks.write_coincidences(interval_join.coincidences(s, protocol.window, protocol.delay, config.channel_num), args.out, config)


if __name__ == "__main__":
    main()
