"""The two jobs from the command line, for ``spark-submit`` or ``python -m linewarden``.

    python -m linewarden extract --outages outages.csv --logs logs.parquet --out /data/extract
    python -m linewarden network --database network --incidents 1000000
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from linewarden.operators import generate
from linewarden.operators.clean import clean_outages
from linewarden.plans.jobs import NetworkSizes, run_extract, seed_network
from linewarden.plans.outage_reports import INPUT_COLUMNS
from linewarden.session import scratch_scope
from linewarden.sources import readers
from linewarden.sources.typed import read_csv_typed


def extract(spark: SparkSession, options: argparse.Namespace) -> None:
    """Read the outages and logs given; generate those that are not.

    Outages that cannot be read are an error unless ``--or-generate`` asks for a fallback.
    """
    def generated():
        return generate.outage_records(generate.ids(spark, options.rows))

    if not options.outages:
        raw, source = generated(), "generated"
    elif options.or_generate:
        raw, source, _ = readers.load_or_else(
            lambda: read_csv_typed(spark, options.outages).rows, generated, required=INPUT_COLUMNS
        )
    else:
        read = read_csv_typed(spark, options.outages)
        raw, source = read.rows, "primary"
        print(f"{read.rejects.count()} records with a value that does not fit")
    if options.logs:
        logs = readers.read_checked_parquet(spark, options.logs)
    else:
        logs = generate.incident_logs(clean_outages(raw).select("outage_id"))
    run = run_extract(raw, logs, options.out, options.database, options.publish)
    print(f"outages from the {source} source")
    run.metrics.show(truncate=False)
    for name, report in run.reports.items():
        print(name)
        report.show(truncate=False)


def network(spark: SparkSession, options: argparse.Namespace) -> None:
    """Create and fill the model's tables; a second run adds only what is missing."""
    sizes = NetworkSizes(options.towers, options.engineers, options.incidents, options.outages)
    run = seed_network(spark, options.database, options.location, sizes)
    for name, rows in run.rows_added.items():
        print(f"{name}: {rows} rows added")
    for name, report in run.reports.items():
        print(name)
        report.show(truncate=False)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="linewarden", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(required=True)

    command = commands.add_parser("extract", help=extract.__doc__)
    command.add_argument("--outages", help="CSV file or folder with a header row")
    command.add_argument("--rows", type=int, default=300, help="rows to generate otherwise")
    command.add_argument(
        "--or-generate", action="store_true", help="generate outages if the file cannot be read"
    )
    command.add_argument("--logs", help="parquet folder with outage_id and log_text")
    command.add_argument("--out", required=True, help="folder of the parquet extract")
    command.add_argument("--database", help="database of the two tables")
    command.add_argument("--publish", help="folder where both are published together")
    command.set_defaults(run=extract)

    command = commands.add_parser("network", help=network.__doc__)
    command.add_argument("--database", required=True)
    command.add_argument("--location", help="folder of a new database")
    for name, default in vars(NetworkSizes()).items():
        command.add_argument(f"--{name}", type=int, default=default)
    command.set_defaults(run=network)

    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("linewarden").getOrCreate()
    with scratch_scope(spark):
        options.run(spark, options)


if __name__ == "__main__":
    main()
