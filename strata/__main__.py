"""Command line: run the layers over a folder of extracts, or export a table.

    python -m strata run --raw RAW --lake LAKE --reference-year 2024 [--incremental]
    python -m strata export --lake LAKE --output OUT [--year 2023] [--files 1]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from strata.operators import export
from strata.plans.pipeline import Pipeline
from strata.plans.registry import Options
from strata.sources.layers import Layers
from strata.sources.readers import resolve_extracts


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="strata", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)

    run = commands.add_parser("run", help="raw files to gold tables, analyses and reports")
    run.add_argument("--raw", required=True)
    run.add_argument("--lake", required=True)
    run.add_argument("--reference-year", type=int, required=True, help="year ages are counted to")
    run.add_argument("--years", type=int, nargs="*", help="only these fiscal years")
    run.add_argument("--incremental", action="store_true", help="skip years stored already")
    run.add_argument("--no-analysis", action="store_true")

    out = commands.add_parser("export", help="shareable extract of a stored layer")
    out.add_argument("--lake", required=True)
    out.add_argument("--output", required=True)
    out.add_argument("--year", type=int, help="one bronze year instead of all of silver")
    out.add_argument("--files", type=int, help="number of files, for small extracts")
    return parser.parse_args(given)


def main(given: list[str] | None = None) -> None:
    args = arguments(given)
    spark = SparkSession.builder.appName("strata").getOrCreate()
    layers = Layers(spark, args.lake)
    if args.command == "export":
        source = layers.silver if args.year is None else layers.bronze
        export.write_refined(layers.read(source), args.output, args.year, args.files)
        return
    extracts = resolve_extracts(spark, args.raw)
    if args.years:
        extracts = extracts.only(args.years)
    pipeline = Pipeline(layers, Options(args.reference_year))
    pipeline.run(args.raw, extracts, args.incremental, run_analysis=not args.no_analysis)


if __name__ == "__main__":
    main()
