"""The two batch jobs, run as ``python -m midyear.jobs``.

``population``  three cell tables in, population snapshot out
``under-five``  birth and death records, places and that snapshot in, one ordered CSV report out
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from midyear.plans.population import population_table
from midyear.plans.vital import place_names, report_order, vital_table
from midyear.session import build_session
from midyear.sources import scans, snapshots
from midyear.sources.shared import run_folder


def population_job(spark: SparkSession, cells_2000: str, cells_2011: str, cells_2016: str,
                   out: str) -> None:
    """Build the population table of all years and put them into the snapshot, old years of that name replaced."""
    books = [scans.read_cells(spark, path) for path in (cells_2000, cells_2011, cells_2016)]
    snapshots.write_years(population_table(*books), out)


def under_five_job(spark: SparkSession, records: str, places: str, snapshot: str, out: str,
                   record_format: str = "parquet", code: str = "cod_muni",
                   name: str = "municipio") -> None:
    """Write the under-five report as one ordered CSV file.

    ``records`` is a folder whose file names contain ``births`` or ``deaths`` and the year; the
    places have the format of the records.
    """
    options = {"header": "true"} if record_format == "csv" else {}
    births = scans.read_records(spark, records, "births", record_format, **options)
    deaths = scans.read_records(spark, records, "deaths", record_format, **options)
    lookup = place_names(spark.read.format(record_format).options(**options).load(places), code, name)
    report = vital_table(births, deaths, lookup, snapshots.read_snapshot(spark, snapshot))
    snapshots.write_ordered_csv(report_order(report), out)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    population = jobs.add_parser("population")
    for name in ("cells_2000", "cells_2011", "cells_2016", "out"):
        population.add_argument(name)
    under_five = jobs.add_parser("under-five")
    for name in ("records", "places", "snapshot", "out"):
        under_five.add_argument(name)
    under_five.add_argument("--format", default="parquet", dest="record_format")
    chosen = vars(parser.parse_args(arguments))
    run = {"population": population_job, "under-five": under_five_job}[chosen.pop("job")]
    spark = build_session("midyear")
    with run_folder(spark):
        run(spark, **chosen)


if __name__ == "__main__":
    main()
