"""Command line of the daily batch: `python -m cinestar --help`, or with spark-submit."""

from __future__ import annotations

import argparse
import dataclasses
import importlib

from cinestar.plans.daily import DailyConfig, run_daily
from cinestar.session import build_session


def parse_config(arguments: list[str] | None = None) -> DailyConfig:
    parser = argparse.ArgumentParser(prog="cinestar", description=run_daily.__doc__)
    for name in ("movies-csv", "credits-csv", "keywords-csv", "ratings-csv", "lake", "run-date"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--database", default="films")
    parser.add_argument("--policy", default="exact", help="how collection cells are cleaned")
    parser.add_argument("--buckets", type=int, help="default: spark.sql.shuffle.partitions")
    parser.add_argument("--companies-csv", help="companies as an export of their own")
    parser.add_argument("--links-csv", help="pairs of rating id and film id")
    parser.add_argument("--multiline", action="store_true", help="line breaks in keywords, ratings")
    parser.add_argument("--slices", type=int, default=5, help="parallel poster lookups")
    parser.add_argument("--open-resolver", help="module:function that opens a poster resolver")
    parser.add_argument("--poster-table", help="Parquet table of poster locations")
    parser.add_argument("--poster-features", help="Parquet table of poster features")
    options = vars(parser.parse_args(arguments))
    if options["open_resolver"]:
        module, _, function = options["open_resolver"].partition(":")
        options["open_resolver"] = getattr(importlib.import_module(module), function)
    known = {field.name for field in dataclasses.fields(DailyConfig)}
    return DailyConfig(**{name: value for name, value in options.items() if name in known})


if __name__ == "__main__":
    run_daily(build_session(), parse_config())
