"""The command line: a run over a seed file, listing pages or profile pages.

``python -m rosterforge.cli --input seeds.csv --pages captured.parquet``; with
none of the three sources it asks for one. Pages come from ``--pages`` (a table
of captured pages) or are fetched.
"""

from __future__ import annotations

import argparse
import datetime
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from .functions import rules
from .plans import pipeline
from .sources import capture, files

SOURCES = ("input", "list_page_url", "profile_url")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="rosterforge", description="Template rows from seed files, listing pages or profile pages.")
    out.add_argument("--input", default="", help="CSV file of seeds")
    out.add_argument("--list-page-url", default="", help="address of a listing page")
    out.add_argument("--profile-url", default="", help="address of a profile page")
    out.add_argument("--output", default="", help="CSV file written; inferred from school, college and day if left out")
    out.add_argument("--root", default="output", help="folder under which an inferred output lies")
    out.add_argument("--collector", default="", help="who collects")
    out.add_argument("--date", default="", help="day of collection, today if left out")
    out.add_argument("--school", default="")
    out.add_argument("--college", default="")
    out.add_argument("--concurrency", type=int, default=5, help=f"tasks that fetch at once, {capture.LEAST} to {capture.MOST}")
    out.add_argument("--limit", type=int, default=None, help="most rows read of a source")
    out.add_argument("--log", default="", help="folder of the run's log; beside the output if left out")
    out.add_argument("--pages", default="", help="table of captured pages (url, html) instead of fetching")
    return out


def asked(given: argparse.Namespace, ask: Callable[[str], str]) -> argparse.Namespace:
    """With no source given, asks for one and tells by its looks which it is."""
    if any(getattr(given, s) for s in SOURCES):
        return given
    source = ask("CSV file, listing page or profile page: ").strip()
    if not source.lower().startswith(("http://", "https://")):
        given.input = source
    elif ask("Is it a listing page? [y/n] ").strip().lower().startswith("y"):
        given.list_page_url = source
    else:
        given.profile_url = source
    return given


def run(spark: SparkSession, given: argparse.Namespace, fetch: Callable[[str, float], str] = capture.fetched) -> dict:
    """The run's counters; rows are written as one CSV file, and the log beside it."""
    if not any(getattr(given, s) for s in SOURCES):
        raise ValueError("one of --input, --list-page-url and --profile-url is needed")
    told = pipeline.Run(given.collector, given.date or datetime.date.today().isoformat(), given.school, given.college, given.limit)

    def pages_of(urls: DataFrame, seconds: float) -> DataFrame:
        if given.pages:
            return files.read_pages(spark, given.pages)
        return capture.captured(urls, "url", seconds, given.concurrency, fetch).where("html IS NOT NULL").select("url", "html")

    def only(url: str) -> DataFrame:
        return pages_of(spark.createDataFrame([(url,)], "url string"), 20).where(f"url = '{url}'")

    if given.input:
        records = pipeline.seed_records(files.read_ragged_csv(spark, given.input), told)
    elif given.list_page_url:
        records = pipeline.listing_records(only(given.list_page_url), told)
    else:
        records = pipeline.profile_records(only(given.profile_url), told)
    done = pipeline.run(records, pages_of(records.selectExpr("profile_url AS url"), 15), told)
    path = given.output or files.output_path(given.root, told.day, told.school, told.college, (given.input or given.list_page_url or given.profile_url).rstrip("/").rpartition("/")[2].rpartition(".")[0])
    counters = done["counters"].first().asDict()
    files.write_small_csv(done["rows"].orderBy("seq").select("seq", *rules.REQUIRED), files.csv_path(path), rules.HEADERS)
    log = given.log or files.log_path(given.root, path).removesuffix(".json")
    files.write_run_log(log, counters, done["log"])
    return counters | {"output": files.csv_path(path), "log": log}


def main(arguments: Sequence[str] | None = None) -> None:
    given = parser().parse_args(arguments)
    if sys.stdin.isatty():
        given = asked(given, input)
    print(run(SparkSession.builder.getOrCreate(), given))


if __name__ == "__main__":
    main()
