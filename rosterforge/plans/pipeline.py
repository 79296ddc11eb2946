"""The runs: from seed files, listing pages or profile pages to template rows, and the day's summary."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import org, rules, title
from ..functions.names import clean_name, name_of_page
from ..functions.text import compact, norm_ws, truncate
from ..functions.url import path_stem
from ..operators import enrich, merge, pages as page_operators, report, seeds
from ..operators.common import checkpointed, looked_up, numbered
from ..sources import files, workbook


@dataclass(frozen=True)
class Run:
    """What a run is told: who collects, for which day, and the organisation if it is known."""

    collector: str = ""
    day: str = ""
    school: str = ""
    college: str = ""
    limit: int | None = None
    impute_title: bool = True
    merge_duplicates: bool = True


def projected(records: DataFrame, run: Run, order: str = "ord") -> DataFrame:
    """Records as rows of the template, with ``title_imputed``; a blank rank beside an address is taken for a full one."""
    rank = title.normalise("title")
    imputed = F.lit(run.impute_title) & (rank == "") & (norm_ws("email") != "")
    values = {
        "name": clean_name("name"), "title": F.when(imputed, "教授").otherwise(rank), "email": F.col("email"), "school": F.col("school"), "college": F.col("college"),
        "collector": F.lit(run.collector), "collected_at": F.lit(run.day), "intro": truncate(norm_ws("intro"), 200), "profile_url": F.col("profile_url"),
    }
    return records.select(F.col(order), *[compact(v).alias(c) for c, v in values.items()], imputed.alias("title_imputed"))


def exported(records: DataFrame, run: Run) -> tuple[DataFrame, DataFrame]:
    """Valid template rows numbered from 1, and the counters of the run."""
    rows = projected(records, run)
    return numbered(rows.where(merge.is_valid_row()), ["ord"], "seq"), report.counters(rows)


def _ordered(records: DataFrame) -> DataFrame:
    return numbered(records, ["source", "ord", "part"], "_n").withColumn("ord", F.col("_n") - 1).drop("_n")


def seed_records(cells: DataFrame, run: Run) -> DataFrame:
    """Records of seed files with organisations filled forward; ``ord`` runs over all files."""
    rows = cells.where("ord >= 0")
    maps = seeds.header_map(cells.where("ord = -1"), rows)
    if run.limit:
        rows = seeds.first_rows(rows, run.limit)
    stem = path_stem(F.col("source"))
    given = org.default_org(F.lit(run.school), F.lit(run.college), None, stem)
    defaults = cells.select("source").distinct().select(
        "source", given["school"].alias("school"), given["college"].alias("college"), title.of_name(stem).alias("fallback_title")
    )
    records = seeds.expand(rows, maps, defaults)
    place = F.shiftleft("ord", 24) + F.col("part")  # a row has fewer records than cells, and those fewer than 2**24
    placed = looked_up(
        records.withColumn("_place", place), defaults.select("source", F.col("school").alias("_s"), F.col("college").alias("_c")), ["source"]
    )
    filled = seeds.fill_org_forward(placed, "source", "_place", F.col("_s"), F.col("_c")).drop("_s", "_c", "_place")
    return _ordered(filled)


def listing_records(pages: DataFrame, run: Run) -> DataFrame:
    """Records of listing pages; the page's organisation overrides the run's."""
    items = page_operators.list_items(pages, run.limit)
    where = org.default_org(F.lit(run.school), F.lit(run.college), org.org_of_page("url", "html"), path_stem("url"))
    orgs = pages.select("url", where.alias("o")).dropDuplicates(["url"])
    return _ordered(
        items.join(orgs, "url").select(
            F.col("url").alias("source"), F.col("at").alias("ord"), F.lit(0).alias("part"), F.col("at").alias("row_number"), "name", "profile_url",
            F.col("o.school").alias("school"), F.col("o.college").alias("college"), "title", "email", "intro",
        )
    )


def profile_records(pages: DataFrame, run: Run) -> DataFrame:
    """One record per profile page with a name."""
    blank = F.lit("")
    where = org.default_org(F.lit(run.school), F.lit(run.college), org.org_of_page("url", "html"), path_stem("url"))
    named = pages.select("url", name_of_page("html", "url").alias("name"), where.alias("o")).where("name <> ''")
    return _ordered(
        named.select(
            F.col("url").alias("source"), F.lit(0).alias("ord"), F.lit(0).alias("part"), F.lit(1).alias("row_number"), "name", F.col("url").alias("profile_url"),
            F.col("o.school").alias("school"), F.col("o.college").alias("college"), blank.alias("title"), blank.alias("email"), blank.alias("intro"),
        )
    )


def run(
    records: DataFrame, pages: DataFrame, told: Run, ocr_text: Column | None = None, decode: Callable[[Column, Column, Column], Column] | None = None
) -> dict[str, DataFrame]:
    """``rows``, ``log`` and ``counters`` of a run over its records; encrypted spans are decoded before anything is read."""
    done = checkpointed(enrich.enriched(records, page_operators.decode_spans(pages, decode), ocr_text))  # read three times
    log = enrich.enrichment_log(done)
    merged = merge.merged_profiles(done, "ord") if told.merge_duplicates else done
    rows, counters = exported(merged, told)
    return {"rows": rows, "log": log, "counters": counters}


def day_summary(manifest_rows: DataFrame, file_rows: DataFrame) -> DataFrame:
    """Manifests' rows before files' rows, the best of every identity, in the order of the summary.

    On equal quality the manifest's row stays, as it comes first.
    """
    placed = manifest_rows.select(F.lit(0).alias("_k"), "source", "ord", *rules.COLUMNS).unionByName(
        file_rows.select(F.lit(1).alias("_k"), "source", "ord", *rules.COLUMNS)
    )
    ordered = numbered(placed, ["_k", "source", "ord"], "_n").withColumn("ord", F.col("_n")).select("ord", *rules.COLUMNS)
    return report.summary(merge.best_rows(merge.sanitised(ordered), "ord"), "ord")


def clean_stored(rows: DataFrame, order: str = "ord") -> DataFrame:
    """Stored output cleaned again by the same rules."""
    return merge.sanitised(rows).orderBy(order)


def resync(day_rows: DataFrame, path: str) -> int:
    """The summary written anew as one workbook, or as one CSV file by its name; its number of rows.

    A workbook holds a sheet of all rows and one for each school and college.
    """
    ordered = day_rows.orderBy("number").select(F.col("number").alias("seq"), *rules.REQUIRED)
    if not path.lower().endswith(".xlsx"):
        return files.write_small_csv(ordered, path, rules.HEADERS)
    if ordered.limit(workbook.MOST_ROWS).count() >= workbook.MOST_ROWS:
        raise ValueError("more rows than a workbook holds; use write_partitioned")
    rows = [tuple(r) for r in ordered.collect()]
    at = {c: i for i, c in enumerate(rules.COLUMNS)}
    groups: dict[str, list[tuple]] = {}
    for r in rows:
        group = groups.setdefault(f"{r[at['school']]}-{r[at['college']]}", [])
        group.append((len(group) + 1, *r[1:]))
    workbook.write_workbook(path, [("汇总", rules.HEADERS, rows), *[(g, rules.HEADERS, v) for g, v in groups.items()]])
    return len(rows)
