"""CSV seeds and outputs, run manifests, run logs, captured pages, and the paths of outputs."""

from __future__ import annotations

import csv
import hashlib
import io
import json
import os
import re
import shutil
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import SPACES, norm_ws

def read_ragged_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``source, ord, cells`` of CSV files of any width; ``ord`` is -1 for the header row, blank rows are dropped.

    A byte order mark is ignored; quoted line ends and doubled quotes are kept.
    A file is read by one task, since only that keeps the order of its rows;
    these are seed files made by hand, and Spark refuses one above 2 GB.
    """
    paths = [path] if isinstance(path, str) else path
    raw = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("source"), "content")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        csv.field_size_limit(2**31 - 1)
        for batch in batches:
            for source, content in zip(batch["source"], batch["content"]):
                reader = csv.reader(io.StringIO(bytes(content).decode("utf-8-sig", "replace"), newline=""))
                kept = ((i - 1, cells) for i, cells in enumerate(chain(islice(reader, 1), filter(any_filled, reader))))
                while part := list(islice(kept, 10_000)):
                    yield pd.DataFrame({"source": source, "ord": [i for i, _ in part], "cells": [c for _, c in part]})

    return raw.mapInPandas(parse, "source string, ord long, cells array<string>")


def any_filled(cells: list[str]) -> bool:
    """Whether a row holds anything but white space and byte order marks."""
    return any(c.strip("\ufeff" + SPACES) for c in cells)


def template_rows(cells: DataFrame) -> DataFrame:
    """Output rows read again: ``source, ord`` and the ten columns; files under other headers are left out."""
    head = cells.where("ord = -1").select("source", F.transform(F.slice("cells", 1, len(rules.HEADERS)), norm_ws).alias("_head"))
    ours = head.where(F.col("_head") == F.array(*[F.lit(h) for h in rules.HEADERS])).select("source")
    at = lambda i: norm_ws(F.coalesce(F.get("cells", F.lit(i)), F.lit("")))
    return cells.where("ord >= 0").join(ours, "source", "left_semi").select(
        "source", "ord", *[at(i).alias(c) for i, c in enumerate(rules.COLUMNS)]
    )


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Manifests of runs (one JSON document a file) with their rows; unreadable files are left out."""
    schema = (
        "createdAt string, inputPath string, listPageUrl string, outputPath string, collector string, collectedAt string, "
        "school string, college string, headers array<string>, rows array<array<string>>, _bad string"
    )
    read = (
        spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    )
    return read.select("*", F.col("_metadata.file_path").alias("source")).where("_bad IS NULL").drop("_bad")


def manifest_rows(manifests: DataFrame) -> DataFrame:
    """The template rows within manifests; the manifest's school and college replace placeholders."""
    from ..functions import org

    each = manifests.select("source", "school", "college", F.posexplode("rows").alias("ord", "cells")).where(
        F.size("cells") >= len(rules.COLUMNS)
    )
    at = {c: norm_ws(F.get("cells", F.lit(i))) for i, c in enumerate(rules.COLUMNS)}
    given = {"school": org.is_placeholder_school, "college": org.is_placeholder_college}
    chosen = {
        c: F.when(given[c](v) & (norm_ws(c) != ""), norm_ws(c)).otherwise(v) if c in given else v for c, v in at.items()
    }
    return each.select("source", F.col("ord").cast("long").alias("ord"), *[v.alias(c) for c, v in chosen.items()])


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages as ``url, html`` from parquet or JSON lines."""
    read = spark.read.json(path) if re.search(r"\.jsonl?$|\.json\.", path) else spark.read.parquet(path)
    return read.select("url", "html")


def csv_text(headers: Sequence[str], rows: Iterable[Sequence[object]]) -> str:
    """CSV with a byte order mark and CRLF line ends."""
    out = io.StringIO()
    writer = csv.writer(out)
    writer.writerow(headers)
    writer.writerows(["" if v is None else v for v in r] for r in rows)
    return "﻿" + out.getvalue()


def write_small_csv(df: DataFrame, path: str, headers: Sequence[str], most: int = 1_000_000) -> int:
    """A report of bounded size as one CSV file with a byte order mark; more than ``most`` rows are refused."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows; use write_partitioned")
    rows = [tuple(r) for r in df.collect()]
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(csv_text(headers, rows))
    return len(rows)


def write_previews(folder: str, sheets: Sequence[tuple[str, Sequence[str], Sequence[Sequence[object]]]]) -> list[str]:
    """One numbered CSV file for each ``(name, headers, rows)`` in a folder that holds nothing else afterwards."""
    if os.path.isdir(folder):
        shutil.rmtree(folder)
    os.makedirs(folder)
    out = []
    for i, (name, headers, rows) in enumerate(sheets, 1):
        out.append(os.path.join(folder, f"{i:02}_{file_part(name)}.csv"))
        with open(out[-1], "w", encoding="utf-8", newline="") as f:
            f.write(csv_text(headers, rows))
    return out


def write_partitioned(rows: DataFrame, path: str) -> None:
    """One folder per school and college under ``path``; only the folders of these rows are replaced."""
    out = rows.withColumn("school", path_part("school", "未填写学校")).withColumn("college", path_part("college", "未命名学院"))
    previous = rows.sparkSession.conf.get("spark.sql.sources.partitionOverwriteMode")
    rows.sparkSession.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        out.write.mode("overwrite").partitionBy("school", "college").option("header", True).csv(path)
    finally:
        rows.sparkSession.conf.set("spark.sql.sources.partitionOverwriteMode", previous)


def is_within(root: str, path: str) -> bool:
    """Whether a path lies under a root, after both are made plain."""
    plain = lambda p: os.path.normpath(p.replace("\\", "/")).rstrip("/")
    return (plain(path) + "/").startswith(plain(root) + "/")


def _located(spark: SparkSession, path: str) -> tuple:
    """The Hadoop path and its file system, so that shared stores and local folders are reached alike."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def listed(spark: SparkSession, path: str) -> list[str]:
    """Full paths of what a folder holds, in order; none if it doesn't exist."""
    at, store = _located(spark, path)
    return sorted(s.getPath().toString() for s in store.listStatus(at)) if store.exists(at) else []


def exists(spark: SparkSession, path: str) -> bool:
    at, store = _located(spark, path)
    return store.exists(at)


def removed(spark: SparkSession, root: str, paths: Iterable[str]) -> list[str]:
    """Files or folders under ``root`` deleted; those that were there are returned, any outside is refused."""
    paths, gone = list(paths), []
    for path in paths:
        if not is_within(root, path) or is_within(path, root):
            raise ValueError(f"{path} doesn't lie under {root}")
    for path in paths:
        at, store = _located(spark, path)
        if store.exists(at) and store.delete(at, True):
            gone.append(path)
    return gone


def write_run_log(path: str, counters: dict, log: DataFrame) -> None:
    """Counters as one JSON document, entries as JSON lines beside it."""
    log.write.mode("overwrite").json(os.path.join(path, "entries"))
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "run.json"), "w", encoding="utf-8") as f:
        json.dump(counters, f, ensure_ascii=False, indent=2)


def manifest_of(rows: DataFrame, **about: str) -> DataFrame:
    """``value``: one JSON document per run of what is said about it and its rows in order.

    ``rows`` has ``run_id, ord`` and the ten columns; a run's rows are those of
    one output file.
    """
    cells = F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rules.COLUMNS])
    listed = rows.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("ord", cells.alias("cells")))).alias("r"))
    said = [F.lit(v).alias(k) for k, v in about.items()]
    heads = F.array(*[F.lit(h) for h in rules.HEADERS]).alias("headers")
    return listed.select("run_id", F.to_json(F.struct(*said, heads, F.transform("r", lambda x: x["cells"]).alias("rows"))).alias("value"))


# --- paths ------------------------------------------------------------------------------------------------------


def path_part(c: Column | str, otherwise: str) -> Column:
    """A value fit for a folder name."""
    out = F.regexp_replace(norm_ws(c), r"[<>:\"/\\|?*]+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(out, r"^[ .]+|[ .]+$", ""), F.lit("")), F.lit(otherwise))


def file_part(value: str) -> str:
    """A value fit for a file name."""
    return re.sub(r"\s+", "_", re.sub(r'[<>:"/\\|?*]+', "_", value)).strip("._") or "output"


def output_stem(stem: str) -> str:
    """A stem without its import or export suffix, named an output."""
    endings = "|".join(map(re.escape, rules.OUTPUT_SUFFIXES))
    return re.sub(rf"^(.*?)[_\- ]*(?:{endings})$", r"\1", stem.strip(), count=1).rstrip("_- ") + "输出" if re.search(rf"(?:{endings})$", stem.strip()) else stem.strip() + "输出"


def output_path(root: str, day: str, school: str, college: str, stem: str) -> str:
    """``root/day/school/college.csv`` with placeholders for what is missing."""
    clean = lambda v: re.sub(r'[<>:"/\\|?*]+', "_", " ".join((v or "").split())).strip(" .")
    return os.path.join(root, day, clean(school) or "未填写学校", (clean(college) or clean(output_stem(stem)) or "未命名学院") + ".csv")


def csv_path(path: str) -> str:
    return path if path.lower().endswith(".csv") else os.path.splitext(path)[0] + ".csv"


def legacy_path(path: str) -> str:
    return os.path.splitext(path)[0] + ".xlsx"


def preview_path(path: str) -> str:
    return os.path.splitext(path)[0] + "_预览.csv"


def log_path(root: str, output: str) -> str:
    return os.path.join(root, "日志", os.path.splitext(os.path.basename(output))[0] + "_日志.json")


def manifest_path(root: str, day: str, output: str) -> str:
    digest = hashlib.sha1(output.replace(os.sep, "/").encode()).hexdigest()[:12]
    return os.path.join(root, day, ".汇总数据", "records", file_part(f"{os.path.splitext(os.path.basename(output))[0]}_{digest}.json"))
