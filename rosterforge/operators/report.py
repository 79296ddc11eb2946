"""Reports over template rows: validity per day, numbered summaries, claims against facts, files without runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import org
from ..functions.text import norm_ws
from .common import looked_up, numbered
from .merge import is_valid_row


def valid_by_day(rows: DataFrame) -> DataFrame:
    """``collected_at, n_rows, n_valid``."""
    return rows.groupBy(norm_ws("collected_at").alias("collected_at")).agg(
        F.count("*").alias("n_rows"), F.count_if(is_valid_row()).alias("n_valid")
    )


def counters(rows: DataFrame) -> DataFrame:
    """One row of run counters: input, exported, filtered."""
    return rows.agg(
        F.count("*").alias("n_input"), F.count_if(is_valid_row()).alias("n_exported"), F.count_if(~is_valid_row()).alias("n_filtered")
    )


def with_real_org(rows: DataFrame) -> DataFrame:
    return rows.where(~org.is_placeholder_school("school") & ~org.is_placeholder_college("college"))


def group_key() -> Column:
    return F.concat_ws("-", norm_ws("school"), norm_ws("college"))


def summary(rows: DataFrame, order: str) -> DataFrame:
    """Rows of real organisations by group, school, college, name and order, numbered from 1 over all."""
    keyed = with_real_org(rows).select(
        "*", group_key().alias("_g"), norm_ws("school").alias("_s"), norm_ws("college").alias("_c"), norm_ws("name").alias("_n")
    )
    return numbered(keyed, ["_g", "_s", "_c", "_n", order], "number").drop("_g", "_s", "_c", "_n")


def numbered_by_group(rows: DataFrame, order: str) -> DataFrame:
    """Rows with their group and their number within it.

    A group is numbered in order without one task holding it: rows are numbered
    over all, and each group's numbers start at its least.
    """
    keyed = with_real_org(rows).withColumn("group_key", group_key())
    over_all = numbered(keyed, ["group_key", order], "_at")
    first = over_all.groupBy("group_key").agg(F.min("_at").alias("_first"))
    return looked_up(over_all, first, ["group_key"]).withColumn("number", F.col("_at") - F.col("_first") + 1).drop("_at", "_first")


def claims(manifests: DataFrame, rows: DataFrame) -> DataFrame:
    """``run_id, claimed, actual, difference`` of every run."""
    actual = rows.groupBy("run_id").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0)).cast("long")
    return manifests.join(actual, "run_id", "left").select(
        "run_id", F.col("row_count").alias("claimed"), n.alias("actual"), (n - F.coalesce("row_count", F.lit(0))).alias("difference")
    )


def without_rows(manifests: DataFrame, rows: DataFrame) -> DataFrame:
    """Runs whose output holds no valid row: what a rebuild of the files would leave over."""
    return manifests.join(rows.where(is_valid_row()).select("run_id").distinct(), "run_id", "left_anti").select("run_id", "output_path")


def first_filled(rows: DataFrame, group: str, order: str, column: str, otherwise: Column) -> DataFrame:
    """``group, column``: the first non-blank value of each group in order, else ``otherwise``."""
    value = F.nullif(norm_ws(column), F.lit(""))
    return rows.groupBy(group).agg(F.coalesce(F.min_by(value, F.when(value.isNotNull(), F.col(order))), otherwise).alias(column))


def log_summary(log: DataFrame) -> DataFrame:
    """Entries by severity without regard to case; entries written twice count once."""
    once = log.select(F.lower(norm_ws("severity")).alias("severity"), "run_id", "row_no", "name", "url", "message").distinct()
    return once.groupBy("severity").agg(F.count("*").alias("n_entries"), F.countDistinct("run_id").alias("n_runs"))


def last_by_run(log: DataFrame) -> DataFrame:
    """The latest entry of each run (greatest time, then greatest log_id)."""
    entry = F.struct("logged_at", "log_id", "message")
    return log.groupBy("run_id").agg(F.max(entry).alias("e"), F.count("*").alias("n_entries")).select(
        "run_id", F.col("e.log_id").alias("log_id"), F.col("e.message").alias("message"), "n_entries"
    )


def places(rows: DataFrame, order: str) -> DataFrame:
    """Each row's number within its run, in order."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("run_id").orderBy(order)))
