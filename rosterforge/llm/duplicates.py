"""Problem 1: records that differ in form only.

A record's canonical key is the sorted set of its field values after white
space, letter case, punctuation and symbols are dropped, so neither the
formatting nor the order of the fields matters. Counting runs in two ways:

* partial counts per key find the *hot* keys exactly: those holding more than
  ``1 / HOT_SHARE`` of all rows, of which there can be at most ``HOT_SHARE``;
* rows of hot keys are salted and aggregated in two levels, all other rows by
  one shuffle. Representative is the least identifier either way.

Defined results: NULL, empty and blank values are all the one value "blank";
a value made of punctuation only is not blank and equals any other such value;
repeated identifiers count as often as they occur; an empty table gives no
rows; columns beyond those named play no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, checkpointed, is_blank

#: A key is hot when it holds more than one row in HOT_SHARE; hence at most HOT_SHARE keys are ever broadcast.
HOT_SHARE = 1000
#: Parts into which the rows of a hot key are split.
SALTS = 32
#: Stands for "not blank, but nothing left after dropping marks".
ONLY_MARKS = "\u0001"


def canonical_value(c: Column | str) -> Column:
    """One value without white space, case, punctuation and symbols; '' for blank."""
    c = F.col(c) if isinstance(c, str) else c
    bare = F.regexp_replace(F.lower(F.upper(c)), rf"[\p{{P}}\p{{S}}{SPACE}]+", "")
    return F.when(is_blank(c), F.lit("")).when(bare == "", F.lit(ONLY_MARKS)).otherwise(bare)


def canonical_key(fields: Sequence[str]) -> Column:
    """128-bit digest of the sorted set of the canonical values."""
    values = F.array_sort(F.array_distinct(F.array(*[canonical_value(f) for f in fields])))
    return F.unhex(F.md5(F.concat_ws("\u0002", values)))


def keyed_rows(df: DataFrame, id_col: str, fields: Sequence[str]) -> DataFrame:
    """``id, key`` of each row."""
    return df.select(F.col(id_col).alias("id"), canonical_key(fields).alias("key"))


def hot_keys(keyed: DataFrame, total: int, hot_share: int = HOT_SHARE) -> DataFrame:
    """Keys above the hot threshold, by exact counts; at most ``hot_share`` rows."""
    counts = keyed.groupBy("key").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") * F.lit(hot_share) > F.lit(total)).select("key", F.lit(True).alias("hot"))


def _collapsed(keyed: DataFrame, total: int, hot_share: int, salts: int) -> DataFrame:
    hot = hot_keys(keyed, total, hot_share)
    marked = keyed.join(F.broadcast(hot), "key", "left")
    plain = (
        marked.where(F.col("hot").isNull())
        .groupBy("key")
        .agg(F.min("id").alias("representative"), F.count("*").alias("copies"))
    )
    salted = (
        marked.where("hot")
        .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
        .groupBy("key", "salt")
        .agg(F.min("id").alias("low"), F.count("*").alias("part"))
        .groupBy("key")
        .agg(F.min("low").alias("representative"), F.sum("part").alias("copies"))
    )
    return plain.unionByName(salted)


def collapse(
    df: DataFrame, id_col: str, fields: Sequence[str], hot_share: int = HOT_SHARE, salts: int = SALTS
) -> DataFrame:
    """One row per group of records equal up to form: ``key, representative, copies``.

    This and ``membership`` are the forms that scale; ``pairs`` lists them out.
    """
    keyed = checkpointed(keyed_rows(df, id_col, fields))
    return _collapsed(keyed, keyed.count(), hot_share, salts)


def membership(
    df: DataFrame, id_col: str, fields: Sequence[str], hot_share: int = HOT_SHARE, salts: int = SALTS
) -> DataFrame:
    """``id, key, representative, copies, is_hot`` of every row that has a copy.

    The keys are computed once. Rows of hot keys meet their group by broadcast
    where they are, so no task holds such a key; the others by one shuffle.
    """
    keyed = checkpointed(keyed_rows(df, id_col, fields))
    total = keyed.count()
    is_hot = F.col("copies") * F.lit(hot_share) > F.lit(total)
    groups = checkpointed(_collapsed(keyed, total, hot_share, salts).where("copies > 1").withColumn("is_hot", is_hot))
    hot = groups.where("is_hot")  # at most hot_share rows
    found = keyed.join(F.broadcast(hot), "key")
    rest = keyed.join(F.broadcast(hot.select("key")), "key", "left_anti").join(groups.where("NOT is_hot"), "key")
    return found.unionByName(rest)


def pairs(df: DataFrame, id_col: str, fields: Sequence[str], salts: int = SALTS, hot_share: int = HOT_SHARE) -> DataFrame:
    """Every pair of equal records, ``id_a < id_b``; the listing form of the groups.

    The rows of a hot group are met in ``salts`` blocks: each row is sent to
    every block on one side and to its own block on the other, so that no
    single task holds such a group. Identical identifiers form no pair, and a
    repeated identifier lists its pairs once per occurrence.
    """
    members = checkpointed(membership(df, id_col, fields, hot_share, salts).select("id", "key", "is_hot"))
    own = F.when(F.col("is_hot"), F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    left = members.select(
        F.col("id").alias("id_a"),
        "key",
        F.explode(F.when(F.col("is_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))).alias("block"),
    )
    right = members.select(F.col("id").alias("id_b"), "key", own.alias("block"))
    return left.join(right, ["key", "block"]).where("id_a < id_b").select("id_a", "id_b")
