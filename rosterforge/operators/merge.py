"""Duplicates of template rows and of profiles: identity, quality, best row, shared addresses, upsert, merging fold.

All choices of one row out of many are aggregates with partial results
(``max_by``), so a key that holds a third of all rows is combined on the map
side and never drawn into one task.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import org, rules, title
from ..functions.names import clean_name, quality_of_clean
from ..functions.text import more_han_than_latin, norm_ws, person_name
from ..functions.url import profile_key
from .common import checkpointed, components, looked_up, numbered

#: Names of the parts of a row's quality, in order of weight.
QUALITY = ("school", "college", "filled", "name_in_intro", "name_clean", "name_quality", "title", "email", "intro")


#: Columns that ``cleaned`` adds: each field normalised, and the cleaned name.
_CLEAN, _NAME = "_clean_", "_clean_of_name"


def cleaned(df: DataFrame) -> DataFrame:
    """``df`` with its fields normalised once, in columns of their own that ``identity`` and ``quality`` read."""
    out = df.withColumns({_CLEAN + f: norm_ws(f) for f in rules.REQUIRED})
    return out.withColumn(_NAME, clean_name(_CLEAN + "name"))


def identity() -> Column:
    """``struct<kind, a, b, c>`` of a cleaned row: URL, else school and address, else school and name, else what there is."""
    c = lambda f: F.col(_CLEAN + f)
    url, mail, name = F.lower(c("profile_url")), F.lower(c("email")), F.col(_NAME)
    key = lambda kind, a, b=F.lit(""), d=F.lit(""): F.struct(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"), d.alias("c"))
    return (
        F.when(url != "", key("url", url))
        .when(mail != "", key("email", c("school"), mail))
        .when(name != "", key("name", c("school"), name))
        .otherwise(key("fallback", name, c("school"), c("college")))
    )


def _parts() -> tuple[Column, ...]:
    c = {f: F.col(_CLEAN + f) for f in rules.REQUIRED}
    name = F.col(_NAME)
    parts = (
        org.looks_like_school(c["school"]) & ~org.is_placeholder_school(c["school"]),
        org.looks_like_college(c["college"]) & ~org.is_placeholder_college(c["college"]),
        sum(((c[f] != "").cast("int") for f in rules.REQUIRED), F.lit(0)),
        (name != "") & person_name(c["intro"]).contains(name),
        (name != "") & (name == c["name"]),
        quality_of_clean(name),
        title.is_valid(c["title"]),
        c["email"] != "",
        F.least(F.length(c["intro"]), F.lit(200)),
    )
    return tuple(p.cast("int").alias(q) for p, q in zip(parts, QUALITY))


def quality() -> Column:
    """Struct of nine numbers of a cleaned row, compared in order; greater is better."""
    return F.struct(*_parts())


def best_rows(df: DataFrame, order: str) -> DataFrame:
    """Per identity the row of the best quality, the first of equals; ``order`` becomes that of the identity's first row.

    ``order`` must be a number unique in ``df``. What is aggregated is one
    decimal a row, quality before place, so that the aggregate hashes fixed
    widths; the chosen rows are then fetched by their number.
    """
    place = F.lit(2**63 - 1).cast("decimal(38,0)") - F.col(order).cast("decimal(20,0)")
    rank = F.lit(0).cast("decimal(18,0)")
    for part, most in zip(_parts(), (2, 2, 10, 2, 2, 3, 2, 2, 201)):
        rank = (rank * F.lit(most) + part).cast("decimal(18,0)")
    unit = F.lit("1" + "0" * 20).cast("decimal(21,0)")
    scored = cleaned(df).select(
        F.md5(F.to_json(identity())).alias("_key"), F.col(order).alias("_at"), (rank.cast("decimal(10,0)") * unit + place).cast("decimal(38,0)").alias("_rank")
    )
    chosen = scored.groupBy("_key").agg(F.max("_rank").alias("_rank"), F.min("_at").alias("_first"))
    at = (F.lit(2**63 - 1).cast("decimal(38,0)") - F.col("_rank") % unit).cast(df.schema[order].dataType)
    return df.join(chosen.select(at.alias(order), "_first"), order).withColumn(order, F.col("_first")).select(*df.columns)


def shared_addresses(df: DataFrame) -> DataFrame:
    """``_school, _college, _email`` of addresses that two or more people of one college have."""
    people = df.select(
        norm_ws("school").alias("_school"), norm_ws("college").alias("_college"), F.lower(norm_ws("email")).alias("_email"), clean_name("name").alias("_name")
    ).where("_school <> '' AND _college <> '' AND _email <> '' AND _name <> ''")
    keys = ["_school", "_college", "_email"]
    return people.distinct().groupBy(*keys).agg(F.count("*").alias("_people")).where("_people >= 2").select(*keys)


def without_shared_addresses(df: DataFrame) -> DataFrame:
    """``df`` with addresses blanked that several people of one college have."""
    shared = shared_addresses(df).withColumn("_shared", F.lit(True))
    filled = lambda c: F.nullif(c, F.lit(""))
    keyed = df.withColumns(
        {"_school": filled(norm_ws("school")), "_college": filled(norm_ws("college")), "_email": filled(F.lower(norm_ws("email")))}
    )
    joined = looked_up(keyed, shared, ["_school", "_college", "_email"])
    return joined.withColumn("email", F.when(F.col("_shared"), "").otherwise(F.col("email"))).select(*df.columns)


def is_valid_row(prefix: str = "") -> Column:
    """Every column but the number is filled."""
    out = F.lit(True)
    for f in rules.REQUIRED:
        out = out & (norm_ws(F.col(prefix + f)) != "")
    return out


def sanitised(df: DataFrame, keep_invalid: bool = False) -> DataFrame:
    """Shared addresses blanked, cells normalised, names cleaned, incomplete rows dropped unless kept."""
    given = [c for c in rules.COLUMNS if c in df.columns]
    out = without_shared_addresses(df).withColumns({c: clean_name(c) if c == "name" else norm_ws(c) for c in given})
    return out if keep_invalid else out.where(is_valid_row())


def upserted(existing: DataFrame, new: DataFrame, order: str = "ord") -> DataFrame:
    """Existing and new rows merged: best row per identity at the place of its first, renumbered from 1.

    Existing rows come first in order, and win ties.
    """
    both = existing.drop("seq").withColumn("_batch", F.lit(0)).unionByName(new.drop("seq").withColumn("_batch", F.lit(1)))
    last = existing.agg(F.max(order)).first()[0]
    behind = F.col(order) + F.lit(0 if last is None else last + 1)
    placed = both.withColumn(order, F.when(F.col("_batch") == 1, behind).otherwise(F.col(order))).drop("_batch")
    merged = sanitised(best_rows(sanitised(placed), order))
    return numbered(merged, [order], "seq")


# --- merging of profiles ---------------------------------------------------------------------------------------


def preference(name: Column, url: Column, intro: Column, rank: Column, mail: Column) -> Column:
    """Struct of four numbers; greater is preferred."""
    return F.struct(
        (~name.contains("英文")).cast("int").alias("native_name"),
        (~F.lower(url).contains("english")).cast("int").alias("native_url"),
        (more_han_than_latin(intro).cast("int") + (rank != "").cast("int")).alias("intro_and_title"),
        (mail != "").cast("int").alias("mail"),
    )


class _Fold:
    """Records of one component in order: each joins the first cluster it matches, else opens one.

    Clusters are found by name and by address with profile; a merge may change
    a cluster's own, so entries that no longer hold are dropped when met.
    """

    def __init__(self) -> None:
        self.clusters: list[dict] = []
        self.filed: dict[tuple, list[int]] = defaultdict(list)

    @staticmethod
    def keys(r: dict) -> list[tuple]:
        place = (r["_school"], r["_college"])
        named = [(*place, r["_name"])] if r["_name"] else []
        return named + ([(*place, r["_mail"], r["_profile"])] if r["_mail"] and r["_profile"] else [])

    def file(self, i: int) -> None:
        for k in self.keys(self.clusters[i]):
            if i not in self.filed[k][:1]:
                heappush(self.filed[k], i)

    def first(self, k: tuple) -> int | None:
        at = self.filed[k]
        while at and k not in self.keys(self.clusters[at[0]]):
            heappop(at)
        return at[0] if at else None

    def add(self, r: dict) -> None:
        hits = [i for k in self.keys(r) if (i := self.first(k)) is not None]
        if hits:
            self.clusters[min(hits)] = _united(self.clusters[min(hits)], r)
        else:
            self.clusters.append(dict(r))
        self.file(min(hits) if hits else len(self.clusters) - 1)


_FILLED = (("email", "_mail"), ("title", "_title"), ("intro", "_intro"), ("profile_url", "_profile"), ("school", "_school"), ("college", "_college"))


def _score(r: dict) -> tuple[int, ...]:
    return (r["_native_name"], r["_native_url"], r["_han_intro"] + bool(r["_title"]), int(bool(r["_mail"])))


def _united(a: dict, b: dict) -> dict:
    first, second = (a, b) if _score(a) >= _score(b) else (b, a)
    out = dict(first)
    out["ord"], out["n_merged"] = a["ord"], a["n_merged"] + b["n_merged"]
    for field, key in _FILLED:
        if not out[key]:
            out[field], out[key] = second[field], second[key]
            if field == "intro":
                out["_han_intro"] = second["_han_intro"]
            if field == "profile_url":
                out["_native_url"] = second["_native_url"]
    return out


def merged_profiles(df: DataFrame, order: str = "ord") -> DataFrame:
    """Records of the same person folded into one, with ``n_merged``.

    Two records belong together within a school and college if their cleaned
    names agree, or their addresses and profile keys do. A merge may complete
    the record that later ones are compared with, so the fold runs in order;
    but only within records that share a name or an address of one college,
    directly or over others, which are found first as connected components.
    Exact copies are folded into their first before that, as they change
    nothing. A component's different records pass through one task in order, as
    the fold demands, but as a stream: memory holds its clusters only.
    """
    fields = ["name", "profile_url", "school", "college", "title", "email", "intro"]
    text = {f: F.coalesce(F.col(f), F.lit("")) for f in fields}
    first = df.select(F.col(order).cast("long").alias("ord"), *[text[f].alias(f) for f in fields]).groupBy(*fields).agg(
        F.min("ord").alias("ord"), F.count("*").alias("n_merged")
    )
    keyed = checkpointed(
        first.select(
            "ord",
            "n_merged",
            *fields,
            clean_name("name").alias("_name"),
            F.lower(norm_ws("email")).alias("_mail"),
            profile_key("profile_url").alias("_profile"),
            norm_ws("school").alias("_school"),
            norm_ws("college").alias("_college"),
            norm_ws("title").alias("_title"),
            norm_ws("intro").alias("_intro"),
            (~norm_ws("name").contains("英文")).cast("int").alias("_native_name"),
            (~F.lower(norm_ws("profile_url")).contains("english")).cast("int").alias("_native_url"),
            more_han_than_latin(norm_ws("intro")).cast("int").alias("_han_intro"),
        )
    )
    links = keyed.select(
        F.col("ord").alias("id"),
        F.explode(
            F.filter(
                F.array(
                    F.when(F.col("_name") != "", F.md5(F.concat_ws("\u0001", "_school", "_college", F.lit("n"), "_name"))),
                    F.when(F.col("_mail") != "", F.md5(F.concat_ws("\u0001", "_school", "_college", F.lit("m"), "_mail"))),
                ),
                lambda k: k.isNotNull(),
            )
        ).alias("key"),
    )
    grouped = keyed.join(components(links), keyed["ord"] == F.col("id"), "left").drop("id")
    grouped = grouped.withColumn("component", F.coalesce("component", "ord"))
    schema = "ord long, n_merged long, " + ", ".join(f"{f} string" for f in fields)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        component, held = None, _Fold()
        for batch in batches:
            done: list[dict] = []
            for r in batch.to_dict("records"):
                if r["component"] != component:
                    done += held.clusters
                    component, held = r["component"], _Fold()
                held.add(r)
            yield pd.DataFrame(done, columns=["ord", "n_merged", *fields])
        yield pd.DataFrame(held.clusters, columns=["ord", "n_merged", *fields])

    return grouped.repartition("component").sortWithinPartitions("component", "ord").mapInPandas(fold, schema)
