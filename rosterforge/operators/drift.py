"""Schemas that drift between the files of a feed.

Every file's columns are profiled from its records: JSON type, a fixed number
of min-hash registers as value sketch, shares of value shapes, a bitmap that
tells varied from repeated values. Between a file and the one before it a
bipartite matching, weighted by overlap of the sketches, closeness of the
shapes, type and likeness of the names, pairs the columns that go on; pairs
under different names are renamed columns, what is left over was added or
removed. Header spellings play no part in these weights; they, and value
shapes where a spelling is unknown, only say which field a column is called
after, and that columns called after different fields are not one. The matched
columns then unify all records in one table.

What is shuffled is one profile row per file and column; values never are.
Matchings work on the handful of columns of one file that don't keep their
name.

Defined results: a record that is not a JSON object counts for nothing; NULL
values leave a column present but untyped, and an untyped column is never
retyped; of several types in one file the most frequent holds (ties: the
least name); repeated records and key order change nothing; a file without a
usable record has no columns; an empty table gives no changes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .assignment import best_matching

#: Min-hash registers kept per column.
REGISTERS = 16
#: Least weight at which a column is taken for a field, and two columns for the same one.
FIELD_LEAST, SAME_LEAST = 1.8, 4.0
#: Weights of sketch overlap, closeness of shapes, likeness of names and equal types in the matching of two versions.
BY_SKETCH, BY_SHAPE, BY_NAME, BY_TYPE = 4.0, 4.5, 1.5, 0.5
#: Values that a field's shape must fit, and distinct values that a varied field must have, as shares.
FITTING, VARIED = 0.6, 0.75
#: Values from which a column counts as varied.
ENOUGH = 6
#: Taken off where only one of two columns is called after a field.
HALF_KNOWN = 0.5


@dataclass(frozen=True)
class FieldSpec:
    """A known field: its header spellings, a pattern that most of its values fit, and whether these seldom repeat."""

    name: str
    aliases: tuple[str, ...]
    shape: str
    varied: bool = False


# The fields of the template, usual header spellings (compared
# without case, white space and separators), and the look of their values.
FIELDS = (
    FieldSpec("name", ("name", "姓名", "教师姓名", "教师", "老师", "人员", "teacher", "teachername", "fullname", "xm", "字段1", "标题"), r"^(?:[一-龥]{2,3}(?:[·・][一-龥]{1,6})?|\p{Lu}[\p{L}'’.-]+(?: \p{Lu}[\p{L}'’.-]*){1,3})$", True),
    FieldSpec("profile_url", ("profileurl", "url", "主页", "个人主页", "教师主页", "主页链接", "网页", "网页地址", "网址", "链接", "详情链接", "详情", "link", "links", "href", "page", "homepage", "标题链接"), r"https?://"),
    FieldSpec("school", ("school", "学校", "院校", "高校", "大学", "university", "schoolname", "学校名称"), r"大学$|^\w*University"),
    FieldSpec("college", ("college", "学院", "院系", "系所", "department", "dept", "学院名称", "faculty", "所在学院"), r"(?:学院|研究院|系|中心|图书馆)$"),
    FieldSpec("title", ("title", "职称", "rank", "zc", "岗位", "职务", "jobtitle", "专业技术职务", "职称职务"), r"^\W*(?:[一-龥]{0,4}(?:教授|讲师|助教|研究员|工程师|实验师|医师)|\w*\s*(?:Professor|Lecturer|Research Fellow|Engineer|Physician))\W*$"),
    FieldSpec("email", ("email", "mail", "邮箱", "电子邮箱", "电子邮件", "电子信箱", "信箱", "邮件", "联系邮箱", "emailaddress"), r"\S@\S"),
    FieldSpec("intro", ("intro", "简介", "个人简介", "介绍", "个人介绍", "教师简介", "about", "bio", "profile", "introduction", "biography", "summary"), r"[\s\S]{24}"),
)


def bare(header: str) -> str:
    """A header without case, white space and separators."""
    return re.sub(r"[\s_\-.:：/]+", "", header).lower()


def cells(lines: DataFrame) -> DataFrame:
    """``file_id, key, kind, text``: each member of each usable record (NULL kind for a NULL)."""
    parsed = lines.select("file_id", F.try_parse_json("record").alias("v")).where(
        F.schema_of_variant("v").startswith("OBJECT")
    )
    exploded = parsed.lateralJoin(parsed.sparkSession.tvf.variant_explode(F.col("v").outer()))
    kind = F.schema_of_variant("value")
    return exploded.select(
        "file_id",
        "key",
        F.when(kind == "VOID", F.lit(None))
        .when(kind == "STRING", F.lit("string"))
        .when(kind == "BOOLEAN", F.lit("boolean"))
        .when(kind.startswith("ARRAY"), F.lit("array"))
        .when(kind.startswith("OBJECT"), F.lit("object"))
        .otherwise(F.lit("number"))
        .alias("kind"),
        F.when(kind == "STRING", F.try_variant_get("value", "$", "string"))
        .when(kind != "VOID", F.to_json("value"))
        .alias("text"),
    )


#: Looks of any values: ideographs, Latin letters, digits, signs of addresses, several words, more than eight signs, more than thirty.
LOOKS = (r"[一-龥]", r"[A-Za-z]", r"[0-9]", r"[@/]", r"[ ，。、]", r"^[\s\S]{9}", r"^[\s\S]{31}")


def profiles(lines: DataFrame, fields: tuple[FieldSpec, ...] = FIELDS) -> DataFrame:
    """One row per file and column: type, sketch, shares of values with each field's shape and each look, bitmap of values."""
    plain = cells(lines).withColumn("text", plain_value(F.col("text")))
    patterns = [*(f.shape for f in fields), *LOOKS]
    per_kind = plain.groupBy("file_id", "key", "kind").agg(
        F.count("*").alias("n"),
        F.bit_or(F.when(F.col("text").isNotNull(), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64("text"), F.lit(64)).cast("int")))).alias("map"),
        *[F.min(F.when(F.col("text").isNotNull(), F.xxhash64("text", F.lit(i)))).alias(f"h{i}") for i in range(REGISTERS)],
        *[F.count_if(F.col("text").rlike(p)).alias(f"s{i}") for i, p in enumerate(patterns)],
    )
    typed = F.col("kind").isNotNull()
    total = F.sum(F.when(typed, F.col("n")).otherwise(0))
    return per_kind.groupBy("file_id", "key").agg(
        F.min_by("kind", F.when(typed, F.struct(-F.col("n"), F.col("kind")))).alias("kind"),
        total.alias("n"),
        F.bit_count(F.coalesce(F.bit_or("map"), F.lit(0).cast("long"))).alias("spread"),
        F.array(*[F.min(F.when(typed, F.col(f"h{i}"))) for i in range(REGISTERS)]).alias("sketch"),
        F.array(*[F.try_divide(F.sum(f"s{i}").cast("double"), total) for i in range(len(patterns))]).alias("shapes"),
    )


@lru_cache(maxsize=100_000)
def _likeness(a: str, b: str) -> float:
    """Of two headers, by their signs."""
    return SequenceMatcher(None, bare(a), bare(b)).ratio()


@lru_cache(maxsize=100)
def _spellings(fields: tuple[FieldSpec, ...]) -> dict[str, int]:
    return {bare(a): i for i, f in reversed(list(enumerate(fields))) for a in f.aliases}


def _is_varied(column: dict) -> bool:
    """Whether values seldom repeat, by linear counting in the bitmap."""
    n, spread = min(column["n"] or 0, 60), min(column["spread"] or 0, 63)
    return n >= ENOUGH and -64 * math.log(1 - spread / 64) >= VARIED * n


def _field_of(columns: list[dict], fields: tuple[FieldSpec, ...]) -> dict[str, int]:
    """Columns of one file -> index of the known field each is called after, or whose shape its values have."""
    known = _spellings(fields)
    out = {}
    for c in columns:
        if (i := known.get(bare(c["key"]))) is not None and i not in out.values():
            out[c["key"]] = i
    rest = [c for c in columns if c["key"] not in out and bare(c["key"]) not in known and c["kind"] not in (None, "boolean", "number")]
    free = [i for i in range(len(fields)) if i not in out.values()]

    def weight(c: dict, i: int) -> float:
        share = (c["shapes"][i] or 0.0) if c["shapes"] is not None else 0.0
        if share < FITTING or fields[i].varied and not _is_varied(c):
            return 0.0
        return 3 * share + max(_likeness(c["key"], a) for a in fields[i].aliases) + 0.1 * (len(fields) - i)

    if rest and free:
        out |= {rest[r]["key"]: free[j] for r, j in best_matching([[weight(c, i) for i in free] for c in rest], FIELD_LEAST)}
    return out


def _overlap(a: list | None, b: list | None) -> float:
    if a is None or b is None:
        return 0.0
    return sum(x is not None and x == y for x, y in zip(a, b)) / REGISTERS


def _closeness(a: list | None, b: list | None) -> float:
    """1 for equal shares of all shapes and looks, 0 where they differ by a third on average; 0 without values."""
    if a is None or b is None or a[0] is None or b[0] is None:
        return 0.0
    return max(0.0, 1 - 3 * sum(abs(x - y) for x, y in zip(a, b)) / len(a))


def _changes(old: list[dict], new: list[dict], fields: tuple[FieldSpec, ...]) -> Iterator[tuple[str, str]]:
    of_old, of_new = _field_of(old, fields), _field_of(new, fields)

    def weight(a: dict, b: dict) -> float:
        f, g = of_old.get(a["key"]), of_new.get(b["key"])
        if f is None and g is None or f is not None and g is not None and f != g:
            return 0.0  # a column outside the known fields is a field of its own
        return (
            BY_SKETCH * _overlap(a["sketch"], b["sketch"])
            + BY_SHAPE * _closeness(a["shapes"], b["shapes"])
            + BY_NAME * _likeness(a["key"], b["key"])
            + BY_TYPE * (a["kind"] == b["kind"])
            - HALF_KNOWN * (f is None or g is None)
        )

    later = {c["key"]: c for c in new}
    pairs = [(c, later[c["key"]]) for c in old if c["key"] in later]  # a column that keeps its name goes on
    kept = {a["key"] for a, _ in pairs}
    gone, come = ([c for c in columns if c["key"] not in kept] for columns in (old, new))
    if gone and come:
        matched = best_matching([[weight(a, b) for b in come] for a in gone], SAME_LEAST)
        pairs += [(gone[i], come[j]) for i, j in matched]
        gone = [c for i, c in enumerate(gone) if i not in {i for i, _ in matched}]
        come = [c for j, c in enumerate(come) if j not in {j for _, j in matched}]
    # What the matching left apart, but is called after one known field, is that field under another name.
    for a in list(gone):
        same = [b for b in come if of_old.get(a["key"]) is not None and of_old[a["key"]] == of_new.get(b["key"])]
        if same:
            pairs.append((a, same[0]))
            gone.remove(a)
            come.remove(same[0])
    label = lambda f, key: key if f is None else fields[f].name
    for a, b in pairs:
        called = label(of_new.get(b["key"], of_old.get(a["key"])), b["key"])
        if a["key"] != b["key"]:
            yield called, "renamed"
        if a["kind"] is not None and b["kind"] is not None and a["kind"] != b["kind"]:
            yield called, "retyped"
    for c in gone:
        yield label(of_old.get(c["key"]), c["key"]), "removed"
    for c in come:
        yield label(of_new.get(c["key"]), c["key"]), "added"


def _records(columns: object) -> list[dict]:
    rows = [] if columns is None else [c if isinstance(c, dict) else c.asDict() for c in columns]
    return sorted(rows, key=lambda c: c["key"])


def versions(files: DataFrame, lines: DataFrame, fields: tuple[FieldSpec, ...] = FIELDS) -> DataFrame:
    """``file_id, feed_id, position, columns``: each file's profile, in the order of its feed."""
    profiled = (
        profiles(lines, fields)
        .groupBy("file_id")
        .agg(F.collect_list(F.struct("key", "kind", "n", "spread", "sketch", "shapes")).alias("columns"))
    )
    order = Window.partitionBy("feed_id").orderBy("file_date", "file_id")
    return (
        files.select("file_id", "feed_id", "file_date")
        .withColumn("position", F.row_number().over(order))
        .join(profiled, "file_id", "left")
    )


def changes(files: DataFrame, lines: DataFrame, fields: tuple[FieldSpec, ...] = FIELDS) -> DataFrame:
    """``file_id, field, change``: every change of a file against the previous file of its feed."""
    v = versions(files, lines, fields)
    before = v.select("feed_id", (F.col("position") + 1).alias("position"), F.col("columns").alias("before"))
    met = v.join(before, ["feed_id", "position"]).select("file_id", "before", "columns")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                (file_id, field, change)
                for file_id, old, new in zip(batch["file_id"], batch["before"], batch["columns"])
                for field, change in _changes(_records(old), _records(new), fields)
            ]
            yield pd.DataFrame(out, columns=["file_id", "field", "change"])

    return met.mapInPandas(compare, "file_id long, field string, change string")


def field_map(files: DataFrame, lines: DataFrame, fields: tuple[FieldSpec, ...] = FIELDS) -> DataFrame:
    """``file_id, keys``: per file a map from known field to the key that holds it."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            maps = [
                {fields[i].name: key for key, i in _field_of(_records(columns), fields).items()}
                for columns in batch["columns"]
            ]
            yield pd.DataFrame({"file_id": batch["file_id"], "keys": maps})

    return versions(files, lines, fields).select("file_id", "columns").mapInPandas(
        assign, "file_id long, keys map<string,string>"
    )


def plain_value(json_text: Column) -> Column:
    """The text of a scalar, the first element of an array, the first text member of an object."""
    return (
        F.when(json_text.startswith("["), F.get(F.from_json(json_text, "array<string>"), F.lit(0)))
        .when(
            json_text.startswith("{"),
            F.coalesce(F.get_json_object(json_text, "$.text"), F.get_json_object(json_text, "$.href"), json_text),
        )
        .otherwise(json_text)
    )


def unify(files: DataFrame, lines: DataFrame, fields: tuple[FieldSpec, ...] = FIELDS) -> DataFrame:
    """All usable records in one table: a text column per known field, all other members in ``others``."""
    members = F.from_json("record", "map<string,string>")
    joined = lines.join(field_map(files, lines, fields), "file_id").withColumn("members", members).where(
        F.try_parse_json("record").isNotNull() & F.col("members").isNotNull()
    )
    return joined.select(
        "line_id",
        "file_id",
        "line_no",
        *[
            F.when(
                F.col("keys")[f.name].isNotNull(), plain_value(F.try_element_at("members", F.col("keys")[f.name]))
            ).alias(f.name)
            for f in fields
        ],
        F.map_filter("members", lambda k, _: ~F.array_contains(F.map_values("keys"), k)).alias("others"),
    )
