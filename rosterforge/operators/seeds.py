"""Seed files: which column holds which field, rows into records, organisations filled forward.

Seed rows are ragged: ``source, ord, cells array<string>``, where ``source``
names the file, and ``ord`` counts its data rows from 0. All operators handle
any number of files at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import org, rules, title
from ..functions.names import looks_like_name
from ..functions.text import norm_ws
from ..functions.url import looks_like_url
from .common import looked_up

#: Rows from which columns are inferred when headers don't tell.
SAMPLE = 10
#: Rows of one bucket of the forward fill.
BUCKET = 100_000

RECORD = ("name", "profile_url", "school", "college", "title", "email", "intro")


def cell(cells: Column, at: Column) -> Column:
    """The cell at a position, '' outside the row or for position -1."""
    return F.when(at >= 0, norm_ws(F.get(cells, at))).otherwise(F.lit(""))


def is_blank_row(cells: Column) -> Column:
    return ~F.exists(cells, lambda c: norm_ws(c) != "")


def infer_columns(rows: DataFrame) -> DataFrame:
    """``source, name, profile_url``: columns with most name-like and URL-like cells among the first rows (NULL: none)."""
    first = rows.where(~is_blank_row(F.col("cells"))).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("source").orderBy("ord"))
    ).where(F.col("_rank") <= SAMPLE)
    scored = (
        first.select("source", F.posexplode("cells").alias("at", "cell"))
        .groupBy("source", "at")
        .agg(F.count_if(looks_like_name("cell")).alias("names"), F.count_if(looks_like_url("cell")).alias("urls"))
    )
    top = lambda n: F.max(F.when(F.col(n) > 0, F.struct(F.col(n), -F.col("at"))))
    return scored.groupBy("source").agg(top("names").alias("n"), top("urls").alias("u")).select(
        "source", (-F.col("n.col2")).alias("name"), (-F.col("u.col2")).alias("profile_url")
    )


def header_map(headers: DataFrame, rows: DataFrame) -> DataFrame:
    """``source, columns map<field, position>`` from headers (``source, cells``), samples, then position.

    A field's first column with a known spelling holds it; names and URLs
    without one are inferred from samples, and else taken from columns 0 and 1.
    """
    spark = headers.sparkSession
    known = [
        (a.lower(), f) for f, names in rules.HEADER_ALIASES.items() for a in names if a.lower() not in rules.PLACEHOLDER_HEADERS
    ]
    aliases = spark.createDataFrame(known, "header string, field string")
    named = (
        headers.select("source", F.posexplode("cells").alias("at", "cell"))
        .withColumn("header", F.lower(norm_ws("cell")))
        .join(F.broadcast(aliases), "header")
        .groupBy("source")
        .pivot("field", list(rules.HEADER_ALIASES))
        .agg(F.min("at"))
    )
    inferred = infer_columns(rows).select("source", F.col("name").alias("_name"), F.col("profile_url").alias("_url"))
    width = F.size("cells")
    joined = headers.join(named, "source", "left").join(inferred, "source", "left")
    of = {f: F.coalesce(F.col(f), F.lit(-1)) for f in rules.HEADER_ALIASES}
    of["name"] = F.coalesce(F.col("name"), F.col("_name"), F.when(width >= 1, 0), F.lit(-1))
    of["profile_url"] = F.coalesce(F.col("profile_url"), F.col("_url"), F.when(width >= 2, 1), F.lit(-1))
    pairs = [x for f, c in of.items() for x in (F.lit(f), c.cast("int"))]
    return joined.select("source", F.create_map(*pairs).alias("columns"))


def _record(**given: Column) -> Column:
    return F.struct(*[given.get(f, F.lit("")).alias(f) for f in RECORD])


def expand(rows: DataFrame, maps: DataFrame, defaults: DataFrame | None = None) -> DataFrame:
    """Records of seed rows: ``source, ord, part, row_number`` and the seven fields.

    Several distinct URLs in a row give a nameless record each; several equal
    URLs beside names give a record per pair of neighbours, in the orientation
    most of the row shows; any other row is one record. ``defaults`` holds
    ``source, school, college, fallback_title``.
    """
    df = looked_up(rows, maps, ["source"]).where("columns IS NOT NULL")
    if defaults is not None:
        named = [F.col(c).alias(f"_{c}") for c in ("school", "college", "fallback_title")]
        df = looked_up(df, defaults.select("source", *named), ["source"])
    default = {c: norm_ws(f"_{c}") if defaults is not None else F.lit("") for c in ("school", "college", "fallback_title")}
    cells = F.transform("cells", norm_ws)
    at = lambda f: cell(F.col("cells"), F.col("columns")[f])
    filled = lambda *c: F.coalesce(*[F.nullif(x, F.lit("")) for x in c], F.lit(""))
    urls = F.array_distinct(F.filter(cells, looks_like_url))
    by_url = F.transform(
        urls, lambda u: _record(profile_url=u, school=default["school"], college=default["college"], title=default["fallback_title"])
    )
    last = F.size(cells) - 1
    neighbours = F.sequence(F.lit(0), F.greatest(last - 1, F.lit(0)))
    pairs_of = lambda left, right: F.size(
        F.filter(neighbours, lambda i: (i < last) & left(F.get(cells, i)) & right(F.get(cells, i + 1)))
    )
    before_first = pairs_of(looks_like_name, looks_like_url) > pairs_of(looks_like_url, looks_like_name)
    named_at = lambda i: F.when((i >= 0) & looks_like_name(F.get(cells, i)), F.get(cells, i))
    beside = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.struct(
                F.when(before_first, F.coalesce(named_at(i - 1), named_at(i + 1)))
                .otherwise(F.coalesce(named_at(i + 1), named_at(i - 1)))
                .alias("name"),
                F.when(looks_like_url(F.get(cells, i)), F.get(cells, i)).alias("url"),
            ),
        ),
        lambda p: p["name"].isNotNull() & p["url"].isNotNull(),
    )
    by_pair = F.transform(
        F.array_distinct(beside),
        lambda p: _record(
            name=p["name"],
            profile_url=p["url"],
            school=default["school"],
            college=default["college"],
            title=filled(title.of_name(p["name"]), default["fallback_title"]),
        ),
    )
    several = (F.size(F.filter(cells, looks_like_url)) >= 2) & (F.size(F.filter(cells, looks_like_name)) >= 2)
    single = _record(
        name=at("name"),
        profile_url=at("profile_url"),
        school=filled(at("school"), default["school"]),
        college=filled(at("college"), default["college"]),
        title=filled(at("title"), title.of_name(at("name")), default["fallback_title"]),
        email=at("email"),
        intro=at("intro"),
    )
    records = F.when(F.size(urls) >= 2, by_url).when(several & (F.size(by_pair) > 0), by_pair).otherwise(F.array(single))
    return df.select("source", "ord", F.posexplode(records).alias("part", "record")).select(
        "source", "ord", "part", (F.col("ord") + 2).alias("row_number"), "record.*"
    )


def first_rows(rows: DataFrame, most: int) -> DataFrame:
    """The first ``most`` rows of every source in order (at least one); partial per task, so no source is drawn together."""
    rank = F.row_number().over(Window.partitionBy("source").orderBy("ord"))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= max(1, most)).drop("_rank")


def fill_forward(df: DataFrame, group: str, order: str, value: str, good: Column, default: Column, bucket: int = BUCKET) -> DataFrame:
    """``df`` with ``value`` replaced by the last good one at or before each row, else ``default``.

    ``order`` is a number unique within the group. Rows are filled within
    buckets of the order; what a bucket hands on is its last good value, found
    over the buckets alone, so a group of any size is spread over many tasks.
    """
    b = F.floor(F.col(order) / bucket)
    marked = df.withColumn("_bucket", b).withColumn("_good", F.when(good, F.col(value)))
    ends = marked.groupBy(group, "_bucket").agg(F.max_by("_good", F.when(F.col("_good").isNotNull(), F.col(order))).alias("_last"))
    earlier = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(group, "_bucket", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    within = Window.partitionBy(group, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        marked.withColumn("_seen", F.last("_good", ignorenulls=True).over(within))
        .join(carried, [group, "_bucket"], "left")
        .withColumn(value, F.coalesce("_seen", "_carried", default))
        .drop("_bucket", "_good", "_seen", "_carried")
    )


def fill_org_forward(df: DataFrame, group: str, order: str, school: Column | None = None, college: Column | None = None) -> DataFrame:
    """Blank, placeholder and malformed schools and colleges take the last good one of their group."""
    blank = F.lit("")
    good_school = org.looks_like_school("school") & ~org.is_placeholder_school("school")
    good_college = org.looks_like_college("college") & ~org.is_placeholder_college("college")
    df = df.withColumn("school", norm_ws("school")).withColumn("college", norm_ws("college"))
    df = fill_forward(df, group, order, "school", good_school, school if school is not None else blank)
    return fill_forward(df, group, order, "college", good_college, college if college is not None else blank)
