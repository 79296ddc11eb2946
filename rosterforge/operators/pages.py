"""Rows out of pages: links, cards and widgets of listing pages, encrypted spans, images.

Pages are rows of ``url, html``. Generators keep the order of the page and give
each item once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import email, markup, rules, title
from ..functions.names import clean_name, looks_like_name, name_beside_title
from ..functions.text import card_intro, clean_intro, filled, html_to_text, norm_ws, text_of
from ..functions.url import resolve, site_root

ITEM = ("url", "at", "name", "profile_url", "title", "email", "intro")


def _first_of_each(items: DataFrame) -> DataFrame:
    once = Window.partitionBy("url", "name", "profile_url").orderBy("at")
    kept = items.withColumn("_n", F.row_number().over(once)).where("_n = 1").drop("_n")
    return kept.withColumn("at", F.row_number().over(Window.partitionBy("url").orderBy("at")))


def limited(items: DataFrame, most: int | None) -> DataFrame:
    return items if not most else items.where(F.col("at") <= max(1, most))


def list_links(pages: DataFrame, most: int | None = None) -> DataFrame:
    """Distinct (name, URL) of the profile links whose text is a name, in page order."""
    p = text_of("html")
    pairs = F.arrays_zip(
        F.regexp_extract_all(p, F.lit(markup.LIST_LINK), F.lit(1)).alias("href"),
        F.regexp_extract_all(p, F.lit(markup.LIST_LINK), F.lit(2)).alias("inner"),
    )
    each = pages.select("url", F.posexplode(pairs).alias("at", "link")).select("url", "at", "link.*")
    tight = F.regexp_replace(clean_intro(html_to_text("inner")), r"(?U)\s+", "")
    named = each.select(
        "url",
        "at",
        clean_name(tight).alias("name"),
        resolve("url", norm_ws("href")).alias("profile_url"),
        title.of_name(tight).alias("title"),
        F.lit("").alias("email"),
        F.lit("").alias("intro"),
    ).where((F.col("name") != "") & looks_like_name("name"))
    return limited(_first_of_each(named), most)


def list_cards(pages: DataFrame, most: int | None = None) -> DataFrame:
    """Cards of a listing page; nameless ones keep an empty name for ``card_log``."""
    p = text_of("html")
    after = F.locate(rules.CARD_SCRIPT.lower(), F.lower(p))
    listed = F.when(after > 0, F.regexp_extract(F.substr(p, after), markup.LIST, 1))
    items = F.regexp_extract_all(F.coalesce(F.nullif(listed, F.lit("")), p), F.lit(markup.ITEM), F.lit(1))
    parts = (markup.CARD_LINK, *markup.CARD_BLOCKS, markup.CARD_HEAD, markup.CARD_BODY)
    is_card = lambda item: reduce(Column.__and__, [item.rlike(part) for part in parts])
    each = pages.select("url", F.posexplode(F.filter(items, is_card)).alias("at", "item")).select(
        "url",
        "at",
        *[F.regexp_extract("item", part, 1).alias(n) for n, part in (("href", markup.CARD_LINK), ("head", markup.CARD_HEAD), ("body", markup.CARD_BODY))],
    )
    head, body = clean_intro(html_to_text("head")), clean_intro(html_to_text("body"))
    both = norm_ws(F.concat(head, F.lit("\n"), body))
    rank = F.coalesce(filled(title.normalise(head)), title.extract(both, both, clean_name(head)))
    each = each.withColumn("_head", head).withColumn("_both", both).withColumn("_body", body).withColumn("title", rank)
    return each.select(
        "url",
        F.row_number().over(Window.partitionBy("url").orderBy("at")).alias("at"),
        name_beside_title("_head", "title").alias("name"),
        F.when(norm_ws("href") == "#", F.col("url")).otherwise(resolve("url", norm_ws("href"))).alias("profile_url"),
        "title",
        email.extract(F.lit(""), "_both", "_both").alias("email"),
        card_intro("_body").alias("intro"),
    ).where(F.lit(True) if not most else F.col("at") <= max(1, most))


def list_widgets(pages: DataFrame, most: int | None = None) -> DataFrame:
    """Items of script arrays (titles, ids, summaries by position) joined with hidden links by id."""
    p = text_of("html")
    as_array = lambda raw: F.transform(F.coalesce(F.from_json(raw, "array<string>"), F.array().cast("array<string>")), norm_ws)
    titles = F.lit(markup.script_array(rules.WIDGET_PREFIX + "_title"))
    found = F.arrays_zip(
        F.regexp_extract_all(p, titles, F.lit(1)).alias("prefix"), F.regexp_extract_all(p, titles, F.lit(2)).alias("titles")
    )
    widgets = pages.select("url", F.posexplode(found).alias("w", "widget"), p.alias("html")).select(
        "url", "w", "widget.prefix", F.col("widget.titles").alias("titles"), "html"
    )

    def of_prefix(pattern: str) -> Column:
        """A pattern with the row's prefix in place of a mark."""
        return F.replace(F.lit(pattern), F.lit("PREFIX"), F.col("prefix"))

    array_of = lambda kind: F.coalesce(
        F.get(F.regexp_extract_all("html", of_prefix(markup.script_array(f"PREFIX_{kind}")), F.lit(1)), F.lit(0)), F.lit("[]")
    )
    hidden = of_prefix(markup.any_case(markup.opening("a", id=r"PREFIX_(\d+)_a", href=markup.VALUE)))
    zipped = F.arrays_zip(
        as_array(F.col("titles")).alias("title"), as_array(array_of("id")).alias("id"), as_array(array_of("summary")).alias("summary")
    )
    items = widgets.select("url", "w", "prefix", F.posexplode(zipped).alias("i", "item")).select("url", "w", "prefix", "i", "item.*")
    links = widgets.select(
        "url",
        "prefix",
        F.explode(
            F.arrays_zip(
                F.regexp_extract_all("html", hidden, F.lit(1)).alias("id"), F.regexp_extract_all("html", hidden, F.lit(2)).alias("href")
            )
        ).alias("l"),
    ).select("url", "prefix", "l.id", "l.href")
    links = links.groupBy("url", "prefix", "id").agg(F.last("href").alias("href"))
    joined = items.where("title IS NOT NULL AND id IS NOT NULL").join(links, ["url", "prefix", "id"])
    summary = F.coalesce("summary", F.lit(""))
    named = joined.select(
        "url",
        (F.col("w") * 1_000_000 + F.col("i")).alias("at"),
        clean_name("title").alias("name"),
        resolve("url", norm_ws("href")).alias("profile_url"),
        title.of_name(summary).alias("title"),
        F.lit("").alias("email"),
        clean_intro(summary).alias("intro"),
    ).where((F.col("name") != "") & looks_like_name("name"))
    return limited(_first_of_each(named), most)


def list_items(pages: DataFrame, most: int | None = None) -> DataFrame:
    """Per page the items of the first kind that gives any: cards, links, widgets."""
    cards = list_cards(pages, most).where("name <> ''")
    links = list_links(pages, most)
    links = links.join(cards.select("url").distinct(), "url", "left_anti")
    rest = list_widgets(pages, most)
    rest = rest.join(cards.select("url").union(links.select("url")).distinct(), "url", "left_anti")
    return cards.select(*ITEM).unionByName(links.select(*ITEM)).unionByName(rest.select(*ITEM))


def card_log(pages: DataFrame) -> DataFrame:
    """Log entries of nameless cards, and of pages without any item."""
    entry = lambda level, row, message: [F.lit(level).alias("severity"), row.alias("row_no"), F.lit("").alias("name"), F.col("url"), F.lit(message).alias("message")]
    nameless = list_cards(pages).where("name = ''").select(*entry("warn", F.col("at").cast("long"), "card without a name, skipped"))
    empty = pages.join(list_items(pages).select("url").distinct(), "url", "left_anti")
    return nameless.unionByName(empty.select(*entry("error", F.lit(None).cast("long"), "no items on the listing page")))


def decode_spans(pages: DataFrame, decode: Callable[[Column, Column, Column], Column] | None = None) -> DataFrame:
    """``pages`` with encrypted spans replaced by what ``decode(root, field, content)`` gives; as they are without one.

    ``decode`` takes and gives columns, evaluated per span within its row, so repeated URLs stay apart.
    """
    if decode is None:
        return pages
    p = text_of("html")
    spans, fields, contents = (F.regexp_extract_all(p, F.lit(markup.ENCRYPTED_SPAN), F.lit(i)) for i in (0, 1, 2))
    gaps = F.split(p, markup.ENCRYPTED_SPAN, -1)
    given = pages.withColumn("_root", site_root("url")).withColumn("_gaps", gaps).withColumn(
        "_spans", F.arrays_zip(spans.alias("span"), fields.alias("field"), contents.alias("content"))
    )
    opened = rf"(?i)style\s*=\s*[\"'][^\"']*display\s*:\s*none;?[^\"']*[\"']|{rules.ENCRYPTED}\s*=\s*[\"'][^\"']*[\"']"

    def shown(s: Column) -> Column:
        plain = decode(F.col("_root"), norm_ws(s["field"]), norm_ws(s["content"]))
        tag = F.regexp_replace(F.regexp_extract(s["span"], r"^<span[^>]*>", 0), opened, "")
        return F.when((F.col("_root") != "") & (plain != ""), F.concat(tag, plain, F.lit("</span>"))).otherwise(s["span"])

    filled = F.zip_with("_gaps", F.transform("_spans", shown), lambda g, n: F.concat(F.coalesce(g, F.lit("")), F.coalesce(n, F.lit(""))))
    return given.withColumn("html", F.when(F.size("_spans") > 0, F.array_join(filled, "")).otherwise(F.col("html"))).select(*pages.columns)
