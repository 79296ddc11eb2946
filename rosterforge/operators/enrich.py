"""Seed records joined with captured pages; blank fields filled from the page, and a log of what happened.

Records have ``ord`` and the seven fields; pages have ``url, html``. The join
is on the URL without fragment; pages are made distinct before it, so a page is
read once however many records point to it. Records without URL or page pass
through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import email, org, title
from ..functions.names import name_of_page
from ..functions.text import filled, html_to_text, norm_ws, page_intro, text_of
from ..functions.url import image_urls, looks_like_url, without_fragment
from .seeds import RECORD


def distinct_pages(pages: DataFrame) -> DataFrame:
    """One page per URL without fragment (of several the least URL's), under ``page_key``."""
    return (
        pages.withColumn("page_key", without_fragment("url"))
        .groupBy("page_key")
        .agg(F.min_by("html", "url").alias("html"))
    )


def enriched(records: DataFrame, pages: DataFrame, ocr_text: Column | None = None) -> DataFrame:
    """``records`` with ``found`` (whether a page was there); the page's organisation overrides, blanks are filled."""
    keyed = records.withColumn("page_key", F.when(norm_ws("profile_url") != "", without_fragment(norm_ws("profile_url"))))
    # A key of its own for each record without URL: a missing one would send them all to one task.
    keyed = keyed.withColumn("page_key", F.coalesce("page_key", F.concat(F.lit("\u0001"), F.col("ord").cast("string"))))
    joined = keyed.join(distinct_pages(pages), "page_key", "left").withColumn("found", F.col("html").isNotNull())
    page = F.col("html")
    joined = joined.withColumn("_text", html_to_text(page)).withColumn("_org", org.org_of_page("profile_url", page))
    first = lambda *c: F.coalesce(*[filled(norm_ws(x)) for x in c], F.lit(""))
    nameless = (norm_ws("name") == "") | looks_like_url("name")
    joined = joined.withColumn("name", F.when(F.col("found") & nameless, first(name_of_page(page, "profile_url"), "name")).otherwise(text_of("name")))
    joined = joined.withColumn("_context", title.context_of("_text", "name"))
    ocr = None
    if ocr_text is not None:
        ocr = F.when(title.needs_ocr(page, "_text", image_urls(page, "profile_url")), ocr_text).otherwise(F.lit(""))
    given = {
        "school": first(F.col("_org.school"), "school"),
        "college": first(F.col("_org.college"), "college"),
        "email": first("email", email.extract(page, "_text", "_context", ocr)),
        "title": first("title", title.extract("_text", "_context", "name", ocr)),
        "intro": first("intro", page_intro(page, "_text")),
    }
    for field, value in given.items():
        joined = joined.withColumn(field, F.when(F.col("found"), value).otherwise(text_of(field)))
    keep = [c for c in records.columns if c not in RECORD]
    return joined.select(*keep, *RECORD, "found")


def enrichment_log(done: DataFrame, order: str = "ord") -> DataFrame:
    """Entries for records without URL, without page, and without a mail address or rank on their page."""
    without_url = norm_ws("profile_url") == ""
    messages = F.filter(
        F.array(
            F.when(without_url, F.struct(F.lit("warn").alias("severity"), F.lit("no profile URL, kept as it is").alias("message"))),
            F.when(~without_url & ~F.col("found"), F.struct(F.lit("error").alias("severity"), F.lit("page not captured").alias("message"))),
            F.when(F.col("found") & (norm_ws("email") == ""), F.struct(F.lit("info").alias("severity"), F.lit("no mail address found").alias("message"))),
            F.when(F.col("found") & (norm_ws("title") == ""), F.struct(F.lit("info").alias("severity"), F.lit("no rank found").alias("message"))),
        ),
        lambda m: m.isNotNull(),
    )
    return done.select(
        F.col(order).alias("row_no"), "name", F.col("profile_url").alias("url"), F.explode(messages).alias("m")
    ).select("m.severity", "row_no", "name", "url", "m.message")
