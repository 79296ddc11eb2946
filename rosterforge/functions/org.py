"""Schools and colleges: recognition, placeholders, extraction from names and pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import markup, rules
from .text import SPACE, clean_intro, col, html_to_text, let, norm_ws, text_of
from .url import host


def _ends(c: Column, suffixes: tuple[str, ...]) -> Column:
    return c.rlike(f"(?:{'|'.join(suffixes)})$")


def looks_like_school(c: Column | str) -> Column:
    return let(norm_ws(c), lambda n: (F.length(n) >= 4) & _ends(n, rules.SCHOOL_SUFFIXES) & ~n.contains("系"))


def looks_like_college(c: Column | str) -> Column:
    return let(norm_ws(c), lambda n: (F.length(n) >= 2) & _ends(n, rules.COLLEGE_SUFFIXES))


def _placeholder(c: Column | str, suffixes: tuple[str, ...]) -> Column:
    bare = F.replace(F.lower(norm_ws(c)), F.lit(" "), F.lit(""))
    return bare.rlike(rf"^(?:x{{2,}}(?:{'|'.join(suffixes)}))?$") & ~bare.contains("\n")


def is_placeholder_school(c: Column | str) -> Column:
    return _placeholder(c, rules.SCHOOL_SUFFIXES)


def is_placeholder_college(c: Column | str) -> Column:
    return _placeholder(c, rules.PLACEHOLDER_COLLEGE_SUFFIXES)


def org_name(c: Column | str) -> Column:
    out = F.regexp_replace(text_of(c), r"[（(].*?[）)]", "")
    return F.trim(F.regexp_replace(F.regexp_replace(out, rf"[{SPACE}]+", ""), r"^[-_ ]+|[-_ ]+$", ""))


def extract_school(c: Column | str) -> Column:
    """Longest part that looks like a school, the first of equals; '' if none does."""
    signs = r"[\x{4e00}-\x{9fa5}A-Za-z0-9·（）()]+"
    # The second alternative takes what holds no further suffix at once, where the lazy one would be tried at every sign.
    found = F.concat(
        *[F.regexp_extract_all(text_of(c), F.lit(rf"({signs}?{s})|{signs}"), F.lit(1)) for s in rules.SCHOOL_SUFFIXES]
    )
    usable = F.filter(F.transform(found, org_name), looks_like_school)
    ranked = F.transform(usable, lambda x, i: F.struct((-F.length(x)).alias("size"), i.alias("at"), x.alias("found")))
    return F.coalesce(F.array_min(ranked)["found"], F.lit(""))


def name_parts(c: Column | str) -> Column:
    """Non-blank parts between dashes and underscores."""
    return F.filter(F.transform(F.split(text_of(c), "[-_]"), org_name), lambda p: p != "")


def extract_college(c: Column | str, school: Column | str) -> Column:
    """First part that ends like a college, before any that ends like a smaller unit; '' if none does."""
    s = text_of(school)
    parts = F.filter(
        F.transform(name_parts(c), lambda p: F.when((s != "") & p.startswith(s), F.substr(p, F.length(s) + 1)).otherwise(p)),
        looks_like_college,
    )
    main = F.filter(parts, lambda p: p.rlike("(?:学院|研究院)$"))
    return F.coalesce(F.get(main, F.lit(0)), F.get(parts, F.lit(0)), F.lit(""))


def clean_stem(c: Column | str) -> Column:
    """File stem without noise words and a trailing ``(n)``; single dashes between parts."""
    out = reduce(lambda x, w: F.replace(x, F.lit(w), F.lit("")), rules.STEM_NOISE, text_of(c))
    out = F.regexp_replace(F.regexp_replace(out, r"\(\d+\)$", ""), "[-_]+", "-")
    return F.regexp_replace(out, "^[- ]+|[- ]+$", "")


def college_of_stem(c: Column | str) -> Column:
    """First part that names a unit, else the whole stem."""
    n = norm_ws(c)
    parts = F.filter(F.split(n, rf"[-_—{SPACE}]+"), lambda p: p.rlike("学院|学部|研究院|中心|系"))
    return F.coalesce(F.get(parts, F.lit(0)), F.nullif(n, F.lit("")), F.lit("未填写学院"))


def school_by_domain(url: Column | str, domains: dict[str, str] = rules.SCHOOL_DOMAINS) -> Column:
    """School of the first domain that the host is or ends in; '' if none."""
    h, out = host(url), None
    for domain, school in domains.items():
        hit = (h == domain) | h.endswith("." + domain)
        out = F.when(hit, school) if out is None else out.when(hit, school)
    return F.lit("") if out is None else out.otherwise(F.lit(""))


def join_school_by_host(rows: DataFrame, url: str, domains: DataFrame) -> DataFrame:
    """``rows`` with ``site_school`` of the longest domain (``source, school``) that their host is or ends in.

    Every suffix of a host is looked up by equality, so the match is a hash join
    however many domains there are.
    """
    labels = F.split("_host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")
    )
    hosts = rows.select(host(F.col(url)).alias("_host")).distinct()
    each = hosts.select("_host", F.posexplode(suffixes).alias("_at", "source"))
    best = (
        each.join(domains.select("source", F.col("school").alias("_school")), "source")
        .groupBy("_host")
        .agg(F.min_by("_school", F.struct("_at", "_school")).alias("site_school"))
    )
    return rows.withColumn("_host", host(F.col(url))).join(best, "_host", "left").drop("_host").fillna("", ["site_school"])


def org_of_page(url: Column | str, page: Column | str) -> Column:
    """``struct<school, college>`` from the domain, then page title, meta title, end and beginning of the text."""
    p = text_of(page)
    parts = F.array(F.regexp_extract(p, markup.PAGE_TITLE, 1), F.regexp_extract(p, markup.META_PAGE_TITLE, 1), F.right(p, F.lit(6000)), F.left(p, F.lit(12000)))
    first = lambda found: F.coalesce(F.get(F.filter(found, lambda s: s != ""), F.lit(0)), F.lit(""))

    def within(scopes: Column) -> Column:
        school = first(F.concat(F.array(school_by_domain(url)), F.transform(scopes, extract_school)))
        return let(
            school,
            lambda s: F.struct(s.alias("school"), first(F.transform(scopes, lambda x: extract_college(x, s))).alias("college")),
        )

    return let(F.transform(parts, lambda x: clean_intro(html_to_text(x))), within)


def default_org(school: Column | str, college: Column | str, page_org: Column | None, stem: Column | str) -> Column:
    """``struct<school, college>``: the page overrides what is given, the stem fills what is blank."""
    s, c = norm_ws(school), norm_ws(college)
    if page_org is not None:
        s = F.coalesce(F.nullif(page_org["school"], F.lit("")), s)
        c = F.coalesce(F.nullif(page_org["college"], F.lit("")), c)
    cleaned = clean_stem(col(stem))
    s = F.coalesce(F.nullif(s, F.lit("")), extract_school(cleaned))
    c = F.coalesce(F.nullif(c, F.lit("")), extract_college(cleaned, s))
    return F.struct(s.alias("school"), c.alias("college"))
