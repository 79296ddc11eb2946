"""Text expressions: entities, white space, HTML to text, intros. Column in, Column out; NULL counts as ''."""

from __future__ import annotations

import html
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import markup, rules

#: White space as a class for Java and RE2 patterns.
SPACE = r"\x09-\x0d\x1c-\x20\x85\p{Z}"
#: The same signs one by one, for trimming.
SPACES = "".join(chr(n) for n in range(0x3001) if chr(n).isspace())
HAN = r"\x{4e00}-\x{9fa5}"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_of(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often the body refers to it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def filled(c: Column) -> Column:
    """NULL for ''; unlike ``nullif`` it doesn't repeat a long expression."""
    return let(c, lambda v: F.when(v != "", v))


def contains_any(c: Column, tokens: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for t in tokens:
        out = out | c.contains(t)
    return out


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(SPACES))


def unescape(c: Column | str) -> Column:
    """Common named entities; the ampersand last, so that nothing is decoded twice. A plain column without one is left as it is."""
    out = text_of(c)
    for entity, sign in rules.ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(sign))
    return F.when(text_of(c).contains("&"), out).otherwise(text_of(c)) if isinstance(c, str) else out


@F.pandas_udf(StringType())
def unescape_all(s: pd.Series) -> pd.Series:
    """Every HTML entity; for columns where the common ones don't suffice."""
    return s.map(lambda x: html.unescape(x) if x else x)


def squeeze(c: Column) -> Column:
    """Single spaces, at most one blank line, nothing around."""
    return strip(F.regexp_replace(F.regexp_replace(c, " +", " "), "\n{3,}", "\n\n"))


def norm_ws(c: Column | str) -> Column:
    """Entities decoded, byte order marks dropped, spaces unified and squeezed."""
    out = unescape(c)
    out = F.replace(F.replace(out, F.lit("﻿"), F.lit("")), F.lit("ï»¿"), F.lit(""))
    return squeeze(F.translate(out, " 　\t\r", "   \n"))


def person_name(c: Column | str) -> Column:
    """Without white space between ideographs."""
    return F.regexp_replace(norm_ws(c), rf"(?<=[{HAN}])[{SPACE}]+(?=[{HAN}])", "")


def html_to_text(c: Column | str) -> Column:
    out = text_of(c)
    for pattern, by in (
        (r"(?i)<script[\s\S]*?</script>", " "), (r"(?i)<style[\s\S]*?</style>", " "), (r"(?i)<br\s*/?>", "\n"), (r"(?i)</p>", "\n"), (r"<[^>]+>", " "),
    ):
        out = F.regexp_replace(out, pattern, by)
    return squeeze(unescape(out))


def clean_intro(c: Column | str) -> Column:
    return F.regexp_replace(norm_ws(c), r"(?i)^View\s+(?:English|Chinese)\s+CV\s*", "")


def truncate(c: Column | str, most: int) -> Column:
    short = lambda t: F.when(F.length(t) > most, F.concat(F.left(t, F.lit(most)), F.lit("..."))).otherwise(t)
    return let(clean_intro(c), short)


def compact(c: Column | str) -> Column:
    """One line."""
    return F.regexp_replace(norm_ws(c), rf"[{SPACE}]*\n[{SPACE}]*", " ")


def looks_like_navigation(c: Column | str) -> Column:
    return contains_any(col(c), rules.NAVIGATION)


def is_valid_intro(c: Column | str) -> Column:

    def judge(t: Column) -> Column:
        bad = F.lit(False)
        for p in rules.BAD_INTRO_PREFIXES:
            bad = bad | t.startswith(p)
        contacts = sum((t.contains(x).cast("int") for x in rules.CONTACT_TOKENS), F.lit(0))
        return (F.length(t) >= 8) & ~bad & (contacts < 2)

    return let(clean_intro(c), judge)


def more_han_than_latin(c: Column | str) -> Column:
    return F.regexp_count(col(c), F.lit(rf"[{HAN}]")) >= F.regexp_count(col(c), F.lit("[A-Za-z]"))


def named_sections(page: Column | str) -> Column:
    """``array<struct<title, html>>`` of a page's titled blocks."""
    p = text_of(page)
    titles, blocks = (F.regexp_extract_all(p, F.lit(markup.SECTION), F.lit(i)) for i in (1, 2))
    return F.zip_with(titles, blocks, lambda t, b: F.struct(norm_ws(t).alias("title"), b.alias("html")))


def section_intro(page: Column | str) -> Column:
    usable = F.filter(
        F.transform(
            F.filter(named_sections(page), lambda s: s["title"].isin(*rules.INTRO_SECTIONS)),
            lambda s: clean_intro(html_to_text(s["html"])),
        ),
        is_valid_intro,
    )
    return F.coalesce(F.get(usable, F.lit(0)), F.lit(""))


def content_block(page: Column | str) -> Column:
    """The marked block of a page's content, with its tags; ''."""
    return F.regexp_extract(text_of(page), markup.CONTENT_BLOCK, 0)


def meta_description(page: Column | str) -> Column:
    return norm_ws(F.regexp_extract(text_of(page), markup.META_DESCRIPTION, 1))


def first_body_line(text: Column | str) -> Column:
    lines = F.filter(
        F.transform(F.split(text_of(text), "\n"), norm_ws),
        lambda x: (F.length(x) >= 20) & ~looks_like_navigation(x) & is_valid_intro(x),
    )
    return F.coalesce(F.get(lines, F.lit(0)), F.lit(""))


def page_intro(page: Column | str, text: Column | str) -> Column:
    """Titled section, else meta description, else first line of content; at most 200 signs."""
    meta = let(meta_description(page), lambda m: F.when(is_valid_intro(m), m))
    return truncate(F.coalesce(filled(section_intro(page)), meta, first_body_line(text)), 200)


def card_intro(c: Column | str) -> Column:
    """Text of a card without its labelled addresses."""
    out = norm_ws(c)
    for label in ("邮箱", "电子邮件"):
        out = F.regexp_replace(out, rf"{label}\s*[:：]?\s*{markup.EMAIL}", "")
    return clean_intro(out)


def matches_with_offsets(text: Column, pattern: str) -> Column:
    """``array<struct<start, end, found>>``: the gaps and matches of a split give every offset, without a UDF."""
    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: _with_offsets(found, F.split(text, pattern, -1))
    )


def _with_offsets(found: Column, gaps: Column) -> Column:
    empty = F.array().cast("array<struct<start:int,end:int,found:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["found"])
        here = F.struct(begin.alias("start"), end.alias("end"), pair["found"].alias("found"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(here)).alias("out"))

    pairs = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, f: F.struct(g.alias("gap"), f.alias("found")))
    return F.when(F.size(found) == 0, empty).otherwise(F.aggregate(pairs, start, step, lambda acc: acc["out"]))
