"""The lighter extraction profile: fewer steps, no scores, no entities beyond six. For clean sources and quick passes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules, title
from .text import col, first_body_line, meta_description, squeeze, text_of, truncate

ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
NAME_WORDS = "教授|副教授|讲师|博士|硕导|博导|老师"
TITLE_LABELS = (r"职\s*称\s*[:：]\s*([^\n]{0,30})", r"职\s*务\s*[:：]\s*([^\n]{0,30})")


def norm_ws(c: Column | str) -> Column:
    return squeeze(F.translate(text_of(c), " 　\t\r", "   \n"))


def unescape(c: Column | str) -> Column:
    out = text_of(c)
    for entity, sign in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(sign))
    return out


def clean_name(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(norm_ws(c), f"(?:{NAME_WORDS})$", ""))


def addresses(c: Column | str) -> Column:
    """Distinct addresses of any top-level domain, as they stand."""
    return F.array_distinct(F.regexp_extract_all(text_of(c), F.lit(EMAIL), F.lit(0)))


def extract_email(page: Column | str, text: Column | str, context: Column | str) -> Column:
    """First acceptable address in context, page, text; no scores."""
    from .email import first_usable, undisguise

    tries = [F.nullif(first_usable(addresses(undisguise(s))), F.lit("")) for s in (context, page, text)]
    return F.coalesce(*tries, F.lit(""))


def extract_title(text: Column | str, context: Column | str) -> Column:
    """Labelled with a colon, else the first rank anywhere."""
    tries = []
    for s in (norm_ws(context), norm_ws(text)):
        for p in TITLE_LABELS:
            value = F.regexp_extract(s, p, 1)
            tries += [F.nullif(x, F.lit("")) for x in (title.by_level(value), title.first_in(value), title.by_priority(value))]
        tries.append(F.nullif(title.first_in(s), F.lit("")))
    return F.coalesce(*tries, F.lit(""))


def extract_intro(page: Column | str, text: Column | str) -> Column:
    return truncate(F.coalesce(F.nullif(meta_description(page), F.lit("")), first_body_line(text)), 200)


def context_of(text: Column | str, name: Column | str) -> Column:
    return title.context_of(text, name, before=120, after=240)


def normalise_title(c: Column | str) -> Column:
    t = norm_ws(c)
    filled = lambda x: F.nullif(x, F.lit(""))
    return F.coalesce(filled(title.first_in(t)), filled(title.by_priority(t)), filled(title.known_in(t)), t)


def header_position(headers: Column, field: str) -> Column:
    """First column whose header is a spelling of the field, by aliases only; else 0 for names and 1 for URLs; else -1."""
    lowered = F.transform(headers, lambda h: F.lower(norm_ws(h)))
    at = F.array_min(
        F.transform(F.array(*[F.lit(a) for a in rules.HEADER_ALIASES[field]]), lambda a: F.nullif(F.array_position(lowered, a), F.lit(0)))
    )
    return F.coalesce(at - 1, F.lit({"name": 0, "profile_url": 1}.get(field, -1))).cast("int")


def clamp(c: Column | str, low: int, high: int) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(col(c).try_cast("int"), F.lit(low))))
