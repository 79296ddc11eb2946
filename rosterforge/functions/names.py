"""Names of people: cleaning, recognition, quality."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import markup, rules
from .text import HAN, SPACE, clean_intro, col, contains_any, html_to_text, let, norm_ws, person_name, strip, text_of
from .url import path_stem

_NAME = rf"^[{HAN}·]{{2,10}}$"


def clean_name(c: Column | str) -> Column:
    """Without bracketed parts, profile words and ranks before, after or beside the name."""
    prefix = rf"^(?:{'|'.join(rules.NAME_PREFIXES)})[{SPACE}]*[-—－]?[{SPACE}]*"
    ranks = "|".join(rules.NAME_RANK_WORDS)
    out = F.regexp_replace(norm_ws(c), r"[（(][^（）()]{1,30}[）)]", "")
    out = F.regexp_replace(out, rf"(?:{'|'.join(rules.NAME_PROFILE_WORDS)})$", "")
    for last in (r"项目$", None):
        for pattern in (prefix, rf"(?:{ranks})$", rf"(?<![^{SPACE}])(?:{ranks})(?![^{SPACE}])", last):
            if pattern:
                out = F.regexp_replace(out, pattern, "")
    return person_name(strip(F.regexp_replace(out, " +", " ")))


def looks_like_name(c: Column | str) -> Column:
    return person_name(c).rlike(_NAME)  # which no URL is


def quality_of_clean(n: Column) -> Column:
    """2 for a clean name, 1 if it holds an ideograph, else 0."""
    noisy = (n == "") | contains_any(n, rules.NAME_NOISE)
    return F.when(noisy, 0).when(n.rlike(_NAME), 2).when(n.rlike(rf"[{HAN}]"), 1).otherwise(0)


def name_quality(c: Column | str) -> Column:
    return let(clean_name(c), quality_of_clean)


def name_candidate(c: Column | str) -> Column:
    """First run of ideographs that looks like a name, or ''."""
    runs = F.transform(F.regexp_extract_all(norm_ws(c), F.lit(rf"[{HAN}·]{{2,10}}"), F.lit(0)), clean_name)
    named = F.filter(runs, lambda n: n.rlike(_NAME) & ~contains_any(n, rules.NAME_NOISE))
    return F.coalesce(F.get(named, F.lit(0)), F.lit(""))


def name_of_page(page: Column | str, url: Column | str) -> Column:
    """From the page title's parts, the first three meta contents, then the URL's stem."""
    title = clean_intro(html_to_text(F.regexp_extract(text_of(page), markup.PAGE_TITLE, 1)))
    metas = F.slice(F.regexp_extract_all(text_of(page), F.lit(markup.META_CONTENT), F.lit(1)), 1, 3)
    candidates = F.transform(F.concat(F.split(title, r"--|－|—|-"), metas, F.array(path_stem(url))), name_candidate)
    return F.coalesce(F.get(F.filter(candidates, lambda n: n != ""), F.lit(0)), F.lit(""))


def name_beside_title(text: Column | str, title: Column | str) -> Column:
    t = F.when(col(title) != "", F.replace(norm_ws(text), col(title), F.lit(" "))).otherwise(norm_ws(text))
    return clean_name(strip(F.regexp_replace(t, r"(?:硕导|博导|博士生导师|硕士生导师)$", "")))
