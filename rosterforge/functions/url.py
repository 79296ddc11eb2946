"""URLs by pattern, since strict parsers refuse what pages contain."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import col, norm_ws, text_of

_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)"


def looks_like_url(c: Column | str) -> Column:
    return F.lower(norm_ws(c)).rlike("^https?://")


def without_fragment(c: Column | str) -> Column:
    return F.regexp_replace(text_of(c), r"#[\s\S]*$", "")


def scheme(c: Column | str) -> Column:
    return F.lower(F.regexp_extract(text_of(c), _SPLIT, 1))


def host(c: Column | str) -> Column:
    return F.lower(F.regexp_extract(text_of(c), _SPLIT, 2))


def path(c: Column | str) -> Column:
    return F.regexp_extract(text_of(c), _SPLIT, 3)


def path_stem(c: Column | str) -> Column:
    """Last part of the path without its suffix."""
    last = F.regexp_extract(F.regexp_replace(path(c), "/+$", ""), r"([^/]*)$", 1)
    return F.regexp_replace(last, r"(?<=.)\.[^.]*$", "")


def site_root(c: Column | str) -> Column:
    """``scheme://host``, or '' if either is missing."""
    both = (scheme(c) != "") & (host(c) != "")
    return F.when(both, F.concat(scheme(c), F.lit("://"), F.regexp_extract(text_of(c), _SPLIT, 2))).otherwise(F.lit(""))


def profile_key(c: Column | str) -> Column:
    """Host and path in lower case, without scheme, locale, index page, query, fragment and slashes at the end."""
    u = norm_ws(c)
    p = F.regexp_replace(path(u), r"(?i)/(?:zh_CN|en|en_US|cn)(?=/|$)", "")
    p = F.regexp_replace(F.regexp_replace(p, r"(?i)/index\.html?$", ""), "/+$", "")
    return F.concat(host(u), F.lower(p))


def resolve(base: Column | str, link: Column | str) -> Column:
    """Absolute form of a link as pages write them; dots in paths are left to ``resolve_all``."""
    b, x = text_of(base), text_of(link)
    folder = F.regexp_replace(F.regexp_replace(b, r"[?#].*$", ""), r"(?<=[^/:])/[^/]*$", "")
    return (
        F.when(x == "", b)
        .when(x.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), x)
        .when(x.startswith("//"), F.concat(scheme(b), F.lit(":"), x))
        .when(x.startswith("/"), F.concat(site_root(b), x))
        .when(x.startswith("#"), F.concat(without_fragment(b), x))
        .otherwise(F.concat(folder, F.lit("/"), x))
    )


@F.pandas_udf(StringType())
def resolve_all(base: pd.Series, link: pd.Series) -> pd.Series:
    """Absolute form of any link."""
    return pd.Series([urljoin(b or "", x or "") for b, x in zip(base, link)])


def image_urls(page: Column | str, page_url: Column | str) -> Column:
    """Distinct image addresses of a page, resolved against the page itself."""
    from . import markup

    raw = F.filter(F.transform(F.regexp_extract_all(text_of(page), F.lit(markup.IMAGE), F.lit(1)), norm_ws), lambda x: x != "")
    return F.array_distinct(
        F.transform(raw, lambda x: F.when(x.startswith("//"), F.concat(F.lit("https:"), x)).otherwise(resolve(col(page_url), x)))
    )
