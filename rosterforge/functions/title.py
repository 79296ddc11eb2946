"""Academic ranks: occurrences with offsets, labelled ranks, the one nearest a name, normal forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import markup, rules
from .names import clean_name
from .text import HAN, contains_any, filled, let, matches_with_offsets, norm_ws, text_of

#: How far from a name a rank may stand.
NEAR = 40


def _pattern(alias: str) -> str:
    if alias.isascii():
        word = r"[\p{L}\p{N}_]"
        return rf"(?i)(?<!{word}){alias}(?!{word})"
    return alias


def collapse(c: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in rules.COLLAPSED_TITLES.items() for x in pair])
    return let(norm_ws(c), lambda t: F.coalesce(F.try_element_at(known, t), t))


def is_valid(c: Column) -> Column:
    return let(norm_ws(c), lambda t: t.rlike(rf"[{HAN}A-Za-z]") & ~t.isin(*rules.INVALID_TITLES))


def priority(c: Column) -> Column:
    """Place in the list of known ranks, or its length."""
    at = F.array_position(F.array(*[F.lit(t) for t in rules.TITLE_ORDER]), c)
    return F.when(at > 0, at - 1).otherwise(len(rules.TITLE_ORDER)).cast("int")


def _found(source: Column, title: str, alias: str) -> Column:
    place = rules.TITLE_ORDER.index(title)
    return F.transform(
        matches_with_offsets(source, _pattern(alias)),
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(place).alias("priority"),
            (m["start"] - m["end"]).alias("size"),
            m["end"].alias("end"),
            F.lit(title).alias("title"),
        ),
    )


def occurrences(source: Column | str) -> Column:
    """``array<struct<start, priority, size, end, title>>`` of every rank, sorted; ``size`` is negative length."""
    s = text_of(source)
    return F.array_sort(F.array_distinct(F.concat(*[_found(s, t, a) for t, english in rules.TITLES.items() for a in (t, *english)])))


def first_in(source: Column | str) -> Column:
    """First rank in a text other than the bare word for a teacher; ''."""
    usable = F.filter(occurrences(source), lambda m: is_valid(m["title"]))
    return F.coalesce(F.get(usable, F.lit(0))["title"], F.lit(""))


def near_name(source: Column | str, name: Column | str) -> Column:
    """The rank nearest the name's first occurrence, within NEAR signs; then by priority, then the first."""
    s = text_of(source)

    def nearest(n: Column) -> Column:
        return let(F.instr(s, n) - 1, lambda begin: F.when((n != "") & (begin >= 0), ranked(begin, begin + F.length(n))))

    def ranked(begin: Column, end: Column) -> Column:
        each = F.transform(
            occurrences(s),
            lambda m, i: F.struct(
                F.when(m["end"] <= begin, begin - m["end"]).when(m["start"] >= end, m["start"] - end).otherwise(0).alias("distance"),
                m["priority"].alias("priority"),
                i.alias("at"),
                m["title"].alias("title"),
            ),
        )
        return F.array_min(F.filter(each, lambda m: m["distance"] <= NEAR))["title"]

    return F.coalesce(let(clean_name(name), nearest), F.lit(""))


def by_level(c: Column) -> Column:
    return F.when(c.rlike(rules.FULL_LEVEL), "教授").when(c.rlike(rules.ASSOCIATE_LEVEL), "副教授").otherwise("")


def specific(c: Column | str) -> Column:
    return F.regexp_extract(norm_ws(c), rules.SPECIFIC_TITLE, 1)


def by_priority(c: Column) -> Column:
    out = F.lit("")
    for t in reversed(rules.PRIORITY_TITLES):
        hit = c.contains(t)
        for alias in rules.TITLES[t]:
            hit = hit | c.rlike(_pattern(alias))
        out = F.when(hit, t).otherwise(out)
    return out


def known_in(c: Column) -> Column:
    out = F.lit("")
    for t in reversed(rules.TITLE_ORDER):
        out = F.when(c.contains(t), t).otherwise(out)
    return out


def field_value(c: Column | str) -> Column:
    """A labelled value without a copula before it and the next label behind it."""
    out = F.regexp_replace(norm_ws(c), "^(?:为|是)", "")
    return norm_ws(F.regexp_replace(out, markup.NEXT_LABEL, ""))


def labelled(source: Column | str) -> Column:
    """The rank behind a label: by level, by its words, else the first token of the value; ''."""

    def value(v: Column) -> Column:
        token = F.left(F.get(F.split(v, "[，,；;。/ ]"), F.lit(0)), F.lit(20))
        return F.coalesce(*[filled(x) for x in (by_level(v), first_in(v), by_priority(v), known_in(v), specific(v), token)])

    captured = F.array(*[F.regexp_extract(text_of(source), p, 1) for p in markup.TITLE_LABELS])
    found = F.filter(F.transform(captured, lambda c: let(field_value(c), value)), lambda t: t.isNotNull())
    return F.coalesce(F.get(found, F.lit(0)), F.lit(""))


def extract(text: Column | str, context: Column | str, name: Column | str, ocr: Column | str | None = None) -> Column:
    """Per source, context first: labelled, near the name, anywhere; the first that is a rank."""
    kept = lambda x: F.when(is_valid(x), x)
    steps = lambda s: F.coalesce(let(labelled(s), kept), let(near_name(s, name), kept), let(first_in(s), kept))
    sources = (context, text, *([ocr] if ocr is not None else []))
    found = F.filter(F.transform(F.array(*map(text_of, sources)), lambda s: let(norm_ws(s), steps)), lambda t: t.isNotNull())
    return F.coalesce(F.get(found, F.lit(0)), F.lit(""))


def normalise(c: Column | str) -> Column:
    """A rank's normal form; unknown ranks as they are."""
    steps = lambda t: F.coalesce(
        filled(collapse(specific(t))), filled(collapse(first_in(t))), filled(by_priority(t)), filled(collapse(known_in(t))), collapse(t)
    )
    return let(norm_ws(c), steps)


def of_name(c: Column | str) -> Column:
    """Associate, lecturer or full, by containment in a name or a file stem."""
    t = norm_ws(c)
    return F.when(t.contains("副教授"), "副教授").when(t.contains("讲师"), "讲师").when(t.contains("教授"), "教授").otherwise("")


def context_of(text: Column | str, name: Column | str, before: int = 20, after: int = 400) -> Column:
    """The text around the name's first occurrence; ''."""
    from .text import strip

    def around(t: Column, n: Column) -> Column:
        at = F.instr(t, n)
        start = F.greatest(at - before, F.lit(1))
        return F.when((t != "") & (n != "") & (at > 0), F.substr(t, start, at + F.length(n) + after - start))

    found = let(strip(text_of(text)), lambda t: let(clean_name(name), lambda n: around(t, n)))
    return F.coalesce(found, F.lit(""))


def needs_ocr(page: Column | str, text: Column | str, images: Column) -> Column:
    """Whether a page's facts are likely in its images only."""
    from .text import content_block, html_to_text

    p, body = text_of(page), norm_ws(text)
    block = content_block(p)
    bare = block.contains(rules.CONTENT_IMAGE) & (F.length(norm_ws(html_to_text(block))) < 40)
    strong = contains_any(body, rules.STRONG_TOKENS)
    return (F.size(images) > 0) & (bare | (~strong & (p.contains(rules.CONTENT_IMAGE) | (F.length(body) < 200))))
