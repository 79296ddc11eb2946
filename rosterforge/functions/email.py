"""Mail addresses: disguised forms, candidates with offsets, scores by what stands around them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import markup, rules
from .text import SPACE, col, contains_any, filled, html_to_text, let, matches_with_offsets, norm_ws, text_of

_CANDIDATES = "array<struct<score:int,email:string>>"


def undisguise(c: Column | str) -> Column:
    """``[at]``, ``(dot)``, full-width signs and gaps around the signs of an address, as plain signs."""
    out = text_of(c)
    tld = r"(?:com|cn|edu|net|org|gov)"
    for pattern, by in (
        (r"(?i)\[at\]|\(at\)|（at）", "@"), (r"(?i)\[dot\]|\(dot\)|（dot）", "."), (r"&#64;|＠", "@"), ("。", "."),
        (rf"(?i)(?<=[A-Za-z0-9._%+-])[{SPACE}]*[#＃][{SPACE}]*(?=[A-Za-z0-9.-]+\.{tld}(?![A-Za-z0-9_]))", "@"),
        (rf"[{SPACE}]*@[{SPACE}]*", "@"), (rf"[{SPACE}]*\.[{SPACE}]*", "."), (rf"(?U)(?<=\w)[{SPACE}]+(?=[A-Za-z0-9._%+-]+@)", ""), ("(?i)mailto:", ""),
    ):
        out = F.regexp_replace(out, pattern, by)
    return out


def trimmed(c: Column | str) -> Column:
    """A candidate without punctuation around it and signs before it."""
    marks = r"[.,;:，。；：()\[\]{}<>]+"
    out = F.regexp_replace(norm_ws(c), f"^{marks}|{marks}$", "")
    return F.regexp_replace(out, r"(?U)^[\W_]+(?=[A-Za-z0-9])", "")


def is_public(email: Column) -> Column:
    """Mailboxes of offices rather than people, by their local part."""
    local = F.lower(F.substring_index(email, "@", 1))
    return local.isin(*rules.PUBLIC_MAILBOXES) | contains_any(local, rules.PUBLIC_MAILBOX_PARTS)


def score(source: Column, start: Column, end: Column, email: Column) -> Column:
    """Additive evidence within 200 signs on either side, and the place within the source."""
    left = F.greatest(start - 200, F.lit(0))
    window = F.substr(source, left + 1, F.least(F.length(source), end + 200) - left)
    return let(window, lambda w: _weighed(w, start / F.greatest(F.length(source), F.lit(1)), is_public(email)))


def _weighed(window: Column, at: Column, public: Column) -> Column:
    near = {k: contains_any(window, v) for k, v in rules.AROUND.items()}
    own = near["label"] & ~public
    loose = ~near["section"] & ~own
    weigh = lambda condition, weight: F.when(condition, weight).otherwise(0)
    return (
        F.lit(10)
        + weigh(near["label"], 30)
        + weigh(own, 50)
        + weigh(near["profile"], 15)
        + weigh(near["complaint"], -80)
        + weigh(near["section"], 45)
        + weigh(near["footer"] & near["footer_contact"], -180)
        + weigh(near["footer"] & loose, -50)
        + weigh(window.contains("地址：") & window.contains("电话"), -40)
        + F.when(at <= 0.45, 15).when((at >= 0.82) & loose, -80).when((at >= 0.70) & loose, -35).otherwise(0)
        + weigh(public, -50)
    )


def candidates(source: Column | str, kind: str | Column) -> Column:
    """``array<struct<score, email>>`` of a plain source: the first occurrence of every address."""
    bonus = F.lit(rules.SOURCE_BONUS.get(kind, 0)) if isinstance(kind, str) else kind

    def each(s: Column) -> Column:
        found = F.filter(
            F.transform(
                matches_with_offsets(s, markup.EMAIL),
                lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), trimmed(m["found"]).alias("email")),
            ),
            lambda m: m["email"] != "",
        )
        return F.transform(
            let(found, _first_of_each),
            lambda m: F.struct(
                (score(s, m["start"], m["end"], m["email"]) + bonus).cast("int").alias("score"), m["email"].alias("email")
            ),
        )

    return let(text_of(source), each)


def _first_of_each(found: Column) -> Column:
    seen = F.transform(found, lambda m: F.lower(m["email"]))
    return let(seen, lambda e: F.filter(found, lambda m, i: F.array_position(e, F.lower(m["email"])) == i + 1))


def best(scored: Column, least: int = 1) -> Column:
    """Highest score, then greatest address, in lower case; '' below ``least``."""
    top = F.array_max(F.transform(scored, lambda c: F.struct(c["score"].alias("score"), F.lower(c["email"]).alias("email"))))
    return F.coalesce(let(top, lambda t: F.when(t["score"] >= least, t["email"])), F.lit(""))


def addresses(c: Column | str) -> Column:
    """Distinct addresses in order, without regard to case."""
    found = F.filter(F.transform(F.regexp_extract_all(text_of(c), F.lit(markup.EMAIL), F.lit(0)), trimmed), lambda e: e != "")
    lowered = F.transform(found, F.lower)
    return F.filter(found, lambda e, i: F.array_position(lowered, F.lower(e)) == i + 1)


def first_usable(found: Column) -> Column:
    """First address outside the placeholder domains, else the first; '' if none."""
    bad = "(?i)@(?:" + "|".join(d.replace(".", r"\.") for d in rules.BAD_EMAIL_DOMAINS) + ")$"
    return F.coalesce(F.get(F.filter(found, lambda e: ~e.rlike(bad)), F.lit(0)), F.get(found, F.lit(0)), F.lit(""))


def labelled_candidates(source: Column | str) -> Column:
    """Candidates in the text after a mail or contact label, as it stands and without white space."""
    s = text_of(source)
    after = F.concat(*[F.regexp_extract_all(s, F.lit(p), F.lit(1)) for p in markup.MAIL_LABELS])
    plain = F.transform(after, lambda x: undisguise(F.when(x.contains("<") & x.contains(">"), html_to_text(x)).otherwise(x)))
    tight = F.transform(plain, lambda x: F.regexp_replace(x, rf"[{SPACE}]+", ""))
    every = F.array_distinct(F.concat(plain, tight))
    return F.coalesce(F.flatten(F.transform(every, lambda x: candidates(x, "context"))), F.array().cast(_CANDIDATES))


def reliability(email: Column, source: Column | str, kind: str | Column) -> Column:
    """Best score of the address in a source, or NULL if it doesn't occur there."""
    hits = F.filter(candidates(undisguise(source), kind), lambda c: F.lower(c["email"]) == F.lower(email))
    return F.array_max(F.transform(hits, lambda c: c["score"]))


def extract(page: Column | str, text: Column | str, context: Column | str, ocr: Column | str | None = None) -> Column:
    """A labelled, reliable address; else the best of context and text; else the best of all sources."""
    each = (("context", context), ("text", text), ("html", page))
    sources = F.array(
        *[F.struct(F.lit(k).alias("kind"), F.lit(rules.SOURCE_BONUS[k]).alias("bonus"), text_of(s).alias("text")) for k, s in each]
    )
    labelled = best(F.flatten(F.transform(sources, lambda s: labelled_candidates(s["text"]))), 70)
    trusted = lambda e: F.array_max(F.transform(sources, lambda s: reliability(e, s["text"], s["bonus"]))) >= 70
    scored = F.transform(
        sources, lambda s: F.struct((s["kind"] == "html").alias("far"), candidates(undisguise(s["text"]), s["bonus"]).alias("c"))
    )
    seen = F.array().cast(_CANDIDATES)
    if ocr is not None:
        from_image = best(candidates(undisguise(ocr), "ocr"))
        shown = let(from_image, lambda e: F.when(e != "", F.array(F.struct(F.lit(40).alias("score"), e.alias("email")))))
        seen = F.coalesce(shown, seen)
    of = lambda parts: F.flatten(F.transform(parts, lambda p: p["c"]))
    staged = lambda p: F.coalesce(
        filled(best(of(F.filter(p, lambda x: ~x["far"])), 70)), best(F.concat(of(p), seen))
    )
    return F.coalesce(let(labelled, lambda e: F.when((e != "") & F.coalesce(trusted(e), F.lit(False)), e)), let(scored, staged))


def masked(email: Column | str) -> Column:
    """Domain and a digest of the local part, for outputs that must not carry addresses."""
    e = F.lower(text_of(email))
    digest = F.left(F.sha2(F.substring_index(e, "@", 1), 256), F.lit(12))
    return F.when(e.contains("@"), F.concat(digest, F.lit("@"), F.substring_index(e, "@", -1))).otherwise(F.lit(""))
