"""Patterns of pages: tags by their attributes, labels with what follows them, addresses; all built from the values in ``rules``."""

from __future__ import annotations

from collections.abc import Iterable

from . import rules

#: Captures an attribute's value, and what an element holds up to its first end tag.
VALUE, INSIDE = r"([^\"']+)", r"([\s\S]*?)"


def opening(tag: str, **attributes: str) -> str:
    """An opening tag that has the attributes in any order; their values are patterns, and may capture."""
    wanted = "".join(rf"(?=[^>]*[\s\"']{name}\s*=\s*[\"']{value}[\"'])" for name, value in attributes.items())
    return rf"<{tag}(?=[\s/>]){wanted}[^>]*>"


def element(tag: str, inside: str = INSIDE, **attributes: str) -> str:
    return opening(tag, **attributes) + inside + rf"</{tag}\s*>"


def any_case(*parts: str) -> str:
    return "(?i)" + "".join(parts)


def script_array(variable: str) -> str:
    """A script's assignment of an array literal to the variable."""
    return any_case(rf"\bvar\s+{variable}\s*=\s*", r"(\[[\s\S]*?\])\s*;")


def spaced(word: str) -> str:
    """A word that may be set with gaps between its signs."""
    return r"\s*".join(word)


def behind(labels: Iterable[str], sign: str, most: int) -> str:
    """Captures up to ``most`` signs behind any of the labels and an optional colon."""
    return any_case(rf"(?:{'|'.join(labels)})\s*[:：]?\s*({sign}{{0,{most}}})")


EMAIL = rf"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]*)*?\.(?i:{'|'.join(rules.MAIL_ENDINGS)})(?:\.[A-Za-z]{{2,3}})?"
MAIL_LABELS = (behind(rules.MAIL_WORDS, r"[^\n]", 80), behind(rules.CONTACT_WORDS, r"[^\n]", 120))
TITLE_LABELS = tuple(behind([before + spaced(word)], r"[\s\S]", 80) for before, word in rules.TITLE_WORDS)
NEXT_LABEL = any_case(rf"(?:{'|'.join(map(spaced, rules.GUIDE_WORDS))}|{'|'.join(rules.NEXT_WORDS)}).*$")

PAGE_TITLE = any_case(element("title"))
META_CONTENT = any_case(opening("meta", content=VALUE))
META_PAGE_TITLE = any_case(opening("meta", name="pageTitle", content=VALUE))
META_DESCRIPTION = any_case(opening("meta", name="description", content=VALUE))
IMAGE = any_case(opening("img", src=VALUE))
CONTENT_BLOCK = any_case(element("div", id=rules.CONTENT_ID))

LIST_LINK = any_case(element("a", href=rules.PROFILE_PATH))
SECTION = any_case(
    element("span", r"\s*([^<]+?)\s*", id=r"t\d+"), r"[\s\S]*?", opening("div", **{"class": "nr", "id": r"n\d+"}), INSIDE, r"</div><!--ckendn\d+-->"
)
LIST, ITEM = any_case(element("ul")), any_case(element("li"))
CARD_LINK = any_case(opening("a", href=VALUE))
CARD_BLOCKS = tuple(any_case(opening("div", **{"class": c})) for c in rules.CARD_BLOCKS)
CARD_HEAD, CARD_BODY = (any_case(element("p", **{"class": c})) for c in rules.CARD_TEXTS)
ENCRYPTED_SPAN = any_case(element("span", **{rules.ENCRYPTED: rules.ENCRYPTED, "id": VALUE}))
