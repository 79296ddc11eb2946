"""Problem 5: text that looks ordinary but is made of other characters.

Each word's characters are resolved to the scripts they can be written in: a
letter with a look-alike counts for both scripts. The intersection over the
word says which scripts can spell it whole. A word whose letters come from
several scripts is a mixed confusable; a word wholly in one script that can be
spelled in the script of the words around it (or of the address it stands in)
is a whole-script confusable. Both are respelled in the script selected: the
one most of the surrounding letters need, else the one most letters are in.
What remains is normalised: compatible forms to ordinary ones, letters
composed, spaces and marks to their usual signs, invisible signs dropped.

All work is per cell; only cells with unusual signs leave the JVM and nothing
shuffles.

Defined results: NULL stays NULL and an empty text empty; plain ASCII white
space is kept; a cell wholly in one other script is left alone; punctuation of
Chinese writing is ordinary in a cell with ideographs; very long texts are
handled whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters that look alike in two scripts.
LATIN_CYRILLIC = (
    "aа bЬ cс dԁ eе gɡ hһ iі jј kк lӏ oо pр qԛ sѕ vѵ wԝ xх yу ëё ïї AА BВ CС EЕ HН IІ JЈ KК MМ NԊ OО PР SЅ TТ VѴ XХ YҮ YУ ZꙀ ËЁ ÏЇ"
)
LATIN_ARMENIAN = "oօ nո uս hհ gց qզ OՕ SՏ UՍ LԼ"
LATIN_CHEROKEE = "AᎪ BᏴ CᏟ DᎠ EᎬ GᏀ HᎻ JᎫ KᏦ LᏞ MᎷ PᏢ RᎡ SᏚ TᎢ VᏙ WᎳ YᎩ ZᏃ"
HAN_KATAKANA = "口ロ 二ニ 卜ト 力カ 工エ 夕タ 千チ 八ハ 匕ヒ 厶ム"
LATIN_GREEK = "aα iι kκ oο pρ uυ vν xχ yγ AΑ BΒ EΕ HΗ IΙ KΚ MΜ NΝ OΟ PΡ TΤ XΧ YΥ ZΖ"
# Radicals without a compatible ideograph, with the ideographs they stand for.
RADICALS = "⺎兀⺠民⺮竹⺼肉⻁虎⻂衣⻄西⻅见⻆角⻇角⻈讠⻉贝⻋车⻎辶⻓长⻔门⻘青⻙韦⻚页⻛风⻜飞⻝食⻢马⻣骨⻤鬼⻥鱼⻦鸟⻧卤⻨麦⻩黄⻪黾⻬齐⻭齿⻮齿⻰龙⻲龟"
MIDDLE_DOTS = "•∙‧⋅᛫・･•●"
DASHES = "‐‑‒–—−﹣－⁃"
ORDINARY_IN_CHINESE = "，。；：（）、！？【】《》“”‘’…—·～"

_RADICAL = dict(zip(RADICALS[::2], RADICALS[1::2]))


def _twins() -> dict[str, dict[str, str]]:
    """script -> letter -> its look-alike in that script."""
    pairs = (
        (LATIN_CYRILLIC, "LATIN", "CYRILLIC"), (LATIN_GREEK, "LATIN", "GREEK"), (LATIN_ARMENIAN, "LATIN", "ARMENIAN"),
        (LATIN_CHEROKEE, "LATIN", "CHEROKEE"), (HAN_KATAKANA, "HAN", "KATAKANA"),
    )
    out: dict[str, dict[str, str]] = {s: {} for _, *scripts in pairs for s in scripts}
    for table, first, second in pairs:
        for a, b in table.split():
            out[first].setdefault(b, a)
            out[second].setdefault(a, b)
    return out


TWINS = _twins()
#: Scripts that one word may well have together, as Japanese names do; such a word is respelled only if one script can spell all of it.
MIXED_RIGHTLY = frozenset({"HAN", "KATAKANA"})


@lru_cache(maxsize=100_000)
def script_of(c: str) -> str:
    """Script of a letter; '' for signs common to all scripts."""
    if not c.isalpha():
        return ""
    name = unicodedata.name(c, "")
    first = name.split(" ")[0]
    return "HAN" if first == "CJK" else first


def scripts_for(c: str) -> frozenset[str]:
    """Every script the letter, or its look-alike, can stand in."""
    own = script_of(c)
    return frozenset({own} | {s for s, letters in TWINS.items() if c in letters})


EUROPEAN = TWINS.keys() - MIXED_RIGHTLY


def _spell(word: str, script: str) -> str:
    return "".join(c if script_of(c) in ("", script) else TWINS[script].get(c, c) for c in word)


def resolve(text: str, address: bool = False) -> str:
    """``text`` with each confusable word respelled in its consistent script."""
    words = re.split(r"(\s+)", text)
    used = [Counter(s for c in w if (s := script_of(c)) in TWINS) for w in words]
    surely = Counter(script_of(c) for c in text if script_of(c) in TWINS and len(scripts_for(c)) == 1)
    total = sum(used, Counter())
    if len(total) == 0 or len(total) == 1 and not (address and "LATIN" not in total and total.keys() <= EUROPEAN):
        return text
    if address:
        leading = "LATIN"
    else:
        leading = max(total, key=lambda s: (surely.get(s, 0), total[s], s == "LATIN"))
    out = []
    for w, scripts in zip(words, used):
        if scripts:
            letters = [scripts_for(c) for c in w if script_of(c)]
            spellable = frozenset.intersection(*letters) & TWINS.keys() if letters else frozenset()
            if len(scripts) > 1 or leading not in scripts:
                if leading in spellable:
                    w = _spell(w, leading)
                elif spellable and len(scripts) > 1:
                    w = _spell(w, max(spellable, key=lambda s: (scripts[s], s)))
                elif len(scripts) > 1 and not scripts.keys() <= MIXED_RIGHTLY:
                    w = _spell(w, max(scripts, key=lambda s: (scripts[s], s)))
        out.append(w)
    return "".join(out)


def _usual(c: str, chinese: bool) -> str:
    if c.isascii() or chinese and c in ORDINARY_IN_CHINESE:
        return c
    category = unicodedata.category(c)
    if category == "Zs":
        return " "
    if category == "Cf" or "︀" <= c <= "️" or c in "͏ᅟᅠㅤﾠ":
        return ""
    if c in _RADICAL:
        return _RADICAL[c]
    if c in DASHES:
        return "-"
    return unicodedata.normalize("NFKC", c)


def consistent(text: str) -> str:
    """The one consistent form of a name or address."""
    if text.isascii():
        return text
    chinese = "@" not in text and "＠" not in text and any(script_of(c) == "HAN" for c in text)
    plain = unicodedata.normalize("NFC", "".join(_usual(c, chinese) for c in text))
    if any(c in MIDDLE_DOTS for c in text):  # a dot between kana is ordinary
        plain = re.sub(rf"(?<![ァ-ヺー])[{MIDDLE_DOTS}]|[{MIDDLE_DOTS}](?![ァ-ヺー])", "·", plain)
    return resolve(plain, address="@" in plain)


#: Katakana that look like ideographs.
_KATAKANA = "".join(TWINS["KATAKANA"].values())


def unusual(c: Column) -> Column:
    """Whether a cell may hold anything but its consistent form; cheap, and true for all that do."""
    return c.rlike(r"[^\x00-\x7f一-鿿·가-힣ぁ-ゖァ-ヺーÀ-ÖØ-öø-ıĴ-ľŁ-ňŊ-ž]") | c.rlike(f"[一-鿿].*[{_KATAKANA}]|[{_KATAKANA}].*[一-鿿]")


def cells(
    df: DataFrame, id_col: str, columns: tuple[str, ...], skip: Callable[[str, str], bool] | None = None
) -> DataFrame:
    """``id, field, original, consistent`` of every cell that isn't in its consistent form.

    ``skip(field, text)`` leaves out cells that another operator answers for.
    """
    may = F.lit(False)
    for c in columns:
        may = may | unusual(F.col(c))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for field in columns:
                for i, text in zip(batch[id_col], batch[field]):
                    if text and not text.isascii():
                        form = consistent(text)
                        if form != text and not (skip and skip(field, text)):
                            out.append((i, field, text, form))
            yield pd.DataFrame(out, columns=["id", "field", "original", "consistent"])

    kind = dict(df.dtypes)[id_col]
    return (
        df.select(id_col, *columns)
        .where(may)
        .mapInPandas(scan, f"id {kind}, field string, original string, consistent string")
    )
