"""Problem 7: text decoded with the wrong encoding, found and restored.

For each pair of encodings (the wrong one a text was read in, the one its bytes
were written in) the characters are mapped back to bytes, and an automaton over
the byte structure of the written encoding finds the maximal well-formed
multibyte spans. Only those spans are decoded; the rest of the text stays as it
is. A span counts when what it decodes to is likelier than what stands there,
by a character model counted over the distinct texts of the whole column, each
weighted by its share of signs that aren't odd, so that neither repeated nor many garbled
texts make themselves likely. Texts garbled twice are restored in turns. A replacement character is garbled text that can't be
restored.

The model has at most one count per code point, however large the corpus, and
is shipped to the workers; each column's texts shuffle once to be told apart.

Defined results: NULL and empty texts are never garbled; foreign letters used
rightly form no well-formed span, or a less likely one; ties between encodings
go to the pair named first; very long texts are scanned once per pair.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (read as, written in), most frequent first.
PAIRS = (
    ("cp1252", "utf-8"), ("cp1252", "gb18030"), ("gb18030", "utf-8"), ("big5", "gb18030"), ("mac_roman", "utf-8"), ("cp1251", "utf-8"),
    ("cp437", "utf-8"), ("cp932", "utf-8"), ("cp850", "utf-8"), ("koi8_r", "utf-8"), ("cp866", "utf-8"), ("euc_kr", "utf-8"),
    ("big5", "utf-8"), ("cp1250", "utf-8"), ("iso8859_15", "utf-8"), ("gb18030", "big5"), ("cp1252", "big5"), ("cp1252", "cp932"),
)
#: Least gain in mean log-likelihood at which a span counts, and turns for texts garbled more than once.
GAIN, TURNS = 1.5, 3
#: Least gain in summed log-likelihood of a stretch where both encodings take two bytes a character.
STRETCH = 6.0
#: A distinct character is common if it makes up this share of a column of short values (less where values are
#: longer); pairs of equal width are tried only on texts that hold other characters.
COMMON = 3e-4

_UTF8 = re.compile(
    rb"(?:[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]"
    rb"|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})+"
)
_GB = re.compile(rb"(?:[\x81-\x84][0-9][\x81-\xfe][0-9]|[\x81-\xfe][\x80-\xfe]|[\x81-\xfe][\x40-\x7e])+")
_BIG5 = re.compile(rb"(?:[\x81-\xfe][\x40-\x7e\xa1-\xfe])+")
_SJIS = re.compile(rb"(?:[\x81-\x9f\xe0-\xfc][\x40-\x7e\x80-\xfc])+")
_FOUR_BYTE = re.compile(r"[\x81-\x84ƒ‚„][0-9].[0-9]")
#: What UTF-8 leaves in a two-byte encoding: signs of three bytes in a row, punctuation, letters in or beside a Latin word.
_THREE_BYTES = re.compile(
    rb"(?:[\xe2-\xef][\x80-\xbf][\x80-\xbf]){2}|\xe2\x80[\x90-\xbf]|(?<=[A-Za-z])[\xc3-\xc5][\x80-\xbf]"
    rb"|[\xc3-\xc5][\x80-\xbf](?=[A-Za-z])|(?:[\xd0\xd1][\x80-\xbf]){3}|(?:\xef\xbf\xbd){2}"
)
_LATIN = re.compile("[A-Za-z\u00c0-\u024f]+")
_CYRILLIC = {"cp1251", "koi8_r", "cp866"}
#: Characters that hardly stand in a well-read Chinese or English text.
_ODD = re.compile("[\x7f-\xb6\xb8-\u2012\u2015-\u2017\u201a\u201b\u201e-\u2021\u2023-\u2025\u2027-\u2e7f\uff61-\uff9f]")
#: Byte structure of the encodings a text may have been written in.
AUTOMATA = {"utf-8": _UTF8, "gb18030": _GB, "big5": _BIG5, "cp932": _SJIS}


@lru_cache(maxsize=None)
def byte_of(codec: str) -> dict[str, bytes]:
    """Characters of a single-byte code page -> byte; control codes fill its gaps, as browsers do."""
    out = {}
    for b in range(256):
        try:
            out.setdefault(bytes([b]).decode(codec), bytes([b]))
        except UnicodeDecodeError:
            out.setdefault(chr(b), bytes([b]))
    if codec == "cp1252":
        for b in range(0x80, 0xA0):
            out.setdefault(chr(b), bytes([b]))
    return out


_SINGLE = {"cp1252", "mac_roman", "cp1251", "cp437", "cp850", "koi8_r", "cp866", "cp1250", "iso8859_15"}


@lru_cache(maxsize=200_000)
def _legacy(c: str, codec: str) -> bytes | None:
    if codec in _SINGLE:
        return byte_of(codec).get(c)
    try:
        return c.encode(codec)
    except UnicodeEncodeError:
        return b"\x80" if codec == "gb18030" and c == "€" else None


class CharModel:
    """Log-likelihoods of characters from their counts in one column of the given mean length; ``unit`` is what one text without odd signs counts."""

    def __init__(self, counts: dict[str, int], length: float = 10.0, unit: float = 1.0) -> None:
        total = sum(counts.values()) or 1
        self.log = {c: math.log(n / total) for c, n in counts.items()}
        self.rare = math.log(0.2 * unit / total)
        least = COMMON * total / max(1.0, length / 10)
        self.common = frozenset(c for c, n in counts.items() if n >= least and not 0x7F <= ord(c) < 0xA0)

    def mean(self, s: str) -> float:
        return sum(self.log.get(c, self.rare) for c in s) / max(1, len(s))

    def plain(self, s: str) -> bool:
        return self.common.issuperset(s)


def _plausible(decoded: str, standing: str, read: str, written: str, model: CharModel, glued: bool) -> bool:
    if "\ufffd" in decoded:
        return True  # the bytes of a replacement character, garbled once more
    single = read in _SINGLE
    if any("\x7f" < c < "\xa0" for c in decoded):
        return read == "cp1252" and written == "utf-8" and len(standing) >= 4  # garbled more than once
    if single and written == "utf-8":
        if any("\u0530" <= c < "\u0900" and c not in model.log for c in decoded):
            return False
        if read == "cp1252" or all("\u2010" <= c <= "\u203a" for c in decoded):
            return True
        if len(decoded) == 1 and len(standing) == 2 and read in _CYRILLIC:
            return _LATIN.fullmatch(decoded) is not None and glued
        return model.mean(decoded) > model.mean(standing) + (0.0 if len(standing) > 2 else 0.5)
    if not single and glued and len(standing) == 1 and _LATIN.fullmatch(decoded):
        return True
    wide = [c for c in decoded if not c.isascii()]
    if not wide:
        return False
    if single and written == "gb18030" and len(wide) == len(decoded) and (
        all(c == "§" for c in standing[::2]) and len(decoded) >= 2 and all("\u0400" <= c < "\u0500" for c in wide)
        or all(c == "¨" for c in standing[::2]) and glued and _LATIN.fullmatch(decoded)
    ):
        return True  # the rows of Cyrillic and of accented letters
    if single and _FOUR_BYTE.search(standing) and all(ord(c) < 0x3000 or "\u3040" <= c < "\u3100" or "\uac00" <= c < "\ud7a4" for c in wide):
        return True
    if single and not all(0x3000 <= ord(c) < 0xA000 or 0xFF00 <= ord(c) < 0xFFEF or ord(c) == 0xB7 for c in wide):
        return False
    if single and sum(not c.isascii() for c in standing) < 2:
        return False
    symbols = single and len(standing) >= 4 and not any(c.isascii() for c in standing)
    # Twelve bytes of UTF-8 hardly come about by chance in two-byte text.
    formed = not single and written == "utf-8" and len(decoded) >= 4 and len(wide) == len(decoded) and min(wide) >= "\u0800"
    return model.mean(decoded) > model.mean(standing) + (0.0 if symbols or formed else GAIN)


def _glued(s: str, start: int, end: int) -> bool:
    """Whether a Latin word goes on directly before or after the span, and no other letters do."""
    before, after = s[start - 1 : start], s[end : end + 1]
    near = [c for c in (before, after) if c and c.isalpha()]
    return bool(near) and all(c.isascii() for c in near)


def _in_word(s: str, i: int) -> bool:
    """Whether the letter stands beside another letter of an alphabet that isn't ASCII."""

    def foreign(c: str) -> bool:
        return c.isalpha() and not c.isascii() and c < "\u2e80"

    return foreign(s[i]) and any(foreign(c) for c in (s[i - 1 : i], s[i + 1 : i + 2]) if c)


def _gaining(chars: str, decoded: str, model: CharModel) -> Iterator[tuple[int, int]]:
    """Stretches of two texts of equal length where the second is likelier by ``STRETCH`` in all."""

    def least(x: int, y: int) -> float:
        return STRETCH if any(c >= "\u2e80" for c in chars[x:y]) else 0.6 * STRETCH

    start, total, top, end = 0, 0.0, 0.0, 0
    for i, (a, b) in enumerate(zip(chars, decoded)):
        total += min(6.0, max(-4.0, model.log.get(b, model.rare) - model.log.get(a, model.rare)))
        if total > top:
            top, end = total, i + 1
        if total <= 0 or top - total > 10:
            if top >= least(start, end):
                yield start, end
            start, total, top = i + 1, 0.0, 0.0
    if top >= least(start, end):
        yield start, end


def spans(s: str, read: str, written: str, model: CharModel) -> list[tuple[int, int, str]]:
    """``(start, end, decoded)`` of the spans of ``s`` that were read in the wrong encoding."""
    out: list[tuple[int, int, str]] = []
    run, at = bytearray(), []

    def close() -> None:
        for m in AUTOMATA[written].finditer(run):
            a, b = m.span()
            while a < b and a and at[a] == at[a - 1]:  # begins inside a character
                a += 1
            while b > a and b < len(run) and at[b] == at[b - 1]:  # ends inside a character
                b -= 1
            if b <= a:
                continue
            start, end = at[a], at[b - 1] + 1
            decoded = bytes(run[a:b]).decode(written, "ignore")
            if read not in _SINGLE and written != "utf-8" and len(decoded) == end - start:
                for x, y in _gaining(s[start:end], decoded, model):
                    if y - x == 1 and _in_word(s, start + x):
                        continue  # its neighbours would have been misread as well
                    out.append((start + x, start + y, decoded[x:y]))
                if end - start <= 2 and _LATIN.fullmatch(decoded[0]) and _glued(s, start, start + 1):
                    out.append((start, start + 1, decoded[0]))
            elif decoded and _plausible(decoded, s[start:end], read, written, model, _glued(s, start, end)):
                out.append((start, end, decoded))

    for i, c in enumerate(s):
        b = _legacy(c, read)
        if b is None or b.isascii() and written != "utf-8" and read not in _SINGLE:
            close()
            run.clear()
            at.clear()
        else:
            run += b
            at += [i] * len(b)
    close()
    return out


def _worth_trying(s: str, model: CharModel) -> Iterator[tuple[str, str]]:
    """The pairs whose wrong reading could have left the characters of ``s``."""
    odd, rare = _ODD.search(s), not model.plain(s)
    for read, written in PAIRS:
        if read in _SINGLE:
            if odd:
                yield read, written
        elif written == "utf-8":
            if (rare or read == "gb18030") and _THREE_BYTES.search(s.encode(read, "ignore")):
                yield read, written
        elif rare:
            yield read, written


def repair(s: str, model: CharModel) -> tuple[bool, str]:
    """Whether ``s`` holds garbled text, and ``s`` with the garbled spans restored as far as they can be."""
    if not s or s.isascii():
        return False, s
    found, text = False, s
    for _ in range(TURNS):
        best: tuple[float, str] | None = None
        for read, written in _worth_trying(text, model):
            hits = spans(text, read, written, model)
            if not hits:
                continue
            done, last = [], 0
            for start, end, decoded in hits:
                done += [text[last:start], decoded]
                last = end
            whole = "".join([*done, text[last:]])
            covered = sum(end - start for start, end, _ in hits)
            score = model.mean(whole) - model.mean(text) + covered * 0.02
            if best is None or score > best[0] + 1e-9:
                best = (score, whole)
        if best is None or best[1] == text:
            break
        found, text = True, best[1]
        if text.isascii():
            break
    return found or "\ufffd" in s, text


@lru_cache(maxsize=1)
def _odd() -> dict[int, None]:
    """What misread text is full of and other text hardly holds, as a table that deletes it: ideographs outside the national
    standard's two levels, half-width kana, private signs, code-page symbols and line-drawing signs."""
    standard = bytes(b for row in range(0xB0, 0xF8) for cell in range(0xA1, 0xFF) for b in (row, cell)).decode("gb2312", "ignore")
    ideographs = set(range(0x3400, 0xA000)) - set(map(ord, standard))
    return dict.fromkeys([*sorted(ideographs), *range(0x80, 0xB7), *range(0xB8, 0xC0), *range(0x2500, 0x25A0), *range(0xE000, 0xF900), *range(0xFF61, 0xFFA0)])


#: Parts in which a text's share of signs that aren't odd is told, and the power of that share which weighs it.
PARTS, POWER = 10, 4
_HANGUL, _IDEOGRAPH = re.compile("[\uac00-\ud7a3]+"), re.compile("[\u4e00-\u9fff]")


def weight_class(text: str) -> int:
    """0 for a text of odd signs only to PARTS for one without any; Korean letters among ideographs are odd too."""
    rest = text.translate(_odd())
    if _HANGUL.search(rest) and _IDEOGRAPH.search(text):
        rest = _HANGUL.sub("", rest)
    return round(PARTS * len(rest) / max(1, len(text)))


def model_of(counts: dict[str, int]) -> CharModel:
    """The model of ``char_counts``'s counts, where the empty sign counts the texts."""
    signs = {c: n for c, n in counts.items() if c}
    return CharModel(signs, sum(signs.values()) / max(1, counts.get("", 1)), PARTS**POWER)


def char_counts(df: DataFrame, *columns: str) -> dict[str, dict[str, int]]:
    """Counts of every character per column, each distinct text counted once by its weight; at most one per code point reaches the driver."""

    def count(field: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            classes: list[Counter[str]] = [Counter() for _ in range(PARTS + 1)]
            for batch in batches:
                texts: list[list[str]] = [[] for _ in classes]
                for text in batch["text"]:
                    texts[weight_class(text)].append(text)
                for held, some in zip(classes, texts):
                    held.update("".join(some))
                    held[""] += len(some)
            totals: Counter[str] = Counter()
            for i, held in enumerate(classes):
                for c, n in held.items():
                    totals[c] += n * max(1, i**POWER)
            rows = [(field, c, n) for c, n in totals.items() if c != "\x00"]
            yield pd.DataFrame(rows, columns=["field", "sign", "n"])

        return counted

    out: dict[str, dict[str, int]] = {c: {} for c in columns}
    counts = [
        df.select(F.col(c).alias("text")).where("text IS NOT NULL").distinct().mapInPandas(count(c), "field string, sign string, n long")
        for c in columns
    ]
    summed = reduce(DataFrame.unionByName, counts).groupBy("field", "sign").agg(F.sum("n").alias("n"))
    for r in summed.collect():
        out[r["field"]][r["sign"]] = r["n"]
    return out


def restored(df: DataFrame, id_col: str, columns: tuple[str, ...], counts: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """``id, field, original, restored`` of every garbled cell."""
    counts = char_counts(df, *columns) if counts is None else counts

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = {c: model_of(counts[c]) for c in columns}
        for batch in batches:
            out = []
            for c in columns:
                for i, s in zip(batch[id_col], batch[c]):
                    if s:
                        bad, text = repair(s, models[c])
                        if bad:
                            out.append((i, c, s, text))
            yield pd.DataFrame(out, columns=["id", "field", "original", "restored"])

    kind = dict(df.dtypes)[id_col]
    return df.select(id_col, *columns).mapInPandas(scan, f"id {kind}, field string, original string, restored string")
