"""Problem 4: freely typed values mapped to the entries of a reference list.

Every spelling of every reference entry goes into a symmetric-delete
dictionary: each spelling is filed under all strings that arise from its first
``PREFIX`` signs by at most d deletions; within d edits two strings' beginnings
always have such a string in common. A typed value meets its candidates by
looking up its own deletions; they are ranked by weighted Damerau-Levenshtein distance, then by
how often the entry is spelled out in the data. Before that, a spelling that
the value contains is taken (the longest), unless a longer spelling lies one
edit away from the whole; after that, an abbreviation is read as a
subsequence of one entry only. The name of the scope itself (the part after
its last slash) is dropped from the front. What remains is a miss, reported with id 0.

The dictionary is built once and broadcast; ``REFERENCE_BLOCK`` bounds how
many entries it has, and a longer list is handled in blocks, each of which
hands on the best candidate so far. Contained spellings are found by their
first two signs at each place of the value. Rows never shuffle: each worker
maps its rows and remembers the values it has met.

Defined results: blank values give no row; a value spelled exactly like a
reference entry gives none either; an empty reference list reports every value
as a miss; ties go to the more frequent entry, then to the lower id.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Signs from which deletions are made.
PREFIX = 12
#: Entries of a reference list in one broadcast dictionary (some 10 kB each).
REFERENCE_BLOCK = 5_000
#: Values that a worker remembers before it starts afresh.
REMEMBERED = 200_000

# Abbreviated words in English names.
WORDS = {
    "prof": "professor", "assoc": "associate", "asst": "assistant", "asso": "associate", "lect": "lecturer", "res": "research",
    "sr": "senior", "eng": "engineering", "engr": "engineer", "sch": "school", "coll": "college", "dept": "department", "sci": "science",
    "tech": "technology", "doctor": "physician", "dr": "physician", "mgmt": "management", "&": "and",
}

# Customary short or older forms of academic ranks.
RANK_FORMS = {
    "教授": ("正教授", "全职教授", "full professor"),
    "副教授": ("付教授",),
    "研究员": ("正研究员",),
    "副研究员": ("副研", "付研究员"),
    "助理研究员": ("助研",),
    "正高级工程师": ("正高工", "教授级高工", "教授级高级工程师", "研究员级高级工程师"),
    "高级工程师": ("高工",),
    "助理工程师": ("助工",),
    "主任医师": ("主任医生",),
    "副主任医师": ("副主任医生", "付主任医师"),
}

HAN = r"㐀-鿿"
_BETWEEN_HAN = re.compile(rf"(?<=[{HAN}])\s+(?=[{HAN}])")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_PIECES = re.compile(r"[,，、;；/|（）()\[\]【】<>《》:：。\n]+")


def clean(value: str) -> str:
    """Compatible characters, lower case, single spaces, none between ideographs, no marks at the ends."""
    v = unicodedata.normalize("NFKC", value).lower()
    v = "".join(c for c in v if unicodedata.category(c) != "Cf")
    v = _BETWEEN_HAN.sub("", re.sub(r"\s+", " ", v))
    if re.search(r"[a-z]", v):
        words = (WORDS.get(w.strip(".,"), w.strip(".,")) for w in v.replace("&", " & ").split())
        v = " ".join(w for w in words if w not in ("", "the", "phd"))
    return _EDGE.sub("", v)


def deletions(s: str, most: int) -> set[str]:
    """Every string left after at most ``most`` deletions."""
    out = {s}
    for d in range(1, min(most, len(s) - 1) + 1):
        for gone in combinations(range(len(s)), d):
            out.add("".join(c for i, c in enumerate(s) if i not in gone))
    return out


def allowed(length: int) -> int:
    """Edits allowed for a spelling of this length."""
    return 1 if length < 6 else 2


def distance(a: str, b: str, most: float) -> float:
    """Weighted Damerau-Levenshtein distance, or infinity beyond ``most``.

    A transposition or a change within one script costs 1, a change from one
    script to another 1.5, a deletion or insertion 1; an edit of the first
    sign, which is seldom mistyped, costs 0.25 more.
    """
    if abs(len(a) - len(b)) > most:
        return float("inf")
    before: list[float] = []
    row = [j * 1.0 for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        older, before = before, row
        row = [i * 1.0]
        first = 0.25 if i == 1 else 0.0
        for j, y in enumerate(b, 1):
            change = 0.0 if x == y else (1.0 if x.isascii() == y.isascii() else 1.5) + first
            best = min(before[j] + 1 + first, row[j - 1] + 1, before[j - 1] + change)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, older[j - 2] + 1)
            row.append(best)
        if min(row) > most:
            return float("inf")
    return row[-1]


@dataclass
class Entry:
    """A reference entry: its id, the scope it is valid in, its spellings, its number of exact uses."""

    ref_id: int
    scope: str
    spellings: tuple[str, ...]
    core: str = ""
    uses: int = 0


def _lists() -> defaultdict:
    return defaultdict(list)


@dataclass
class Dictionary:
    """Symmetric-delete dictionary over the spellings of one block of entries."""

    entries: list[Entry]
    exact: dict[tuple[str, str], list[Entry]] = field(default_factory=_lists)
    filed: dict[tuple[str, str], list[tuple[str, Entry]]] = field(default_factory=_lists)
    #: Spellings by their scope and first two signs.
    begun: dict[tuple[str, str], list[tuple[str, Entry]]] = field(default_factory=_lists)
    cores: dict[str, list[Entry]] = field(default_factory=_lists)
    #: Signs of the longest spelling with its allowed edits.
    longest: int = 0

    def __post_init__(self) -> None:
        for e in self.entries:
            if e.core:
                self.cores[e.scope].append(e)
            for s in dict.fromkeys(map(clean, e.spellings)):
                if not s:
                    continue
                self.exact[e.scope, s].append(e)
                if len(s) >= 2:
                    self.begun[e.scope, s[:2]].append((s, e))
                self.longest = max(self.longest, len(s) + allowed(len(s)))
                for d in deletions(s[:PREFIX], allowed(len(s))):
                    self.filed[e.scope, d].append((s, e))

    def close(self, scope: str, v: str) -> tuple[float, int, int, int] | None:
        """Best spelling within the allowed edits: (distance, -uses, id, length)."""
        found: dict[tuple[str, int], tuple[float, int, int, int]] = {}
        if len(v) > self.longest:
            return None
        for d in deletions(v[:PREFIX], 2 if len(v) >= 5 else 1):
            for s, e in self.filed.get((scope, d), ()):
                if (s, e.ref_id) in found or len(s) < 2:
                    continue
                most = allowed(len(s)) + 0.25
                w = distance(v, s, most)
                if w <= most and w < len(s) - 0.5:
                    found[s, e.ref_id] = (w, -e.uses, e.ref_id, len(s))
        return min(found.values(), default=None)

    def contained(self, scope: str, v: str) -> tuple[int, int, int] | None:
        """Longest spelling that the value contains: (-length, -uses, id)."""
        found = []
        for i in range(len(v) - 1):
            for s, e in self.begun.get((scope, v[i : i + 2]), ()):
                beside = v[max(0, i - 1) : i] + v[i + len(s) : i + len(s) + 1]
                if v.startswith(s, i) and not (s.isascii() and re.search("[a-z]", beside)):
                    found.append((-len(s), -e.uses, e.ref_id))
        return min(found, default=None)

    def shortened(self, scope: str, v: str) -> int | None:
        """The one entry whose core holds the value's signs in order, beginning alike."""
        for ending in ("学院", "院"):
            part = v.removesuffix(ending)
            if part == v or not part or not re.fullmatch(rf"[{HAN}]{{1,6}}", part):
                continue
            hits = [e for e in self.cores.get(scope, ()) if e.core[0] == part[0] and _in_order(part, e.core)]
            if len(hits) == 1:
                return hits[0].ref_id
        return None

    def best(self, scope: str, value: str) -> tuple[int, float, int, int]:
        """(tier, distance, -uses, id) of the best entry; tier 9 and id 0 for a miss."""
        v = clean(value)
        head = clean(scope.rpartition("/")[2])
        v = _EDGE.sub("", v.removeprefix(head)) if head else v
        if not v:
            return (9, 0.0, 0, 0)
        if hits := self.exact.get((scope, v)):
            e = min(hits, key=lambda e: (-e.uses, e.ref_id))
            return (0, 0.0, -e.uses, e.ref_id)
        part, near = self.contained(scope, v), self.close(scope, v)
        if near and (not part or near[3] > -part[0]) and (not part or near[0] <= 1.25):
            return (1, near[0], near[1], near[2])
        if part:
            return (2, float(part[0]), part[1], part[2])
        nearest = min((c for p in _PIECES.split(v) if (c := self.close(scope, clean(p)))), default=None)
        if nearest:
            return (3, nearest[0], nearest[1], nearest[2])
        if (short := self.shortened(scope, v)) is not None:
            return (4, 0.0, 0, short)
        return (9, 0.0, 0, 0)


def _in_order(part: str, whole: str) -> bool:
    rest = iter(whole)
    return all(c in rest for c in part)


def map_values(rows: DataFrame, columns: list[str], entries: Iterable[Entry], block: int = REFERENCE_BLOCK) -> DataFrame:
    """``columns`` + ``ref_id, tier`` for rows with ``scope`` and ``value``; id 0 and tier 9 mark a miss.

    Tiers: 0 spelled alike after cleaning, 1 within the allowed edits, 2
    contained, 3 a part within the allowed edits, 4 an abbreviation.
    ``entries`` may be of any length; at most ``block`` of them are in a
    worker's memory at once.
    """
    every = list(entries)
    blocks = [every[i : i + block] for i in range(0, len(every), block)] or [[]]
    state = {"_map_tier": (9, "int"), "_map_far": (0.0, "double"), "_map_uses": (0, "long"), "_map_id": (0, "long")}
    found = rows.select(
        *columns, F.col("scope").alias("_map_scope"), F.col("value").alias("_map_value"), *[F.lit(v).cast(kind).alias(n) for n, (v, kind) in state.items()]
    )
    for entries_of_block in blocks:
        shipped = rows.sparkSession.sparkContext.broadcast(Dictionary(entries_of_block))

        def apply(batches: Iterator[pd.DataFrame], shipped: Broadcast = shipped) -> Iterator[pd.DataFrame]:
            dictionary = shipped.value
            known: dict[tuple[str, str], tuple] = {}
            for frame in batches:
                out = []
                for *k, tier, far, uses, ref_id in zip(*[frame[n] for n in ("_map_scope", "_map_value", *state)]):
                    k = tuple(k)
                    if k not in known:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[k] = dictionary.best(*k)
                    out.append(min((tier, far, uses, ref_id), known[k]))
                yield frame.assign(**{n: [o[i] for o in out] for i, n in enumerate(state)})

        found = found.mapInPandas(apply, found.schema)
    return found.select(*columns, F.col("_map_id").alias("ref_id"), F.col("_map_tier").alias("tier"))


def rank_entries(titles: list[tuple[int, str, str]], uses: dict[str, int]) -> list[Entry]:
    """Entries of a list of ranks (id, Chinese, English), valid in one scope."""
    return [
        Entry(i, "", (zh, en or "", *RANK_FORMS.get(zh, ())), "", uses.get(zh, 0)) for i, zh, en in titles if zh
    ]


def college_entries(colleges: list[tuple[int, str, str, str]], uses: dict[tuple[str, str], int]) -> list[Entry]:
    """Entries of a list of colleges (id, school, Chinese, English), valid within their school."""
    out = []
    for i, school, zh, en in colleges:
        if not school or not zh:
            continue
        core = zh.removesuffix("学院").removesuffix("研究院")
        bare_en = re.sub(r"(?i)^(school|college|faculty|department|institute) of ", "", en or "")
        out.append(Entry(i, school, (zh, core, core + "院", core.replace("与", ""), en or "", bare_en), core, uses.get((school, zh), 0)))
    return out
