"""Problem 10: reading level of each document.

The words of all documents are ranked by frequency. For each document the
smallest frequency-ranked vocabulary that covers a fixed share of its tokens is
found, at several shares: its *coverage ranks*. With the length and make-up of
its sentences these are calibrated in SQL: mean and variance of every feature
per language and labelled level give the likelihood of each level, weighted by
how frequent the level is; the likeliest is the document's.

Ranking needs no global sort: words of one frequency share a rank, and there
are at most the square root of twice the number of tokens of distinct
frequencies. The ``VOCABULARY`` most frequent words are shipped to the workers,
which settles every document whose coverage lies among them where it is; the
others are settled exactly by a join with all counts.

Defined results: blank documents have no level; a document without words has
all coverage ranks 0; labels that are NULL count for nothing and several raters
of a document count by their rounded mean; without labels in a language its
documents take the level statistics of all languages, and without any labels
level 3; very long texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, is_blank

#: Token shares at which coverage is measured.
SHARES = (0.5, 0.7, 0.8, 0.9, 0.95)
#: Most words shipped to the workers, and distinct words a task holds before it hands them on.
VOCABULARY, HELD = 200_000, 200_000
#: Least variance of a feature within a level, and labelled documents below which a language borrows from the others.
LEAST_VARIANCE, LEAST_LABELS = 0.02, 20

FEATURES = tuple(f"cover_{round(s * 100)}" for s in SHARES) + (
    "sentence_mean", "sentence_low", "sentence_mid", "sentence_high", "clauses", "word_length",
)

_RUNS = re.compile(r"[一-鿿]+|[A-Za-zÀ-ɏ']+")
_SCAN = re.compile(r"([一-鿿]+)|([A-Za-zÀ-ɏ']+)|([，,、：:])|(\d+)|([。！？!?；;\n]+|\.(?:\s|$))")


def words_of(run: str) -> list[str]:
    """A Latin word itself; the overlapping pairs of signs of an ideographic run."""
    if "一" <= run[0]:
        return [run[i : i + 2] for i in range(len(run) - 1)] or [run]
    return [run.lower()]


def words(text: str) -> list[str]:
    """Words in Latin letters, and the overlapping pairs of signs of ideographic runs."""
    return [w for run in _RUNS.findall(text) for w in words_of(run)]


def covering_ranks(ranked: list[tuple[int, int]], total: int) -> list[float] | None:
    """Logarithms of the coverage ranks from sorted (rank, count); None if these don't reach the last share."""
    out, at, covered = [], 0, 0
    for share in SHARES:
        need = share * total - 1e-9
        while covered < need:
            if at == len(ranked):
                return None
            covered += ranked[at][1]
            at += 1
        out.append(math.log(ranked[at - 1][0]) if at else 0.0)
    return out


def scan(text: str) -> tuple[list[str], bool, list[float]]:
    """Words, whether ideographs prevail, and sentence features, in one pass.

    The features are mean and quartiles of the sentence length (in signs; a
    Latin word counts 1.7), clause marks a sentence, and mean word length.
    """
    found: list[str] = []
    lengths: list[float] = []
    han = latin = letters = clauses = 0
    length, filled = 0.0, False
    for m in _SCAN.finditer(text):
        kind = m.lastindex
        if kind == 1:
            n = m.end() - m.start()
            han += n
            length += n
            filled = True
            found += words_of(m.group())
        elif kind == 2:
            latin += 1
            letters += m.end() - m.start()
            length += 1.7
            filled = True
            found.append(m.group().lower())
        elif kind == 3:
            clauses += 1
        elif kind == 4:
            filled = True
        elif filled:
            lengths.append(length)
            length, filled = 0.0, False
    if filled:
        lengths.append(length)
    n = len(lengths)
    lengths = sorted(lengths) or [0.0]
    top = len(lengths) - 1
    quartiles = [math.log1p(lengths[int(q * top + 0.5)]) for q in (0.25, 0.5, 0.75)]
    mean = math.log1p(sum(lengths) / len(lengths))
    return found, han > 1.7 * latin, [mean, *quartiles, clauses / max(1, n), letters / latin if latin else 0.0]


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` over all documents; each task hands on partial counts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[str] = Counter()
        for batch in batches:
            for text in batch["text"]:
                held.update(words(text))
                if len(held) > HELD:
                    yield pd.DataFrame(list(held.items()), columns=["word", "n"])
                    held.clear()
        yield pd.DataFrame(list(held.items()), columns=["word", "n"])

    return docs.select("text").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def ranks_of_frequencies(counts: DataFrame) -> dict[int, int]:
    """Frequency -> rank: one more than the number of words that are more frequent."""
    out, rank = {}, 1
    for n, k in sorted(((r["n"], r["count"]) for r in counts.groupBy("n").count().collect()), reverse=True):
        out[n] = rank
        rank += k
    return out


_SCHEMA = "id long, ideographic boolean, " + ", ".join(f"{f} double" for f in FEATURES)


def features(docs: DataFrame, vocabulary: int = VOCABULARY) -> DataFrame:
    """One row of features per document of ``docs`` (id, text), none of them blank."""
    counts = checkpointed(word_counts(docs))
    rank = ranks_of_frequencies(counts)
    # Cut between two frequencies, so that at most `vocabulary` words are shipped.
    ordered = sorted(rank.items(), key=lambda x: x[1])
    total_words = counts.count()
    through = [r - 1 for _, r in ordered[1:]] + [total_words]  # words at least as frequent
    least = min((n for (n, _), words_in in zip(ordered, through) if words_in <= vocabulary), default=None)
    shipped = (
        {r["word"]: rank[r["n"]] for r in counts.where(F.col("n") >= least).collect()} if least is not None else {}
    )
    complete = len(shipped) == total_words
    table = docs.sparkSession.sparkContext.broadcast(shipped)

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = table.value
        for batch in batches:
            out = []
            for i, text in zip(batch["id"], batch["text"]):
                found, ideographic, sentence = scan(text)
                tf = Counter(found)
                covered = covering_ranks(sorted((known[w], n) for w, n in tf.items() if w in known), len(found))
                out.append((i, ideographic, *(covered or [None] * len(SHARES)), *sentence))
            yield pd.DataFrame(out, columns=["id", "ideographic", *FEATURES])

    settled = docs.select("id", "text").mapInPandas(settle, _SCHEMA)
    if complete:
        return settled
    settled = checkpointed(settled)
    open_docs = settled.where(F.col(FEATURES[0]).isNull())
    exact = exact_coverage(docs.join(open_docs.select("id"), "id", "left_semi"), counts, rank, table)
    rest = open_docs.drop(*FEATURES[: len(SHARES)]).join(exact, "id").select("id", "ideographic", *FEATURES)
    return settled.where(F.col(FEATURES[0]).isNotNull()).unionByName(rest)


def exact_coverage(docs: DataFrame, counts: DataFrame, rank: dict[int, int], shipped: Broadcast) -> DataFrame:
    """``id`` and coverage ranks from each document's words: shipped ones by the vocabulary, the rest by a join with all counts.

    A word that is joined is rarer than every shipped one, so it makes up less
    than one in ``VOCABULARY`` of all words and is no hot key.
    """
    spark = docs.sparkSession
    names = FEATURES[: len(SHARES)]

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shipped.value
        for batch in batches:
            for i, text in zip(batch["id"], batch["text"]):
                by_rank: Counter[int] = Counter()
                rest = []
                for w, n in Counter(words(text)).items():
                    if w in known:
                        by_rank[known[w]] += n
                    else:
                        rest.append((i, w, None, n))
                yield pd.DataFrame([*((i, None, r, n) for r, n in by_rank.items()), *rest], columns=["id", "word", "rank", "tf"]).astype({"rank": "Int64"})

    def cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, pairs in zip(batch["id"], batch["pairs"]):
                ranked = sorted((int(p["rank"]), int(p["tf"])) for p in pairs)
                out.append((i, *(covering_ranks(ranked, sum(n for _, n in ranked)) or [0.0] * len(SHARES))))
            yield pd.DataFrame(out, columns=["id", *names])

    ranks = spark.createDataFrame(list(rank.items()), "n long, rank long")
    each = checkpointed(docs.select("id", "text").mapInPandas(split, "id long, word string, rank long, tf long"))
    joined = each.where("word IS NOT NULL").drop("rank").join(counts, "word").join(F.broadcast(ranks), "n").select("id", "rank", "tf")
    ranked = each.where("word IS NULL").select("id", "rank", "tf").unionByName(joined)
    grouped = ranked.groupBy("id").agg(F.collect_list(F.struct("rank", "tf")).alias("pairs"))
    return grouped.mapInPandas(cover, "id long, " + ", ".join(f"{n} double" for n in names))


def calibrated(feats: DataFrame, labels: DataFrame) -> DataFrame:
    """``ideographic, levels``: per language the statistics of every labelled level (at most five each)."""
    level = (
        labels.where(F.col("level").isNotNull())
        .groupBy("id")
        .agg(F.round(F.avg("level")).cast("int").alias("level"))
    )
    labelled = feats.join(level, "id")
    stats = [F.count("*").alias("n")]
    for f in FEATURES:
        stats += [F.avg(f).alias(f"m_{f}"), F.greatest(F.var_pop(f), F.lit(LEAST_VARIANCE)).alias(f"v_{f}")]
    own = labelled.groupBy("ideographic", "level").agg(*stats)
    any_language = labelled.groupBy("level").agg(*stats)
    enough = labelled.groupBy("ideographic").agg(F.count("*").alias("labels")).where(F.col("labels") >= LEAST_LABELS)
    own = own.join(F.broadcast(enough), "ideographic").drop("labels")
    either = any_language.withColumn("ideographic", F.explode(F.array(F.lit(True), F.lit(False))))
    borrowed = either.join(F.broadcast(enough), "ideographic", "left_anti")
    packed = F.struct("level", "n", *[c for f in FEATURES for c in (f"m_{f}", f"v_{f}")])
    return own.unionByName(borrowed.select(*own.columns)).groupBy("ideographic").agg(
        F.array_sort(F.collect_list(packed)).alias("levels")
    )


def reading_levels(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, level_col: str = "level") -> DataFrame:
    """``id, level`` and the features of every document with a non-blank text."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(~is_blank("text"))
    feats = checkpointed(features(texts))
    stats = calibrated(feats, labels.select(F.col(id_col).alias("id"), F.col(level_col).alias("level")))

    def likelihood(s):  # noqa: ANN001, ANN202 - a struct column
        out = F.log(s["n"].cast("double"))
        for f in FEATURES:
            d = F.col(f) - s[f"m_{f}"]
            out = out - 0.5 * (F.log(s[f"v_{f}"]) + d * d / s[f"v_{f}"])
        return F.struct(out.alias("likelihood"), s["level"].alias("level"))

    scored = feats.join(F.broadcast(stats), "ideographic", "left")
    best = F.array_max(F.transform("levels", likelihood))["level"]
    return scored.select("id", F.coalesce(best, F.lit(3)).cast("long").alias("level"), "ideographic", *FEATURES)
