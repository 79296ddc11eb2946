"""Problem 3: text cut off by field limits or in transfer.

Per source, histograms of the lengths in characters and in bytes are tested for
a spike at their upper end; a text of that length without terminal punctuation
was cut. Limits counted in bytes leave texts of up to two bytes less, since no
character is torn. Texts that carry the mark of a cut (dots, "more", broken
markup) are cut wherever they stop.

Cuts in transfer come at any length. For those the sentences of the whole
column are counted by how they open: where sentences that open alike nearly
always end with a stop, one that doesn't was cut, and so was a last fragment
that is only the beginning of such an opening. Openings that never end with a
stop (addresses, lists, dates of change) make whole texts, provided they end as
their like do. That is judged by shares alone, so it doesn't turn with the size
of the input: the less an opening's endings vary, the more a rare one tells. A
text at a limit is no evidence, and is whole only if others end as it does.

Only counts shuffle: lengths per source, openings, and endings of unfinished
texts. Where openings or endings are too many to be broadcast, the frequent ones
are, and the others are joined by shuffle; none is dropped for its share.

Defined results: blank cells are never cut; a NULL source is one source;
repeated texts count as often as they occur; an empty table has no cut texts;
very long texts are split into sentences in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, checkpointed, is_blank, stripped

#: Most sources whose limits are broadcast; beyond that they are joined by shuffle.
BROADCAST_LIMITS = 200_000
#: Most keys (openings, endings, fragments) broadcast whole; beyond that only those with one in SUPPORT of all uses or
#: more are, at most SUPPORT, and the others are joined by shuffle.
BROADCAST_KEYS, SUPPORT = 100_000, 20_000
#: Sentences from which an opening counts, whatever the size of the input.
LEAST_USES = 3
#: Characters that make an opening in writing without spaces.
OPENING = 4
#: Share of unfinished sentences from which an opening counts as one that needs no stop.
FREE_SHARE = 0.7
#: Least share of a good ending, as a part of the share a typical ending of its opening has, or in any case among the
#: opening's other texts.
ENDING_TYPICAL, ENDING_SHARE = 0.2, 0.01
#: Spike: least number and share of unfinished texts at the length, share of longer texts at most, factor over the
#: mean of the other lengths.
SPIKE_LEAST, SPIKE_OPEN, SPIKE_BEYOND, SPIKE_FACTOR = 3, 0.6, 0.08, 4.0

# What is put or left at a cut.
MARK = (
    r"(?:\.{3}|…|[\[【(（<《]\s{0,9}(?:更多|阅读全文|查看更多|查看全文|展开|详细|详情|more|read more|continue)\s{0,9}[\]】)）>》]|more\s{0,9}[»>]{1,9}"
    r"|&#?\w{0,8}|<[A-Za-z/][^<>]{0,60}|<|\\u[0-9A-Fa-f]{0,3}|\\x[0-9A-Fa-f]?|\\|%[0-9A-F]?)$"
)
STOPS, CLOSERS = "。.!?！？", "”\"’』」）)]】"

#: Precedes the opening of a sentence with and without a stop.
_STOPPED, _OPEN = ".", " "
#: No mark has more signs, as MARK bounds every repetition; so only these are looked at for one.
LAST = 80


def marked(text: Column) -> Column:
    last = F.right(text, F.lit(LAST))
    return last.rlike(r"[&<\\%]|(?:\.\.\.|[…\])】）>》»])$") & last.rlike("(?i)" + MARK)


def stopped_at_end(text: Column) -> Column:
    return F.right(F.rtrim(text, F.lit(CLOSERS)), F.lit(1)).isin(*STOPS)


def sentences(text: Column) -> Column:
    parts = F.split(text, r"(?<=[。！？])|(?<=[.!?])[ \t]+|[\r\n]+")
    return F.filter(F.transform(parts, lambda p: stripped(p)), lambda p: p != "")


def masked(text: Column) -> Column:
    return F.regexp_replace(text, r"[0-9]+", "0")


def opening(sentence: Column) -> Column:
    """The first two words of a sentence in Latin letters, else its first four signs; a number is one sign."""
    return masked(F.regexp_extract(sentence, rf"^(?:[A-Za-z]\S*(?:\s+\S+)?|(?:[0-9]+|[^0-9]){{1,{OPENING}}})", 0))


def ending(sentence: Column) -> Column:
    """The last word in Latin letters, else the last two signs; a number is one sign."""
    back = F.regexp_extract(F.reverse(sentence), r"^(?:(?=[A-Za-z])[^\s,，、]+|(?:[0-9]+|[^0-9]){1,2})", 0)
    return masked(F.reverse(back))


def spikes(cells: DataFrame) -> DataFrame:
    """``source, chars, bytes``: all lengths at which a source cuts. ``cells`` has source, n_chars, n_bytes, unfinished."""
    counts = cells.groupBy("source", "n_chars", "n_bytes").agg(
        F.count("*").alias("n"), F.count_if("unfinished").alias("n_open")
    )
    by_unit = (
        counts.select(
            "source",
            "n",
            "n_open",
            F.explode(
                F.array(
                    F.struct(F.lit("chars").alias("unit"), F.col("n_chars").alias("length")),
                    F.struct(F.lit("bytes").alias("unit"), F.col("n_bytes").alias("length")),
                )
            ).alias("at"),
        )
        .groupBy("source", "at.unit", "at.length")
        .agg(F.sum("n").alias("n"), F.sum("n_open").alias("n_open"))
    )
    of = Window.partitionBy("source", "unit")
    upward = of.orderBy("length")
    torn = upward.rangeBetween(-2, 0)
    near = F.when(F.col("unit") == "bytes", F.sum("n_open").over(torn)).otherwise(F.col("n_open"))
    near_all = F.when(F.col("unit") == "bytes", F.sum("n").over(torn)).otherwise(F.col("n"))
    tested = by_unit.select(
        "source",
        "unit",
        "length",
        near.alias("near"),
        near_all.alias("near_all"),
        F.sum("n").over(of).alias("total"),
        (F.sum("n").over(of) - F.sum("n").over(upward.rangeBetween(Window.unboundedPreceding, 0))).alias("beyond"),
        ((F.sum("n_open").over(of) - near) / F.count("*").over(of)).alias("usual"),
    ).where(
        (F.col("near") >= SPIKE_LEAST)
        & (F.col("near") >= F.col("near_all") * F.lit(SPIKE_OPEN))
        & (F.col("near") >= F.col("usual") * F.lit(SPIKE_FACTOR))
        & (F.col("beyond") <= F.col("total") * F.lit(SPIKE_BEYOND))
    )
    lengths = lambda unit: F.collect_list(F.when(F.col("unit") == unit, F.col("length"))).alias(unit)
    return tested.groupBy("source").agg(lengths("chars"), lengths("bytes"))


def openings(scanned: DataFrame, tails: DataFrame) -> DataFrame:
    """``opening, n_stop, n, n_open`` of every opening with enough sentences.

    ``scanned`` has ``before``, the openings of sentences known to be whole with
    a sign for their stop; ``tails`` the openings of unfinished last ones.
    """
    told = scanned.select(F.explode("before").alias("b")).select(
        F.substring("b", 2, 2**31 - 1).alias("opening"), F.startswith("b", F.lit(_STOPPED)).alias("stop")
    )
    counted = checkpointed(
        told.unionByName(tails.select("opening", F.lit(False).alias("stop")))
        .groupBy("opening")
        .agg(F.count_if("stop").alias("n_stop"), F.count("*").alias("n"))
    ).withColumn("n_open", F.col("n") - F.col("n_stop"))
    return counted.where(F.col("n") >= LEAST_USES)


def looked_up(rows: DataFrame, keyed: DataFrame, keys: list[str], n: str) -> DataFrame:
    """``rows`` left-joined with the checkpointed ``keyed``, whose column ``n`` has the uses of each key and is dropped."""
    size, total = keyed.agg(F.count("*"), F.sum(n)).first()
    if size <= BROADCAST_KEYS:
        return rows.join(F.broadcast(keyed.drop(n)), keys, "left")
    is_hot = F.col(n) * F.lit(SUPPORT) >= F.lit(total)
    hot, others = keyed.where(is_hot).drop(n), keyed.where(~is_hot).drop(n)
    found = rows.join(F.broadcast(hot), keys)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(others.hint("shuffle_hash"), keys, "left")
    return found.unionByName(rest)


def good_endings(tails: DataFrame) -> DataFrame:
    """``opening, ending, n, good`` of the endings that whole texts have; ``tails`` has opening and ending."""
    counted = checkpointed(tails.groupBy("opening", "ending").agg(F.count("*").cast("double").alias("n")))
    # pairs / (uses * (uses - 1)) is the chance that two texts of an opening end alike: the share of a typical ending.
    uses = counted.groupBy("opening").agg(F.sum("n").alias("uses"), F.sum(F.col("n") * (F.col("n") - 1)).alias("pairs"))
    typical = F.col("n") * (F.col("uses") - 1) >= F.col("pairs") * F.lit(ENDING_TYPICAL)
    frequent = F.col("n") - 1 >= (F.col("uses") - 1) * F.lit(ENDING_SHARE)
    return counted.join(uses, "opening").where(typical | frequent).select("opening", "ending", "n", F.lit(True).alias("good"))


def cut_texts(df: DataFrame, id_col: str, source: str, column: str) -> DataFrame:
    """``id, source, text, reason`` of every cut text; reason is 'mark', 'limit' or 'sentence'."""
    cells = (
        df.select(
            F.col(id_col).alias("id"), F.coalesce(F.col(source), F.lit("")).alias("source"), stripped(F.col(column)).alias("text")
        )
        .where(~is_blank("text"))
        .withColumn("marked", marked(F.col("text")))
        .withColumn("unfinished", F.col("marked") | ~stopped_at_end(F.col("text")))
    )

    def told(parts: Column) -> Column:
        whole = F.when(F.col("unfinished"), F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)
        sign = lambda p: F.when(stopped_at_end(p), _STOPPED).otherwise(_OPEN)
        tail = F.when(F.col("unfinished"), F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit("")))
        return F.struct(F.transform(whole, lambda p: F.concat(sign(p), opening(p))).alias("before"), tail.alias("tail"))

    # One scan splits every text once; what it leaves is read several times.
    scanned = checkpointed(
        cells.select(
            "source",
            F.length("text").alias("n_chars"),
            F.octet_length("text").alias("n_bytes"),
            "unfinished",
            F.get(F.transform(F.array(sentences(F.col("text"))), told), F.lit(0)).alias("told"),
            *[F.when(F.col("unfinished"), F.col(c)).alias(c) for c in ("id", "text", "marked")],
        ).select("*", "told.*").drop("told")
    )
    limits = checkpointed(spikes(scanned))
    if limits.count() <= BROADCAST_LIMITS:
        limits = F.broadcast(limits)
    at_limit = F.coalesce(
        F.array_contains("chars", F.col("n_chars"))
        | F.exists("bytes", lambda top: F.col("n_bytes").between(top - 2, top)),
        F.lit(False),
    )
    opened = checkpointed(
        scanned.where("unfinished").join(limits, "source", "left").select(
            "id",
            "source",
            "text",
            "marked",
            at_limit.alias("at_limit"),
            opening(F.col("tail")).alias("opening"),
            ending(F.col("tail")).alias("ending"),
            masked(F.col("tail")).alias("fragment"),
        )
    )
    # The last fragments of texts that are marked or at a limit say nothing about how their like end.
    known = openings(scanned, opened.where(~F.col("marked") & ~F.col("at_limit")))
    is_free = F.col("n_open") >= F.col("n") * F.lit(FREE_SHARE)
    known = known.select("opening", "n", is_free.alias("free"), (F.col("n_stop") * 2 >= F.col("n")).alias("stopped"))
    begun = checkpointed(
        known.select(F.explode(F.sequence(F.lit(1), F.greatest(F.length("opening") - 1, F.lit(1)))).alias("k"), "opening", "n")
        .where(F.col("k") < F.length("opening"))
        .groupBy(F.expr("left(opening, k)").alias("fragment"))
        .agg(F.sum("n").alias("n"))
        .withColumn("begun", F.lit(True))
    )
    opened = looked_up(opened, known, ["opening"], "n")
    endings = checkpointed(good_endings(opened.where(F.col("free") & ~F.col("marked") & ~F.col("at_limit"))))
    judged = looked_up(looked_up(opened, endings, ["opening", "ending"], "n"), begun, ["fragment"], "n")
    whole = F.coalesce(F.col("free"), F.lit(False)) & F.col("good").isNotNull()
    reason = (
        F.when(F.col("marked"), "mark")
        .when(F.col("at_limit") & ~whole, "limit")
        .when(F.col("stopped") | F.col("begun") | (F.col("free") & ~whole), "sentence")
    )
    return judged.withColumn("reason", reason).where("reason IS NOT NULL").select("id", "source", "text", "reason")
