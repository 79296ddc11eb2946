"""Queries of this subpackage; ``queries()`` and ``oracle_sql()`` are merged by the driver entry."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import duplicates, garbled, levels, lookalike, mapping, packing, residue, tokens, truncation
from .common import SPACE, is_blank, table

P1_FIELDS = ("name", "profile_url", "email")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "template_rows", "row_id", *P1_FIELDS)
    return duplicates.pairs(rows, "row_id", P1_FIELDS).select(
        F.col("id_a").alias("row_id_a"), F.col("id_b").alias("row_id_b")
    )


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "template_rows", "row_id", *P1_FIELDS)
    return duplicates.collapse(rows, "row_id", P1_FIELDS).select("representative", "copies")


def _p3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut intros without those that are residue (6) or garbled (7)."""
    rows = table(spark, sf_dir, "template_rows", "row_id", "source", "intro")
    cut = truncation.cut_texts(rows, "row_id", "source", "intro")
    left_out = residue.residue(rows, "row_id", "source", ("intro",), ()).select("id")
    counts = garbled.char_counts(rows, "intro")["intro"]

    def readable(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = garbled.model_of(counts)
        for batch in batches:
            yield batch[[not garbled.repair(t, model)[0] for t in batch["text"]]]

    kept = cut.join(left_out, "id", "left_anti")
    return kept.mapInPandas(readable, kept.schema)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p3(spark, sf_dir).select(F.col("id").alias("row_id"))


def p3_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source its intros, its cut intros and their share."""
    intros = (
        table(spark, sf_dir, "template_rows", "source", "intro")
        .where(~is_blank("intro"))
        .groupBy(F.coalesce("source", F.lit("")).alias("source"))
        .agg(F.count("*").alias("n_intros"))
    )
    cut = _p3(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n_cut"))
    n_cut = F.coalesce("n_cut", F.lit(0))
    return intros.join(cut, "source", "left").select(
        "source", "n_intros", n_cut.alias("n_cut"), (n_cut / F.col("n_intros")).alias("share_cut")
    )


def _p4(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """``row_id, field, <keep>, ref_id`` of every typed value that isn't spelled like an entry.

    The reference lists and the sites are fixed lists (18, 486 and 80 rows);
    the counts of exact spellings are grouped by their entries, so all that
    reaches the driver is bounded by the size of the lists.
    """
    rows = table(spark, sf_dir, "template_rows", "row_id", "title", "school", "college", "source")
    titles = table(spark, sf_dir, "title_list", "title_id", "title_zh", "title_en")
    colleges = table(spark, sf_dir, "college_list", "college_id", "school", "college_zh", "college_en")
    sites = table(spark, sf_dir, "sites", "source", F.col("school").alias("own_school")).dropDuplicates(["source"])
    ranks, places = titles.collect(), colleges.collect()

    rows = rows.join(F.broadcast(sites), "source", "left").withColumn("own_school", F.coalesce("own_school", "school"))
    typed = rows.select(
        "row_id",
        F.explode(
            F.array(
                F.struct(F.lit("title").alias("field"), F.lit("").alias("scope"), F.col("title").alias("value")),
                F.struct(
                    F.lit("college").alias("field"),
                    F.coalesce("own_school", F.lit("")).alias("scope"),
                    F.col("college").alias("value"),
                ),
            )
        ).alias("cell"),
    ).select("row_id", "cell.*")
    typed = typed.where(~is_blank("value"))
    exact = titles.select(F.lit("title").alias("field"), F.col("title_zh").alias("value")).unionByName(
        colleges.select(F.lit("college").alias("field"), F.col("college_zh").alias("value"))
    ).distinct()
    in_scope = titles.select(F.lit("title").alias("field"), F.lit("").alias("scope"), F.col("title_zh").alias("value")).unionByName(
        colleges.select(F.lit("college").alias("field"), F.col("school").alias("scope"), F.col("college_zh").alias("value"))
    ).distinct()
    spelled = typed.join(F.broadcast(in_scope), ["field", "scope", "value"], "left_semi").groupBy("field", "scope", "value").count().collect()
    uses = {(r["field"], r["scope"], r["value"]): r["count"] for r in spelled}
    found = typed.join(F.broadcast(exact), ["field", "value"], "left_anti")
    keep_columns = ["row_id", "field", *keep]
    by_title = mapping.rank_entries([tuple(r) for r in ranks], {v: n for (f, _, v), n in uses.items() if f == "title"})
    by_college = mapping.college_entries([tuple(r) for r in places], {(s, v): n for (f, s, v), n in uses.items() if f == "college"})
    for e in by_title:
        e.scope = "title/"
    for e in by_college:
        e.scope = "college/" + e.scope
    scoped = found.withColumn("scope", F.concat_ws("/", "field", "scope"))
    return mapping.map_values(scoped, keep_columns, by_title + by_college)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p4(spark, sf_dir).drop("tier")


def p4_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed values by field and by how their entry was found."""
    return _p4(spark, sf_dir).groupBy("field", "tier").agg(F.count("*").alias("n_cells"))


def p4_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values without any entry, with their number of rows."""
    return (
        _p4(spark, sf_dir, "value").where("ref_id = 0").groupBy("field", "value").agg(F.count("*").alias("n_rows"))
    )


P5_FIELDS = ("name", "email")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with other characters; names that are garbled and addresses that are residue are answered by 7 and 6."""
    rows = table(spark, sf_dir, "template_rows", "row_id", *P5_FIELDS)
    names = garbled.char_counts(rows, "name")["name"]
    model: list[garbled.CharModel] = []

    def is_garbled(field: str, text: str) -> bool:
        if field != "name":
            return False
        if not model:
            model.append(garbled.model_of(names))
        return garbled.repair(text, model[0])[0]

    found = lookalike.cells(rows, "row_id", P5_FIELDS, is_garbled)
    is_residue = (F.col("field") == "email") & residue.evidence(F.trim("original"), F.lit(True)).isNotNull()
    return found.where(~is_residue).select(F.col("id").alias("row_id"), "field")


def p5_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's name and email in their consistent form."""
    rows = table(spark, sf_dir, "template_rows", "row_id", *P5_FIELDS)
    changed = lookalike.cells(rows, "row_id", P5_FIELDS).groupBy(F.col("id").alias("row_id")).agg(
        *[F.max(F.when(F.col("field") == f, F.col("consistent"))).alias(f"new_{f}") for f in P5_FIELDS]
    )
    joined = rows.join(changed, "row_id", "left")
    return joined.select("row_id", *[F.coalesce(f"new_{f}", f).alias(f) for f in P5_FIELDS])


def _p6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "template_rows", "row_id", "source", "intro", "email")
    return residue.residue(rows, "row_id", "source", ("intro",), ("email",)).withColumnRenamed("id", "row_id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p6(spark, sf_dir).select("row_id", "field")


def p6_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Excluded cells by field and kind of evidence."""
    return _p6(spark, sf_dir).groupBy("field", "evidence").agg(F.count("*").alias("n_cells"))


P7_FIELDS = ("name", "intro")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "template_rows", "row_id", *P7_FIELDS)
    return garbled.restored(rows, "row_id", P7_FIELDS).select(F.col("id").alias("row_id"), "field")


def p7_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Garbled cells with their original text, as far as it can still be had."""
    rows = table(spark, sf_dir, "template_rows", "row_id", *P7_FIELDS)
    whole = ~F.col("restored").contains("\ufffd")
    return garbled.restored(rows, "row_id", P7_FIELDS).select(
        F.col("id").alias("row_id"), "field", "original", "restored", whole.alias("is_whole")
    )


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return tokens.encode_column(docs, "doc_id", "text").withColumnRenamed("id", "doc_id")


def p8_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that the ids of every document stand for; as many as its text has."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return tokens.byte_lengths(tokens.encode_column(docs, "doc_id", "text")).withColumnRenamed("id", "doc_id")


def p9_assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every document, or of every piece of a split one, for each capacity."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    capacities = [tuple(r) for r in table(spark, sf_dir, "container_sizes", "size_id", "capacity_tokens").collect()]
    sizes = tokens.count_column(docs, "doc_id", "text")
    return packing.pack(sizes, capacities).withColumnRenamed("id", "doc_id")


def p9_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers used per capacity, the least number possible by volume, and the share of space filled."""
    capacities = table(spark, sf_dir, "container_sizes", "size_id", "size_name", "capacity_tokens")
    used = (
        p9_assigned(spark, sf_dir)
        .groupBy("size_id", "container_id")
        .agg(F.sum("n_tokens").alias("n"))
        .groupBy("size_id")
        .agg(F.count("*").alias("n_containers"), F.sum("n").alias("n_tokens"))
    )
    return capacities.join(used, "size_id").select(
        "size_id",
        "size_name",
        "n_containers",
        F.ceil(F.col("n_tokens") / F.col("capacity_tokens")).alias("least_containers"),
        (F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens"))).alias("share_filled"),
    )


def p9_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per capacity the documents placed, containers over capacity, and documents split although they fit."""
    capacities = table(spark, sf_dir, "container_sizes", "size_id", "capacity_tokens")
    placed = p9_assigned(spark, sf_dir).join(F.broadcast(capacities), "size_id")
    documents = placed.groupBy("size_id", "capacity_tokens", "doc_id").agg(F.count("*").alias("pieces"), F.sum("n_tokens").alias("n"))
    by_size = documents.groupBy("size_id").agg(
        F.count("*").alias("n_documents"), F.count_if((F.col("pieces") > 1) & (F.col("n") <= F.col("capacity_tokens"))).alias("n_split")
    )
    containers = placed.groupBy("size_id", "capacity_tokens", "container_id").agg(F.sum("n_tokens").alias("n"))
    over = containers.groupBy("size_id").agg(F.count_if(F.col("n") > F.col("capacity_tokens")).alias("n_over"))
    return by_size.join(over, "size_id").select("size_id", "n_documents", "n_split", "n_over")


def p3_intros(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with their intros, as the rates of cut ones count them."""
    return p3_rates(spark, sf_dir).select("source", "n_intros")


def p5_ordinary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and addresses of plain ASCII signs, which the consistent form leaves as they are."""
    forms = p5_consistent(spark, sf_dir)
    return forms.where(~F.col("name").rlike(r"[^\x00-\x7f]") & ~F.col("email").rlike(r"[^\x00-\x7f]")).join(
        table(spark, sf_dir, "template_rows", "row_id", F.col("name").alias("n"), F.col("email").alias("e")), "row_id"
    ).where(~F.col("n").rlike(r"[^\x00-\x7f]") & ~F.col("e").rlike(r"[^\x00-\x7f]")).select("row_id", "name", "email")


def _p10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "level_labels", "doc_id", "level")
    return levels.reading_levels(docs, labels, "doc_id", "text").withColumnRenamed("id", "doc_id")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p10(spark, sf_dir).select("doc_id", "level")


def p10_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus by level and writing: documents, mean coverage rank and mean sentence length (logarithms)."""
    return (
        _p10(spark, sf_dir)
        .groupBy("level", "ideographic")
        .agg(
            F.count("*").alias("n_documents"),
            F.avg("cover_90").alias("mean_cover_90"),
            F.avg("sentence_mean").alias("mean_sentence"),
        )
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p1_found": p1_found, "p1_groups": p1_groups, "p3_found": p3_found, "p3_rates": p3_rates, "p3_intros": p3_intros, "p4_found": p4_found, "p4_misses": p4_misses, "p4_tiers": p4_tiers, "p5_found": p5_found, "p5_consistent": p5_consistent, "p5_ordinary": p5_ordinary, "p6_found": p6_found, "p6_kinds": p6_kinds, "p7_found": p7_found, "p7_restored": p7_restored,
        "p8_ids": p8_ids, "p8_bytes": p8_bytes, "p9_assigned": p9_assigned, "p9_checked": p9_checked, "p9_fill": p9_fill, "p10_found": p10_found, "p10_profile": p10_profile,
    }


def _p1_keys() -> str:
    def value(c: str) -> str:
        bare = f"regexp_replace(lower(upper({c})), '[\\p{{P}}\\p{{S}}{SPACE}]+', '', 'g')"
        return f"CASE WHEN {c} IS NULL OR NOT regexp_matches({c}, '[^{SPACE}]') THEN '' WHEN {bare} = '' THEN chr(1) ELSE {bare} END"

    return f"SELECT row_id, list_sort(list_distinct([{', '.join(map(value, P1_FIELDS))}])) AS k FROM template_rows"


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express; the others are tested against brute force and round trips."""
    keys = f"WITH t AS ({_p1_keys()})"
    return {
        "p1_found": f"{keys} SELECT a.row_id AS row_id_a, b.row_id AS row_id_b FROM t a JOIN t b ON a.k = b.k AND a.row_id < b.row_id",
        "p3_intros": f"SELECT coalesce(source, '') AS source, count(*) AS n_intros FROM template_rows WHERE regexp_matches(intro, '[^{SPACE}]') GROUP BY 1",
        "p5_ordinary": "SELECT row_id, name, email FROM template_rows WHERE NOT regexp_matches(name, '[^\\x00-\\x7f]') AND NOT regexp_matches(email, '[^\\x00-\\x7f]')",
        "p8_bytes": "SELECT doc_id, coalesce(cast(octet_length(encode(text)) AS BIGINT), 0) AS n_bytes FROM documents",
        "p9_checked": "SELECT size_id, (SELECT count(*) FROM documents) AS n_documents, cast(0 AS BIGINT) AS n_split, cast(0 AS BIGINT) AS n_over FROM container_sizes",
        "p1_groups": f"{keys} SELECT min(row_id) AS representative, count(*) AS copies FROM t GROUP BY k",
    }
