"""Registered queries of the core, each a callable of session and data folder, and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import email, markup, names, org, rules, simple, text, title, url
from ..operators import drift, enrich, merge, report, seeds
from . import oracle as q
from .pipeline import Run, projected

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL where SQL can express it."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "template_rows")


# --- text ------------------------------------------------------------------------------------------------------


@query(f"SELECT row_id, {q.norm_ws('name')} AS name, {q.norm_ws('intro')} AS intro, {q.person_name('name')} AS person FROM template_rows")
def text_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_of(spark, sf_dir).select(
        "row_id", text.norm_ws("name").alias("name"), text.norm_ws("intro").alias("intro"), text.person_name("name").alias("person")
    )


@query(f"SELECT doc_id, {q.html_to_text('text')} AS plain FROM documents")
def text_from_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.html_to_text("text").alias("plain"))


@query(f"SELECT row_id, {q.truncate('intro', 60)} AS short, {q.compact('intro')} AS one_line FROM template_rows")
def text_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_of(spark, sf_dir).select("row_id", text.truncate("intro", 60).alias("short"), text.compact("intro").alias("one_line"))


@query(
    f"SELECT row_id, {q.is_valid_intro('intro')} AS is_valid, {q.any_of(q.text_of('intro'), rules.NAVIGATION)} AS is_navigation, "
    f"len(regexp_extract_all({q.text_of('intro')}, '[{q.HAN}]')) >= len(regexp_extract_all({q.text_of('intro')}, '[A-Za-z]')) AS is_han FROM template_rows"
)
def intro_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    intro = text.text_of("intro")
    return rows_of(spark, sf_dir).select(
        "row_id", text.is_valid_intro(intro).alias("is_valid"), text.looks_like_navigation(intro).alias("is_navigation"), text.more_han_than_latin(intro).alias("is_han")
    )


# --- names -----------------------------------------------------------------------------------------------------


@query(f"SELECT row_id, {q.clean_name('name')} AS name FROM template_rows")
def name_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_of(spark, sf_dir).select("row_id", names.clean_name("name").alias("name"))


@query(f"SELECT row_id, cast({q.NAME_QUALITY} AS INT) AS quality, {q.looks_like_name('name')} AS is_name FROM ({q.ROWS})")
def name_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_of(spark, sf_dir).select("row_id", names.name_quality("name").alias("quality"), names.looks_like_name("name").alias("is_name"))


@query(f"SELECT row_id, {q.name_candidate('intro')} AS name FROM template_rows")
def name_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First run of signs in an intro that looks like a name."""
    return rows_of(spark, sf_dir).select("row_id", names.name_candidate("intro").alias("name"))


# --- URLs ------------------------------------------------------------------------------------------------------


@query(
    f"SELECT row_id, lower({q.url_part('profile_url', 2)}) AS host, {q.sub(q.text_of('profile_url'), '#[\\s\\S]*$')} AS bare, {q.profile_key('profile_url')} AS profile_key, "
    f"CASE WHEN {q.url_part('profile_url', 1)} <> '' AND {q.url_part('profile_url', 2)} <> '' THEN lower({q.url_part('profile_url', 1)}) || '://' || {q.url_part('profile_url', 2)} ELSE '' END AS root, "
    f"{q.looks_like_url('profile_url')} AS is_url FROM template_rows"
)
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = "profile_url"
    return rows_of(spark, sf_dir).select(
        "row_id", url.host(u).alias("host"), url.without_fragment(u).alias("bare"), url.profile_key(u).alias("profile_key"), url.site_root(u).alias("root"), url.looks_like_url(u).alias("is_url")
    )


@query(
    "SELECT row_id, coalesce(arg_min(s.school, length(h) - length(s.source)), '') AS site_school "
    f"FROM (SELECT row_id, lower({q.url_part('profile_url', 2)}) AS h FROM template_rows) t LEFT JOIN sites s ON t.h = s.source OR ends_with(t.h, '.' || s.source) GROUP BY row_id"
)
def site_school(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The school whose domain a row's host is or ends in."""
    sites = table(spark, sf_dir, "sites").select("source", "school")
    rows = rows_of(spark, sf_dir).select("row_id", "profile_url")
    return org.join_school_by_host(rows, "profile_url", sites).select("row_id", "site_school")


# --- organisations ---------------------------------------------------------------------------------------------


@query(
    f"SELECT row_id, {q.looks_like_school('school')} AS is_school, {q.looks_like_college('college')} AS is_college, "
    f"{q.placeholder_school('school')} AS is_blank_school, {q.placeholder_college('college')} AS is_blank_college FROM template_rows"
)
def org_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_of(spark, sf_dir).select(
        "row_id",
        org.looks_like_school("school").alias("is_school"),
        org.looks_like_college("college").alias("is_college"),
        org.is_placeholder_school("school").alias("is_blank_school"),
        org.is_placeholder_college("college").alias("is_blank_college"),
    )


@query(
    f"SELECT run_id, s AS school, coalesce({q.filled('c')}, {q.extract_college('k', 's')}) AS college, coalesce(list_filter(regexp_split_to_array(o, '[-_—{q.SPACE}]+'), lambda p: regexp_matches(p, '学院|学部|研究院|中心|系'))[1], {q.filled('o')}, '未填写学院') AS named "
    f"FROM (SELECT run_id, k, o, c, coalesce({q.filled('g')}, {q.extract_school('k')}) AS s FROM (SELECT run_id, {q.clean_stem(q.path_stem('coalesce(input_path, list_page_url)'))} AS k, {q.norm_ws(q.path_stem('output_path'))} AS o, {q.norm_ws('college')} AS c, {q.norm_ws('school')} AS g FROM manifests))"
)
def org_of_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """School and college of every run: what it was told, else what its path or page address says."""
    where = F.coalesce("input_path", "list_page_url")
    found = org.default_org("school", "college", None, url.path_stem(where))
    return table(spark, sf_dir, "manifests").select(
        "run_id", found["school"].alias("school"), found["college"].alias("college"), org.college_of_stem(url.path_stem("output_path")).alias("named")
    )


@query(
    f"SELECT doc_id, s AS school, {q.extract_college('t', 's')} AS college FROM (SELECT doc_id, t, {q.extract_school('t')} AS s FROM (SELECT doc_id, {q.norm_ws('text')} AS t FROM documents))"
)
def org_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """School and college named in every captured text."""
    named = text.let(
        text.norm_ws("text"),
        lambda t: text.let(
            org.extract_school(t), lambda school: F.struct(school.alias("school"), org.extract_college(t, school).alias("college"))
        ),
    )
    return table(spark, sf_dir, "documents").select("doc_id", named.alias("named")).select("doc_id", "named.school", "named.college")


_FORWARD = f"""
WITH r AS (SELECT run_id, row_id, {q.norm_ws('school')} AS school, {q.norm_ws('college')} AS college FROM template_rows)
SELECT row_id,
  coalesce(last_value(CASE WHEN {q.looks_like_school('school')} AND NOT {q.placeholder_school('school')} THEN school END IGNORE NULLS) OVER w, '') AS school,
  coalesce(last_value(CASE WHEN {q.looks_like_college('college')} AND NOT {q.placeholder_college('college')} THEN college END IGNORE NULLS) OVER w, '') AS college
FROM r WINDOW w AS (PARTITION BY run_id ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


@query(_FORWARD)
def org_filled_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank and malformed organisations take the last good one of their run."""
    rows = rows_of(spark, sf_dir).select("run_id", "row_id", "school", "college")
    return seeds.fill_org_forward(rows, "run_id", "row_id").select("row_id", "school", "college")


@query(
    f"SELECT run_id, coalesce(arg_min(s, row_id) FILTER (s <> ''), '未填写学校') AS school FROM (SELECT run_id, row_id, {q.norm_ws('school')} AS s FROM template_rows) GROUP BY run_id"
)
def org_first_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.first_filled(rows_of(spark, sf_dir), "run_id", "row_id", "school", F.lit("未填写学校"))


# --- addresses -------------------------------------------------------------------------------------------------


@query(
    f"SELECT row_id, {q.undisguise('email')} AS email, CASE WHEN contains(e, '@') THEN left(sha256(split_part(e, '@', 1)), 12) || '@' || list_last(string_split(e, '@')) ELSE '' END AS masked FROM (SELECT row_id, email, lower(coalesce(email, '')) AS e FROM template_rows)"
)
def email_undisguised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_of(spark, sf_dir).select("row_id", email.undisguise("email").alias("email"), email.masked("email").alias("masked"))


_SEVERAL = "concat_ws('; ', email, 'Office@Pages.test.cn', email, collector)"


@query(
    f"SELECT row_id, cast(len(list_distinct(list_transform(regexp_extract_all({_SEVERAL}, {q.lit(markup.EMAIL)}), lambda e: lower(e)))) AS BIGINT) AS n_addresses FROM template_rows"
)
def email_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different addresses in a text that has some of them twice."""
    return rows_of(spark, sf_dir).select("row_id", F.size(email.addresses(F.expr(_SEVERAL))).cast("long").alias("n_addresses"))


@query(
    f"SELECT row_id, lower(coalesce(list_filter(regexp_extract_all(t, {q.lit(markup.EMAIL)}), lambda e: NOT regexp_matches(e, '(?i)@(?:example[.]com|test[.]com|163[.]com[.]cn)$'))[1], regexp_extract_all(t, {q.lit(markup.EMAIL)})[1], '')) AS email FROM (SELECT row_id, 'x@example.com ' || {_SEVERAL} AS t FROM template_rows)"
)
def email_first_usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first address that is no stand-in."""
    found = email.addresses(F.concat(F.lit("x@example.com "), F.expr(_SEVERAL)))
    return rows_of(spark, sf_dir).select("row_id", F.lower(email.first_usable(found)).alias("email"))


@query(
    f"SELECT row_id, len(regexp_extract_all({q.text_of('email')}, {q.lit(simple.EMAIL)})) > 0 AS has_address, "
    f"coalesce(regexp_extract({q.text_of('email')}, {q.lit(simple.EMAIL)}), '') AS first_address FROM template_rows"
)
def email_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The light profile: addresses of any top-level domain as they stand."""
    found = simple.addresses("email")
    return rows_of(spark, sf_dir).select(
        "row_id", (F.size(found) > 0).alias("has_address"), F.coalesce(F.get(found, F.lit(0)), F.lit("")).alias("first_address")
    )


# --- ranks -----------------------------------------------------------------------------------------------------


@query(
    f"WITH t AS MATERIALIZED (SELECT row_id AS id, {q.norm_ws('title')} AS s FROM template_rows), {q.ALIASES}, {q.occurrences('t')}, {q.first_rank('occ')} "
    f"SELECT t.id AS row_id, {q.normal_title('t.s', 'f.title')} AS title FROM t LEFT JOIN first_rank f ON f.id = t.id"
)
def title_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_of(spark, sf_dir).select("row_id", title.normalise("title").alias("title"))


@query(
    f"SELECT row_id, {q.valid_title('title')} AS is_valid, CASE WHEN contains({q.norm_ws('title')}, '副教授') THEN '副教授' WHEN contains({q.norm_ws('title')}, '讲师') THEN '讲师' "
    f"WHEN contains({q.norm_ws('title')}, '教授') THEN '教授' ELSE '' END AS by_word, regexp_extract({q.norm_ws('title')}, {q.lit(rules.SPECIFIC_TITLE)}, 1) AS specific, "
    f"CASE WHEN {q.has(q.text_of('title'), rules.FULL_LEVEL)} THEN '教授' WHEN {q.has(q.text_of('title'), rules.ASSOCIATE_LEVEL)} THEN '副教授' ELSE '' END AS by_level FROM template_rows"
)
def title_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_of(spark, sf_dir).select(
        "row_id", title.is_valid(F.col("title")).alias("is_valid"), title.of_name("title").alias("by_word"), title.specific("title").alias("specific"), title.by_level(text.text_of("title")).alias("by_level")
    )


@query(
    f"WITH t AS MATERIALIZED (SELECT row_id AS id, concat_ws(' ', title, intro) AS s FROM template_rows), {q.ALIASES}, {q.occurrences('t')} SELECT id AS row_id, title, count(*) AS n FROM occ GROUP BY ALL"
)
def title_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places at which any rank is named in a row's texts."""
    found = title.occurrences(F.concat_ws(" ", "title", "intro"))
    each = rows_of(spark, sf_dir).select("row_id", F.explode(found).alias("o")).select("row_id", "o.title", "o.start", "o.end").distinct()
    return each.groupBy("row_id", "title").agg(F.count("*").alias("n"))


@query(
    f"WITH t AS MATERIALIZED (SELECT row_id AS id, concat_ws(' ', title, name, intro) AS s, {q.strip("concat_ws(' ', title, name, intro)")} AS b, {q.clean_name('name')} AS n FROM template_rows), {q.ALIASES}, {q.occurrences('t')}, "
    "d AS (SELECT o.id, o.title, o.priority, o.start, o.stop, instr(t.s, t.n) - 1 AS a, instr(t.s, t.n) - 1 + length(t.n) AS e FROM occ o JOIN t ON t.id = o.id AND t.n <> '' AND contains(t.s, t.n)), "
    f"g AS (SELECT *, CASE WHEN stop <= a THEN a - stop WHEN start >= e THEN start - e ELSE 0 END AS far FROM d), r AS (SELECT id, arg_min(title, (far, priority, start, start - stop)) AS title FROM g WHERE far <= {title.NEAR} GROUP BY id) "
    f"SELECT t.id AS row_id, coalesce(r.title, '') AS title, {q.context_of('t.b', 't.n')} AS context FROM t LEFT JOIN r ON r.id = t.id"
)
def title_near_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rank that stands nearest the name within a row's rank and intro."""
    around = F.concat_ws(" ", "title", "name", "intro")
    return rows_of(spark, sf_dir).select("row_id", title.near_name(around, "name").alias("title"), title.context_of(around, "name").alias("context"))


# --- seeds -----------------------------------------------------------------------------------------------------


def seed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable seed records as ragged rows ``source, ord, cells``; the keys of a file's first record are its header.

    Values stand under their own key whatever their order; further keys of later records follow behind.
    """
    members = F.from_json("record", "map<string,string>", {"mode": "PERMISSIVE"})
    lines = table(spark, sf_dir, "seed_lines").where(F.try_parse_json("record").isNotNull()).select(F.col("file_id").alias("source"), "line_id", members.alias("m"))
    keyed = lines.where(F.size("m") > 0)
    header = keyed.groupBy("source").agg(F.min_by(F.map_keys("m"), "line_id").alias("keys"))
    at = F.row_number().over(Window.partitionBy("source").orderBy("line_id")) - 1
    placed = keyed.withColumn("ord", at.cast("long")).join(header, "source")
    further = F.filter(F.map_keys("m"), lambda k: ~F.array_contains("keys", k))
    value = lambda k: F.coalesce(F.try_element_at("m", k), F.lit(""))
    data = placed.select("source", "ord", F.transform(F.concat("keys", further), value).alias("cells"))
    return data.unionByName(header.select("source", F.lit(-1).cast("long").alias("ord"), F.col("keys").alias("cells")))


_HEADS = "h AS (SELECT file_id, arg_min(json_keys(record), line_id) AS keys FROM seed_lines WHERE json_valid(record) AND json_type(record) = 'OBJECT' GROUP BY file_id)"
_KNOWN = "a(header, field) AS (VALUES " + ", ".join(
    f"({q.lit(a.lower())}, {q.lit(f)})" for f, aliases in rules.HEADER_ALIASES.items() for a in aliases if a.lower() not in rules.PLACEHOLDER_HEADERS
) + ")"


@query(
    f"WITH {_HEADS}, {_KNOWN}, k AS (SELECT file_id, unnest(keys) AS key, unnest(range(len(keys))) AS pos FROM h) "
    f"SELECT k.file_id, a.field, cast(min(pos) AS INT) AS position FROM k JOIN a ON {q.norm_ws('lower(k.key)')} = a.header GROUP BY ALL"
)
def seed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of the fields whose header is spelled in a known way."""
    known = [(a.lower(), f) for f, aliases in rules.HEADER_ALIASES.items() for a in aliases if a.lower() not in rules.PLACEHOLDER_HEADERS]
    aliases = spark.createDataFrame(known, "header string, field string")
    heads = seed_cells(spark, sf_dir).where("ord = -1").select(F.col("source").alias("file_id"), F.posexplode("cells").alias("pos", "key"))
    named = heads.withColumn("header", F.lower(text.norm_ws("key"))).join(F.broadcast(aliases), "header")
    return named.groupBy("file_id", "field").agg(F.min("pos").cast("int").alias("position"))


@query(f"WITH {q.seed_columns()} SELECT * FROM cols")
def seed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which column holds which field, by header, samples and position."""
    cells = seed_cells(spark, sf_dir)
    maps = seeds.header_map(cells.where("ord = -1"), cells.where("ord >= 0"))
    return maps.select(F.col("source").alias("file_id"), *[F.col("columns")[f].alias(f) for f in rules.HEADER_ALIASES])


@query(q.seed_records())
def seed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all seed files, several per row where a row holds several."""
    cells = seed_cells(spark, sf_dir)
    rows = cells.where("ord >= 0")
    maps = seeds.header_map(cells.where("ord = -1"), rows)
    return seeds.expand(rows, maps).withColumnRenamed("source", "file_id")


@query("SELECT file_id, line_id FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY line_no, line_id) AS n FROM seed_lines) WHERE n <= 3")
def seed_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three lines of every seed file (a run's limit)."""
    lines = table(spark, sf_dir, "seed_lines").select(F.col("file_id").alias("source"), F.struct("line_no", "line_id").alias("ord"), "line_id")
    return seeds.first_rows(lines, 3).select(F.col("source").alias("file_id"), "line_id")


# --- joins -----------------------------------------------------------------------------------------------------


_BEST_BY_URL = (
    "b AS (SELECT u, arg_max(title, row_id) AS title, arg_max(email, row_id) AS email FROM (SELECT row_id, lower(regexp_replace(profile_url, '#[\\s\\S]*$', '')) AS u, title, email FROM template_rows "
    "WHERE profile_url IS NOT NULL AND profile_url <> '' AND title IS NOT NULL AND email IS NOT NULL) GROUP BY u)"
)


@query(
    f"WITH {_BEST_BY_URL} SELECT log_id, coalesce(b.title, '') AS title, coalesce(b.email, '') AS email, b.u IS NOT NULL AS found FROM run_log l LEFT JOIN b ON lower(regexp_replace(l.url, '#[\\s\\S]*$', '')) = b.u"
)
def log_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log entries with rank and address of the latest row of their page; entries without one are kept."""
    rows = rows_of(spark, sf_dir).where("profile_url <> '' AND title IS NOT NULL AND email IS NOT NULL")
    best = rows.groupBy(F.lower(url.without_fragment("profile_url")).alias("u")).agg(
        F.max_by("title", "row_id").alias("title"), F.max_by("email", "row_id").alias("email")
    )
    log = table(spark, sf_dir, "run_log").select("log_id", F.lower(F.regexp_replace("url", r"#[\s\S]*$", "")).alias("u"))
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return log.join(best.withColumn("_f", F.lit(True)), "u", "left").select("log_id", blank("title"), blank("email"), F.coalesce("_f", F.lit(False)).alias("found"))


@query(
    f"SELECT run_id, output_path FROM manifests m WHERE NOT EXISTS (SELECT 1 FROM template_rows t WHERE t.run_id = m.run_id AND {q.is_valid_row('t.')})"
)
def runs_without_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.without_rows(table(spark, sf_dir, "manifests"), rows_of(spark, sf_dir))


# --- merging ---------------------------------------------------------------------------------------------------


@query(f"SELECT row_id, {q.IDENTITY} FROM ({q.ROWS})")
def row_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.cleaned(rows_of(spark, sf_dir)).select("row_id", merge.identity().alias("i")).select("row_id", "i.*")


@query(f"SELECT row_id, {', '.join(f'cast({e} AS INT) AS {k}' for k, e in q.QUALITY.items())} FROM ({q.ROWS})")
def row_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.cleaned(rows_of(spark, sf_dir)).select("row_id", merge.quality().alias("i")).select("row_id", "i.*")


_RANKED = f"""
WITH r AS ({q.ROWS}), i AS (SELECT *, {q.IDENTITY} FROM r),
s AS (SELECT row_id, kind, a, b, c, min(row_id) OVER (PARTITION BY kind, a, b, c) AS first_id,
  row_number() OVER (PARTITION BY kind, a, b, c ORDER BY {', '.join(f'{e} DESC' for e in q.QUALITY.values())}, row_id) AS n FROM i)
SELECT row_id, first_id FROM s WHERE n = 1"""


@query(_RANKED)
def best_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per identity the best row and the first row's number."""
    rows = rows_of(spark, sf_dir).select("row_id", F.col("row_id").alias("first_id"), *rules.COLUMNS)
    return merge.best_rows(rows, "first_id").select("row_id", "first_id")


_SHARED = f"WITH r AS ({q.ROWS}) SELECT school, college, lower(email) AS email, cast(count(DISTINCT cname) AS BIGINT) AS n_people FROM r WHERE school <> '' AND college <> '' AND email <> '' AND cname <> '' GROUP BY ALL HAVING count(DISTINCT cname) >= 2"


@query(f"SELECT school, college, email FROM ({_SHARED})")
def shared_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.shared_addresses(rows_of(spark, sf_dir)).select(
        F.col("_school").alias("school"), F.col("_college").alias("college"), F.col("_email").alias("email")
    )


@query(
    f"WITH x AS ({_SHARED}), n AS ({q.ROWS}) SELECT t.row_id, CASE WHEN x.email IS NOT NULL THEN '' ELSE t.email END AS email FROM template_rows t JOIN n ON n.row_id = t.row_id "
    "LEFT JOIN x ON x.school = n.school AND x.college = n.college AND x.email = lower(n.email)"
)
def shared_stripped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's address, blanked where several people of its college have it."""
    return merge.without_shared_addresses(rows_of(spark, sf_dir).select("row_id", "name", "email", "school", "college")).select("row_id", "email")


_DAY = "CASE WHEN regexp_matches(collected_at, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN try_cast(collected_at AS TIMESTAMP) END"
_LATE = f"coalesce(ingested_at > {_DAY} + INTERVAL 30 DAY, false)"


@query(q.upserted(f"(SELECT *, row_id AS ord FROM template_rows WHERE NOT {_LATE})", f"(SELECT *, row_id AS ord FROM template_rows WHERE {_LATE})"))
def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows merged into the earlier ones: the best row of every identity, renumbered."""
    rows = rows_of(spark, sf_dir).select(F.col("row_id").alias("ord"), *rules.COLUMNS, "ingested_at")
    day = F.when(F.col("collected_at").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_timestamp("collected_at"))
    marked = rows.withColumn("_late", F.coalesce(F.col("ingested_at") > day + F.expr("INTERVAL 30 DAYS"), F.lit(False)))
    return merge.upserted(marked.where("NOT _late").drop("_late", "ingested_at"), marked.where("_late").drop("_late", "ingested_at"))


@query()
def profiles_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the same person within a college folded into one."""
    rows = rows_of(spark, sf_dir).select(F.col("row_id").alias("ord"), "name", "profile_url", "school", "college", "title", "email", "intro")
    return merge.merged_profiles(rows)


@query(
    f"WITH t AS MATERIALIZED (SELECT row_id AS id, {q.norm_ws('title')} AS s FROM template_rows), {q.ALIASES}, {q.occurrences('t')}, {q.first_rank('occ')}, "
    f"x AS (SELECT r.*, {q.normal_title('t.s', 'f.title')} AS rank FROM template_rows r JOIN t ON t.id = r.row_id LEFT JOIN first_rank f ON f.id = t.id) "
    f"SELECT row_id AS ord, {q.compact(q.clean_name('name'))} AS name, CASE WHEN rank = '' AND {q.norm_ws('email')} <> '' THEN '教授' ELSE {q.compact('rank')} END AS title, {q.compact('email')} AS email, {q.compact('school')} AS school, {q.compact('college')} AS college, "
    f"'collector' AS collector, '2025-01-01' AS collected_at, {q.compact(q.truncate(q.norm_ws('intro'), 200))} AS intro, {q.compact('profile_url')} AS profile_url, rank = '' AND {q.norm_ws('email')} <> '' AS title_imputed FROM x"
)
def rows_projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as template rows, with blank ranks beside an address imputed and marked."""
    rows = rows_of(spark, sf_dir).select(F.col("row_id").alias("ord"), "name", "profile_url", "school", "college", "title", "email", "intro")
    return projected(rows, Run(collector="collector", day="2025-01-01"))


@query(f"SELECT row_id FROM template_rows WHERE {q.is_valid_row()}")
def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_of(spark, sf_dir).where(merge.is_valid_row()).select("row_id")


# --- reports ---------------------------------------------------------------------------------------------------


@query(
    f"SELECT {q.norm_ws('collected_at')} AS collected_at, count(*) AS n_rows, count(*) FILTER ({q.is_valid_row()}) AS n_valid FROM template_rows GROUP BY 1"
)
def valid_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.valid_by_day(rows_of(spark, sf_dir))


@query(
    f"SELECT count(*) AS n_input, count(*) FILTER ({q.is_valid_row()}) AS n_exported, count(*) FILTER (NOT {q.is_valid_row()}) AS n_filtered FROM template_rows"
)
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.counters(rows_of(spark, sf_dir))


_REAL = f"SELECT row_id, {q.norm_ws('school')} AS s, {q.norm_ws('college')} AS c, {q.norm_ws('name')} AS n, concat_ws('-', {q.norm_ws('school')}, {q.norm_ws('college')}) AS g FROM template_rows WHERE NOT {q.placeholder_school('school')} AND NOT {q.placeholder_college('college')}"


@query(f"SELECT row_id, cast(row_number() OVER (ORDER BY g, s, c, n, row_id) AS BIGINT) AS number FROM ({_REAL})")
def summary_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of real organisations in the order of the summary, numbered over all."""
    return report.summary(rows_of(spark, sf_dir).select("row_id", "school", "college", "name"), "row_id").select("row_id", "number")


@query(f"SELECT row_id, g AS group_key, cast(row_number() OVER (PARTITION BY g ORDER BY row_id) AS BIGINT) AS number FROM ({_REAL})")
def group_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.numbered_by_group(rows_of(spark, sf_dir).select("row_id", "school", "college"), "row_id").select("row_id", "group_key", "number")


@query(
    "SELECT m.run_id, m.row_count AS claimed, cast(coalesce(t.n, 0) AS BIGINT) AS actual, cast(coalesce(t.n, 0) - coalesce(m.row_count, 0) AS BIGINT) AS difference "
    "FROM manifests m LEFT JOIN (SELECT run_id, count(*) AS n FROM template_rows GROUP BY run_id) t ON t.run_id = m.run_id"
)
def run_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.claims(table(spark, sf_dir, "manifests"), rows_of(spark, sf_dir))


@query(
    f"SELECT severity, count(*) AS n_entries, count(DISTINCT run_id) AS n_runs FROM (SELECT DISTINCT lower({q.norm_ws('severity')}) AS severity, run_id, row_no, name, url, message FROM run_log) GROUP BY severity"
)
def log_by_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.log_summary(table(spark, sf_dir, "run_log"))


@query(
    "SELECT run_id, log_id, message, n_entries FROM (SELECT *, count(*) OVER (PARTITION BY run_id) AS n_entries, row_number() OVER (PARTITION BY run_id ORDER BY logged_at DESC NULLS LAST, log_id DESC) AS n FROM run_log) WHERE n = 1"
)
def log_last_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.last_by_run(table(spark, sf_dir, "run_log"))


# --- schema drift ----------------------------------------------------------------------------------------------


_DRIFT_FIELD = "CASE " + " ".join(
    f"WHEN lower(regexp_replace(key, '[\\s_\\-.:：/]+', '', 'g')) IN ({', '.join(q.lit(drift.bare(a)) for a in f.aliases)}) THEN {q.lit(f.name)}" for f in drift.FIELDS
) + " ELSE key END"
_DRIFT = f"""
WITH v AS (SELECT file_id, record FROM seed_lines WHERE json_valid(record) AND json_type(record) = 'OBJECT'),
k AS (SELECT file_id, record, unnest(json_keys(record)) AS key FROM v),
t AS (SELECT file_id, key, json_type(record, '$."' || key || '"') AS jt FROM k),
n AS (SELECT file_id, key, CASE WHEN jt IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'HUGEINT') THEN 'number' WHEN jt = 'VARCHAR' THEN 'string' WHEN jt = 'BOOLEAN' THEN 'boolean' WHEN jt = 'ARRAY' THEN 'array' WHEN jt = 'OBJECT' THEN 'object' END AS kind FROM t),
c AS (SELECT file_id, key, kind, count(*) AS m FROM n GROUP BY ALL),
p AS (SELECT file_id, key, {_DRIFT_FIELD} AS field, arg_min(kind, (-m, kind)) FILTER (kind IS NOT NULL) AS kind FROM c GROUP BY file_id, key),
f AS (SELECT file_id, feed_id, lag(file_id) OVER (PARTITION BY feed_id ORDER BY file_date, file_id) AS before FROM seed_files),
o AS (SELECT f.file_id, p.field, p.key, p.kind FROM f JOIN p ON p.file_id = f.before),
w AS (SELECT f.file_id, p.field, p.key, p.kind FROM f JOIN p ON p.file_id = f.file_id WHERE f.before IS NOT NULL),
j AS (SELECT coalesce(o.file_id, w.file_id) AS file_id, coalesce(o.field, w.field) AS field, o.key AS okey, w.key AS wkey, o.kind AS okind, w.kind AS wkind FROM o FULL JOIN w ON o.file_id = w.file_id AND o.field = w.field)
SELECT file_id, field, 'added' AS change FROM j WHERE okey IS NULL
UNION ALL SELECT file_id, field, 'removed' FROM j WHERE wkey IS NULL
UNION ALL SELECT file_id, field, 'renamed' FROM j WHERE okey <> wkey
UNION ALL SELECT file_id, field, 'retyped' FROM j WHERE okind <> wkind"""


@query(_DRIFT)
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.changes(table(spark, sf_dir, "seed_files"), table(spark, sf_dir, "seed_lines"))


@query()
def p2_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seed records of all files in one table."""
    return drift.unify(table(spark, sf_dir, "seed_files"), table(spark, sf_dir, "seed_lines"))


_BARE = "lower(regexp_replace(key, '[\\s_\\-.:：/]+', '', 'g'))"


def _unified_value(f: drift.FieldSpec) -> str:
    """The plain value under the first key that is a spelling of the field."""
    listed = ", ".join(q.lit(drift.bare(a)) for a in f.aliases)
    key = f"list_filter(list_sort(ks), lambda key: {_BARE} IN ({listed}))[1]"
    at = "json_extract(record, '$.\"' || " + key + " || '\"')"
    value = "json_extract_string(record, '$.\"' || " + key + " || '\"')"
    return (
        f"CASE json_type({at}) WHEN 'ARRAY' THEN json_extract_string({at}, '$[0]') WHEN 'OBJECT' THEN coalesce(json_extract_string({at}, '$.text'), json_extract_string({at}, '$.href'), {value}) ELSE {value} END AS {f.name}"
    )


@query(
    "WITH v AS MATERIALIZED (SELECT line_id, record, json_keys(record) AS ks FROM seed_lines WHERE json_valid(record) AND json_type(record) = 'OBJECT') "
    f"SELECT line_id, {', '.join(map(_unified_value, drift.FIELDS))} FROM v"
)
def p2_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The known fields of the unified seed table."""
    return p2_unified(spark, sf_dir).drop("others", "file_id", "line_no")


def queries() -> dict[str, Query]:
    from . import page_queries  # noqa: F401 - registers its own

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(ORACLES)
