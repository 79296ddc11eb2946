"""Registered queries of what is read off pages. The pages are made of template rows by one SQL expression, the same for both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import email, markup, names, org, rules, simple, text, title, url
from ..operators import enrich, pages
from ..operators.common import checkpointed
from . import oracle as q
from .queries import query, rows_of

_V = {c: f"coalesce({c}, '')" for c in ("name", "title", "email", "school", "college", "intro")}
_URL = "'https://pages.test/p/' || cast(row_id AS VARCHAR(20)) || '.htm'"
#: A person's page: its title, the rank, the address behind a label, and the intro.
PAGE = (
    f"concat('<html><head><title>', {_V['name']}, '--', {_V['school']}, '-', {_V['college']}, '</title></head><body><p>', {_V['name']}, '，', {_V['title']}, '</p><p>邮箱：', {_V['email']}, "
    f"'</p><p>', {_V['intro']}, '</p><p>版权所有 地址：甲路1号 电话：1 office@pages.test.cn</p></body></html>')"
)
SECTIONS = (
    f"concat('<span id=\"t1\"> 姓名 </span><i></i><div class=\"nr\" id=\"n1\">', {_V['name']}, '</div><!--ckendn1--><p></p>', "
    f"'<span id=\"t2\">个人简介</span><div id=\"n2\" class=\"nr\"><p>', {_V['intro']}, '</p></div><!--ckendn2-->')"
)
LINKS = (
    f"concat('<a class=\"x\" href=\"/info/1/', cast(row_id AS VARCHAR(20)), '.htm\" >', {_V['name']}, ' ', {_V['title']}, '</a><a href=\"/info/1/2.htm\">more</a>', "
    f"'<a href=\"/info/1/', cast(row_id AS VARCHAR(20)), '.htm\"><b>', {_V['name']}, '</b> ', {_V['title']}, '</a><a href=\"/other\">', {_V['name']}, '</a>')"
)
CARDS = (
    f"concat('<script src=\"centerCutImg.js\"></script><ul><li><a href=\"/t/', cast(row_id AS VARCHAR(20)), '\"><div class=\"pic fl\"></div><div class=\"con fl\"><p class=\"btn\">+</p><p class=\"bt\">', {_V['name']}, ' ', {_V['title']}, "
    f"'</p><p class=\"zy\">', {_V['intro']}, '</p></div></a></li><li><a href=\"/n\">', {_V['name']}, '</a></li></ul>')"
)
_PLAIN_NAME = f"regexp_replace({_V['name']}, '[^一-龥A-Za-z· ]', '', 'g')"
_IS_PLAIN = "NOT regexp_matches(name, '[\"''\\\\\\\\<>&\\x00-\\x1f]')"


def made(spark: SparkSession, sf_dir: str, expression: str, where: str = "true") -> DataFrame:
    """``row_id, url, html`` and the fields of every row's page."""
    return rows_of(spark, sf_dir).where(where).select(
        "row_id", "name", "title", "email", "school", "college", "intro", F.expr(_URL).alias("url"), F.expr(expression).alias("html")
    )


_TEXT = f"SELECT row_id AS id, {q.html_to_text(PAGE)} AS s FROM template_rows"
_BODY_LINE = q.first_of(f"list_filter(list_transform(string_split(s, chr(10)), lambda x: {q.norm_ws('x')}), lambda x: length(x) >= 20 AND NOT {q.any_of('x', rules.NAVIGATION)} AND {q.is_valid_intro('x')})")


@query(
    f"WITH t AS MATERIALIZED ({_TEXT}), {q.ALIASES}, {q.occurrences('t')}, {q.first_rank('occ')}, u AS MATERIALIZED (SELECT id, 1 AS k, {q.undisguise('s')} AS s, {rules.SOURCE_BONUS['text']} AS bonus FROM t), {q.email_candidates('u')}, {q.best_email('candidates', 'best')} "
    f"SELECT t.id AS row_id, {q.truncate(_BODY_LINE, 200)} AS intro, coalesce(f.title, '') AS title, coalesce(b.email, '') AS email FROM t LEFT JOIN first_rank f ON f.id = t.id LEFT JOIN best b ON b.id = t.id"
)
def page_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First line of content, first rank and best address of every person's page."""
    told = made(spark, sf_dir, PAGE).select("row_id", "html", text.html_to_text("html").alias("_t"))
    return told.select(
        "row_id", text.page_intro("html", "_t").alias("intro"), title.first_in("_t").alias("title"), email.best(email.candidates(email.undisguise("_t"), "text")).alias("email")
    )


@query(
    f"WITH u AS MATERIALIZED (SELECT row_id AS id, 1 AS k, {q.undisguise(PAGE)} AS s, {rules.SOURCE_BONUS['html']} AS bonus FROM template_rows), {q.email_candidates('u')} SELECT id AS row_id, email, score FROM candidates"
)
def email_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every address of every person's page with its score."""
    found = email.candidates(email.undisguise("html"), "html")
    return made(spark, sf_dir, PAGE).select("row_id", F.explode(found).alias("c")).select("row_id", "c.email", "c.score")


def _labelled(source: str) -> str:
    """A relation of what stands behind the labels of ``id, k, s``, as text without disguise, as it is and without white space."""
    behind = " || ".join(f"regexp_extract_all(s, {q.lit(p)}, 1)" for p in markup.MAIL_LABELS)
    plain = q.undisguise(f"CASE WHEN contains(x, '<') AND contains(x, '>') THEN {q.html_to_text('x')} ELSE x END")
    return f"""behind AS MATERIALIZED (SELECT id, k, {plain} AS s FROM (SELECT id, k, unnest({behind}) AS x FROM {source})),
labelled AS MATERIALIZED (SELECT DISTINCT id, k, s, {rules.SOURCE_BONUS['context']} AS bonus FROM (SELECT * FROM behind UNION ALL SELECT id, k, {q.sub('s', f'[{q.SPACE}]+')} FROM behind))"""


_EXTRACT = f"""
WITH p AS MATERIALIZED (SELECT row_id AS id, {PAGE} AS html, {q.html_to_text(PAGE)} AS t, {q.clean_name('name')} AS n FROM template_rows),
src AS MATERIALIZED (SELECT id, 1 AS k, {rules.SOURCE_BONUS['context']} AS bonus, {q.context_of('t', 'n')} AS s FROM p UNION ALL SELECT id, 2, {rules.SOURCE_BONUS['text']}, t FROM p UNION ALL SELECT id, 3, {rules.SOURCE_BONUS['html']}, html FROM p),
{_labelled('src')}, {q.email_candidates('labelled', 'lc')}, {q.best_email('lc', 'lb', 70)},
und AS MATERIALIZED (SELECT id, k, {q.undisguise('s')} AS s, bonus FROM src), {q.email_candidates('und', 'sc')},
trust AS (SELECT lb.id, lb.email FROM lb JOIN sc ON sc.id = lb.id AND lower(sc.email) = lower(lb.email) WHERE lb.email <> '' GROUP BY ALL HAVING max(sc.score) >= 70),
nearby AS (SELECT * FROM sc WHERE k < 3), {q.best_email('nearby', 'nb', 70)}, {q.best_email('sc', 'ab')}
SELECT p.id AS row_id, coalesce(trust.email, nullif(nb.email, ''), ab.email, '') AS email FROM p LEFT JOIN trust ON trust.id = p.id LEFT JOIN nb ON nb.id = p.id LEFT JOIN ab ON ab.id = p.id"""


@query(_EXTRACT)
def email_extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The address a page gives: labelled and reliable, else the best near the name and in the text, else the best of all."""
    told = made(spark, sf_dir, PAGE).select("row_id", "html", "name", text.html_to_text("html").alias("_t"))
    told = told.withColumn("_c", title.context_of("_t", "name"))
    return told.select("row_id", email.extract("html", "_t", "_c").alias("email"))


@query(
    f"WITH x AS (SELECT row_id, unnest([{{'title': '姓名', 'html': {_V['name']}}}, {{'title': '个人简介', 'html': '<p>' || {_V['intro']} || '</p>'}}]) AS x FROM template_rows) "
    f"SELECT row_id, x.title AS title, {q.clean_intro(q.html_to_text('x.html'))} AS content FROM x"
)
def page_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titled blocks of a page with their plain text."""
    each = made(spark, sf_dir, SECTIONS).select("row_id", F.explode(text.named_sections("html")).alias("s"))
    return each.select("row_id", "s.title", text.clean_intro(text.html_to_text("s.html")).alias("content"))


_SECTION = q.clean_intro(q.html_to_text("'<p>' || " + _V["intro"] + " || '</p>'"))


@query(f"SELECT row_id, CASE WHEN {q.is_valid_intro(_SECTION)} THEN {_SECTION} ELSE '' END AS intro FROM template_rows")
def page_section_intro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return made(spark, sf_dir, SECTIONS).select("row_id", text.section_intro("html").alias("intro"))


_DESCRIBED = f"replace(replace({_V['intro']}, chr(34), ''), chr(39), '')"
_META = f"concat('<head><meta content=\"', replace(replace({_DESCRIBED}, '<', ''), '>', ''), '\" name=\"description\"></head>')"


@query(f"SELECT row_id, {q.norm_ws('d')} AS description FROM (SELECT row_id, replace(replace({_DESCRIBED}, '<', ''), '>', '') AS d FROM template_rows)")
def page_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The description in a page's head, whatever the order of its attributes."""
    return made(spark, sf_dir, _META).select("row_id", text.meta_description("html").alias("description"))


_TITLE_TEXT = q.clean_intro(q.html_to_text(f"{_V['name']} || '--' || {_V['school']} || '-' || {_V['college']}"))


@query(
    f"SELECT row_id, {q.first_of('list_filter(list_transform(regexp_split_to_array(t, ' + q.lit('--|－|—|-') + '), lambda c: ' + q.name_candidate('c') + '), lambda c: c <> ' + q.lit('') + ')')} AS name FROM (SELECT row_id, {_TITLE_TEXT} AS t FROM template_rows)"
)
def page_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The person a page is about, by its title."""
    return made(spark, sf_dir, PAGE).select("row_id", names.name_of_page("html", "url").alias("name"))


_TIGHT = f"regexp_replace({q.clean_intro(q.html_to_text(_V['name'] + ' || chr(32) || ' + _V['title']))}, '[{q.SPACE}]+', '', 'g')"


@query(
    f"SELECT row_id, 'https://pages.test/info/1/' || row_id || '.htm' AS profile_url, cast(1 AS INT) AS at, {q.clean_name('t')} AS name, {q.of_name('t')} AS title FROM (SELECT row_id, {_TIGHT} AS t FROM template_rows) WHERE {q.looks_like_name(q.clean_name('t'))}"
)
def list_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People linked from listing pages; a link met twice counts once, links without a name don't."""
    found = pages.list_links(made(spark, sf_dir, LINKS).select("url", "html"))
    return found.select(F.regexp_extract("url", r"/(\d+)\.htm", 1).cast("long").alias("row_id"), "profile_url", F.col("at").cast("int").alias("at"), "name", "title")


_HEAD = q.clean_intro(q.html_to_text(_V["name"] + " || chr(32) || " + _V["title"]))
_BESIDE = f"CASE WHEN title <> '' THEN replace({q.norm_ws('h')}, title, ' ') ELSE {q.norm_ws('h')} END"


@query(
    f"WITH t AS MATERIALIZED (SELECT row_id AS id, {_HEAD} AS s, {q.clean_intro(q.html_to_text('intro'))} AS b FROM template_rows), {q.ALIASES}, n AS MATERIALIZED (SELECT id, {q.norm_ws('s')} AS s, s AS h, b FROM t), {q.occurrences('n')}, {q.first_rank('occ')}, "
    f"k AS (SELECT n.id, n.h, n.b, {q.normal_title('n.s', 'f.title')} AS title FROM n LEFT JOIN first_rank f ON f.id = n.id) "
    f"SELECT id AS row_id, {q.clean_name(q.strip(q.sub(_BESIDE, '(?:硕导|博导|博士生导师|硕士生导师)$')))} AS name, title, {q.clean_intro(q.sub(q.sub(q.norm_ws('b'), '邮箱\\s*[:：]?\\s*' + markup.EMAIL), '电子邮件\\s*[:：]?\\s*' + markup.EMAIL))} AS intro FROM k WHERE h <> ''"
)
def list_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards of listing pages: name, rank and text; items that are no cards are left out."""
    found = pages.list_cards(made(spark, sf_dir, CARDS).select("url", "html")).where(F.col("title") != "")
    return found.select(F.regexp_extract("url", r"/(\d+)\.htm", 1).cast("long").alias("row_id"), "name", "title", "intro")


_WIDGET = (
    f"concat('<script>var u_u7_title = [\"', {_PLAIN_NAME}, '\",\"more\"]; var u_u7_id = [\"', cast(row_id AS VARCHAR(20)), '\",\"0\"];var u_u7_summary = [\"教授\",\"\"];</script>', "
    "'<a href=\"/w/', cast(row_id AS VARCHAR(20)), '\" id=\"u_u7_', cast(row_id AS VARCHAR(20)), '_a\">x</a>')"
)


@query(
    f"SELECT row_id, {q.clean_name('n')} AS name, 'https://pages.test/w/' || row_id AS profile_url, '教授' AS title FROM (SELECT row_id, {_PLAIN_NAME} AS n FROM template_rows) WHERE {q.looks_like_name(q.clean_name('n'))}"
)
def list_widgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People listed in script arrays, with the hidden link of their number."""
    spark_widget = _WIDGET.replace(", '', 'g')", ", '')")
    found = pages.list_widgets(made(spark, sf_dir, spark_widget).select("url", "html"))
    return found.select(F.regexp_extract("url", r"/(\d+)\.htm", 1).cast("long").alias("row_id"), "name", "profile_url", "title")


_IMAGES = "concat('<img src=\"/a/', cast(row_id AS VARCHAR(20)), '.png\"><img alt=\"\" src=\"//cdn.test/b.png\"><img src=\"c.png\"><img src=\"/a/', cast(row_id AS VARCHAR(20)), '.png\">')"


@query("SELECT row_id, unnest(['https://pages.test/a/' || row_id || '.png', 'https://cdn.test/b.png', 'https://pages.test/p/c.png']) AS image FROM template_rows")
def page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct images of a page, resolved against it."""
    return made(spark, sf_dir, _IMAGES).select("row_id", F.explode(url.image_urls("html", "url")).alias("image"))


_CODED = f"concat('<b>', {_V['title']}, '</b><span _tsites_encrypt_field=\"_tsites_encrypt_field\" id=\"f1\" style=\"display:none;\">', reverse({_V['email']}), '</span><i>', {_V['name']}, '</i>')"


@query(
    f"SELECT row_id, '<b>' || {_V['title']} || '</b>' || CASE WHEN {q.norm_ws('reverse(' + _V['email'] + ')')} = '' THEN '<span _tsites_encrypt_field=\"_tsites_encrypt_field\" id=\"f1\" style=\"display:none;\">' || reverse({_V['email']}) || '</span>' "
    f"ELSE '<span  id=\"f1\" >' || reverse({q.norm_ws('reverse(' + _V['email'] + ')')}) || '</span>' END || '<i>' || {_V['name']} || '</i>' AS html FROM template_rows WHERE NOT contains({_V['email']}, '<') AND NOT contains({_V['title']}, '<span')"
)
def pages_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encrypted spans shown as what a decoder makes of them; here one that turns them round."""
    given = made(spark, sf_dir, _CODED, f"NOT contains({_V['email']}, '<') AND NOT contains({_V['title']}, '<span')")
    return pages.decode_spans(given, lambda root, field, content: F.reverse(content)).select("row_id", "html")


_BEHIND = f"concat('职 称：', {_V['title']}, '，电话 1')"


def _label_value(i: int) -> str:
    v = q.norm_ws(q.sub(q.norm_ws(f"regexp_extract(s, {q.lit(markup.TITLE_LABELS[i])}, 1)"), "^(?:为|是)"))
    return q.norm_ws(q.sub(v, markup.NEXT_LABEL))


@query(
    f"WITH t AS MATERIALIZED (SELECT row_id AS id, {_label_value(0)} AS s FROM (SELECT row_id, {_BEHIND} AS s FROM template_rows)), {q.ALIASES}, {q.occurrences('t')}, {q.first_rank('occ')} "
    f"SELECT t.id AS row_id, coalesce({q.filled(q.by_level('t.s'))}, f.title, CASE WHEN contains(t.s, '教师') THEN '教师' END, {q.filled('regexp_extract(t.s, ' + q.lit(rules.SPECIFIC_TITLE) + ', 1)')}, {q.filled('left(regexp_split_to_array(t.s, ' + q.lit('[，,；;。/ ]') + ')[1], 20)')}, '') AS title FROM t LEFT JOIN first_rank f ON f.id = t.id"
)
def title_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rank behind a label."""
    return rows_of(spark, sf_dir).select("row_id", title.labelled(F.expr(_BEHIND)).alias("title"))


@query(
    f"SELECT row_id, NOT {q.any_of('t', rules.STRONG_TOKENS)} AND length(t) < 200 AS is_needed FROM (SELECT row_id, {q.norm_ws('intro')} AS t FROM template_rows)"
)
def page_needs_ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with an image and little text that tells nothing."""
    given = made(spark, sf_dir, "'<img src=\"/x.png\">'")
    return given.select("row_id", title.needs_ocr("html", "intro", url.image_urls("html", "url")).alias("is_needed"))


_RECORDS = (
    "SELECT row_id, CASE WHEN row_id % 5 = 0 THEN '' ELSE profile_url END AS profile_url, CASE WHEN row_id % 7 = 0 THEN NULL ELSE {url} END AS page_url FROM template_rows"
)


def _page_records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Records of all rows, some without URL and some whose page was not captured; of the given fields every third rank and address is blank."""
    given = made(spark, sf_dir, PAGE)
    blank = lambda c, n: F.when(F.col("row_id") % n == 0, F.lit("")).otherwise(F.coalesce(c, F.lit(""))).alias(c)
    records = given.select(
        F.col("row_id").alias("ord"), "name", F.when(F.col("row_id") % 5 == 0, F.lit("")).otherwise(F.concat("url", F.lit("#a"))).alias("profile_url"),
        "school", "college", blank("title", 3), blank("email", 4), "intro",
    )
    return records, given.where("row_id % 7 <> 0").select("url", "html")


@query()
def page_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with blank fields filled from their page; those without URL or page pass through."""
    return enrich.enriched(*_page_records(spark, sf_dir)).select("ord", "name", "school", "college", "title", "email", "intro", "found")


@query(
    f"SELECT row_id AS ord, row_id % 5 <> 0 AND row_id % 7 <> 0 AS found, CASE WHEN row_id % 4 <> 0 OR row_id % 5 = 0 OR row_id % 7 = 0 THEN CASE WHEN row_id % 5 <> 0 AND row_id % 7 <> 0 THEN {q.norm_ws('email')} WHEN row_id % 4 = 0 THEN '' ELSE {_V['email']} END END AS email "
    f"FROM template_rows WHERE NOT (row_id % 4 = 0 AND row_id % 5 <> 0 AND row_id % 7 <> 0) AND {q.norm_ws('email')} <> ''"
)
def page_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given addresses are kept whatever the page says, and only those of pages are found."""
    done = page_enriched(spark, sf_dir).where("NOT (ord % 4 = 0 AND ord % 5 <> 0 AND ord % 7 <> 0)")
    given = rows_of(spark, sf_dir).where(text.norm_ws("email") != "").select(F.col("row_id").alias("ord"))
    return done.join(given, "ord").select("ord", "found", "email")


@query(
    "SELECT 'warn' AS severity, count(*) AS n FROM template_rows WHERE row_id % 5 = 0 HAVING count(*) > 0 UNION ALL SELECT 'error', count(*) FROM template_rows WHERE row_id % 5 <> 0 AND row_id % 7 = 0 HAVING count(*) > 0"
)
def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of records without URL and of pages that were not captured."""
    log = enrich.enrichment_log(checkpointed(enrich.enriched(*_page_records(spark, sf_dir))))
    return log.where("severity <> 'info'").groupBy("severity").agg(F.count("*").alias("n"))


@query(
    f"SELECT row_id, s AS school, {q.extract_college('t', 's')} AS college FROM (SELECT row_id, t, {q.extract_school('t')} AS s FROM (SELECT row_id, {q.clean_intro(q.html_to_text(_V['school'] + ' || ' + q.lit('-') + ' || ' + _V['college']))} AS t FROM template_rows))"
)
def page_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    """School and college by the title of a page."""
    html = f"concat('<title>', {_V['school']}, '-', {_V['college']}, '</title>')"
    found = made(spark, sf_dir, html).select("row_id", org.org_of_page("url", "html").alias("o"))
    return found.select("row_id", "o.school", "o.college")


_BLOCK = f"concat('<p>x</p><div class=\"c\" id=\"vsb_content\"><p>', {_V['intro']}, '</p></div><div>', {_V['name']}, '</div>')"


@query(f"SELECT row_id, CASE WHEN contains({_V['intro']}, '</div') THEN '' ELSE {q.html_to_text(chr(39) + '<p>' + chr(39) + ' || ' + _V['intro'] + ' || ' + chr(39) + '</p></div>' + chr(39))} END AS content FROM template_rows")
def page_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of a page's marked content."""
    given = made(spark, sf_dir, _BLOCK).select("row_id", "intro", text.html_to_text(text.content_block("html")).alias("content"))
    return given.select("row_id", F.when(F.coalesce("intro", F.lit("")).contains("</div"), "").otherwise(F.col("content")).alias("content"))


_LIGHT = f"concat('<p>', {_V['name']}, '</p><p>职称：', {_V['title']}, '</p><p>', {_V['email']}, '</p>')"


@query(
    f"SELECT row_id, {q.first_of('regexp_extract_all(' + q.undisguise(_LIGHT) + ', ' + q.lit(simple.EMAIL) + ')')} AS email, coalesce({q.sub(q.strip(q.sub(q.sub('translate(' + _V['name'] + ', chr(160) || chr(12288) || chr(9) || chr(13), ' + q.lit('   ') + ' || chr(10))', ' +', ' '), chr(10) + '{3,}', chr(10) + chr(10))), '(?:' + simple.NAME_WORDS + ')$')}, '') AS name FROM template_rows"
)
def light_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The light profile: the first address that is no stand-in, and the name without a rank behind it."""
    given = made(spark, sf_dir, _LIGHT)
    return given.select("row_id", simple.extract_email("html", "html", F.lit("")).alias("email"), simple.clean_name("name").alias("name"))
