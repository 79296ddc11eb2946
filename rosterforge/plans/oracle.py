"""DuckDB SQL of the expressions, built from the same fixed values. RE2 has no look-around, so those steps are written out."""

from __future__ import annotations

from ..functions import markup, rules

SPACE = r"\x09-\x0d\x1c-\x20\x85\p{Z}"
HAN = r"\x{4e00}-\x{9fa5}"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {by if by.startswith('chr(') else lit(by)}, 'g')"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {lit(pattern)})"


def any_of(x: str, tokens: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({x}, {lit(t)})" for t in tokens) + ")"


def text_of(x: str) -> str:
    return f"coalesce(cast({x} AS VARCHAR), '')"


def strip(x: str) -> str:
    return sub(x, rf"^[{SPACE}]+|[{SPACE}]+$")


def unescape(x: str) -> str:
    out = text_of(x)
    for entity, sign in rules.ENTITIES:
        by = "chr(160)" if entity == "&nbsp;" else lit(sign)
        out = f"replace({out}, {lit(entity)}, {by})"
    return out


def squeeze(x: str) -> str:
    return strip(f"regexp_replace({sub(x, ' +', ' ')}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


def norm_ws(x: str) -> str:
    out = f"replace(replace({unescape(x)}, chr(65279), ''), 'ï»¿', '')"
    return squeeze(f"translate({out}, chr(160) || chr(12288) || chr(9) || chr(13), '   ' || chr(10))")


def person_name(x: str) -> str:
    out = norm_ws(x)
    for _ in range(2):
        out = sub(out, rf"([{HAN}])[{SPACE}]+([{HAN}])", r"\1\2")
    return out


def html_to_text(x: str) -> str:
    out = text_of(x)
    for pattern, by in ((r"(?i)<script[\s\S]*?</script>", " "), (r"(?i)<style[\s\S]*?</style>", " "), (r"(?i)<br\s*/?>", "chr(10)"), ("(?i)</p>", "chr(10)"), ("<[^>]+>", " ")):
        out = sub(out, pattern, by)
    return squeeze(unescape(out))


def clean_intro(x: str) -> str:
    return sub(norm_ws(x), r"(?i)^View\s+(?:English|Chinese)\s+CV\s*")


def truncate(x: str, most: int) -> str:
    t = clean_intro(x)
    return f"CASE WHEN length({t}) > {most} THEN left({t}, {most}) || '...' ELSE {t} END"


def compact(x: str) -> str:
    return sub(norm_ws(x), rf"[{SPACE}]*\n[{SPACE}]*", " ")


def is_valid_intro(x: str) -> str:
    t = clean_intro(x)
    bad = " OR ".join(f"starts_with({t}, {lit(p)})" for p in rules.BAD_INTRO_PREFIXES)
    contacts = " + ".join(f"cast(contains({t}, {lit(c)}) AS INT)" for c in rules.CONTACT_TOKENS)
    return f"(length({t}) >= 8 AND NOT ({bad}) AND ({contacts}) < 2)"


def clean_name(x: str) -> str:
    prefix = rf"^(?:{'|'.join(rules.NAME_PREFIXES)})[{SPACE}]*[-—－]?[{SPACE}]*"
    ranks = "|".join(rules.NAME_RANK_WORDS)
    out = sub(norm_ws(x), r"[（(][^（）()]{1,30}[）)]")
    out = sub(out, rf"(?:{'|'.join(rules.NAME_PROFILE_WORDS)})$")
    for last in (True, False):
        out = sub(sub(out, prefix), rf"(?:{ranks})$")
        for _ in range(2):
            out = sub(out, rf"(^|[{SPACE}])(?:{ranks})($|[{SPACE}])", r"\1\2")
        if last:
            out = sub(out, "项目$")
    return person_name(strip(sub(out, " +", " ")))


def looks_like_url(x: str) -> str:
    return has(f"lower({norm_ws(x)})", "^https?://")


def looks_like_name(x: str) -> str:
    return f"({has(person_name(x), f'^[{HAN}·]{{2,10}}$')})"


_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)"


def url_part(x: str, i: int) -> str:
    return f"regexp_extract({text_of(x)}, {lit(_SPLIT)}, {i})"


def profile_key(x: str) -> str:
    u = norm_ws(x)
    p = url_part(u, 3)
    for _ in range(2):
        p = sub(p, r"(?i)/(?:zh_CN|en|en_US|cn)(/|$)", r"\1")
    return f"lower({url_part(u, 2)}) || lower({sub(sub(p, r'(?i)/index[.]html?$'), '/+$')})"


def ends(x: str, suffixes: tuple[str, ...]) -> str:
    return has(x, f"(?:{'|'.join(suffixes)})$")


def looks_like_school(x: str) -> str:
    n = norm_ws(x)
    return f"(length({n}) >= 4 AND {ends(n, rules.SCHOOL_SUFFIXES)} AND NOT contains({n}, '系'))"


def looks_like_college(x: str) -> str:
    n = norm_ws(x)
    return f"(length({n}) >= 2 AND {ends(n, rules.COLLEGE_SUFFIXES)})"


def placeholder(x: str, suffixes: tuple[str, ...]) -> str:
    n = f"replace(lower({norm_ws(x)}), ' ', '')"
    return f"({n} = '' OR {has(n, f'^x{{2,}}(?:' + '|'.join(suffixes) + ')$')})"


def placeholder_school(x: str) -> str:
    return placeholder(x, rules.SCHOOL_SUFFIXES)


def placeholder_college(x: str) -> str:
    return placeholder(x, rules.PLACEHOLDER_COLLEGE_SUFFIXES)


def valid_title(x: str) -> str:
    t = norm_ws(x)
    return f"({has(t, f'[{HAN}A-Za-z]')} AND {t} NOT IN ({', '.join(map(lit, rules.INVALID_TITLES))}))"


def is_valid_row(alias: str = "") -> str:
    return "(" + " AND ".join(f"{norm_ws(alias + c)} <> ''" for c in rules.REQUIRED) + ")"


#: Normalised columns of template_rows under their own names; what the longer oracles start from.
ROWS = "SELECT row_id, run_id, " + ", ".join(f"{norm_ws(c)} AS {c}" for c in rules.COLUMNS) + f", {clean_name('name')} AS cname FROM template_rows"

IDENTITY = (
    "CASE WHEN profile_url <> '' THEN 'url' WHEN email <> '' THEN 'email' WHEN cname <> '' THEN 'name' ELSE 'fallback' END AS kind, "
    "CASE WHEN profile_url <> '' THEN lower(profile_url) WHEN email <> '' THEN school WHEN cname <> '' THEN school ELSE cname END AS a, "
    "CASE WHEN profile_url <> '' THEN '' WHEN email <> '' THEN lower(email) WHEN cname <> '' THEN cname ELSE school END AS b, "
    "CASE WHEN profile_url <> '' OR email <> '' OR cname <> '' THEN '' ELSE college END AS c"
)

NAME_QUALITY = (
    f"CASE WHEN cname = '' OR {any_of('cname', rules.NAME_NOISE)} THEN 0 WHEN {has('cname', f'^[{HAN}·]{{2,10}}$')} THEN 2 "
    f"WHEN {has('cname', f'[{HAN}]')} THEN 1 ELSE 0 END"
)

QUALITY = {
    "school": f"cast({looks_like_school('school')} AND NOT {placeholder_school('school')} AS INT)",
    "college": f"cast({looks_like_college('college')} AND NOT {placeholder_college('college')} AS INT)",
    "filled": " + ".join(f"cast({c} <> '' AS INT)" for c in rules.REQUIRED),
    "name_in_intro": f"cast(cname <> '' AND contains({person_name('intro')}, cname) AS INT)",
    "name_clean": "cast(cname <> '' AND cname = name AS INT)",
    "name_quality": NAME_QUALITY,
    "title": f"cast({valid_title('title')} AS INT)",
    "email": "cast(email <> '' AS INT)",
    "intro": "least(length(intro), 200)",
}


# --- names, ranks, organisations, addresses of texts -------------------------------------------------------------


def first_of(items: str) -> str:
    return f"coalesce(({items})[1], '')"


def filled(x: str) -> str:
    return f"nullif({x}, '')"


def name_candidate(x: str) -> str:
    runs = f"list_transform(regexp_extract_all({norm_ws(x)}, '[{HAN}·]{{2,10}}'), lambda r: {clean_name('r')})"
    return first_of(f"list_filter({runs}, lambda n: {has('n', f'^[{HAN}·]{{2,10}}$')} AND NOT {any_of('n', rules.NAME_NOISE)})")


def path_stem(x: str) -> str:
    last = f"regexp_extract({sub(url_part(x, 3), '/+$')}, '([^/]*)$', 1)"
    return f"regexp_replace({last}, '(.)[.][^.]*$', '\\1')"


def collapse(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} = {lit(a)} THEN {lit(b)}" for a, b in rules.COLLAPSED_TITLES.items()) + f" ELSE {x} END"


ALIASES = "aliases(title, alias, priority) AS (VALUES " + ", ".join(
    f"({lit(t)}, {lit(a)}, {i})" for i, (t, english) in enumerate(rules.TITLES.items()) for a in (t, *english)
) + ")"


def occurrences(source: str, name: str = "occ") -> str:
    """A CTE ``id, title, priority, start, stop`` of every rank in a relation of ``id, s``, found by comparing each place with each spelling."""
    outside = lambda c: f"NOT regexp_matches({c}, '[\\p{{L}}\\p{{N}}_]')"
    return f"""{name} AS (SELECT DISTINCT id, title, priority, i AS start, i + length(alias) AS stop
  FROM (SELECT id, s, title, alias, priority, unnest(range(0, length(s) - length(alias) + 1)) AS i FROM {source} JOIN aliases ON contains(lower(s), alias))
  WHERE lower(substr(s, i + 1, length(alias))) = alias
    AND (NOT regexp_matches(alias, '^[a-z ]+$') OR ((i = 0 OR {outside('substr(s, i, 1)')}) AND {outside('substr(s, i + 1 + length(alias), 1)')})))"""


def first_rank(occ: str, name: str = "first_rank") -> str:
    """A CTE ``id, title`` of the first rank other than the bare word for a teacher."""
    return f"{name} AS (SELECT id, arg_min(title, (start, priority, start - stop)) AS title FROM {occ} WHERE title NOT IN ({', '.join(map(lit, rules.INVALID_TITLES))}) GROUP BY id)"


def normal_title(t: str, first: str) -> str:
    """The normal form of a rank ``t`` (normalised) whose first known rank is ``first``."""
    specific = f"regexp_extract({t}, {lit(rules.SPECIFIC_TITLE)}, 1)"
    return f"coalesce({filled(collapse(specific))}, {filled(collapse(first))}, CASE WHEN contains({t}, '教师') THEN '教师' END, {collapse(t)})"


def of_name(x: str) -> str:
    t = norm_ws(x)
    return f"CASE WHEN contains({t}, '副教授') THEN '副教授' WHEN contains({t}, '讲师') THEN '讲师' WHEN contains({t}, '教授') THEN '教授' ELSE '' END"


def by_level(x: str) -> str:
    return f"CASE WHEN {has(x, rules.FULL_LEVEL)} THEN '教授' WHEN {has(x, rules.ASSOCIATE_LEVEL)} THEN '副教授' ELSE '' END"


def context_of(text: str, name: str, before: int = 20, after: int = 400) -> str:
    """``text`` must be stripped and ``name`` cleaned."""
    at = f"instr({text}, {name})"
    start = f"greatest({at} - {before}, 1)"
    return f"CASE WHEN {text} <> '' AND {name} <> '' AND {at} > 0 THEN substr({text}, {start}, {at} + length({name}) + {after} - {start}) ELSE '' END"


def org_name(x: str) -> str:
    out = sub(sub(text_of(x), "[（(].*?[）)]"), rf"[{SPACE}]+")
    return f"trim({sub(out, '^[-_ ]+|[-_ ]+$')}, ' ')"


def extract_school(x: str) -> str:
    signs = r"[\x{4e00}-\x{9fa5}A-Za-z0-9·（）()]+"
    found = " || ".join(f"regexp_extract_all({text_of(x)}, {lit(f'({signs}?{s})|{signs}')}, 1)" for s in rules.SCHOOL_SUFFIXES)
    usable = f"list_filter(list_transform({found}, lambda f: {org_name('f')}), lambda f: {looks_like_school('f')})"
    return f"coalesce(list_sort(list_transform({usable}, lambda f, i: {{'a': -length(f), 'i': i, 'f': f}}))[1].f, '')"


def extract_college(x: str, school: str) -> str:
    parts = f"list_filter(list_transform(regexp_split_to_array({text_of(x)}, '[-_]'), lambda p: {org_name('p')}), lambda p: p <> '')"
    bare = f"list_transform({parts}, lambda p: CASE WHEN {school} <> '' AND starts_with(p, {school}) THEN substr(p, length({school}) + 1) ELSE p END)"
    good = f"list_filter({bare}, lambda p: {looks_like_college('p')})"
    return f"coalesce(list_filter({good}, lambda p: regexp_matches(p, '(?:学院|研究院)$'))[1], ({good})[1], '')"


def clean_stem(x: str) -> str:
    out = text_of(x)
    for w in rules.STEM_NOISE:
        out = f"replace({out}, {lit(w)}, '')"
    return sub(sub(sub(out, r"\(\d+\)$"), "[-_]+", "-"), "^[- ]+|[- ]+$")


def undisguise(x: str) -> str:
    tld = r"(?:com|cn|edu|net|org|gov)"
    out = text_of(x)
    for pattern, by in ((r"(?i)\[at\]|\(at\)|（at）", "@"), (r"(?i)\[dot\]|\(dot\)|（dot）", "."), ("&#64;|＠", "@"), ("。", ".")):
        out = sub(out, pattern, by)
    for _ in range(2):
        out = sub(out, rf"(?i)([A-Za-z0-9._%+-])[{SPACE}]*[#＃][{SPACE}]*([A-Za-z0-9.-]+\.{tld})([^A-Za-z0-9_]|$)", r"\1@\2\3")
    out = sub(sub(out, rf"[{SPACE}]*@[{SPACE}]*", "@"), rf"[{SPACE}]*\.[{SPACE}]*", ".")
    for _ in range(2):
        out = sub(out, rf"([\pL\p{{Nd}}\pM_])[{SPACE}]+([A-Za-z0-9._%+-]+@)", r"\1\2")
    return sub(out, "(?i)mailto:")


def trimmed_email(x: str) -> str:
    marks = r"[.,;:，。；：()\[\]{}<>]+"
    return sub(sub(norm_ws(x), f"^{marks}|{marks}$"), r"^[^\pL\p{Nd}\pM]+([A-Za-z0-9])", r"\1")


def email_candidates(source: str, name: str = "candidates") -> str:
    """CTEs down to ``id, k, email, score`` of a relation of ``id, k, s, bonus``: the first occurrence of every address, scored by what surrounds it."""
    near = {k: any_of("w", v) for k, v in rules.AROUND.items()}
    local = f"lower(split_part(email, {lit('@')}, 1))"
    public = f"({local} IN ({', '.join(map(lit, rules.PUBLIC_MAILBOXES))}) OR {any_of(local, rules.PUBLIC_MAILBOX_PARTS)})"
    weigh = lambda c, n: f"CASE WHEN {c} THEN {n} ELSE 0 END"
    own, loose = f"({near['label']} AND NOT public)", f"(NOT {near['section']} AND NOT ({near['label']} AND NOT public))"
    terms = [
        weigh(near["label"], 30), weigh(own, 50), weigh(near["profile"], 15), weigh(near["complaint"], -80), weigh(near["section"], 45),
        weigh(f"{near['footer']} AND {near['footer_contact']}", -180), weigh(f"{near['footer']} AND {loose}", -50), weigh("contains(w, '地址：') AND contains(w, '电话')", -40),
        f"CASE WHEN place <= 0.45 THEN 15 WHEN place >= 0.82 AND {loose} THEN -80 WHEN place >= 0.70 AND {loose} THEN -35 ELSE 0 END", weigh("public", -50),
    ]
    mail = lit(markup.EMAIL)
    return f"""
{name}_m AS (SELECT id, k, s, bonus, unnest(regexp_extract_all(s, {mail})) AS found, unnest(regexp_split_to_array(s, {mail})[:-2]) AS gap, unnest(range(len(regexp_extract_all(s, {mail})))) AS n FROM {source} WHERE contains(s, '@')),
{name}_o AS (SELECT *, cast(sum(length(gap) + length(found)) OVER (PARTITION BY id, k, s, bonus ORDER BY n) AS BIGINT) AS stop, {trimmed_email('found')} AS email FROM {name}_m),
{name}_f AS (SELECT *, stop - length(found) AS start, row_number() OVER (PARTITION BY id, k, s, bonus, lower(email) ORDER BY n) AS nth FROM {name}_o WHERE email <> ''),
{name}_w AS (SELECT *, substr(s, greatest(start - 200, 0) + 1, least(length(s), stop + 200) - greatest(start - 200, 0)) AS w, start / greatest(length(s), 1) AS place, {public} AS public FROM {name}_f WHERE nth = 1),
{name} AS (SELECT id, k, email, cast(10 + bonus + {' + '.join(terms)} AS INT) AS score FROM {name}_w)"""


def best_email(candidates: str, name: str, least: int = 1) -> str:
    """A CTE ``id, email`` of the highest score, then the greatest address, if the score is enough."""
    return f"{name} AS (SELECT id, CASE WHEN max(score) >= {least} THEN arg_max(lower(email), (score, lower(email))) ELSE '' END AS email FROM {candidates} GROUP BY id)"


def resolve_root(x: str) -> str:
    """``scheme://host`` of a URL that has both."""
    return f"lower({url_part(x, 1)}) || '://' || {url_part(x, 2)}"


# --- seeds and upserts -------------------------------------------------------------------------------------------

#: Usable records of seed files with their values under the header keys of the file: ``file_id, ord, keys, vals``.
SEED_CELLS = f"""
v AS MATERIALIZED (SELECT file_id, line_id, record, json_keys(record) AS ks FROM seed_lines WHERE json_valid(record) AND json_type(record) = 'OBJECT' AND len(json_keys(record)) > 0),
h AS (SELECT file_id, arg_min(ks, line_id) AS keys FROM v GROUP BY file_id),
c AS MATERIALIZED (SELECT v.file_id, row_number() OVER (PARTITION BY v.file_id ORDER BY line_id) - 1 AS ord, h.keys,
  list_transform(h.keys || list_filter(v.ks, lambda k: NOT list_contains(h.keys, k)), lambda k: {norm_ws("json_extract_string(v.record, '$." + chr(34) + "' || k || '" + chr(34) + "')")}) AS vals FROM v JOIN h ON h.file_id = v.file_id)"""
KNOWN_HEADERS = "a(header, field) AS (VALUES " + ", ".join(
    f"({lit(a.lower())}, {lit(f)})" for f, aliases in rules.HEADER_ALIASES.items() for a in aliases if a.lower() not in rules.PLACEHOLDER_HEADERS
) + ")"


def seed_columns() -> str:
    """CTEs down to ``cols``: the position of every field in every file, by header, by the looks of ten rows, by place."""
    of = {f: f"coalesce(min(n.pos) FILTER (n.field = {lit(f)}), -1)" for f in rules.HEADER_ALIASES}
    of["name"] = "coalesce(min(n.pos) FILTER (n.field = 'name'), any_value(i.name_at), CASE WHEN len(any_value(h.keys)) >= 1 THEN 0 END, -1)"
    of["profile_url"] = "coalesce(min(n.pos) FILTER (n.field = 'profile_url'), any_value(i.url_at), CASE WHEN len(any_value(h.keys)) >= 2 THEN 1 END, -1)"
    listed = ", ".join(f"cast({e} AS INT) AS {f}" for f, e in of.items())
    return f"""{SEED_CELLS}, {KNOWN_HEADERS},
k AS (SELECT file_id, unnest(keys) AS key, unnest(range(len(keys))) AS pos FROM h),
n AS (SELECT k.file_id, a.field, k.pos FROM k JOIN a ON {norm_ws('lower(k.key)')} = a.header),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY ord) AS nth FROM c WHERE len(list_filter(vals, lambda x: x <> '')) > 0) WHERE nth <= 10),
e AS (SELECT file_id, unnest(vals) AS x, unnest(range(len(vals))) AS pos FROM f),
s AS (SELECT file_id, pos, count(*) FILTER ({looks_like_name('x')}) AS names, count(*) FILTER ({looks_like_url('x')}) AS urls FROM e GROUP BY ALL),
i AS (SELECT file_id, arg_min(pos, (-names, pos)) FILTER (names > 0) AS name_at, arg_min(pos, (-urls, pos)) FILTER (urls > 0) AS url_at FROM s GROUP BY file_id),
cols AS (SELECT h.file_id, {listed} FROM h LEFT JOIN n ON n.file_id = h.file_id LEFT JOIN i ON i.file_id = h.file_id GROUP BY h.file_id)"""


def seed_records() -> str:
    """A record for every seed row, or for every address of a row with several."""
    at = lambda f: f"CASE WHEN cols.{f} >= 0 THEN coalesce(c.vals[cols.{f} + 1], '') ELSE '' END"
    urls = f"list_filter(c.vals, lambda x, i: {looks_like_url('x')} AND list_position(c.vals, x) = i)"
    fields = {f: "''" for f in rules.HEADER_ALIASES}
    by_url = ", ".join(f"{x if f == 'profile_url' else v} AS {f}" for (f, v), x in zip(fields.items(), ["u"] * len(fields)))
    single = ", ".join((f"coalesce({filled(at('title'))}, {of_name(at('name'))})" if f == "title" else at(f)) + f" AS {f}" for f in fields)
    return f"""WITH {seed_columns()}, r AS MATERIALIZED (SELECT c.*, {urls} AS urls FROM c)
SELECT c.file_id, c.ord, cast(0 AS INT) AS part, c.ord + 2 AS row_number, {single} FROM r c JOIN cols ON cols.file_id = c.file_id WHERE len(c.urls) < 2
UNION ALL SELECT file_id, ord, part, ord + 2, {by_url} FROM (SELECT file_id, ord, cast(unnest(range(len(urls))) AS INT) AS part, unnest(urls) AS u FROM r WHERE len(urls) >= 2)"""


def upserted(existing: str, new: str) -> str:
    """Two relations of ``ord`` and the template's columns, merged into the best row of every identity."""
    cols = rules.REQUIRED

    def sanitised(source: str, n: int) -> str:
        norm = ", ".join(f"{norm_ws(c)} AS {c}" for c in cols)
        kept = ", ".join("t.cname AS name" if c == "name" else f"CASE WHEN x.email IS NULL THEN t.email ELSE '' END AS email" if c == "email" else f"t.{c}" for c in cols)
        valid = " AND ".join(f"{c} <> ''" for c in cols)
        return f"""n{n} AS MATERIALIZED (SELECT ord, {norm}, {clean_name('name')} AS cname FROM {source}),
x{n} AS (SELECT school, college, lower(email) AS email FROM n{n} WHERE school <> '' AND college <> '' AND email <> '' AND cname <> '' GROUP BY ALL HAVING count(DISTINCT cname) >= 2),
s{n} AS MATERIALIZED (SELECT * FROM (SELECT t.ord, {kept} FROM n{n} t LEFT JOIN x{n} x ON x.school = t.school AND x.college = t.college AND x.email = lower(t.email)) WHERE {valid})"""

    columns = ", ".join(cols)
    norm = ", ".join(f"{norm_ws(c)} AS {c}" for c in cols)
    order = ", ".join(f"{e} DESC" for e in QUALITY.values())
    return f"""WITH old AS (SELECT ord, {columns} FROM {existing}), late AS (SELECT ord + (SELECT coalesce(max(ord), -1) + 1 FROM old) AS ord, {columns} FROM {new}),
both_rows AS (SELECT * FROM old UNION ALL SELECT * FROM late), {sanitised('both_rows', 1)},
w AS MATERIALIZED (SELECT ord, {norm}, {clean_name('name')} AS cname FROM s1), i AS (SELECT *, {IDENTITY} FROM w),
b AS (SELECT ord, min(ord) OVER (PARTITION BY kind, a, b, c) AS first_ord, row_number() OVER (PARTITION BY kind, a, b, c ORDER BY {order}, ord) AS nth FROM i),
m AS (SELECT b.first_ord AS ord, {', '.join('s1.' + c for c in cols)} FROM b JOIN s1 ON s1.ord = b.ord WHERE nth = 1), {sanitised('m', 2)}
SELECT ord, {columns}, row_number() OVER (ORDER BY ord) AS seq FROM s2"""
