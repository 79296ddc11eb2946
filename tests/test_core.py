import html
import itertools
import json
import random

from pyspark.sql import functions as F

from rosterforge.functions import email, names, org, rules, simple, text, title, url
from rosterforge.operators import drift, enrich, merge, pages, report, seeds
from rosterforge.operators.assignment import best_matching
from rosterforge.operators.common import components, numbered
from rosterforge.plans import pipeline
from rosterforge.plans import queries as registered


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


# --- expressions -----------------------------------------------------------------------------------------------


def test_text(spark):
    assert one(spark, text.norm_ws("a"), a="﻿ a\xa0\xa0b　c\td &amp;lt; ") == "a b c d &lt;"
    assert one(spark, text.norm_ws("a"), a=None) == ""
    assert one(spark, text.person_name("a"), a="张 三 丰") == "张三丰"
    page = "<style>x</style><script>var t='</p>'</script><p>a&nbsp;b</p><br/>c<b>d</b>"
    assert one(spark, text.html_to_text("a"), a=page) == "a\xa0b\n\nc d"
    assert one(spark, text.truncate("a", 3), a="View English CV abcdef") == "abc..."
    assert one(spark, text.unescape_all("a"), a="&eacute;&#20013;") == html.unescape("&eacute;&#20013;")
    section = '<span id="t1"> 个人简介 </span><div class="nr" id="n1"><p>长期从事海流模拟方面的研究</p></div><!--ckendn1-->'
    assert one(spark, text.page_intro("a", F.lit("")), a=section) == "长期从事海流模拟方面的研究"
    assert one(spark, text.page_intro("a", "b"), a="", b="首页\n" + "长期从事海流模拟方面的教学和研究工作二十年") == "长期从事海流模拟方面的教学和研究工作二十年"


def test_offsets_equal_python(spark):
    import re

    random.seed(7)
    for _ in range(20):
        s = "".join(random.choice("ab教授😀 ") for _ in range(random.randint(0, 40)))
        got = [(m["start"], m["end"], m["found"]) for m in one(spark, text.matches_with_offsets(F.col("a"), "教授|ab"), a=s)]
        assert got == [(m.start(), m.end(), m.group()) for m in re.finditer("教授|ab", s)]


def test_names(spark):
    for raw, clean in {"张三（教授）": "张三", "副教授 李 四": "李四", "王五个人简介": "王五", "赵六 博导": "赵六", "教授-钱七": "钱七", "": ""}.items():
        assert one(spark, names.clean_name("a"), a=raw) == clean, raw
    assert one(spark, names.looks_like_name("a"), a="买买·艾力") and not one(spark, names.looks_like_name("a"), a="http://张三")
    assert [one(spark, names.name_quality("a"), a=x) for x in ("张三", "张三abc", "Ann", "学院主页")] == [2, 1, 0, 0]
    assert one(spark, names.name_of_page("a", "b"), a="<title>张三--某学院</title>", b="http://x/1.htm") == "张三"


def test_urls(spark):
    assert one(spark, url.profile_key("a"), a="HTTPS://X.cn/zh_CN/Ab/index.htm?q#f") == "x.cn/ab"
    assert one(spark, url.site_root("a"), a="https://x.cn/a") == "https://x.cn" and one(spark, url.site_root("a"), a="/a") == ""
    for link in ("/b", "//y.cn/b", "http://y.cn", "c.htm", "#f", ""):
        native = one(spark, url.resolve("a", "b"), a="https://x.cn/d/e.htm", b=link)
        assert native == one(spark, url.resolve_all("a", "b"), a="https://x.cn/d/e.htm", b=link), link
    assert one(spark, url.image_urls("a", "b"), a='<img src="//y/1.png"><img src="/2.png"><img src="/2.png">', b="https://x.cn/p") == ["https://y/1.png", "https://x.cn/2.png"]


def test_organisations(spark):
    assert one(spark, org.extract_school("a"), a="甲大学-乙丙丁大学（东区）") == "乙丙丁大学"
    assert one(spark, org.extract_college("a", "b"), a="甲大学物理系-甲大学数学学院", b="甲大学") == "数学学院"
    assert one(spark, org.is_placeholder_school("a"), a="XX 大学") and one(spark, org.is_placeholder_college("a"), a=None)
    assert one(spark, org.school_by_domain("a"), a="http://gr.xidian.edu.cn/x") == "西安电子科技大学"
    assert one(spark, org.school_by_domain("a"), a="http://notxidian.edu.cn/x") == ""
    assert one(spark, org.clean_stem("a"), a="甲大学__教师列表(2)") == "甲大学"


def test_organisations_anywhere_in_a_text(spark, tmp_path):
    far = "，" + "研究海流模拟。" * 60
    rows = {
        1: (f"简介{far}毕业于甲乙丙大学，\n任教至今", "毕业于甲乙丙大学", ""),
        2: (f"甲大学校友{far}甲乙丙丁大学。-物理系-数学学院", "甲乙丙丁大学", "数学学院"),
        3: ("某" * 100_000 + "大学，" + "某" * 100_000 + "，甲乙丙大学", "某" * 100_000 + "大学", ""),
        4: ("某" * 100_000, "", ""),
        5: (None, "", ""),
    }
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in rows.items()], "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["school"], r["college"]) for r in registered.org_in_text(spark, str(tmp_path)).collect()}
    assert got == {i: (school, college) for i, (_, school, college) in rows.items()}


def test_mail(spark):
    assert one(spark, email.undisguise("a"), a="a [at] b (dot) cn。x") == "a@b.cn.x"
    page, body = "", "邮箱：zhang@x.edu.cn 联系电话 123"
    assert one(spark, email.extract("a", "b", "b"), a=page, b=body) == "zhang@x.edu.cn"
    footer = "正文" * 300 + " 版权所有 地址：甲 电话：1 office@x.edu.cn"
    assert one(spark, email.extract("a", "b", F.lit("")), a="", b=footer) == ""
    assert one(spark, email.addresses("a"), a="A@x.cn; a@X.cn b@y.com") == ["A@x.cn", "b@y.com"]
    assert one(spark, email.first_usable(email.addresses("a")), a="a@example.com b@y.com") == "b@y.com"
    assert one(spark, email.masked("a"), a="Ann@X.cn").endswith("@x.cn")


def test_ranks(spark):
    for raw, normal in {"特聘教授": "教授", "Associate Professor": "副教授", "professorial": "professorial", "科研副教授": "科研副教授", "讲师（校聘）": "讲师", "": ""}.items():
        assert one(spark, title.normalise("a"), a=raw) == normal, raw
    assert one(spark, title.labelled("a"), a="职称：三级教授 电话 1") == "教授" and one(spark, title.labelled("a"), a="职称：六级") == "六级"
    assert one(spark, title.near_name("a", "b"), a="李四 教授" + "。" * 60 + "张三 讲师", b="张三") == "讲师"
    assert one(spark, title.extract("a", "b", "c"), a="工程师", b="", c="张三") == "工程师"
    assert one(spark, title.context_of("a", "b"), a="x" * 50 + "张三" + "y" * 500, b="张三") == "x" * 20 + "张三" + "y" * 400


def test_light_profile(spark):
    assert one(spark, simple.extract_email("a", "a", "a"), a="x@y.io") == "x@y.io"
    assert one(spark, simple.clean_name("a"), a="张三教授") == "张三"
    assert one(spark, simple.extract_title("a", F.lit("")), a="职称：副教授") == "副教授"
    assert one(spark, simple.clamp("a", 1, 20), a="99") == 20


# --- operators -------------------------------------------------------------------------------------------------


def test_matching_against_brute_force():
    random.seed(8)
    for _ in range(200):
        r, c = random.randint(1, 4), random.randint(1, 4)
        w = [[random.choice([0, 1, 2, 5]) for _ in range(c)] for _ in range(r)]
        got = sum(w[i][j] for i, j in best_matching(w, 1))
        small, large = (range(r), range(c)) if r <= c else (range(c), range(r))
        at = (lambda i, j: w[i][j]) if r <= c else (lambda i, j: w[j][i])
        assert got == max(sum(at(i, j) for i, j in zip(small, p)) for p in itertools.permutations(large, len(small)))


def seed_tables(spark):
    files = [(1, "f", "2024-01-01"), (2, "f", "2024-02-01"), (3, "f", "2024-03-01"), (4, "g", "2024-01-01")]
    lines = [
        (1, 1, 2, '{"姓名": "张三", "url": "https://x.cn/1", "备注": "a"}'), (2, 1, 3, '{"姓名": null, "url": "https://x.cn/2", "备注": null}'), (3, 1, 4, '{"姓名": "'),
        (4, 2, 2, '{"url": ["https://x.cn/1"], "xm": "张三", "phone": 5}'), (5, 3, 2, '{"xm": {"text": "张三"}, "url": ["https://x.cn/1"], "phone": "5"}'), (6, 4, 2, "[1]"),
    ]
    return (
        spark.createDataFrame(files, "file_id long, feed_id string, file_date string"),
        spark.createDataFrame([(*x, "keep") for x in lines], "line_id long, file_id long, line_no long, record string, name string"),
    )


def test_drift(spark):
    files, lines = seed_tables(spark)
    got = {tuple(r) for r in drift.changes(files, lines).collect()}
    assert got == {
        (2, "name", "renamed"), (2, "profile_url", "retyped"), (2, "备注", "removed"), (2, "phone", "added"), (3, "name", "retyped"), (3, "phone", "retyped"),
    }
    table = {r["line_id"]: r for r in drift.unify(files, lines).collect()}
    assert set(table) == {1, 2, 4, 5} and table[5]["name"] == "张三" and table[4]["profile_url"] == "https://x.cn/1"
    assert drift.changes(files.limit(0), lines.limit(0)).count() == 0


def test_unknown_header_is_found_by_values(spark):
    files = spark.createDataFrame([(1, "f", "1"), (2, "f", "2")], "file_id long, feed_id string, file_date string")
    lines = [(i, 1, i, '{"url": "https://x.cn/%d"}' % i) for i in range(5)] + [(10 + i, 2, i, '{"wohin": "https://x.cn/%d"}' % i) for i in range(5)]
    df = spark.createDataFrame(lines, "line_id long, file_id long, line_no long, record string")
    assert [tuple(r) for r in drift.changes(files, df).collect()] == [(2, "profile_url", "renamed")]


def ragged(spark, rows):
    return spark.createDataFrame(rows, "source string, ord long, cells array<string>")


def test_seed_rows(spark):
    cells = ragged(spark, [
        ("f", -1, ["链接", "姓名", "院系"]), ("f", 0, ["http://x/1", "张三", "数学学院"]), ("f", 1, ["http://x/2", "http://x/3"]), ("f", 2, ["http://x/4", "李四", "http://x/4", "王五"]),
        ("g", -1, ["字段1", "字段2"]), ("g", 0, ["http://y/1", "赵六"]), ("g", 1, ["http://y/2", "钱七"]),
    ])
    rows = cells.where("ord >= 0")
    maps = {r["source"]: r["columns"] for r in seeds.header_map(cells.where("ord = -1"), rows).collect()}
    assert (maps["f"]["name"], maps["f"]["profile_url"], maps["f"]["college"], maps["f"]["email"]) == (1, 0, 2, -1)
    assert (maps["g"]["name"], maps["g"]["profile_url"]) == (1, 0)
    records = {(r["source"], r["ord"], r["part"]): (r["name"], r["profile_url"]) for r in seeds.expand(rows, seeds.header_map(cells.where("ord = -1"), rows)).collect()}
    assert records["f", 0, 0] == ("张三", "http://x/1") and records["f", 1, 1] == ("", "http://x/3")
    assert records["f", 2, 0] == ("李四", "http://x/4") and records["f", 2, 1] == ("王五", "http://x/4") and records["g", 1, 0] == ("钱七", "http://y/2")


def test_forward_fill_over_buckets(spark):
    random.seed(9)
    values = [random.choice([None, "", "xx大学", "甲乙大学", "丙丁大学"]) for _ in range(60)]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "g string, n long, school string")
    got = [r["school"] for r in seeds.fill_forward(df, "g", "n", "school", F.col("school").endswith("大学") & ~F.col("school").startswith("xx"), F.lit("-"), 7).orderBy("n").collect()]
    want, last = [], "-"
    for v in values:
        last = v if v in ("甲乙大学", "丙丁大学") else last
        want.append(last)
    assert got == want


def test_listing_pages(spark):
    link = '<a href="/info/1/%d.htm">%s</a>'
    page = link % (1, "张三 副教授") + link % (2, "more") + link % (1, "张三 副教授") + link % (3, "李四")
    widget = "var u_u1_title = ['王五','赵六'];var u_u1_id = ['7','8'];<a id='u_u1_7_a' href='/p/7.htm'>"
    df = spark.createDataFrame([("https://x.cn/l", page), ("https://x.cn/w", widget), ("https://x.cn/n", "")], "url string, html string")
    got = {(r["url"], r["at"]): (r["name"], r["profile_url"], r["title"]) for r in pages.list_items(df).collect()}
    assert got["https://x.cn/l", 1] == ("张三", "https://x.cn/info/1/1.htm", "副教授") and got["https://x.cn/l", 2][0] == "李四"
    assert got["https://x.cn/w", 1][:2] == ("王五", "https://x.cn/p/7.htm") and len(got) == 3
    assert pages.list_links(df, 1).count() == 1


def template(**given):
    return tuple(given.get(c, "") for c in rules.COLUMNS)


def rows_frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "ord long, " + ", ".join(f"{c} string" for c in rules.COLUMNS))


FULL = dict(name="张三", title="教授", email="z@x.cn", school="甲乙大学", college="数学学院", collector="c", collected_at="2024-01-01", intro="张三是教授", profile_url="http://x/1")


def test_upsert_is_idempotent_and_keeps_places(spark):
    old = rows_frame(spark, [template(**FULL), template(**FULL | {"name": "李四", "profile_url": "http://x/2", "email": "l@x.cn"})])
    new = rows_frame(spark, [template(**FULL | {"title": "教师", "intro": "短"}), template(**FULL | {"name": "王五", "profile_url": "http://x/3", "email": "w@x.cn"}), template(name="缺")])
    merged = merge.upserted(old, new)
    got = [(r["seq"], r["name"], r["title"]) for r in merged.orderBy("seq").collect()]
    assert got == [(1, "张三", "教授"), (2, "李四", "教授"), (3, "王五", "教授")]
    again = merge.upserted(merged.withColumn("seq", F.col("seq").cast("string")), old.limit(0))
    assert [(r["seq"], r["name"], r["title"]) for r in again.orderBy("seq").collect()] == got


def test_shared_addresses_are_blanked(spark):
    df = rows_frame(spark, [template(**FULL), template(**FULL | {"name": "李四"}), template(**FULL | {"name": "张三", "college": "物理学院"}), template(**FULL | {"name": ""})])
    assert [r["email"] for r in merge.without_shared_addresses(df).orderBy("ord").collect()] == ["", "", "z@x.cn", ""]


def fold_by_hand(records):
    def key(r):
        return r["school"], r["college"]

    clusters = []
    for r in records:
        for c in clusters:
            if key(r) == key(c) and ((r["name"] and r["name"] == c["name"]) or (r["email"] and r["email"] == c["email"] and r["profile_url"] and r["profile_url"] == c["profile_url"])):
                score = lambda x: ("english" not in x["profile_url"], bool(x["title"]), bool(x["email"]))
                a, b = (c, r) if score(c) >= score(r) else (r, c)
                merged = {k: a[k] or (b[k] if k != "name" else "") for k in a}
                merged["name"], merged["ord"], merged["n"] = a["name"], c["ord"], c["n"] + 1
                c.clear(), c.update(merged)
                break
        else:
            clusters.append(dict(r, n=1))
    return {(c["ord"], c["name"], c["email"], c["title"], c["profile_url"], c["n"]) for c in clusters}


def test_profile_fold_against_a_plain_fold(spark):
    random.seed(10)
    for _ in range(3):
        records = [
            dict(ord=i, name=random.choice(["张三", "李四", ""]), profile_url=random.choice(["", "http://x/1", "http://x/english/2"]), school="甲乙大学", college=random.choice(["数学学院", "物理学院"]),
                 title=random.choice(["", "教授"]), email=random.choice(["", "a@x.cn", "b@x.cn"]), intro="")
            for i in range(14)
        ]
        seen, distinct = {}, []
        for r in records:  # exact copies are folded into their first
            k = tuple(v for f, v in r.items() if f != "ord")
            if k in seen:
                seen[k]["n0"] += 1
            else:
                seen[k] = dict(r, n0=1)
                distinct.append(seen[k])
        df = spark.createDataFrame(records).select("ord", "name", "profile_url", "school", "college", "title", "email", "intro")
        got = {(r["ord"], r["name"], r["email"], r["title"], r["profile_url"]) for r in merge.merged_profiles(df).collect()}
        want = {x[:5] for x in fold_by_hand([{k: v for k, v in r.items() if k != "n0"} for r in distinct])}
        assert got == want
        assert merge.merged_profiles(df).agg(F.sum("n_merged")).first()[0] == len(records)


def test_components(spark):
    links = [(1, "a"), (2, "a"), (2, "b"), (3, "b"), (4, "c"), (5, "d"), (6, "d")]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "id long, key string")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 5}


def test_numbering(spark):
    df = spark.createDataFrame([(random.randint(0, 9), i) for i in range(500)], "a long, b long")
    got = [(r["a"], r["b"]) for r in numbered(df.repartition(7), ["a", "b"]).orderBy("seq").collect()]
    assert got == sorted((r["a"], r["b"]) for r in df.collect())
    assert numbered(df.limit(0), ["a", "b"]).count() == 0


def test_reports(spark):
    df = rows_frame(spark, [template(**FULL), template(**FULL | {"intro": ""}), template(**FULL | {"school": "xx大学"})])
    assert [tuple(r) for r in report.valid_by_day(df).collect()] == [("2024-01-01", 3, 2)]
    assert report.summary(df, "ord").count() == 2
    assert sorted(r["number"] for r in report.numbered_by_group(df, "ord").collect()) == [1, 2]


def test_a_whole_run(spark):
    page = "<title>张三--甲乙大学</title><p>张三，副教授，邮箱：zhang@x.edu.cn</p><p>长期从事海流模拟方面的教学和研究工作二十余年，成果丰富。</p>"
    captured = spark.createDataFrame([("https://x.cn/1", page)], "url string, html string")
    cells = ragged(spark, [("甲乙大学-数学学院.csv", -1, ["姓名", "主页"]), ("甲乙大学-数学学院.csv", 0, ["张三", "https://x.cn/1#a"]), ("甲乙大学-数学学院.csv", 1, ["李四", ""])])
    told = pipeline.Run(collector="c", day="2024-01-01")
    out = pipeline.run(pipeline.seed_records(cells, told), captured, told)
    rows = out["rows"].collect()
    assert [(r["name"], r["title"], r["email"], r["school"], r["college"]) for r in rows] == [("张三", "副教授", "zhang@x.edu.cn", "甲乙大学", "数学学院")]
    assert {r["severity"] for r in out["log"].collect()} == {"warn"}
    done = enrich.enriched(pipeline.seed_records(cells, told), captured)
    assert done.where("found").count() == 1


def test_drift_without_known_spellings(spark):
    """Columns that go on under other names are matched by their values, whatever the names."""
    from dataclasses import replace

    random.seed(12)
    bare_fields = tuple(replace(f, aliases=(f.name,)) for f in drift.FIELDS)
    signs = "赵钱孙李周吴郑王冯陈褚卫蒋沈韩杨朱秦尤许何吕施张"
    people = [
        {"n": "".join(random.sample(signs, 3)), "u": f"https://x.test/{i}", "c": random.choice(["数学学院", "物理学院", "化学学院"]), "m": f"a{i}@x.test"} for i in range(24)
    ]
    names = [{"n": "n1", "u": "u1", "c": "c1", "m": "m1"}, {"n": "zz", "u": "yy", "c": "xx", "m": "ww"}]
    lines = [(100 * f + i, f + 1, i, json.dumps({names[f][k]: v for k, v in p.items()}, ensure_ascii=False)) for f in (0, 1) for i, p in enumerate(people[12 * f : 12 * f + 12])]
    files = spark.createDataFrame([(1, "f", "1"), (2, "f", "2")], "file_id long, feed_id string, file_date string")
    df = spark.createDataFrame(lines, "line_id long, file_id long, line_no long, record string")
    got = {tuple(r) for r in drift.changes(files, df, bare_fields).collect()}
    assert got == {(2, f, "renamed") for f in ("name", "profile_url", "college", "email")}


def test_lookups_spread_hot_keys(spark):
    from rosterforge.operators.common import looked_up

    rows = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"k{i % 7}" if i % 3 == 1 else None) for i in range(90)], "id long, k string")
    keyed = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, v long")
    want = {r["id"]: {"hot": 1, "k1": 2, "k2": 3}.get(r["k"]) for r in rows.collect()}
    for broadcast, share in ((100, 1000), (0, 4), (0, 1000), (0, 1)):
        assert {r["id"]: r["v"] for r in looked_up(rows, keyed, ["k"], broadcast, share).collect()} == want


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, f"c{j}") for i in range(40) for j in (i, i + 1)]
    hub = [(1000 + i, "hub") for i in range(60)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(chain + hub, "id long, key string")).collect()}
    assert got == {i: 0 for i in range(40)} | {1000 + i: 1000 for i in range(60)}


def test_best_rows_of_a_hot_identity(spark):
    rows = [(i, *template(**FULL | {"title": "教授" if i in (7, 9) else "教师", "intro": "张三" + "好" * (i == 9)})) for i in range(40)]
    df = spark.createDataFrame(rows, "ord long, " + ", ".join(f"{c} string" for c in rules.COLUMNS))
    assert [(r["ord"], r["intro"]) for r in merge.best_rows(df, "ord").collect()] == [(0, "张三好")]
    assert merge.best_rows(df.limit(0), "ord").count() == 0
