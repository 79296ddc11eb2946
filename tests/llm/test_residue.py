from rosterforge.llm import residue as r

BAD = [
    "{{bio}}", "<p>${intro}", "简介：[%jianjie%]", "Author of 3 papers.联系电话：{phone}", "<%= 简介 %>", "@@desc@@", "__intro__", "【简介待填】", "暂无简介", "（待补充）", "TBD", "null", "Loading...",
    "请启用JavaScript后查看本页内容。", "noscript: 本页需要脚本支持", "Enable scripts and cookies to continue.", "HTTP错误 404：您访问的页面不存在或已被删除。", "503 Timeout - gate", "Access denied.", "系统繁忙，请稍后重试。",
    "测试测试测试", "asdf asdf asdf", "啊啊啊啊啊啊", "文本内容文本内容。", "Lorem ipsum dolor sit amet", "[object Object]", "待更新（院办）", "java.lang.NullPointer at Show.render",
]
GOOD = [
    "提出集合{x1, x2}上的新型度量，给出了收敛条件。", "研究兴趣还包括页面模板的自动识别与占位内容的过滤。", "在404号实验室负责仪器预约与安全培训。", "开设JavaScript程序设计选修课，并维护课程网站。", "参与编写《网页访问异常处理手册》。",
    "长期负责系里的访问服务器维护工作。", "Room 404 in the north building hosts the weekly reading group.", "Wrote a short course on JavaScript and error handling.", "Enjoys template-free teaching.", "", None, "　",
]


def found(spark, rows):
    df = spark.createDataFrame(rows, "row_id long, source string, intro string, email string, evidence string")
    return {(x["id"], x["field"]) for x in r.residue(df, "row_id", "source", ("intro",), ("email",)).collect()}


def test_bad_and_good_texts(spark):
    rows = [(i, "h", t, None, None) for i, t in enumerate(BAD)] + [(100 + i, None, t, "ann@x.test", None) for i, t in enumerate(GOOD)]
    got = found(spark, rows)
    assert {BAD[i] for i in range(len(BAD)) if (i, "intro") not in got} == set()
    assert {i for i, _ in got if i >= 100} == set()


def test_addresses(spark):
    bad = ["name@example.invalid", "abc@abc.abc", "***@***.***", "@", "{user}@{domain}", "null@null", "javascript:void(0)", "[email protection active]", "待补充", "姓名@学校.xx", "x@localhost.invalid"]
    good = ["ann@x.edu.test", "(ann@x.test)", "test28@lanmail.test", "Ann Lee", "https://x.test/a", None, ""]
    rows = [(i, "h", None, t, None) for i, t in enumerate(bad)] + [(100 + i, "h", None, t, None) for i, t in enumerate(good)]
    assert found(spark, rows) == {(i, "email") for i in range(len(bad))}


def test_recurrent_lines_beside_content_are_boilerplate(spark):
    rows = [(i, "h", f"Paper {i} on soils. Access denied to bots by policy.", None, None) for i in range(50)]
    rows += [(100 + i, "g", "Access denied to bots by policy.", None, None) for i in range(50)]
    got = {i for i, _ in found(spark, rows)}
    assert got == set(range(100, 150))


def test_empty_and_long(spark):
    assert found(spark, []) == set()
    assert found(spark, [(1, "h", "Works on soils. " * 20000 + "{{bio}}", None, None)]) == {(1, "intro")}


def test_evidence_in_long_texts_without_line_ends(spark):
    long = "Works on soil fertility and the plants that depend on it, with " + "colleagues of other departments and " * 3 + "students."
    han = "长期关注海流模拟中的评价方法问题，主持省部级课题三项，参与横向项目五项" * 3 + "。"
    bad = [f"暂无简介。{han}", f"待补充。{han}", f"{long} TBD", f"{long} (null) {long}"[: -len(long) - 1], f"TBD! {long}", f"{long} N/A. {long}", f"Loading... {long}", f"　TODO。{han}"]
    bad += [f"{han}测试一测试一测试一。{han}", f"{long} asdf asdf asdf. {long}", f"{long} 啊啊啊啊啊 {han}"[: len(long) + 6], f"{long}\n{{{{bio\n{long}"]
    good = [long, han, f"{long} None of it is lost. {long}", f"Testing of soils. {long}", f"{han}2020"]
    rows = [(i, "h", t, None, None) for i, t in enumerate(bad)] + [(100 + i, "g", t, None, None) for i, t in enumerate(good)]
    assert found(spark, rows) == {(i, "intro") for i in range(len(bad))}


def test_every_line_with_evidence_is_screened(spark):
    """Whatever stop stands before it, in cells of 10 to 10,000 characters; no cell with evidence may be lost."""
    from pyspark.sql import functions as F

    lines = [x for x in [*BAD, *GOOD] if x]
    before = ["", "长期" * 50 + "。", "Soils " * 20 + "end. ", "Ends! ", "Ends? ", "完了！", "完了？", "a\r\n", "　", "· ", "Soils and " * 1000 + "air.\t"]
    texts = [b + x + after for x in lines for b in before for after in ("", "\n" + "甲乙丙丁" * 30)]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    has = F.exists(r.lines_of(F.col("value")), lambda x: r.evidence(x, F.lit(False)).isNotNull())
    bad = df.where(has)
    assert bad.count() > len(BAD) * len(before)
    assert bad.exceptAll(r.screened(bad, False)).collect() == []


def test_every_phrase_needs_one_of_its_literals():
    import re

    samples = {
        r"请输入": "请输入姓名", r"http\s?(?:错误|error)": "http 错误", r"error[: ]+[45]\d\d\b": "error: 404", r"页面(?:不存在|走丢|已(?:被)?删除|无法访问|出错|未找到)": "页面走丢",
        r"稍[后候](?:重试|再试)": "稍候再试", r"e-?mail地址": "email地址", r"\[email protect": "[email protected]", r"to be (?:filled|added|announced)": "to be added",
    }
    for pattern, text in samples.items():
        assert re.search(pattern, text) and any(w in text for w in r.literals(pattern))
    for pattern in (*r.SCRIPTS, *r.ERRORS, *r.STAND_INS):
        assert r.literals(pattern), pattern
