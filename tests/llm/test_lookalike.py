from rosterforge.llm import lookalike as k


def test_consistent_forms():
    for text, form in {
        "Рetrа Nоrrgård": "Petra Norrgård", "Юлия Pудаков": "Юлия Рудаков", "Inês Β. Xavierre": "Inês B. Xavierre", "Ｓｅａｎ　Ｌacombe": "Sean Lacombe",
        "孙木‌": "孙木", "柳\xa0溪": "柳 溪", "⻢⾟": "马辛", "买买•多吉": "买买·多吉", "Håkan": "Håkan", "x＠y．test": "x@y.test", "уа@b.test": "ya@b.test",
        "a‑b@c.test": "a-b@c.test", "𝐈𝐤𝐞𝐫": "Iker", "​": "",
    }.items():
        assert k.consistent(text) == form, text


def test_left_alone():
    for text in ("Анна Ежова", "김하늘", "森田ユウ", "大江 みさき", "Ömer Éluard", "阿依·艾力", "\tAnn \n", "", "邮箱未公开，请登录后查看"):
        assert k.consistent(text) == text


def test_idempotent_and_frame(spark):
    rows = [(1, "Рetrа", None, "x"), (2, None, "", "x"), (3, "Ann", "a@b", "x"), (4, "Håkan" * 5000, "x", "y")]
    df = spark.createDataFrame(rows, "row_id long, name string, email string, consistent string")
    got = {(r["id"], r["field"]): r["consistent"] for r in k.cells(df, "row_id", ("name", "email")).collect()}
    assert set(got) == {(1, "name"), (4, "name")}
    assert all(k.consistent(v) == v for v in got.values())
    assert k.cells(df.limit(0), "row_id", ("name", "email")).count() == 0


def test_compatible_latin_letters_are_unusual(spark):
    names = [f"A{c}b" for c in "ĲĳĿŀŉſ"] + [f"A{chr(n)}b" for n in range(0xC0, 0x180)]
    df = spark.createDataFrame([(i, n, None) for i, n in enumerate(names)], "row_id long, name string, email string")
    got = {r["id"] for r in k.cells(df, "row_id", ("name",)).collect()}
    assert got == {i for i, n in enumerate(names) if k.consistent(n) != n} and set(range(6)) <= got


def test_further_scripts():
    for text, form in {"Օlga": "Olga", "ᎪNNA": "ANNA", "王口ニ": "王口二", "力カ": "力力", "トヨ卜": "トヨト"}.items():
        assert k.consistent(text) == form, text
    for text in ("田中マリ", "江ノ島", "トヨタ", "岡本タロウ", "Անի Հակոբյան", "买买·艾力"):
        assert k.consistent(text) == text


def test_no_sign_that_changes_is_overlooked(spark):
    """Over all of Unicode, alone, in a Latin and in a Chinese name."""
    signs = [chr(n) for n in range(0x110000) if not 0xD800 <= n < 0xE000]
    texts = [t for c in signs for t in (f"A{c}n", f"王{c}") if k.consistent(t) != t]
    df = spark.createDataFrame([(t,) for t in texts], "name string")
    assert len(texts) > 10_000 and df.where(~k.unusual(df["name"])).collect() == []
