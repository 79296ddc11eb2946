import json
import os

import pytest
from pyspark.sql import functions as F

from rosterforge.functions import rules
from rosterforge.sources import files, workbook
from rosterforge.streaming import upsert


def test_workbook_round_trip(spark, tmp_path):
    path = str(tmp_path / "w.xlsx")
    rows = [["1", "张三", "", "a<b>&\"c\""], ["2", "", None, "x\ny"]]
    workbook.write_workbook(path, [("汇总", ["a", "b", "c", "d"], rows), ("汇总", [], [])])
    assert list(workbook.read_first_sheet(path)) == [["a", "b", "c", "d"], ["1", "张三", "", "a<b>&\"c\""], ["2", "", "", "x\ny"]]
    workbook.register(spark)
    read = spark.read.format("workbook").load(path).orderBy("ord").collect()
    assert [r["ord"] for r in read] == [-1, 0, 1] and read[1]["cells"][1] == "张三"
    folder = str(tmp_path / "out")
    spark.createDataFrame([("1", "李四")], "seq string, name string").coalesce(1).write.format("workbook").mode("append").save(folder)
    again = spark.read.format("workbook").load(folder).orderBy("ord").collect()
    assert [list(r["cells"]) for r in again] == [["seq", "name"], ["1", "李四"]]


def test_names_of_sheets_and_columns():
    assert workbook.sheet_names(["a/b", "A_B", "", "x" * 40, "x" * 40]) == ["a_b", "A_B_2", "Sheet", "x" * 31, "x" * 29 + "_2"]
    for n in (1, 26, 27, 28, 702, 703, 16384):
        assert workbook.column_number(workbook.column_name(n) + "7") == n
    assert workbook.column_number("12") == 1


def test_ragged_csv(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_bytes('﻿姓名,主页\r\n"张\n三","a ""b"""\r\n,\r\n李四\r\n'.encode())
    got = [(r["ord"], list(r["cells"])) for r in files.read_ragged_csv(spark, str(path)).orderBy("ord").collect()]
    assert got == [(-1, ["姓名", "主页"]), (0, ["张\n三", 'a "b"']), (1, ["李四"])]


def test_output_csv_read_again(spark, tmp_path):
    df = spark.createDataFrame([tuple(str(i) for i in range(10))], ", ".join(f"{c} string" for c in rules.COLUMNS))
    path = str(tmp_path / "d" / "o.csv")
    assert files.write_small_csv(df, path, rules.HEADERS) == 1
    with open(path, "rb") as f:
        raw = f.read()
    assert raw.startswith(b"\xef\xbb\xbf") and raw.endswith(b"\r\n")
    other = tmp_path / "d" / "x.csv"
    other.write_text("a,b\n1,2\n")
    rows = files.template_rows(files.read_ragged_csv(spark, str(tmp_path / "d"))).collect()
    assert len(rows) == 1 and rows[0]["profile_url"] == "9"


def test_manifests(spark, tmp_path):
    row = [str(i) for i in range(10)]
    row[4] = "xx大学"
    (tmp_path / "a.json").write_text(json.dumps({"school": "甲大学", "college": "", "rows": [row, ["short"]]}, ensure_ascii=False, indent=1))
    (tmp_path / "b.json").write_text("{broken")
    got = files.manifest_rows(files.read_manifests(spark, str(tmp_path))).collect()
    assert len(got) == 1 and got[0]["school"] == "甲大学" and got[0]["name"] == "1"
    listed = spark.createDataFrame([(1, 0, *row)], "run_id long, ord long, " + ", ".join(f"{c} string" for c in rules.COLUMNS))
    value = json.loads(files.manifest_of(listed, school="甲大学").first()["value"])
    assert value["headers"] == list(rules.HEADERS) and value["rows"] == [row]


def test_paths(spark):
    assert files.output_stem("甲大学_导入_Python") == "甲大学输出" and files.output_stem("x") == "x输出"
    assert files.output_path("/r", "d", "甲/大学", "", "y导入") == "/r/d/甲_大学/y输出.csv"
    assert files.file_part(' a<b>:"c ') == "a_b_c" and files.file_part("..") == "output"
    assert files.csv_path("a.txt") == "a.csv" and files.legacy_path("a.csv") == "a.xlsx" and files.preview_path("a.csv") == "a_预览.csv"
    assert files.manifest_path("/r", "d", "/o/x.csv").startswith("/r/d/.汇总数据/records/x_")
    assert spark.range(1).select(files.path_part(F.lit(" a:b. "), "z").alias("x")).first()["x"] == "a_b"


def test_stream_of_rows(spark, tmp_path):
    schema = "ord long, " + ", ".join(f"{c} string" for c in rules.COLUMNS)
    full = ("", "张三", "教授", "z@x.cn", "甲乙大学", "数学学院", "c", "2024-01-01", "张三是教授", "http://x/1")
    source, snapshot = str(tmp_path / "in"), str(tmp_path / "snap")
    for n, title in enumerate(("讲师", "教授")):
        spark.createDataFrame([(n, *full[:2], title, *full[3:8], "张三" + "好" * n, full[9])], schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        upsert.upsert_stream(stream, snapshot, str(tmp_path / "cp")).awaitTermination()
    rows = spark.read.parquet(upsert.latest(spark, snapshot)).collect()
    assert [(r["name"], r["title"]) for r in rows] == [("张三", "教授")]
    assert len([d for d in os.listdir(snapshot) if d.startswith("batch=")]) == 2


def test_rows_of_any_width(spark, tmp_path):
    wide = [f"c{i}" for i in range(300)]
    (tmp_path / "w.csv").write_text("﻿" + ",".join(wide) + "\r\n\r\n , \r\na,\"b\n\"\"c\"\"\"\r\n" + ",".join(wide) + ",more\r\n", encoding="utf-8")
    got = {r["ord"]: list(r["cells"]) for r in files.read_ragged_csv(spark, str(tmp_path / "w.csv")).collect()}
    assert got == {-1: wide, 0: ["a", 'b\n"c"'], 1: [*wide, "more"]}


def test_stale_files_and_listing(spark, tmp_path):
    root = tmp_path / "out"
    (root / "a").mkdir(parents=True)
    (root / "a" / "x.csv").write_text("1")
    (root / "b.csv").write_text("2")
    assert [p.rpartition("/")[2] for p in files.listed(spark, str(root))] == ["a", "b.csv"] and files.listed(spark, str(tmp_path / "none")) == []
    assert files.removed(spark, str(root), [str(root / "a"), str(root / "gone.csv")]) == [str(root / "a")]
    assert not (root / "a").exists() and (root / "b.csv").exists()
    for outside in (str(tmp_path / "other.csv"), str(root), str(root / ".." / "x")):
        with pytest.raises(ValueError):
            files.removed(spark, str(root), [outside])
    assert files.is_within("/a/b", "/a/b/c") and not files.is_within("/a/b", "/a/bc")


def test_snapshots_are_listed_through_the_store(spark, tmp_path):
    snapshot = tmp_path / "snap"
    for n, complete in ((1, True), (2, True), (3, False)):
        folder = snapshot / f"batch={n:012d}"
        folder.mkdir(parents=True)
        if complete:
            (folder / "_SUCCESS").write_text("")
    uri = snapshot.as_uri()  # a path with a scheme, which no function of the os module would find
    assert upsert.latest(spark, uri).endswith("batch=000000000002") and upsert.latest(spark, uri, below=2).endswith("batch=000000000001")
    assert upsert.latest(spark, uri, below=1) is None and upsert.latest(spark, uri + "/none") is None


def test_capture_with_retries(spark):
    from urllib.error import HTTPError, URLError

    from rosterforge.sources import capture

    calls = []

    def fetch(url, seconds):
        calls.append(url)
        if "slow" in url and len(calls) < 3:
            raise URLError("no route")
        if "gone" in url:
            raise HTTPError(url, 404, "Not Found", None, None)
        return f"<p>{url}</p>"

    assert capture.with_retries(fetch, "https://x.test/slow", 1, (0, 0)) == "<p>https://x.test/slow</p>" and len(calls) == 3
    assert capture.headers("https://x.test/a")["Referer"] == "https://x.test/"
    urls = spark.createDataFrame([("https://x.test/a#1",), ("https://x.test/a#2",), ("https://x.test/gone",), ("",), (None,)], "url string")
    got = {r["url"]: (r["html"], r["error"]) for r in capture.captured(urls, fetch=fetch, waits=(0,)).collect()}
    assert set(got) == {"https://x.test/a", "https://x.test/gone"} and got["https://x.test/a"] == ("<p>https://x.test/a</p>", None)
    assert got["https://x.test/gone"][0] is None and "404" in got["https://x.test/gone"][1]


def test_command_line(spark, tmp_path):
    from rosterforge import cli

    page = "<title>张三--甲乙大学</title><p>张三，副教授，邮箱：zhang@x.edu.cn</p><p>长期从事海流模拟方面的教学和研究工作二十余年，成果丰富。</p>"
    spark.createDataFrame([("https://x.cn/1", page)], "url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    (tmp_path / "甲乙大学-数学学院.csv").write_text("姓名,主页\n张三,https://x.cn/1\n李四,\n", encoding="utf-8")
    given = cli.parser().parse_args(["--input", str(tmp_path / "甲乙大学-数学学院.csv"), "--pages", str(tmp_path / "pages.parquet"), "--collector", "c", "--date", "2024-01-01", "--output", str(tmp_path / "o.csv"), "--log", str(tmp_path / "log")])
    counters = cli.run(spark, given)
    assert (counters["n_input"], counters["n_exported"]) == (2, 1)
    assert "zhang@x.edu.cn" in (tmp_path / "o.csv").read_text(encoding="utf-8") and (tmp_path / "log" / "run.json").exists()
    answers = iter(["https://x.cn/l", "y"])
    assert cli.asked(cli.parser().parse_args([]), lambda _: next(answers)).list_page_url == "https://x.cn/l"
    with pytest.raises(ValueError):
        cli.run(spark, cli.parser().parse_args([]))


def test_previews_replace_their_folder(tmp_path):
    folder = tmp_path / "p"
    folder.mkdir()
    (folder / "old.csv").write_text("x")
    made = files.write_previews(str(folder), [("甲", ["a"], [["1"]]), ("乙/丙", ["b"], [])])
    assert sorted(os.listdir(folder)) == ["01_甲.csv", "02_乙_丙.csv"] and len(made) == 2


def test_summary_written_as_workbook(spark, tmp_path):
    from rosterforge.plans import pipeline
    from rosterforge.sources import workbook

    full = ("", "张三", "教授", "z@x.cn", "甲乙大学", "数学学院", "c", "2024-01-01", "张三是教授", "http://x/1")
    schema = "number long, " + ", ".join(f"{c} string" for c in rules.COLUMNS)
    df = spark.createDataFrame([(2, *full), (1, *full[:5], "物理学院", *full[6:])], schema).drop("seq")
    assert pipeline.resync(df, str(tmp_path / "s.xlsx")) == 2
    rows = list(workbook.read_first_sheet(str(tmp_path / "s.xlsx")))
    assert rows[0] == list(rules.HEADERS) and [r[0] for r in rows[1:]] == ["1", "2"] and rows[1][5] == "物理学院"
