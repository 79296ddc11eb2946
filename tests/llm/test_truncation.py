from rosterforge.llm import truncation as t

WHOLE = ["Works on soil fertility and plants.", "Serves on the board of a journal.", "Visited Linxi University for a year."]


def cut(spark, rows):
    df = spark.createDataFrame(rows, "id long, source string, intro string, text string")
    return {r["id"]: r["reason"] for r in t.cut_texts(df, "id", "source", "intro").collect()}


def corpus():
    rows = [(i, "a", " ".join(WHOLE[: 1 + i % 3]), None) for i in range(60)]
    rows += [(100 + i, "a", f"{WHOLE[i % 3]} Office: Room {i}", None) for i in range(30)]
    return rows


def test_marks_limits_and_sentences(spark):
    text = "长期关注海流模拟中的评价方法问题。主持省部级课题三项，参与横向项目五项。"
    rows = corpus()
    rows += [(200 + i, "b", (text * 3)[i : i + 30], None) for i in range(1, 14)]  # all cut at 30 signs
    rows += [(300, "a", "Works on soil fertility and pl", None), (301, "a", "Serves on the boa...", None), (302, "a", "Works on&nb", None), (303, "a", "Works on <a hre", None)]
    rows += [(304, "a", "Wor", None), (305, "a", WHOLE[0] + " Office: Room 7", None), (306, None, None, None), (307, "a", "", None), (308, "a", "　", None)]
    got = cut(spark, rows)
    assert got[300] == "sentence" and got[301] == "mark" and got[302] == "mark" and got[303] == "mark" and got[304] == "sentence"
    assert 305 not in got and not {306, 307, 308} & got.keys()
    assert not any(i in got for i in range(130))
    limit = [i for i in range(201, 214) if not rows[[r[0] for r in rows].index(i)][2].endswith("。")]
    assert limit and all(i in got for i in limit)


def test_byte_limits_leave_up_to_two_bytes(spark):
    long = "曾赴澜坞农业大学访问两年合作开展植物抗逆研究兼任学会理事"
    rows = [(i, "b", ("a" * (i % 3) + long)[: 20], None) for i in range(30)]
    # limit 60 bytes: 20 ideographs are 60 bytes, with Latin letters 58 or 59
    rows = [(i, s, x.encode()[:60].decode(errors="ignore"), n) for i, s, x, n in rows]
    assert len(cut(spark, rows + corpus_other())) >= 30


def corpus_other():
    return [(1000 + i, "c", " ".join(WHOLE[: 1 + i % 3]), None) for i in range(30)]


def test_empty_table(spark):
    assert cut(spark, []) == {}


def test_very_long_text(spark):
    rows = corpus() + [(500, "a", "Works on soil. " * 20000 + "Works on so", None)]
    assert cut(spark, rows)[500] == "sentence"


def test_endings_of_rare_free_openings(spark):
    rows = corpus() + [(500 + i, "a", f"{WHOLE[i % 3]} Last updated October {i}", None) for i in range(40)]
    rows += [(600, "a", WHOLE[0] + " Last updated Octobe", None)]
    # endings that seldom come twice tell nothing
    words = [a + b for a in "bdfgklmnprst" for b in ("ore", "ink", "ath", "ell", "oom")]
    rows += [(700 + i, "a", f"{WHOLE[i % 3]} Research interests: {w}", None) for i, w in enumerate(words)]
    got = cut(spark, rows)
    assert got == {600: "sentence"}


def test_at_a_limit_only_a_proven_ending_spares(spark):
    rows = corpus() + [(800 + i, "d", f"{WHOLE[i % 3]} Last updated October {i}", None) for i in range(12)]
    rows += [(900 + i, "e", ("A" * (i % 7 + 20) + ". Last updated October 20")[:40], None) for i in range(12)]
    rows += [(950, "e", "A" * 15 + ". Last updated October 7", None)]
    assert len(rows[-1][2]) == 39 and cut(spark, rows) == {900 + i: "limit" for i in range(12)}
    rows[-1] = (950, "e", "A" + rows[-1][2], None)
    assert cut(spark, rows) == {900 + i: "limit" for i in range(12)}


def test_rare_openings_count_whatever_the_size(spark, monkeypatch):
    rows = corpus() + [(500 + i, "a", f"Breeds wheat in field {i}.", None) for i in range(4)]
    rows += [(600, "a", "Breeds wheat in fie", None), (601, "a", WHOLE[0] + " Breeds wh", None)]
    rows += [(1000 + i, "a", "Works on soil. " * 2500 + WHOLE[0], None) for i in range(40)]  # 100,000 other sentences
    assert cut(spark, rows) == {600: "sentence", 601: "sentence"}
    monkeypatch.setattr(t, "BROADCAST_KEYS", 0)
    assert cut(spark, rows) == {600: "sentence", 601: "sentence"}
    monkeypatch.setattr(t, "SUPPORT", 20)
    assert cut(spark, rows) == {600: "sentence", 601: "sentence"}


def test_every_spike_of_a_source_counts(spark):
    rows = [(i, "f", "Works on soil" + " and air" * (i % 5) + ".", None) for i in range(300)]
    rows += [(400 + i, "f", f"Works on field {i:02} {'x' * 100}"[:60], None) for i in range(12)]
    rows += [(500 + i, "f", f"Works on field {i:02} {'y' * 100}"[:84], None) for i in range(12)]
    assert cut(spark, rows) == {i: "limit" for i in [*range(400, 412), *range(500, 512)]}
