import random
from collections import Counter

import pytest

from rosterforge.llm import garbled as g

SENTENCES = ["长期关注海流模拟中的评价方法问题。", "主持省部级课题三项，参与横向项目五项。", "获校级教学奖励五次。", "Works on soil fertility – and “open” café talks.", "Ömer Éluard", "Анна Ежова"]


@pytest.fixture(scope="module")
def model():
    random.seed(3)
    return g.CharModel(Counter("".join(random.choice(SENTENCES) for _ in range(3000))), 20.0)


@pytest.mark.parametrize("read,written", [p for p in g.PAIRS[:8]])
def test_round_trip(model, read, written):
    for text in SENTENCES[:3]:
        try:
            raw = text.encode(written)
            back = {v: k for k, v in g.byte_of(read).items()} if read in ("cp1252", "mac_roman", "cp1251", "cp437", "cp850") else None
            spoiled = "".join(back[bytes([b])] for b in raw) if back else raw.decode(read)
        except (UnicodeDecodeError, KeyError):
            continue
        bad, restored = g.repair(spoiled, model)
        assert bad and restored == text, (read, written, spoiled, restored)


def test_part_of_a_text(model):
    spoiled = SENTENCES[1] + SENTENCES[0].encode().decode("latin-1")
    assert g.repair(spoiled, model) == (True, SENTENCES[1] + SENTENCES[0])


def test_twice_garbled(model):
    def once(s):
        table = {v: k for k, v in g.byte_of("cp1252").items()}
        return "".join(table[bytes([b])] for b in s.encode())

    assert g.repair(once(once(SENTENCES[0])), model) == (True, SENTENCES[0])


def test_rightly_used_letters(model):
    for text in [*SENTENCES, "", "Łukasz Müllner", "Мария Щукарь", "김하늘", "森田ユウ"]:
        assert not g.repair(text, model)[0], text


def test_lost_bytes_are_found(model):
    assert g.repair("获校级�学奖励", model)[0] and g.repair("锟斤拷锟斤拷", model)[0]


def test_frame(spark):
    rows = [(1, SENTENCES[0], None, "x")] * 30 + [(2, SENTENCES[0].encode().decode("latin-1"), "", "x"), (3, None, "Ann", "x")]
    df = spark.createDataFrame(rows, "row_id long, name string, intro string, field string")
    got = [(r["id"], r["field"], r["restored"]) for r in g.restored(df, "row_id", ("name", "intro")).collect()]
    assert got == [(2, "name", SENTENCES[0])]
    assert g.restored(df.limit(0), "row_id", ("name", "intro")).count() == 0


def test_hot_garbled_value_is_found(spark):
    hot = ["欧阳海流".encode().decode(read) for read in ("gb18030", "mac_roman", "cp437")]
    rows = [(i, s + str(i), None) for i, s in enumerate(SENTENCES * 30)] + [(1000 + i, "长期关注海流模拟%d" % i, None) for i in range(60)]
    rows += [(2000 + i, "欧阳海流%d" % i, None) for i in range(60)]
    for spoiled in hot:
        df = spark.createDataFrame(rows + [(5000 + i, spoiled, None) for i in range(150)], "row_id long, name string, intro string")
        found = {r["id"]: r["restored"] for r in g.restored(df, "row_id", ("name", "intro")).collect()}
        assert found == {i: "欧阳海流" for i in range(5000, 5150)}, spoiled


def test_letter_of_a_word_is_left(model):
    counts = Counter({"清": 4000, **{c: 60 for c in "Щукар Тимур"}, "ь": 1})
    assert not g.repair("Тимур Щукарь", g.CharModel(counts))[0]


@pytest.mark.parametrize("share", (0.1, 0.3, 0.5))
def test_many_garbled_texts_do_not_make_themselves_likely(share):
    random.seed(5)
    parts = ["长期关注", "海流模拟", "评价方法", "主持省部级课题", "参与横向项目", "教学奖励", "研究生培养", "农业大学", "访问一年", "开设课程", "土壤肥力", "期刊审稿", "水稻育种", "获得校级", "数据资源库"]
    clean = sorted({"，".join(random.sample(parts, 5)) + "。" for _ in range(600)})
    for read, written in (("gb18030", "utf-8"), ("gb18030", "big5"), ("cp1252", "gb18030")):
        spoiled = [s for s in (t.encode(written, "ignore").decode(read, "ignore") for t in clean[: int(600 * share)]) if len(s) > 5]
        counts: Counter[str] = Counter()
        for text in spoiled + clean[int(600 * share) :]:
            for c in [*text, ""]:
                counts[c] += max(1, g.weight_class(text) ** g.POWER)
        m = g.model_of(counts)
        found = sum(g.repair(s, m)[0] for s in spoiled)
        assert found >= 0.9 * len(spoiled), (read, written, found, len(spoiled))
        assert not any(g.repair(t, m)[0] for t in clean[-60:])
