import random

from rosterforge.llm import mapping as m


def ranks():
    return m.rank_entries([(1, "教授", "Professor"), (2, "副教授", "Associate Professor"), (3, "助理教授", "Assistant Professor"), (4, "讲师", "Lecturer"), (9, "正高级工程师", "Principal Engineer"), (10, "高级工程师", "Senior Engineer")], {"教授": 9})


def colleges():
    return m.college_entries([(1, "甲大学", "经济与金融学院", "School of Economics and Finance"), (2, "甲大学", "食品与轻工学院", "School of Food and Light Industry"), (3, "乙大学", "经济与金融学院", "School of Economics and Finance")], {})


def best(entries, scope, value):
    return m.Dictionary(entries).best(scope, value)[3]


def test_ranks():
    for value, ref in {
        "副教受": 2, "付教授": 2, "教搜": 1, "正教授": 1, "三级教授": 1, "lectuer": 4, "Assoc. Prof.": 2, "the associate  professor": 2, "助里教授": 3,
        "教授级高工（正高级工程师）": 9, "高极工程师": 10, "讲师；实验室主任": 4, "副教授/系主任": 2, "教 授": 1, "【副教授】": 2, "院长": 0, "N/A": 0, "—": 0, "Dean": 0,
    }.items():
        assert best(ranks(), "", value) == ref, value


def test_colleges():
    for value, ref in {
        "经济于金融学院": 1, "经金学院": 1, "甲大学经金学院": 1, "甲大学 经济与金融学院": 1, "经济与金融学院国际贸易系": 1, "Sch. of Economics & Finance": 1, "食品学院": 2, "图书馆": 0, "xx学院": 0, "校医院": 0,
    }.items():
        assert best(colleges(), "甲大学", value) == ref, value
    assert best(colleges(), "乙大学", "食品学院") == 0


def test_symmetric_delete_finds_all_within_one_edit():
    random.seed(2)
    entries = ranks()
    d = m.Dictionary(entries)
    for _ in range(300):
        word = random.choice([s for e in entries for s in map(m.clean, e.spellings) if len(s) >= 5])
        i = random.randrange(1, len(word))
        z = "z" if word.isascii() else "某"  # a sign of another script costs more than one edit
        typed = random.choice([word[:i] + word[i + 1 :], word[:i] + z + word[i:], word[:i] + z + word[i + 1 :]])
        assert d.close("", typed) is not None, (word, typed)


def test_distance_is_damerau():
    assert m.distance("abcd", "acbd", 2) == 1 and m.distance("abcd", "abcd", 2) == 0 and m.distance("ab", "abcde", 2) == float("inf")


def test_blocks_and_nulls(spark):
    rows = spark.createDataFrame([(1, "", "教搜", "x"), (2, "", "院长", "x"), (3, "", "副教受", "x")], "row_id long, scope string, value string, ref_id string")
    for block in (1, 2, 100):
        got = {r["row_id"]: r["ref_id"] for r in m.map_values(rows.drop("ref_id"), ["row_id"], ranks(), block).collect()}
        assert got == {1: 1, 2: 0, 3: 2}
    assert [r["ref_id"] for r in m.map_values(rows.drop("ref_id"), ["row_id"], []).collect()] == [0, 0, 0]


def test_long_entries_are_found_with_a_typo():
    name = "Joint International Graduate School of Economics, Finance and Public Administration"
    entries = m.college_entries([(1, "甲大学", "经济与金融学院", name)], {})
    long = max((s for e in entries for s in map(m.clean, e.spellings)), key=len)
    assert len(long) > 60 and m.Dictionary(entries).close("甲大学", long[:20] + long[21:]) is not None


def test_long_entries_and_prefixes_against_brute_force():
    import random

    random.seed(4)
    entries = [m.Entry(i + 1, "", ("".join(random.choice("abcdefgh ") for _ in range(random.randint(6, 90))).strip(),)) for i in range(60)]
    d = m.Dictionary(entries)
    for _ in range(300):
        s = m.clean(random.choice(entries).spellings[0])
        v = list(s)
        for _ in range(random.randint(1, 2)):
            i = random.randrange(len(v))
            random.choice((lambda: v.pop(i), lambda: v.insert(i, "z"), lambda: v.__setitem__(i, "y")))()
        typed = "".join(v)
        best = min(
            ((w, -e.uses, e.ref_id, len(c)) for e in entries for c in [m.clean(e.spellings[0])] if (w := m.distance(typed, c, m.allowed(len(c)) + 0.25)) <= m.allowed(len(c)) + 0.25),
            default=None,
        )
        assert d.close("", typed) == best, typed
    name = "college of " + "very long and winding names of fields " * 2
    assert m.Dictionary([m.Entry(7, "", (name,))]).best("", name.replace("winding", "wnding"))[3] == 7


def test_contained_spellings_against_brute_force():
    d = m.Dictionary([m.Entry(1, "", ("数学学院",)), m.Entry(2, "", ("应用数学学院",)), m.Entry(3, "", ("art",))])
    assert d.contained("", "某校应用数学学院办公室") == (-6, 0, 2) and d.contained("", "state art") == (-3, 0, 3)
    assert d.contained("", "artist") is None and d.contained("", "x") is None
