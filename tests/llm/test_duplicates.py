import itertools
import random

from rosterforge.llm import duplicates as d

FIELDS = ("name", "url", "mail")


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, name string, url string, mail string, key string, hot string")


def canonical(values):
    def one(v):
        if v is None or not v.strip():
            return ""
        bare = "".join(c for c in v.upper().lower() if c.isalnum())
        return bare or "\u0001"

    return tuple(sorted({one(v) for v in values}))


def test_pairs_equal_brute_force(spark):
    random.seed(1)
    pool = ["Ann Lee", "ann-lee", " ANN  LEE ", None, "", "　", "http://x/A", "HTTP://X/a/", "...", "@", "a@b", "A@B."]
    rows = [(i, *(random.choice(pool) for _ in range(3)), "x", None) for i in range(120)]
    got = {tuple(r) for r in d.pairs(frame(spark, rows), "id", FIELDS).collect()}
    want = {
        (a[0], b[0]) for a, b in itertools.combinations(rows, 2) if canonical(a[1:4]) == canonical(b[1:4])
    }
    assert got == want


def test_hot_group_is_salted_and_whole(spark):
    rows = [(i, "Same", "u", None, "x", None) for i in range(300)] + [(1000 + i, f"n{i}", "u", None, "x", None) for i in range(300)]
    groups = {r["representative"]: r["copies"] for r in d.collapse(frame(spark, rows), "id", FIELDS).collect()}
    assert groups[0] == 300 and len(groups) == 301
    assert d.hot_keys(d.keyed_rows(frame(spark, rows), "id", FIELDS), 600, 3).count() == 1
    assert d.pairs(frame(spark, rows), "id", FIELDS, salts=4, hot_share=3).count() == 300 * 299 // 2


def test_fields_out_of_place_and_blank_only_equals_blank(spark):
    rows = [(1, "Ann", "u", "m", None, None), (2, "m", "Ann", "U", None, None), (3, None, "", " ", None, None), (4, "", None, "　", None, None), (5, "--", None, None, None, None)]
    assert {tuple(r) for r in d.pairs(frame(spark, rows), "id", FIELDS).collect()} == {(1, 2), (3, 4)}


def test_empty_table(spark):
    empty = frame(spark, [])
    assert d.collapse(empty, "id", FIELDS).count() == 0 and d.pairs(empty, "id", FIELDS).count() == 0


def test_membership_of_hot_and_other_groups(spark):
    from rosterforge.llm import duplicates as u

    rows = [(i, "Ann", "u", "") for i in range(60)] + [(100 + i, f"p{i // 2}", "u", "") for i in range(40)] + [(900, "alone", "u", None)]
    df = spark.createDataFrame(rows, "id long, name string, url string, mail string")
    got = {r["id"]: (r["representative"], r["copies"], r["is_hot"]) for r in u.membership(df, "id", ("name", "url", "mail"), hot_share=10).collect()}
    assert got == {i: (0, 60, True) for i in range(60)} | {100 + i: (100 + i // 2 * 2, 2, False) for i in range(40)}
