import random

from pyspark.sql import functions as F

from rosterforge.llm import levels as v

EASY = ["看，小鱼！", "我有三个球。", "天很高。"]
HARD = ["设若将自我指涉视作潜变量，并以同调代数工具刻画其与交互设计的耦合强度，则可证边界敏感性在弱正则条件下几乎处处成立。"]


def corpus():
    random.seed(6)
    rows = []
    for i in range(120):
        pool = EASY if i % 2 else HARD
        rows.append((i, "".join(random.choice(pool) for _ in range(random.randint(3, 9)))))
    return rows


def test_held_out_levels(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows] + [(900, None, "x"), (901, "　\n", "x"), (902, "!!!", "x")], "doc_id long, text string, level string")
    labels = spark.createDataFrame([(i, 1 if i % 2 else 5) for i, _ in rows[:60]] + [(1, None), (2, 5)], "doc_id long, level long")
    got = {r["id"]: r["level"] for r in v.reading_levels(docs.drop("level"), labels, "doc_id", "text").collect()}
    assert set(got) == {i for i, _ in rows} | {902}
    assert sum(got[i] == (1 if i % 2 else 5) for i, _ in rows[60:]) >= 57


def test_without_labels_level_three(spark):
    docs = spark.createDataFrame(corpus()[:4], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, level long")
    assert {r["level"] for r in v.reading_levels(docs, labels, "doc_id", "text").collect()} == {3}


def test_small_vocabulary_gives_the_same_ranks(spark):
    docs = spark.createDataFrame(corpus(), "id long, text string")
    whole = {r["id"]: tuple(r) for r in v.features(docs).collect()}
    for most in (0, 3, 20):
        assert {r["id"]: tuple(r) for r in v.features(docs, most).collect()} == whole


def test_ranks_against_brute_force(spark):
    docs = spark.createDataFrame(corpus(), "id long, text string")
    counts = {r["word"]: r["n"] for r in v.word_counts(docs).collect()}
    rank = v.ranks_of_frequencies(spark.createDataFrame(list(counts.items()), "word string, n long"))
    for n, r in rank.items():
        assert r == 1 + sum(m > n for m in counts.values())


def test_scan_and_words_agree():
    for _, t in corpus():
        assert sorted(v.scan(t)[0]) == sorted(v.words(t))


def test_very_long_text(spark):
    docs = spark.createDataFrame([(1, EASY[0] * 50000)], "id long, text string")
    assert v.features(docs).select(F.col("cover_95")).first()[0] >= 0
