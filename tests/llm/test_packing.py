import random
from collections import defaultdict

from rosterforge.llm import packing as p


def check(rows, sizes, capacities):
    of = dict(capacities)
    filled, pieces = defaultdict(int), defaultdict(list)
    for r in rows:
        filled[r["size_id"], r["container_id"]] += r["n_tokens"]
        pieces[r["size_id"], r["id"]].append(r["n_tokens"])
    assert all(n <= of[s] for (s, _), n in filled.items())
    for s, c in capacities:
        for i, n in sizes:
            assert sum(pieces[s, i]) == (n or 0)
            assert (n or 0) > c or len(pieces[s, i]) == 1
    return filled


def test_every_item_fits_and_only_large_ones_are_split(spark):
    random.seed(5)
    sizes = [(i, random.choice([None, 0, 5, 40, 99, 100, 101, 350])) for i in range(400)]
    capacities = [(1, 100), (2, 1000)]
    rows = p.pack(spark.createDataFrame(sizes, "id long, n_tokens long"), capacities).collect()
    filled = check(rows, sizes, capacities)
    total = sum(n or 0 for _, n in sizes)
    assert sum(1 for s, _ in filled if s == 2) <= total / 1000 * 1.1 + 2
    again = p.pack(spark.createDataFrame(sizes, "id long, n_tokens long"), capacities).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_best_fit_and_fullest_closes_first():
    fit = p.BestFit(10, 0, most=2)
    assert [list(fit.place(n))[0][0] for n in (7, 4, 3, 6)] == [0, 1, 0, 1]
    fit = p.BestFit(10, 0, most=2)
    list(fit.place(7)), list(fit.place(6)), list(fit.place(5))  # the one with 7 closes
    assert list(fit.place(3)) == [(1, 0, 3)]


def test_empty_and_unusable(spark):
    empty = spark.createDataFrame([], "id long, n_tokens long")
    assert p.pack(empty, [(1, 10)]).count() == 0
    assert p.pack(spark.createDataFrame([(1, 5)], "id long, n_tokens long"), [(1, None), (2, 0)]).count() == 0
