"""Differences of two tables by digests, against a plain comparison."""

import random
from collections import Counter

import pytest

from assaylake.operators import reconcile

SCHEMA = "a int, b string, x long, y string"


def brute(left, right):
    def bags(table):
        out = {}
        for a, b, *rest in table:
            out.setdefault((a, b), []).append(tuple(rest))
        return out

    one, two, found = bags(left), bags(right), []
    for k in one.keys() | two.keys():
        l, r = one.get(k, []), two.get(k, [])
        if Counter(l) == Counter(r):
            continue
        changed = [n for i, n in enumerate("xy") if Counter(v[i] for v in l) != Counter(v[i] for v in r)]
        found.append((*k, len(l), len(r), ",".join(changed) if l and r else ""))
    return sorted(found, key=repr)


def got(spark, left, right, **options):
    one, two = (spark.createDataFrame(t, SCHEMA) for t in (left, right))
    return sorted((tuple(r) for r in reconcile.table_differences(one, two, ["a", "b"], **options).collect()), key=repr)


@pytest.mark.parametrize("fan", [1, 4, 256])
def test_differences_against_brute_force(spark, fan):
    rng = random.Random(fan)
    left = [(rng.choice([None, k % 90]), rng.choice([None, "p", "q"]), rng.choice([None, 1, 2]), rng.choice([None, "", "z"]))
            for k in range(400)]
    right = [r for r in left if rng.random() > 0.03] + rng.choices(left, k=5)
    right = [(a, b, y if rng.random() < 0.05 else x, z) for (a, b, x, z), y in zip(right, rng.choices([None, 7], k=len(right)), strict=True)]
    right += [(1000, "new", 1, "n")]
    rng.shuffle(right)
    want = brute(left, right)
    assert len(want) > 10 and got(spark, left, right, fan=fan) == want


def test_equal_and_empty_tables(spark):
    rows = [(k % 7, "p", k, None) for k in range(50)]
    assert got(spark, rows, rows[::-1]) == []
    assert got(spark, rows, []) == brute(rows, [])
    assert got(spark, [], rows) == brute([], rows)
    assert got(spark, [], []) == []
    # values do not trade places with nulls, nor repeated rows with each other
    assert len(got(spark, [(1, "p", None, "5")], [(1, "p", 5, None)])) == 1
    assert len(got(spark, [(1, "p", 1, "a")] * 2, [(1, "p", 2, "a")] * 2)) == 1
    assert len(got(spark, [(1, "p", 1, "a")] * 3, [(1, "p", 1, "a")])) == 1


def test_types_and_columns(spark):
    one = spark.createDataFrame([(1, 5, "u")], "id long, n long, other string")
    two = spark.createDataFrame([(1, 5, "v")], "id int, n int, other string")
    assert reconcile.table_differences(one, two, ["id"], ["n"]).collect() == []
    assert [r["changed"] for r in reconcile.table_differences(one, two, ["id"]).collect()] == ["other"]
    assert reconcile.table_differences(one, two, ["id"], []).collect() == []
