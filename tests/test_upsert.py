import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from assaylake.operators.upsert import (
    MergeConflict,
    merge_conflicts,
    merge_into,
    require_no_conflicts,
    upsert,
    with_merge_key,
)

SCHEMA = "id long, a string, b long"


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def test_match_insert_and_keep(spark):
    t = frame(spark, [(1, "t1", 1), (2, "t2", 2), (None, "tn", 0)])
    s = frame(spark, [(2, None, 20), (3, "s3", 30), (None, "sn", 9)])
    everything = upsert(t, s, "id")
    assert rows(everything) == [
        (1, "t1", 1), (2, None, 20), (3, "s3", 30), (None, "sn", 9), (None, "tn", 0)]
    # only b is updated; a keeps its first value, but is inserted for new rows
    assert rows(upsert(t, s, "id", ["b"]))[1:3] == [(2, "t2", 20), (3, "s3", 30)]
    assert (None, "sn", 9) not in rows(upsert(t, s, "id", drop_null_keys=True))


def test_again_changes_nothing_but_null_keys(spark):
    t = frame(spark, [(1, "t1", 1)])
    s = frame(spark, [(1, "s1", 2), (2, "s2", 3)])
    once = upsert(t, s, "id")
    assert rows(upsert(once, s, "id")) == rows(once)
    s = frame(spark, [(None, "n", 1)])
    once = upsert(t, s, "id")
    assert upsert(once, s, "id").count() == once.count() + 1


def test_broadcast_form_gives_the_same_rows(spark):
    t = frame(spark, [(i, f"t{i}", i) for i in range(50)] + [(None, "tn", 0)])
    s = frame(spark, [(i, None if i % 2 else f"s{i}", i * 10) for i in range(40, 70)] + [(None, "x", 1)])
    plain = rows(upsert(t, s, "id", ["b"]))
    assert rows(upsert(t, s, "id", ["b"], broadcast_rows=100)) == plain
    # over the bound: falls back to the shuffled join
    over = upsert(t, s, "id", ["b"], broadcast_rows=5)
    assert rows(over) == plain


def test_composite_keys_match_on_null_parts(spark):
    schema = "u long, y int, k int, v long"
    t = frame(spark, [(1, 2020, None, 1), (1, 2020, 1, 2), (None, None, 3, 3)], schema)
    s = frame(spark, [(1, 2020, None, 10), (2, 2020, 1, 20), (None, None, 3, 30)], schema)
    keys = ("u", "y", "k")
    once = upsert(t, s, keys)
    assert rows(once) == [(1, 2020, 1, 2), (1, 2020, None, 10), (2, 2020, 1, 20), (None, None, 3, 30)]
    assert rows(upsert(once, s, keys)) == rows(once)
    assert rows(upsert(t, s, keys, drop_null_keys=True)) == [
        (1, 2020, 1, 2), (1, 2020, None, 1), (2, 2020, 1, 20), (None, None, 3, 3)]


def test_target_schema_rules(spark):
    t = frame(spark, [(1, "a", 1)])
    s = frame(spark, [("x", 2, 5, 3)], "A string, id int, b int, extra int")
    out = upsert(t, s, "id")
    assert out.schema.simpleString() == t.schema.simpleString()
    assert rows(out) == [(1, "a", 1), (2, "x", 5)]
    with pytest.raises(ValueError, match="lacks target columns"):
        upsert(t, s.drop("b"), "id")
    with pytest.raises(ValueError, match="lacks update columns"):
        upsert(t, s, "id", ["zzz"])


def test_conflicts(spark):
    t = frame(spark, [(1, "a", 1), (2, "b", 2), (None, "n", 0)])
    s = frame(spark, [(1, "x", 1), (1, "y", 1), (3, "z", 1), (3, "z", 2), (2, "w", 1),
                      (None, "p", 1), (None, "q", 1)])
    assert rows(merge_conflicts(t, s, "id")) == [(1, 2)]
    with pytest.raises(MergeConflict, match="'id': 1"):
        require_no_conflicts(t, s, "id")
    require_no_conflicts(t, s.filter("id <> 1"), "id")


def test_merge_key_leaves_nulls_out(spark):
    df = frame(spark, [(5, None, 2019), (None, "a", 1)], "u long, t string, y long")
    assert [r.merge_key for r in with_merge_key(df, "u", "t", "y").collect()] == ["5_2019", "a_1"]


def test_row_level_merge_resolves_and_is_refused_by_plain_tables(spark, namespaces):
    spark.sql("create schema silver")
    frame(spark, [(1, "a", 1)]).write.saveAsTable("silver.plain")
    for keys in ("id", ["id", "b"]):
        with pytest.raises(Exception) as e:
            merge_into(frame(spark, [(1, "x", 1)]), "silver.plain", keys)
        # every column was found; only the kind of table is not suited
        assert e.value.getCondition() == "UNSUPPORTED_FEATURE.TABLE_OPERATION"


record = st.tuples(
    st.one_of(st.none(), st.integers(0, 6)),
    st.one_of(st.none(), st.sampled_from("xyz")),
    st.one_of(st.none(), st.integers(0, 3)),
)
table = st.lists(record, max_size=8, unique_by=lambda r: r[0] if r[0] is not None else object())


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(t=table, s=table, cols=st.sets(st.sampled_from(["a", "b"])), small=st.booleans())
def test_equals_a_dictionary(spark, t, s, cols, small):
    names = ["id", "a", "b"]
    by_key = {r[0]: dict(zip(names, r)) for r in s if r[0] is not None}
    expected = []
    for r in t:
        row = dict(zip(names, r))
        match = by_key.pop(r[0], None) if r[0] is not None else None
        if match:
            row.update({c: match[c] for c in cols})
        expected.append(tuple(row.values()))
    expected += [tuple(m.values()) for m in by_key.values()]
    expected += [r for r in s if r[0] is None]
    got = upsert(frame(spark, t), frame(spark, s), "id", sorted(cols),
                 broadcast_rows=100 if small else None)
    assert rows(got) == sorted(expected, key=repr)
