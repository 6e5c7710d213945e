"""The manifest against a tree built in plain Python."""

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from billbook.llm import merkle

COLUMNS = "lang string, doc_id bigint, leaf string, note string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def record(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(level, fanout):
    """The root, and each node's steps as (before, after)."""
    paths = [[] for _ in level]
    at = list(range(len(level)))
    while len(level) > 1:
        for leaf, node in enumerate(at):
            first = node // fanout * fanout
            run = level[first:first + fanout]
            paths[leaf].append(("".join(run[:node - first]), "".join(run[node - first + 1:])))
        level = [h(*level[i:i + fanout]) for i in range(0, len(level), fanout)]
        at = [node // fanout for node in at]
    return level[0], paths


def expected(rows, fanout=2):
    key = lambda v: (v is not None, "" if v is None else str(v).encode())
    groups = sorted({r[0] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in groups:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        trees[g] = own, *climb([r[2] for r in own], fanout)
    if not groups:
        return []
    root, above = climb([trees[g][1] for g in groups], fanout)
    out = []
    for g, up in zip(groups, above):
        own, subroot, paths = trees[g]
        out += [(*r, subroot, root, tuple(p + up)) for r, p in zip(own, paths)]
    return sorted(out, key=lambda r: [key(v) for v in r[:4]] + [r[6]])


def found(spark, rows, fanout=2):
    df = spark.createDataFrame(rows, COLUMNS).withColumn("tree", F.lit(1)).withColumn("pos", F.lit("x"))
    got = merkle.manifest(df, "lang", "doc_id", "leaf", ["note"], fanout).collect()
    key = lambda v: (v is not None, "" if v is None else str(v).encode())
    rows = [(r.lang, r.doc_id, r.leaf, r.note, r.subroot, r.root, tuple((s.before, s.after) for s in r.path)) for r in got]
    return sorted(rows, key=lambda r: [key(v) for v in r[:4]] + [r[6]])


def rows_of(sizes):
    return [(g, i * 3, h(str(g), str(i)), f"n{i}") for g, n in sizes.items() for i in range(n)]


@pytest.mark.parametrize("fanout", [2, 3, 5, 20])
def test_trees_of_many_heights(spark, fanout):
    rows = rows_of({None: 1, "": 2, "a": 3, "de": 17, "é": 33, "z": 300})
    assert found(spark, rows, fanout) == expected(rows, fanout)


def test_one_leaf_is_its_own_root(spark):
    (row,) = found(spark, rows_of({"a": 1}))
    assert row[4] == row[5] == row[2] and row[6] == ()


def test_empty(spark):
    assert found(spark, []) == []


def test_repeated_rows_ties_and_nulls_each_have_a_place(spark):
    rows = [(None, None, h("x"), None)] * 3 + [("a", 1, h("p"), "n")] * 40 + [("a", 1, h("o"), "n"), ("a", None, h("o"), "n")]
    assert found(spark, rows) == expected(rows)


def test_more_groups_than_partitions(spark):
    rows = rows_of({f"g{i:03}": 1 + i % 3 for i in range(150)})
    assert found(spark, rows) == expected(rows)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([None, "a", "B"]), st.one_of(st.none(), st.integers(-5, 5))), max_size=40))
def test_any_rows(spark, keys):
    rows = [(g, d, h(str(g), str(d)), None) for g, d in keys]
    assert found(spark, rows) == expected(rows)


def test_fold_tells_a_changed_leaf(spark):
    df = spark.createDataFrame(rows_of({"a": 9, "b": 4}), COLUMNS)
    got = merkle.manifest(df, "lang", "doc_id", "leaf").select(
        (merkle.folded(F.col("leaf"), F.col("path")) == F.col("root")).alias("same"),
        (merkle.folded(F.lit(h("other")), F.col("path")) == F.col("root")).alias("other"),
    )
    assert {tuple(r) for r in got.collect()} == {(True, False)}


def test_record_digest(spark):
    rows = [(1, None, "é", "x" * 200_000), (None, "a", "", "1:b"), (-5, "-", "-", None)]
    df = spark.createDataFrame(rows, "a bigint, b string, c string, d string")
    got = [r[0] for r in df.select(merkle.record_digest([F.col(c) for c in "abcd"])).collect()]
    assert got == [record(*r) for r in rows]


def test_a_run_of_one_is_refused(spark):
    with pytest.raises(ValueError):
        merkle.manifest(spark.createDataFrame([], COLUMNS), "lang", "doc_id", "leaf", fanout=1)
