import numpy as np

from billbook.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, score string"


def brute(rows, queries, k):
    ids, matrix = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float32).astype(np.float64)
    found = {}
    for q in queries:
        scores = (matrix * matrix[ids == q][0]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != q][:k]
        found[q] = [(int(ids[j]), float(scores[j])) for j in order]
    return found


def searched(spark, rows, k=20, index=None):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x") for i, v in rows], SCHEMA)
    found = {}
    for r in ann.search(df, df.where("vec_id % 20 = 0"), k, index or ann.CrossPolytope()).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(found.setdefault(r["query_id"], [])) + 1
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    return found


def recall(found, expected):
    return np.mean([len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) / len(expected[q]) for q in expected])


def test_recall_on_random_vectors_of_one_and_many_lengths(spark):
    rng = np.random.default_rng(1)
    units = rng.normal(size=(1500, 64))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    for vectors in (units, units * rng.uniform(0.5, 2.0, (1500, 1))):
        rows = list(enumerate(vectors.astype(np.float32)))
        expected, found = brute(rows, range(0, 1500, 20), 20), searched(spark, rows)
        assert recall(found, expected) >= 0.9
        for q in found:
            known = dict(expected[q])
            assert all(abs(known.get(i, s) - s) < 1e-12 for i, s in found[q])


def test_copies_blocks_and_invalid_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8)) for i in range(60)] + [(i, np.eye(8)[0]) for i in range(100, 160)]
    valid = [(i, np.asarray(v, np.float32)) for i, v in rows]
    rows += [(200, None), (201, np.zeros(8)), (202, [np.nan] * 8), (203, [1.0, None]), (204, [np.inf] * 8), (205, [1.0])]
    rows += [(None, np.ones(8)), (5, rows[5][1])]
    index = ann.CrossPolytope(tables=4, probes=1.0, members_per_block=7, queries_per_block=1)
    assert searched(spark, rows, 20, index) == brute(valid, [0, 20, 40, 100, 120, 140], 20)


def test_each_width_is_searched(spark):
    rng = np.random.default_rng(6)
    narrow = [(i, rng.normal(size=8).astype(np.float32)) for i in range(40)]
    wide = [(i, rng.normal(size=12).astype(np.float32)) for i in range(100, 130)]
    index = ann.CrossPolytope(tables=3, probes=1.0)
    found = searched(spark, [*narrow, *wide, (1000, [1.0] * 65)], 20, index)
    assert found == brute(narrow, [0, 20], 20) | brute(wide, [100, 120], 20)


def test_ties_at_the_border_of_a_block(spark):
    # 400 different vectors have the same product with the query; the smallest ids are last in no order.
    rng = np.random.default_rng(4)
    codes = {tuple(c) for c in rng.integers(0, 2, (2000, 12))}
    vectors = [np.array([1.0, *c, *[1 - x for x in c]]) for c in sorted(codes)][:400]
    rows = [(20 * 400, np.eye(25)[0])] + [(20 * int(i) + 1, v) for i, v in zip(rng.permutation(400), vectors, strict=True)]
    index = ann.CrossPolytope(tables=1, probes=1.0)
    found = searched(spark, rows, 20, index)
    assert [i for i, _ in found[8000]] == [20 * i + 1 for i in range(20)]


def test_fewer_candidates_than_asked(spark):
    rows = [(i, np.eye(16)[i % 16]) for i in (0, 1, 2, 20)]
    found = searched(spark, rows, 20, ann.CrossPolytope(tables=1, probes=0.0))
    assert {q: [i for i, _ in r] for q, r in found.items()} == {0: [1, 2, 20], 20: [0, 1, 2]}
    assert searched(spark, rows[:1]) == {} and searched(spark, []) == {}


def test_hadamard_keeps_lengths():
    rows = np.random.default_rng(3).normal(size=(5, 32))
    turned = ann.rotated(rows, 1, 7)
    assert np.allclose(turned @ turned.T, rows @ rows.T)
