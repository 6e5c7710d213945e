import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from billbook.llm import lm
from billbook.llm.common import importable
from billbook.llm.elias_fano import EliasFano

SCHEMA = "doc_id bigint, text string, train boolean, score int"


def brute(rows):
    tokens = [bytes(t or "", "utf-8").lower().split() + [None] for _, t, *_ in rows]
    words, pairs, contexts = Counter(), Counter(), Counter()
    for (_, _, train, *_), own in zip(rows, tokens, strict=True):
        if train:
            words.update(own)
            pairs.update(zip([0, *own], own))
            contexts.update([0, *own[:-1]])
    n, v, found = sum(words.values()), len(words), []
    for (doc, *_), own in zip(rows, tokens, strict=True):
        base = [(words[w] + 1) / (n + v + 1) for w in own]
        smooth = [(pairs[p, w] + lm.MU * b) / (contexts[p] + lm.MU) for p, w, b in zip([0, *own], own, base)]
        found.append((doc, len(own), sum(words[w] > 0 for w in own), n, sum(map(math.log10, base)), sum(map(math.log10, smooth))))
    return found


def same(found, expected):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[4])
    found, expected = sorted((tuple(r) for r in found), key=key), sorted(expected, key=key)
    assert [r[:4] for r in found] == [r[:4] for r in expected]
    assert [r[4] for r in found] == pytest.approx([r[4] for r in expected])
    assert [r[5] for r in found] == pytest.approx([r[5] for r in expected], rel=1e-3, abs=1e-3)


def rows_of(n):
    rng = np.random.default_rng(n)
    vocabulary = np.array([f"W{i}" for i in range(60)] + ["é", "The"])
    weights = 1 / np.arange(1, 63)
    text = lambda: " ".join(rng.choice(vocabulary, rng.integers(0, 40), p=weights / weights.sum()))
    return [(i, text(), bool(i % 3), 0) for i in range(n)]


@pytest.mark.parametrize(("chunk", "shard"), [(10**6, 10**6), (300, 200), (50, 40)])
def test_same_as_brute_force(spark, chunk, shard):
    importable(spark)
    rows = rows_of(80) + [(None, "w1 w2", True, 0), (5, None, True, 0), (5, "", False, 0), (6, "new", None, 0), (6, "new", None, 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    same(lm.score(docs, F.col("train"), chunk, shard).collect(), brute(rows))


def test_nothing_learnt_and_nothing_given(spark):
    importable(spark)
    docs = spark.createDataFrame([(1, "a b", False, 0)], SCHEMA)
    row = lm.score(docs, F.col("train")).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"], row["score"]) == (3, 0, 0, 0.0, 0.0)
    assert lm.score(docs.limit(0), F.col("train")).collect() == []


def test_probabilities_after_a_context_add_up(spark):
    importable(spark)
    train = [(i, "a b a c a b", True, 0) for i in range(5)]
    asked = [(100 + i, f"a {w}".strip(), False, 0) for i, w in enumerate(["a", "b", "c", "unknown", ""])]
    found = {r["doc_id"]: r["score"] for r in lm.score(spark.createDataFrame(train + asked, SCHEMA), F.col("train")).collect()}
    expected = {r[0]: r[5] for r in brute(train + asked)}
    assert all(abs(found[k] - expected[k]) < 1e-3 for k in found)


@pytest.mark.parametrize("top", [1, 5, 100, 2**20, 2**40, 2**63 - 1])
def test_elias_fano(top):
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 5000):
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        coded = EliasFano.of(values)
        assert (coded.get(np.arange(n)) == values).all()
        asked = np.concatenate((values, rng.integers(0, top, 50, dtype=np.uint64)))
        found = coded.find(asked, np.zeros(len(asked), np.int64), np.full(len(asked), n))
        for x, at in zip(asked.tolist(), found.tolist(), strict=True):
            assert (at >= 0) == (x in values) and (at < 0 or values[at] == x)
        assert (coded.find(asked, np.full(len(asked), n), np.full(len(asked), n)) == -1).all()


def test_held_out_texts_are_likelier_than_by_words_alone(spark):
    from billbook.llm.queries import QUERIES

    rows = QUERIES["op9_lm_scoring"](spark, "/root/testdata/sf0.001").where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)
