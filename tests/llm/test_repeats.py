import tempfile
from collections import Counter

import numpy as np
import pytest

from billbook.llm import anchors, induced, repeats
from billbook.llm.common import importable

SCHEMA = "doc_id bigint, text string, kept string"


def brute(texts, length):
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    found = []
    for t in texts:
        marks = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                marks[i : i + length] = b"\x01" * length
        spans = sum(1 for i in range(len(t)) if marks[i] and not (i and marks[i - 1]))
        found.append((len(t), spans, bytes(c for c, m in zip(t, marks, strict=True) if not m)))
    return found


def ordered(data, depth, memory):
    with tempfile.TemporaryDirectory() as folder:
        blocks = list(induced.suffixes(data, folder, depth, memory))
    join = lambda i: np.concatenate([b[i] for b in blocks])[::-1].tolist() if blocks else []
    return join(0), join(1)


@pytest.mark.parametrize(("block", "memory"), [(1 << 18, 1 << 26), (7, 1 << 26), (50, 100)])
def test_induced_order_and_common_prefixes(monkeypatch, block, memory):
    monkeypatch.setattr(induced, "BLOCK", block)
    rng = np.random.default_rng(block)
    for trial in range(40):
        data = rng.integers(97, 97 + int(rng.integers(1, 5)), int(rng.integers(1, 300))).astype(np.uint8)
        if trial % 3 == 0:
            data = np.tile(data[: max(1, len(data) // 4)], 5)
        depth, text = int(rng.choice([3, 8, 200])), data.tobytes()
        places, common = ordered(data, depth, memory)
        assert sorted(places) == list(range(len(text)))
        keys = [text[p : p + depth] for p in places]
        assert keys == sorted(keys)
        for i, (a, b) in enumerate(zip(keys, keys[1:], strict=False)):
            same = next((j for j, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert common[i] == same
    assert ordered(np.zeros(0, np.uint8), 200, memory) == ([], [])


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(4)
    shared = rng.integers(0, 255, 400).astype(np.uint8)
    for lead in (0, 1, 77, 5000):
        data = np.concatenate((rng.integers(0, 255, lead).astype(np.uint8), shared))
        first, last, value = anchors.runs(data, np.array([len(data)]), 200)
        starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last, strict=True)])
        assert (starts == np.arange(lead + 201)).all()
        own = np.repeat(value, last - first + 1)[lead:]
        if lead:
            assert (own == before).all()
        before = own


def test_same_as_brute_force_in_chunks_and_shards(spark):
    importable(spark)
    rng = np.random.default_rng(5)
    passage = "".join(rng.choice(list("abcdé "), 300))
    texts = ["ab" * 300, None, "", "x" * 199, "x" * 199, "é" * 150, "é" * 150, "a" * 2000, "hello world " * 40]
    texts += ["".join(rng.choice(list("abcd "), 150)) + passage + "".join(rng.choice(list("abcd "), 80)) for _ in range(30)]
    texts += [texts[-1], passage[:250], "n\x00ul" * 60]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, passage, None), (3, passage, None), (3, passage, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    expected = brute([(t or "").encode() for _, t, _ in rows], 200)
    for sizes in ({}, {"chunk_bytes": 500, "shard_bytes": 900}):
        found = repeats.deduplicate(docs, 200, **sizes).collect()
        got = sorted((r["n_bytes"], len(r["spans"]), bytes(r["kept"])) for r in found)
        assert got == sorted(expected)
        for r in found:
            assert sum(s["length"] for s in r["spans"]) == r["n_bytes"] - len(r["kept"])


def test_texts_keep_their_rows_and_columns(spark):
    importable(spark)
    docs = spark.createDataFrame([(1, "é" * 300, "a"), (2, None, "b"), (2, "ok", None)], "doc_id int, text string, lang string")
    found = repeats.without_repeats(docs)
    assert sorted(found.columns) == ["doc_id", "lang", "text"]
    assert sorted(((r["doc_id"], r["text"], r["lang"]) for r in found.collect()), key=str) == [
        (1, "", "a"), (2, "", "b"), (2, "ok", None),
    ]
    assert repeats.without_repeats(docs.limit(0)).collect() == []


def test_a_character_that_is_cut_into_is_left_out(spark):
    importable(spark)
    tail = "z" * 230
    docs = spark.createDataFrame([(1, "begin é" + tail), (2, "other ©" + tail)], "doc_id int, text string")
    found = dict(repeats.without_repeats(docs).select("doc_id", "text").collect())
    assert found == {1: "begin ", 2: "other "}


@pytest.mark.parametrize("length", [0, 63, 255, 300])
def test_lengths_beyond_the_method_are_refused(spark, length):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    with pytest.raises(ValueError, match="64 to 254"):
        repeats.deduplicate(docs, length)


def test_texts_are_not_shuffled(spark):
    importable(spark)
    docs = spark.createDataFrame([(i, f"text {i} " * 50, None) for i in range(20)], SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = repeats.deduplicate(docs, chunk_bytes=2_000, shard_bytes=4_000)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line for line in plan.toString().splitlines() if "Exchange" in line]
    assert len(moved) == 2 and all("REPARTITION_BY_NUM" in line for line in moved)  # both kinds of answers
