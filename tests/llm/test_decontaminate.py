import random
import re

import pytest

from billbook.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id bigint, text string, window string"
ITEMS = "item_id bigint, text string"


def words(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return WORD.findall(lower)


def brute(docs, items, length):
    windows = {}
    for item, text in items:
        own = words(text)
        for i in range(max(1, len(own) - length + 1)):
            if own:
                windows.setdefault(tuple(own[i : i + length]), set()).add(item)
    out = []
    for doc, text, _ in docs:
        own, hit, found = words(text), set(), set()
        for window, ids in windows.items():
            for i in range(len(own) - len(window) + 1):
                if tuple(own[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= ids
        out.append((doc, len(own), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=str)


@pytest.mark.parametrize("broadcast_bytes", [decontaminate.BROADCAST_BYTES, 0])
def test_same_as_brute_force(spark, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", broadcast_bytes)
    random.seed(3)
    text = lambda n: " ".join(random.choice("a b c D É word,").strip() or "x" for _ in range(n))
    items = [(i, text(random.randint(0, 9))) for i in range(12)] + [(3, "a b c"), (None, "c d c"), (99, None)]
    docs = [(i, text(random.randint(0, 60)), "x") for i in range(40)]
    docs += [(7, docs[7][1], "x"), (7, "a b c", None), (None, "a b c d", None), (100, None, None), (101, "", None)]
    docs.append((102, " ".join(["a"] * 3000 + ["b", "c"]), None))
    found = decontaminate.contamination(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), 4
    ).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(docs, items, 4)


def test_shuffled_rows_carry_contexts_and_not_texts(spark):
    docs = spark.createDataFrame([(1, "a b " * 20_000, "x")], DOCS)
    terms = spark.createDataFrame([("b",)], "term string")
    shuffled, broadcast = (decontaminate._postings(docs, terms, small, 3) for small in (False, True))
    join = shuffled._jdf.queryExecution().optimizedPlan()
    while join.nodeName() != "Join":
        join = join.children().apply(0)
    sides = [join.children().apply(i).output().mkString(" ") for i in (0, 1)]
    assert "context" in " ".join(sides) and "words" not in " ".join(sides)
    rows = [sorted(df.select("pos", "context", "at").collect()) for df in (shuffled, broadcast)]
    assert rows[0] == rows[1] and len(rows[0]) == 20_000
    assert max(len(r["context"]) for r in rows[0]) == 7


def test_nothing_to_find(spark):
    none, docs = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b", "x")], DOCS)
    items, no_items = spark.createDataFrame([(1, "a b")], ITEMS), spark.createDataFrame([], ITEMS)
    assert decontaminate.contamination(none, items).collect() == []
    assert [tuple(r) for r in decontaminate.contamination(docs, no_items).collect()] == [(1, 2, 0, [])]
    assert decontaminate.without_contaminated(docs, items).collect() == []
    assert decontaminate.without_contaminated(docs, no_items).collect() == docs.collect()


def test_proximity_takes_any_order_within_reach(spark):
    docs = spark.createDataFrame([(1, "x gamma one beta two alpha y", ""), (2, "alpha 1 2 3 4 5 beta gamma", "")], DOCS)
    items = spark.createDataFrame([(1, "alpha beta gamma")], ITEMS)
    lookups = decontaminate.lookups_of(docs, decontaminate.windows_of(items))
    index = decontaminate.build_index(docs, lookups, 4)
    assert [r["doc"]["doc_id"] for r in decontaminate.proximity_matches(index, lookups, 2).collect()] == [1]
    assert decontaminate.phrase_matches(index, lookups).collect() == []
