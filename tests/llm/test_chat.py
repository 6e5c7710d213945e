import pytest
from pyspark.sql import functions as F

from billbook.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string"
PIECES = ["</s>", "<!/s>", "<!!/s>", "[INST]", "[!/INST]", "<|im_end|>", "<|im_sep|>", "<|im_start|>", "<", "!", "a\n", "é", ""]


def formatted(spark, rows):
    template = chat.ChatTemplate()
    done = chat.format_chats(spark.createDataFrame(rows, SCHEMA), template)
    loss = template.loss_text(F.col("formatted"), F.col("loss_spans"))
    return {
        r["conv_id"]: r
        for r in done.select("*", template.parsed(F.col("formatted")).alias("back"), loss.alias("loss")).collect()
    }


def test_contents_come_back_whatever_they_are(spark):
    texts = [a + b + c for a in PIECES for b in PIECES for c in PIECES]
    rows = [(i, 0, text, text, None) for i, text in enumerate(texts)]
    rows += [(i, 1, "assistant", text, None) for i, text in enumerate(texts)]
    found = formatted(spark, rows)
    for i, text in enumerate(texts):
        assert [tuple(t) for t in found[i]["back"]] == [(text, text), ("assistant", text)]
        assert found[i]["loss"] == text
        inner = found[i]["formatted"]
        assert inner.count("<|im_start|>") == inner.count("<|im_end|>") == 2
        assert "</s>" not in inner and "[INST]" not in inner


def test_nulls_ties_and_order(spark):
    rows = [
        (1, 2, "user", "late", "x"), (1, None, "system", "first", "x"), (1, 1, "b", "2", None),
        (1, 1, "a", "3", None), (1, 1, "a", "3", None), (2, 0, None, None, None), (None, 0, "assistant", "", None),
    ]
    found = formatted(spark, rows)
    assert [tuple(t) for t in found[1]["back"]] == [
        ("system", "first"), ("a", "3"), ("a", "3"), ("b", "2"), ("user", "late"),
    ]
    assert [tuple(t) for t in found[2]["back"]] == [("", "")]
    assert found[None]["loss"] == "" and len(found[None]["loss_spans"]) == 1
    assert formatted(spark, []) == {}


def test_only_conflicts_are_escaped(spark):
    found = formatted(spark, [(1, 0, "user", "plain ! <b>", None), (2, 0, "user", "<s>", None)])
    assert not found[1]["escaped"] and "plain ! <b>" in found[1]["formatted"]
    assert found[2]["escaped"] and "<!s>" in found[2]["formatted"]


def test_a_template_refuses_what_it_cannot_escape():
    with pytest.raises(ValueError):
        chat.ChatTemplate(controls=("!x",))
    with pytest.raises(ValueError):
        chat.ChatTemplate(controls=("<",))
