import numpy as np

from billbook.llm import langid
from billbook.llm.common import importable

SCHEMA = "doc_id bigint, text string, lang string, score string"


def test_held_out_accuracy(spark):
    from billbook.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.01"
    lang = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect())
    rows = QUERIES["op10_language_id"](spark, sf_dir).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97


def test_no_letters_nulls_and_other_columns(spark):
    importable(spark)
    train = [(1, "the cat and the hat", "en", ""), (2, "der hund und die katze", "de", ""), (3, None, "en", ""), (4, "xx", None, "")]
    prototypes = langid.learn(spark.createDataFrame(train, SCHEMA))
    assert sorted(prototypes) == ["de", "en"]
    asked = [(1, "the HAT", "zz", ""), (1, "the HAT", "zz", ""), (None, "und der", None, ""), (5, None, "en", ""), (6, "", "", ""), (7, "12 -- !", "", "")]
    found = langid.identify(spark.createDataFrame(asked, SCHEMA), prototypes)
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert [(r["doc_id"], r["lang_pred"]) for r in found.collect()] == [
        (1, "en"), (1, "en"), (None, "de"), (5, "und"), (6, "und"), (7, "und"),
    ]
    none = langid.learn(spark.createDataFrame([], SCHEMA))
    assert none == {} and langid.identify(spark.createDataFrame(asked, SCHEMA), none).first()["lang_pred"] == "und"
    assert langid.identify(spark.createDataFrame([], SCHEMA), prototypes).collect() == []


def test_a_bundle_is_the_sum_of_bound_vectors(monkeypatch):
    profile = langid.Profile(dimensions=64)
    text = "Abc, déf 9 " * 40 + "z"
    whole = langid._Space(profile).bundles([text, None, "a"])
    space = langid._Space(profile)
    list(space.codes(text))
    blank = np.random.default_rng([profile.seed]).integers(0, 2, 64, np.int8) * 2 - 1
    letters = [0] + [c for c in text.lower() if c.isalpha() or c == " "] + [0]
    marks = "".join(c if c != 0 else " " for c in letters)
    marks = " " + " ".join(marks.split()) + " "
    vector = lambda c: blank if c == " " else space.vectors[space.by_fold[c]]
    expected = sum(
        (np.roll(vector(a), 2) * np.roll(vector(b), 1) * vector(c)).astype(int) for a, b, c in zip(marks, marks[1:], marks[2:], strict=False)
    )
    assert (whole[0] == expected).all() and not whole[1].any()
    # Parts and small tables change nothing.
    monkeypatch.setattr(langid, "PART", 7)
    monkeypatch.setattr(langid, "KEPT", 10)
    assert (langid._Space(profile).bundles([text, None, "a"]) == whole).all()
