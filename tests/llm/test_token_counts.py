import subprocess
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from billbook.llm import token_counts
from billbook.llm.common import ROOT, importable

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_odd_characters_and_special_strings(spark, library):
    importable(spark)
    tokenizer = token_counts._tokenizer(PATH)
    ranges = token_counts.odd_characters(tokenizer, public_tokenizers.PATTERN)
    odd = "".join(f" a{chr(a)}{chr(b)}1 " for a, b in ranges)
    texts = ["Hello wörld", "a<|endoftext|>b <|endoftext|>", odd, "", None, "  \n\t x  ", "y" * 3000, "z" * 40 + " é"]
    docs = spark.createDataFrame(
        [(i, t, 0) for i, t in enumerate(texts)] + [(None, "same same same", 1), (0, "Hello", 1)],
        "doc_id bigint, text string, n_tokens int",
    )
    for frequent, fit_rows in ((0, 100), (2, 100), (65_536, 3), (65_536, 100)):
        rows = token_counts.count_tokens(docs, PATH, public_tokenizers.PATTERN, frequent, fit_rows).collect()
        expected = sorted(
            (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
            for t in [*texts, "same same same", "Hello"]
        )
        assert sorted((r["n_bytes"], r["n_tokens"]) for r in rows) == expected
    assert token_counts.count_tokens(docs.limit(0), PATH, public_tokenizers.PATTERN).collect() == []


def test_a_full_cache_is_emptied(library, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED", 3)
    lookup = token_counts._Lookup(token_counts.LengthTable([" b"], [1], []), PATH)
    for text in ("a b c d", "a b x y z", "a a a q r s t u"):
        pieces = [p if i == 0 else " " + p for i, p in enumerate(text.split())]
        assert lookup.tokens(text, pieces) == len(library.encode(text).ids)


def test_whole_texts_of_the_tables(spark, library):
    importable(spark)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    for r in token_counts.count_tokens(docs, PATH, public_tokenizers.PATTERN).collect():
        assert r["n_tokens"] == len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)


def test_a_task_starts_no_threads_of_its_own():
    script = f"""
import os
from billbook.llm import token_counts
lookup = token_counts._Lookup(token_counts.LengthTable([], [], []), {PATH!r})
before = len(os.listdir("/proc/self/task"))
assert len(lookup.learn({{f" new{{i}}word" for i in range(500)}})) == 0 and len(lookup) == 500
assert len(os.listdir("/proc/self/task")) == before
"""
    subprocess.run([sys.executable, "-c", script], check=True, cwd=ROOT, timeout=120)
