import random
import struct

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from billbook.llm import bpe
from billbook.llm.common import importable

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={}
    )


def test_pieces_as_the_library_has_them(library):
    random.seed(5)
    machine = bpe.Transducer(bpe.read_ranks(PATH))
    tokens = list(machine.ranks)
    pieces = [bytes(random.choices(b"abcdeth n\xc3\xa9\xe4\xb8", k=random.randint(1, 30))) for _ in range(1500)]
    pieces += [b"".join(random.choices(tokens, k=random.randint(1, 4))) for _ in range(1500)]
    pieces += [bytes(random.choices(range(256), k=random.randint(1, 12))) for _ in range(1000)]
    pieces += [bytes([b]) * n for b in b"a 0=" for n in (1, 2, 3, 7, 64, 500)]
    for piece in pieces:
        assert machine.encode(piece) == library._encode_single_piece(piece)
        assert machine.encode(piece) == ([machine.ranks[piece]] if piece in machine.ranks else list(bpe.merged(piece, machine.ranks)))


def test_lookahead_and_states_are_bounded_inside_a_piece(library, monkeypatch):
    random.seed(7)
    monkeypatch.setattr(bpe, "STATES", 20_000)
    machine = bpe.Transducer(bpe.read_ranks(PATH))
    letters = bytes(random.choices(b"abcdefghijklmnopqrstuvwxyz", k=200_000))
    for piece in (b"a" * 5_000, letters, b"the" * 3_000, "é日".encode() * 2_000):
        out, undecided = 0, 0

        def fed():
            nonlocal undecided
            for at, byte in enumerate(piece):
                undecided = max(undecided, at - out)
                yield byte

        ids = []
        for decided in machine.stream(fed()):
            out += sum(len(machine.bytes_of[t]) for t in decided)
            ids += decided
            assert len(machine.states) <= 20_002
        assert out == len(piece) and undecided <= 2 * machine.longest
        assert ids == machine.encode(piece) == library._encode_single_piece(piece)


def test_small_caches_change_nothing(library, monkeypatch):
    for name in ("STATES", "TRANSITIONS", "PAIRS", "PIECES"):
        monkeypatch.setattr(bpe, name, 3)
    machine = bpe.Transducer(bpe.read_ranks(PATH))
    for piece in (b"determinised", b" transducers", b"determinised", b"\xc3\xa9t\xc3\xa9"):
        assert machine.encode(piece) == library._encode_single_piece(piece)


def test_incremental_utf8_is_the_decoder_of_the_language():
    random.seed(6)
    alphabet = [0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xED, 0xA0, 0xFF]
    for _ in range(3000):
        data = bytes(random.choices(alphabet, k=random.randint(0, 7)))
        cut = random.randint(0, len(data))
        held, first = bpe.utf8_step(b"", data[:cut])
        held, second = bpe.utf8_step(held, data[cut:])
        assert first + second + "�" * bool(held) == data.decode("utf-8", "replace")


def test_documents(spark, library):
    importable(spark)
    texts = ["Hello  wörld\n\n é 😀 日本 12345", "", None, " ", "a" * 5000, "x  y", "<|endoftext|>"]
    docs = spark.createDataFrame(
        [(i, t, b"z") for i, t in enumerate(texts)] + [(None, "null id", b""), (1, "again", b"")],
        "doc_id bigint, text string, ids binary",
    )
    encoded = bpe.encode(docs, PATH, public_tokenizers.PATTERN, keep=True)
    rows = bpe.decode(encoded, PATH, keep=True).collect()
    assert len(rows) == docs.count()
    for r in rows:
        text = r["text"] or ""
        assert [i for (i,) in struct.iter_unpack("<I", r["ids"])] == library.encode_ordinary(text)
        assert r["decoded"] == text
    empty = docs.limit(0)
    assert bpe.decode(bpe.encode(empty, PATH, public_tokenizers.PATTERN), PATH).collect() == []
    nothing = spark.createDataFrame([(1, None)], "doc_id bigint, ids binary")
    assert bpe.decode(nothing, PATH).first()["decoded"] == ""


def test_whole_texts_of_the_tables(spark, library):
    importable(spark)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r in bpe.encode(docs, PATH, public_tokenizers.PATTERN, keep=True).collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(r["text"])
