"""Byte-level BPE against the library on whole texts, and an exact round trip."""

import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from labtide.llm import bpe
from labtide.llm.queries import ranks

SCHEMA = "doc_id bigint, text string, ids string, data string, n_tokens string"
TEXTS = [
    (1, "Hello world's end, 12 a3\n\n  x  "),
    (2, None),
    (3, ""),
    (4, " \t\r\n  "),
    (5, "\x1c\x85\xa0é 中文\U0001f600 <|endoftext|>"),
    (5, "Hello world's end, 12 a3\n\n  x  "),
    (None, "no id"),
    (7, "word " * 40_000 + " " * 20_000 + "x\n" * 30_000 + "\n" * 9_000),
    (8, "a" * 100_000),
]


@pytest.fixture(scope="module")
def plain():
    with open(ranks(), "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def test_op12_equals_the_library_on_whole_texts(spark, plain):
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in TEXTS], SCHEMA)
    got = bpe.round_trip(docs, ranks(), public_tokenizers.PATTERN).collect()
    want = []
    for doc, text in TEXTS:
        ids = plain.encode_ordinary(text or "")
        digest = hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        want.append((doc, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_op12_decodes_parts_of_characters_and_keeps_columns(spark, plain):
    ids = plain.encode_ordinary("é中")[:1]
    rows = spark.createDataFrame([(1, bytearray(np.array(ids, "<u4").tobytes()), "kept"), (2, None, "kept")], "a int, ids binary, data string")
    got = {r.a: r for r in bpe.decoded(rows, ranks(), public_tokenizers.PATTERN).collect()}
    assert bytes(got[1].data_) == plain.decode_bytes(ids) and got[1].data == "kept" and got[2].data_ is None


def test_op12_empty_table_and_other_patterns(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.round_trip(docs, ranks(), public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError, match="pattern"):
        bpe.codec(ranks(), r"\w+")


def test_op12_runs_of_spaces_that_the_library_cannot_match(plain):
    text = "a" + " " * 1_500_000 + "b"
    ids = bpe.token_ids(text, plain)
    # One match of all spaces but the last, then " b".
    assert ids.tolist() == [*plain.encode_ordinary("a"), *plain._encode_single_piece(b" " * 1_499_999), *plain.encode_ordinary(" b")]
    assert plain.decode_bytes(ids.tolist()).decode() == text


def test_op12_cuts_change_no_match(plain):
    draw = random.Random(1)
    letters = "ab1. \n\t'sé \x85\x1c-中' "
    for _ in range(1500):
        text = "".join(draw.choice(letters) * draw.choice([1, 1, 2, 9]) for _ in range(draw.randint(0, 50)))
        run = re.compile(f"[{bpe.SPACES}]{{{draw.randint(2, 6)},}}")
        parts = [*bpe.segments(text, draw.randint(1, 20), run)]
        ids = [i for part, single in parts for i in (plain._encode_single_piece(part.encode()) if single else plain.encode_ordinary(part))]
        assert "".join(p for p, _ in parts) == text and ids == plain.encode_ordinary(text)
