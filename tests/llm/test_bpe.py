import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from urbanflux.llm import bpe

PATH = bpe.vocabulary_path(bpe.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = [
    "",
    "Plain words, twice: plain WORDS.",
    "it's we'll they'd 'sword x''s",
    "ÉÇ ß ΣΑΣ İstanbul é ﬁ 中文 😀👍🏽",
    "<|endoftext|>a<|startoftext|> <|endoftext|",
    "tabs\tand\nlines\r\n\x0b\x0c\x1c\x85\xa0 1234567",
    "a" * 5000,
    "lorem ipsum " * 3000,
]


def expected(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS)
def test_encode_and_decode_like_the_library(text):
    own = bpe.load(PATH)
    ids = own.encode(text)
    assert ids == expected(text)
    assert own.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aabbcdeiorstl '<|>endoftxé́ßΣ1 9\n\t.,!?-中😀", max_size=60))
def test_any_mixture_like_the_library(text):
    assert bpe.load(PATH).encode(text) == expected(text)


def test_unknown_ids_are_left_out():
    own = bpe.load(PATH)
    assert own.decode([0, 10**6, 1]) == own.decode([0, 1])


def test_digests(spark, documents):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(1, TEXTS[1]), (None, "x"), (99, None)]
    found = {(r["doc_id"], r["ids_sha256"], r["decoded_sha256"], r["n_tokens"]) for r in bpe.digests(documents(*rows)).collect()}
    want = set()
    for number, text in rows:
        ids = expected(text or "")
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.add((number, sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False)), len(ids)))
    assert found == want
    assert bpe.digests(documents(*rows)).count() == len(rows)


def test_empty_table_and_clashing_columns(documents):
    clashing = documents((1, "one two")).withColumn("ids", F.lit("old")).withColumn("decoded", F.lit(1))
    coded = bpe.decode(bpe.encode(clashing))
    assert coded.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "decoded"]
    assert coded.first()["decoded"] == "one</w> two</w>"
    assert bpe.decode(bpe.encode(clashing.limit(0))).collect() == []


def test_every_code_point_like_the_library():
    own = bpe.WordBpe(PATH, bpe.characters(PATH))
    known = bpe.characters(PATH)
    assert len(known.classes) < 5_000 and len(known.lower) < 500
    for first in range(0x80, 0x110000, 64):
        block = [chr(c) for c in range(first, first + 64) if not 0xD800 <= c <= 0xDFFF]
        text = " ".join(f"a<{c}>b {c}1{c}{c}" for c in block)
        assert own.encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids, hex(first)
