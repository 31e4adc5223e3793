"""Byte-level BPE and token counts against the libraries themselves."""

from __future__ import annotations

import hashlib

import cases
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from flowsieve.llm import byte_bpe, token_counts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(byte_bpe.build_model(byte_bpe.read_ranks(RANKS)), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_round_trip_matches_library(spark, tik):
    docs = cases.frame(spark)
    got = {r.doc_id: r for r in byte_bpe.round_trip(docs, RANKS).collect()}
    for doc_id, text, *_ in cases.rows():
        ids = tik.encode_ordinary(text or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        assert tuple(got[doc_id])[1:] == want


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_codec_on_any_text(codec, tik, text):
    ids = [i for part in codec.encode(text) for i in part]
    assert ids == tik.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_every_code_point_splits_alike(codec, tik):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 4000):
        text = "".join(f"a{c}1 {c}{c}\n" for c in points[at : at + 4000 : 7])
        assert [i for part in codec.encode(text) for i in part] == tik.encode_ordinary(text)


def test_slices_do_not_change_ids(codec, monkeypatch):
    text = cases.SENTENCE * 5
    whole = [i for part in codec.encode(text) for i in part]
    monkeypatch.setattr(byte_bpe, "SLICE", 7)
    assert [i for part in codec.encode(text) for i in part] == whole


def test_arrays_decode_and_keep_other_columns(spark):
    docs = cases.frame(spark).withColumnRenamed("source", "decoded")
    out = byte_bpe.decode_ids(byte_bpe.encode_texts(docs, RANKS), RANKS, out="bytes").collect()
    assert len(out) == len(cases.TEXTS)
    assert all(bytes(r.bytes) == (r.text or "").encode() and r.decoded == "src0" for r in out)


def test_bpe_on_empty_table_and_repeated_rows(spark):
    assert byte_bpe.round_trip(cases.frame(spark, []), RANKS).collect() == []
    twice = cases.frame(spark, [(None, "same", None, None, None)] * 2)
    assert len(byte_bpe.round_trip(twice, RANKS).collect()) == 2


def test_ranks_must_be_complete():
    with pytest.raises(ValueError):
        byte_bpe.build_model({b"a": 0})


def test_counts_match_library(spark, pieces):
    docs = cases.frame(spark).withColumnRenamed("source", "part").withColumnRenamed("lang", "n")
    got = {r.doc_id: r for r in token_counts.count_tokens(docs, MODEL, limit=3000).collect()}
    for doc_id, text, *_ in cases.rows():
        n = len(pieces.encode(text or ""))
        assert tuple(got[doc_id])[1:] == (len((text or "").encode()), n, n > 3000)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab ▁\n<s>é🙂\t\u3000."), max_size=80))
def test_parts_add_up(pieces, text):
    splitter = _splitter()
    assert sum(map(splitter.count, splitter.split(text))) == len(pieces.encode(text))


def _splitter(found=[]):  # noqa: B006  one model for all examples
    if not found:
        with open(MODEL, "rb") as file:
            found.append(token_counts.Splitter(file.read()))
    return found[0]


def test_counts_do_not_depend_on_the_broadcast_table(spark, monkeypatch):
    docs = cases.frame(spark)
    first = sorted(map(tuple, token_counts.count_tokens(docs, MODEL).collect()), key=str)
    monkeypatch.setattr(token_counts, "TABLE", 0)
    assert sorted(map(tuple, token_counts.count_tokens(docs, MODEL).collect()), key=str) == first
    assert token_counts.count_tokens(cases.frame(spark, []), MODEL).collect() == []
