import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from trendspark.llm import bpe, bpe_codec

from .helpers import frame, odd_rows

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
OWN, FAST = bpe.Encoder(RANKS), bpe.encoder(PATH, fast=True)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("ab's tremdlv'  \n\t1.!　")), max_size=40), max_size=5))
def test_ids_equal_the_library(texts):
    expected = [LIBRARY.encode_ordinary(t) for t in texts]
    assert [x.tolist() for x in OWN.encode(texts)] == expected
    assert [x.tolist() for x in FAST.encode(texts, at_once=7)] == expected


@pytest.mark.parametrize("text", ["'s's's'll''re'", "a'sx", "!'s", " 's", "\n's", "''s", "'S'", "x  y", "x \n y  ", "é'll'", " 'd", "a" * 5000, "ab" * 4000])
def test_contractions_white_space_and_long_runs(text):
    assert next(OWN.encode([text])).tolist() == LIBRARY.encode_ordinary(text)


def test_decoding_by_ids_and_offsets():
    text = "it's 12 naïve 日本語\n"
    ids = next(FAST.encode([text]))
    at = FAST.offsets(ids)
    raw = text.encode()
    assert FAST.decode(ids) == raw and at[-1] == len(raw)
    assert [raw[a:b] for a, b in zip(at, at[1:])] == [FAST.values[i] for i in ids.tolist()]


def test_a_small_cache_changes_nothing():
    tiny = bpe.Encoder(RANKS, most=3)
    tiny.pairs.most = 5
    text = "the cat sat on the mat and the cat sat again " * 20
    assert next(tiny.encode([text])).tolist() == LIBRARY.encode_ordinary(text)


def test_both_files_of_one_vocabulary_agree():
    json_ranks = bpe.encoder(public_tokenizers.path("byte_bpe_50k.json")).ranks
    assert json_ranks == bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_round_trip_table(spark):
    rows = odd_rows()
    out = bpe_codec.round_trip(frame(spark, rows, clash=True), PATH).collect()
    expected = []
    for doc, text in rows:
        ids = LIBRARY.encode_ordinary(text or "")
        expected.append((doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, out), key=repr) == sorted(expected, key=repr)
    assert bpe_codec.round_trip(frame(spark, []), PATH).count() == 0


def test_encode_then_decode_table(spark):
    rows = odd_rows()
    tokens = bpe_codec.encode_documents(frame(spark, rows), PATH)
    back = bpe_codec.decode_documents(tokens, PATH).collect()
    assert sorted((r.doc_id, bytes(r.data)) for r in back if r.doc_id) == sorted((i, (t or "").encode()) for i, t in rows if i)
