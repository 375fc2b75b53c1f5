import base64
import hashlib
import struct

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from llm_fixtures import HARD, make  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimwise.llm import bpe

VOCABULARY = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def judge():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def coded(texts):
    return [x.tolist() for x in bpe.codec(VOCABULARY, P.PATTERN).encode_batch(texts)]


def test_characters_are_encoded_as_by_ranks(judge):
    # all that are split here, and every 41st of those that are left to the library
    chars = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000 and (bpe.STEADY.fullmatch(c) or ord(c) % 41 == 0)]
    texts = [f"a{c}a {c}{c} 1{c}1 !{c}! {c} \n{c}\n  {c}'s" for c in chars]
    assert coded(texts) == [judge.encode_ordinary(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text() | st.text(" \n\t'sdtlmrevé1a") | st.text("ab '<|endoftext>中 "))
def test_any_text(judge_text):
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = RANKS or RANKS.update({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}) or RANKS
    own = CODERS or CODERS.append(tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})) or CODERS
    (ids,) = coded([judge_text])
    assert ids == own[0].encode_ordinary(judge_text)
    c = bpe.codec(VOCABULARY, P.PATTERN)
    assert c.decode(np.array(ids, np.int64)) == judge_text
    if ids:
        starts, ends = c.offsets(judge_text, np.array(ids))
        data = judge_text.encode()
        at = 0
        for i, a, b in zip(ids, starts, ends, strict=True):
            piece = c.bytes[i]
            assert piece in judge_text[a:b].encode() and data[at:at + len(piece)] == piece
            at += len(piece)


RANKS: dict = {}
CODERS: list = []


def test_digests_of_hard_rows(make, judge):
    got = bpe.digests(make(HARD), VOCABULARY, P.PATTERN).select("doc_id", "coded.*").collect()
    expected = []
    for i, t, *_ in HARD:
        ids = judge.encode_ordinary(t or "")
        expected.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got)) == sorted(expected)
    assert bpe.digests(make([]), VOCABULARY, P.PATTERN).count() == 0


def test_encode_and_decode_columns(make, judge):
    docs = make(HARD).withColumn("starts", F.lit("taken"))
    out = bpe.decode(bpe.encode(docs, VOCABULARY, P.PATTERN, offsets=True), VOCABULARY, P.PATTERN)
    for r in out.collect():
        assert r.ids == judge.encode_ordinary(r.text or "") and r.decoded == (r.text or "")
        assert len(r.starts) == len(r.ends) == len(r.ids) and (not r.ids or (r.starts[0], r.ends[-1]) == (0, len(r.text)))
    assert bpe.encode(make([]), VOCABULARY, P.PATTERN).count() == 0


def test_split_characters():
    c = bpe.codec(VOCABULARY, P.PATTERN)
    (ids,) = c.encode_batch(["a\U0001f9ff"])  # several tokens hold parts of one character
    starts, ends = c.offsets("a\U0001f9ff", ids)
    assert len(ids) > 2 and starts.tolist()[-1] == 1 and set(ends.tolist()[1:]) == {2}
    assert c.decode(ids[:-1]).endswith("�") and c.decode(ids) == "a\U0001f9ff"
