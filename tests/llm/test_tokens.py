"""Packing, token counts and byte-level BPE against the public libraries."""

import base64
import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pintime.llm import byte_bpe, common, packing, token_counts
from pintime.llm.common import table
from tests.llm.helpers import ODD_TEXTS, SF, frame

TEXT = st.text(st.sampled_from(list("ab  \n\t'’,.-+1é▁日\x1c\xa0<>|s😀")), max_size=60)


@pytest.fixture(scope="module")
def bpe_50k():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def pieces_32k():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def multi_50k():
    import tiktoken
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_chunks_hold_the_text(text):
    plain, cut = common.chunks(text)
    assert "".join(plain + [" " + c for c in cut]) == text


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_packing_ids_are_the_library_s(bpe_50k, text):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = ids_of(packing.token_bytes([text], path)[0])
    assert got == bpe_50k.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_counts_are_the_library_s(pieces_32k, text):
    path = public_tokenizers.path("piece_bpe_32k.model")
    assert token_counts.count_tokens([text], path) == [len(pieces_32k.encode(text))]


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_bpe_is_the_library_s(multi_50k, text):
    codec = byte_bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ids = codec.encode([text])[0]
    assert ids_of(ids) == multi_50k.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("abthe ionérs"), max_size=120), st.integers(0, 120))
def test_join_is_the_encoding_of_both(multi_50k, text, cut):
    codec = byte_bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    data = text.replace(" ", "").encode()
    left, right = codec.encode_bytes(data[:cut]), codec.encode_bytes(data[cut:])
    assert codec.join(left, right) == codec.encode_bytes(data)
    assert codec.join([], right) == right and codec.join(left, []) == left


def test_cut_is_the_binary_decomposition():
    for n in (0, 1, 2, 3, 2047, 2048, 2049, 5000, 12_345):
        pieces = packing.cut(n, 2048)
        assert sum(k for _, k in pieces) == n
        assert [a for a, _ in pieces] == list(np.cumsum([0] + [k for _, k in pieces])[:-1])
        assert all(k & (k - 1) == 0 and k <= 2048 for _, k in pieces)
        small = [k for _, k in pieces if k < 2048]
        assert small == sorted(set(small), reverse=True)


def test_pack_whole_texts(spark, bpe_50k):
    df = frame(spark, [*ODD_TEXTS, ODD_TEXTS[5]])
    rows = packing.pack(df).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for d, t in enumerate([*ODD_TEXTS, ODD_TEXTS[5]]):
        ids = [*bpe_50k.encode(t or "", add_special_tokens=False).ids, 1]
        own = sorted(by_doc[d], key=lambda r: r.start)
        assert [x for r in own for x in r.ids] == ids
        assert all(r.doc_tokens == len(ids) and r.length == len(r.ids) == 2 ** r.bucket
                   and r.offset == 0 for r in own)
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in own)
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert packing.pack(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, max_length=1000)


def test_batches_have_one_length_and_size(spark):
    pieces = packing.pack(table(spark, SF, "documents"), with_ids=False)
    rows = packing.batches(pieces, 4096).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.batch_id].append(r.length)
    assert len(rows) == pieces.count()
    assert all(len(set(v)) == 1 and sum(v) <= 4096 for v in by.values())
    small = [k for k, v in by.items() if sum(v) < 4096]
    assert len(small) <= 12 + sum(1 for k in by if k.endswith("-0"))


def test_count_whole_texts(spark, pieces_32k):
    df = frame(spark, ODD_TEXTS)
    rows = {r.doc_id: r for r in token_counts.token_counts(df).collect()}
    for d, t in enumerate(ODD_TEXTS):
        n = len(pieces_32k.encode(t or ""))
        assert (rows[d].n_tokens, rows[d].over_limit) == (n, n > 4096)
        assert rows[d].n_bytes == len((t or "").encode())
    assert token_counts.token_counts(df.limit(0)).count() == 0


def test_encode_and_decode_whole_texts(spark, multi_50k):
    df = frame(spark, ODD_TEXTS)
    digests = {r.doc_id: r for r in byte_bpe.round_trip(df).collect()}
    encoded = byte_bpe.encode(df)
    back = {r.doc_id: bytes(r.data) for r in byte_bpe.decode(encoded).collect()}
    for d, t in enumerate(ODD_TEXTS):
        ids = np.array(multi_50k.encode_ordinary(t or ""), "<u4").tobytes()
        assert digests[d].n_tokens == len(ids) // 4
        assert digests[d].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert digests[d].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
        assert back[d] == (t or "").encode()


def test_cache_generations_change_nothing():
    calls = []

    def compute(parts):
        calls.append(len(parts))
        return [p.upper() for p in parts]

    cache = common.ChunkCache(compute, limit=3)
    for text in ("a b c", "d e f", "a b " + "x" * 100, "a d"):
        got = cache.values([common.chunks(text)])
        assert "".join(got[0]) == text.upper()
    assert len(cache.plain) + len(cache.cut) <= 2 * 3 + 3
