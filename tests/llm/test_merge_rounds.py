"""BPE by merge rounds against the tokenizers library, and a plain merge loop."""

import functools
import hashlib
import json

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pintime.llm import merge_rounds
from pintime.llm.common import table
from tests.llm.helpers import ODD_TEXTS, SF, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXT = st.text(st.sampled_from(list("abest  \n\t'’,.-+1é▁日\x1c\xa0<>|s😀᲏՘")), max_size=80)
SPECIAL = "<|endoftext|>"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


@functools.cache
def pairs_of(vocabulary):
    return {int(k): (int(r), int(j)) for k, r, j in
            zip(vocabulary.keys, vocabulary.ranks, vocabulary.joined, strict=True)}


def plain_merge(word, vocabulary):
    """One pair after the other: the lowest rank, the leftmost."""
    symbols = vocabulary.first[np.frombuffer(word, np.uint8)].tolist()
    pairs = pairs_of(vocabulary)
    while True:
        found = [(pairs[a * vocabulary.size + b][0], i)
                 for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False))
                 if a * vocabulary.size + b in pairs]
        if not found:
            return symbols
        _, i = min(found)
        symbols[i:i + 2] = [pairs[symbols[i] * vocabulary.size + symbols[i + 1]][1]]


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(0, 3))
def test_ids_are_the_library_s(library, text, specials):
    for k in range(specials):
        at = len(text) * (k + 1) // 4
        text = text[:at] + SPECIAL + text[at:]
    got = merge_rounds.codec(PATH).encode([text])[0]
    want = library.encode(text, add_special_tokens=False).ids
    assert ids_of(got) == want
    assert merge_rounds.codec(PATH).decode(got) == library.decode(want, skip_special_tokens=False)


def test_every_character_is_cut_as_the_library_cuts_it(library):
    """Its table of characters may be of another age than Python's."""
    odd = [chr(c) for c in range(0x80, 0x33480) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}1{c}{c}! {c} b" for c in odd[i:i + 4000])
             for i in range(0, len(odd), 4000)]
    got = merge_rounds.codec(PATH).encode(texts)
    for data, want in zip(got, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids_of(data) == want.ids


def test_a_very_long_word(library):
    rng = np.random.default_rng(5)
    letters = "".join(rng.choice(list("etaoinshrdlu"), 40_000))
    for word in (letters, "a" * 50_001, "ab" * 20_000, "日本" * 5_000):
        got = merge_rounds.codec(PATH).encode([word])[0]
        assert ids_of(got) == library.encode(word, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def unordered(tmp_path_factory):
    """A vocabulary in which a pair ranks before the merge that makes its left side."""
    tokens = [*merge_rounds.byte_of_char(), "ab", "abc", "ca", "bc", "aa"]
    content = {"version": "1.0", "truncation": None, "padding": None, "added_tokens": [],
               "normalizer": None, "post_processor": None,
               "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False,
                                 "trim_offsets": True, "use_regex": True},
               "decoder": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True,
                           "use_regex": True},
               "model": {"type": "BPE", "dropout": None, "unk_token": None,
                         "continuing_subword_prefix": None, "end_of_word_suffix": None,
                         "fuse_unk": False, "byte_fallback": False, "ignore_merges": False,
                         "vocab": {t: i for i, t in enumerate(tokens)},
                         "merges": [["ab", "c"], ["a", "a"], ["c", "a"], ["a", "b"], ["b", "c"]]}}
    path = tmp_path_factory.mktemp("bpe") / "unordered.json"
    path.write_text(json.dumps(content))
    return str(path)


@settings(max_examples=150, deadline=None)
@given(word=st.text("abc", min_size=1, max_size=40))
def test_any_order_of_merges(unordered, word):
    vocabulary = merge_rounds.codec(unordered).vocabulary
    assert not vocabulary.in_order
    want = plain_merge(word.encode(), vocabulary)
    raw = np.frombuffer(word.encode(), np.uint8)
    assert merge_rounds.merge_words(raw, np.array([len(raw)]), vocabulary)[0].tolist() == want
    assert merge_rounds.merge_long(raw, vocabulary).tolist() == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=30), min_size=1, max_size=8))
def test_rounds_are_the_plain_loop(words):
    vocabulary = merge_rounds.codec(PATH).vocabulary
    want = [plain_merge(w, vocabulary) for w in words]
    raw = np.frombuffer(b"".join(words), np.uint8)
    ids, sizes = merge_rounds.merge_words(raw, np.array(list(map(len, words))), vocabulary)
    assert ids.tolist() == sum(want, []) and sizes.tolist() == list(map(len, want))
    assert [merge_rounds.merge_long(np.frombuffer(w, np.uint8), vocabulary).tolist()
            for w in words] == want


def test_a_small_cache_changes_nothing(library):
    from pintime.llm.common import TokenCache
    texts = ["one two three", "two  four", "", "one", "five six two"] * 3
    codec = merge_rounds.codec(PATH)
    cache = TokenCache(codec._encode_chunks, limit=2)
    for i in range(0, len(texts), 2):
        got = cache.encode(texts[i:i + 2])
        assert [ids_of(g) for g in got] == [
            library.encode(t, add_special_tokens=False).ids for t in texts[i:i + 2]]


def test_decoding_of_broken_bytes(library):
    ids = library.encode("日", add_special_tokens=False).ids[:1] + [0, 50256]
    data = np.array(ids, "<u4").tobytes()
    assert merge_rounds.codec(PATH).decode(data) == library.decode(ids, skip_special_tokens=False)


def expect(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest())


def test_odd_texts_repeats_and_clashing_columns(spark, library):
    texts = [*ODD_TEXTS, *ODD_TEXTS[:4], f"a{SPECIAL}{SPECIAL} b  {SPECIAL}\n"]
    got = merge_rounds.round_trip(frame(spark, texts)).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expect(library, texts[r.doc_id])
    empty = merge_rounds.round_trip(frame(spark, [])).collect()
    assert empty == []
    nameless = frame(spark, ["a b"]).withColumn("doc_id", F.lit(None).cast("long"))
    assert merge_rounds.round_trip(nameless).first().doc_id is None


def test_encode_then_decode(spark):
    docs = table(spark, SF, "documents").limit(40)
    back = merge_rounds.decode(merge_rounds.encode(docs)).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert {r.doc_id: r.text for r in back} == texts


def test_query_against_the_library(spark, library):
    got = {r.doc_id: r for r in merge_rounds.op12_merge_rounds(spark, SF).collect()}
    docs = table(spark, SF, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expect(library, d.text)
