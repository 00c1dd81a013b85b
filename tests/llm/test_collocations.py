"""Collocations against plain counting over all pieces."""

import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pintime.llm import collocations
from pintime.llm.common import table
from tests.llm.helpers import ODD_TEXTS, SF, frame

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_UPPER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute(rows, least=10, longest=3, top=2000, percent=50):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for w in pieces(text):
            n[lang or "und"] += len(w)
            for size in range(1, longest + 1):
                counts[lang or "und"].update(
                    tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= percent * a and any(
                    q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in candidates.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k)
                           for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def phrases_of(chunks, longest):
    """What the dictionary's chunks count, by plain Python."""
    out = Counter()
    for chunk, n in Counter(chunks).items():
        goes_on = chunk.endswith("\n")
        w = chunk.removesuffix("\n").split(" ")
        for i in range(len(w) - (longest - 1 if goes_on else 0)):
            for size in range(1, min(longest, len(w) - i) + 1):
                out[tuple(w[i:i + size])] += n
    return out


WORDY = st.lists(st.sampled_from(["a", "b", "C", "dd", "é", "x\x1cy", ".", ",", "\n", " ", "\t"]),
                 max_size=60).map(" ".join)


@settings(max_examples=200, deadline=None)
@given(WORDY, st.integers(1, 5), st.integers(1, 4))
def test_the_parse_counts_every_phrase_once(text, trigger, longest):
    want = Counter(tuple(w[i:i + size]) for w in pieces(text)
                   for size in range(1, longest + 1) for i in range(len(w) - size + 1))
    assert phrases_of(collocations.parse(text, longest, trigger), longest) == want


def test_shared_passages_give_the_same_chunks():
    passage = " ".join(f"w{i}" for i in range(200))
    a = set(collocations.parse("some words before " + passage))
    b = set(collocations.parse("others " + passage + " and after it"))
    assert len(a & b) >= len(a) - 3 and len(a) > 5


def test_query_against_plain_counts(spark):
    docs = table(spark, SF, "documents")
    want = brute([(r.lang, r.text) for r in docs.collect()])
    assert len(want) > 100
    assert rows_of(collocations.op11_collocations(spark, SF)) == want


@pytest.fixture(scope="module")
def copies():
    text = "One two three, one two. Three ONE two three! Big-data  is\tbig-data is"
    return [text] * 30 + ["one two three " * 40, "is big-data"] * 3


@pytest.mark.parametrize("options", [
    {}, {"least": 2, "top": 3}, {"least": 1, "longest": 2}, {"least": 3, "longest": 4,
                                                             "percent": 90}])
def test_copies_ties_and_clashing_columns(spark, copies, options):
    df = frame(spark, copies)
    want = brute([(r.lang, r.text) for r in df.collect()], **options)
    assert want and rows_of(collocations.collocations(df, **options)) == want


def test_odd_texts(spark):
    df = frame(spark, [*ODD_TEXTS] * 10)
    want = brute([(r.lang, r.text) for r in df.collect()])
    assert want and rows_of(collocations.collocations(df)) == want


def test_full_slots_change_nothing(spark, copies):
    df = frame(spark, copies)
    assert rows_of(collocations.collocations(df, least=2, slot_bits=6)) == brute(
        [(r.lang, r.text) for r in df.collect()], least=2)


def test_counts_past_64_bits(spark):
    counts = spark.createDataFrame(
        [("en", "p q", 3 * 10**12), ("en", "p", 4 * 10**12), ("en", "q", 5 * 10**12)],
        "lang string, phrase string, a long")
    assert collocations.scored(counts).first().score == 1_000_000 * 9 // 20


def test_nothing_to_count(spark):
    for df in (frame(spark, []), frame(spark, [None, "", " . ,", "a b"])):
        assert collocations.collocations(df).collect() == []
    nulls = frame(spark, ["a b"] * 12).withColumn("lang", F.lit(None).cast("string"))
    assert [r.lang for r in collocations.collocations(nulls).collect()] == ["und"]
