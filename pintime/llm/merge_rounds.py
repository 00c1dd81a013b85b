"""BPE encoding and decoding by batched numpy merge rounds.

The distinct pre-tokens of a group of texts that were not met before lie in one
flat array of symbols, at first one for each byte, with the word that owns each.
In every round each word's lowest-ranked pair is found by a segmented minimum
and merged wherever it stands in that word, from the left, in all words at once.
A pair's rank comes from a binary search over the vocabulary's sorted pair keys
(left id times the vocabulary's size, plus right id); after a round only the
pairs beside merged symbols are searched again. Words without a mergeable pair
leave the array.

Merging all places of a word's best pair in one round is what one merge after
the other gives if no pair ranks before the merges that made its symbols (then
no merge can make a better pair); the vocabulary is checked for that when it is
loaded, and otherwise only the leftmost place is merged in a round. Words of more
than ``LONG`` bytes, which would need very many rounds, are merged one by one in
order of rank over a linked list.

Defined results: null or empty text has no ids and decodes to the empty text;
the string of an added token inside a text is that token, as the library has it
by default; bytes that are no UTF-8 decode to replacement characters; repeated
rows are encoded once each; null ids and extra columns are kept out of the way.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from pintime.llm.common import MARKS, WORD, TokenCache, gathered, id_text, map_text, table

VOCABULARY = "byte_bpe_50k.json"
LONG = 2048
NONE = np.iinfo(np.int32).max


def byte_of_char() -> dict[str, int]:
    """The public byte-level alphabet: visible characters stand for themselves, the
    other bytes, in order, for the characters from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Sorted pair keys with their ranks and joined ids; the bytes of every id."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        vocab, added = content["model"]["vocab"], content["added_tokens"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m)
                 for m in content["model"]["merges"]]
        alphabet = byte_of_char()
        self.size = 1 + max([*vocab.values(), *(t["id"] for t in added)])
        self.first = np.zeros(256, np.int64)
        for char, byte in alphabet.items():
            self.first[byte] = vocab[char]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        joined = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.joined = joined[order].astype(np.int32)
        made = np.full(self.size, -1, np.int64)     # the first merge that makes an id
        made[joined[::-1]] = np.arange(len(pairs))[::-1]
        place = np.arange(len(pairs))
        self.in_order = bool(((made[left] < place) & (made[right] < place)).all()
                             and len(np.unique(joined)) == len(joined))
        self.bytes: list[bytes] = [b""] * self.size
        for token, i in [*vocab.items(), *((t["content"], t["id"]) for t in added)]:
            known = all(c in alphabet for c in token)
            self.bytes[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        self.added = {t["content"]: t["id"] for t in added}
        self.pre_tokenizer = Tokenizer.from_file(path).pre_tokenizer

    def search(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE: no merge) and joined id of each pair."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        rank = np.where(self.keys[at] == key, self.ranks[at], NONE)
        return rank, self.joined[at]


def merge_words(raw: np.ndarray, sizes: np.ndarray,
                vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words (none empty) in a row, and how many each has; merged in step.

    ``raw`` holds the words' bytes one after the other.
    """
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    long = np.flatnonzero(sizes > LONG)
    ends = np.cumsum(sizes)
    late = {i: merge_long(raw[ends[i] - sizes[i]:ends[i]], vocabulary) for i in long.tolist()}
    if late:
        short = ~np.isin(owner, long)
        raw, owner = raw[short], owner[short]
    symbol = vocabulary.first[raw].astype(np.int32)
    rank, join = _ranked(symbol, owner, vocabulary)
    done_symbol, done_owner = [], []
    while len(symbol):
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        lengths = np.diff(np.r_[starts, len(owner)])
        best = np.repeat(np.minimum.reduceat(rank, starts), lengths)
        over = best == NONE
        if over.any():
            done_symbol.append(symbol[over])
            done_owner.append(owner[over])
            on = ~over
            symbol, owner, rank, join, best = (x[on] for x in (symbol, owner, rank, join, best))
            if not len(symbol):
                break
        at = np.flatnonzero(rank == best)
        first = np.r_[True, owner[at][1:] != owner[at][:-1]]
        if vocabulary.in_order:     # of places that overlap, every second one from the left
            run = np.flatnonzero(first | (np.diff(at, prepend=-2) != 1))
            place = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
            at = at[place % 2 == 0]
        else:
            at = at[first]
        symbol[at] = join[at]
        keep = np.ones(len(symbol), bool)
        keep[at + 1] = False
        symbol, owner, rank, join = symbol[keep], owner[keep], rank[keep], join[keep]
        merged = at - np.arange(len(at))
        near = np.zeros(len(symbol), bool)
        near[merged] = True
        near[np.maximum(merged - 1, 0)] = True
        near = np.flatnonzero(near)
        rank[near] = NONE
        near = near[near < len(symbol) - 1]
        near = near[owner[near] == owner[near + 1]]
        rank[near], join[near] = vocabulary.search(symbol[near], symbol[near + 1])
    for i, ids in late.items():
        done_symbol.append(ids)
        done_owner.append(np.full(len(ids), i, np.int32))
    if not done_symbol:
        return symbol, sizes
    owner = np.concatenate(done_owner)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(done_symbol)[order], np.bincount(owner, minlength=len(sizes))


def _ranked(symbol: np.ndarray, owner: np.ndarray,
            vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    rank, join = np.full(len(symbol), NONE, np.int32), np.zeros(len(symbol), np.int32)
    if len(symbol) > 1:
        rank[:-1], join[:-1] = vocabulary.search(symbol[:-1], symbol[1:])
        rank[:-1][owner[:-1] != owner[1:]] = NONE
    return rank, join


def merge_long(raw: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """The ids of one word's bytes: its pairs in order of rank, over a linked list of symbols."""
    symbol = vocabulary.first[raw].astype(np.int32)
    n = len(symbol)
    after = np.arange(1, n + 1)         # n: no symbol
    before = np.arange(-1, n)           # one more, so that the last one's neighbour can be set
    rank, join = _ranked(symbol, np.zeros(n, np.int32), vocabulary)
    waiting: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def wait(places: np.ndarray) -> None:
        places = places[rank[places] != NONE]
        places = places[np.argsort(rank[places], kind="stable")]
        values, starts = np.unique(rank[places], return_index=True)
        for value, part in zip(values.tolist(), np.split(places, starts[1:]), strict=False):
            if value not in waiting:
                waiting[value] = []
                heapq.heappush(heap, value)
            waiting[value].append(part)

    wait(np.arange(n))
    while heap:
        value = heapq.heappop(heap)
        at = np.unique(np.concatenate(waiting.pop(value)))
        at = at[rank[at] == value]
        if not len(at):
            continue
        if vocabulary.in_order:
            run = np.flatnonzero(np.r_[True, after[at[:-1]] != at[1:]])
            place = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
            at, later = at[place % 2 == 0], at[:0]
        else:
            at, later = at[:1], at[1:]
        gone = after[at]
        symbol[at] = join[at]
        rank[gone] = NONE
        after[at] = after[gone]
        before[after[at]] = at
        symbol[gone] = -1
        near = np.unique(np.r_[at, before[at][before[at] >= 0]])
        rank[near] = NONE
        pairs = near[after[near] < n]
        rank[pairs], join[pairs] = vocabulary.search(symbol[pairs], symbol[after[pairs]])
        wait(np.unique(np.r_[near, later]))
    return symbol[symbol >= 0]


def word_bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all strings in a row, and how many each has."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    raw = np.frombuffer(data or b"", np.uint8)
    return raw[ends[0]:ends[-1]], np.diff(ends)


class Codec:
    """Whole texts to packed ids and back, with a bounded cache of chunks."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.chunks = TokenCache(self._encode_chunks)
        added = sorted(self.vocabulary.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None

    def _cut(self, part: str) -> list[str]:
        """What the library's own pre-tokenizer makes of a text without added tokens."""
        return [part[a:b] for _, (a, b) in self.vocabulary.pre_tokenizer.pre_tokenize_str(part)]

    def pre_tokens(self, chunk: str) -> list[str]:
        """The pre-tokens and added tokens of a chunk."""
        if not (self.special and self.special.search(chunk)):
            return self._cut(chunk)
        out = []
        for piece in self.special.split(chunk):
            out += [piece] if piece in self.vocabulary.added else self._cut(piece)
        return out

    def _encode_chunks(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words with marks behind them are two pre-tokens or one; others go to the library's
        pre-tokenizer. The distinct pre-tokens are merged."""
        simple = pc.match_substring_regex(parts, f"^{WORD}[{MARKS}]*$").to_numpy(
            zero_copy_only=False)
        words = parts.filter(pa.array(simple))
        marks = pc.replace_substring_regex(words, f"^{WORD}", "")
        marked = pc.not_equal(marks, "")
        odd = [self.pre_tokens(c) for c in parts.filter(pa.array(~simple)).to_pylist()]
        flat = pa.concat_arrays([pc.utf8_rtrim(words, MARKS), marks.filter(marked),
                                 pa.array([w for some in odd for w in some], parts.type)])
        encoded = flat.dictionary_encode()
        each, distinct = encoded.indices.to_numpy(), encoded.dictionary
        ids, sizes = merge_words(*word_bytes(distinct), self.vocabulary)
        starts = np.cumsum(sizes) - sizes
        for text, token in self.vocabulary.added.items():
            i = pc.index(distinct, text).as_py()
            if i >= 0:      # one id, in the place of its first symbol
                ids[starts[i]], sizes[i] = token, 1
        # where each chunk's pre-tokens lie in ``flat``: the word, then its marks if any
        has = marked.to_numpy(zero_copy_only=False)
        counts = np.zeros(len(parts), np.int64)
        counts[simple] = 1 + has
        counts[~simple] = [len(some) for some in odd]
        order = np.zeros(int(counts.sum()), np.int64)
        to = np.cumsum(counts) - counts
        order[to[simple]] = each[:len(words)]
        order[to[simple][has] + 1] = each[len(words):len(words) + int(has.sum())]
        rest = each[len(words) + int(has.sum()):]
        order[gathered(np.arange(len(order)), to[~simple], counts[~simple])] = rest
        lengths = sizes[order]
        ends = np.r_[0, np.cumsum(lengths)][np.cumsum(counts)]
        return gathered(ids, starts[order], lengths), np.diff(ends, prepend=0)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, as little-endian unsigned 32-bit integers."""
        return self.chunks.encode(texts)

    def decode(self, ids: bytes) -> str:
        held = self.vocabulary.bytes
        data = b"".join([held[i] for i in np.frombuffer(ids, "<u4").tolist()])
        return data.decode(errors="replace")


@functools.lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def _path(tokenizer_path: str | None) -> str:
    return tokenizer_path or public_tokenizers.path(VOCABULARY)


def encode(docs: DataFrame, tokenizer_path: str | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its ids (little-endian unsigned 32-bit, binary)."""
    path = _path(tokenizer_path)
    return map_text(id_text(docs, id_col, text_col), "doc_id long, ids binary",
                    lambda i, t: {"doc_id": i, "ids": codec(path).encode(t)})


def decode(encoded: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """One row per document with the text of its ids (null ids: the empty text)."""
    path = _path(tokenizer_path)
    rows = encoded.selectExpr("cast(doc_id as bigint) as doc_id", "coalesce(ids, X'') as ids")
    return map_text(rows, "doc_id long, text string",
                    lambda i, b: {"doc_id": i, "text": [codec(path).decode(x) for x in b]})


def round_trip(docs: DataFrame, tokenizer_path: str | None = None,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, then decode the ids in the same pass; digests of both."""
    path = _path(tokenizer_path)

    def work(doc_ids: list, texts: list[str]) -> dict[str, list]:
        c = codec(path)
        ids = c.encode(texts)
        return {"doc_id": doc_ids, "n_tokens": [len(x) // 4 for x in ids],
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(c.decode(x).encode()).hexdigest() for x in ids]}

    return map_text(id_text(docs, id_col, text_col),
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", work)


def op12_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
