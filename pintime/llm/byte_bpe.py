"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is the concatenation of the pattern's matches, and ids of matches simply
concatenate. Inside a match, halves are encoded recursively and neighbours are
joined: the window around the boundary (at first one token on either side) is
encoded anew and grows until the tokens left and right of it provably stay.
They stay when each pair of neighbours across a window edge is itself stable,
that is, encoding the two tokens' bytes gives these two tokens again: a token
sequence is the encoding of its bytes exactly if all its neighbours are stable
(inside the halves they are by induction, inside the window by construction).
The join is associative with the empty encoding as unit, so the tree's shape
does not matter. Decoding concatenates the tokens' bytes up the same tree.

Defined results: null or empty text has no ids and decodes to no bytes.
"""

from __future__ import annotations

import base64
import functools
import hashlib

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pintime.llm.common import (
    ChunkCache,
    chunks,
    id_text,
    map_text,
    pack_ids,
    simple_pre_tokens,
    table,
)

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LEAF = 6            # bytes that one merge loop takes
KEPT = 200_000      # merges of short byte strings that are remembered


class Codec:
    """Ranks of a public vocabulary, and the monoid of encodings under ``join``."""

    def __init__(self, path: str):
        import regex

        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.token = {r: t for t, r in self.rank.items()}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self._stable: dict[tuple[int, int], bool] = {}
        self._merged: dict[bytes, list[int]] = {}
        self.words = ChunkCache(self._encode_words)
        self.chunks = ChunkCache(self._encode_chunks)

    def merge(self, data: bytes) -> list[int]:
        """Lowest rank first, leftmost on ties; for short byte strings."""
        if (whole := self.rank.get(data)) is not None:
            return [whole]
        if (known := self._merged.get(data)) is None:
            if len(self._merged) > KEPT:
                self._merged.clear()
            known = self._merged[data] = self._merge(data)
        return known

    def _merge(self, data: bytes) -> list[int]:
        rank = self.rank
        parts = [data[i:i + 1] for i in range(len(data))]
        ranks = [rank.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            at, low = -1, None
            for i, r in enumerate(ranks):
                if r is not None and (low is None or r < low):
                    at, low = i, r
            if low is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank.get(parts[at] + parts[at + 1])
            if at:
                ranks[at - 1] = rank.get(parts[at - 1] + parts[at])
        return [rank[p] for p in parts]

    def stable(self, a: int, b: int) -> bool:
        key = (a, b)
        if (known := self._stable.get(key)) is None:
            if len(self._stable) > KEPT:
                self._stable.clear()
            known = self._stable[key] = self.merge(self.token[a] + self.token[b]) == [a, b]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of both sides' bytes together."""
        if not left or not right:
            return left or right
        if self.stable(left[-1], right[0]):
            return left + right
        a, b = len(left) - 1, 1
        while True:
            window = self.merge(b"".join(self.token[t] for t in left[a:] + right[:b]))
            left_stays = a == 0 or self.stable(left[a - 1], window[0])
            right_stays = b == len(right) or self.stable(window[-1], right[b])
            if left_stays and right_stays:
                return left[:a] + window + right[b:]
            a = a if left_stays else max(0, a - 1)
            b = b if right_stays else min(len(right), b + 1)

    def encode_bytes(self, data: bytes) -> list[int]:
        """Halves are encoded and joined, level by level (no deep recursion)."""
        if len(data) <= LEAF:
            return self.merge(data) if data else []
        if (whole := self.rank.get(data)) is not None:
            return [whole]
        level = [self.merge(data[i:i + LEAF]) for i in range(0, len(data), LEAF)]
        while len(level) > 1:
            joined = [self.join(a, b) for a, b in zip(level[::2], level[1::2], strict=False)]
            level = joined + level[len(joined) * 2:]
        return level[0]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        return [pack_ids(self.encode_bytes(w.encode())) for w in words]

    def _encode_chunks(self, parts: list[str]) -> list[bytes]:
        matches = [(simple_pre_tokens(c) or self.pattern.findall(c), []) for c in parts]
        return [b"".join(v) for v in self.words.values(matches)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, as little-endian unsigned 32-bit integers."""
        return [b"".join(v) for v in self.chunks.values([chunks(t) for t in texts])]

    def decode(self, ids: bytes) -> bytes:
        """The tokens' bytes, concatenated up the tree."""
        level = list(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        while len(level) > 1:
            level = [b"".join(level[i:i + 1024]) for i in range(0, len(level), 1024)]
        return level[0] if level else b""


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
    """One row per document with the bytes of its ids (null ids: none)."""
    path = _path(tokenizer_path)
    rows = encoded.selectExpr("cast(doc_id as bigint) as doc_id", "coalesce(ids, X'') as ids")
    return map_text(rows, "doc_id long, data binary",
                    lambda i, b: {"doc_id": i, "data": [codec(path).decode(x) for x in b]})


def round_trip(docs: DataFrame, tokenizer_path: str | None = None,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, then decode the ids in the same pass; digests of both."""
    path = _path(tokenizer_path)

    def work(doc_ids: list, texts: list[str]) -> dict[str, list]:
        c = codec(path)
        ids = c.encode(texts)
        return {"doc_id": doc_ids, "n_tokens": [len(x) // 4 for x in ids],
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(c.decode(x)).hexdigest() for x in ids]}

    return map_text(id_text(docs, id_col, text_col),
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", work)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
