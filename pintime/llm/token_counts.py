"""Token counts by rank-synchronous array merging.

The vocabulary's library puts one mark before the text, turns blanks into
marks, and merges the neighbours whose joined piece has the best score, the
leftmost first. No piece holds a mark after another character, so a mark run
with the characters that follow is a pre-token: no merge crosses its ends.
The distinct pre-tokens of a group of texts that were not met before are held
as one ragged array (symbols, and where each pre-token starts). Every round
finds each pre-token's best pair by a segmented minimum of the pairs' ranks and
applies it to all pre-tokens at once; pre-tokens with no pair left go. What
survives is counted: a symbol is one token, a character outside the vocabulary
as many as its UTF-8 bytes.

Equal pairs of one pre-token are merged in the same round only if none of the
pairs that this makes ranks as well or better (then the library would have gone
on there first); otherwise only the leftmost is. Long runs of marks are cut
into pieces of the longest all-mark length, which the leftmost-first order
completes one after another anyway.

Defined results: null or empty text has 0 tokens; a text of blanks is counted
as the library counts it; special strings inside texts are ordinary text.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pintime.llm.common import ChunkCache, id_text, map_text, table

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
MARK = "▁"
NONE = np.iinfo(np.int32).max
_PRE_TOKEN = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Vocabulary:
    """Ids of the normal pieces and, for two neighbours, the joined piece and its rank."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(sp.get_piece_size())
               if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.piece = {sp.id_to_piece(i): i for i in ids}
        score = {p: sp.get_score(i) for p, i in self.piece.items()}
        rank = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.size = sp.get_piece_size()
        pairs = {}
        for p, i in self.piece.items():
            for k in range(1, len(p)):
                a, b = self.piece.get(p[:k]), self.piece.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = (rank[score[p]], i)
        # open addressing: a slot's key, or the next free slot after it
        self.mask = (1 << max(10, (len(pairs) * 8).bit_length())) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.ranks = np.full(self.mask + 1, NONE, np.int32)
        self.joined = np.full(self.mask + 1, -1, np.int32)
        for key, (r, i) in pairs.items():
            at = self._slot(key)
            while self.keys[at] >= 0:
                at = (at + 1) & self.mask
            self.keys[at], self.ranks[at], self.joined[at] = key, r, i
        marks = [len(p) for p in self.piece if not p.strip(MARK)]
        self.longest_marks = max(marks, default=1)

    def pairs_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and joined piece of each pair (NONE: no piece)."""
        key = left.astype(np.int64) * self.size + right
        key[(left < 0) | (right < 0)] = 0       # no pair of a vocabulary has key 0
        at = self._slot(key)
        held = self.keys[at]
        more = np.flatnonzero((held != key) & (held >= 0))
        while len(more):
            at[more] = (at[more] + 1) & self.mask
            held = self.keys[at[more]]
            more = more[(held != key[more]) & (held >= 0)]
        lost = self.keys[at] != key
        rank, joined = self.ranks[at], self.joined[at]
        rank[lost] = NONE
        return rank, joined

    def _slot(self, key):
        return (key * 2654435761 >> 15) & self.mask


def count_symbols(words: list[str], vocabulary: Vocabulary) -> np.ndarray:
    """Tokens of each pre-token, all merged in step."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    get = vocabulary.piece.get
    symbols = np.fromiter((get(c, -1) for w in words for c in w), np.int32, int(sizes.sum()))
    total = np.zeros(len(words), np.int64)
    owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    if (symbols < 0).any():     # what byte fallback adds to the one symbol counted below
        extra = np.fromiter((len(c.encode()) - 1 if get(c) is None else 0
                             for w in words for c in w), np.int64, len(symbols))
        np.add.at(total, owner, extra)

    def ranked(sym: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, join = np.full(len(sym), NONE, np.int32), np.full(len(sym), -1, np.int32)
        if len(sym) > 1:
            rank[:-1], join[:-1] = vocabulary.pairs_of(sym[:-1], sym[1:])
            rank[:-1][own[:-1] != own[1:]] = NONE
        return rank, join

    rank, join = ranked(symbols, owner)
    while len(symbols):
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        lengths = np.diff(np.r_[starts, len(owner)])
        best = np.minimum.reduceat(rank, starts)
        done = best == NONE
        if done.any():
            total[owner[starts[done]]] += lengths[done]
            keep = np.repeat(~done, lengths)
            symbols, owner, rank, join = symbols[keep], owner[keep], rank[keep], join[keep]
            if not len(symbols):
                break
            best, lengths = best[~done], lengths[~done]
            starts = np.r_[0, np.cumsum(lengths)[:-1]]
        segment_best = np.repeat(best, lengths)
        hit = rank == segment_best
        at = np.flatnonzero(hit)
        # of hits that overlap, every second one counts, from the left
        run = np.flatnonzero(np.r_[True, np.diff(at) != 1])
        place = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
        at = at[place % 2 == 0]
        merged = _merge(symbols, owner, rank, join, at, vocabulary)
        many = owner[at][1:] == owner[at][:-1]
        if many.any():
            new_at, new_owner, new_rank = merged[4], merged[1], merged[2]
            limit = np.zeros(len(total), np.int64) - 1
            several = owner[at][1:][many]
            limit[several] = rank[at][1:][many]
            bad = new_owner[new_at][new_rank[new_at] <= limit[new_owner[new_at]]]
            if len(bad):
                first = np.r_[True, ~many]
                at = at[first | ~np.isin(owner[at], bad)]
                merged = _merge(symbols, owner, rank, join, at, vocabulary)
        symbols, owner, rank, join, _ = merged
    return total


def _merge(symbols, owner, rank, join, at, vocabulary):
    """Merge the pairs that start at ``at``; only the pairs that change are looked up again."""
    symbols = symbols.copy()
    symbols[at] = join[at]
    keep = np.ones(len(symbols), bool)
    keep[at + 1] = False
    symbols, owner, rank, join = symbols[keep], owner[keep], rank[keep], join[keep]
    new = at - np.arange(len(at))           # where the merged symbols are now
    touched = np.zeros(len(symbols), bool)
    touched[new] = True
    touched[np.maximum(new - 1, 0)] = True
    changed = np.flatnonzero(touched)
    inner = changed[changed < len(symbols) - 1]
    inner = inner[owner[inner] == owner[inner + 1]]
    rank[changed] = NONE
    if len(inner):
        rank[inner], join[inner] = vocabulary.pairs_of(symbols[inner], symbols[inner + 1])
    return symbols, owner, rank, join, changed


@functools.lru_cache(maxsize=4)
def _cache(path: str) -> tuple[Vocabulary, ChunkCache]:
    vocabulary = Vocabulary(path)
    return vocabulary, ChunkCache(lambda words: count_symbols(words, vocabulary).tolist(), MARK)


def pre_tokens(text: str, longest_marks: int) -> tuple[list[str], list[str]]:
    """The text's pre-tokens with the leading mark: (as they are, less one mark)."""
    if not text:
        return [], []
    if MARK not in text and "  " not in text and text[0] != " " and text[-1] != " ":
        return [], text.split(" ")
    out = []
    for p in _PRE_TOKEN.findall(MARK + text.replace(" ", MARK)):
        run = len(p) - len(p.lstrip(MARK))
        while run > 2 * longest_marks:
            out.append(MARK * longest_marks)
            p, run = p[longest_marks:], run - longest_marks
        out.append(p)
    return out, []


def count_tokens(texts: list[str], path: str) -> list[int]:
    vocabulary, cache = _cache(path)
    parts = [pre_tokens(t, vocabulary.longest_marks) for t in texts]
    return [sum(v) for v in cache.values(parts)]


def token_counts(docs: DataFrame, limit: int = LIMIT, tokenizer_path: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its UTF-8 bytes, its tokens, and whether they pass ``limit``."""
    path = tokenizer_path or public_tokenizers.path(VOCABULARY)

    def work(doc_ids: list, texts: list[str]) -> dict[str, list]:
        return {"doc_id": doc_ids, "n_bytes": [len(t.encode()) for t in texts],
                "n_tokens": count_tokens(texts, path)}

    counted = map_text(id_text(docs, id_col, text_col),
                       "doc_id long, n_bytes long, n_tokens long", work)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
