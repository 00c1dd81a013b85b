"""Phrase collocations counted over a prefix-free parse.

Texts are cut into pieces at marks, pieces into words. Where a hash of the next
``longest - 1`` words is 0 modulo ``TRIGGER``, a piece is cut into chunks that overlap by
those words: the cut depends on the words alone, so passages that texts share give the
same chunks wherever they stand. The distinct chunks with their frequencies (the
dictionary of the parse) are written once; all counting reads that dictionary and weighs
every chunk by its frequency. A phrase of up to ``longest`` words lies in the chunk in
which it starts; phrases that start in a chunk's last overlap are counted in the next
chunk, so each occurrence counts once.

Counting goes by levels. For two words and more, phrases whose two parts (all but the
last word, all but the first) passed the level before are counted by hash slots, and the
slots with ``least`` occurrences are kept as bits. A slot never counts too few, so this
only spares work: the bits are ``2^slot_bits`` at every size of the input (32 MB), and
where they are full everything passes. The last pass counts the phrases that passed
every level by their words, exactly. Scores are exact decimals.

Defined results: null and empty texts have no words; null ``lang`` counts as ``und``, with
rows of that name; repeated rows count each time; only ``lang`` and ``text`` are read, so
other columns never clash; without candidates the result is empty. Equal scores rank by
``a``, then by the phrase's UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pintime.llm.common import map_arrow, map_text, table
from pintime.llm.components import written
from pintime.llm.shingles import mix
from pintime.session import scratch_dir

LONGEST = 3
LEAST = 10
TOP = 2000
CONTAINED_PERCENT = 50
UNKNOWN = "und"
#: One window of words in so many begins a chunk.
TRIGGER = 16
SLOT_BITS = 28
#: Characters of the dictionary that are counted together.
GROUP_CHARS = 3_000_000

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_LETTERS = bytes(range(65, 91))
_PLAIN = bytes.maketrans(_LETTERS + _BREAKS + b"\t",
                         _LETTERS.lower() + b"\n" * len(_BREAKS) + b" ")
_STEP = np.uint64(0x9E3779B97F4A7C15)
BREAK = "\n"        # between pieces; at the end of a chunk that another one continues


def _numbered(words: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The words as numbers, the distinct words, and a hash of each of those."""
    encoded = words.dictionary_encode()
    names = encoded.dictionary
    hashes = pd.util.hash_array(names.to_numpy(zero_copy_only=False), categorize=False)
    return encoded.indices.to_numpy().astype(np.int64), names, hashes


def _words(lines: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all lines, and the line of each."""
    lists = pc.split_pattern(lines, " ")
    words = lists.flatten()
    line = np.repeat(np.arange(len(lines)), pc.list_value_length(lists).to_numpy())
    full = pc.not_equal(words, "")
    return words.filter(full), line[full.to_numpy(zero_copy_only=False)]


def parse(text: str, longest: int = LONGEST, trigger: int = TRIGGER) -> list[str]:
    """The chunks of a text: words with single blanks, and a last ``\\n`` where the next
    chunk begins with this one's last ``longest - 1`` words."""
    plain = text.encode().translate(_PLAIN).decode()
    words, piece = _words(pa.array(plain.split(BREAK), pa.large_string()))
    n, overlap = len(words), longest - 1
    if not n:
        return []
    ids, _, hashes = _numbered(words)
    begins = np.r_[True, piece[1:] != piece[:-1]]
    if overlap and n > overlap:
        h = hashes[ids]
        window = np.zeros(n - overlap + 1, np.uint64)
        for k in range(overlap):
            window = mix(window * _STEP + h[k:k + len(window)])
        whole = piece[:len(window)] == piece[overlap - 1:]
        begins[:len(window)] |= whole & (window % np.uint64(trigger) == 0)
    starts = np.flatnonzero(begins)
    follow = np.r_[starts[1:], n]
    goes_on = np.r_[piece[starts[1:]] == piece[starts[:-1]], False]
    ends = np.where(goes_on, follow + overlap, follow)
    tokens = words.to_numpy(zero_copy_only=False).tolist()
    return [" ".join(tokens[a:b]) + BREAK if on else " ".join(tokens[a:b])
            for a, b, on in zip(starts.tolist(), ends.tolist(), goes_on.tolist(), strict=True)]


def dictionary(docs: DataFrame, longest: int = LONGEST, trigger: int = TRIGGER,
               text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, chunk, n): the distinct chunks of all texts and how often they are parsed."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def work(langs: list[str], texts: list[str]) -> dict[str, list]:
        together: dict[str, list[str]] = {}
        for lang, text in zip(langs, texts, strict=True):
            together.setdefault(lang, []).append(text)
        out: dict[str, list] = {"lang": [], "chunk": []}
        for lang, some in together.items():
            chunks = parse(BREAK.join(some), longest, trigger)
            out["lang"] += [lang] * len(chunks)
            out["chunk"] += chunks
        return out

    chunks = map_text(rows, "lang string, chunk string", work)
    return chunks.groupBy("lang", "chunk").agg(F.count("*").alias("n"))


class Phrases:
    """The phrases of some chunks: where they start, their slots and their weights."""

    def __init__(self, langs: pa.Array, chunks: pa.Array, weights: np.ndarray, longest: int):
        goes_on = pc.ends_with(chunks, BREAK).to_numpy(zero_copy_only=False)
        self.words, self.chunk = _words(pc.utf8_rtrim(chunks, BREAK))
        self.ids, self.names, hashes = _numbered(self.words)
        ends = np.searchsorted(self.chunk, np.arange(len(chunks)), side="right")
        left = ends[self.chunk] - np.arange(len(self.ids))      # words from here to the end
        # what starts in the overlap is the next chunk's
        self.start = ~goes_on[self.chunk] | (left >= longest)
        encoded = langs.dictionary_encode()
        self.langs = encoded.dictionary.to_numpy(zero_copy_only=False)
        self.lang = encoded.indices.to_numpy().astype(np.int64)[self.chunk]
        self.weight = weights[self.chunk]
        self._left = left
        self._h = hashes[self.ids]
        self._first = mix(pd.util.hash_array(self.langs, categorize=False)[self.lang] + self._h)

    def places(self, size: int) -> np.ndarray:
        """Where a phrase of ``size`` words starts that counts here."""
        return np.flatnonzero(self.start & (self._left >= size))

    def text(self, at: np.ndarray, size: int) -> pa.Array:
        """The phrases of ``size`` words that start at these places."""
        words = [self.words.take(pa.array(at + k)) for k in range(size)]
        return words[0] if size == 1 else pc.binary_join_element_wise(
            *words, pa.scalar(" ", pa.large_string()))

    def slots(self, at: np.ndarray, size: int, bits: int) -> np.ndarray:
        h = self._first[at]
        for k in range(1, size):
            h = mix(h * _STEP + self._h[at + k])
        return (h >> np.uint64(64 - bits)).astype(np.int64)

    def passing(self, size: int, kept: dict[int, np.ndarray]) -> np.ndarray:
        """Places of the phrases whose slots, and their parts' slots, are kept."""
        at = self.places(size)
        for level, bits in kept.items():
            if level > size:
                continue
            for k in range(size - level + 1):
                slot = self.slots(at + k, level, len(bits).bit_length() + 5)
                hit = bits[slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1)
                at = at[hit.astype(bool)]
        return at


def _map_phrases(chunks: DataFrame, schema: pa.Schema, ddl: str, longest: int,
                 work: Callable[[Phrases], Iterator[list]]) -> DataFrame:
    """``work`` on groups of chunks of the dictionary, about ``GROUP_CHARS`` characters each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(parts).combine_chunks()
            one = [rows.column(c).chunk(0) for c in ("lang", "chunk", "n")]
            phrases = Phrases(one[0], one[1].cast(pa.large_string()), one[2].to_numpy(), longest)
            for columns in work(phrases):
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                     for c, f in zip(columns, schema, strict=True)], schema=schema)

        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.column("chunk").nbytes
            if size >= GROUP_CHARS:
                yield from emit(held)
                held, size = [], 0
        if held:
            yield from emit(held)

    return map_arrow(chunks.select("lang", "chunk", "n"), run, ddl)


def frequent_slots(chunks: DataFrame, size: int, least: int, kept: dict, longest: int,
                   slot_bits: int = SLOT_BITS):
    """A broadcast of the bits of slots with ``least`` phrases of ``size`` words or more."""
    def work(phrases: Phrases) -> Iterator[list]:
        at = phrases.passing(size, {k: b.value for k, b in kept.items()})
        slots, inverse = np.unique(phrases.slots(at, size, slot_bits), return_inverse=True)
        yield [slots, np.bincount(inverse, phrases.weight[at], len(slots)).astype(np.int64)]

    schema = pa.schema([("slot", pa.int64()), ("n", pa.int64())])
    counted = _map_phrases(chunks, schema, "slot long, n long", longest, work)
    often = counted.groupBy("slot").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    # 2^(slot_bits - 6) short rows at most
    bits = often.groupBy(F.expr("slot div 64").alias("place")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits")).toArrow()
    held = np.zeros(1 << (slot_bits - 6), np.uint64)
    held[bits.column("place").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
    return chunks.sparkSession.sparkContext.broadcast(held)


def phrase_counts(chunks: DataFrame, least: int = LEAST, longest: int = LONGEST,
                  slot_bits: int = SLOT_BITS) -> DataFrame:
    """(lang, phrase, a): single words and longer phrases that occur ``least`` times or more,
    and under the empty phrase the number of all words."""
    kept: dict[int, object] = {}
    for size in range(2, longest + 1):
        kept[size] = frequent_slots(chunks, size, least, kept, longest, slot_bits)

    def work(phrases: Phrases) -> Iterator[list]:
        bits = {k: b.value for k, b in kept.items()}
        totals = np.bincount(phrases.lang[phrases.start], phrases.weight[phrases.start],
                             len(phrases.langs)).astype(np.int64)
        yield [list(phrases.langs), [""] * len(totals), totals]
        distinct = len(phrases.names)
        code = phrases.lang.astype(np.int64)        # numbers of the phrase but its last word
        for size in range(1, longest + 1):
            at = phrases.passing(size, bits)
            if not len(at):
                return
            _, first, inverse = np.unique(code[at] * distinct + phrases.ids[at + size - 1],
                                          return_index=True, return_inverse=True)
            code = np.zeros(len(phrases.ids), np.int64)
            code[at] = inverse
            at_first = at[first]
            yield [phrases.langs[phrases.lang[at_first]], phrases.text(at_first, size),
                   np.bincount(inverse, phrases.weight[at], len(first)).astype(np.int64)]

    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64())])
    counted = _map_phrases(chunks, schema, "lang string, phrase string, a long", longest, work)
    return counted.groupBy("lang", "phrase").agg(F.sum("a").alias("a")).where(
        (F.col("a") >= least) | (F.col("phrase") == ""))


def scored(counts: DataFrame) -> DataFrame:
    """Candidates of two words and more with their lowest-scoring cut: lang, phrase, words, a,
    l, r, score."""
    sized = counts.where("phrase <> ''").withColumn("words", F.size(F.split("phrase", " ")))
    cuts = sized.where("words > 1").withColumn(
        "k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn(
        "rest", F.expr("substring(phrase, char_length(first) + 2)"))
    part = counts.where("phrase <> ''").select("lang", "phrase", "a")
    whole = cuts.join(part.toDF("lang", "first", "l"), ["lang", "first"]).join(
        part.toDF("lang", "rest", "r"), ["lang", "rest"])
    score = F.expr("(1000000BD * cast(a as decimal(15,0)) * cast(a as decimal(15,0)))"
                   " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return whole.groupBy("lang", "phrase", "words", "a").agg(least).select(
        "lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def not_contained(candidates: DataFrame, percent: int = CONTAINED_PERCENT) -> DataFrame:
    """Candidates without those that lie inside a longer one that is ``percent`` as frequent."""
    inner = F.expr("""flatten(transform(sequence(2, words - 1), s -> transform(
        sequence(1, words - s + 1), i -> array_join(slice(split(phrase, ' '), i, s), ' '))))""")
    longer = candidates.where("words > 2").select(
        "lang", F.explode(inner).alias("phrase"), F.col("a").alias("f")).groupBy(
        "lang", "phrase").agg(F.max("f").alias("f"))
    held = F.coalesce(100 * F.col("f") >= percent * F.col("a"), F.lit(False))
    return candidates.join(longer, ["lang", "phrase"], "left").where(~held).drop("f")


def first_of_each(phrases: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of every language with their ``rank``: first of hashed shares of a
    language, so that no task sorts all of one."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    for shares in (4096, 64):
        share = F.pmod(F.xxhash64("phrase"), F.lit(shares))
        phrases = phrases.withColumn("rank", F.row_number().over(
            Window.partitionBy("lang", share).orderBy(*order))).where(F.col("rank") <= top)
    return phrases.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP,
                 percent: int = CONTAINED_PERCENT, slot_bits: int = SLOT_BITS,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each language's first ``top`` phrases of two to ``longest`` words by score."""
    folder = scratch_dir(docs.sparkSession, "collocations")
    chunks = written(dictionary(docs, longest, text_col=text_col, lang_col=lang_col),
                     folder, "dictionary")
    counts = written(phrase_counts(chunks, least, longest, slot_bits), folder, "counts")
    candidates = written(scored(counts), folder, "candidates")
    ranked = first_of_each(not_contained(candidates, percent), top)
    n = counts.where("phrase = ''").select("lang", F.col("a").alias("n"))
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"),
                                         "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
