"""Quality rules by distribution divergence, in DataFrame functions only.

A document's histogram of character classes and its histogram of common words
are held against every language's reference by the Jensen-Shannon distance (the
root of the divergence in bits, 0 to 1); the nearest language counts. References
come from all documents with a language that read as prose (symbols are at most
one character in a hundred and capitals one letter in five, so that littered
texts don't shape what they are judged by): class counts, and each language's
``top_words`` most frequent words, all other words being one bucket. A language needs ``min_reference_chars`` characters of such
text, whatever else the table holds. References are constant arrays in the plan,
whose expressions do not grow with the languages; the driver collects at most
``1 + top_words`` short rows a language, and a document's work is linear in them.

Guards: the class histogram judges only texts of ``min_chars`` characters, the
word histogram only texts of ``min_words`` words, and neither judges documents
whose own ``lang`` has no reference. A document without ``lang`` is judged, by its
classes, only if its words are near enough to a reference to be of that language; what is
not judged passes. ``base_failed`` is
a plain rule on length and repetition and comes first.

Everything of a document is computed inside its row: no text is shuffled, a hot
source costs nothing extra. Only the references shuffle: counts of words and of
classes by language, summed in every task first.

Defined results: null text counts as empty (no words: base_failed, not kept);
with no usable language nothing but the base rule judges; repeated rows are
judged one by one; null lang contributes to no reference; other columns are kept, whatever
their names.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pintime.llm.common import table

# fixed values of the contract
SPACES = " \t\n\x0b\x0c\r"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_BASE_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Character classes that are rare in prose; white space is what no word holds, and
#: "small" is all the rest. Digits count with the small letters, and the marks of
#: addresses and numbers with the stops: personal data in a short text says nothing
#: against its prose.
RARE = {
    "capital": r"\p{Lu}+",
    "stop": r"[.,;:?'\"()+@=/-]+",
    "other": r"[^\p{L}\p{Nd}\x20\x09-\x0D.,;:?'\"()+@=/-]+",
}
CLASSES = [*RARE, "space", "small"]
#: What is neither a symbol of the contract nor in a rare class: taken out first, in long
#: runs, so that the other patterns look at the few characters that remain.
COMMON = r"[a-z \p{Ll}\p{Nd}\x09-\x0D]+"

TOP_WORDS = 64
#: Characters of prose that make a reference: shares of classes are then known to about half
#: a percent.
MIN_REFERENCE_CHARS = 10_000
MIN_CHARS = 100
MIN_WORDS = 50
MAX_CLASS_DISTANCE = 0.17
MAX_WORD_DISTANCE = 0.5
#: A text without ``lang`` is of a language if it is that much nearer to its reference than a
#: text without any of its words.
RECOGNISED = 0.75


@dataclass(frozen=True)
class References:
    """Per language: shares of the character classes, shares of its common words."""

    classes: dict[str, list[float]]
    words: dict[str, dict[str, float]]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, however often it is used."""
    return F.transform(F.array(value), body)[0]


def letters_words(text: Column) -> Column:
    """Lower-cased runs of letters."""
    return F.array_remove(F.split(F.lower(text), r"[^a-zà-öø-ÿ\p{L}]+"), "")


def _without(text: Column, pattern: str) -> Column:
    """How many characters of the text the pattern takes."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("long")


def uncommon(text: Column) -> Column:
    return F.regexp_replace(text, COMMON, "")


def n_symbols(rest: Column) -> Column:
    """Symbols of a text, counted in its ``uncommon`` characters."""
    return _without(rest, f"[{SYMBOLS}]+")


def rare_counts(rest: Column) -> dict[str, Column]:
    """Characters of each rare class, counted in the ``uncommon`` characters."""
    return {n: _without(rest, rx) for n, rx in RARE.items()}


def class_counts(chars: Column, spaces: Column, rare: dict[str, Column]) -> dict[str, Column]:
    """Characters of each of ``CLASSES``."""
    return {**rare, "space": spaces, "small": chars - spaces - sum(rare.values(), F.lit(0))}


def n_spaces(text: Column) -> Column:
    """White space characters; each is one byte, and plain replacing is cheap."""
    lost = [F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit("")))
            for c in SPACES]
    return sum(lost[1:], lost[0]).cast("long")


def split_words(text: Column) -> Column:
    for c in SPACES[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def _rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))


def references(docs: DataFrame, top_words: int = TOP_WORDS,
               min_reference_chars: int = MIN_REFERENCE_CHARS, id_col: str = "doc_id",
               text_col: str = "text", lang_col: str = "lang") -> References:
    """Reference histograms over all documents, one for each language with enough prose."""
    rows = _rows(docs, id_col, text_col, lang_col).where("lang is not null")
    text = F.col("text")
    measured = rows.select(
        "lang", F.char_length("text").alias("chars"), uncommon(text).alias("rest"),
        n_spaces(text).alias("spaces"), letters_words(text).alias("words"))
    measured = measured.select(
        "lang", "chars", "spaces", "words", n_symbols(F.col("rest")).alias("symbols"),
        *[c.alias(f"_{n}") for n, c in rare_counts(F.col("rest")).items()])
    counted = class_counts(F.col("chars"), F.col("spaces"), {n: F.col(f"_{n}") for n in RARE})
    measured = measured.select("lang", "chars", "words", "symbols",
                               *[c.alias(n) for n, c in counted.items()])
    prose = (100 * F.col("symbols") <= F.col("chars")) & (
        5 * F.col("capital") <= F.col("capital") + F.col("small"))
    # One pass: a first, empty entry carries the document's own numbers. The condition
    # stands inside the array: as a filter it would be pushed below and every measure
    # computed twice; and the words themselves must not stand beside what is exploded.
    entries = measured.select("lang", *CLASSES, F.size("words").alias("n_words"), F.when(
        prose, F.concat(F.array(F.lit("")), "words")).alias("entries"))
    entries = entries.select("lang", *CLASSES, "n_words", F.explode_outer("entries").alias("word")
                             ).where("word is not null")
    own = F.col("word") == ""
    counts = entries.groupBy("lang", "word").agg(
        F.count("*").alias("n"), F.sum(F.when(own, F.col("n_words"))).alias("n_words"),
        *[F.sum(F.when(own, F.col(n))).alias(n) for n in CLASSES])
    place = F.row_number().over(Window.partitionBy("lang").orderBy(
        F.col("word") != "", F.desc("n"), "word"))
    top = counts.withColumn("place", place).where(F.col("place") <= top_words + 1)
    chars = sum((F.col(n) for n in CLASSES[1:]), F.col(CLASSES[0]))
    usable = F.max(F.when(own, (chars >= min_reference_chars) & (F.col("n_words") > 0))).over(
        Window.partitionBy("lang"))
    kept = top.withColumn("usable", usable).where("usable").orderBy("lang", "place").collect()
    classes, shares, size = {}, {}, {}
    for r in kept:
        if not r["word"]:
            classes[r["lang"]] = [r[n] / sum(r[m] for m in CLASSES) for n in CLASSES]
            shares[r["lang"]], size[r["lang"]] = {}, r["n_words"]
        else:
            shares[r["lang"]][r["word"]] = r["n"] / size[r["lang"]]
    return References(classes, shares)


def _part(p: Column, q: Column) -> Column:
    """What one bucket adds to the divergence in bits."""
    half = lambda x: F.when(x > 0, 0.5 * x * F.log2(2 * x / (p + q))).otherwise(0.0)
    return half(p) + half(q)


def _root(divergence: Column) -> Column:
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))


def _constant(value: list, schema: str) -> Column:
    """A nested value as one constant of the plan, however large."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def class_distance(shares: list[Column], refs: References) -> Column:
    """Distance of the shares of ``CLASSES`` to the nearest reference."""
    def distance(q: Column) -> Column:
        parts = [_part(p, q[i]) for i, p in enumerate(shares)]
        return _root(sum(parts[1:], parts[0]))

    return F.array_min(F.transform(
        _constant([*refs.classes.values()], "array<array<double>>"), distance))


def word_distance(words: Column, refs: References) -> Column:
    """``distance`` of the histogram of common ``words`` to the nearest reference, and the least
    ``ratio`` of a distance to that of a text without any of the reference's words; null
    without words."""
    vocabulary = sorted({w for words in refs.words.values() for w in words})

    def runs(s: Column) -> Column:
        """(word, count) of a sorted array."""
        starts = F.filter(F.transform(s, lambda w, i: F.when(
            (i == 0) | (F.get(s, i - 1) != w), i)), lambda i: i.isNotNull())
        return let(starts, lambda b: F.transform(b, lambda i, k: F.struct(
            F.get(s, i).alias("w"),
            (F.coalesce(F.get(b, k + 1), F.size(s)) - i).cast("double").alias("c"))))

    def distance(own: Column, other: Column) -> Column:
        sums = F.aggregate(own, F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("p"),
                                         F.lit(0.0).alias("q")),
                           lambda a, e: F.struct((a["d"] + _part(e["p"], e["q"])).alias("d"),
                                                 (a["p"] + e["p"]).alias("p"),
                                                 (a["q"] + e["q"]).alias("q")))
        # a reference word that the document lacks adds half its share
        return let(sums, lambda a: _root(
            a["d"] + 0.5 * (F.lit(1.0) - other - a["q"])
            + _part(F.greatest(1.0 - a["p"], F.lit(0.0)), other)))

    # each word's shares in the references that have it, found by a hash of the word
    n_slots = max(1, len(vocabulary))
    slots: list[dict[str, list]] = [{} for _ in range(n_slots)]
    for i, own in enumerate(refs.words.values()):
        for w, q in own.items():
            slots[zlib.crc32(w.encode()) % n_slots].setdefault(w, []).append({"i": i, "q": q})
    table_ = _constant(slots, "array<map<string, array<struct<i: int, q: double>>>>")
    others = _constant([1.0 - sum(own.values()) for own in refs.words.values()], "array<double>")
    none = _constant([_distance_without(1.0 - sum(own.values())) for own in refs.words.values()],
                     "array<double>")

    def shares(w: Column) -> Column:
        slot = F.get(table_, (F.crc32(w.cast("binary")) % n_slots).cast("int"))
        return F.try_element_at(slot, w)

    found = F.sort_array(F.filter(words, lambda w: w.isin(vocabulary)))
    entries = let(found, lambda s: F.flatten(F.transform(runs(s), lambda r: F.transform(
        shares(r["w"]), lambda e: F.struct(
            e["i"].alias("i"), (r["c"] / F.size(words)).alias("p"), e["q"].alias("q"))))))
    nearest = lambda each: F.struct(
        F.array_min(each).alias("distance"),
        F.array_min(F.zip_with(each, none, lambda d, far: d / far)).alias("ratio"))
    return F.when(F.size(words) > 0, let(let(entries, lambda own: F.transform(
        others, lambda other, i: distance(F.filter(own, lambda e: e["i"] == i), other))), nearest))


def _distance_without(other: float) -> float:
    """Distance of a text without a reference's words, whose other words have share ``other``."""
    half = lambda x, y: 0.5 * x * math.log2(2 * x / (x + y)) if x > 0 else 0.0
    return math.sqrt(0.5 * (1.0 - other) + half(1.0, other) + half(other, 1.0))


def repeat_words(words: Column) -> Column:
    """Words inside windows of eight words that are found twice or more in the text.

    Windows are told apart by 64-bit hashes.
    """
    def covered(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"),
                                                                          i.alias("i"))))
        twice = let(ordered, lambda s: F.sort_array(F.transform(F.filter(s, lambda e, k: (
            F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False)))), lambda e: e["i"])))
        return let(twice, lambda at: F.aggregate(
            F.transform(at, lambda i, k: F.least(
                F.lit(WINDOW), F.coalesce(i - F.get(at, k - 1), F.lit(WINDOW)))),
            F.lit(0), lambda a, x: a + x))

    def pairs(h: Column, step: int) -> Column:
        """Hashes of every entry with the one ``step`` places on."""
        return F.zip_with(h, F.slice(h, F.lit(step + 1), F.size(h)), lambda a, b: F.xxhash64(a, b))

    # hashes of 2, 4 and 8 words from each place on; the last seven have no window
    windows = let(pairs(words, 1), lambda h2: let(pairs(h2, 2), lambda h4: F.slice(
        pairs(h4, 4), F.lit(1), F.size(words) - (WINDOW - 1))))
    return F.when(F.size(words) <= WINDOW, 0).otherwise(
        let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0)
            .otherwise(covered(w)))).cast("long")


def dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_SPACE))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def with_verdict(docs: DataFrame, refs: References, min_chars: int = MIN_CHARS,
                 min_words: int = MIN_WORDS, max_class_distance: float = MAX_CLASS_DISTANCE,
                 max_word_distance: float = MAX_WORD_DISTANCE, text_col: str = "text",
                 lang_col: str = "lang", name: str = "_verdict") -> DataFrame:
    """``docs`` with one more column ``name``: its counts, distances and ``kept``; the word
    distance is found where it judges (null elsewhere).

    The given columns travel in one struct, so none clashes with a step's. What a later
    step uses more than once is a column of an earlier one, so it is computed once a row.
    """
    if name in docs.columns:
        raise ValueError(f"there is a column {name} already")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("given"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.col(lang_col).cast("string").alias("lang"))
    text = F.col("text")
    measured = rows.withColumns({
        "words": let(split_words(text), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("chars"))),
        "rest": uncommon(text), "lines": dup_lines(text), "chars": F.char_length(text),
    })
    n, spaces = F.col("words.n_words"), F.col("chars") - F.col("words.chars")
    repeated = F.col("words.n_repeat_words")
    failed = (n < MIN_BASE_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n)
    measured = measured.withColumns({
        "symbols": n_symbols(F.col("rest")),
        **{f"n_{c}": x for c, x in rare_counts(F.col("rest")).items()}})
    counts = class_counts(F.col("chars"), spaces, {c: F.col(f"n_{c}") for c in RARE})
    shares = measured.withColumns({f"p{i}": F.try_divide(c, F.col("chars"))
                                   for i, c in enumerate(counts.values())})
    none = F.lit(None).cast("double")
    distances = shares.withColumns({
        "class_distance": class_distance([F.col(f"p{i}") for i in range(len(CLASSES))], refs)
        if refs.classes else none,
        "nearest": F.when(~failed & (n >= min_words), let(
            letters_words(text), lambda w: word_distance(w, refs))) if refs.words else F.struct(
            none.alias("distance"), none.alias("ratio")),
    })
    referred = F.coalesce(F.col("lang").isin([*refs.words]), F.lit(False))
    far = F.coalesce("nearest.distance", F.lit(0.0)) > max_word_distance
    known = F.col("lang").isNull() & (n >= min_words) & (
        F.coalesce(F.col("nearest.ratio") <= RECOGNISED, F.lit(False)))
    odd_classes = (F.col("chars") >= min_chars) & (referred | known) & (
        F.coalesce("class_distance", F.lit(0.0)) > max_class_distance)
    odd_words = (n >= min_words) & referred & far
    return distances.select("given.*", F.struct(
        n.alias("n_words"), F.col("words.chars").alias("word_chars"),
        F.col("symbols").alias("n_symbols"), F.col("lines").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"), failed.alias("base_failed"),
        (~failed & ~odd_classes & ~odd_words).alias("kept"), "class_distance",
        F.col("nearest.distance").alias("word_distance"),
    ).alias(name))


def quality(docs: DataFrame, refs: References, id_col: str = "doc_id", text_col: str = "text",
            lang_col: str = "lang", **limits) -> DataFrame:
    """One row per document: the base counts, both distances, and the verdict ``kept``."""
    rows = _rows(docs, id_col, text_col, lang_col)
    return with_verdict(rows, refs, **limits).select("doc_id", "_verdict.*")


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "base_failed", "kept"]


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality(docs, references(docs)).select(COLUMNS)
