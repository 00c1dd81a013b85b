"""Language identification by multilingual mixture inference.

Each language is a distribution over hashed character trigrams (the letter, and
the letter or word edge on either side). A document is a mixture of languages:
expectation-maximisation over its trigram counts estimates the proportions, the
languages are ranked by them, and among the nested sets of the first k languages
the one with the best penalised likelihood is chosen (half the logarithm of the
number of letters for each language, times ``penalty``: trigrams overlap, so
their evidence counts ``1 / 3``). The prediction is the set's leading language
and the score its share.

The model is fitted on all labelled rows that are not held out, or, beyond
``sample`` rows of a language, on about that many chosen by a hash of the id; its
size is ``slots`` times the number of languages. Languages with fewer than
``min_rows`` labelled rows are not learned. Prediction is one pass without any
shuffle.

Defined results: null text, or text without a letter: ``und`` with score 0; rows
with a null id are predicted but never learned from; with no learned language all
are ``und``; repeated rows are predicted alike.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pintime.llm.common import annotate, id_text, map_arrow, map_text, table

UNKNOWN = "und"
SLOTS = 1 << 15
SAMPLE = 2000       # labelled rows of a language, about
MIN_ROWS = 5
PENALTY = 4.0
ROUNDS, REFITS = 12, 4


@dataclass(frozen=True)
class Model:
    languages: list[str]
    probability: np.ndarray     # slots x languages


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    known = np.zeros(0x110000, bool)
    for lo, hi in ((0, 0xD800), (0xE000, 0x32000)):
        known[lo:hi] = [chr(c).isalpha() for c in range(lo, hi)]
    return known


def trigrams(texts: list[str], slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) of every letter of the lower-cased texts."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer(" ".join(lowered).encode("utf-32-le"), np.uint32).astype(np.int64)
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes[~_letters()[codes]] = 0
    around = np.r_[0, codes, 0]
    at = np.flatnonzero(codes)
    h = (around[at] * 0x9E3779B1 + around[at + 1]) * 0x85EBCA77 + around[at + 2]
    h = (h ^ (h >> 29)) * 0x27D4EB2F165667C5
    ends = np.cumsum([len(t) + 1 for t in lowered])
    return np.searchsorted(ends, at, side="right"), (h >> 33) & (slots - 1)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(labelled: DataFrame, slots: int = SLOTS, sample: int = SAMPLE, min_rows: int = MIN_ROWS,
        id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Trigram distributions of the languages of ``labelled``."""
    rows = labelled.select(F.col(id_col).cast("long").alias("doc_id"),
                           F.col(lang_col).cast("string").alias("lang"),
                           F.col(text_col).cast("string").alias("text")).where(
        "doc_id is not null and lang is not null and text is not null")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).where(F.col("n") >= min_rows)
    # as many rows as the model has languages
    known = {r["lang"]: min(1.0, sample / r["n"]) for r in sizes.collect()}
    if not known:
        return Model([], np.zeros((slots, 0)))
    share = F.try_element_at(F.create_map(*[F.lit(x) for p in known.items() for x in p]),
                             F.col("lang"))
    chosen = rows.where(F.expr("pmod(xxhash64(doc_id, 17), 1000000)") < share * 1_000_000
                        ).select("lang", "text")
    schema = pa.schema([("lang", pa.string()), ("slot", pa.int32()), ("n", pa.int64())])

    def count(batches):
        for b in batches:
            langs = np.array(b.column(0).to_pylist(), object)
            texts = b.column(1).to_pylist()
            for lang in sorted(set(langs)):
                _, slot = trigrams([t for t, la in zip(texts, langs, strict=True) if la == lang],
                                   slots)
                found, n = np.unique(slot, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found)), pa.array(found, pa.int32()),
                     pa.array(n, pa.int64())], schema=schema)

    counts = (map_arrow(chosen, count, "lang string, slot int, n long")
              .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow())
    languages = sorted(set(counts.column("lang").to_pylist()))
    total = np.full((slots, len(languages)), 0.5)
    place = {la: i for i, la in enumerate(languages)}
    cols = np.array([place[la] for la in counts.column("lang").to_pylist()], np.int64)
    total[counts.column("slot").to_numpy(), cols] += counts.column("n").to_numpy()
    return Model(languages, total / total.sum(axis=0))


def mixtures(texts: list[str], model: Model, penalty: float = PENALTY
             ) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the chosen languages (texts x languages) and letters of each text."""
    return explained(texts, model, penalty)[:2]


def explained(texts: list[str], model: Model, penalty: float = PENALTY
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``mixtures``, and how much better they explain each text than a background in which
    every trigram is as likely as any other: the mean gain in log-likelihood a letter. A text
    in a language that was not learned has mostly trigrams that no learned language has, which
    the smoothed mixtures explain worse than the background does (0 without letters)."""
    k, n_texts = len(model.languages), len(texts)
    slots = len(model.probability)
    text, slot = trigrams(texts, slots)
    letters = np.bincount(text, minlength=n_texts)
    out, gain = np.zeros((n_texts, k)), np.zeros(n_texts)
    if not len(text) or not k:
        return out, letters, gain
    key, count = np.unique(text * slots + slot, return_counts=True)
    owner, p = key // slots, model.probability[key % slots]
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    present = owner[starts]
    row = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(owner)]))
    weight = count.astype(float)
    size = np.add.reduceat(weight, starts)

    def step(pi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        joint = p * pi[row]
        total = joint.sum(axis=1)
        joint *= (weight / total)[:, None]
        return np.add.reduceat(joint, starts, axis=0) / size[:, None], total

    pi = np.full((len(starts), k), 1 / k)
    for _ in range(ROUNDS):
        pi, _ = step(pi)
    rank = np.argsort(np.argsort(-pi, axis=1, kind="stable"), axis=1, kind="stable")
    best_score, best = np.full(len(starts), -np.inf), np.zeros_like(pi)
    best_fit = np.zeros(len(starts))
    for size_of_set in range(1, k + 1):
        part = np.where(rank < size_of_set, np.maximum(pi, 1e-12), 0)
        part /= part.sum(axis=1, keepdims=True)
        for _ in range(REFITS if size_of_set > 1 else 0):
            part, _ = step(part)
        _, total = step(part)
        fit_ = np.add.reduceat(weight * np.log(total), starts) / 3
        score = fit_ - penalty * size_of_set * np.log(size + 1) / 2
        better = score > best_score
        best_score[better], best[better] = score[better], part[better]
        best_fit[better] = fit_[better]
    out[present] = best
    gain[present] = 3 * best_fit / size + np.log(slots)
    return out, letters, gain


def leading(share: np.ndarray, letters: np.ndarray, model: Model
            ) -> tuple[list[str], list[float]]:
    """The language and score of each row of ``mixtures``."""
    if not model.languages:
        return [UNKNOWN] * len(letters), [0.0] * len(letters)
    known = letters > 0
    return ([model.languages[f] if y else UNKNOWN
             for f, y in zip(share.argmax(axis=1), known, strict=True)],
            np.where(known, np.minimum(share.max(axis=1), 1.0), 0.0).tolist())


def predict(texts: list[str], model: Model, penalty: float = PENALTY
            ) -> tuple[list[str], list[float]]:
    return leading(*mixtures(texts, model, penalty), model)


def identify(docs: DataFrame, model: Model, penalty: float = PENALTY, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per document: its leading language and that language's share."""
    def work(ids: list, texts: list[str]) -> dict[str, list]:
        lang, score = predict(texts, model, penalty)
        return {"doc_id": ids, "lang_pred": lang, "score": score}

    return map_text(id_text(docs, id_col, text_col),
                    "doc_id long, lang_pred string, score double", work)


def with_language(docs: DataFrame, model: Model, penalty: float = PENALTY,
                  text_col: str = "text") -> DataFrame:
    """``docs`` with the columns _lang_pred, _score, _shares (of ``model.languages``) and _gain
    (a letter's gain over the background; below 0 no learned language explains the text)."""
    def work(texts: list[str]) -> dict[str, list]:
        share, letters, gain = explained(texts, model, penalty)
        lang, score = leading(share, letters, model)
        return {"_lang_pred": lang, "_score": score, "_shares": list(share),
                "_gain": gain.tolist()}

    return annotate(docs, text_col, "_lang_pred string, _score double, _shares array<double>, "
                                    "_gain double", work)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    return identify(docs, model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")
