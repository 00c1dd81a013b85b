"""Personal data by a skip-chain conditional random field over plain patterns.

The base kinds (email, ip, card, phone) are the leftmost matches of fixed patterns
that pass their checks. Beside them a conditional random field labels the words of
a text with these kinds or none:

- nodes are the words with a digit or an ``@``; words without either are none, so
  they part the chains;
- neighbouring nodes share a chain potential, and occurrences of the same address
  or the same digits share a skip potential, however far away. Digits are those of
  a word (six or more) or of neighbouring words of a number written with single
  blanks (10 to 19, as phones and cards have), also where more words of digits
  follow; words with the same digits of a number are counterparts, and the size and
  checksum of a repeated number are features of all its words, which a fixed
  potential ties to each other in place of the chain's. Every occurrence is linked
  to the first, never all to all, so two of them are two links apart; a word in
  several repeated numbers is linked by the best (checksum, then the earliest);
- when spans are looked for, words that a base match touches have its kind;
- damped sum-product messages run over this loopy graph, for all texts of a group
  at once, until they settle (``ROUNDS`` ends those that swing for ever); that makes
  labels of repeated entities agree within a document.

A word that the field gives a kind with a marginal of ``SURE`` or more and that no
base match touches is an added span (neighbouring words of one kind are one span),
for example a card number that the base pattern lost because another number
follows it. Base spans always stay.

The field's weights are fitted, by gradient ascent with the same inference, to the
base labels of ``sample`` texts with such words, chosen by a hash of the text.

Defined results: null or empty text has no spans; with nothing to learn from, only
base spans are found; repeated rows have equal results.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pintime.llm.common import annotate, id_text, map_text, table

KINDS = ["email", "ip", "card", "phone"]
SAMPLE = 600        # texts that the field is fitted to, each of at most LONGEST characters
LONGEST = 20_000
ROUNDS, DAMPING = 200, 0.5
TIED = 6.0          # for one label of neighbouring words of a number, in nats
SURE = 0.8

# fixed patterns of the contract
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
# a match starts where its digits do, so other starts need no try
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_NODE = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
#: A word of a number over several words; a mark after it ends the number.
_PART = re.compile(r"([+(]*[0-9][0-9()-]*)[.,;:!?\"']*")
LEAST_OF_WORDS, MOST_OF_WORDS = 10, 19      # digits of a number over several words
_QUAD = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """From every ``@`` leftwards over the local part: each text is passed once."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1, start):
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def _small(digits: str) -> bool:
    """Whether a number without leading zeros, of any length, is at most 255."""
    return len(digits) <= 2 or (len(digits) == 3 and digits <= "255")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind), ordered by start, then kind."""
    out = []
    if "@" in text:
        out += [(s, e, 0) for s, e in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(_small(x.lstrip("0")) for x in m[0].split(".")):
                out.append((m.start(), m.end(), 1))
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


FEATURES = ["any", "at", "at.dot", "quad", "luhn", "1-3 digits", "4-6 digits", "7-13 digits",
            "14-19 digits", "20+ digits", "plus", "(digits)", "digits-digits", "only digits",
            "letters", "equals", "plus before", "(digits) before", "(digits) after",
            "digits-digits after", "alone"]
_F = {n: i for i, n in enumerate(FEATURES)}


@dataclass
class Graph:
    """Words of many texts: where they lie, their features, and their links."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    x: np.ndarray           # words x features
    links: np.ndarray       # (from, to): chain, skip, ties inside numbers
    n_chain: int
    n_tied: int = 0


def graph(texts: list[str]) -> Graph:
    where, starts, ends, rows, chain, skip = [], [], [], [], [], []
    number: dict[int, tuple] = {}   # of a word: rank and first word of its repeated number
    linked: dict[int, tuple] = {}   # of a word: rank and words of the first occurrence
    for t, text in enumerate(texts):
        if not _DIGIT.search(text) and "@" not in text:
            continue
        first: dict = {}
        run: list[tuple[int, str]] = []     # the number's last words: node, digits
        open_ = False                       # whether it may go on
        before = None
        for m in _NODE.finditer(text):
            k = len(starts)
            where.append(t)
            starts.append(m.start())
            ends.append(m.end())
            word = m[0]
            digits = _NOT_DIGIT.sub("", word)
            own = _own_features(word, digits)
            if before is not None and not text[ends[k - 1]:m.start()].strip(" \t\n\x0b\x0c\r"):
                chain.append((k - 1, k))
                prior = rows[k - 1]
                if prior[_F["plus"]]:
                    own[_F["plus before"]] = 1
                if prior[_F["(digits)"]]:
                    own[_F["(digits) before"]] = 1
                if own[_F["(digits)"]]:
                    prior[_F["(digits) after"]] = 1
                if own[_F["digits-digits"]]:
                    prior[_F["digits-digits after"]] = 1
                prior[_F["alone"]] = own[_F["alone"]] = 0
            rows.append(own)
            before = k
            part = _PART.fullmatch(word)
            if not (part and open_ and text[ends[k - 1]:m.start()] == " "):
                run = []
            open_ = bool(part) and part.end(1) == len(word)
            if "@" in word:
                address = word.strip(".,;:!?()\"'").lower()
                if first.setdefault(address, k) != k:
                    skip.append((first[address], k))
                continue
            run = [*run[1 - MOST_OF_WORDS:], (k, digits)]
            best = _repeat(first, run)
            if best:
                rank, whole, there, spans = best
                better = {j for j, _ in spans if j not in linked or rank > linked[j][0]}
                for i, j in _counterparts(there, spans) if better else ():
                    if j in better:
                        if j not in linked or linked[j][0] != rank:
                            linked[j] = rank, []
                        linked[j][1].append(i)
                if len(there) > 1 or len(spans) > 1:
                    size = _size(whole)
                    for nodes in (there, spans):
                        for i, _ in nodes:
                            if i not in number or rank > number[i][0]:
                                number[i] = rank, nodes[0][0]
                                for name, holds in size.items():
                                    rows[i][_F[name]] = float(holds)
    # neighbours in one repeated number are not two entities: their labels agree
    tied = [(a, b) for a, b in chain if a in number and number[a] == number.get(b)]
    if tied:
        inside = set(tied)
        chain = [link for link in chain if link not in inside]
    skip += [(i, j) for j, (_, words) in linked.items() for i in words]
    links = np.array(chain + skip + tied, np.int64).reshape(-1, 2)
    return Graph(np.array(where, np.int64), np.array(starts, np.int64), np.array(ends, np.int64),
                 np.array(rows, float).reshape(-1, len(FEATURES)), links, len(chain),
                 len(tied))


def _repeat(first: dict, run: list[tuple[int, str]]) -> tuple | None:
    """Of the numbers that end with the run's last word and were met before, the best: its
    rank (checksum, then the earliest first occurrence, then length), digits, the (word,
    digits) of the first occurrence and of this one."""
    best = None
    whole, spans = "", []
    for k, digits in reversed(run):
        whole, spans = digits + whole, [(k, len(digits)), *spans]
        if len(spans) > 1 and len(whole) > MOST_OF_WORDS:
            break
        if len(whole) < (6 if len(spans) == 1 else LEAST_OF_WORDS):
            continue
        there = first.setdefault(whole, spans)
        if there[-1][0] >= spans[0][0]:     # this one, or one that shares words
            continue
        rank = (_size(whole)["luhn"], -there[0][0], len(whole))
        if best is None or rank > best[0]:
            best = rank, whole, there, spans
    return best


def _counterparts(there: list[tuple[int, int]], spans: list[tuple[int, int]]
                  ) -> list[tuple[int, int]]:
    """Words of two occurrences of a number that share digits."""
    out, i, j, a, b = [], 0, 0, there[0][1], spans[0][1]
    while True:
        out.append((there[i][0], spans[j][0]))
        if i == len(there) - 1 and j == len(spans) - 1:
            return out
        step_a, step_b = a <= b, b <= a
        if step_a:
            i += 1
            a += there[i][1]
        if step_b:
            j += 1
            b += spans[j][1]


def _size(digits: str) -> dict[str, bool]:
    n = len(digits)
    return {"luhn": 14 <= n <= 19 and luhn(digits), "1-3 digits": 0 < n < 4,
            "4-6 digits": 4 <= n < 7, "7-13 digits": 7 <= n < 14, "14-19 digits": 14 <= n < 20,
            "20+ digits": n >= 20}


def _own_features(word: str, digits: str) -> list[float]:
    out = [0.0] * len(FEATURES)
    n = len(digits)
    hold = {
        "any": True, "at": "@" in word, "at.dot": bool(_DOMAIN.search(word)),
        "quad": bool(_QUAD.search(word)), **_size(digits), "plus": word[0] == "+",
        "(digits)": bool(re.fullmatch(r"\([0-9]+\)", word)),
        "digits-digits": bool(re.match(r"[0-9]{2,}-[0-9]{2,}", word)),
        "only digits": n == len(word.rstrip(".,;:!?$%&#*")),
        "letters": any(c.isalpha() for c in word), "equals": "=" in word, "alone": True,
    }
    for name, holds in hold.items():
        if holds:
            out[_F[name]] = 1.0
    return out


@dataclass(frozen=True)
class Field:
    """Weights: features x labels, and one table a kind of link."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def infer(g: Graph, field: Field, rounds: int = ROUNDS, known: np.ndarray | None = None
          ) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the words, and of the links (from label, to label).

    Words with a label above 0 in ``known`` have that label.
    """
    k = field.unary.shape[1]
    unary = g.x @ field.unary
    if known is not None:
        unary[known > 0] = np.where(np.eye(k)[known[known > 0]] > 0, 0.0, -50.0)
    n, n_links = len(unary), len(g.links)
    pair = np.empty((n_links, k, k))
    pair[:g.n_chain], pair[g.n_chain:] = field.chain, field.skip
    pair[n_links - g.n_tied:] = np.eye(k) * TIED
    source = np.r_[g.links[:, 0], g.links[:, 1]]
    target = np.r_[g.links[:, 1], g.links[:, 0]]
    table_ = np.concatenate([pair, pair.transpose(0, 2, 1)])
    back = np.r_[np.arange(n_links) + n_links, np.arange(n_links)]
    message = np.zeros((2 * n_links, k))
    belief = unary
    for _ in range(rounds if n_links else 0):
        out = (belief[source] - message[back])[:, :, None] + table_
        top = out.max(axis=1, keepdims=True)
        new = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
        new -= new.max(axis=1, keepdims=True)
        change = np.abs(new - message).max()
        message = DAMPING * message + (1 - DAMPING) * new
        belief = unary.copy()
        for label in range(k):
            belief[:, label] += np.bincount(target, message[:, label], n)
        if change < 1e-4:
            break
    p = np.exp(belief - belief.max(axis=1, keepdims=True)) if n else np.zeros((0, k))
    p /= p.sum(axis=1, keepdims=True)
    a = (belief[source[:n_links]] - message[back[:n_links]])[:, :, None]
    b = (belief[target[:n_links]] - message[:n_links])[:, None, :]
    both = a + b + pair
    both = np.exp(both - both.max(axis=(1, 2), keepdims=True)) if n_links else both
    return p, both / both.sum(axis=(1, 2), keepdims=True)


def base_labels(g: Graph, spans: list[list[tuple[int, int, int]]]) -> np.ndarray:
    """0 or 1 + kind of each word, by the base spans of its text that touch it."""
    out = np.zeros(len(g.start), np.int64)
    for t in np.unique(g.text):
        a, b = np.searchsorted(g.text, [t, t + 1])
        for s, e, kind in spans[t]:
            # the words of a text are in order and apart
            lo, hi = a + np.searchsorted(g.end[a:b], s, "right"), a + np.searchsorted(
                g.start[a:b], e, "left")
            hit = np.arange(lo, hi)
            out[hit[out[hit] == 0]] = kind + 1
    return out


def train(texts: list[str], rounds: int = 80, rate: float = 0.4, decay: float = 0.02) -> Field:
    """Fit the field to the base labels of texts."""
    k = len(KINDS) + 1
    g = graph(texts)
    labels = np.eye(k)[base_labels(g, [base_spans(t) for t in texts])]
    parts = [np.zeros((len(FEATURES), k)), np.zeros((k, k)), np.zeros((k, k))]
    squares = [np.full_like(p, 1e-8) for p in parts]
    a, b = labels[g.links[:, 0]], labels[g.links[:, 1]]
    seen = a[:, :, None] * b[:, None, :]
    for _ in range(rounds):
        p, both = infer(g, Field(*parts))
        gap = seen - both
        slopes = [g.x.T @ (labels - p), gap[:g.n_chain].sum(axis=0),
                  gap[g.n_chain:len(gap) - g.n_tied].sum(axis=0)]
        for part, square, slope in zip(parts, squares, slopes, strict=True):
            slope = slope - decay * part
            square += slope ** 2
            part += rate * slope / np.sqrt(square)
    # Links of equal words say that labels agree; a base sample rarely shows them differ.
    agree = np.eye(k) * 2.0
    return Field(parts[0], parts[1], np.maximum(parts[2], agree) * np.eye(k)
                 + np.minimum(parts[2], 0.0) * (1 - np.eye(k)))


def find(texts: list[str], field: Field | None, sure: float = SURE
         ) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """For each text, its base spans and the spans that the field adds."""
    out = [(base_spans(t), []) for t in texts]
    if field is None:
        return out
    g = graph(texts)
    if not len(g.start):
        return out
    p, _ = infer(g, field, known=base_labels(g, [base for base, _ in out]))
    kind = p[:, 1:].argmax(axis=1)
    sure_at = np.flatnonzero(p[np.arange(len(p)), kind + 1] >= sure)
    before = None
    for k in sure_at.tolist():
        t = int(g.text[k])
        text, (base, added) = texts[t], out[t]
        s, e = int(g.start[k]), int(g.end[k])
        while s < e and not (text[s].isalnum() or text[s] in "+("):
            s += 1
        while e > s and not (text[e - 1].isalnum() or text[e - 1] == ")"):
            e -= 1
        if s == e or any(a < e and b > s for a, b, _ in base):
            before = None
            continue
        if before == k - 1 and g.text[before] == t and added and added[-1][2] == kind[k] and (
                not text[g.end[before]:g.start[k]].strip(" \t\n\x0b\x0c\r")):
            added[-1] = (added[-1][0], e, int(kind[k]))
        else:
            added.append((s, e, int(kind[k])))
        before = k
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}"
                    for s, e, k in sorted(spans, key=lambda x: (x[0], x[2], x[1])))


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span (overlapping ones together) replaced by its kind."""
    out, at = [], 0
    for s, e, k in sorted(spans, key=lambda x: (x[0], -x[1])):
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def fit(docs: DataFrame, sample: int = SAMPLE, longest: int = LONGEST,
        text_col: str = "text") -> Field | None:
    """Train on a bounded sample of texts with digits or addresses; None without any."""
    rows = (docs.select(F.col(text_col).cast("string").alias("text"))
            .where((F.char_length("text") <= longest) & F.col("text").rlike("[0-9@]"))
            .select(F.xxhash64("text").alias("h"), "text"))
    # the least hashes first, so that no task sends texts that aren't chosen
    chosen = [r["h"] for r in rows.select("h").distinct().orderBy("h").limit(sample).collect()]
    texts = [r["text"] for r in rows.where(F.col("h") <= chosen[-1]).groupBy("h")
             .agg(F.min("text").alias("text")).orderBy("h").collect()] if chosen else []
    return train(texts) if texts else None


def personal_data(docs: DataFrame, field: Field | None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: base counts, the digest of the base spans, and all spans."""
    def work(ids: list, texts: list[str]) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": ids, **{f"n_{k}": [] for k in KINDS},
                                "base_sha256": [], "spans": []}
        for base, added in find(texts, field):
            for i, k in enumerate(KINDS):
                out[f"n_{k}"].append(sum(s[2] == i for s in base))
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined(base + added))
        return out

    schema = ("doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS)
              + ", base_sha256 string, spans string")
    return map_text(id_text(docs, id_col, text_col), schema, work)


def redacted(docs: DataFrame, field: Field | None, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns _redacted (the text without personal data) and _found."""
    def work(texts: list[str]) -> dict[str, list]:
        found = find(texts, field)
        return {"_redacted": [redact(t, b + a) for t, (b, a) in zip(texts, found, strict=True)],
                "_found": [len(b) + len(a) for b, a in found]}

    return annotate(docs, text_col, "_redacted string, _found long", work)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return personal_data(docs, fit(docs))
