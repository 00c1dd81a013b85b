"""Small frames for the operators' tests."""

import re

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")

ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "  two  blanks and a trailing one ", "tab\tand\r\nline ends\x0b\x0c",
    "x\x1cy \x85 z\xa0 \n w　v", "<|endoftext|> and <s> </s> <unk> <0x0A>", "▁ marks ▁▁ inside",
    "I'm sure we'll say it's done, they've said I'd", "日本語のテキスト 中文 한국어", "😀é‍ ẞ ﬁ",
    "a" * 3000, "ab" * 2000, " " * 70 + "x", "\x00\x01 control", "the the the the " * 60,
    "numbers 1234567890 12,345.67 ١٢٣", "word " * 9000, "### </turn> \\### Assistant: ",
]


def frame(spark, texts, extra=True, first_id=0):
    """documents with the given texts, and columns whose names clash with results."""
    rows = [(first_id + i, t, "en" if i % 3 else None, f"src{i}", None if t is None else len(t))
            for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                     "n_chars long")
    if extra:
        names = ["start", "length", "n_tokens", "n_words", "kept", "score", "lang_pred", "spans",
                 "ids", "bucket", "signature", "_e", "component", "n"]
        df = df.withColumns({n: F.lit("clash") for n in names})
    return df


def words(text):
    return WORD.findall((text or "").encode())


def shingles(text):
    w = [x.lower() for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute_components(sets, percent=85):
    """Least id reachable over pairs with 100 * intersection >= percent * union."""
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            both = len(x & y)
            if both and 100 * both >= percent * (len(x) + len(y) - both):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {d: root(d) for d in sets}
