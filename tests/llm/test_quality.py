"""Quality rules against a brute-force version, and their SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from pintime.llm import quality
from pintime.llm.common import table
from pintime.llm.oracle import ORACLE_SQL
from pintime.llm.quality import CLASSES, RARE, op3_quality
from tests.llm.helpers import ODD_TEXTS, SF, frame


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(i, i + 8))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def test_counts_of_odd_texts(spark):
    texts = [*ODD_TEXTS, "one two three four five six seven eight " * 3, "a b c d e f g h\n" * 4,
             "x y\nx y\n\n \nx y", "w1 w2 w3 w4 w5 w6 w7 w8 q w2 w3 w4 w5 w6 w7 w8 w1 w2"]
    df = frame(spark, texts)
    rows = {r.doc_id: r for r in quality.quality(df, quality.references(df)).collect()}
    for d, t in enumerate(texts):
        r, want = rows[d], brute(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_empty_table_and_no_languages(spark):
    df = frame(spark, ["a few words are here"])
    empty = df.limit(0)
    refs = quality.references(empty)
    assert refs.classes == {} and quality.quality(empty, refs).count() == 0
    row = quality.quality(df, refs).first()
    assert row.class_distance is None and row.word_distance is None and not row.kept


def test_distances_by_hand(spark):
    docs = table(spark, SF, "documents")
    refs = quality.references(docs)
    assert set(refs.words) == {"en", "de", "fr", "es"}
    assert all(len(w) == quality.TOP_WORDS for w in refs.words.values())

    def distance(p, q):
        part = lambda x, y: 0.5 * x * math.log2(2 * x / (x + y)) if x > 0 else 0.0
        return math.sqrt(max(0.0, sum(part(a, b) + part(b, a) for a, b in zip(p, q, strict=True))))

    by_id = {r.doc_id: r for r in quality.quality(docs, refs).collect()}
    for r in docs.collect():
        got = by_id[r.doc_id]
        letters = [w for w in re.split(r"[^\W\d_]+", "")]  # noqa: F841
        words = re.findall(r"[^\W\d_]+", r.text.lower())
        if got.base_failed or got.n_words < quality.MIN_WORDS:
            assert got.word_distance is None
        elif words:
            counts = Counter(words)
            want = []
            for shares in refs.words.values():
                p = [counts[w] / len(words) for w in shares]
                want.append(distance([*p, max(0.0, 1 - sum(p))],
                                     [*shares.values(), 1 - sum(shares.values())]))
            assert got.word_distance == pytest.approx(min(want), abs=1e-9)
    assert len(refs.classes["en"]) == len(CLASSES) == len(RARE) + 2


def test_clean_documents_stay_and_littered_ones_go(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    out = quality.quality(docs, quality.references(docs)).join(labels, "doc_id").where(
        "not base_failed").toPandas()
    good = out[out.quality == 1]
    assert good.kept.mean() >= 0.995
    assert out[out.quality == 0].kept.mean() <= 0.15


def test_sql_agrees_and_no_python(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(ORACLE_SQL["op3_quality"]).fetchdf().sort_values("doc_id")
    df = op3_quality(spark, SF)
    got = df.toPandas().sort_values("doc_id")[list(want.columns)]
    assert got.values.tolist() == want.values.tolist()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


HINDI = ("यह एक साफ पाठ है जो किसी छोटी भाषा में लिखा गया और इसमें कोई गड़बड़ नहीं हम लोग सुबह नदी के "
         "किनारे घूमने गए थे वहाँ बच्चे खेल रहे बाद घर लौट आए").split()


def hindi(seed, n):
    return " ".join(random.Random(seed).choices(HINDI, k=n)) + "।"


def verdicts(spark, extra):
    """Reference languages, and the verdicts on (text, lang) rows beside sf0.01's thousand."""
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    rows = [(10 ** 9 + i, t, lang) for i, (t, lang) in enumerate(extra)]
    both = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    refs = quality.references(both)
    out = quality.quality(both, refs).where(f"doc_id >= {10 ** 9}").orderBy("doc_id").collect()
    return set(refs.words), out


def test_no_rule_rejects_a_language_without_reference(spark):
    known, (row,) = verdicts(spark, [(hindi(1, 45), "hi")])
    assert known == {"en", "de", "fr", "es"}
    assert row.class_distance > quality.MAX_CLASS_DISTANCE and not row.base_failed and row.kept


def test_small_share_of_a_large_table_makes_a_reference(spark):
    junk = " ".join(f"QXZ;{i}.-" for i in range(60))
    known, rows = verdicts(spark, [(hindi(2, 4000), "hi"), (hindi(3, 60), None), (junk, "hi")])
    assert known == {"en", "de", "fr", "es", "hi"}
    assert [r.base_failed for r in rows] == [False] * 3
    assert [r.kept for r in rows] == [True, True, False]


def test_plan_does_not_grow_with_the_languages(spark):
    docs = table(spark, SF, "documents")
    refs = quality.references(docs)
    many = quality.References({f"{k}{i}": v for i in range(75) for k, v in refs.classes.items()},
                              {f"{k}{i}": v for i in range(75) for k, v in refs.words.items()})
    few = quality.quality(docs, refs).drop("kept").orderBy("doc_id").collect()
    assert quality.quality(docs, many).drop("kept").orderBy("doc_id").collect() == few


def test_without_lang_only_a_recognised_text_is_judged(spark):
    """A clean text of a language without reference, and littered texts, all without lang."""
    prose = next(r.text for r in table(spark, SF, "documents").where("lang = 'en'").collect()
                 if r.text and 900 < len(r.text) < 4000 and not brute(r.text)[4])
    littered = prose.replace(" ", " ;;--((\"' ")
    known, (a, b, c) = verdicts(spark, [(hindi(1, 60), None), (prose, None), (littered, None)])
    assert "hi" not in known
    assert a.class_distance > quality.MAX_CLASS_DISTANCE and a.kept
    assert b.kept and not b.base_failed
    assert c.class_distance > quality.MAX_CLASS_DISTANCE and not c.kept and not c.base_failed


def test_common_words_of_any_length(spark):
    text = "unmistakably long words internationalisation here " * 300
    refs = quality.references(spark.createDataFrame([(1, text, "en")],
                                                    "doc_id long, text string, lang string"))
    assert refs.words["en"]["internationalisation"] == pytest.approx(0.2)
    assert sum(refs.words["en"].values()) == pytest.approx(1)


def test_given_columns_are_kept_whatever_their_names(spark):
    names = ["given", "text", "lang", "words", "rest", "lines", "chars", "spaces", "letters",
             "symbols", "n_capital", "p0", "class_distance", "word_distance", "_chars", "_words",
             "a b", "_verdict2"]
    df = frame(spark, ["some words are here " * 9, None], extra=False).select(
        "doc_id", "source", *[F.lit(f"mine {n}").alias(n) if n not in ("text", "lang")
                              else F.col(n) for n in names])
    refs = quality.references(df, min_reference_chars=1)
    out = quality.with_verdict(df, refs)
    assert out.columns == [*df.columns, "_verdict"]
    assert sorted(map(str, out.drop("_verdict").collect())) == sorted(map(str, df.collect()))
    with pytest.raises(ValueError):
        quality.with_verdict(out, refs)


def test_sql_and_engine_take_the_same_references(spark, tmp_path):
    """A language with many short documents and little text, one with text in one document,
    and rows without lang."""
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    extra = [(10**9 + i, hindi(i, 5), "hi") for i in range(60)]
    extra += [(2 * 10**9, hindi(99, 4000), "mr"), (2 * 10**9 + 1, hindi(98, 60), None),
              (2 * 10**9 + 2, "QX;-" * 60 + " a b c d e" * 9, "hi"),
              (2 * 10**9 + 3, "QX;- Z9; " * 3 + hindi(7, 60), "mr")]
    both = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    path = str(tmp_path / "documents.parquet")
    both.toPandas().to_parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    want = con.execute(ORACLE_SQL["op3_quality"]).fetchdf().sort_values("doc_id")
    refs = quality.references(both)
    assert set(refs.words) == {"en", "de", "fr", "es", "mr"}
    got = quality.quality(both, refs).select(quality.COLUMNS).toPandas().sort_values("doc_id")
    assert got[list(want.columns)].values.tolist() == want.values.tolist()
