"""The pipeline: every stage against its operator or brute force, and odd inputs."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pintime.llm import language_id, personal_data, quality
from pintime.llm.common import table
from tests.llm.helpers import ODD_TEXTS, SF, brute_components, frame, shingles


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage returns for the smallest table, written and read again."""
    docs = table(spark, SF, "documents")
    out, folder = [docs], tmp_path_factory.mktemp("stages")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SF).write.parquet(f"{folder}/{i}")
        out.append(spark.read.parquet(f"{folder}/{i}"))
    return out


def test_columns_stay(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_language_stage(stages):
    ids = {r.doc_id for r in stages[1].collect()}
    model = language_id.fit(stages[0])
    docs = stages[0].collect()
    gain = dict(zip([r.doc_id for r in docs], language_id.explained(
        [r.text or "" for r in docs], model)[2], strict=True))
    want = {r.doc_id for r in language_id.identify(stages[0], model).collect()
            if r.lang_pred != "und" and r.score >= corpus_pipeline.MIN_LANGUAGE_SHARE
            and gain[r.doc_id] > 0}
    assert ids == want and len(ids) >= 195


def test_quality_stage(stages):
    rows = quality.quality(stages[1], quality.references(stages[1])).collect()
    assert {r.doc_id for r in stages[2].collect()} == {r.doc_id for r in rows if r.kept}
    assert any(not r.kept for r in rows)


def test_near_duplicate_stage(stages):
    before = {r.doc_id: r.text for r in stages[2].collect()}
    want = brute_components({d: shingles(t) for d, t in before.items()},
                            corpus_pipeline.NEAR_PERCENT)
    assert {r.doc_id for r in stages[3].collect()} == {d for d, c in want.items() if c == d}
    assert stages[3].count() < len(before)


def test_personal_data_stage(stages):
    before = {r.doc_id: r for r in stages[3].collect()}
    field = personal_data.fit(stages[3])
    after = {r.doc_id: r for r in stages[4].collect()}
    assert set(after) == set(before)
    for d, r in after.items():
        (base, added), = personal_data.find([before[d].text], field)
        assert r.text == personal_data.redact(before[d].text, base + added)
        assert personal_data.base_spans(r.text) == []
        assert r.n_chars == (len(r.text) if base or added else before[d].n_chars)


def test_packing_stage_and_run(spark, stages):
    from tokenizers import Tokenizer
    import public_tokenizers
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by = defaultdict(list)
    for r in corpus_pipeline.run(spark, SF).collect():
        by[r.doc_id].append(r)
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    assert set(by) == set(texts)
    for d, t in texts.items():
        ids = [x for r in sorted(by[d], key=lambda r: r.start) for x in r.ids]
        assert ids == [*tok.encode(t, add_special_tokens=False).ids, 1]


def test_odd_documents_pass_every_stage(spark):
    prose = "The quick fox, who ran over the hill, saw that it was late and went home to sleep. "
    texts = [*ODD_TEXTS, prose * 2 + "One.", prose * 2 + "One.", prose + "It rained, so nobody came."]
    docs = frame(spark, texts).unionByName(frame(spark, [prose + "Twenty birds sang there."] * 2))
    docs = docs.unionByName(docs.where("doc_id = 5").selectExpr(
        "cast(null as long) as doc_id", *[c for c in docs.columns if c != "doc_id"]))
    for df in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, SF)
            df = spark.createDataFrame(df.collect(), df.schema)


FOREIGN = [
    "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. " * 3,
    "Все люди рождаются свободными и равными в своем достоинстве и правах. " * 3,
    "यह एक साफ पाठ है जो किसी छोटी भाषा में लिखा गया और इसमें कोई गड़बड़ नहीं। " * 3,
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. " * 3,
    "zxq vvkj qqpw xzzj kkqx wwvz jjxq pqzk vxwj zzqk xvvj qwxz " * 5,
]


def test_texts_of_no_learned_language_go(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(10**9 + i, t, None, "x", len(t)) for i, t in enumerate(FOREIGN)]
    both = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    left = {r.doc_id for r in corpus_pipeline.identify_language(spark, both, SF).collect()}
    assert not [i for i in range(len(FOREIGN)) if 10**9 + i in left]
    gone = [r for r in docs.collect() if r.doc_id not in left]
    assert len(gone) <= 5 and all(len(r.text or "") < 60 for r in gone)


def test_every_internal_name_may_be_a_column(spark):
    docs = table(spark, SF, "documents")
    names = ["_lang_pred", "_score", "_shares", "_gain", "_verdict", "verdict0", "_chars", "_words",
             "_kept", "kept", "_redacted", "_found", "doc", "key", "component_id", "first", "given",
             "signature", "text_key", "shingles", "n_shingles", "a b", "order"]
    named = docs.withColumns({n: F.lit(f"mine {n}") for n in names})
    plain, extra = docs, named
    for _, stage in corpus_pipeline.STAGES[:-1]:
        plain, extra = (spark.createDataFrame(d.collect(), d.schema) for d in (
            stage(spark, plain, SF), stage(spark, extra, SF)))
        assert extra.columns == named.columns
        assert sorted(map(str, extra.select(*docs.columns).collect())) == sorted(
            map(str, plain.collect()))
        assert extra.where(" or ".join(f"`{n}` <> 'mine {n}'" for n in names)).count() == 0
    assert corpus_pipeline.pack_sequences(spark, extra, SF).count() == (
        corpus_pipeline.pack_sequences(spark, plain, SF).count())


def test_repeated_and_missing_ids(spark):
    a = "one clean text of some words that is here to be kept by all of us today " * 3
    b = "quite another story in which nobody is found who would have known the first one " * 3
    rows = [(7, a), (7, b), (7, b), (3, b + " end"), (None, a), (None, "only here " + a[:90] + b[:99])]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for parts in (1, 4):
        got = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(parts), SF).collect()
        assert sorted((r.doc_id or 0, r.text) for r in got) == sorted(
            [(7, a), (3, b + " end"), (0, rows[5][1])])
