"""Point-in-time join: hand-made edge cases and a brute-force property check."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import types as T

from pintime.operators.asof import AsofSide, asof_join

ENT = T.StructType([T.StructField("state", T.StringType()),
                    T.StructField("event_timestamp", T.TimestampNTZType()),
                    T.StructField("tag", T.IntegerType())])
FEAT = T.StructType([T.StructField("state", T.StringType()),
                     T.StructField("date", T.TimestampNTZType()),
                     T.StructField("f", T.DoubleType()), T.StructField("g", T.DoubleType())])
D = datetime.fromisoformat


def run(spark, ents, feats, ttl=None, bucket_days=91, **kw):
    e = spark.createDataFrame(ents, ENT)
    f = spark.createDataFrame(feats, FEAT)
    side = AsofSide(df=f, ts="date", features=["f", "g"], ttl=ttl)
    return sorted((r.tag, r.f, r.g) for r in
                  asof_join(e, side, ["state"], bucket_days=bucket_days, **kw).collect())


@pytest.mark.parametrize("bucket_days", [None, 1, 91])
def test_edge_cases(spark, bucket_days):
    feats = [("A", D("2021-01-04"), 1.0, 1.0),
             ("A", D("2021-01-11"), 2.0, None),     # newest row has a null feature
             ("B", D("2021-02-01"), 5.0, 5.0),      # only later than B's entity
             (None, D("2021-01-01"), 9.0, 9.0)]     # null key never matches
    ents = [("A", D("2021-01-04"), 1),              # same instant: visible
            ("A", D("2021-01-12"), 2), ("A", D("2021-01-12"), 3),   # equal entity rows
            ("B", D("2021-01-20"), 4),
            ("Z", D("2021-01-20"), 5),              # unknown key
            (None, D("2021-01-20"), 6)]             # null key
    got = run(spark, ents, feats, bucket_days=bucket_days)
    assert got == [(1, 1.0, 1.0), (2, 2.0, None), (3, 2.0, None), (4, None, None),
                   (5, None, None), (6, None, None)]


@pytest.mark.parametrize("bucket_days", [None, 2])
def test_ttl_bounds_inclusive(spark, bucket_days):
    feats = [("A", D("2021-01-01 00:00:00"), 1.0, 1.0),
             ("B", D("2020-12-31 23:59:59"), 2.0, 2.0)]
    ents = [("A", D("2021-01-04 00:00:00"), 1), ("B", D("2021-01-04 00:00:00"), 2)]
    got = run(spark, ents, feats, ttl=timedelta(days=3), bucket_days=bucket_days)
    assert got == [(1, 1.0, 1.0), (2, None, None)]


def brute(ents, feats, ttl):
    out = []
    for key, ets, tag in ents:
        best = None
        for fk, fts, f, g in feats:
            if key is None or ets is None or fk != key or fts > ets:
                continue
            if ttl is not None and fts < ets - ttl:
                continue
            if best is None or (fts, f if f is not None else -1e9, g if g is not None else -1e9) > \
                    (best[0], best[1] if best[1] is not None else -1e9,
                     best[2] if best[2] is not None else -1e9):
                best = (fts, f, g)
        out.append((tag, None, None) if best is None else (tag, best[1], best[2]))
    return sorted(out, key=lambda r: r[0])


@pytest.mark.parametrize("ttl_days,bucket_days",
                         [(None, 3), (2, 5), (10, None), (0, 7), (1000, 1), (5, 30)])
def test_matches_brute_force(spark, ttl_days, bucket_days):
    rnd = random.Random(7 + (ttl_days or 0))
    base = D("2021-01-01")
    keys = ["A", "B", "C", None]
    feats = []
    seen = set()
    for _ in range(300):
        k = rnd.choice(keys)
        t = base + timedelta(days=rnd.randint(0, 60))
        if (k, t) in seen:           # one feature row per (key, time) for a clean oracle
            continue
        seen.add((k, t))
        feats.append((k, t, rnd.choice([None, float(rnd.randint(0, 9))]), float(rnd.randint(0, 9))))
    ents = [(rnd.choice(keys + ["Z"]), base + timedelta(days=rnd.randint(-5, 70), hours=rnd.choice([0, 12])), i)
            for i in range(400)]
    # a block of rows at one instant of one key, and exact copies (same tag)
    ents += [("A", base + timedelta(days=20), 400 + i) for i in range(60)]
    ents += [("B", base + timedelta(days=33), 999)] * 40
    # hot null keys and times, and hot (copied) feature rows
    ents += [(None, base, 2000 + i) for i in range(50)] + [("A", None, 3000 + i) for i in range(30)]
    feats += [f for f in feats if f[0] == "C"] * 20
    ttl = None if ttl_days is None else timedelta(days=ttl_days)
    want = brute(ents, feats, ttl)
    for group_rows in (None, 500_000, 10):
        assert run(spark, ents, feats, ttl=ttl, bucket_days=bucket_days,
                   group_rows=group_rows) == want


def test_a_hot_day_is_cut_into_bounded_groups(spark):
    """Most instants of one key lie inside an hour of one day, half of those in a minute."""
    from pintime.operators import asof
    rnd, day = random.Random(3), D("2021-05-05 10:00:00")
    near = lambda i: day + timedelta(microseconds=rnd.randrange(
        60 * 10**6 if i % 2 else 3600 * 10**6))
    feats = [("hot", near(i), float(i), 1.0) for i in range(3000)]
    feats += [(k, day + timedelta(days=rnd.randrange(-200, 200)), 1.0, None) for k in "abc"
              for _ in range(40)]
    ents = [("hot", near(i), i) for i in range(1500)] + [
        ("hot", day + timedelta(days=d), 2000 + d) for d in (-3, 3, 100)]
    assert run(spark, ents, feats, group_rows=100) == brute(ents, feats, None)
    e, f = spark.createDataFrame(ents, ENT), spark.createDataFrame(feats, FEAT)
    side = asof.AsofSide(df=f, ts="date", features=["f", "g"])
    timeline = asof._timeline(e, [side], ["state"], "event_timestamp", ["_k0"], ["_f0"], 91)
    sizes = [r["count"] for r in asof._grouped(timeline, ["_k0"], ["_f0"], 100).groupBy(
        "_k0", "_b", "_s").count().collect()]
    assert max(sizes) <= 200 and len(sizes) > 40
    whole = [r["count"] for r in timeline.groupBy("_k0", "_b").count().collect()]
    assert max(whole) > 4000


def test_two_views_one_pass_and_row_count(spark):
    e = spark.createDataFrame([("A", D("2021-01-10"), 1), ("A", D("2021-01-10"), 2)], ENT)
    f1 = spark.createDataFrame([("A", D("2021-01-05"), 1.0, 2.0)], FEAT)
    f2 = spark.createDataFrame([("A", D("2021-01-09"), 3.0, 4.0)], FEAT).withColumnRenamed(
        "f", "h").withColumnRenamed("g", "k")
    out = asof_join(e, [AsofSide(f1, "date", ["f", "g"]), AsofSide(f2, "date", ["h", "k"])],
                    ["state"])
    assert out.columns == ["state", "event_timestamp", "tag", "f", "g", "h", "k"]
    assert sorted(tuple(r)[2:] for r in out.collect()) == [(1, 1.0, 2.0, 3.0, 4.0),
                                                            (2, 1.0, 2.0, 3.0, 4.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_name_collision_raises(spark):
    e = spark.createDataFrame([("A", D("2021-01-10"), 1)], ENT).withColumnRenamed("tag", "f")
    f = spark.createDataFrame([("A", D("2021-01-05"), 1.0, 2.0)], FEAT)
    with pytest.raises(ValueError):
        asof_join(e, AsofSide(f, "date", ["f", "g"]), ["state"])


def test_created_timestamp_breaks_ties(spark):
    from pintime.operators.latest import latest_per_key
    feats = spark.createDataFrame(
        [("A", D("2021-01-04"), D("2021-01-05"), 9.0),     # same event time, created earlier
         ("A", D("2021-01-04"), D("2021-01-06"), 1.0)],    # created later: wins
        "state string, date timestamp_ntz, created timestamp_ntz, f double")
    ents = spark.createDataFrame([("A", D("2021-01-10"), 1)], ENT)
    out = asof_join(ents, AsofSide(feats, "date", ["f"], created="created"), ["state"]).first()
    assert out.f == 1.0
    snap = latest_per_key(feats, ["state"], "date", ["f"], created="created").first()
    assert snap.f == 1.0


def test_few_entity_keys_reduce_the_feature_scan(spark, tmp_root):
    from pintime.definitions import Entity, FeatureService, FeatureSource, FeatureView, Field
    from pintime.plans.retrieval import get_historical_features
    rows = [(f"K{i % 500}", D("2021-01-01") + timedelta(days=i // 500), float(i))
            for i in range(5000)]
    spark.createDataFrame(rows, "state string, date timestamp_ntz, x double").write.parquet(
        f"{tmp_root}/x")
    view = FeatureView("v", [Entity("state", ("state",))], timedelta(days=100),
                       [Field("x", T.DoubleType())], FeatureSource("s", "date",
                                                                   path=f"{tmp_root}/x"))
    ents = spark.createDataFrame([(f"K{i}", D("2021-01-06"), i) for i in range(10)]
                                 + [(None, D("2021-01-06"), 10), ("no", None, 11)], ENT)
    get = lambda n: get_historical_features(
        spark, FeatureService("f", [view]), ents, few_keys=n)
    few, all_keys = get(100), get(0)
    cut = get_historical_features(spark, FeatureService("f", [view]), ents, group_rows=50)
    assert sorted(map(str, cut.collect())) == sorted(map(str, all_keys.collect()))
    assert sorted(map(str, few.collect())) == sorted(map(str, all_keys.collect()))
    assert {r.tag: r.x for r in few.collect()}[3] == 2503.0
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi" in plan and "Join LeftSemi" not in (
        all_keys._jdf.queryExecution().optimizedPlan().toString())
    # only the rows of the ten keys reach the exchange of the timeline
    semi = view.to_df(spark).join(ents.select("state").distinct(), "state", "left_semi")
    assert semi.count() == 100
    assert plan.index("Aggregate") < plan.index("Join LeftSemi")
