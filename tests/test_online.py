"""Newest-per-key, upsert, expiry, incremental materialization and lookup."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pintime.definitions import Entity, FeatureService, FeatureSource, FeatureView, Field
from pintime.operators.latest import expire, latest_per_key, upsert
from pintime.plans.online import SnapshotStore, get_online_features, materialize_incremental

D = datetime.fromisoformat
SCHEMA = T.StructType([T.StructField("state", T.StringType()),
                       T.StructField("date", T.TimestampNTZType()),
                       T.StructField("x", T.LongType())])


def snap_rows(df):
    return sorted((r.state, r.event_ts, r.x) for r in df.collect())


def test_latest_upsert_expire(spark):
    src = spark.createDataFrame([("A", D("2021-01-04"), 1), ("A", D("2021-01-11"), 2),
                                 ("B", D("2021-01-04"), 3)], SCHEMA)
    snap = latest_per_key(src, ["state"], "date", ["x"])
    assert snap_rows(snap) == [("A", D("2021-01-11"), 2), ("B", D("2021-01-04"), 3)]
    inc = latest_per_key(spark.createDataFrame(
        [("A", D("2021-01-04"), 9),        # late older row: ignored
         ("B", D("2021-01-04"), 7),        # equal time: new wins
         ("C", D("2021-01-18"), 5)], SCHEMA), ["state"], "date", ["x"])
    merged = upsert(snap, inc, ["state"], ["x"])
    assert snap_rows(merged) == [("A", D("2021-01-11"), 2), ("B", D("2021-01-04"), 7),
                                 ("C", D("2021-01-18"), 5)]
    empty = latest_per_key(src.where(F.lit(False)), ["state"], "date", ["x"])
    assert snap_rows(upsert(snap, empty, ["state"], ["x"])) == snap_rows(snap)
    kept = expire(merged, F.lit(D("2021-01-18")).cast("timestamp_ntz"), timedelta(days=7))
    assert snap_rows(kept) == [("A", D("2021-01-11"), 2), ("C", D("2021-01-18"), 5)]


def _view(path, ttl=timedelta(days=365)):
    state = Entity("state", ("state",))
    return FeatureView("v", [state], ttl, [Field("x", T.LongType())],
                       FeatureSource("src", "date", path=path))


def test_incremental_equals_full(spark, tmp_root):
    rows = [("A", D("2021-01-04"), 1), ("A", D("2021-01-11"), 2), ("B", D("2021-01-05"), 3),
            ("B", D("2021-02-01"), 4), ("C", D("2021-03-01"), 5)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_root}/src")
    view = _view(f"{tmp_root}/src")
    inc_store = SnapshotStore(spark, f"{tmp_root}/inc")
    for end in ["2021-01-06", "2021-01-20", "2021-02-15"]:
        materialize_incremental(spark, inc_store, view, end_ts=D(end))
    full = materialize_incremental(spark, SnapshotStore(spark, f"{tmp_root}/full"), view,
                                   end_ts=D("2021-02-15"))
    assert snap_rows(inc_store.snapshot("v")) == snap_rows(full)
    # the row dated after end_ts is not published; versions move forward
    assert ("C", D("2021-03-01"), 5) not in snap_rows(full)
    assert inc_store.current("v").version == 3
    # a first run starts at end - ttl: with a 30-day TTL only B's February row is in range
    short = materialize_incremental(spark, SnapshotStore(spark, f"{tmp_root}/short"),
                                    _view(f"{tmp_root}/src", timedelta(days=30)),
                                    end_ts=D("2021-02-15"))
    assert snap_rows(short) == [("B", D("2021-02-01"), 4)]
    req = spark.createDataFrame([("A",), ("Z",)], "state string")
    svc = FeatureService("s", [view])
    got = sorted((r.state, r.x) for r in get_online_features(inc_store, svc, req).collect())
    assert got == [("A", 2), ("Z", None)]


def test_publish_after_a_crash_and_no_rewind(spark, tmp_root):
    rows = [("A", D("2021-01-04"), 1), ("A", D("2021-01-11"), 2), ("B", D("2021-01-05"), 3)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_root}/src")
    view, store = _view(f"{tmp_root}/src"), SnapshotStore(spark, f"{tmp_root}/s")
    # a run that died after its snapshot and before its state row
    spark.createDataFrame([("Z",)], "x string").write.parquet(f"{tmp_root}/s/v/layer=dead")
    first = materialize_incremental(spark, store, view, end_ts=D("2021-02-15"))
    assert store.current("v").version == 1
    again = materialize_incremental(spark, store, view, end_ts=D("2021-01-06"))
    assert snap_rows(again) == snap_rows(first)
    assert store.current("v").end_ts == D("2021-02-15") and store.current("v").version == 2
    # values older than the TTL at the end are evicted
    late = materialize_incremental(spark, store, _view(f"{tmp_root}/src", timedelta(days=40)),
                                   end_ts=D("2021-02-16"))
    assert snap_rows(late) == [("A", D("2021-01-11"), 2)]
    now = materialize_incremental(spark, SnapshotStore(spark, f"{tmp_root}/now"), view)
    assert now.count() == 0


def keyed(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def sizes(spark, root):
    """Rows of each layer, by when it was committed."""
    store = SnapshotStore(spark, root)
    return [spark.read.parquet(f"{root}/v/layer={n}").count() for n in store.current("v").layers]


def test_an_increment_writes_its_rows_alone(spark, tmp_root):
    many = [(f"K{i}", D("2021-01-04"), i) for i in range(1000)]
    few = [(f"K{i}", D("2021-01-11"), -i) for i in range(0, 1000, 100)]
    keyed(spark, many + few).write.parquet(f"{tmp_root}/src")
    view, root = _view(f"{tmp_root}/src"), f"{tmp_root}/s"
    store = SnapshotStore(spark, root)
    materialize_incremental(spark, store, view, end_ts=D("2021-01-05"))
    snap = materialize_incremental(spark, store, view, end_ts=D("2021-01-12"))
    assert sizes(spark, root) == [1000, 10]
    want = {f"K{i}": (-i if i % 100 == 0 else i) for i in range(1000)}
    assert {r.state: r.x for r in snap.collect()} == want
    before = store.current("v")
    store.compact("v")
    assert sizes(spark, root) == [1000] and store.current("v").version == before.version + 1
    assert {r.state: r.x for r in store.snapshot("v").collect()} == want
    assert store.vacuum("v", keep=1) == 2
    assert {r.state: r.x for r in store.snapshot("v").collect()} == want


def test_layers_are_merged_past_a_number(spark, tmp_root):
    rows = [(k, D("2021-01-01") + timedelta(days=d), d) for d in range(9) for k in "AB"]
    keyed(spark, rows).write.parquet(f"{tmp_root}/src")
    store = SnapshotStore(spark, f"{tmp_root}/s", max_deltas=2)
    depth = []
    for d in range(9):
        snap = materialize_incremental(spark, store, _view(f"{tmp_root}/src"),
                                       end_ts=D("2021-01-01") + timedelta(days=d))
        depth.append(len(store.current("v").layers))
        assert {r.state: r.x for r in snap.collect()} == {"A": d, "B": d}
    assert depth == [1, 2, 3, 1, 2, 3, 1, 2, 3]


def test_the_second_of_two_publishers_is_refused(spark, tmp_root):
    import pytest

    from pintime.plans.online import VersionConflict
    keyed(spark, [("A", D("2021-01-04"), 1)]).write.parquet(f"{tmp_root}/src")
    store = SnapshotStore(spark, f"{tmp_root}/s")
    materialize_incremental(spark, store, _view(f"{tmp_root}/src"), end_ts=D("2021-01-05"))
    read = store.current("v")
    rows = store.snapshot("v")
    store.publish("v", rows, ["state"], D("2021-01-06"), based_on=read)
    with pytest.raises(VersionConflict):
        store.publish("v", rows, ["state"], D("2021-01-07"), based_on=read)
    assert store.current("v").end_ts == D("2021-01-06")
    store.drop("v")
    assert store.current("v") is None and store.snapshot("v") is None


def test_lookup_prunes_buckets_and_checks_the_ttl(spark, tmp_root):
    rows = [(f"K{i}", D("2021-01-01") + timedelta(days=i % 30), i) for i in range(300)]
    keyed(spark, rows).write.parquet(f"{tmp_root}/src")
    view = _view(f"{tmp_root}/src", timedelta(days=20))
    store = SnapshotStore(spark, f"{tmp_root}/s", buckets=32)
    materialize_incremental(spark, store, view, end_ts=D("2021-01-15"))
    materialize_incremental(spark, store, view, end_ts=D("2021-01-31"))
    svc = FeatureService("s", [view])
    asked = spark.createDataFrame([("K7",), ("K29",), ("K0",), (None,), ("K7",), ("no",)],
                                  "state string")
    got = get_online_features(store, svc, asked)
    assert sorted((r.state or "", r.x) for r in got.collect()) == [
        ("", None), ("K0", None), ("K29", 29), ("K7", None), ("K7", None), ("no", None)]
    # K7 is of the 8th, K0 of the 1st; a lookup as of an earlier time still serves K7
    early = get_online_features(store, svc, asked, as_of=D("2021-01-25"))
    assert {r.state: r.x for r in early.collect()}["K7"] == 7
    late = get_online_features(store, svc, asked, as_of=D("2022-01-01"))
    assert all(r.x is None for r in late.collect())
    plan = got._jdf.queryExecution().toString()
    assert "PartitionFilters: [bucket" in plan or "PartitionFilters: [isnotnull(bucket" in plan or (
        "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters", 1)[1][:80])
    found = {f.split("bucket=")[1].split("/")[0] for f in store.snapshot(
        "v", buckets={3}).inputFiles()}
    assert found <= {str(b) for b in range(32)}


def test_keys_of_other_types_find_their_buckets(spark, tmp_root):
    view = FeatureView("v", [Entity("id", ("id",))], None, [Field("x", T.LongType())],
                       FeatureSource("src", "date", path=f"{tmp_root}/src"))
    spark.createDataFrame([(i, D("2021-01-04"), i * 2) for i in range(50)],
                          "id int, date timestamp_ntz, x long").write.parquet(f"{tmp_root}/src")
    store = SnapshotStore(spark, f"{tmp_root}/s")
    materialize_incremental(spark, store, view, end_ts=D("2021-02-01"))
    asked = spark.createDataFrame([(7,), (99,)], "id long")
    got = get_online_features(store, FeatureService("s", [view]), asked).collect()
    assert sorted((r.id, r.x) for r in got) == [(7, 14), (99, None)]
