"""Drift reports from stored profiles against the scan."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pintime import config
from pintime.operators.drift import drift_report
from pintime.plans.profiles import Columns, DriftProfiles
from pintime.sources.periods import period_of

A, B = ("1997-01-01", "1997-12-31"), ("1998-01-01", "1998-12-31")
COLUMNS = Columns(numeric=("x", "z"), categorical=("c",), target="y")


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    out = []
    for i in range(3000):
        t = datetime(1996, 7, 1) + timedelta(days=rng.randrange(1100))
        late = t.year == 1998
        out.append((t, rng.gauss(0.4 * late, 1), rng.choice([None, 1.0, 2.0, float("nan")]),
                    rng.choice("pqr" if late else "pq"), float(rng.randrange(60) + 9 * late)))
    return spark.createDataFrame(
        out, f"{config.EVENT_TS} timestamp_ntz, x double, z double, c string, y double").checkpoint()


def scan(rows):
    a, b = (rows.where(F.year(config.EVENT_TS) == y).withColumn("target", F.col("y"))
            for y in (1997, 1998))
    return {r.feature: r for r in drift_report(a, b, ["x", "z"], ["c"], "target").collect()}


@pytest.fixture(scope="module")
def profiles(spark, rows):
    from pintime.session import scratch_dir
    p = DriftProfiles(spark, scratch_dir(spark, "profiles-test"), COLUMNS)
    p.write(rows)
    return p


def same(got, want, **near):
    assert got.keys() == want.keys()
    for k, r in want.items():
        for c in ("statistic", "p_value", "n_a", "n_b", "mean_a", "mean_b", "drifted"):
            a, b = getattr(got[k], c), getattr(r, c)
            assert a == b or a == pytest.approx(b, **near), (k, c, a, b)


def test_exact_report_is_the_scan_s(rows, profiles):
    got = {r.feature: r for r in profiles.report(A, B).collect()}
    same(got, scan(rows), rel=1e-9)
    assert got["x"].drifted and got["c"].drifted


def test_sketched_report_is_near_and_reads_sketches_alone(rows, profiles):
    report = profiles.report(A, B, sketched=True)
    got, want = {r.feature: r for r in report.collect()}, scan(rows)
    for k in ("x", "z"):
        assert abs(got[k].statistic - want[k].statistic) < 0.02
        assert (got[k].n_a, got[k].n_b) == (want[k].n_a, want[k].n_b)
    assert got["c"].statistic == pytest.approx(want["c"].statistic)
    assert got["target"].statistic == pytest.approx(want["target"].statistic, rel=0.25)
    assert [got[k].drifted for k in got] == [want[k].drifted for k in got]
    files = report.inputFiles()
    assert not any("/values/" in f for f in files)
    periods = {f.split("period=")[1][:4] for f in profiles.window("sketches", *B).inputFiles()}
    assert periods == {"1998"}


def test_windows_of_some_months_and_no_others(rows, profiles):
    a, b = ("1997-03-01", "1997-05-31"), ("1998-11-01", "1999-02-28")
    got = {r.feature: r for r in profiles.report(a, b).collect()}
    inside = lambda w: rows.where(F.col(config.EVENT_TS).between(*[
        F.lit(datetime.fromisoformat(d)).cast("timestamp_ntz") for d in w])).withColumn(
        "target", F.col("y"))
    want = {r.feature: r for r in drift_report(inside(a), inside(b), ["x", "z"], ["c"]).collect()}
    same(got, want, rel=1e-9)
    for bad in (("1997-01-02", "1997-12-31"), ("1997-01-01", "1997-12-30"), B[::-1]):
        with pytest.raises(ValueError):
            profiles.window("values", *bad)
    with pytest.raises(ValueError):
        profiles.report(A, ("2020-01-01", "2020-12-31"))


def test_a_rebuilt_period_replaces_its_rows(spark, rows, profiles, tmp_root):
    p = DriftProfiles(spark, f"{tmp_root}/p", COLUMNS)
    p.write(rows)
    before = p.table.current()
    changed = rows.withColumn("x", F.when(F.year(config.EVENT_TS) == 1998, F.col("x") + 1)
                              .otherwise(F.col("x")))
    p.write(changed.where(period_of(config.EVENT_TS) == 1998), [1998])
    after = p.table.current()
    for part in ("values", "categories", "sketches"):
        old, new = before.periods(part), after.periods(part)
        assert {k for k in new if old[k] != new[k]} == {1998}
    same({r.feature: r for r in p.report(A, B).collect()}, scan(changed), rel=1e-9)


def test_refresh_keeps_profiles(spark, tmp_root):
    from pintime.plans.refresh import refresh
    from pintime.plans.windows import split_windows, window_union
    sf = "/root/testdata/sf0.001"
    store, ws = refresh(spark, sf, f"{tmp_root}/fs", profiles=True)
    first = DriftProfiles(spark, f"{tmp_root}/fs/profiles")
    version = first.table.current().number
    refresh(spark, sf, f"{tmp_root}/fs", profiles=True)       # nothing changed
    assert first.table.current().number == version
    got = {r.feature: r for r in first.report(config.DRIFT_WINDOW_A,
                                              config.DRIFT_WINDOW_B).collect()}
    from pintime.plans.workspace import open_workspace
    a, b = split_windows(window_union(spark, open_workspace(spark, sf), target="target"))
    want = {r.feature: r for r in drift_report(a, b, config.X_COLS, ["state"]).collect()}
    same(got, want, rel=1e-9)
