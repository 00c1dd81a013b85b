"""Feature tables kept up by changed days equal a full build; versions and files."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pintime.plans.features import count_features, trend_features
from pintime.plans.maintenance import COUNTS, TRENDS, changed_days, rebuild, update
from pintime.sources.periods import PERIOD, PeriodTable
from pintime.sources.versions import VersionConflict, VersionLog

DAILY = "date date, location string, daily_count long"
POINTS = "date date, sub_region_1 string, sub_region_2 string, s1 long, s2 long, s3 long"
PLACES = ["A", "B", "C", "NATION_0", None]


def rows_of(df):
    return sorted(map(str, df.collect()))


def count_rows(rng, n=160):
    """Days over six years, thin enough that keys miss weeks and whole years."""
    out = {}
    for _ in range(n):
        day = date(1995, 11, 1) + timedelta(days=rng.randrange(2200))
        out[day, rng.choice(PLACES)] = rng.choice([None, 0, 1, 5, 9])
    return out


def point_rows(rng, n=160):
    out = {}
    for i in range(n):
        day = date(1996, 1, 1) + timedelta(weeks=rng.randrange(260))
        out[day, rng.choice(["A", "B", None]), str(i % 3)] = tuple(
            rng.choice([None, 1, 2, 3]) for _ in range(3))
    return out


def frame(spark, kind, rows):
    if kind is COUNTS:
        return spark.createDataFrame([(*k, v) for k, v in rows.items()], DAILY)
    return spark.createDataFrame([(*k, *v) for k, v in rows.items()], POINTS)


def changed(rng, rows, make):
    """Some rows late or new, some corrected, some days gone."""
    more = make(rng, 8)
    out = {k: (more[k2] if rng.random() < 0.05 else v)
           for (k, v), k2 in zip(rows.items(), rng.choices(list(more), k=len(rows)), strict=True)}
    gone = {k[0] for k in rng.sample(list(rows), 4)}
    return {k: v for k, v in out.items() if k[0] not in gone} | more


@pytest.mark.parametrize("spec, make, full", [(COUNTS, count_rows, count_features),
                                              (TRENDS, point_rows, trend_features)])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_updates_equal_a_full_build(spark, tmp_root, spec, make, full, seed):
    rng = random.Random(seed)
    rows = make(rng)
    table = PeriodTable(spark, f"{tmp_root}/t")
    assert rebuild(table, spec, frame(spark, spec, rows)).version.number == 1
    for turn in range(2):
        before, rows = rows, changed(rng, rows, make)
        raw = frame(spark, spec, rows)
        days = sorted({k[0] for k in before.keys() | rows.keys() if before.get(k, 0) != rows.get(
            k, 0) or (k in before) != (k in rows)})
        assert set(days) >= set(changed_days(table, raw))
        done = update(table, spec, raw, days if turn else None)
        assert set(done.cell_periods) <= {spec.label(d).year for d in days}
        assert rows_of(table.read("rows").drop(PERIOD)) == rows_of(full(raw))
        assert changed_days(table, raw) == []


@pytest.fixture
def steady(spark, tmp_root):
    rng = random.Random(7)
    rows = {(date(1996, 1, 2) + timedelta(days=d), p): rng.randrange(9)
            for d in range(0, 2000, 3) for p in "AB"}
    table = PeriodTable(spark, f"{tmp_root}/steady")
    rebuild(table, COUNTS, frame(spark, COUNTS, rows))
    return table, rows


def test_a_new_day_touches_its_period_alone(spark, steady):
    table, rows = steady
    before = table.current()
    day = max(rows)[0] + timedelta(days=2)
    raw = frame(spark, COUNTS, rows | {(day, "A"): 4})
    done = update(table, COUNTS, raw)
    assert done.row_periods == done.cell_periods == [day.year] and done.days == 1
    for part in ("cells", "edges", "rows"):
        old, new = before.periods(part), table.current().periods(part)
        assert {p for p in new if old.get(p) != new[p]} == {day.year}
    assert rows_of(table.read("rows").drop(PERIOD)) == rows_of(count_features(raw))
    files = table.read("cells", [day.year]).inputFiles()
    assert files and all(f"period={day.year}" in f for f in files)


def test_a_year_s_first_week_touches_the_year_before(spark, steady):
    table, rows = steady
    raw = frame(spark, COUNTS, rows | {(date(1997, 12, 31), "A"): 99})
    done = update(table, COUNTS, raw, [date(1997, 12, 31)])
    assert done.cell_periods == [1998] and done.row_periods == [1997, 1998]
    assert rows_of(table.read("rows").drop(PERIOD)) == rows_of(count_features(raw))
    assert update(table, COUNTS, raw, []).row_periods == []


def test_raw_scan_is_bounded_by_the_touched_weeks(spark, steady, tmp_root):
    from pintime.plans.maintenance import _within
    table, rows = steady
    frame(spark, COUNTS, rows).write.parquet(f"{tmp_root}/raw")
    raw = spark.read.parquet(f"{tmp_root}/raw")
    week = COUNTS.cells(raw.where(_within("date", [(date(1998, 3, 3), date(1998, 3, 9))])))
    text = week._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(date,1998-03-03)" in text and "LessThanOrEqual(date,1998-03-09" in text


def test_thousands_of_scattered_days(spark, tmp_root):
    rows = {(date(1996, 1, 2) + timedelta(days=3 * d), "A"): d % 7 for d in range(1, 1200)}
    table = PeriodTable(spark, f"{tmp_root}/many")
    rebuild(table, COUNTS, frame(spark, COUNTS, rows))
    raw = frame(spark, COUNTS, {k: v + 1 for k, v in rows.items() if v != 3})
    assert update(table, COUNTS, raw).days == 1199
    assert rows_of(table.read("rows").drop(PERIOD)) == rows_of(count_features(raw))


def test_a_dead_writer_and_two_writers(spark, steady):
    table, rows = steady
    version = table.current()
    raw = frame(spark, COUNTS, rows | {(date(1999, 5, 5), "B"): 50})
    table.stage("rows", raw.select("date").withColumn(PERIOD, F.lit(1999)))     # died here
    assert rows_of(table.read("rows").drop(PERIOD)) == rows_of(
        count_features(frame(spark, COUNTS, rows)))
    update(table, COUNTS, raw)
    staged = table.stage("rows", table.read("rows", version=version))
    with pytest.raises(VersionConflict):
        table.commit([(*staged[:2], None)], version)
    assert rows_of(table.read("rows").drop(PERIOD)) == rows_of(count_features(raw))
    old = rows_of(table.read("rows", version=version))      # a reader of the old version
    assert old and table.vacuum(keep=2) >= 2
    assert rows_of(table.read("rows", version=version)) == old
    assert table.vacuum(keep=1) > 0
    assert rows_of(table.read("rows").drop(PERIOD)) == rows_of(count_features(raw))
    table.drop()
    assert table.current() is None


def test_version_log(spark, tmp_root):
    log = VersionLog(spark, f"{tmp_root}/log")
    assert log.latest() is None
    log.commit(1, {"a": "é"})
    with pytest.raises(VersionConflict):
        log.commit(1, {"a": "other"})
    log.commit(2, {"a": 2})
    assert log.latest() == (2, {"a": 2}) and log.read(1) == {"a": "é"}
    assert log.versions() == [1, 2]


def test_empty_raw_table(spark, tmp_root):
    table = PeriodTable(spark, f"{tmp_root}/none")
    empty = spark.createDataFrame([], DAILY)
    rebuild(table, COUNTS, empty)
    assert table.read("rows").count() == 0
    raw = frame(spark, COUNTS, {(date(1997, 1, 1), "A"): 3})
    update(table, COUNTS, raw)
    assert rows_of(table.read("rows").drop(PERIOD)) == rows_of(count_features(raw))
    update(table, COUNTS, empty)
    assert table.read("rows").count() == 0
