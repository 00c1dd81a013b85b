"""CSV load with a bad-record limit, CSV round trip, JSON requests."""

import pytest
from pyspark.sql import functions as F

from pintime.sources.csv import COUNT_CSV_SCHEMA, TooManyBadRecords, load_csv
from pintime.sources.requests import build_requests, read_request_keys, request_keys

HEADER = ("date,state,lag_1_weekly_vaccinations_count,weekly_vaccinations_count,"
          "lag_2_weekly_vaccinations_count\n")
GOOD = ["2021-01-04 00:00:00,A,1,2,3\n", "2021-01-11 00:00:00,A,2,,1\n"]
BAD = ["2021-13-45 00:00:00,A,1,2,3\n", "2021-01-18 00:00:00,B,x,2,3\n",
       "2021-01-25 00:00:00,B,1,2,3,4\n"]


def write(path, lines):
    import os
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part.csv", "w") as fh:
        fh.write(HEADER + "".join(lines))


def test_two_bad_records_pass(spark, tmp_root):
    write(f"{tmp_root}/two", GOOD + BAD[:2])
    out = load_csv(spark, f"{tmp_root}/two", COUNT_CSV_SCHEMA, f"{tmp_root}/t2")
    got = sorted((r.state, r.lag_1_weekly_vaccinations_count, r.weekly_vaccinations_count)
                 for r in out.collect())
    assert got == [("A", 1, 2), ("A", 2, None)]     # blank integer -> null


def test_three_bad_records_fail(spark, tmp_root):
    write(f"{tmp_root}/three", GOOD + BAD)
    with pytest.raises(TooManyBadRecords):
        load_csv(spark, f"{tmp_root}/three", COUNT_CSV_SCHEMA, f"{tmp_root}/t3")


def test_extra_column_is_bad(spark, tmp_root):
    write(f"{tmp_root}/extra", GOOD + BAD[2:])
    out = load_csv(spark, f"{tmp_root}/extra", COUNT_CSV_SCHEMA, f"{tmp_root}/t4")
    assert out.count() == 2


def test_requests_several_keys_one_named_state(spark, tmp_root):
    req = spark.createDataFrame(
        [("1", [("state", [2, 1], "BYTES", [["A"], ["B"]]),
                ("other", [1, 1], "BYTES", [["X"]])])],
        "id string, inputs array<struct<name string, shape array<int>, datatype string, "
        "data array<array<string>>>>")
    assert sorted(tuple(r) for r in request_keys(req).collect()) == [("1", "A"), ("1", "B")]
    keys = spark.createDataFrame([("r1", "A"), ("r2", "C")], "id string, state string")
    from pintime.sources.requests import write_requests
    write_requests(build_requests(keys, "id", "state"), f"{tmp_root}/req")
    back = read_request_keys(spark, f"{tmp_root}/req")
    assert sorted(tuple(r) for r in back.collect()) == [("r1", "A"), ("r2", "C")]
    assert back.where(F.col("state").isNull()).count() == 0
