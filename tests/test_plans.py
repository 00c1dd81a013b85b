"""Plan checks: pruned scans, pushed filters, no cartesian products."""

import contextlib
import io
import re
from datetime import datetime

from pyspark.sql import functions as F

import __spark_entry__ as entry
from pintime.plans.catalog import QUERIES
from pintime.functions.time import ts_lit

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def read_schemas(text: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<([^>]*)>", text)


def test_feature_builds_prune_and_push_down(spark):
    trend = plan(entry.queries()["trend_features"](spark, SF))
    line_scans = [s for s in read_schemas(trend) if "l_shipdate" in s]
    assert line_scans and all("l_extendedprice" not in s and "l_returnflag" not in s
                              for s in line_scans)
    counts = plan(entry.queries()["count_features"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in counts
    assert all("o_totalprice" not in s for s in read_schemas(counts))


def test_training_set_has_no_cartesian_product(spark):
    text = plan(entry.queries()["training_set_clean"](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_time_range_reaches_parquet_scan(spark, tmp_root):
    rows = [("A", datetime(2021, 1, d), float(d)) for d in range(1, 20)]
    spark.createDataFrame(rows, "state string, date timestamp_ntz, x double") \
        .write.parquet(f"{tmp_root}/src")
    df = spark.read.parquet(f"{tmp_root}/src").where(
        (F.col("date") > ts_lit("2021-01-05")) & (F.col("date") <= ts_lit("2021-01-10")))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan(df.select("state", "x")))
    assert pushed and "GreaterThan(date" in pushed[0] and "LessThanOrEqual(date" in pushed[0]


def test_no_cross_or_nested_loop_join_in_any_query(spark):
    skip = {"train_predict", "train_predict_poisson", "validation_mae", "feature_importance",
            "batch_score", "train_predict_boosted", "boosting_curve"}
    for key, fn in QUERIES.items():
        if key in skip:
            continue
        text = plan(fn(spark, SF))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Join Cross"):
            assert bad not in text, (key, bad)


def test_key_filter_reaches_every_scan_of_the_training_set(spark):
    text = plan(entry.queries()["filter_state"](spark, SF))
    scans = re.findall(r"PushedFilters: \[([^\]]*)\]", text)
    assert scans and all("EqualTo(state,NATION_19)" in s for s in scans)


def test_changed_sources_give_new_answers(spark, tmp_root):
    for t in ("nation", "customer", "supplier", "orders", "lineitem"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_root}/{t}.parquet")
    before = entry.queries()["training_set"](spark, tmp_root).count()
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    orders.where("o_orderkey % 3 = 0").write.mode("overwrite").parquet(f"{tmp_root}/orders.parquet")
    after = entry.queries()["training_set"](spark, tmp_root).count()
    assert 0 < after < before


def test_periods_are_pruned(spark):
    text = plan(entry.queries()["training_set"](spark, SF))
    found = re.findall(r"PartitionFilters: \[([^\]]*)\]", text)
    assert sum("period" in f for f in found) >= 2
    from pintime.plans.workspace import open_workspace
    ws = open_workspace(spark, SF)
    one = ws.counts.to_df(spark, time_range=(ts_lit("1997-03-01"), ts_lit("1997-09-30")))
    assert "PartitionFilters: [isnotnull(period" in plan(one)
    years = {r.y for r in one.select(F.year("date").alias("y")).distinct().collect()}
    assert years == {1997}
