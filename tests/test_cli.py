"""The recurring jobs from the command line: refresh, train, score."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


def run(*args):
    out = subprocess.run([sys.executable, "-m", "pintime", *args], cwd=REPO, capture_output=True,
                         text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout


def test_refresh_train_score(spark):
    root = tempfile.mkdtemp(prefix="pintime-cli-")
    assert "weekly_vaccinations version 1" in run("refresh", SF, f"{root}/fs")
    assert "saved model version 1" in run("train", SF, f"{root}/fs", "--trees", "3")
    from pintime.sources.requests import build_requests, write_requests
    keys = spark.createDataFrame([("r1", "NATION_19"), ("r2", "NATION_99")],
                                 "id string, state string")
    write_requests(build_requests(keys, "id", "state"), f"{root}/req")
    run("score", f"{root}/fs", f"{root}/req", f"{root}/out")
    got = {r.id: r for r in spark.read.parquet(f"{root}/out").collect()}
    assert got["r1"].prediction is not None and len(got["r1"].feature_values) == 8
    assert got["r2"].prediction is None
