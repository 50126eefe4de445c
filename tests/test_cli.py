"""The job entry point end to end in its own process: full rebuild, then a
stream over change folders on the same tables."""

import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS="--master local[2] --conf spark.ui.enabled=false "
               "--conf spark.driver.host=127.0.0.1 --conf spark.driver.bindAddress=127.0.0.1 pyspark-shell")
    return subprocess.run([sys.executable, "-m", "docmart", *args], cwd=ROOT, env=env,
                          capture_output=True, text=True, timeout=600)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_cli_full_and_stream(spark, scratch):
    out = _run("full", "--test-sf", SF, "--out", f"{scratch}/full")
    assert out.returncode == 0, out.stderr[-2000:]
    assert spark.read.parquet(f"{scratch}/full/indexes/movies").count() == 1500
    for table, ids in (("film_work", [1, 2]), ("person", [5]), ("genre", [7])):
        spark.createDataFrame([(i,) for i in ids], "id bigint").write.parquet(f"{scratch}/changes/{table}")
    out = _run("stream", "--test-sf", SF, "--out", f"{scratch}/stream", "--changes", f"{scratch}/changes",
               "--id-type", "bigint", "--available-now")
    assert out.returncode == 0, out.stderr[-2000:]
    assert spark.read.parquet(f"{scratch}/stream/indexes/persons").count() == 1
    assert spark.read.parquet(f"{scratch}/stream/indexes/movies").count() > 2
