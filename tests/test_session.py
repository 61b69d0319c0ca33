import os
import subprocess
import sys
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from postgrove.session import shared_folder
from postgrove.sources.files import spread


def session(master, **settings):
    context = SimpleNamespace(master=master, applicationId="test")
    return SimpleNamespace(conf=settings, sparkContext=context)


def test_shared_folder_is_the_one_the_cluster_names(spark):
    named = session("spark://host:1", **{"spark.checkpoint.dir": "/shared/"})
    assert shared_folder(named, "a").startswith("/shared/a-")
    assert shared_folder(named, "a") != shared_folder(named, "a")
    for master in ("spark://host:1", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_folder(session(master), "a")
    assert shared_folder(session("local[*]"), "a").startswith("/")
    assert shared_folder(spark, "a").startswith("/")


@pytest.mark.parametrize("parts", [1, 4, 9])
def test_spread_moves_rows_only_where_cores_would_idle(spark, parts):
    df = spark.range(0, 100, 1, parts)
    plan = spread(df)._jdf.queryExecution().executedPlan().toString()
    assert ("RoundRobin" in plan) == (parts < spark.sparkContext.defaultParallelism)
    assert spread(df).agg(F.sum("id")).head()[0] == 4950


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Every query, from an empty folder and with the package on the driver's path alone."""
    script = """
import os, sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").config("spark.sql.session.timeZone", "UTC").config(
    "spark.driver.memory", "4g").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
def has_package(rows):
    import importlib.util
    yield importlib.util.find_spec("postgrove") is not None
assert not any(spark.sparkContext.parallelize([0, 1], 2).mapPartitions(has_package).collect())
failed = {}
for name, query in entry.queries().items():
    try:
        query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    except Exception as error:
        failed[name] = str(error)[-500:]
assert not failed, failed
print("done", len(entry.queries()))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", script, root], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1200
    )
    assert done.stdout.strip().split("\n")[-1].startswith("done"), done.stderr[-2000:]
