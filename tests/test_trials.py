"""Trials as jobs: cancelled ones stop, the others end; the gain of a layout."""
import threading
import time

import pytest
from pyspark.sql import functions as F

from kiln.ml import features as M
from kiln.ml import models as L
from kiln.ml import search as H
from kiln.ml.trials import TrialCancelled, run_trials
from kiln.operators import timing as TM


def slow_job(spark, seconds=60):
    """A job whose tasks sleep."""
    def sleep(it):
        for x in it:
            time.sleep(seconds)
            yield x
    return spark.sparkContext.parallelize(range(2), 2).mapPartitions(sleep).count()


def running(spark):
    return len(spark.sparkContext.statusTracker().getActiveJobsIds())


def settled(spark, most=0):
    for _ in range(100):
        if running(spark) <= most:
            return True
        time.sleep(0.1)
    return False


def test_a_late_trial_is_cancelled_and_others_end(spark):
    began = time.monotonic()
    done = run_trials(spark, [[lambda: slow_job(spark)], [lambda: spark.range(50).count()],
                              [lambda: spark.range(10).count(), lambda: spark.range(20).count()]], parallelism=3, timeout=4)
    assert time.monotonic() - began < 30 and settled(spark)
    assert isinstance(done[0][1], TrialCancelled) and done[1] == ([50], None) and done[2] == ([10, 20], None)


def test_a_failed_fold_cancels_the_trials_other_jobs(spark):
    started = threading.Event()

    def wait_then_fail():
        for _ in range(200):
            if running(spark):
                break
            time.sleep(0.05)
        started.set()
        raise ZeroDivisionError("no such fold")

    began = time.monotonic()
    done = run_trials(spark, [[lambda: slow_job(spark), wait_then_fail], [lambda: spark.range(7).count()]], parallelism=3)
    assert started.is_set() and time.monotonic() - began < 30 and settled(spark)
    assert isinstance(done[0][1], ZeroDivisionError) and done[1] == ([7], None)


def test_trials_have_their_own_pool_and_leave_none_behind(spark):
    pools = []

    def note():
        pools.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
    run_trials(spark, [[note, note], [note]], parallelism=1)
    assert len(set(pools)) == 2 and all(p.startswith("trial-") for p in pools)
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    assert run_trials(spark, []) == []


def test_sweep_pins_nothing_and_keeps_errors(spark):
    df = spark.range(300).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0).alias("y"), (F.col("id") % 3).alias("fold"))

    def stages(p):
        if p["bad"]:
            raise ValueError("bad point")
        return [M.assembler(["x"], "features"), L.estimator("linear", "features", "y", regParam=p["reg"])]

    grid = [{"bad": False, "reg": 0.0}, {"bad": True, "reg": 0.0}, {"bad": False, "reg": 5.0}]
    for stored in (False, True):
        out = H.sweep(df, grid, stages, "y", stored=stored).orderBy("trial").collect()
        assert out[0]["avg_rmse"] == pytest.approx(0.0, abs=1e-6) and out[2]["avg_rmse"] > 0.1
        assert out[1]["avg_rmse"] is None and "bad point" in out[1]["error"]
        assert not df.is_cached and spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_gain_is_read_from_the_scan(spark, tmp_path):
    rows = spark.range(1000).withColumn("g", F.col("id") % 10)
    rows.repartition(8).write.parquet(str(tmp_path / "a"))
    rows.repartitionByRange(10, "g").write.parquet(str(tmp_path / "b"))
    got = {r["metric"]: (r["before"], r["after"]) for r in
           TM.scan_gain(spark.read.parquet(str(tmp_path / "a")), spark.read.parquet(str(tmp_path / "b")), "g = 3").collect()}
    assert got["rows_met"] == (100, 100) and got["files"][0] == 8 and got["files_met"][0] == 8 and got["files_met"][1] == 1
