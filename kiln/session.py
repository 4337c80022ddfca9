"""Session construction and the shared scratch location.

Everything that must outlive a task (snapshots, tracking tables, cut
lineage) is written under the folder the cluster names in
``spark.checkpoint.dir``. Only when that setting is absent (tests, a
laptop) do we create a private temporary folder and register it.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "kiln", extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with our defaults.

    On a cluster the session already exists and its settings win; the
    defaults only fill gaps for local runs.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and durable scratch output.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only a
    local master without one gets a private folder; on a cluster that folder
    would be another one on every machine, so it is an error there.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur.rstrip("/")
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return conf.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="kiln-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


#: Paths handed out inside the open scopes, innermost last.
_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the shared checkpoint root. What is
    written there stays until its owner removes it: the ``scratch_scope`` it was
    made in, or whoever cleans the shared folder."""
    path = f"{checkpoint_root(spark)}/kiln-scratch/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Owner of the intermediate tables made inside (ranges, dictionaries, node
    tables): they are deleted at its end. Frames built on them must have been
    written or collected by then. Scopes of one thread may be nested."""
    from kiln.sources import fs
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            fs.delete(spark, path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
