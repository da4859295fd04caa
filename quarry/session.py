"""Session helpers: building a local session for tests/bench and the
checkpoint-directory policy used by operators that cut lineage."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "quarry",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with this library's settings: AQE (coalescing and skew
    join) on, UTC session zone, UI off. Whatever the launcher already set
    (``spark-submit --master/--conf``, defaults file) wins; the master is
    set only when asked for, or when nothing else names one. ``extra`` and
    explicit arguments are the caller's wish and always apply."""
    memory = os.environ.get("QUARRY_DRIVER_MEMORY", "16g")
    if not os.environ.get("PYSPARK_SUBMIT_ARGS"):
        # the JVM's memory is set when it starts, before any session setting
        SparkContext._ensure_initialized(conf=SparkConf(loadDefaults=False).set("spark.driver.memory", memory))
    SparkContext._ensure_initialized()
    given = SparkConf()  # with the JVM up: what the launcher and the defaults file set
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    conf = {
        "spark.app.name": app,
        "spark.master": f"local[{cpus}]",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    conf = {k: v for k, v in conf.items() if not given.contains(k)}
    if conf.get("spark.master", "").startswith("local") and not given.contains("spark.sql.shuffle.partitions"):
        conf["spark.sql.shuffle.partitions"] = cpus   # one JVM: as many as cores
    if master:
        conf["spark.master"] = master
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    b = SparkSession.builder
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for stored intermediates.

    The cluster names it in ``spark.checkpoint.dir``; a folder set on the
    context counts as well. Only a single-JVM session (master ``local`` or
    ``local[...]``: tests, the bench) may fall back to a scratch folder of
    this machine; on a cluster, where executors do not share local disks,
    an unset folder raises.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-", dir=os.environ.get("QUARRY_SCRATCH") or tempfile.gettempdir())
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for one action, then as they were."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint (survives executor loss; the
    result's partitioning is fixed, so partition ids are stable)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
