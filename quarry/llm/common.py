"""Driver-side helpers: tables, stored intermediates, column checks."""

from __future__ import annotations

import pickle
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from quarry.llm.text import worker_store
from quarry.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder of the session."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage through a Parquet table in the shared folder: it survives
    lost executors, is columnar and is read again with pruning."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Remove a table written by ``stored`` that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for f in {p.rpartition("/")[0] for p in df.inputFiles()}:
        if "/llm-" not in f:
            raise ValueError(f"not a stored intermediate: {f}")
        path = jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of an Arrow batch sent to a Python worker, where nobody chose.
BATCH_BYTES = 8 << 20


def need(df: DataFrame, *cols: str) -> None:
    """Check the input of an operator: it has the columns, and its session
    sends texts to Python workers in batches of a few MB (Spark's own bound
    of 64 MB is held several times over by the JVM and a worker)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} not in {df.columns}")
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key, "67108864b") in ("67108864b", "67108864", "64m", "64MB"):
        conf.set(key, str(BATCH_BYTES))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def file_bytes(path: str, limit: int = 64 << 20) -> bytes:
    """A vocabulary or model file, read on the driver and then broadcast;
    its size is fixed by the tokenizer and checked here."""
    with open(path, "rb") as f:
        data = f.read(limit + 1)
    if len(data) > limit:
        raise ValueError(f"{path} is larger than {limit} bytes")
    return data


class Shared:
    """A broadcast object, classes of this subpackage included (a plain
    broadcast pickles classes by name, which a worker may not have). Only
    for data of a fixed or checked size; unpickled once per worker."""

    def __init__(self, spark: SparkSession, value):
        self.key = uuid.uuid4().hex
        self.data = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        held = worker_store()
        if held.get("shared_key", {}).get(self.key) is None:
            if len(held.get("shared_key", {})) > 4:
                held["shared_key"].clear()
            held.setdefault("shared_key", {})[self.key] = pickle.loads(self.data.value)
        return held["shared_key"][self.key]
