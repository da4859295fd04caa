"""Compaction of a folder-partitioned Parquet table.

Folders that many small loads have filled with small files are rewritten to
files of about ``target_bytes``. Sizes come from the files' metadata columns
by one distributed aggregation; only folders that get fewer files are read.

The swap can be repeated: new files are written to a hidden staging folder,
then a plan names the old files and the staged ones, and only then old files
are removed and new ones moved in. After a crash before the plan nothing has
changed (staging is swept); after the plan, ``compact_folders`` (or
``recover``) finishes the swap before anything else.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sinks.files import write_partitioned
from quarry.sinks.store import Store, sealed, unsealed

STAGING, PLANS = "_compact", "_compact_plans"


def folder_files(spark: SparkSession, path: str) -> DataFrame:
    """(folder, file, bytes) of every data file, folder relative to ``path``."""
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("full")).agg(
        F.max("_metadata.file_size").alias("bytes"))
    full = F.url_decode(F.replace("full", F.lit("+"), F.lit("%2B")))  # the column holds a URI
    depth = F.regexp_extract(full, r"((?:/[^/=]+=[^/]*)+)/[^/]+$", 1)
    return files.select(F.substring(depth, 2, 1 << 30).alias("folder"), F.substring_index(full, "/", -1).alias("file"), "bytes")


def small_folders(spark: SparkSession, path: str, target_bytes: int) -> DataFrame:
    """(folder, n_files, bytes, files) of the folders that fewer files of
    ``target_bytes`` could hold."""
    per = folder_files(spark, path).groupBy("folder").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("bytes"), F.sort_array(F.collect_list("file")).alias("files"))
    return per.filter(F.col("n_files") > F.greatest(F.ceil(F.col("bytes") / F.lit(target_bytes)), F.lit(1)))


def recover(spark: SparkSession, path: str) -> int:
    """Finish the swaps that a crash has left open, sweep staging folders
    without a plan; returns the number of finished plans."""
    store, done = Store(spark, path), 0
    for name in store.names(PLANS):
        body = unsealed(store.read(f"{PLANS}/{name}"))
        if body is not None:
            for old in body["old"]:
                store.remove(old)
            for staged, to in body["new"]:
                store.move(staged, to)
            store.remove(f"{STAGING}/{body['id']}")
            done += 1
        store.remove(f"{PLANS}/{name}")
    for name in store.names(STAGING):
        store.remove(f"{STAGING}/{name}")
    return done


def compact_folders(spark: SparkSession, path: str, target_bytes: int = 128 << 20) -> dict[str, int]:
    """Rewrite the folders with too many small files; counts of folders and
    of files before and after. The driver holds the names of the files of
    those folders, never rows."""
    recover(spark, path)
    todo = small_folders(spark, path, target_bytes).collect()
    if not todo:
        return {"folders": 0, "before": 0, "after": 0}
    store, run = Store(spark, path), uuid.uuid4().hex[:12]
    cols = [p.partition("=")[0] for p in todo[0]["folder"].split("/")]
    old = [f"{r['folder']}/{f}" for r in todo for f in r["files"]]
    chosen = [store.root + "/" + r["folder"] for r in todo]
    rows = spark.read.option("basePath", path).option("mergeSchema", True).parquet(*chosen)
    write_partitioned(rows, f"{store.root}/{STAGING}/{run}", tuple(cols))
    new = [(f"{STAGING}/{run}/{r['folder']}/{f}", f"{r['folder']}/c{run}-{f}")
           for r in todo for f in store.names(f"{STAGING}/{run}/{r['folder']}") if not f.startswith(("_", "."))]
    store.create(f"{PLANS}/{run}.json", sealed({"id": run, "old": old, "new": new}))
    recover(spark, path)
    return {"folders": len(todo), "before": len(old), "after": len(new)}
