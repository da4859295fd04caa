"""Loading the parquet tables of a data directory (one ``<name>.parquet``
per table). Column selection and filters are left to Catalyst: callers
project and filter what they need and both reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def load_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, data_dir: str, names=TABLES) -> None:
    """Expose the tables as temp views for ``spark.sql``."""
    for n in names:
        load_table(spark, data_dir, n).createOrReplaceTempView(n)
