"""Readers: driver tables, CSV/JSON/Parquet/Avro/JDBC files, file catalogues."""

from quarry.sources.tables import TABLES, load_table, register_tables  # noqa: F401
