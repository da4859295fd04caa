"""Writers for files, JDBC, document stores and label lines."""
