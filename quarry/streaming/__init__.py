"""Structured Streaming jobs: file stream → keyed messages, keyed upsert
sink (exactly-once through foreachBatch + batch-id folders), minute files."""
