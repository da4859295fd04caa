"""quarry: a library of Spark-native data operators.

Every operator is a plain function over DataFrames (or a dict of them).
Relational work stays inside Catalyst (no Python UDFs); ML work uses
``pyspark.ml``; streaming uses Structured Streaming.
"""

__version__ = "0.1.0"
