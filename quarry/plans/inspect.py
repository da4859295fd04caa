"""Plan inspection with the public ``explain`` API."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def python_nodes(df: DataFrame) -> list[str]:
    """Physical nodes that run Python (UDF evaluation, pandas maps)."""
    text = plan_text(df, "simple")
    marks = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas")
    return [m for m in marks if m in text]
