"""Physical plans as text."""

import contextlib
import io

from pyspark.sql import DataFrame


def plan_of(df: DataFrame) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
