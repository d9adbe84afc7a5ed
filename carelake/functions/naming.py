"""Column-name normalisation rules.

A rule maps one raw header to one column name.  ``rename`` applies a rule to a
batch or streaming frame as a pure projection and refuses to let two headers
fall together.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame

Rule = Callable[[str], str]

# Which characters of a raw header become which text.
SPACES = str.maketrans({" ": "_"})
ADMISSION_MARKS = str.maketrans({" ": "_", "/": "_or_", ".": "_", "-": "_"})
DEVICE_MARKS = str.maketrans({" ": "_", "(": "_", ")": "_", ",": "_"})


def basic(header: str) -> str:
    """Lower case with underscores for spaces; outer spaces become underscores too."""
    return header.lower().translate(SPACES)


def admissions(header: str) -> str:
    """``basic`` plus slashes spelled out and dots and dashes as underscores."""
    return header.lower().translate(ADMISSION_MARKS)


def device(header: str) -> str:
    """Trimmed name without brackets or commas.

    Pairs of underscores are halved once, left to right, so three leave two;
    one underscore at the end is dropped.
    """
    marked = header.strip().lower().translate(DEVICE_MARKS)
    return marked.replace("__", "_").removesuffix("_")


def rename(df: DataFrame, rule: Rule) -> DataFrame:
    names = [rule(header) for header in df.columns]
    clashes = [name for name, uses in Counter(names).items() if uses > 1]
    if clashes:
        raise ValueError(f"columns {df.columns} collide after renaming: {clashes}")
    return df.toDF(*names)
