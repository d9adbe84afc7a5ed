"""Counts over the words, lines and characters of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

NAMES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words",
    "n_bytes", "n_upper", "n_digits", "n_stops", "n_bangs", "n_pipes", "n_ascii",
)
WINDOW = 3
_WHITE = b" \t\n\x0b\x0c\r"


def _without(data: bytes, some: bytes) -> int:
    """How many of the bytes are among ``some``."""
    return len(data) - len(data.translate(None, some))


def repeated_words(words: list[bytes], window: int = WINDOW) -> tuple[int, int]:
    """Words inside windows that occur twice or more, and the number of distinct words."""
    seen: dict[bytes, int] = {}
    numbers = np.fromiter(map(seen.setdefault, words, range(len(words))), dtype=np.int64, count=len(words))
    n = len(words) - window + 1
    if n < 2:
        return 0, len(seen)
    code = numbers[:n]
    for k in range(1, window):
        if code.max() > (1 << 62) // len(words):
            code = np.unique(code, return_inverse=True)[1]
        code = code * len(words) + numbers[k : n + k]
    _, which, counts = np.unique(code, return_inverse=True, return_counts=True)
    often = np.flatnonzero(counts[which] > 1)
    inside = np.zeros(len(words), dtype=bool)
    for k in range(window):
        inside[often + k] = True
    return int(inside.sum()), len(seen)


def measure(text: str | None) -> tuple[int, ...]:
    """The counts in ``NAMES``; all zero for a null or empty text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    repeats, distinct = repeated_words(words)
    lines, same, n_lines = set(), 0, 0
    for line in data.split(b"\n"):
        if line and not line.isspace():
            n_lines += 1
            same += line in lines
            lines.add(line)
    return (
        len(words), len(text or "") - _without(data, _WHITE), _without(data, b"#*$%&|<>"), same, repeats,
        n_lines, distinct, len(data), _without(data, bytes(range(65, 91))), _without(data, b"0123456789"),
        _without(data, b"."), _without(data, b"!"), _without(data, b"|"), _without(data, bytes(range(128))),
    )


def measured(text: Column | str) -> Column:
    """A struct with the counts in ``NAMES``."""

    @F.pandas_udf(", ".join(f"{n} bigint" for n in NAMES))
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            rows = np.array([measure(t) for t in part], dtype=np.int64).reshape(-1, len(NAMES))
            yield pd.DataFrame(rows, columns=list(NAMES))

    return of(text)
