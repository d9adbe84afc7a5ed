"""Token counts of every prefix, so that budgets are answered without encoding again.

For each text the operator stores how the token count changes with every code
point.  The running sum at n is exactly the number of tokens of the first n code
points, as the library would count them; it may fall, where a letter completes a
merge.  ``tokens_of_prefix`` and ``longest_prefix`` answer from the stored
steps alone.

Work is row by row and nothing is shuffled.  Texts are taken in parts of bounded
size, whatever a batch holds.

Defined results: a null text is empty and has no tokens.  Repeated rows and null
ids are returned as given.  Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from carelake.llm import shared, tokens

LIMIT = 2048


def _steps(words: tokens.Words, encoder: tokens.Encoder) -> tuple[np.ndarray, np.ndarray]:
    """Change of the count at each code point of a part, and where each text begins."""
    counts, bounds = encoder.prefix_counts(words.distinct)
    changes = np.diff(counts, prepend=0)
    firsts = bounds[:-1]
    changes[firsts] = counts[firsts]
    points = (words.data & 0xC0) != 0x80
    steps = np.zeros(int(points.sum()), dtype="<i4")
    steps[words.inside[points]] = tokens.spread(changes, bounds, words.of)[0]
    return steps, words.counted(points)


def _totals(steps: np.ndarray, begins: np.ndarray) -> np.ndarray:
    return np.array([steps[a:b].sum() for a, b in zip(begins, begins[1:])], dtype=np.int64)


def prefix_steps(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, steps``: the steps are 32-bit numbers, one per code point."""
    path = path or tokens.default_path()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path)
        for batch in batches:
            for part in tokens.parts(batch):
                words = tokens.Words(part.column("text"))
                steps, begins = _steps(words, encoder)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(np.diff(words.bounds)), pa.array(_totals(steps, begins)),
                        pa.array([steps[a:b].tobytes() for a, b in zip(begins, begins[1:])], pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "n_tokens", "steps"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        of, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, steps binary"
    )


def tokens_of_prefix(steps: bytes, length: int) -> int:
    """Tokens of the first ``length`` code points."""
    return int(np.frombuffer(steps, dtype="<i4")[:length].sum())


def longest_prefix(steps: bytes, limit: int = LIMIT) -> int:
    """Code points of the longest prefix of at most ``limit`` tokens."""
    counts = np.cumsum(np.frombuffer(steps, dtype="<i4"))
    fits = np.flatnonzero(counts <= limit)
    return int(fits[-1]) + 1 if len(fits) else 0


def budgets(docs: DataFrame, limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, fits``: what a budget asks of the steps, without storing them.

    ``fits`` is the number of code points of the longest prefix within the limit.
    """
    path = path or tokens.default_path()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path)
        for batch in batches:
            for part in tokens.parts(batch):
                words = tokens.Words(part.column("text"))
                steps, begins = _steps(words, encoder)
                totals, fits = _totals(steps, begins), np.diff(begins)
                for i in np.flatnonzero(totals > limit):
                    fits[i] = longest_prefix(steps[begins[i] : begins[i + 1]].tobytes(), limit)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(words.bounds)), pa.array(totals), pa.array(fits)],
                    ["doc_id", "n_bytes", "n_tokens", "fits"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        of, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, fits bigint"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = budgets(shared.table(spark, sf_dir, "documents"))
    return counted.selectExpr(
        "doc_id", "n_bytes", "n_tokens", f"n_tokens > {LIMIT} AS over_limit", "fits"
    )
