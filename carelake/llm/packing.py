"""Best-fit packing of tokenized documents into sequences of bounded length.

Documents above a third of the capacity fit into a sequence at most twice.  They
are matched greedily: the longest with the longest that still fits beside it.
Shorter documents then go, longest first, to the smallest gap that takes them.

Which sequences arise depends only on how many pieces of each length there are,
so the plan is made from that count, which has a row for each length up to the
capacity however large the corpus is.  Equal sequences are planned together, as
one run.  Pieces then find their place by their rank among those of their length.

Tokenizing is row by row; what moves between tasks is a row of numbers per piece.
A document longer than a sequence is cut, and only such a one.

Defined results: a null text is empty and is the closing token alone.  Repeated
rows are packed as often as given, null ids like others.  An empty table gives no
pieces.  Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import shared, tokens

CAPACITY = 2048
CLOSING = 0
#: Pieces of one length that one window ranks.
PIECE = 1_000


def pieces(docs: DataFrame, capacity: int = CAPACITY, closing: int = CLOSING, path: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: the token pieces of each document."""
    path = path or tokens.default_path()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path)
        for batch in batches:
            for part in tokens.parts(batch):
                words = tokens.Words(part.column("text"))
                ids, bounds = encoder.encode(words.distinct)
                flat, ends = tokens.spread(ids, bounds, words.of)
                begins = ends[words.first_word]
                rows = []
                for i, (a, b) in enumerate(zip(begins, begins[1:])):
                    own = np.append(flat[a:b], closing).astype("<u4")
                    for n, at in enumerate(range(0, len(own), capacity)):
                        cut = own[at : at + capacity]
                        rows.append((i, n, at, len(cut), zlib.crc32(cut.tobytes())))
                table = np.array(rows, dtype=np.int64).reshape(-1, 5)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(table[:, 0])), pa.array(table[:, 1].astype(np.int32)),
                        pa.array(table[:, 2]), pa.array(table[:, 3]), pa.array(table[:, 4]),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        of, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


class _Runs:
    """Runs of equal open sequences by the gap they still have."""

    def __init__(self) -> None:
        self.gaps: list[int] = []
        self.at: dict[int, list[int]] = {}

    def add(self, gap: int, run: int) -> None:
        if gap:
            if gap not in self.at:
                insort(self.gaps, gap)
                self.at[gap] = []
            self.at[gap].append(run)

    def take(self, size: int) -> int | None:
        """A run with the smallest gap that holds ``size``."""
        i = bisect_left(self.gaps, size)
        if i == len(self.gaps):
            return None
        gap = self.gaps[i]
        run = self.at[gap].pop()
        if not self.at[gap]:
            del self.at[gap]
            del self.gaps[i]
        return run


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Sequences as runs ``(how many, [(length, how many of it in each), ...])``."""
    left = {n: c for n, c in counts.items() if c}
    large = sorted(n for n in left if 3 * n > capacity)
    runs: list[tuple[int, list[tuple[int, int]]]] = []
    open_runs = _Runs()

    def add(many: int, content: list[tuple[int, int]]) -> None:
        runs.append((many, content))
        open_runs.add(capacity - sum(n * k for n, k in content), len(runs) - 1)

    while large:
        size = large[-1]
        i = bisect_left(large, capacity - size + 1) - 1
        mate = large[i] if i >= 0 else None
        if mate is None:
            add(left[size], [(size, 1)])
            large.pop()
        elif mate == size:
            if left[size] > 1:
                add(left[size] // 2, [(size, 2)])
            left[size] %= 2
            if not left[size]:
                large.pop()
            elif i == 0:
                add(1, [(size, 1)])
                large.pop()
            else:
                other = large[i - 1]
                add(1, [(size, 1), (other, 1)])
                large.pop()
                left[other] -= 1
                if not left[other]:
                    large.remove(other)
        else:
            many = min(left[size], left[mate])
            add(many, [(size, 1), (mate, 1)])
            for n in (size, mate):
                left[n] -= many
                if not left[n]:
                    large.remove(n)

    for size in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        rest = left[size]
        while rest:
            run = open_runs.take(size)
            if run is None:
                each = capacity // size
                if rest >= each:
                    add(rest // each, [(size, each)])
                if rest % each:
                    add(1, [(size, rest % each)])
                break
            many, content = runs[run]
            gap = capacity - sum(n * k for n, k in content)
            each = gap // size
            whole, some = min(many, rest // each), 0
            if whole < many:
                some = rest % each if whole == rest // each else 0
            rest -= whole * each + some
            unused = many - whole - bool(some)
            runs[run] = (unused, content)
            if unused:
                open_runs.add(gap, run)
            if whole:
                add(whole, [*content, (size, each)])
            if some:
                add(1, [*content, (size, some)])
    return [run for run in runs if run[0]]


def places(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, from rank, to rank, first sequence, in each sequence, offset)`` for each run's lengths."""
    rows, used, first = [], dict.fromkeys(counts, 0), 0
    for many, content in plan(counts, capacity):
        offset = 0
        for size, each in content:
            rows.append((size, used[size], used[size] + many * each, first, each, offset))
            used[size] += many * each
            offset += size * each
        first += many
    return rows


def packed(docs: DataFrame, capacity: int = CAPACITY, closing: int = CLOSING, path: str | None = None) -> DataFrame:
    """The pieces with ``sequence_id`` and their ``offset`` there."""
    spark = docs.sparkSession
    cut = shared.written(pieces(docs, capacity, closing, path), "pack-pieces")
    # At most ``capacity`` rows come to the driver, and a few times as many go out.
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = places(counts, capacity)
    schema = "_length bigint, low bigint, high bigint, first bigint, each bigint, base bigint"
    spans = F.broadcast(spark.createDataFrame(rows, schema))
    slices = max(1, -(-max(counts.values(), default=1) // PIECE))
    dealt = cut.withColumn("_order", shared.hashed(F.lit("pack"), "doc_id", "piece", "ids_crc32"))
    ranked = shared.ranked(
        dealt, ["length"], [F.col(c) for c in ("_order", "doc_id", "piece", "ids_crc32")],
        F.floor(F.col("_order") * slices),
    )
    within = F.col("rank") - F.col("low")
    return ranked.join(
        spans, (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    ).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.expr("(rank - low) div each")).alias("sequence_id"),
        (F.col("base") + within % F.col("each") * F.col("length")).alias("offset"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(shared.table(spark, sf_dir, "documents"))
