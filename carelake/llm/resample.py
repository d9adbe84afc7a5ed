"""Target-distribution importance resampling: documents drawn by how much they resemble a target.

Words and runs of words are hashed into a fixed number of buckets.  A bucket is
worth the logarithm of its share in the target over its share in the corpus, a
document the mean worth of its features, and adding Gumbel noise to that and
taking the highest draws without replacement.

Features are found a batch at a time: the texts are joined with a separator that
no word can hold, one regular expression finds all words, and a search of their
places among the documents' offsets says whose they are, so that runs across two
documents are masked before the counts (``bincount``) by bucket or document.
The corpus is passed over twice, once for the buckets' counts, once for worths.
Each task sends one row per bucket, and the table of buckets (``BUCKETS`` rows,
whatever the corpus) is all that the driver holds.

The draw finds the lowest score that counts from the number of documents per
score (scores are whole numbers in a narrow range), and ranks what is above by
ranges of the order, so no task sorts more than its range.

Defined results: a null text has no words, weight 0 and no rank.  The noise of
a null id is that of an empty one, and it comes last among ties.  Repeated rows
count and are drawn as often as given, in any order among themselves.  An empty
target leaves the corpus's rare buckets worth most.  Without documents there is
no row.  Columns other than ``doc_id`` and ``text`` (``text`` of the target) are
not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm import shared, tokens

LONGEST, BUCKETS, SCALE = 1, 10_000, 1000
LEAST_WORDS, PERCENT, SEED = 20, 10, 2024
#: Bytes of text that are joined and searched at once; a longer text is cut between words.
PART_BYTES = 4 << 20
#: Distinct features whose bucket a task remembers, and the longest of them.
KNOWN, KNOWN_BYTES = 400_000, 64
#: On lower-cased UTF-8: bytes from 0x80 belong to letters outside ASCII, which are all word characters.
_WORDS = re.compile(rb"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)")
#: Between words, before lower-casing.
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
#: Ends a document; no word holds it, and cutting at words leaves it in the gaps.
_SENTINEL = b"\x00"


class _Buckets(dict):
    """Feature to bucket, computed once per distinct feature."""

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        found = crc32(feature) % self.buckets
        if len(feature) <= KNOWN_BYTES:
            if len(self) >= KNOWN:
                self.clear()
            self[feature] = found
        return found


def features(
    texts: list[bytes], known: _Buckets, longest: int = LONGEST
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features of the texts, the number of the text each is from, and words per text."""
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    begins = np.cumsum(sizes + 1) - sizes - 1
    # Cutting at the words gives gap, word, gap, ..., so the lengths give every word's place.
    cut = _WORDS.split(_SENTINEL.join(texts).lower())
    words = cut[1::2]
    ends = np.cumsum(np.fromiter(map(len, cut), dtype=np.int64, count=len(cut)))
    owner = np.searchsorted(begins, ends[: 2 * len(words) : 2], side="right") - 1
    buckets, owners = [], []
    for n in range(1, longest + 1):
        if n > len(words):
            break
        runs = words if n == 1 else list(map(b" ".join, zip(*(words[k:] for k in range(n)))))
        found = np.fromiter(map(known.__getitem__, runs), dtype=np.int64, count=len(runs))
        inside = owner[: len(runs)] == owner[n - 1 :]
        buckets.append(found[inside])
        owners.append(owner[: len(runs)][inside])
    none = np.zeros(0, dtype=np.int64)
    return (
        np.concatenate([none, *buckets]), np.concatenate([none, *owners]), np.bincount(owner, minlength=len(texts))
    )


def long_features(text: bytes, known: _Buckets, longest: int = LONGEST) -> Iterator[tuple[np.ndarray, int]]:
    """Buckets of all features of one long text and its number of words, a piece at a time."""
    at, last = 0, []
    while at < len(text):
        gap = _GAP.search(text, at + PART_BYTES)
        piece = text[at : gap.start() if gap else len(text)]
        found, _, n_words = features([piece], known, longest)
        if longest > 1:
            words = _WORDS.findall(piece.lower())
            # Runs that begin before the cut and end after it.
            near, cut = [*last, *words[: longest - 1]], len(last)
            across = [
                known[b" ".join(near[i : i + n])]
                for n in range(2, longest + 1)
                for i in range(max(0, cut - n + 1), min(cut, len(near) - n + 1))
            ]
            found = np.concatenate([found, np.array(across, dtype=np.int64)])
            last = [*last, *words[1 - longest :]][1 - longest :]
        yield found, int(n_words[0])
        at += len(piece)


def in_pieces(
    texts: list[bytes], known: _Buckets, longest: int, take: Callable[[np.ndarray, np.ndarray], None]
) -> np.ndarray:
    """Words per text; ``take`` gets the features' buckets and texts in bounded pieces."""
    long = [i for i, t in enumerate(texts) if len(t) > PART_BYTES]
    found, owner, n_words = features([b"" if len(t) > PART_BYTES else t for t in texts], known, longest)
    take(found, owner)
    for i in long:
        for found, n in long_features(texts[i], known, longest):
            take(found, np.full(len(found), i))
            n_words[i] += n
    return n_words


def _encoded(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary()).fill_null(b"").to_pylist()


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: features per bucket over all texts; buckets without one are left out."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _Buckets(buckets), np.zeros(buckets, dtype=np.int64)

        def take(found: np.ndarray, _: np.ndarray) -> None:
            total[:] += np.bincount(found, minlength=buckets)

        for batch in batches:
            for part in tokens.parts(batch, most=PART_BYTES):
                in_pieces(_encoded(part.column("text")), known, longest, take)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    counted = texts.select("text").mapInArrow(lambda b: tokens.tidied(of(b)), "bucket int, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """What a feature of each bucket adds, from the bucket counts of corpus and target."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, frame in ((s, corpus), (t, target)):
        for row in frame.collect():  # at most one row per bucket
            counts[row["bucket"]] = row["n"]
    return np.floor(SCALE * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weighted(docs: DataFrame, worth: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every document."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Buckets(len(worth))
        for batch in batches:
            for part in tokens.parts(batch, most=PART_BYTES):
                n = part.num_rows
                if not n:
                    continue
                n_features, total = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)

                def take(found: np.ndarray, owner: np.ndarray) -> None:
                    n_features[:] += np.bincount(owner, minlength=n)  # noqa: B023
                    # Sums of whole numbers below 2**53 are exact in doubles.
                    total[:] += np.bincount(owner, weights=worth[found], minlength=n).astype(np.int64)  # noqa: B023

                n_words = in_pieces(_encoded(part.column("text")), known, longest, take)
                weight = total // np.maximum(n_features, 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c.astype(np.int64)) for c in (n_words, n_features, weight))],
                    ["doc_id", "n_words", "n_features", "weight"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        lambda b: tokens.tidied(of(b)), f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint"
    )


def noise(seed: int = SEED) -> Column:
    """A document's Gumbel noise in thousandths, from its id alone."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-F.lit(float(SCALE)) * F.log(-F.log((h + 0.5) / float(2**32))))


def drawn(scored: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``scored`` (a written table with ``eligible``) and ``rank``: 1, 2, 3, ... by score, null where not drawn."""
    wanted = scored.where("eligible").count() * percent // 100
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    per_score = scored.where("eligible").groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    lowest = (
        per_score.withColumn("above", F.coalesce(F.sum("n").over(above), F.lit(0)))
        .where(F.col("above") < wanted).agg(F.min("score")).first()[0]
    )
    if lowest is None:
        return scored.withColumn("rank", F.lit(None).cast("bigint"))
    chosen = F.col("eligible") & (F.col("score") >= lowest)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.col("row")]
    ranges = scored.where(chosen).repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    # Ranges are in the order of the ranks; each is a bounded piece.
    ranges = shared.written(ranges, "resample-ranges")
    seats = shared.ranked(ranges, [], order, F.col("range"), name="before").drop("range")
    rank = F.when(F.col("before") < wanted, F.col("before") + 1)
    others = scored.where(~chosen).withColumn("rank", F.lit(None).cast("bigint"))
    return seats.withColumn("rank", rank).drop("before").unionByName(others)


def resampled(
    docs: DataFrame, target: DataFrame, *, percent: int = PERCENT, least_words: int = LEAST_WORDS,
    longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document."""
    worth = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets), buckets)
    scored = weighted(docs, worth, longest).withColumns({
        "score": F.col("weight") + noise(seed), "eligible": F.col("n_words") >= least_words,
        "row": F.monotonically_increasing_id(),
    })
    return drawn(shared.written(scored, "resample-scores"), percent).drop("eligible", "row")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (shared.table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return resampled(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


def _statement() -> str:
    # CRC-32 from its polynomial, as DuckDB has no function for it.
    table = """list_transform(range(256), lambda b: list_reduce(list_prepend(CAST(b AS BIGINT), range(8)),
        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""
    octets = """list_transform(range(0, CAST(len(hex(encode(w))) / 2 AS BIGINT)),
        lambda i: CAST(('0x' || hex(encode(w))[2 * i + 1 : 2 * i + 2]) AS BIGINT))"""
    crc = f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {octets}),
        lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1])))"""
    upper, lower = shared.UPPER, shared.LOWER

    def words(name: str, key: str) -> str:
        return rf"""
          SELECT {key}, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM {name}"""

    return f"""
    WITH rows AS (SELECT row_number() OVER () AS row, * FROM documents
    ), corpus AS ({words("rows", "row")}
    ), wanted AS ({words("benchmark", "item_id")}
    ), crcs AS (SELECT {table} AS t
    ), codes AS (
      SELECT w, {crc} % {BUCKETS} AS bucket FROM (SELECT w FROM corpus UNION SELECT w FROM wanted), crcs
    ), s AS (SELECT bucket, count(*) AS n FROM corpus JOIN codes USING (w) GROUP BY bucket
    ), t AS (SELECT bucket, count(*) AS n FROM wanted JOIN codes USING (w) GROUP BY bucket
    ), worth AS (
      SELECT bucket, CAST(floor({SCALE} * ln((coalesce(t.n, 0) + 1.0::DOUBLE)
          * ((SELECT count(*) FROM corpus) + {BUCKETS})
          / ((s.n + 1.0::DOUBLE) * ((SELECT count(*) FROM wanted) + {BUCKETS})))) AS BIGINT) AS gain
      FROM s LEFT JOIN t USING (bucket)
    ), summed AS (
      SELECT row, count(*) AS n_features, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
      FROM corpus JOIN codes USING (w) JOIN worth USING (bucket) GROUP BY row
    ), scored AS (
      SELECT row, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-{SCALE}.0::DOUBLE * ln(-ln(
          (CAST(('0x' || sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8]) AS BIGINT) + 0.5::DOUBLE)
          / 4294967296.0::DOUBLE))) AS BIGINT) AS score
      FROM rows LEFT JOIN summed USING (row)
    ), places AS (
      SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n
      FROM scored WHERE n_features >= {LEAST_WORDS}
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * n // 100 THEN place END AS rank
    FROM scored LEFT JOIN places USING (row)"""


SQL = _statement()
