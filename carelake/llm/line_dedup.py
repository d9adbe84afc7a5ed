"""Line dedup: a line that several documents hold stays in the first of them.

Two hashes of each line's key are dealt by range, ordered by document and
position, and the first document of each key is carried along the ordered rows.
No text moves: what returns to a document is a bitmap of its dropped lines in
64-bit words, of which only words with a bit set are stored.

A key that many documents hold would fill one range.  Keys that make up a
two-thousandth of a sample of the lines (so about two thousand at most) get
their first document from a partial aggregate and are dealt over salted ranges;
the sample only decides how rows are dealt, never what is dropped.

Defined results: a null or empty text is one empty line.  A null ``doc_id`` is
one document after all others.  Repeated rows, and texts under one ``doc_id``,
count as one document; each row is returned with the lines it keeps.  Columns
other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm import shared

MIN_CHARS = 10
SAMPLE, HEAVY_SHARE, SALTS = 0.02, 2000, 256


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased."""
    return shared.lower_ascii(F.btrim(line, F.lit(shared.WHITE)))


def _keyed(docs: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id", text.alias("text"), F.xxhash64(text).alias("text_key"),
        *(F.col(c).alias(f"also_{c}") for c in also),
    )


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line that is long enough: document, position and 128 bits of its key."""
    lines = _keyed(docs).select(
        "doc_id", "text_key", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")
    )
    keys = lines.select("doc_id", "text_key", "pos", line_key(F.col("line")).alias("key"))
    return keys.where(F.char_length("key") >= min_chars).select(
        "doc_id", "text_key", "pos",
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"),
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, text_key, dropped`` for each document that loses lines.

    ``dropped`` holds ``(word, bits)`` in order: bit b of word w stands for the
    line at 64 * w + b.  Documents and words without a dropped line are absent.
    """
    rows = shared.written(occurrences(docs, min_chars), "line-hashes")
    least = max(20.0, rows.count() * SAMPLE / HEAVY_SHARE)
    heavy = (
        rows.select("h1", "h2").sample(SAMPLE, seed=7).groupBy("h1", "h2").count()
        .where(F.col("count") >= least).select("h1", "h2")
    )
    heavy = (
        rows.join(F.broadcast(heavy), ["h1", "h2"])
        .groupBy("h1", "h2").agg(F.min("doc_id").alias("heavy_first"), F.lit(True).alias("heavy"))
    )
    salt = F.when(F.col("heavy"), F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(SALTS))).otherwise(0)
    ordered = (
        rows.join(F.broadcast(heavy), ["h1", "h2"], "left")
        .withColumn("salt", salt)
        .repartitionByRange("h1", "h2", "salt")
    )
    stream = (
        Window.partitionBy("h1", "h2", "salt")
        .orderBy(F.asc_nulls_last("doc_id"), "pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    first = F.when(F.col("heavy"), F.col("heavy_first")).otherwise(F.first("doc_id").over(stream))
    later = F.col("first").isNotNull() & (
        F.col("doc_id").isNull() | (F.col("first") < F.col("doc_id"))
    )
    return (
        ordered.withColumn("first", first)
        .where(later)
        .select(
            "doc_id", "text_key", F.expr("pos div 64").cast("int").alias("word"),
            F.expr("shiftleft(1L, pos % 64)").alias("bit"),
        )
        .repartition("doc_id", "text_key")
        .groupBy("doc_id", "text_key", "word").agg(F.bit_or("bit").alias("bits"))
        .groupBy("doc_id", "text_key")
        .agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dropped"))
    )


def _flags(dropped: Column) -> Column:
    """0 or 1 for each line up to the last word of the bitmap."""
    words = F.aggregate(
        dropped,
        F.array().cast("array<bigint>"),
        lambda done, x: F.concat(
            done, F.array_repeat(F.lit(0).cast("bigint"), x["word"] - F.size(done)), F.array(x["bits"])
        ),
    )
    bits = F.sequence(F.lit(0), F.lit(63))
    return F.flatten(F.transform(words, lambda w: F.transform(bits, lambda b: F.getbit(w, b))))


def dedup_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, also: tuple[str, ...] = ()
) -> DataFrame:
    """Each row of ``docs`` as ``doc_id, kept_text, n_lines, n_dropped, dropped``, then ``also``."""
    bitmaps = keep_bitmaps(docs, min_chars).withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    rows = _keyed(docs, also)
    same = rows["doc_id"].eqNullSafe(bitmaps["_id"]) & (rows["text_key"] == bitmaps["_key"])
    lines = F.split("text", "\n", -1)
    left = F.array_join(
        F.zip_with(lines, _flags(F.col("dropped")), lambda x, f: F.when(F.coalesce(f, F.lit(0)) == 0, x)),
        "\n",
    )
    gone = F.aggregate("dropped", F.lit(0).cast("bigint"), lambda n, x: n + F.bit_count(x["bits"]))
    return rows.join(bitmaps, same, "left").select(
        "doc_id",
        F.when(F.col("dropped").isNull(), F.col("text")).otherwise(left).alias("kept_text"),
        F.size(lines).cast("bigint").alias("n_lines"),
        F.coalesce(gone, F.lit(0)).cast("bigint").alias("n_dropped"),
        "dropped",
        *(F.col(f"also_{c}").alias(c) for c in also),
    )


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """The columns of ``documents`` after the dedup.  A document left without text goes."""
    kept = dedup_lines(docs, also=("lang", "source"))
    return kept.where((F.col("n_dropped") == 0) | (F.btrim("kept_text", F.lit(shared.WHITE)) != "")).select(
        "doc_id", F.col("kept_text").alias("text"), "lang", "source",
        F.char_length("kept_text").cast("bigint").alias("n_chars"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(shared.table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


SQL = r"""
WITH lines AS (
  SELECT doc_id, u.i AS pos, string_split(coalesce(text, ''), chr(10))[u.i] AS line
  FROM documents, LATERAL (SELECT unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i) u
), keys AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), firsts AS (
  SELECT key, min(doc_id) AS first_doc, count(DISTINCT doc_id) AS n FROM keys WHERE length(key) >= 10 GROUP BY key
), marked AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(f.n >= 2 AND f.first_doc <> k.doc_id, FALSE) AS gone
  FROM keys k LEFT JOIN firsts f ON k.key = f.key AND length(k.key) >= 10
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
