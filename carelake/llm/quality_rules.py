"""Quality rules whose thresholds follow each language and source.

For every ratio a sketch counts the documents of a language and source by
logarithmic buckets, so a quantile read from it is within one per cent.
Sketches are merged by adding counts: partial ones before they move, and into
each one the weight of ``PRIOR`` documents dealt as in its language, whose sketch
has the same weight dealt as in the whole.  So a small source leans on its
language by degrees, and a large one hardly at all.

The limits of a ratio are read from the sketch alone: its high quantile and
``FENCE`` times the distance of that from the median, and the same below.  A
document may exceed a quantile by one event of its own (a symbol, a repeated
line, a repeated window or an average line twice; for the length of words a
bucket's width) however narrow its group is.  Each document is joined with the
limits of its language and source.

Sketches are taken over documents that pass the base rules; the limits stay
where the bulk is as long as less than a tenth of a group is junk.  Counts are
whole numbers throughout (a document weighs ``UNIT``), so quantiles repeat.

Defined results: a null text has no words and fails the base rules.  Null
languages and sources are values of their own.  Repeated rows count as often as
given.  Columns other than ``doc_id``, ``text``, ``lang`` and ``source`` are not
read.  Without a document that passes, there are no limits and none is needed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm import measures, shared

LEAST_WORDS, MOST_REPEATED = 50, 50
RATIOS = ("symbols_per_word", "dup_line_share", "repeat_share", "chars_per_word")
GAMMA = 1.02
#: Low, middle and high quantile, in hundredths.
LOW, MIDDLE, HIGH = 10, 50, 90
FENCE = 3.0
PRIOR, UNIT = 50, 1000
SALTS = 64


def ratios() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words,
        "chars_per_word": F.col("word_chars") / words,
    }


def events() -> dict[str, Column]:
    """What one event makes of each ratio in the document itself."""
    one = F.lit(1.0)
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "symbols_per_word": one / words,
        "dup_line_share": one / lines,
        "repeat_share": F.greatest(2.0 * measures.WINDOW / words, 2.0 / lines),
        "chars_per_word": (GAMMA - 1) * F.col("chars_per_word"),
    }


def measured(docs: DataFrame) -> DataFrame:
    """Each document's counts and ratios, and whether it fails the base rules."""
    counted = docs.select("doc_id", "lang", "source", measures.measured("text").alias("m"))
    counted = counted.select("doc_id", "lang", "source", *(f"m.{n}" for n in measures.NAMES))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    return counted.withColumns({**ratios(), "base_failed": failed})


def sketches(rows: DataFrame) -> DataFrame:
    """``lang, source, ratio, bucket, n``: the mergeable sketch of each language and source."""
    pairs = F.explode(F.array(*(F.struct(F.lit(r).alias("ratio"), F.col(r).alias("x")) for r in RATIOS)))
    bucket = F.when(F.col("p.x") > 0, F.ceil(F.log("p.x") / math.log(GAMMA))).cast("int")
    return (
        rows.where(~F.col("base_failed")).select("lang", "source", pairs.alias("p"))
        .groupBy("lang", "source", F.col("p.ratio").alias("ratio"), bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def blended(sketch: DataFrame) -> DataFrame:
    """Each language and source's sketch, leaning on its language, and that on the whole; ``n`` in ``UNIT``ths."""
    whole = sketch.groupBy("ratio", "bucket").agg(F.sum("n").alias("n"))
    return _leaning(sketch, ["lang", "source"], _leaning(sketch, ["lang"], whole, []), ["lang"])


def _leaning(sketch: DataFrame, by: list[str], wider: DataFrame, wider_by: list[str]) -> DataFrame:
    """The sketch merged by ``by``, with the weight of ``PRIOR`` documents dealt as in ``wider``."""
    total = F.sum("n").over(Window.partitionBy(*wider_by, "ratio"))
    prior = wider.withColumn("total", total).select(
        *(F.col(c).alias(f"_{c}") for c in wider_by), F.col("ratio").alias("_ratio"), "bucket",
        F.expr(f"({PRIOR * UNIT} * n) div total").alias("n"),
    )
    same = F.col("ratio") == F.col("_ratio")
    for c in wider_by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    columns = [*by, "ratio", "bucket", "n"]
    given = sketch.select(*by, "ratio").distinct().join(prior, same).select(columns)
    own = sketch.withColumn("n", UNIT * F.col("n")).select(columns)
    return own.union(given).groupBy(*by, "ratio", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """The three quantiles of each ratio after merging the sketches by ``by``."""
    merged = sketch.groupBy(*by, "ratio", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "ratio")
    upto = group.orderBy(F.asc_nulls_first("bucket")).rowsBetween(Window.unboundedPreceding, 0)
    value = F.coalesce(2 * F.pow(F.lit(GAMMA), F.col("bucket")) / (GAMMA + 1), F.lit(0.0))
    ranked = merged.select(
        *by, "ratio", value.alias("x"), F.sum("n").over(upto).alias("upto"), F.sum("n").over(group).alias("n")
    )
    at = lambda q: F.min(F.when(100 * F.col("upto") >= q * F.col("n"), F.col("x")))
    return ranked.groupBy(*by, "ratio").agg(at(LOW).alias("low"), at(MIDDLE).alias("middle"), at(HIGH).alias("high"))


def limits(sketch: DataFrame) -> DataFrame:
    """``lang, source`` and for each ratio a struct: the outer quantiles and how far beyond them is allowed."""
    read = quantiles(blended(sketch), ["lang", "source"]).select(
        "lang", "source", "ratio",
        F.struct(
            "low", (FENCE * (F.col("middle") - F.col("low"))).alias("down"),
            "high", (FENCE * (F.col("high") - F.col("middle"))).alias("up"),
        ).alias("limit"),
    )
    return read.groupBy("lang", "source").agg(
        *(F.max(F.when(F.col("ratio") == r, F.col("limit"))).alias(f"limit_{r}") for r in RATIOS)
    )


def judged(docs: DataFrame) -> DataFrame:
    """Each document's counts with ``base_failed``, its limits and ``kept``."""
    rows = shared.written(measured(docs), "quality-measures")
    sketch = shared.written(sketches(rows), "quality-sketches")
    salt = F.pmod(F.xxhash64("doc_id", "n_bytes"), F.lit(SALTS))
    bounds = limits(sketch).withColumnsRenamed({"lang": "_lang", "source": "_source"}).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    same = (
        F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
        & (salt == F.col("_salt"))
    )
    inside = F.lit(True)
    for r, event in events().items():
        limit = F.col(f"limit_{r}")
        inside &= F.col(r) >= limit["low"] - F.greatest(limit["down"], event)
        inside &= F.col(r) <= limit["high"] + F.greatest(limit["up"], event)
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(True))
    return rows.join(bounds, same, "left").withColumn("kept", kept).drop("_lang", "_source", "_salt")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(shared.table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _statement() -> str:
    event = {
        "symbols_per_word": "1.0::DOUBLE / greatest(n_words, 1)",
        "dup_line_share": "1.0::DOUBLE / greatest(n_lines, 1)",
        "repeat_share": f"greatest({2 * measures.WINDOW}::DOUBLE / greatest(n_words, 1), 2.0::DOUBLE / greatest(n_lines, 1))",
        "chars_per_word": f"{GAMMA - 1!r}::DOUBLE * chars_per_word",
    }
    ratio_rows = " UNION ALL ".join(
        f"SELECT *, '{r}' AS ratio, {r} AS x, {event[r]} AS event FROM measured" for r in RATIOS
    )
    weight = PRIOR * UNIT
    at = lambda q: f"min(CASE WHEN 100 * upto >= {q} * total THEN mid END)"

    return rf"""
    WITH texts AS (
      SELECT doc_id, lang, source, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^ \x09-\x0D]+') AS ws,
        string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
    ), places AS (
      SELECT doc_id, ws, u.i FROM texts, LATERAL (SELECT unnest(range(1, len(ws) - 1)) AS i) u
    ), windows AS (
      SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS w FROM places
    ), often AS (
      SELECT doc_id, w FROM windows GROUP BY doc_id, w HAVING count(*) > 1
    ), inside AS (
      SELECT doc_id, count(DISTINCT i + k.k) AS n FROM windows JOIN often USING (doc_id, w),
        (SELECT unnest(range(0, 3)) AS k) k GROUP BY doc_id
    ), lines AS (
      SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(ls) AS line FROM texts)
      WHERE regexp_matches(line, '[^ \x09-\x0D]') GROUP BY doc_id, line
    ), same AS (
      SELECT doc_id, sum(n) AS n_lines, sum(n - 1) AS n_dup_lines FROM lines GROUP BY doc_id
    ), counted AS (
      SELECT t.doc_id, lang, source, len(ws) AS n_words,
        length(regexp_replace(text, '[ \x09-\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, coalesce(i.n, 0) AS n_repeat_words,
        coalesce(n_lines, 0) AS n_lines
      FROM texts t LEFT JOIN same USING (doc_id) LEFT JOIN inside i USING (doc_id)
    ), measured AS (
      SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
        n_symbols / greatest(n_words, 1) AS symbols_per_word,
        CAST(n_dup_lines AS DOUBLE) / greatest(n_lines, 1) AS dup_line_share,
        n_repeat_words / greatest(n_words, 1) AS repeat_share, word_chars / greatest(n_words, 1) AS chars_per_word
      FROM counted
    ), pairs AS ({ratio_rows}
    ), sketch AS (
      SELECT lang, source, ratio, CASE WHEN x > 0 THEN ceil(ln(x) / {math.log(GAMMA)!r}) END AS bucket, count(*) AS n
      FROM pairs WHERE NOT base_failed GROUP BY lang, source, ratio, bucket
    ), of_all AS (
      SELECT ratio, bucket, {weight} * sum(n) // sum(sum(n)) OVER (PARTITION BY ratio) AS n
      FROM sketch GROUP BY ratio, bucket
    ), langs AS (
      SELECT lang, ratio, bucket, sum(n) AS n FROM (
        SELECT lang, ratio, bucket, {UNIT} * n AS n FROM sketch UNION ALL
        SELECT lang, ratio, bucket, n FROM (SELECT DISTINCT lang, ratio FROM sketch) JOIN of_all USING (ratio)
      ) GROUP BY lang, ratio, bucket
    ), of_lang AS (
      SELECT lang, ratio, bucket, {weight} * n // sum(n) OVER (PARTITION BY lang, ratio) AS n FROM langs
    ), blended AS (
      SELECT lang, source, ratio, bucket, sum(n) AS n FROM (
        SELECT lang, source, ratio, bucket, {UNIT} * n AS n FROM sketch UNION ALL
        SELECT g.lang, g.source, g.ratio, l.bucket, l.n FROM (SELECT DISTINCT lang, source, ratio FROM sketch) g
          JOIN of_lang l ON g.lang IS NOT DISTINCT FROM l.lang AND g.ratio = l.ratio
      ) GROUP BY lang, source, ratio, bucket
    ), used AS (
      SELECT lang, source, ratio, {at(LOW)} AS low, {at(MIDDLE)} AS middle, {at(HIGH)} AS high
      FROM (
        SELECT lang, source, ratio, coalesce(2 * pow({GAMMA}, bucket) / ({GAMMA} + 1), 0.0) AS mid,
          sum(n) OVER (PARTITION BY lang, source, ratio ORDER BY bucket NULLS FIRST) AS upto,
          sum(n) OVER (PARTITION BY lang, source, ratio) AS total
        FROM blended) GROUP BY lang, source, ratio
    ), outside AS (
      SELECT DISTINCT p.doc_id FROM pairs p JOIN used u ON p.lang IS NOT DISTINCT FROM u.lang
        AND p.source IS NOT DISTINCT FROM u.source AND p.ratio = u.ratio
      WHERE p.x < low - greatest({FENCE} * (middle - low), event)
        OR p.x > high + greatest({FENCE} * (high - middle), event)
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM outside) AS kept
    FROM measured"""


SQL = _statement()
