"""Filter interaction audit: what each filter removes in every order the filters can be applied in.

Each document gets one bit per filter that it fails.  A condition on the text
sets its bit in one pass.  The existential filter (an identical text has a
smaller id anywhere in the table) is a left-semi self-join on the text's hash,
the exact text and the smaller id; its ids are united with the other failures'
ids, and the bits of an id are combined.  Counting equal combinations leaves at
most a few dozen rows per part, and from these all orders follow: what a filter
removes depends only on which filters came before, not on their order.

Only documents whose hash occurs twice carry their texts into the self-join.
The side that is looked up holds each text once, with its smallest id; where a
text has more than ``PIECE`` copies, that row is repeated and the copies are
dealt over the repetitions, so a group of copies never meets in one task.

Defined results: a null text is empty; an empty text has no words, no capitals
and no signs.  A null source is the part ``''``, as an empty one is.  Repeated
rows count as often as given; rows equal in id are not smaller than each other.
A null id is neither smaller nor larger than another, and has no labels.  Of
labels that repeat an id, one that marks it counts.  Without documents there is
no part and no row.  Columns other than ``doc_id``, ``text`` and ``source`` (and
``doc_id``, ``quality`` and ``toxic`` of the labels) are not read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm import shared

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SIGNS = 50, 65, 5, "[#$%&*|]"
BITS = {name: 1 << i for i, name in enumerate(FILTERS)}
#: Copies of one text that are looked up in one task.
PIECE = 1000
_KEYS = ("doc_id", "part", "hash_a", "hash_b")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def _texts(docs: DataFrame) -> DataFrame:
    """``doc_id, part, text`` without nulls in the last two, and 128 bits of hash of the text."""
    rows = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.withColumns({"hash_a": F.xxhash64("text"), "hash_b": F.xxhash64(F.lit("b"), "text")})


def _conditions() -> dict[str, Column]:
    """What a text fails by itself, from ``text`` and its ``words``."""
    n_words, n_distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    return {
        "A": n_words < LEAST_WORDS,
        "B": 100 * n_distinct < LEAST_DISTINCT * n_words,
        "C": 100 * capitals > MOST_CAPITALS * F.length("text"),
        "D": F.col("text").rlike(SIGNS),
    }


def checked(docs: DataFrame) -> DataFrame:
    """``doc_id, part, hash_a, hash_b, mask``: the bits of the conditions each text fails by itself."""
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    mask = F.lit(0)
    for name, fails in _conditions().items():
        mask = mask.bitwiseOR(F.when(fails, BITS[name]).otherwise(0))
    return _texts(docs).withColumn("words", words).select(*_KEYS, mask.alias("mask"))


def repeated(docs: DataFrame, hashes: DataFrame, piece: int = PIECE) -> DataFrame:
    """The keys of documents whose exact text a smaller id has.

    ``hashes`` has ``doc_id, hash_a, hash_b`` of the same documents.
    """
    shared_hashes = (
        hashes.groupBy("hash_a", "hash_b")
        .agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 AND first_id IS NOT NULL")
    )
    # Written, its size is known: Spark broadcasts it if it is small and deals the texts by hash if not.
    shared_hashes = shared.written(shared_hashes, "audit-hashes")
    suspects = _texts(docs).join(shared_hashes, ["hash_a", "hash_b"])
    n_pieces = F.ceil(F.col("copies") / piece).cast("int")
    # Any piece will do for a row, as the other side is in all of them.
    dealt = F.floor(F.rand(11) * n_pieces).cast("int")
    later = suspects.where(F.col("doc_id") > F.col("first_id")).select(*_KEYS, "text", dealt.alias("piece"))
    known = (
        suspects.groupBy("hash_a", "hash_b", "text")
        .agg(F.min("doc_id").alias("least_id"), F.max("copies").alias("copies"))
        .select("hash_a", "hash_b", "text", "least_id", F.explode(F.sequence(F.lit(0), n_pieces - 1)).alias("piece"))
    )
    one, other = later.alias("one"), known.alias("other")
    same = F.col("other.least_id") < F.col("one.doc_id")
    for c in ("hash_a", "hash_b", "text", "piece"):
        same &= F.col(f"one.{c}") == F.col(f"other.{c}")
    return one.join(other, same, "left_semi").select(*_KEYS)


def marked(docs: DataFrame, piece: int = PIECE) -> DataFrame:
    """``doc_id, part, mask, docs``: the bits of all filters failed, and how many equal rows there are."""
    own = shared.written(checked(docs), "audit-checked")
    copies = repeated(docs, own, piece).select(*_KEYS, F.lit(BITS["E"]).alias("mask"), F.lit(0).alias("docs"))
    failures = own.withColumn("docs", F.lit(1)).unionByName(copies)
    together = failures.groupBy(*_KEYS).agg(F.bit_or("mask").alias("mask"), F.sum("docs").alias("docs"))
    return together.select("doc_id", "part", "mask", "docs")


def combinations(marks: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, good, toxic, docs``: how many documents fail each combination of filters."""
    flags = labels.groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    flag = lambda name: F.coalesce(name, F.lit(False)).alias(name)
    known = marks.join(flags, "doc_id", "left").select("part", "mask", flag("good"), flag("toxic"), "docs")
    return known.groupBy("part", "mask", "good", "toxic").agg(F.sum("docs").alias("docs"))


def _places(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """``filter_order, step, before, bit``: where each filter stands in each order, after which others."""
    rows = []
    for order in permutations(filters):
        before = 0
        for step, name in enumerate(order, 1):
            rows.append(("".join(order), step, before, BITS[name]))
            before |= BITS[name]
    return rows


def effects(combined: DataFrame) -> DataFrame:
    """``part, before, bit`` and the counts of that filter after that set of others."""
    n = len(FILTERS)
    ways = {
        (before, bit): factorial(before.bit_count()) * factorial(n - 1 - before.bit_count())
        for _, _, before, bit in _places()
    }
    after = F.array(
        *(F.struct(F.lit(s).alias("before"), F.lit(b).alias("bit"), F.lit(w).alias("ways")) for (s, b), w in ways.items())
    )
    rows = combined.select("*", F.inline(after))
    failed = F.col("mask").bitwiseAND(F.col("bit")) != 0
    earlier = F.col("mask").bitwiseAND(F.col("before")) != 0
    conditions = dict(zip(COUNTS, (
        ~failed & ~earlier, failed & ~earlier, failed & earlier, F.col("mask") == F.col("bit"),
        failed & ~earlier & F.col("good"), failed & ~earlier & F.col("toxic"),
    ), strict=True))
    counted = rows.groupBy("part", "before", "bit", "ways").agg(
        *(F.sum(F.when(c, F.col("docs")).otherwise(0)).alias(name) for name, c in conditions.items())
    )
    over_orders = F.sum(F.col("removed") * F.col("ways")).over(Window.partitionBy("part", "bit"))
    return counted.withColumn("shapley", over_orders)


def audit(docs: DataFrame, labels: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per part, order of the filters and step, with the counts of that step's filter."""
    order, step, before, bit = zip(*_places(), strict=True)
    places = docs.sparkSession.createDataFrame(
        pa.table({
            "filter_order": pa.array(order), "step": pa.array(step, pa.int32()),
            "before": pa.array(before, pa.int32()), "bit": pa.array(bit, pa.int32()),
        })
    )
    found = effects(combinations(marked(docs, piece), labels))
    return found.join(places, ["before", "bit"]).select(
        "part", "filter_order", "step", *(F.col(c).cast("bigint").alias(c) for c in (*COUNTS, "shapley"))
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "labels"))


def _statement() -> str:
    places = ", ".join(str(row) for row in _places())
    return rf"""
    WITH texts AS (
      SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^ \x09-\x0D]+') AS ws FROM documents
    ), judged AS (
      SELECT doc_id, part,
        CASE WHEN len(ws) < {LEAST_WORDS} THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(ws)) < {LEAST_DISTINCT} * len(ws) THEN 2 ELSE 0 END
        + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * length(text)
            THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(text, '{SIGNS}') THEN 8 ELSE 0 END
        + CASE WHEN min(doc_id) OVER (PARTITION BY text) < doc_id THEN 16 ELSE 0 END AS mask
      FROM texts
    ), flags AS (
      SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
    ), docs AS (
      SELECT part, mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
      FROM judged LEFT JOIN flags USING (doc_id)
    ), places(filter_order, step, before, bit) AS (VALUES {places}
    ), steps AS (
      SELECT part, filter_order, step, bit,
        count(*) FILTER (mask & (before | bit) = 0) AS kept,
        count(*) FILTER (mask & bit <> 0 AND mask & before = 0) AS removed,
        count(*) FILTER (mask & bit <> 0 AND mask & before <> 0) AS redundant,
        count(*) FILTER (mask = bit) AS unique_fails,
        count(*) FILTER (mask & bit <> 0 AND mask & before = 0 AND good) AS good_lost,
        count(*) FILTER (mask & bit <> 0 AND mask & before = 0 AND toxic) AS toxic_lost
      FROM docs, places GROUP BY ALL
    )
    SELECT * EXCLUDE (bit), CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM steps"""


SQL = _statement()
